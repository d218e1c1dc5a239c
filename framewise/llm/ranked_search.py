"""Ranked lexical search: accumulators for short lists, skipping over long ones.

Documents are read once into index blocks (at most ``BLOCK_DOCS`` documents or
``BLOCK_BYTES`` of text, more only for one longer document): document lengths and, for the
terms of the queries, lists of (document, occurrences).  The corpus' own numbers
(documents, terms, documents of each term) are summed from the blocks.  A block then
answers every query:

* term at a time: the lists that together stay below ``SHORT`` of the block's documents are
  summed into accumulators; sorted by document, these are one list whose bound is
  their greatest sum;
* document at a time: the accumulators and the long lists move on together through
  windows of documents.  Lists whose bounds together stay below the tenth best score so far are
  only probed (binary search) for documents that the others bring up and that can
  still reach it.

The tenth best score lives on through all blocks of a task, so later blocks skip
more.  Each task hands on at most ``top`` documents a query; a window picks the best of all.

Defined results: terms are runs of digits, ASCII letters (A-Z lower-cased) and
characters beyond ASCII; null and empty texts have none and do not count as documents.
Equal scores are ranked by ascending doc_id, null ids last; repeated rows are documents of
their own, and so are repeated items.  An item without a scoring document has no
rows.  Queries are read in chunks, so their number is not bound by memory.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored

BLOCK_DOCS, BLOCK_BYTES = 32_768, 32 << 20
#: Queries answered by one pass over the documents, and the bytes of their texts.
CHUNK_ITEMS, CHUNK_BYTES = 2_000, 4 << 20
#: Share of a block's documents that the short lists may hold together; documents of one window.
SHORT, WINDOW = 1 / 16, 4_096

_INDEX = "doc_id array<long>, lens array<long>, term array<int>, start array<int>, doc array<int>, tf array<int>"
_TERM_BYTES = bytes(c | 0x20 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20
                    for c in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    """The terms of a UTF-8 text in order, repeats included."""
    return text.translate(_TERM_BYTES).split() if text else []


@dataclass
class Queries:
    """One chunk of queries: ``terms`` are all different terms, ``lists[i]`` the
    (term number, times) pairs of query ``i``, ``ids[i]`` what it is called."""

    terms: dict[bytes, int]
    lists: list[list[tuple[int, int]]]
    ids: list


def query_chunks(items: DataFrame, item_id: str, text: str) -> Iterator[Queries]:
    """Chunks of bounded size; the driver holds one at a time."""
    terms, lists, ids, size = {}, [], [], 0
    for name, words in items.select(item_id, F.col(text).cast("string")).toLocalIterator():
        found = Counter(terms_of((words or "").encode()))
        if found:
            lists.append([(terms.setdefault(t, len(terms)), k) for t, k in found.items()])
            ids.append(name)
            size += len(words)
        if len(lists) >= CHUNK_ITEMS or size >= CHUNK_BYTES:
            yield Queries(terms, lists, ids)
            terms, lists, ids, size = {}, [], [], 0
    if lists:
        yield Queries(terms, lists, ids)


def index_blocks(docs: DataFrame, doc_id: str, text: str, wanted: dict[bytes, int]) -> DataFrame:
    """One row a block: ids and lengths of its documents with a term, and the lists of the wanted terms."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches):
        known = shared.value
        ids, lens, posts, size = [], [], [], 0

        def block():
            found = np.array(posts, dtype=np.int64).reshape(-1, 3)
            found = found[np.argsort(found[:, 0], kind="stable")]
            term, start = np.unique(found[:, 0], return_index=True)
            start = np.append(start, len(found))
            row = [ids, lens, term.tolist(), start.tolist(), found[:, 1].tolist(), found[:, 2].tolist()]
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32()]
            return pa.RecordBatch.from_arrays([pa.array([v], pa.list_(t)) for v, t in zip(row, types, strict=True)],
                                              names=["doc_id", "lens", "term", "start", "doc", "tf"])

        for batch in batches:
            texts = batch.column(1)
            for at in range(len(texts)):
                words = terms_of(texts[at].as_py())
                if not words:
                    continue
                posts.extend((known[t], len(ids), k) for t, k in Counter(filter(known.__contains__, words)).items())
                ids.append(batch.column(0)[at].as_py())
                lens.append(len(words))
                size += len(texts[at].as_buffer())
                if len(ids) >= BLOCK_DOCS or size >= BLOCK_BYTES:
                    yield block()
                    ids, lens, posts, size = [], [], [], 0
        if ids:
            yield block()

    return docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string").cast("binary")).mapInArrow(run, _INDEX)


@dataclass
class Corpus:
    """What scores need of the whole corpus: documents, terms, and the weight of each query term."""

    docs: int
    terms: int
    weights: np.ndarray

    def impacts(self, tf: np.ndarray, length: np.ndarray) -> np.ndarray:
        m = 25 + (75 * length * self.docs) // self.terms
        return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def corpus_numbers(blocks: DataFrame, n_terms: int) -> Corpus:
    """Sums over the blocks; one row for each term of the chunk reaches the driver."""
    docs, terms = blocks.agg(F.sum(F.size("doc_id")), F.sum(F.aggregate("lens", F.lit(0).cast("long"), lambda a, x: a + x))).first()
    held = blocks.select(F.posexplode("term").alias("at", "term"), "start")
    held = held.groupBy("term").agg(F.sum(F.element_at("start", F.col("at") + 2) - F.element_at("start", F.col("at") + 1)).alias("df"))
    weights = np.zeros(n_terms, dtype=np.int64)
    for term, df in held.collect():
        weights[term] = math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))
    return Corpus(docs or 0, terms or 0, weights)


class Best:
    """The ``top`` best documents of one query so far; ``need`` is the score to reach."""

    def __init__(self, top: int):
        self.top, self.need = top, 1
        self.scores, self.ids = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        some = scores >= self.need
        if not some.any():
            return
        scores, ids = np.append(self.scores, scores[some]), np.append(self.ids, ids[some])
        best = np.lexsort((ids, -scores))[:self.top]
        self.scores, self.ids = scores[best], ids[best]
        if len(best) == self.top:
            self.need = int(self.scores[-1])


class Block:
    """One index block with the impact of every posting."""

    def __init__(self, row: dict[str, pa.Array], corpus: Corpus, short: float = SHORT, window: int = WINDOW):
        self.n, self.window = len(row["lens"]), window
        # a null id is ranked behind all others
        self.ids = row["doc_id"].fill_null(np.iinfo(np.int64).max).to_numpy()
        self.doc = row["doc"].to_numpy().astype(np.int64)
        self.impact = corpus.impacts(row["tf"].to_numpy().astype(np.int64), row["lens"].to_numpy()[self.doc])
        self.weights, self.short = corpus.weights, max(1, int(self.n * short))
        terms, start = row["term"].to_pylist(), row["start"].to_pylist()
        self.lists = {t: (a, b) for t, a, b in zip(terms, start, start[1:], strict=False)}
        most = np.maximum.reduceat(self.impact, start[:-1]).tolist() if terms else []
        self.most = dict(zip(terms, most, strict=True))

    def answer(self, query: list[tuple[int, int]], best: Best) -> int:
        """Offer the block's documents to ``best``; returns how many postings were summed or probed."""
        lists = []
        for term, times in query:
            factor = times * int(self.weights[term])
            if term in self.lists and factor > 0:
                lists.append((self.lists[term], factor, factor * self.most[term]))
        lists.sort(key=lambda x: x[0][1] - x[0][0])
        held, work, total = [], 0, 0
        while lists and total + lists[0][0][1] - lists[0][0][0] <= self.short:
            (a, b), factor, _ = lists.pop(0)
            total += b - a
            held.append((self.doc[a:b], self.impact[a:b] * factor))
        streams = [(self.doc[a:b], self.impact[a:b], factor, bound) for (a, b), factor, bound in lists]
        if held:
            docs, where = np.unique(np.concatenate([d for d, _ in held]), return_inverse=True)
            sums = np.zeros(len(docs), dtype=np.int64)
            np.add.at(sums, where, np.concatenate([s for _, s in held]))
            streams.append((docs, sums, 1, int(sums.max())))
            work += total
        streams.sort(key=lambda s: s[3])
        reach = np.cumsum([s[3] for s in streams]).tolist()
        for low in range(0, self.n, self.window):
            if not streams or reach[-1] < best.need:
                break
            probed = sum(r < best.need for r in reach)
            work += self._window(streams, reach, probed, low, low + self.window, best)
        return work

    def _window(self, streams, reach, probed, low, high, best) -> int:
        work, cut = 0, []
        for docs, scores, factor, _ in streams[probed:]:
            a, b = np.searchsorted(docs, (low, high))
            cut.append((docs[a:b] - low, scores[a:b], factor))
            work += int(b - a)
        sums = np.zeros(high - low, dtype=np.int64)
        for docs, scores, factor in cut:
            sums[docs] += scores * factor
        found = np.flatnonzero(sums)
        sums = sums[found]
        for k in range(probed - 1, -1, -1):
            able = sums + reach[k] >= best.need
            found, sums = found[able], sums[able]
            if not len(found):
                return work
            docs, scores, factor, _ = streams[k]
            at = np.minimum(np.searchsorted(docs, found + low), len(docs) - 1)
            hit = docs[at] == found + low
            sums[hit] += scores[at[hit]] * factor
            work += len(found)
        best.offer(sums, self.ids[found + low])
        return work


def search(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
           item_text: str = "text", top: int = 10) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` best documents of every item."""
    spark, out = docs.sparkSession, None
    kind = items.schema[item_id].dataType.simpleString()
    for queries in query_chunks(items, item_id, item_text):
        blocks = stored(index_blocks(docs, doc_id, text, queries.terms), "search-index")
        corpus = corpus_numbers(blocks, len(queries.terms))
        shared = spark.sparkContext.broadcast((queries.lists, corpus))

        def run(batches, shared=shared):
            lists, corpus = shared.value
            best = [Best(top) for _ in lists]
            for batch in batches:
                for at in range(batch.num_rows):
                    block = Block({name: batch.column(name)[at].values for name in batch.schema.names}, corpus)
                    for query, so_far in zip(lists, best, strict=True):
                        block.answer(query, so_far)
            item = np.repeat(np.arange(len(best)), [len(b.ids) for b in best])
            columns = [item, np.concatenate([b.ids for b in best]), np.concatenate([b.scores for b in best])]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["item", "doc_id", "score"])

        found = blocks.mapInArrow(run, "item long, doc_id long, score long")
        # ranks inside hash groups first, so that no task sees all tasks' documents of one item
        order = [F.col("score").desc(), "doc_id"]
        group = F.pmod(F.xxhash64("doc_id"), F.lit(64))
        first = found.withColumn("r", F.row_number().over(Window.partitionBy("item", group).orderBy(*order))).filter(F.col("r") <= top)
        ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= top)
        names = spark.createDataFrame(list(enumerate(queries.ids)), f"item long, item_id {kind}")
        ranked = ranked.join(F.broadcast(names), "item").select(
            "item_id", "rank", F.when(F.col("doc_id") < F.lit(2**63 - 1), F.col("doc_id")).alias("doc_id"), "score")
        out = ranked if out is None else out.unionByName(ranked)
    return out if out is not None else spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")


def op13_ranked_search(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return search(docs.select("doc_id", "text"), items.select("item_id", "text"))
