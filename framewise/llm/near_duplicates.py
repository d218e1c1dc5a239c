"""N-gram Jaccard join by T-occurrence search.

A document is the set of its word shingles.  Two documents link when their sets
overlap enough; the result is the connected components of the links.

1.  Inverted lists.  Documents are shingled in chunks; every chunk sends its
    shingles to ranges of the shingle space, and each range answers with those
    that several documents hold, and how many do.  A shingle that is frequent
    inside a chunk is sent once, with its count.
2.  A document needs four fifths of its shingles shared to link at all.  Those
    that have them keep their shared shingles, rarest first; documents with equal
    sets are one class from here on.
3.  Classes that share a shingle among their first ``shared - needed + 1`` can
    link.  The components of that relation are blocks; those with many classes
    or many shingles are cut.
4.  In a block the T-occurrence search runs on inverted lists (DivideSkip): the
    short lists are merged, the long ones only probed for the candidates that the
    short ones leave, and exact overlaps decide.  A class that already belongs
    with another one is not searched against it again, so a group of copies costs
    one search and not all its pairs.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import WordCache, free_name, stored
from .graph import connected_components

SHINGLE = 5
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 80
TOKEN_BITS = 48
ALL = 0xFFFF  # in place of a document's index: every document of the chunk's own list

_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _word_hash(word: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(word)


class Shingler:
    """Sorted distinct 64-bit shingle hashes of whole texts."""

    def __init__(self):
        self.words = WordCache(_word_hash)

    def shingles(self, text: str | None) -> np.ndarray:
        """A-Z lower-cased, words between ASCII white space; a text with fewer
        than SHINGLE words is one shingle, a text without words none."""
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        n = len(words)
        if not n:
            return np.zeros(0, np.uint64)
        w = np.fromiter(map(self.words.__getitem__, words), np.uint64, n)
        if n < SHINGLE:
            return _mixed((w * _FACTORS[:n]).sum(keepdims=True, dtype=np.uint64) + np.uint64(n))
        m = n - SHINGLE + 1
        h = w[:m] * _FACTORS[0]
        for k in range(1, SHINGLE):
            h += w[k:k + m] * _FACTORS[k]
        return np.unique(_mixed(h))


def needed(n):
    """Fewest shared shingles with which a set of ``n`` can link at all."""
    return -(-n * PERCENT // 100)


def _post(docs: DataFrame, ranges: int, chunk_tokens: int, hot: int) -> DataFrame:
    """Chunks of documents as rows for the ranges, and one row per chunk about its documents."""
    shift = np.uint64(TOKEN_BITS - ranges.bit_length() + 1)
    schema = T.StructType([T.StructField("to", T.IntegerType()), T.StructField("chunk", T.LongType())]
                          + [T.StructField(n, T.BinaryType()) for n in ("low", "high", "at", "count")]
                          + [T.StructField(n, T.ArrayType(T.LongType())) for n in ("ids", "hashes")])

    def flush(chunk, ids, hashes, sets):
        """Rows of one chunk.  Documents with one set are posted once."""
        sizes = np.array([len(s) for s in sets], np.int64)
        marks = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
        first: dict[bytes, int] = {}
        own = [i for i, m in enumerate(marks) if len(sets[i]) and first.setdefault(m, i) == i]
        tokens = np.concatenate([sets[i] for i in own] or [np.zeros(0, np.uint64)]) >> np.uint64(64 - TOKEN_BITS)
        at = np.repeat(np.array(own, np.uint16), sizes[own]) if own else np.zeros(0, np.uint16)
        order = np.argsort(tokens, kind="stable")
        tokens, at = tokens[order], at[order]
        new = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]])) if len(tokens) else np.zeros(0, np.int64)
        counts = np.diff(np.append(new, len(tokens)))
        many = np.repeat(counts > hot, counts) if len(tokens) else np.zeros(0, bool)
        rows = [(-1 - chunk % ranges, chunk, tokens[many].tobytes(), sizes.tobytes(), at[many].tobytes(), b"".join(marks), ids, hashes)]
        once = new[counts > hot]
        sent = np.concatenate([tokens[~many], tokens[once]])
        who = np.concatenate([at[~many], np.full(len(once), ALL, np.uint16)])
        n = np.concatenate([np.ones((~many).sum(), np.uint32), counts[counts > hot].astype(np.uint32)])
        order = np.argsort(sent, kind="stable")
        sent, who, n = sent[order], who[order], n[order]
        cuts = np.searchsorted(sent, np.arange(ranges + 1, dtype=np.uint64) << shift)
        low, high = (sent & np.uint64(0xFFFFFFFF)).astype(np.uint32), (sent >> np.uint64(32) & np.uint64(0xFF)).astype(np.uint8)
        for r in np.flatnonzero(np.diff(cuts)):
            a, b = cuts[r], cuts[r + 1]
            rows.append((int(r), chunk, low[a:b].tobytes(), high[a:b].tobytes(), who[a:b].tobytes(), n[a:b][who[a:b] == ALL].tobytes(), None, None))
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], t) for i, t in enumerate(
            [pa.int32(), pa.int64(), *[pa.binary()] * 4, *[pa.list_(pa.int64())] * 2])], names=schema.names)

    def step(batches):
        shingler, number = Shingler(), 0
        base = TaskContext.get().partitionId() << 24
        ids, hashes, sets, held = [], [], [], 0
        for b in batches:
            for i, text, h in zip(*(c.to_pylist() for c in b.columns), strict=True):
                s = shingler.shingles(text)
                ids.append(i)
                hashes.append(h)
                sets.append(s)
                held += len(s)
                if held >= chunk_tokens or len(ids) >= ALL:
                    yield flush(base + number, ids, hashes, sets)
                    ids, hashes, sets, held, number = [], [], [], 0, number + 1
        if ids:
            yield flush(base + number, ids, hashes, sets)

    return docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text")).mapInArrow(step, schema)


def _answer(posted: DataFrame, ranges: int) -> DataFrame:
    """For each range, tell every chunk which of its shingles several documents
    hold: level (log2 of the number of documents) and shingle, and by whom."""
    shift = TOKEN_BITS - ranges.bit_length() + 1
    schema = "chunk long, shared binary, at binary, hot binary, sizes binary, marks binary, ids array<long>, hashes array<long>"

    def answer(key, rows):
        if key[0] < 0:  # about documents: on to the chunk
            return pd.DataFrame({"chunk": rows["chunk"], "shared": None, "at": rows["at"], "hot": rows["low"], "sizes": rows["high"],
                                 "marks": rows["count"], "ids": rows["ids"], "hashes": rows["hashes"]})
        part = [np.frombuffer(b, np.uint32) for b in rows["low"]]
        chunk = np.repeat(np.arange(len(part)), [len(p) for p in part])
        top = np.concatenate([np.frombuffer(b, np.uint8) for b in rows["high"]]).astype(np.uint64) << np.uint64(32)
        # the range number holds the highest bits; 40 below them are sent
        token = np.concatenate(part).astype(np.uint64) | top | (np.uint64(key[0]) << np.uint64(shift) >> np.uint64(40) << np.uint64(40))
        at = np.concatenate([np.frombuffer(b, np.uint16) for b in rows["at"]])
        n = np.ones(len(token), np.int64)
        n[at == ALL] = np.concatenate([np.frombuffer(b, np.uint32) for b in rows["count"]])
        order = np.argsort(token, kind="stable")
        token, at, n, chunk = token[order], at[order], n[order], chunk[order]
        new = np.concatenate([[True], token[1:] != token[:-1]])
        total = np.add.reduceat(n, np.flatnonzero(new))[np.cumsum(new) - 1]
        keep = total > 1
        shared = token[keep] | (np.log2(total[keep]).astype(np.uint64) << np.uint64(TOKEN_BITS))
        at, chunk = at[keep], chunk[keep]
        order = np.argsort(chunk, kind="stable")
        shared, at, chunk = shared[order], at[order], chunk[order]
        ends = np.searchsorted(chunk, np.arange(len(part) + 1))
        made = [(int(c), shared[a:b].tobytes(), at[a:b].tobytes()) for c, a, b in zip(rows["chunk"], ends[:-1], ends[1:], strict=True) if b > a]
        out = pd.DataFrame(made, columns=["chunk", "shared", "at"])
        for c in ("hot", "sizes", "marks", "ids", "hashes"):
            out[c] = None
        return out

    return posted.groupBy("to").applyInPandas(answer, schema)


def _documents(answers: DataFrame) -> DataFrame:
    """One row per document: its set's size and mark, and, where enough of them
    are shared, its shared shingles, rarest first."""

    def gather(key, rows):
        about = rows[rows["sizes"].notna()].iloc[0]
        sizes = np.frombuffer(about["sizes"], np.int64)
        got = rows[rows["shared"].notna()]
        shared = np.concatenate([np.frombuffer(b, np.uint64) for b in got["shared"]] or [np.zeros(0, np.uint64)])
        at = np.concatenate([np.frombuffer(b, np.uint16) for b in got["at"]] or [np.zeros(0, np.uint16)])
        # shingles sent once for all their documents here
        once = at == ALL
        tokens = np.uint64((1 << TOKEN_BITS) - 1)
        table = np.sort(shared[once] & tokens)
        levels = shared[once][np.argsort(shared[once] & tokens, kind="stable")]
        hot = np.frombuffer(about["hot"], np.uint64)
        hot = levels[np.searchsorted(table, hot)] if len(hot) else hot
        shared = np.concatenate([shared[~once], hot])
        at = np.concatenate([at[~once], np.frombuffer(about["at"], np.uint16)])
        order = np.lexsort((shared, at))
        shared, ends = shared[order], np.searchsorted(at[order], np.arange(len(sizes) + 1))
        kept = [shared[a:b].tobytes() if n and b - a >= needed(n) else None
                for n, a, b in zip(sizes.tolist(), ends[:-1], ends[1:], strict=True)]
        marks = [about["marks"][16 * i:16 * i + 16] for i in range(len(sizes))]
        return pd.DataFrame({"row": key[0] * (ALL + 1) + np.arange(len(sizes)), "doc_id": pd.array(list(about["ids"]), dtype="Int64"),
                             "text_hash": list(about["hashes"]), "n": sizes, "mark": marks, "shared": kept})

    return answers.groupBy("chunk").applyInPandas(gather, "row long, doc_id long, text_hash long, n long, mark binary, shared binary")


def divide_skip(query: np.ndarray, n: int, lists: dict[int, np.ndarray], sizes: np.ndarray, allowed: np.ndarray) -> np.ndarray:
    """Members whose sets link with the query's.

    ``lists`` maps a shingle to its members in rising order, ``sizes`` has each
    member's set size, ``allowed`` marks the members asked about.  The T needed
    at least is ``needed(n)``; L long lists are left out of the merge, whose
    candidates then have T - L or more in the short ones.
    """
    own = [m for m in (lists.get(t) for t in query.tolist()) if m is not None]
    t = needed(n)
    if len(own) < t:
        return np.zeros(0, np.int64)
    own.sort(key=len)
    skip = min(int(t / (0.01 * np.log2(max(len(own[-1]), 2)) + 1)), t - 1)
    short, long = own[:len(own) - skip], own[len(own) - skip:]
    found, count = np.unique(np.concatenate(short), return_counts=True)
    ok = (count >= t - skip) & allowed[found] & (sizes[found] >= t) & (needed(sizes[found]) <= n)
    found, count = found[ok], count[ok]
    for k, m in enumerate(long):
        if not len(found):
            break
        place = np.minimum(np.searchsorted(m, found), len(m) - 1)
        count = count + (m[place] == found)
        if k % 64 == 63:  # who cannot reach T any more goes
            ok = count + len(long) - k - 1 >= t
            found, count = found[ok], count[ok]
    return found[100 * count >= PERCENT * (n + sizes[found] - count)]


def search_block(cls: np.ndarray, sizes: np.ndarray, sets: list[np.ndarray], comp: np.ndarray, asked: np.ndarray | None) -> list[tuple[int, int]]:
    """Edges that join all linked classes of a block.

    ``comp`` has known components.  ``asked`` marks the classes to search for;
    None means all pairs count, and then members of the largest component need no
    search of their own, as every other class is searched against them.
    """
    tokens = np.concatenate(sets)
    member = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.lexsort((member, tokens))
    tokens, member = tokens[order], member[order]
    new = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
    ends = np.append(new[1:], len(tokens))
    wide = ends - new > 1
    lists = {t: member[a:b] for t, a, b in zip(tokens[new[wide]].tolist(), new[wide].tolist(), ends[wide].tolist(), strict=True)}
    _, comp = np.unique(comp, return_inverse=True)
    edges: list[tuple[int, int]] = []
    todo = np.ones(len(sets), bool) if asked is None else asked.copy()
    while True:
        rest = todo & (comp != np.bincount(comp).argmax()) if asked is None else todo
        if not rest.any():
            return edges
        q = int(np.flatnonzero(rest)[0])
        todo[q] = False
        for x in divide_skip(sets[q], int(sizes[q]), lists, sizes, comp != comp[q]):
            if comp[x] != comp[q]:
                edges.append((int(cls[q]), int(cls[x])))
                comp[comp == comp[x]] = comp[q]


def _search(blocks: DataFrame) -> DataFrame:
    """Edges found in each block (label, cut, query); rows: cls, n, shared, comp, asked (null: all of the block)."""

    def run(key, rows):
        # a class that asks in its own cut is there twice: the asking row stays
        rows = rows.sort_values(["asked", "n", "cls"], ascending=[False, True, True], kind="stable").drop_duplicates("cls")
        asked = None if rows["asked"].isna().all() else rows["asked"].to_numpy().astype(bool)
        edges = search_block(rows["cls"].to_numpy(), rows["n"].to_numpy(), [np.frombuffer(b, np.uint64) for b in rows["shared"]],
                             rows["comp"].to_numpy(), asked)
        return pd.DataFrame(edges, columns=["a", "b"], dtype="int64")

    return blocks.groupBy("label", "cut", "query").applyInPandas(run, "a long, b long")


def _prefixes(classes: DataFrame) -> DataFrame:
    """One row per class and shingle among its first shared - needed + 1."""

    def step(batches):
        for b in batches:
            sets = [np.frombuffer(s, np.uint64) for s in b.column("shared").to_pylist()]
            n = b.column("n").to_numpy()
            first = [s[:len(s) - int(needed(k)) + 1] for s, k in zip(sets, n, strict=True)]
            cls = np.repeat(b.column("cls").to_numpy(), [len(f) for f in first])
            tokens = np.concatenate(first or [np.zeros(0, np.uint64)]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(cls), pa.array(tokens)], names=["cls", "token"])

    return classes.select("cls", "n", "shared").mapInArrow(step, "cls long, token long")


def _links(sets: DataFrame, classes: DataFrame, block_rows: int, block_tokens: int) -> DataFrame:
    """Edges that connect all linked classes.  ``sets`` has the shared shingles of
    every row, ``classes`` the rows (``cls``) that stand for a class.  The sets
    themselves move once, to their blocks; all before that is narrow."""
    spark = sets.sparkSession
    prefix = stored(_prefixes(sets).join(classes, "cls", "left_semi"), "prefix")
    lead = prefix.groupBy("token").agg(F.min("cls").alias("lead"), F.count(F.lit(1)).alias("k")).filter("k > 1")
    meet = stored(prefix.join(lead, "token").filter("cls <> lead").select(F.col("cls").alias("a"), F.col("lead").alias("b")).distinct(), "meet")
    groups = connected_components(meet)
    width = sets.select("cls", (F.octet_length("shared") / 8).alias("width"))
    size = groups.join(width, F.col("v") == F.col("cls")).groupBy("label").agg(F.count(F.lit(1)).alias("size"), F.sum("width").alias("width"))
    cuts = F.greatest(F.ceil(F.col("size") / block_rows), F.ceil(F.col("width") / block_tokens)).cast("long")
    places = groups.join(size, "label").select(F.col("v").alias("cls"), "label", F.pmod(F.xxhash64("v"), cuts).alias("cut"), cuts.alias("cuts"))
    places = stored(places, "places")
    placed = sets.join(places, "cls")
    none = F.lit(None).cast("boolean")
    edges = stored(_search(placed.select("label", "cut", F.lit(0).alias("query"), "cls", "n", "shared", F.col("cls").alias("comp"), none.alias("asked"))), "links")
    if not places.filter("cuts > 1").limit(1).count():
        return edges
    big = placed.filter("cuts > 1")
    # components within the cuts; then each cut's largest one asks all other cuts, then everything outside the largest of all
    for turn in range(2):
        comp = connected_components(edges) if edges.limit(1).count() else spark.createDataFrame([], "v long, label long")
        known = big.join(comp.select("v", F.col("label").alias("c")), big["cls"] == F.col("v"), "left").withColumn("comp", F.coalesce("c", "cls")).drop("v", "c")
        known = stored(known, "known")
        if turn == 0:
            sizes = known.groupBy("label", "cut", "comp").agg(F.count(F.lit(1)).alias("k"), F.min("cls").alias("cls"))
            ask = sizes.groupBy("label", "cut").agg(F.max_by("cls", F.struct("k", "cls")).alias("cls"))
            ask = known.join(ask.select("cls"), "cls", "left_semi")
        else:
            sizes = known.groupBy("label", "comp").agg(F.count(F.lit(1)).alias("k"))
            top = sizes.groupBy("label").agg(F.max_by("comp", F.struct("k", "comp")).alias("top"))
            ask = known.join(top.select(F.col("label").alias("l"), "top"), F.col("label") == F.col("l")).filter("comp <> top").drop("l", "top")
        ask = ask.withColumn("query", F.pmod(F.xxhash64("cls", F.lit(turn)), F.col("cuts")).cast("int")).withColumn("asked", F.lit(True))
        sent = ask.withColumn("cut", F.explode(F.expr("sequence(0, cuts - 1)")))
        pairs = sent.select("label", "cut", "query").distinct()
        held = known.withColumn("asked", F.lit(False)).join(pairs, ["label", "cut"])
        cols = ["label", "cut", "query", "cls", "n", "shared", "comp", "asked"]
        edges = stored(edges.union(_search(sent.select(*cols).union(held.select(*cols)))), "links")
    return edges


def jaccard_components(docs: DataFrame, chunk_tokens: int = 1_000_000, block_rows: int = 2000,
                       block_tokens: int = 4_000_000, hot: int = 16) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` for every row of ``docs``
    (columns doc_id, text), and the row's ``text_hash`` (xxhash64) and ``group``,
    which is equal for the rows of one component and null for texts without words.

    component_id is the smallest doc_id that links reach, the row's own included;
    null ids count last.  Null texts and texts without words link with nothing.
    Rows with equal sets are in one component, repeated rows among them; an empty
    table gives an empty one.  Shingles are 64-bit hashes; overlaps are counted on
    48 of their bits.
    """
    spark = docs.sparkSession
    ranges = 256
    while ranges < int(spark.conf.get("spark.sql.shuffle.partitions")):
        ranges *= 2
    rows = stored(_documents(_answer(_post(docs, ranges, chunk_tokens, hot), ranges)), "shingled")
    classes = rows.filter("n > 0").groupBy("mark").agg(F.min("doc_id").alias("least"), F.min(F.when(F.col("shared").isNotNull(), F.col("row"))).alias("cls"))
    classes = stored(classes, "classes")
    sets = rows.filter("shared is not null").select(F.col("row").alias("cls"), "n", "shared")
    edges = _links(sets, classes.filter("cls is not null").select("cls"), block_rows, block_tokens)
    labels = connected_components(edges)
    linked = classes.join(labels, F.col("cls") == F.col("v"))
    least = linked.groupBy(F.col("label").alias("l")).agg(F.min("least").alias("low"))
    merged = stored(linked.join(least, F.col("label") == F.col("l")).select(F.col("mark").alias("m"), "low", F.concat(F.lit("component of class "), F.col("l")).cast("binary").alias("g")), "merged")
    classes = classes.join(merged, F.col("mark") == F.col("m"), "left")
    classes = classes.select(F.col("mark").alias("k"), F.coalesce("low", "least").alias("low"), F.coalesce("g", "mark").alias("group"))
    out = rows.join(classes, (F.col("mark") == F.col("k")) & (F.col("n") > 0), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("low", "doc_id").alias("component_id"), "text_hash", "group")


def one_of_each_group(docs: DataFrame, **params) -> DataFrame:
    """The rows of ``docs`` without all but one of every component.

    The row with the smallest doc_id stays (null ids last), then the smallest
    text hash; of repeated rows with that id and text the one whose other columns
    sort first.  Texts without words all stay.
    """
    found = stored(jaccard_components(docs, **params).select("doc_id", "text_hash", "group").filter("group is not null"), "components")
    key = F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", "text_hash")
    best = found.groupBy("group").agg(F.min(key).alias("b"), F.count(F.lit(1)).alias("k")).filter("k > 1")
    tied = found.join(best.withColumnRenamed("group", "g"), F.col("group") == F.col("g"))
    same = F.col("doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("text_hash") == F.col("b.text_hash"))
    lost = tied.filter(~same).select(F.col("doc_id").alias("__i"), F.col("text_hash").alias("__h")).distinct()
    twice = tied.filter(same).groupBy(F.col("doc_id").alias("__i"), F.col("text_hash").alias("__h")).count().filter("count > 1").drop("count")

    def on(other):
        return docs["doc_id"].cast("long").eqNullSafe(other["__i"]) & (F.xxhash64(docs["text"]) == other["__h"])

    kept = docs.join(lost, on(lost), "left_anti")
    twice = stored(twice, "repeated")
    if not twice.limit(1).count():
        return kept
    rest = [F.col(c) for c in docs.columns if c not in ("doc_id", "text")]
    again = kept.join(twice, on(twice), "left_semi")
    place = free_name(docs, "place")
    again = again.withColumn(place, F.row_number().over(Window.partitionBy("doc_id", F.xxhash64("text")).orderBy(*rest, "doc_id")))
    return kept.join(twice, on(twice), "left_anti").union(again.filter(F.col(place) == 1).drop(place))


def op5_jaccard(docs: DataFrame) -> DataFrame:
    return jaccard_components(docs.select("doc_id", "text")).select("doc_id", "n_shingles", "component_id")
