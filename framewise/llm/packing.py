"""Best-fit packing with certified bin counts.

Documents become token pieces of at most one sequence's length.  Pieces are
dealt over partitions of a fixed size; each partition packs its own by best-fit
decreasing and compares its bin count with lower bounds from dual-feasible
functions.  A partition whose count equals its share of the corpus bound is
certified: it keeps all bins but the loosest one.  A partition with a gap gives
up as many of its loosest bins as it takes to offer choice.  What was given up is dealt anew over
fewer partitions and packed again, there also bin by bin where best-fit misses
the bound, until the total equals the bound of the whole corpus or a round gains
nothing.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import WordCache, chunks, schema_of, stored

CAPACITY = 2048
#: Documents that are packed together where their order counts.
STRETCH = 4096

_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
#: ASCII marks but the apostrophe, which can begin a contraction.
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def vocabulary_path(name: str) -> str:
    """Place of a public vocabulary file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


class WordTokenizer:
    """Ids of whole texts as little-endian unsigned 32-bit bytes, equal to
    ``Tokenizer.encode(text, add_special_tokens=False).ids``.

    A tokenizer that drops white space and splits words from marks treats each
    run between blanks alone, so runs are encoded once and remembered.  Runs of
    Latin-1 letters, with marks behind them, go straight to the merge model.
    Any other tokenizer encodes the whole text.
    """

    def __init__(self, path: str):
        import json
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            parts = json.load(f)
        names = [[x["type"] for x in ((parts.get(k) or {}).get(v) or [])]
                 for k, v in (("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers"))]
        self.by_word = (names == [["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]]
                        and parts["pre_tokenizer"]["pretokenizers"][0].get("behavior") == "Removed"
                        and all(not x["normalized"] and not x["lstrip"] and not x["rstrip"]
                                for x in parts["added_tokens"]))
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        small = [chr(c) for c in range(0x61, 0x100) if chr(c).isalpha() and chr(c).islower() and _LETTERS.fullmatch(chr(c))]
        self.mapped = {ord(c): level.pre_tokenize_str(c)[0][0] for c in small}
        self.cache = WordCache(self._chunk)

    def _encode(self, text: str) -> bytes:
        return np.asarray(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _chunk(self, chunk: str) -> bytes:
        core = chunk.rstrip(_MARKS)
        if not _LETTERS.fullmatch(core):
            return self._encode(chunk)
        low = core.lower()
        if low != chunk:
            return self.cache[low] + (self.cache[chunk[len(core):]] if core != chunk else b"")
        found = self.whole.model.tokenize(low.translate(self.mapped))
        return np.asarray([t.id for t in found], "<u4").tobytes()

    def ids(self, text: str) -> bytes:
        if not self.by_word:
            return self._encode(text)
        return b"".join(map(self.cache.__getitem__, chunks(text)))


_TOKENIZERS: dict[str, WordTokenizer] = {}


def tokenizer(name: str) -> WordTokenizer:
    """One tokenizer, with its memory, per worker process and vocabulary."""
    if name not in _TOKENIZERS:
        _TOKENIZERS[name] = WordTokenizer(vocabulary_path(name))
    return _TOKENIZERS[name]


def token_pieces(docs: DataFrame, vocabulary: str = "word_bpe_49k.json", capacity: int = CAPACITY,
                 end_id: int = 0, with_ids: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per piece of a document: its ids, then ``end_id``, cut every
    ``capacity`` ids.  A null text counts as empty, so it gives one piece that
    holds ``end_id`` alone.  ``with_ids`` adds the ids themselves, ``keep``
    names columns of ``docs`` that the pieces keep."""
    rows = docs.select("doc_id", "text", *keep)
    fields = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("piece", T.IntegerType()),
                           T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                           T.StructField("ids_crc32", T.LongType())])
    if with_ids:
        fields.add("ids", T.BinaryType())
    for name in keep:
        fields.add(rows.schema[name])
    end = np.asarray([end_id], "<u4").tobytes()

    def step(batches):
        tok = tokenizer(vocabulary)
        for b in batches:
            at, piece, start, length, crc, held = [], [], [], [], [], []
            for i, text in enumerate(b.column(1).to_pylist()):
                ids = tok.ids(text or "") + end
                for k in range(0, len(ids), 4 * capacity):
                    part = ids[k:k + 4 * capacity]
                    at.append(i)
                    piece.append(k // (4 * capacity))
                    start.append(k // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        held.append(part)
            cols = [b.column(0).take(pa.array(at, pa.int32())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            kept = [b.column(2 + k).take(pa.array(at, pa.int32())) for k in range(len(keep))]
            yield pa.RecordBatch.from_arrays(cols + ([pa.array(held, pa.binary())] if with_ids else []) + kept, names=fields.names)

    return rows.mapInArrow(step, fields)


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Fewest bins for ``counts[x]`` items of size x, by dual-feasible functions:
    the plain volume, the threshold functions (sizes under a level count nothing,
    their complements count a whole bin) and the rounding functions of 2 to 32
    steps.  Integer arithmetic throughout, so the bound is exact."""
    x = np.arange(capacity + 1, dtype=np.int64)
    n = counts.astype(np.int64)
    best = -(-int((n * x).sum()) // capacity)
    volume, number = np.cumsum(n * x), np.cumsum(n)
    for level in range(1, capacity // 2 + 1):
        big = int(number[-1] - number[capacity - level])
        mid = int(volume[capacity - level] - volume[level - 1])
        best = max(best, big + -(-mid // capacity))
    for k in range(1, 32):
        t = (k + 1) * x
        scaled = np.where(t % capacity == 0, k * x, t // capacity * capacity)
        best = max(best, -(-int((n * scaled).sum()) // (k * capacity)))
    return best


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit for items in the given (falling) order: bin and place of each
    item, and the free space of each bin."""
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0  # bit r: some bin has r free
    free: list[int] = []
    bins, places = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i, size in enumerate(lengths.tolist()):
        fits = mask >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = stacks[room].pop()
            if not stacks[room]:
                mask ^= 1 << room
        else:
            room, b = capacity, len(free)
            free.append(capacity)
        bins[i], places[i] = b, capacity - room
        left = room - size
        free[b] = left
        if left:
            stacks[left].append(b)
            mask |= 1 << left
    return bins, places, np.asarray(free, np.int64)


def fill_up(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Like :func:`best_fit`, bin by bin: the largest item left, with the left
    items that come nearest to filling the rest.  Sums that can be reached are
    bits of one integer, and the search ends when the rest can be filled."""
    left: dict[int, list[int]] = {}
    for i, size in enumerate(lengths.tolist()):
        left.setdefault(size, []).append(i)
    sizes = sorted(left, reverse=True)
    bins, places, free = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), []
    while sizes:
        rest = capacity - sizes[0]
        within, reach, steps = (1 << (rest + 1)) - 1, 1, []
        for d in sizes:
            n = min(len(left[d]) - (d == sizes[0]), rest // d)
            take = 1
            while n > 0 and not reach >> rest & 1:
                take = min(take, n)
                steps.append((d, take, reach))
                reach |= reach << (d * take) & within
                n -= take
                take *= 2
            if reach >> rest & 1:
                break
        total = reach.bit_length() - 1
        chosen = [(sizes[0], 1)]
        for d, n, before in reversed(steps):
            if not before >> total & 1:
                chosen.append((d, n))
                total -= d * n
        at = 0
        for d, n in chosen:
            for _ in range(n):
                i = left[d].pop()
                bins[i], places[i] = len(free), at
                at += d
        free.append(capacity - at)
        if any(not left[d] for d, _ in chosen):
            sizes = [d for d in sizes if left[d]]
    return bins, places, np.asarray(free, np.int64)


def _pack_round(pieces: DataFrame, turn: int, parts: int, capacity: int, share: float) -> DataFrame:
    """Deal the pieces over ``parts`` partitions, pack each, mark what it gives up.

    ``share`` is the corpus bound per id.  A partition whose bins are no more
    than its ids' share is as good as the corpus can be; one whose own bound is
    higher drew too many large pieces, and only an exchange can mend that.
    """
    schema = T.StructType([f for f in pieces.schema.fields if f.name not in ("sequence_id", "offset", "open")]
                          + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()),
                             T.StructField("open", T.BooleanType())])
    plain = [f.name for f in schema.fields[:-3]]

    def deal(batches):
        """Each batch goes round the partitions in order of size, so that all
        of them see the same mix of large and small pieces."""
        task = TaskContext.get().partitionId()
        for k, b in enumerate(batches):
            part = np.empty(b.num_rows, np.int64)
            start = int(np.random.default_rng([turn, task, k]).integers(parts))
            part[np.argsort(b.column("length").to_numpy(), kind="stable")] = (start + np.arange(b.num_rows)) % parts
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(part)], names=[*b.schema.names, "__part"])

    dealt = pieces.select(*plain)
    dealt = dealt.mapInArrow(deal, schema_of(dealt, [("__part", T.LongType())]))

    def pack(key, rows):
        rows = rows.drop(columns="__part").sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
        size = rows["length"].to_numpy()
        bins, places, free = best_fit(size, capacity)
        bound = lower_bound(np.bincount(size, minlength=capacity + 1), capacity)
        if turn and len(free) > bound:  # what other partitions gave up fits badly as it is
            other = fill_up(size, capacity)
            if len(other[2]) < len(free):
                bins, places, free = other
        gap = len(free) - math.ceil(size.sum() * share - 1e-9)
        give = min(len(free), 1 if gap <= 0 else 64 + 32 * gap)
        loose = np.zeros(len(free), bool)
        loose[np.argsort(-free, kind="stable")[:give]] = True
        rows["sequence_id"] = bins + (key[0] << 24) + (turn << 52)
        rows["offset"] = places
        rows["open"] = loose[bins] & (free[bins] > 0)
        return rows[schema.names]

    return dealt.groupBy("__part").applyInPandas(pack, schema)


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, part_rows: int = 60_000, rounds: int = 12) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces of ``length`` 1 to ``capacity``.

    Pieces that fill a sequence are one at once.  ``pieces`` is read more than
    once: pass a stored table.  ``rounds`` bounds the exchanges; a packing that
    misses its bound after them is still whole.  An empty table gives an empty
    one; repeated rows are packed as often as they occur.
    """
    full = pieces.filter(F.col("length") == capacity).withColumns(
        {"sequence_id": F.monotonically_increasing_id() + F.lit(1 << 60), "offset": F.lit(0).cast("long")})
    rest = pieces.filter(F.col("length") < capacity)
    sizes = rest.groupBy("length").count().collect()  # at most ``capacity`` rows
    counts = np.zeros(capacity + 1, np.int64)
    for r in sizes:
        counts[r["length"]] = r["count"]
    n, bound = int(counts.sum()), lower_bound(counts, capacity)
    done, settled, held = full, 0, None
    share = bound / max(1, int((counts * np.arange(capacity + 1)).sum()))
    for turn in range(rounds):
        # what misses the bound in small company may reach it in larger
        parts = max(1, math.ceil(n / (part_rows << min(turn, 3))))
        packed = stored(_pack_round(rest, turn, parts, capacity, share), f"packed-{turn}")
        s = packed.agg(F.count_distinct(F.when(~F.col("open"), F.col("sequence_id"))).alias("kept"),
                       F.count_distinct(F.when(F.col("open"), F.col("sequence_id"))).alias("open"),
                       F.count_if("open").alias("n")).first()
        total = settled + s["kept"] + s["open"]
        last = total <= bound or turn + 1 == rounds or s["open"] == 0 or (parts == 1 and held is not None and s["open"] >= held)
        if last:
            return done.unionByName(packed.drop("open"))
        done = done.unionByName(packed.filter(~F.col("open")).drop("open"))
        rest, n, settled, held = packed.filter("open").drop("sequence_id", "offset", "open"), s["n"], settled + s["kept"], s["open"]
    return done


def assemble(pieces: DataFrame) -> DataFrame:
    """The sequences themselves, from packed pieces with ``ids``: one row per
    sequence, at most its capacity of ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id").agg(F.aggregate(parts, F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"))


def pack_documents(docs: DataFrame, vocabulary: str = "word_bpe_49k.json", capacity: int = CAPACITY) -> DataFrame:
    """All documents as packed pieces: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack_pieces(stored(token_pieces(docs, vocabulary, capacity), "pieces"), capacity)


def as_written(docs: DataFrame) -> DataFrame:
    """doc_id, text and the place of each row: ``__file`` and ``__row``.  Rows of
    stored tables have the order of their part files, whatever order Spark scans
    them in; other rows have the order of their partitions."""
    try:
        meta = docs.metadataColumn("_metadata")
        return docs.select("doc_id", "text", meta["file_path"].alias("__file"), meta["row_index"].alias("__row"))
    except AnalysisException:  # not a stored table
        place = F.monotonically_increasing_id()
        file = F.lpad(F.shiftright(place, 33).cast("string"), 10, "0")
        return docs.select("doc_id", "text", file.alias("__file"), place.bitwiseAND(F.lit((1 << 33) - 1)).alias("__row"))


def pack_in_order(docs: DataFrame, vocabulary: str = "word_bpe_49k.json", capacity: int = CAPACITY, stretch: int | None = None) -> DataFrame:
    """Like :func:`pack_documents`, but rising ``sequence_id`` follows the order of
    ``docs``: each ``stretch`` of documents is packed by itself, and its sequences
    are numbered by the mean place of their documents.

    Nothing is exchanged between stretches, so each can have one sequence more than
    its share of the corpus bound (and what best-fit and filling bin by bin miss).
    """
    stretch = stretch or STRETCH
    pieces = stored(token_pieces(as_written(docs), vocabulary, capacity, keep=("__file", "__row")), "pieces")
    files = pieces.groupBy("__file").agg((F.max("__row") + 1).alias("__n"))  # one row per file
    before = Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select(F.col("__file").alias("__f"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    placed = pieces.join(F.broadcast(files), F.col("__file") == F.col("__f")).withColumn("__place", F.col("__before") + F.col("__row"))
    placed = placed.drop("__file", "__row", "__f", "__before").withColumn("__part", F.expr(f"__place div {stretch}"))
    schema = T.StructType([f for f in placed.schema.fields if f.name not in ("__place", "__part")]
                          + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def pack(key, rows):
        rows = rows.sort_values(["length", "__place", "piece"], ascending=[False, True, True], kind="stable")
        size, place = rows["length"].to_numpy(), rows["__place"].to_numpy()
        bins, places, free = best_fit(size, capacity)
        if len(free) > lower_bound(np.bincount(size, minlength=capacity + 1), capacity):
            other = fill_up(size, capacity)
            if len(other[2]) < len(free):
                bins, places, free = other
        mean = np.bincount(bins, place - key[0] * stretch) / np.bincount(bins)
        number = np.empty(len(free), np.int64)
        number[np.argsort(mean, kind="stable")] = np.arange(len(free))
        rows["sequence_id"] = number[bins] + (key[0] << 24)
        rows["offset"] = places
        return rows[schema.names]

    return placed.groupBy("__part").applyInPandas(pack, schema)
