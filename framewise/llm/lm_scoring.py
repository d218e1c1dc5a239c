"""Language-model scoring: logistic mixing of hashed-context bit predictors.

A text is its words (runs without blanks, A-Z lower-cased) and one end.  Every token is
spelled in bits: its bytes and a closing blank.  Each bit is predicted by several
contexts inside the token: the whole spelling so far, and the last 1, 2, 3 and 5
bytes.  A context's two counts give a log-odds input; the inputs are added up
with weights that are chosen by a gate (how often the spelling so far and the
last three bytes were seen), squashed, and refined by an adaptive table of what
followed similar predictions.  Through a document the tokens' probabilities
adapt to what it held before: the next token is the mixer's with weight ``ADAPT`` and one of the
document's own earlier tokens with weight one each.  That probability in turn stands with weight ``ORDER``
beside what followed the token before in the training documents, the document itself left out.
Log probability and total bits per byte are given.

How it is spread:

* ``token_blocks`` reads the documents once: stretches of about ``BLOCK_BYTES``
  become one dictionary of different tokens each, and documents become token numbers in the order of the text.
  A block hands on its different pairs of neighbours, hashed (40 bits) and cut into ``BUCKETS``.
* ``pair_sums`` adds up a bucket's pairs over all blocks and answers each block in the order that it asked in.
* ``token_counts`` sums the training counts of every token of the corpus: an exact table
  that grows with the corpus.
* ``context_tables`` counts the short contexts over all training tokens: hashed tables
  of a fixed size (``TABLE_BITS``), so small enough to broadcast.
* ``spelled_ranges`` sorts all tokens into ranges.  The counts of a spelling so far are sums over
  neighbours in that order, exact for the whole corpus without a table: spellings
  that run across a range's ends get the sums of all ranges.
* ``fit_mixer`` is the online pass: each range predicts its training
  tokens, all of them, every occurrence from the counts without itself, and steps the weights along each minibatch's
  gradient while the refinement counts what followed.  All ranges start alike; their
  weights are averaged by the bits behind them, their refinement counts added.
* ``spell`` evaluates each different token once, whatever the number of its places; the
  bits go back to the blocks, whose documents add them up, and ``order_gain`` takes off what the word before tells.

Only the spelling's first ``PATH`` bytes have the whole-spelling context; later bytes of a
longer token are predicted by the others.  Nothing is left out.

Defined results: a null text is an empty one: one token, the end.  Rows are scored each for
themselves, repeated ones alike.  A null doc_id counts as training.  Without training
documents every bit has probability one half.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib
from array import array
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import crc_mod, stored

BLOCK_BYTES = 16 << 20
#: Bytes of a token with the whole-spelling context, context lengths, slots of each context's table.
PATH, ORDERS, TABLE_BITS = 20, (1, 2, 3, 5), 18
#: Tokens of one minibatch and of one range.
BATCH, RANGE = 1024, 50_000
#: Step, pseudo-count of a context's input, and of a refinement cell.
RATE, DELTA, PRIOR = 0.05, 0.15, 30.0
INPUTS = len(ORDERS) + 2
GATES, CELLS, ROWS = 12 * 4, 33, 4 * 8
#: Weight of the mixer's prediction beside a document's own earlier tokens, and of both beside what followed the token before.
ADAPT, ORDER = 1000.0, 8.0
#: Shares of the pairs of neighbours (a byte names one), and tokens whose gain is computed at once.
BUCKETS, CHUNK = 256, 1 << 18
END = b"\n "

_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)


@dataclass
class Mixer:
    """Weights of each gate, and the refinement's counts of zeros and ones (row of gate and bit, cell)."""

    weights: np.ndarray
    seen: np.ndarray

    @staticmethod
    def fresh() -> Mixer:
        weights = np.full((INPUTS, GATES), 0.2)
        weights[-1] = 0.0
        return Mixer(weights, np.zeros((ROWS, CELLS, 2)))

    def cells(self) -> np.ndarray:
        """Refined probability of a one in every cell; a cell starts at its own prediction."""
        start = 1 / (1 + np.exp(-np.linspace(-8, 8, CELLS)))
        return (self.seen[:, :, 1] + PRIOR * start) / (self.seen.sum(2) + PRIOR)


class Spelled:
    """Tokens as one run of bytes with the hashes of every byte's contexts."""

    def __init__(self, tokens: list[bytes]):
        self.lens = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
        self.starts = np.cumsum(self.lens) - self.lens
        self.bytes = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.token = np.repeat(np.arange(len(tokens)), self.lens)
        self.place = np.arange(len(self.bytes)) - self.starts[self.token]

    def contexts(self) -> list[np.ndarray]:
        """For each of ``ORDERS`` the hash of that many bytes before every byte, none of them before the token."""
        out, run = [], np.zeros(len(self.bytes), dtype=np.uint64)
        for back in range(1, max(ORDERS) + 1):
            byte = np.zeros(len(self.bytes), dtype=np.uint64)
            byte[back:] = self.bytes[:-back].astype(np.uint64) + np.uint64(1)
            byte[self.place < back] = 0
            run = (run + byte) * _STEP
            run ^= run >> np.uint64(29)
            if back in ORDERS:
                out.append(run.copy())
        return out

    def bits(self):
        """For each of a byte's bits, the highest first: (the bit, the bits before it behind a one)."""
        wide = self.bytes.astype(np.int64)
        for k in range(8):
            yield (wide >> (7 - k)) & 1, (1 << k) | (wide >> (8 - k))

    def per_token(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, self.starts) if len(self.starts) else np.zeros(0)


def slots(context: np.ndarray, node: np.ndarray) -> np.ndarray:
    return ((context + node.astype(np.uint64) * _MIX) * _MIX >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def log_odds(zero: np.ndarray, one: np.ndarray) -> np.ndarray:
    return np.log(one + np.float32(DELTA)) - np.log(zero + np.float32(DELTA))


@dataclass
class Predictions:
    """Many bits number ``k`` of their bytes: log-odds inputs, gate, and the mixed log-odds of a one."""

    inputs: list[np.ndarray]
    gate: np.ndarray
    coarse: np.ndarray
    mixed: np.ndarray

    @staticmethod
    def of(weights: np.ndarray, inputs: list[np.ndarray], spelling: np.ndarray, third: np.ndarray) -> Predictions:
        """``inputs`` are the log odds of the whole spelling and of each of ``ORDERS``; how often
        the spelling and the last three bytes were seen choose the gate."""
        level = np.minimum(np.log2(spelling + 1).astype(np.int64), 11)
        gate = level * 4 + np.minimum(np.log2(third + 1).astype(np.int64) // 3, 3)
        mixed = weights[-1][gate]
        for weight, x in zip(weights, inputs, strict=False):
            mixed = mixed + weight[gate] * x
        return Predictions(inputs, gate, np.minimum(level // 3, 3), np.clip(mixed, -16, 16))

    def cell(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Row and position of the refinement."""
        return self.coarse * 8 + k, (np.clip(self.mixed, -8, 8) + 8) * ((CELLS - 1) / 16)

    def log2(self, bit: np.ndarray, k: int, cells: np.ndarray) -> np.ndarray:
        """log2 of the probability of the bits that came: the mean of the mixed and the refined one."""
        row, at = self.cell(k)
        low = np.minimum(at.astype(np.int64), CELLS - 2)
        part = at - low
        one = cells[row, low] * (1 - part) + cells[row, low + 1] * part
        plain = 1 / (1 + np.exp(np.where(bit == 1, -self.mixed, self.mixed)))
        return np.log2((plain + np.where(bit == 1, one, 1 - one)) / 2)


class Learner:
    """The online pass of one task: weights step along each minibatch, and the refinement counts."""

    def __init__(self):
        self.mixer = Mixer.fresh()
        self.bits, self.squares = np.zeros(GATES), np.zeros((INPUTS, GATES))

    def learn(self, bit: np.ndarray, k: int, weight: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]]) -> None:
        third = pairs[1 + ORDERS.index(3)]
        got = Predictions.of(self.mixer.weights, [log_odds(*p) for p in pairs], pairs[0][0] + pairs[0][1], third[0] + third[1])
        error = (bit - 1 / (1 + np.exp(-got.mixed))) * weight
        total = np.bincount(got.gate, weight, GATES)
        slope = np.stack([np.bincount(got.gate, error * x, GATES) for x in got.inputs] + [np.bincount(got.gate, error, GATES)])
        slope /= np.maximum(total, 1)
        self.squares += slope * slope
        self.mixer.weights += RATE * slope / np.sqrt(self.squares + 1e-4)
        self.bits += total
        row, at = got.cell(k)
        cell = (row * CELLS + np.rint(at).astype(np.int64)) * 2 + bit
        self.mixer.seen += np.bincount(cell, weight, ROWS * CELLS * 2).reshape(self.mixer.seen.shape)

    def sums(self) -> np.ndarray:
        """What ranges add up: weights times the bits behind them, those bits, the refinement's counts."""
        return np.concatenate([(self.mixer.weights * self.bits).ravel(), self.bits, self.mixer.seen.ravel()])


def merged(sums: np.ndarray) -> Mixer:
    mixer = Mixer.fresh()
    summed, bits, seen = np.split(sums, [mixer.weights.size, mixer.weights.size + GATES])
    used = bits > 0
    mixer.weights[:, used] = summed.reshape(mixer.weights.shape)[:, used] / bits[used]
    return Mixer(mixer.weights, seen.reshape(mixer.seen.shape))


def word_hashes(tokens: list[bytes]) -> np.ndarray:
    """64 bits of every token."""
    out = []
    for low in range(0, len(tokens), 1 << 16):
        words = Spelled(tokens[low:low + (1 << 16)])
        powers = np.cumprod(np.full(int(words.lens.max()), _STEP))
        mixed = (words.bytes.astype(np.uint64) + np.uint64(1)) * _MIX
        out.append(np.add.reduceat((mixed ^ (mixed >> np.uint64(32))) * powers[words.place], words.starts))
    return np.concatenate(out)


def packed(values: np.ndarray) -> bytes:
    """Small numbers of four bytes, first bytes first: most of the others are zeros."""
    return pa.compress(np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), codec="zstd", asbytes=True)


def unpacked(blob: bytes, size: int) -> np.ndarray:
    flat = np.frombuffer(pa.decompress(blob, decompressed_size=4 * size, codec="zstd"), np.uint8)
    return np.ascontiguousarray(flat.reshape(4, -1).T).view("<u4").ravel()


def neighbours(number: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different pairs of neighbours: the first's number behind a one (zero: the start of a document),
    the second's number; and the pair of every token with the one before."""
    before = np.empty(len(number), dtype=np.int64)
    before[1:] = number[:-1]
    before[1:] += 1
    before[np.cumsum(lens) - lens] = 0
    n = int(number.max()) + 1
    pairs, which = np.unique(before * n + number, return_inverse=True)
    return pairs // n, pairs % n, which.astype(np.int32)


def pair_shares(tokens: list[bytes], number: np.ndarray, lens: np.ndarray, learned: np.ndarray) -> tuple[list[bytes], list[bytes], bytes]:
    """A block's pairs by bucket: hashes and times in training documents (``learned`` tokens); and the bucket of each pair."""
    first, second, which = neighbours(number, lens)
    own = np.concatenate([np.array([_STEP]), word_hashes(tokens)])
    mixed = (own[first] * _STEP + own[second + 1]) * _MIX
    mixed = (mixed ^ (mixed >> np.uint64(29))) * _STEP
    bucket = (mixed >> np.uint64(56)).astype(np.uint8)
    times = np.bincount(which, learned, len(first)).astype("<u4")
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(BUCKETS + 1))
    hashes, times = (mixed >> np.uint64(24)).astype("<u4")[order], times[order]
    return ([hashes[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)],
            [packed(times[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)], bucket.tobytes())


def pair_sums(table: pa.Table) -> pa.Table:
    """A bucket's pairs of all blocks: for each block the sums of its own pairs."""
    parts = table["pairs"].to_pylist()
    cuts = np.cumsum([0, *(len(x) // 4 for x in parts)])
    hashes = np.frombuffer(b"".join(parts), "<u4")
    times = np.concatenate([unpacked(x, len(p) // 4) for x, p in zip(table["times"].to_pylist(), parts, strict=True)])
    _, which = np.unique(hashes, return_inverse=True)
    sums = np.bincount(which, times)[which]
    return pa.table([table["block"], table["bucket"], pa.array([packed(sums[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary())],
                    names=["block", "bucket", "sums"])


def token_blocks(docs: DataFrame, text: str, held_out: Column, keep: list[str]) -> DataFrame:
    """Rows of three kinds: a document (its ``keep`` columns, which of its block it is, and how many tokens it has), a block's
    dictionary (tokens, their times in training documents, pairs of neighbours by bucket), and the numbers of the tokens of all the
    block's documents in the order of the texts, with the buckets of their pairs."""
    n = len(keep)
    kept = [T.StructField(f"k{i}", docs.schema[c].dataType) for i, c in enumerate(keep)]
    blobs = T.ArrayType(T.BinaryType())
    schema = T.StructType([
        T.StructField("block", T.LongType()), *kept, T.StructField("held", T.BooleanType()), T.StructField("size", T.LongType()), T.StructField("nth", T.IntegerType()), T.StructField("long", T.LongType()),
        T.StructField("token", blobs), T.StructField("train", T.ArrayType(T.LongType())), T.StructField("pairs", blobs), T.StructField("times", blobs), T.StructField("place", T.BinaryType()), T.StructField("number", T.BinaryType())])
    last = [pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.list_(pa.binary()), pa.list_(pa.binary()), pa.binary(), pa.binary()]

    def run(batches):
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = batch.column(n + 1)
            ends = np.cumsum([len(t.as_buffer() or b"") for t in texts])
            cuts = np.flatnonzero(np.diff(ends // BLOCK_BYTES)) + 1
            for low, high in zip([0, *cuts], [*cuts, len(texts)], strict=True):
                if low == high:
                    continue
                part = batch.slice(low, high - low)
                dictionary = defaultdict()
                dictionary.default_factory = dictionary.__len__
                number, lens, size = array("i"), [], []
                for word in part.column(n + 1).to_pylist():
                    found = word.lower().split() if word else []
                    size.append(sum(map(len, found)) + len(found) + len(END))
                    found.append(END[:-1])
                    number.extend(map(dictionary.__getitem__, found))
                    lens.append(len(found))
                number = np.frombuffer(number, np.int32)
                learned = np.repeat(~part.column(n).to_numpy(zero_copy_only=False), lens)
                train = np.bincount(number[learned], minlength=len(dictionary))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * len(lens), pa.int64()), *part.columns[:n + 1], pa.array(size, last[0]), pa.array(range(len(lens)), last[1]), pa.array(lens, last[2]),
                     *[pa.nulls(len(lens), t) for t in last[3:]]], names=schema.names)
                pairs, times, place = pair_shares([*dictionary], number, np.array(lens), learned)
                own = [[None] * 3 + [[w + b" " for w in dictionary], train, pairs, times, None, None], [None] * 7 + [place, packed(number)]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * 2, pa.int64()), *[pa.nulls(2, c.type) for c in part.columns[:n + 1]],
                     *[pa.array(x, t) for x, t in zip(zip(*own, strict=True), last, strict=True)]], names=schema.names)
                block += 1

    rows = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], held_out.alias("held"),
                       F.col(f"`{text}`").cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(run, schema)


def token_counts(blocks: DataFrame) -> DataFrame:
    """token, c: every token of the corpus and its times in training documents."""
    pairs = blocks.filter(F.col("token").isNotNull()).select(F.explode(F.arrays_zip("token", "train")).alias("x"))
    return pairs.groupBy(F.col("x.token").alias("token")).agg(F.sum("x.train").alias("c"))


def context_tables(counts: DataFrame) -> list[np.ndarray]:
    """Counts of zeros and ones of every short context's slot, over all training tokens."""
    size = 1 << TABLE_BITS

    def run(batches):
        tables = np.zeros((len(ORDERS), size * 2), dtype=np.int64)
        for batch in batches:
            for low in range(0, batch.num_rows, 16 * BATCH):
                part = batch.slice(low, 16 * BATCH)
                words = Spelled(part.column(0).to_pylist())
                much = part.column(1).to_numpy()[words.token]
                contexts = words.contexts()
                for bit, node in words.bits():
                    for table, context in zip(tables, contexts, strict=True):
                        np.add.at(table, slots(context, node) * 2 + bit, much)
        flat = tables.ravel()
        used = np.flatnonzero(flat)
        for low in range(0, len(used), 100_000):
            some = used[low:low + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(flat[some])], names=["slot", "n"])

    sums = counts.filter("c > 0").select("token", "c").mapInArrow(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    flat = np.zeros(len(ORDERS) * size * 2, dtype=np.float32)
    flat[sums["slot"].to_numpy()] = sums["n"].to_numpy()
    return [np.ascontiguousarray(t.T) for t in flat.reshape(len(ORDERS), size, 2)]


class Range:
    """The tokens of one range in order, with the bits that neighbours share."""

    def __init__(self, table: pa.Table):
        tokens, c = table["token"].to_pylist(), table["c"].to_numpy()
        order = sorted(range(len(tokens)), key=tokens.__getitem__)
        self.tokens, self.c = [tokens[i] for i in order], c[order]
        self.bytes = np.zeros((len(order), PATH), dtype=np.uint8)
        for i, t in enumerate(self.tokens):
            head = t[:PATH]
            self.bytes[i, :len(head)] = np.frombuffer(head, dtype=np.uint8)
        self.lens = np.fromiter(map(len, self.tokens), dtype=np.int64, count=len(order))
        apart = self.bytes[1:] ^ self.bytes[:-1]
        first = (apart != 0).argmax(1)
        gap = apart[np.arange(len(apart)), first].astype(np.int64)
        shared = np.where(gap > 0, 8 * first + 7 - np.log2(np.maximum(gap, 1)).astype(np.int64), 8 * PATH)
        self.shared = np.concatenate([[-1], shared])

    def node(self, token: int, depth: int) -> bytes:
        """Name of the spelling of ``depth`` bits: the depth and the bytes, later bits cleared."""
        head = bytearray(self.bytes[token, :(depth + 7) // 8].tobytes())
        if depth % 8:
            head[-1] &= (0xFF << (8 - depth % 8)) & 0xFF
        return depth.to_bytes(2, "big") + bytes(head)

    def sums(self, depth: int, alive: np.ndarray, totals: dict[bytes, int]) -> np.ndarray:
        """Training times of all tokens that share their first ``depth`` bits, for each token of
        ``alive`` (those with a byte there); ``totals`` has the spellings that go on beyond the range."""
        starts = np.flatnonzero(self.shared[alive] < depth)
        if not len(starts) or starts[0] != 0:
            starts = np.concatenate([[0], starts])
        sums = np.add.reduceat(self.c[alive], starts)
        for place, token in ((0, 0), (-1, len(self.tokens) - 1)):
            # only a group that holds the range's first or last token can go on beyond it
            if alive[place] == token:
                sums[place] = totals.get(self.node(token, depth), sums[place])
        return np.repeat(sums, np.diff(np.append(starts, len(alive))))

    def edges(self) -> dict[bytes, int]:
        """Every spelling of the range's first and last token, with its sum inside the range."""
        out = {}
        for token in {0, len(self.tokens) - 1}:
            for depth in range(8 * min(PATH, int(self.lens[token])) + 1):
                alive = np.flatnonzero(self.lens * 8 >= depth)
                same = self.sums(depth, alive, {})
                out[self.node(token, depth)] = int(same[np.searchsorted(alive, token)])
        return out

    def path_counts(self, totals: dict[bytes, int], words: Spelled) -> np.ndarray:
        """(zeros, ones) behind every bit's spelling so far, as [number of the bit, 0 or 1, byte]."""
        counts = np.zeros((8, 2, len(words.bytes)), dtype=np.float32)
        for place in range(min(PATH, int(self.lens.max()))):
            alive = np.flatnonzero(self.lens > place)
            at = words.starts[alive] + place
            before = self.sums(8 * place, alive, totals)
            for k in range(8):
                after = self.sums(8 * place + k + 1, alive, totals)
                bit = (self.bytes[alive, place] >> (7 - k)) & 1
                counts[k, bit, at] = after
                counts[k, 1 - bit, at] = before - after
                before = after
        return counts

    def learn(self, totals: dict[bytes, int], tables: list[np.ndarray], learner: Learner) -> None:
        """Training tokens predicted by the counts without themselves, in mixed order."""
        words = Spelled(self.tokens)
        contexts, counts = words.contexts(), self.path_counts(totals, words)
        weight = self.c[words.token].astype(np.float64)
        inside = (words.place < PATH).astype(np.float32)
        mixed = np.array([zlib.crc32(t) for t in self.tokens])
        group = np.where(self.c > 0, mixed % max(1, round(len(mixed) / BATCH)), -1)[words.token]
        order = np.argsort(group, kind="stable")
        cuts = np.searchsorted(group[order], np.arange(group.max(initial=-1) + 2))
        bits = list(words.bits())
        for low, high in zip(cuts, cuts[1:], strict=False):
            some = order[low:high]
            if not len(some):
                continue
            for k, (bit, node) in enumerate(bits):
                came = bit[some]
                pairs = [(counts[k, 0, some], counts[k, 1, some])]
                pairs += [tuple(t[:, slots(c[some], node[some])]) for t, c in zip(tables, contexts, strict=True)]
                gone = [inside[some], *[np.float32(1)] * len(ORDERS)]
                pairs = [(np.maximum(zero - (1 - came) * g, 0), np.maximum(one - came * g, 0)) for (zero, one), g in zip(pairs, gone, strict=True)]
                learner.learn(came, k, weight[some], pairs)

    def log_probabilities(self, totals: dict[bytes, int], mixer: Mixer, tables: list[np.ndarray]) -> np.ndarray:
        """log2 of the probability of every token."""
        words = Spelled(self.tokens)
        contexts, counts, cells = words.contexts(), self.path_counts(totals, words), mixer.cells()
        odds = [log_odds(*t) for t in tables]
        third = tables[ORDERS.index(3)].sum(0)
        logs = np.zeros(len(words.bytes))
        for k, (bit, node) in enumerate(words.bits()):
            places = [slots(c, node) for c in contexts]
            inputs = [log_odds(*counts[k]), *[o[p] for o, p in zip(odds, places, strict=True)]]
            got = Predictions.of(mixer.weights, inputs, counts[k].sum(0), third[places[ORDERS.index(3)]])
            logs += got.log2(bit, k, cells)
        return words.per_token(logs)


def _totals(edge: pa.Table) -> dict[bytes, int]:
    return dict(zip(edge["node"].to_pylist(), edge["n"].to_pylist(), strict=True))


def spelled_ranges(counts: DataFrame, types: int):
    """The tokens by ranges of about ``RANGE``, each with the sums of the spellings at its ends."""
    ranges = max(1, -(-types // RANGE))
    ordered = stored(counts.repartitionByRange(ranges, "token").withColumn("range", F.spark_partition_id()), "lm-ranges", compression="zstd")

    def edges(table: pa.Table) -> pa.Table:
        found = Range(table).edges()
        which = table["range"][0].as_py()
        return pa.table([pa.array([which] * len(found), pa.int32()), pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())],
                        names=["range", "node", "n"])

    ends = stored(ordered.groupBy("range").applyInArrow(edges, "range int, node binary, n long"), "lm-edges")
    sums = ends.groupBy("node").agg(F.sum("n").alias("n"))
    ends = ends.drop("n").join(sums, "node").select(F.col("range").alias("of"), "node", "n")
    return ordered.groupBy("range").cogroup(ends.groupBy("of"))


def fit_mixer(ranges, shared, types: int) -> Mixer:
    """One mixer from the ranges' online passes over all training tokens of the corpus, ``types``
    different ones; a bounded number of sums reaches the driver."""
    buckets = max(1, min(64, -(-types // RANGE)))

    def learn(table: pa.Table, edge: pa.Table) -> pa.Table:
        learner = Learner()
        Range(table).learn(_totals(edge), shared.value, learner)
        return pa.table({"bucket": pa.array([table["range"][0].as_py() % buckets], pa.int32()), "sums": pa.array([learner.sums().tolist()])})

    def add(table: pa.Table) -> pa.Table:
        total = np.sum([s.values.to_numpy() for s in table["sums"]], axis=0)
        return pa.table({"bucket": table["bucket"][:1], "sums": pa.array([total.tolist()])})

    kind = "bucket int, sums array<double>"
    rows = ranges.applyInArrow(learn, kind).groupBy("bucket").applyInArrow(add, kind).collect()
    return merged(np.sum([r["sums"] for r in rows], axis=0)) if rows else Mixer.fresh()


def spell(ranges, shared, mixer: Mixer) -> DataFrame:
    """token, c, bits: every token of the corpus with the bits that it takes."""

    def bits(table: pa.Table, edge: pa.Table) -> pa.Table:
        here = Range(table)
        logs = here.log_probabilities(_totals(edge), mixer, shared.value)
        return pa.table([pa.array(here.tokens, pa.binary()), pa.array(here.c), pa.array(-logs)], names=["token", "c", "bits"])

    return ranges.applyInArrow(bits, "token binary, c long, bits double")


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln of the gamma function for x >= 1 (Stirling's series, eight steps up)."""
    steps = sum(np.log(x + k) for k in range(8))
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - steps


def adapted_bits(bits: np.ndarray, times: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Bits of whole documents: token ``i`` takes ``bits[i]`` when it is new and comes ``times[i]`` times."""
    weight = ADAPT * np.exp2(-bits)
    log = math.log(ADAPT) - bits * math.log(2) + log_gamma(weight + times) - log_gamma(weight + 1)
    whole = np.add.reduceat(times, starts).astype(np.float64)
    return -(np.add.reduceat(log, starts) - log_gamma(ADAPT + whole) + log_gamma(np.array(ADAPT))) / math.log(2)


@dataclass
class Bag:
    """The tokens of some documents in order (``doc`` and number), with how often each came before and comes in all of its document."""

    doc: np.ndarray
    before: np.ndarray
    times: np.ndarray
    number_of: np.ndarray
    times_of: np.ndarray
    starts_of: np.ndarray

    @staticmethod
    def of(number: np.ndarray, lens: np.ndarray) -> Bag:
        """``number_of``, ``times_of`` and ``starts_of`` are the different tokens of each document."""
        doc = np.repeat(np.arange(len(lens)), lens)
        n = int(number.max()) + 1
        key = doc * n + number
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        much = np.diff(np.append(first, len(key)))
        before, times = np.empty(len(key), dtype=np.int64), np.empty(len(key), dtype=np.int64)
        before[order] = np.arange(len(key)) - np.repeat(first, much)
        times[order] = np.repeat(much, much)
        return Bag(doc, before, times, key[first] % n, much, np.searchsorted(key[first] // n, np.arange(len(lens))))


def order_gain(number: np.ndarray, lens: np.ndarray, bag: Bag, bits: np.ndarray, which: np.ndarray, sums: np.ndarray,
               after: np.ndarray, learned: np.ndarray) -> np.ndarray:
    """Bits that whole documents save when a token is expected behind the one before: ``sums`` has the times of each pair (``which``
    names a token's) and ``after`` those of its first token in training documents; ``learned`` ones' own are left out."""
    starts = np.cumsum(lens) - lens
    _, same, much = np.unique(bag.doc * len(sums) + which, return_inverse=True, return_counts=True)
    mine = learned[bag.doc]
    around = np.empty(len(number), dtype=np.int64)
    around[1:] = bag.times[:-1]
    around[starts] = 1
    seen = after[which] - around * mine
    came = np.minimum(sums[which] - much[same] * mine, seen)
    new = bits[number]
    plain = math.log(ADAPT) - new * math.log(2)
    plain = np.log(ADAPT * np.exp2(-new) + bag.before, where=bag.before > 0, out=plain)
    plain -= np.log(ADAPT + np.arange(len(number)) - starts[bag.doc])
    told = np.log((came + ORDER * np.exp(plain)) / (seen + ORDER), where=came > 0, out=plain + np.log(ORDER / (seen + ORDER)))
    return np.add.reduceat(told - plain, starts) / math.log(2)


def score_texts(docs: DataFrame, text: str, held_out: Column, keep: list[str]) -> DataFrame:
    """``keep`` columns of every row of ``docs`` with held_out, n_tokens, n_known, train_tokens,
    base_score, score (log10 probabilities), n_bytes and bits_per_byte."""
    names = ["held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes", "bits_per_byte"]
    keep = [c for c in keep if c.lower() not in names]
    blocks = stored(token_blocks(docs, text, held_out, keep), "lm-blocks", compression="zstd")
    counts = stored(token_counts(blocks), "lm-tokens", compression="zstd")
    n, v, types = counts.agg(F.sum("c"), F.count_if(F.col("c") > 0), F.count(F.lit(1))).first()
    n = n or 0
    shared = docs.sparkSession.sparkContext.broadcast(context_tables(counts))
    ranges = spelled_ranges(counts, types)
    scored = spell(ranges, shared, fit_mixer(ranges, shared, types))
    kinds = [T.StructField(c, docs.schema[c].dataType) for c in keep]
    types_out = [T.BooleanType(), T.LongType(), T.LongType(), T.LongType(), T.DoubleType(), T.DoubleType(), T.LongType(), T.DoubleType()]
    schema = T.StructType([*kinds, *[T.StructField(a, b) for a, b in zip(names, types_out, strict=True)]])

    def add_up(rows: pa.Table, words: pa.Table) -> pa.Table:
        at = words["at"].to_numpy()
        c, bits = np.zeros(len(at), dtype=np.int64), np.zeros(len(at))
        c[at], bits[at] = words["c"].to_numpy(), words["bits"].to_numpy()
        base = np.log10((c + 0.5) / (n + 0.5 * (v + 1)))
        shares = rows.filter(rows["sums"].is_valid()).sort_by("bucket")
        bucket = np.frombuffer(rows["place"].drop_null()[0].as_py(), np.uint8)
        number = rows["number"].drop_null()[0].as_py()
        rows = rows.filter(rows["nth"].is_valid()).sort_by("nth")
        lens = rows["long"].to_numpy()
        number = unpacked(number, int(lens.sum())).astype(np.int32)
        starts = np.cumsum(lens) - lens
        first, _, which = neighbours(number, lens)
        sums = np.empty(len(bucket), dtype=np.int64)
        much = np.bincount(bucket, minlength=BUCKETS).tolist()
        sums[np.argsort(bucket, kind="stable")] = np.concatenate([unpacked(x, k) for x, k in zip(shares["sums"].to_pylist(), much, strict=True)])
        # every document starts once, and ends once
        after = np.concatenate([[c[number[lens[0] - 1]]], c])[first]
        learned = ~rows["held"].to_numpy()
        all_bits = np.empty(len(lens))
        for low, high in chunks(lens):
            a, b = starts[low], starts[high - 1] + lens[high - 1]
            bag = Bag.of(number[a:b], lens[low:high])
            all_bits[low:high] = adapted_bits(bits[bag.number_of], bag.times_of, bag.starts_of) - order_gain(
                number[a:b], lens[low:high], bag, bits, which[a:b], sums, after, learned[low:high])

        def total(x):
            return np.add.reduceat(x[number], starts)

        all_bytes = rows["size"].to_numpy()
        out = [rows["held"], lens.astype(np.int64), total((c > 0).astype(np.int64)), np.full(len(lens), n), total(base),
               -all_bits * math.log10(2), all_bytes, all_bits / all_bytes]
        return pa.table([*[rows[f"k{i}"] for i in range(len(keep))], *[x if isinstance(x, pa.ChunkedArray) else pa.array(x) for x in out]],
                        names=schema.names)

    dictionaries = blocks.filter(F.col("token").isNotNull())
    places = dictionaries.select(F.col("block").alias("of"), F.posexplode("token").alias("at", "token"))
    words = places.join(scored, "token").select("of", "at", "c", "bits")
    pairs = dictionaries.select("block", F.posexplode(F.arrays_zip("pairs", "times")).alias("bucket", "x")).select("block", "bucket", "x.pairs", "x.times")
    sums = pairs.groupBy("bucket").applyInArrow(pair_sums, "block long, bucket int, sums binary")
    rows = blocks.filter(F.col("token").isNull()).drop("token", "train", "pairs", "times")
    rows = rows.unionByName(sums, allowMissingColumns=True)
    return rows.groupBy("block").cogroup(words.groupBy("of")).applyInArrow(add_up, schema)


def chunks(lens: np.ndarray):
    """Stretches of documents of about ``CHUNK`` tokens."""
    ends = np.cumsum(lens)
    cuts = [0, *(np.flatnonzero(np.diff(ends // CHUNK)) + 1), len(lens)]
    return zip(cuts, cuts[1:], strict=False)


def op12_lm_scoring(docs: DataFrame) -> DataFrame:
    """Scores of every document; those with crc32(doc_id) mod 5 = 1 are held out of training."""
    held = F.coalesce(crc_mod("doc_id", 5) == 1, F.lit(False))
    return score_texts(docs, "text", held, ["doc_id"])
