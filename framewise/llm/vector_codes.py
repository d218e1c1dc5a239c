"""Vector code compression: product codes whose nearest-entry search is memoised per grid cell.

A vector of integers is cut into consecutive parts and every part is replaced by
the index of the nearest entry of its position's codebook.  The search goes
through a grid: a part lies in a coarse cell (its integers divided by ``cell``,
rounded down), and for a cell's box the squared distance to an entry lies between
a least and a greatest value.  An entry whose least distance exceeds another
entry's greatest one is dominated in the whole box.  The entries that are left are
kept in a memo under the cell's hash; only those are evaluated exactly.  Ties go to the
lower index, as an entry that ties with the best is never dominated.

Defined results: rows whose vector is null or holds a null or non-finite component
are dropped, and so are rows whose vector has another length than the first seed's
(the row with the least ``vec_id``).  Null ids seed after all others; rows with one id
seed in the order of their vectors.  Fewer than ``entries`` rows make a smaller
codebook.  Repeated rows are coded each; an empty table gives an empty result.
Lengths that ``parts`` does not divide are cut at ``p * length // parts``.
Components must be below 2**14 in size (2**26 as integers), as squared distances
are 64-bit sums; larger ones are an error.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import free_name, stored

SCALE = 4096
PARTS, ENTRIES, ROUNDS = 8, 16, 6
#: Side of a grid cell in integer units, and the most cells that a memo holds.
CELL, MEMO = 256, 50_000
LARGEST = 1 << 26


@dataclass
class Codebooks:
    """``bounds`` are the parts' limits; ``entries[p]`` the integer entries of part ``p``."""

    bounds: list[int]
    entries: list[np.ndarray]

    def digest(self) -> str:
        return hashlib.sha256(",".join(str(int(x)) for e in self.entries for x in e.ravel()).encode()).hexdigest()


class GridSearch:
    """Nearest entries of one codebook, with the undominated entries of each cell in a memo."""

    def __init__(self, entries: np.ndarray, cell: int = CELL, most: int = MEMO):
        self.entries, self.cell, self.most = entries, cell, most
        self.memo: dict[bytes, int] = {}
        self.evaluated = 0

    def undominated(self, cells: np.ndarray) -> np.ndarray:
        """Bit sets of the entries that can be nearest to some point of each cell."""
        low = (cells * self.cell)[:, None, :]
        high = low + (self.cell - 1)
        near = np.maximum(np.maximum(low - self.entries, self.entries - high), 0)
        far = np.maximum(np.abs(low - self.entries), np.abs(high - self.entries))
        keep = (near * near).sum(2) <= (far * far).sum(2).min(1)[:, None]
        return (keep << np.arange(len(self.entries))).sum(1)

    def candidates(self, points: np.ndarray) -> np.ndarray:
        cells = np.ascontiguousarray(points // self.cell)
        if not cells.size:
            return np.ones(len(points), dtype=np.int64)
        keys = cells.view(np.dtype((np.void, cells.itemsize * cells.shape[1]))).ravel()
        _, first, where = np.unique(keys, return_index=True, return_inverse=True)
        names = [keys[i].tobytes() for i in first]
        sets = np.array([self.memo.get(k, 0) for k in names], dtype=np.int64)
        new = np.flatnonzero(sets == 0)
        for at in range(0, len(new), 4096):
            some = new[at:at + 4096]
            sets[some] = self.undominated(cells[first[some]])
        if len(self.memo) + len(new) > self.most:
            self.memo.clear()
        self.memo.update((names[i], int(sets[i])) for i in new[:self.most])
        return sets[where]

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry and its squared distance, per point."""
        sets = self.candidates(points)
        best = np.full(len(points), np.iinfo(np.int64).max)
        index = np.zeros(len(points), dtype=np.int64)
        for e in range(len(self.entries)):
            rows = np.flatnonzero(sets >> e & 1)
            self.evaluated += len(rows)
            gap = points[rows] - self.entries[e]
            dist = (gap * gap).sum(1)
            less = dist < best[rows]
            best[rows[less]] = dist[less]
            index[rows[less]] = e
        return index, best


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width).astype(np.int64)


def integer_vectors(df: DataFrame, vector: str, out: str) -> DataFrame:
    """Rows with a whole finite vector, its integers ``floor(SCALE * x)`` in ``out``."""
    v = F.col(f"`{vector}`")
    whole = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    big = F.exists(F.col(out), lambda x: F.abs(x) >= LARGEST)
    ints = df.filter(F.coalesce(whole, F.lit(False))).withColumn(out, F.transform(v, lambda x: F.floor(x.cast("double") * SCALE)))
    too_large = F.raise_error(F.lit(f"components must be below {LARGEST // SCALE} in size"))
    return ints.withColumn(out, F.when(big, too_large.cast("array<bigint>")).otherwise(F.col(out)))


def first_books(ints: DataFrame, vec_id: str, column: str, parts: int, entries: int) -> Codebooks | None:
    """The parts of the ``entries`` rows with the least ids; None for an empty table."""
    width = ints.orderBy(F.col(f"`{vec_id}`").asc_nulls_last(), column).select(F.size(column)).first()
    if width is None:
        return None
    length = width[0]
    seeds = (ints.filter(F.size(column) == length).orderBy(F.col(f"`{vec_id}`").asc_nulls_last(), column)
             .limit(entries).select(column).collect())
    rows = np.array([r[0] for r in seeds], dtype=np.int64).reshape(len(seeds), length)
    bounds = [p * length // parts for p in range(parts + 1)]
    return Codebooks(bounds, [rows[:, a:b].copy() for a, b in zip(bounds, bounds[1:], strict=False)])


def part_sums(ints: DataFrame, column: str, books: Codebooks, cell: int) -> list:
    """Sums and counts of the parts that each entry is nearest to: at most parts x entries x (width + 1) rows."""
    width = books.bounds[-1]

    def add(batches):
        searches = [GridSearch(e, cell) for e in books.entries]
        sums = [np.zeros((len(e), e.shape[1] + 1), dtype=np.int64) for e in books.entries]
        for batch in batches:
            m = _matrix(batch.column(0), width)
            for p, (search, total) in enumerate(zip(searches, sums, strict=True)):
                part = m[:, books.bounds[p]:books.bounds[p + 1]]
                index, _ = search.nearest(part)
                used = np.unique(index)
                order = np.argsort(index, kind="stable")
                at = np.searchsorted(index[order], used)
                if len(used):
                    total[used, 0] += np.bincount(index, minlength=len(total))[used]
                    total[used, 1:] += np.add.reduceat(part[order], at, axis=0)
        rows = [(p, e, k, int(t[e, k])) for p, t in enumerate(sums) for e in range(len(t)) if t[e, 0] for k in range(t.shape[1])]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=["part", "entry", "k", "v"])

    partial = ints.select(column).filter(F.size(column) == width).mapInArrow(add, "part long, entry long, k long, v long")
    return partial.groupBy("part", "entry", "k").agg(F.sum("v").alias("v")).collect()


def refine(books: Codebooks, sums: list) -> Codebooks:
    """Every used entry becomes the floor of its parts' mean; others stay."""
    totals = {(r["part"], r["entry"], r["k"]): r["v"] for r in sums}
    entries = [e.copy() for e in books.entries]
    for p, book in enumerate(entries):
        for e in range(len(book)):
            n = totals.get((p, e, 0), 0)
            if n:
                book[e] = [totals[p, e, k + 1] // n for k in range(book.shape[1])]
    return Codebooks(books.bounds, entries)


def train_books(ints: DataFrame, vec_id: str, column: str, parts: int = PARTS, entries: int = ENTRIES,
                rounds: int = ROUNDS, cell: int = CELL) -> Codebooks | None:
    books = first_books(ints, vec_id, column, parts, entries)
    for _ in range(rounds if books else 0):
        books = refine(books, part_sums(ints, column, books, cell))
    return books


def encode(ints: DataFrame, column: str, books: Codebooks, code: str, error: str, cell: int = CELL) -> DataFrame:
    """``ints`` without ``column``, plus the code (two hex digits a part) and the error."""
    width = books.bounds[-1]
    kept = [c for c in ints.columns if c != column]

    def run(batches):
        searches = [GridSearch(e, cell) for e in books.entries]
        for batch in batches:
            m = _matrix(batch.column(len(kept)), width)
            codes, error_sum = np.empty((len(m), len(searches)), dtype=np.uint8), np.zeros(len(m), dtype=np.int64)
            for p, search in enumerate(searches):
                codes[:, p], dist = search.nearest(m[:, books.bounds[p]:books.bounds[p + 1]])
                error_sum += dist
            names = pa.array([row.tobytes().hex() for row in codes], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(kept)], names, pa.array(error_sum)], names=[*kept, code, error])

    rows = ints.select(*[F.col(f"`{c}`") for c in kept], column)
    schema = StructType([ints.schema[c] for c in kept] + [StructField(code, StringType()), StructField(error, LongType())])
    return rows.mapInArrow(run, schema)


def compress_vectors(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", parts: int = PARTS,
                     entries: int = ENTRIES, rounds: int = ROUNDS, cell: int = CELL) -> tuple[DataFrame, Codebooks | None]:
    """The rows of ``df`` with whole vectors, with ``code`` and ``error`` in place of the
    vector, and the codebooks (None when no row has a whole vector)."""
    if entries > 32 or parts < 1 or entries < 1:
        raise ValueError("between 1 and 32 entries and at least one part")
    column = free_name(df, "ints")
    taken = {"code", "error"} - {vec_id, vector}
    rest = df.select(*[F.col(f"`{c}`") for c in df.columns if c == vec_id or c == vector or c.lower() not in taken])
    ints = stored(integer_vectors(rest, vector, column).drop(vector), "vector-parts")
    books = train_books(ints, vec_id, column, parts, entries, rounds, cell)
    if books is None:
        return ints.drop(column).withColumns({"code": F.lit("").cast("string"), "error": F.lit(0).cast("long")}), None
    ints = ints.filter(F.size(column) == books.bounds[-1])
    return encode(ints, column, books, "code", "error", cell), books


def with_group_sum(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """Add the sum of ``value`` over the rows with an equal ``key`` (nulls together).

    A key that holds more than 1/4096 of the rows is one of at most 4,096, so those
    sums are broadcast; the other keys are joined, and none of them is large.
    """
    total, n, heavy = free_name(df, "total"), free_name(df, "n"), free_name(df, "heavy")
    other = free_name(df, "key")
    sums = stored(df.groupBy(F.col(f"`{key}`").alias(other)).agg(F.sum(value).alias(total), F.count(F.lit(1)).alias(n)), "group-sums")
    rows = sums.agg(F.sum(n)).first()[0] or 0
    large = sums.filter(F.col(n) * 4096 > rows).select(other, F.col(total).alias(heavy))
    rest = sums.filter(F.col(n) * 4096 <= rows).select(other, total)
    got = df.join(F.broadcast(large), df[key].eqNullSafe(large[other]), "left").drop(other)
    light = got.filter(F.col(heavy).isNull())
    light = light.join(rest, light[key].eqNullSafe(rest[other]), "left").drop(other, heavy).withColumnRenamed(total, out)
    return got.filter(F.col(heavy).isNotNull()).withColumnRenamed(heavy, out).unionByName(light)


def op11_vector_codes(df: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every row with a whole vector."""
    coded, books = compress_vectors(df.select("vec_id", "embedding", "label"))
    digest = books.digest() if books else hashlib.sha256(b"").hexdigest()
    out = with_group_sum(stored(coded, "vector-codes"), "label", "error", "label_error")
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
