"""Hilbert-curve sharding: rows close in several metadata columns land close together.

Each column is cut into cells at its quantiles, the cells' coordinates give a
place on the Hilbert curve, and equal runs along the curve are the shards.
Files written in this order have narrow ranges in every column at once, so
readers skip files whichever column they filter on.  DataFrame functions only.
"""

from __future__ import annotations

import os.path
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import let, split_rank


def hilbert_index(coords: list[Column], bits: int) -> Column:
    """Place on the Hilbert curve of non-negative integer coordinates below 2^bits.

    Skilling's transform: from the highest bit down, each coordinate either
    mirrors the first one's lower bits or swaps them with its own; a Gray code
    and bit interleaving finish it.
    """
    n = len(coords)
    x0 = F.array(*[c.cast("int") for c in coords])
    turns = F.array(*[F.struct(F.lit(1 << b).alias("q"), F.lit(i).alias("i")) for b in range(bits - 1, 0, -1) for i in range(n)])

    def turn(x: Column, s: Column) -> Column:
        low = s["q"] - 1
        own, first = F.get(x, s["i"]), F.element_at(x, 1)
        mirrored = own.bitwiseAND(s["q"]) != 0
        swap = first.bitwiseXOR(own).bitwiseAND(low)
        change = lambda k: (F.when((k == 0) & mirrored, low).when((k == 0) | (k == s["i"]), F.when(mirrored, 0).otherwise(swap))
                            .otherwise(0))
        return F.transform(x, lambda v, k: v.bitwiseXOR(change(k)))

    turned = F.aggregate(turns, x0, turn) if bits > 1 else x0
    masks = F.array(*[F.lit(1 << b) for b in range(bits - 1, 0, -1)]) if bits > 1 else F.array().cast("array<int>")

    def gray(x: Column) -> Column:
        return F.transform(x, lambda v, k: F.aggregate(F.slice(x, 1, k + 1), F.lit(0), lambda a, b: a.bitwiseXOR(b)))

    def flip(g: Column) -> Column:
        return F.aggregate(masks, F.lit(0), lambda t, q: F.when(F.element_at(g, n).bitwiseAND(q) != 0, t.bitwiseXOR(q - 1)).otherwise(t))

    def weave(x: Column) -> Column:
        out = F.lit(0).cast("long")
        for b in range(bits - 1, -1, -1):
            for i in range(n):
                out = out * 2 + F.shiftright(F.element_at(x, i + 1), b).bitwiseAND(F.lit(1)).cast("long")
        return out

    return let(turned, lambda x: let(gray(x), lambda g: let(flip(g), lambda f: let(F.transform(g, lambda v: v.bitwiseXOR(f)), weave))))


def _sort_number(df: DataFrame, name: str, low: str | None, high: str | None) -> Column:
    """A number that orders the column's values: itself, or for text the seven
    bytes behind the prefix that its least and greatest value share."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.NumericType):
        return F.col(name).cast("double")
    if isinstance(kind, (T.DateType, T.TimestampType)):
        return F.col(name).cast("timestamp").cast("double")
    shared = len(os.path.commonprefix([low or "", high or ""]).encode())
    raw = F.hex(F.substring(F.encode(F.col(name).cast("string"), "UTF-8"), shared + 1, 7))
    return F.conv(F.rpad(raw, 14, "0"), 16, 10).cast("double")


def curve_cells(df: DataFrame, dims: list[str], bits: int) -> tuple[Column, int]:
    """The packed cell coordinates of a row over ``dims`` (nulls in cell 0), and the row count.

    Cells are cut at approximate quantiles over all rows, so each column's
    cells hold similar numbers of rows unless one value is more frequent.
    """
    text = [d for d in dims if not isinstance(df.schema[d].dataType, T.NumericType | T.DateType | T.TimestampType)]
    ends = df.agg(F.count(F.lit(1)).alias("n"), *[f(F.col(d).cast("string")).alias(f"{k}{i}")
                  for i, d in enumerate(text) for k, f in (("lo", F.min), ("hi", F.max))]).first()
    numbers = [_sort_number(df, d, ends[f"lo{text.index(d)}"] if d in text else None, ends[f"hi{text.index(d)}"] if d in text else None)
               for d in dims]
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    cuts = df.agg(*[F.percentile_approx(c, shares, 10_000).alias(f"c{i}") for i, c in enumerate(numbers)]).first()
    cell = F.lit(0)
    for i, c in enumerate(numbers):
        levels = sorted(set(cuts[f"c{i}"] or []))
        place = reduce(lambda a, b: a + b, [(c > F.lit(v)).cast("int") for v in levels], F.lit(0))
        cell = cell * (1 << bits) + F.coalesce(place, F.lit(0))
    return cell, ends["n"]


def hilbert_order(df: DataFrame, dims: list[str], ident: list[str], bits: int = 5) -> tuple[DataFrame, int]:
    """Add ``curve`` (place of the row's cell on the curve) and ``rank`` (gapless
    place of the row along the curve, ties by hash and value of ``ident``).

    There are at most 2^(bits * dims) cells (32,768 for three), so their table is
    small; a cell that holds many rows is ranked in many groups.  Repeated rows
    stand next to each other; an empty table gives an empty one.
    """
    cell, n = curve_cells(df, dims, bits)
    # the row's own columns travel as one, so that their names meet no other
    held = df.select(F.struct(*df.columns).alias("__row"), F.struct(*ident).alias("__id"), cell.alias("__cell"))
    coords = [F.shiftright(F.col("__c"), bits * (len(dims) - 1 - i)).bitwiseAND(F.lit((1 << bits) - 1)) for i in range(len(dims))]
    cells = held.groupBy(F.col("__cell").alias("__c")).agg(F.count(F.lit(1)).alias("__rows"))
    cells = cells.withColumn("curve", hilbert_index(coords, bits))
    before = Window.orderBy("curve").rowsBetween(Window.unboundedPreceding, -1)  # at most 2^(bits * dims) rows
    cells = cells.withColumn("__start", F.coalesce(F.sum("__rows").over(before), F.lit(0))).drop("__rows")
    ranked = split_rank(held, "__cell", F.col("__id"), n)
    out = ranked.join(F.broadcast(cells), ranked["__cell"] == cells["__c"])
    return out.select("__row.*", "curve", (F.col("rank") + F.col("__start")).alias("rank")), n


def hilbert_shards(df: DataFrame, dims: list[str], ident: list[str], shards: int = 8, bits: int = 5) -> DataFrame:
    """Add ``curve``, ``rank``, ``shard`` and ``slot``: runs along the curve whose
    row counts differ by at most one, and the gapless place inside the run.

    Nulls in ``dims`` fall into a column's first cell, nulls in ``ident`` are
    values like others.  Columns named ``curve``, ``rank``, ``shard`` or ``slot``
    are replaced.
    """
    own = {"curve", "rank", "shard", "slot"}
    out, n = hilbert_order(df.drop(*[c for c in df.columns if c.lower() in own]), dims, ident, bits)
    shard = F.expr(f"cast(rank * {shards}L div {max(n, 1)}L as int)")
    out = out.withColumn("shard", shard)
    # the first rank of shard s is the least r with r * shards >= s * n
    return out.withColumn("slot", F.expr(f"rank - (cast(shard as bigint) * {n}L + {shards - 1}L) div {shards}L"))


def write_shards(df: DataFrame, path: str, shards: int) -> None:
    """One folder per shard, rows inside in curve order: each file covers a short stretch of the curve."""
    (df.repartition(shards, "shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path))


def op1_hilbert(docs: DataFrame) -> DataFrame:
    """The contract's columns under law ``rows``: eight runs along the curve over source, language and n_chars."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).cast("long")
    rows = docs.select("doc_id", "source", "lang", "n_chars", size.alias("size"), crc.alias("text_crc32"))
    out = hilbert_shards(rows, ["source", "lang", "n_chars"], ["doc_id", "text_crc32"], 8)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "curve")
