"""Pairs of boxes that meet, found through cells in one pass over both sides.

Both sides are shuffled together once by their keys (a camera's frame, an image).  Every
frame knows the sizes of its own boxes from a window over its rows, so nothing is looked up
beforehand and neither input is evaluated again.  A box's level is the number of doublings of
``cell`` until a cell is no smaller than the box; it is put into the cells it
touches (four at most) at its own level and at each coarser level of its frame.
A pair meets at the level of its larger box, in the one cell that holds the top-left corner
of the intersection.  A frame with few rows is one cell.  Work grows with the number of meetings, not with left x right.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sorted_groups import cpu_parallelism


#: Frames with no more left x right rows than this are one cell: comparing them is cheaper than cutting.
SMALL_FRAME = 256


def _side(df: DataFrame, keys: list[str], box, mine: str, other: str, other_type: str, cell: float, all_rows: bool) -> DataFrame:
    names = ("_x1", "_y1", "_x2", "_y2")
    payload = F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in keys])
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    # in steps, so that a corner's expression is evaluated once
    out = df.where(whole).select(*keys, payload.alias("_row"), *[c.cast("double").alias(n) for c, n in zip(box, names, strict=True)])
    if not all_rows:  # a box without a place (a null corner) meets nothing
        out = out.where(F.col("_x1").isNotNull() & F.col("_y1").isNotNull() & F.col("_x2").isNotNull() & F.col("_y2").isNotNull())
    out = out.withColumn("_size", F.greatest(F.col("_x2") - F.col("_x1"), F.col("_y2") - F.col("_y1")) / cell)
    level = F.when(F.col("_size") > 1, F.least(F.ceil(F.log2("_size")), F.lit(60))).otherwise(0).cast("int")
    out = out.select(*keys, F.struct(*[F.col(n).alias(n[1:]) for n in names], level.alias("level"), F.col("_row").alias("row")).alias(mine))
    return out.withColumn(other, F.lit(None).cast(other_type))


def _row_type(df: DataFrame, keys: list[str]) -> str:
    fields = ",".join(f"`{f.name}`:{f.dataType.simpleString()}" for f in df.schema.fields if f.name not in keys)
    return f"struct<x1:double,y1:double,x2:double,y2:double,level:int,row:struct<{fields}>>"


def cell_pairs(left: DataFrame, right: DataFrame, keys, lbox: tuple[Column, ...], rbox: tuple[Column, ...],
               cell: float, keep_left: bool = False) -> DataFrame:
    """All (left, right) rows with equal keys whose boxes have a common point.

    ``lbox`` and ``rbox`` are the corners (x1, y1, x2, y2) as columns of their side; a point has
    equal corners.  Column names other than ``keys`` must be disjoint.  Rows with
    a null key or corner are in no pair.  With ``keep_left`` every left row (but for
    those with a null key) comes once more without a partner: null right columns."""
    keys = list(keys)
    rows = _side(left, keys, lbox, "_a", "_b", _row_type(right, keys), cell, keep_left).unionByName(
        _side(right, keys, rbox, "_b", "_a", _row_type(left, keys), cell, False))
    rows = rows.repartition(cpu_parallelism(left), *keys)
    rows = rows.select("*", *[F.coalesce(F.col(f"_a.{c}"), F.col(f"_b.{c}")).alias(f"_{c}") for c in ("x1", "y1", "x2", "y2", "level")])
    frame = Window.partitionBy(*keys)
    # sizes are doublings, 60 of them cover any pixel: a frame's levels are the bits of one number
    bit = F.expr("shiftleft(1L, _level)")
    rows = rows.withColumn("_levels", F.bit_or(bit).over(frame)).withColumn("_left", F.count("_a").over(frame)) \
               .withColumn("_all", F.count(F.lit(1)).over(frame))
    rows = rows.where((F.col("_left") > 0) & (F.lit(keep_left) | (F.col("_left") < F.col("_all"))))
    small = F.col("_left") * (F.col("_all") - F.col("_left")) <= SMALL_FRAME
    placed = F.col("_x1").isNotNull() & F.col("_y1").isNotNull() & F.col("_x2").isNotNull() & F.col("_y2").isNotNull()
    # level -1: the place of a left row without partners; level 61: the one cell of a small frame
    own = F.when(small, F.lit(61)).otherwise(F.col("_level"))
    coarsest = F.when(small, F.lit(61)).otherwise(F.floor(F.log2(F.col("_levels").cast("double"))).cast("int"))
    levels = F.sequence(own, coarsest)
    if keep_left:
        levels = F.when(placed, levels).otherwise(F.array().cast("array<int>"))
        levels = F.when(F.col("_a").isNotNull(), F.concat(levels, F.array(F.lit(-1)))).otherwise(levels)
    rows = rows.withColumn("_lv", F.explode(levels))
    rows = rows.where((F.col("_lv") < 0) | (F.col("_lv") == 61) | (F.expr("shiftright(_levels, _lv)") % 2 == 1))
    side = F.lit(float(cell)) * F.pow(F.lit(2.0), F.col("_lv"))
    one = (F.col("_lv") < 0) | (F.col("_lv") == 61)

    def touched(low: str, high: str) -> Column:
        first = F.when(one, F.lit(0).cast("bigint")).otherwise(F.floor(F.col(low) / side))
        last = F.when(one, F.lit(0).cast("bigint")).otherwise(F.floor(F.col(high) / side))
        return F.explode(F.sequence(first, last))

    rows = rows.withColumn("_gx", touched("_x1", "_x2")).withColumn("_gy", touched("_y1", "_y2"))
    # the frame's partitioning serves the cells too: no second shuffle
    met = rows.groupBy(*keys, "_lv", "_gx", "_gy").agg(F.collect_list("_a").alias("_as"), F.collect_list("_b").alias("_bs"))
    met = met.where((F.size("_as") > 0) & ((F.size("_bs") > 0) | (F.col("_lv") < 0)))
    met = met.withColumn("_a", F.explode("_as")).withColumn("_b", F.explode_outer("_bs") if keep_left else F.explode("_bs"))
    x1, y1 = F.greatest("_a.x1", "_b.x1"), F.greatest("_a.y1", "_b.y1")
    meet = (x1 <= F.least("_a.x2", "_b.x2")) & (y1 <= F.least("_a.y2", "_b.y2"))
    first = ((F.col("_lv") == F.greatest("_a.level", "_b.level"))
             & (F.floor(x1 / side) == F.col("_gx")) & (F.floor(y1 / side) == F.col("_gy")))
    return met.where((F.col("_lv") < 0) | (meet & ((F.col("_lv") == 61) | first))).select(*keys, "_a.row.*", "_b.row.*")
