"""Appearance vectors: normalisation, pair distances, nearest-sample distance,
gallery maintenance, detection assembly.

Pairs are formed only within a blocking key (camera, or camera and frame);
each side is normalised once before the join, never per pair.  The left side of a
key is dealt to ``slices`` tasks, so a camera that holds a third of all rows is not one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vectors as V
from .sorted_groups import cpu_parallelism


def l2_normalize(df: DataFrame, column: str, eps: float | None = None,
                 out: str | None = None) -> DataFrame:
    """``v / sqrt(eps + sum v^2)`` (model output) or ``v / ||v||`` (eps None)."""
    return df.withColumn(out or column, V.l2_normalize(V.as_double_array(column), eps))


def sliced_join(a: DataFrame, b: DataFrame, on, a_part: Column, slices: int) -> DataFrame:
    """Inner join on ``on`` with each key's left rows dealt to ``slices`` groups by ``a_part``
    and the right rows sent to each of them."""
    left = a.withColumn("_slice", F.pmod(F.xxhash64(a_part), F.lit(slices)).cast("int"))
    right = b.withColumn("_slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    keys, tasks = [*on, "_slice"], cpu_parallelism(a)
    return left.repartition(tasks, *keys).join(right.repartition(tasks, *keys), keys).drop("_slice")


def cosine_distance_pairs(a: DataFrame, b: DataFrame, on, a_vec: str = "a_feature",
                          b_vec: str = "b_feature", normalized: bool = False,
                          out: str = "distance", slices: int = 8) -> DataFrame:
    """``1 - cos`` for every pair sharing the blocking key ``on``."""
    if not normalized:
        a = l2_normalize(a, a_vec)
        b = l2_normalize(b, b_vec)
    return sliced_join(a, b, on, F.col(a_vec), slices).withColumn(out, V.cosine_distance(a_vec, b_vec, normalized=True))


def squared_euclidean_pairs(a: DataFrame, b: DataFrame, on, a_vec: str = "a_feature",
                            b_vec: str = "b_feature", out: str = "distance", slices: int = 8) -> DataFrame:
    """Squared Euclidean distance (clamped at 0, no root) per pair."""
    return sliced_join(a, b, on, F.col(a_vec), slices).withColumn(
        out, V.squared_euclidean(V.as_double_array(a_vec), V.as_double_array(b_vec)))


#: Slack of the triangle inequality for rounding.
_SLACK = 1e-9


def _gaps(vec, pivots) -> Column:
    """Distances from a vector to each of an array of vectors."""
    return F.transform(pivots, lambda p: F.sqrt(V.squared_euclidean(vec, p)))


def nearest_gallery_distance(queries: DataFrame, gallery: DataFrame, metric: str = "cosine",
                             on=("camera_id",), query_id: str = "query_id",
                             target_id: str = "target_id", q_vec: str = "q_feature",
                             g_vec: str = "g_feature", pivots: int = 8, slices: int = 8,
                             max_distance: float | None = None, with_work: bool = False) -> DataFrame:
    """Per (query, target): smallest distance to any stored sample of the
    target, in the blocking key ``on``.

    Exact, with pruning by the triangle inequality (for cosine on unit vectors, whose
    squared distance is twice the cosine distance).  Each target has up to ``pivots`` of its samples,
    picked by hash, as pivots; a sample belongs to the tile of the nearest one and
    knows its distance to all.  A tile keeps the least and greatest of these distances.  A query is
    compared with a target's pivots; from those distances every tile has a bound
    from below and one from above.  Tiles whose lower bound exceeds the target's best upper bound are
    left out, and so are, one by one, samples of the other tiles.  Vectors are
    compared for what is left.

    With ``max_distance`` pairs beyond it are left out too (implied infeasible), which also
    prunes whole targets.  ``with_work`` adds ``compared``: vectors that the query was compared with."""
    if metric not in ("cosine", "euclidean"):
        raise ValueError(f"unknown distance {metric!r}: use 'cosine' or 'euclidean'")
    on = list(on)
    mine = [*on, target_id]
    unit = (lambda c: V.l2_normalize(V.as_double_array(c))) if metric == "cosine" else V.as_double_array
    samples = gallery.select(*mine, unit(g_vec).alias("_g")).where(F.col("_g").isNotNull())
    # a window group limit: only ``pivots`` rows of a target and map task are shuffled
    by_hash = Window.partitionBy(*mine).orderBy(F.xxhash64("_g"), "_g")
    chosen = samples.withColumn("_n", F.row_number().over(by_hash)).where(F.col("_n") <= pivots)
    chosen = chosen.groupBy(*mine).agg(F.transform(F.sort_array(F.collect_list(F.struct("_n", "_g"))), lambda x: x["_g"]).alias("_pivots"))
    samples = samples.join(chosen, mine).withColumn("_r", _gaps("_g", F.col("_pivots")))
    nearest = F.array_min(F.transform("_r", lambda r, i: F.struct(r.alias("r"), i.alias("i"))))
    samples = samples.select(*mine, "_g", "_r", nearest["i"].alias("_tile"))
    span = [f(F.get("_r", F.lit(i))) for f in (F.min, F.max) for i in range(pivots)]
    tiles = samples.groupBy(*mine, "_tile").agg(F.array(*span[:pivots]).alias("low"), F.array(*span[pivots:]).alias("high"))
    tiles = tiles.groupBy(*mine).agg(F.collect_list(F.struct("_tile", "low", "high")).alias("_tiles"))
    targets = chosen.join(tiles, mine)

    q = queries.select(*on, query_id, unit(q_vec).alias("_q"))
    pair = sliced_join(q, targets, on, F.col(query_id), slices).withColumn("_d", _gaps("_q", F.col("_pivots")))

    def least(t):
        outside = F.zip_with(F.zip_with("_d", t["high"], lambda d, h: d - h), F.zip_with("_d", t["low"], lambda d, m: m - d), lambda a, b: F.greatest(a, b))
        return F.greatest(F.lit(0.0), F.array_max(outside))

    most = F.array_min(F.transform("_tiles", lambda t: F.array_min(F.zip_with("_d", t["low"], lambda d, m: d + m))))
    if max_distance is not None:
        most = F.least(most, F.lit(math.sqrt(2 * max_distance if metric == "cosine" else max_distance)))
    pair = pair.withColumn("_reach", most + _SLACK)
    left = pair.select(*mine, query_id, "_q", "_d", "_reach", F.size("_pivots").alias("_np"),
                       F.explode(F.transform(F.filter("_tiles", lambda t: least(t) <= F.col("_reach")), lambda t: t["_tile"])).alias("_tile"))
    tasks, tile = cpu_parallelism(gallery), [*mine, "_tile"]
    both = left.repartition(tasks, *tile).join(samples.repartition(tasks, *tile), tile)
    both = both.where(F.array_max(F.zip_with("_d", "_r", lambda d, r: F.abs(d - r))) <= F.col("_reach"))
    exact = V.cosine_distance("_q", "_g", normalized=True) if metric == "cosine" else V.squared_euclidean("_q", "_g")
    out = both.groupBy(*mine, query_id).agg(F.min(exact).alias("distance"), (F.count(F.lit(1)) + F.max("_np")).alias("compared"))
    if max_distance is not None:
        out = out.where(F.col("distance") <= max_distance)
    return out if with_work else out.drop("compared")


def gallery_update(samples: DataFrame, new: DataFrame, active: DataFrame,
                   budget: int | None = None, target_keys=("camera_id", "target_id"),
                   seq: str = "seq") -> DataFrame:
    """Append new samples, keep the last ``budget`` per target (by ``seq``),
    then keep only active targets.  ``budget=None`` keeps all samples.

    The row_number filter is planned as a window group limit, so only
    ``budget`` rows per target and map task cross the shuffle."""
    if budget is not None and budget <= 0:
        raise ValueError("budget must be positive or None")
    keys = list(target_keys)
    allrows = samples.unionByName(new)
    kept = allrows.join(active.select(*keys).distinct(), keys, "left_semi")
    if budget is None:
        return kept
    w = Window.partitionBy(*keys).orderBy(F.col(seq).desc())
    return kept.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= budget).drop("_rn")


def build_detections(boxes: DataFrame, features: DataFrame, keys=("camera_id", "frame_no", "det_id"),
                     confidence: float = 1.0) -> DataFrame:
    """Zip boxes and features of the same detection; confidence is set to the
    pipeline's constant while the detector score is kept as ``score``."""
    return boxes.join(features, list(keys)).withColumn("confidence", F.lit(confidence))

