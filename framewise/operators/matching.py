"""Association: costs, gated one-to-one matching, cascade, left-overs.

Matching is optimal per frame.  Feasible edges (cost <= max) are shuffled
once by the frame keys.  An edge that is the only feasible one for both its
track and its detection is settled where it is; the others are cut into the
connected parts of their frame's graph, and the parts, each a key of its own,
go to a small Hungarian solver.  Both branches read the one shuffle.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import boxes as B
from ..functions import motion as KF
from ..functions import vectors as V
from ..session import ship_package, written_once
from .assignment import min_cost_matching
from .cells import cell_pairs
from .motion import mahalanobis_pairs
from .sorted_groups import iter_groups, cpu_parallelism


def association_costs(tracks: DataFrame, gallery: DataFrame, dets: DataFrame,
                      keys=("camera_id", "frame_no"), gallery_keys=("camera_id", "track_id"),
                      track_id: str = "track_id", det_id: str = "det_id", state: str = "kf",
                      z=("d_cx", "d_cy", "d_a", "d_h"), d_feature: str = "d_feature",
                      g_feature: str = "g_feature", only_position: bool = False) -> DataFrame:
    """Appearance cost (nearest cosine distance to the track's gallery) for
    every pair inside the motion gate.  The gate runs first, so vectors are
    compared only for plausible pairs; gated pairs keep the infeasible cost
    implicitly (they are absent)."""
    keys = list(keys)
    gate = mahalanobis_pairs(tracks.select(*keys, track_id, state),
                             dets.select(*keys, det_id, *z, d_feature),
                             keys, z, state, only_position)
    gate = gate.withColumn(d_feature, V.l2_normalize(V.as_double_array(d_feature)))
    g = gallery.select(*gallery_keys, V.l2_normalize(V.as_double_array(g_feature)).alias(g_feature))
    j = gate.join(g, list(gallery_keys))
    j = j.withColumn("_d", V.cosine_distance(d_feature, g_feature, normalized=True))
    return j.groupBy(*keys, track_id, det_id).agg(F.min("_d").alias("cost"))


def _connected_parts(edges: DataFrame, keys, left: str, right: str) -> DataFrame:
    """Contested edges with ``_part``: the number of their connected part within the frame.

    A fold over a frame's contested edges joins each with the parts that it touches."""
    rest = [c for c in edges.columns if c not in keys]
    frames = edges.groupBy(*keys).agg(F.collect_list(F.struct(*rest)).alias("_es"))
    kind = frames.schema["_es"].dataType.simpleString()

    def touches(part, e):
        return F.exists(part, lambda x: (x[left] == e[left]) | (x[right] == e[right]))

    def add(parts, e):
        near = F.filter(parts, lambda p: touches(p, e))
        return F.concat(F.filter(parts, lambda p: ~touches(p, e)), F.array(F.concat(F.flatten(near), F.array(e))))

    parts = F.aggregate("_es", F.array().cast(f"array<{kind}>"), add)
    split = frames.select(*keys, F.posexplode(parts).alias("_part", "_es"))
    return split.select(*keys, "_part", F.inline("_es"))


def _solve_parts(pdf: pd.DataFrame, keys, left, right, cost, limit_of, level) -> pd.DataFrame:
    """Optimal matching of connected parts, level by level on what is still free."""
    won = []
    for _, g in iter_groups(pdf, [*keys, "_part"]):
        li, lefts = pd.factorize(g[left])
        ri, rights = pd.factorize(g[right])
        c = g[cost].to_numpy(dtype=float)
        lv = g[level].to_numpy() if level else np.zeros(len(g), dtype=int)
        took, taken = np.zeros(len(lefts), dtype=bool), np.zeros(len(rights), dtype=bool)
        for x in np.unique(lv):
            e = np.flatnonzero((lv == x) & ~took[li] & ~taken[ri])
            r, row = np.unique(li[e], return_inverse=True)
            k, column = np.unique(ri[e], return_inverse=True)
            m, edge = np.full((len(r), len(k)), np.inf), np.zeros((len(r), len(k)), dtype=int)
            m[row, column], edge[row, column] = c[e], e
            pairs = np.array([edge[i, j] for i, j in min_cost_matching(m, limit_of(x))[0]], dtype=int)
            took[li[pairs]] = taken[ri[pairs]] = True
            won.append(g.index.to_numpy()[pairs])
    return pdf.loc[np.concatenate(won)] if won else pdf.iloc[:0]


def match_min_cost(edges: DataFrame, max_distance: float, keys=("camera_id", "frame_no"),
                   left: str = "track_id", right: str = "det_id", cost: str = "cost",
                   level: str | None = None, other_limits: dict | None = None,
                   keep=()) -> DataFrame:
    """Optimal one-to-one matching per frame over edges with
    ``cost <= max_distance`` (equivalently: maximum total of
    ``max + 1e-5 - cost``).  With ``level`` set, lower levels are matched
    first and later levels only see what is still free (cascade);
    ``other_limits`` gives levels that have a limit of their own.
    Returns the matched pairs with their cost and the ``keep`` columns.  Only contested
    edges reach Python workers, keyed by connected part and not by frame."""
    keys, keep = list(keys), list(keep)
    other = dict(other_limits or {})
    ship_package(edges.sparkSession)
    limit = F.lit(max_distance)
    for at, value in other.items():
        limit = F.when(F.col(level) == at, F.lit(value)).otherwise(limit)
    rest = list(dict.fromkeys([cost] + ([level] if level else []) + keep))
    e = edges.where(F.col(cost) <= limit).withColumn(cost, F.col(cost).cast("double"))
    # one nullable column for the payload: both branches ask for it whole, so that their
    # shuffles are one and the same, whatever columns the caller goes on to use
    e = e.select(*keys, left, right, F.when(F.col(cost).isNotNull(), F.struct(*rest)).alias("_p"))
    tasks = cpu_parallelism(e)
    e = e.repartition(tasks, *keys)
    alone = (F.count(F.lit(1)).over(Window.partitionBy(*keys, left)) == 1) & (F.count(F.lit(1)).over(Window.partitionBy(*keys, right)) == 1)
    e = e.withColumn("_lone", alone).where(F.col("_p").isNotNull())
    out = list(dict.fromkeys(keys + [left, right, cost] + keep))
    settled = e.where(F.col("_lone")).select(*keys, left, right, "_p.*").select(*out)
    parts = _connected_parts(e.where(~F.col("_lone")).drop("_lone"), keys, left, right).select(*keys, "_part", left, right, "_p.*")
    parts = parts.repartition(tasks, *keys, "_part").sortWithinPartitions(*keys, "_part", left, right)

    def limit_of(x):
        return other.get(int(x), max_distance)

    def solve(batches):
        carry = None
        for pdf in batches:
            if carry is not None:
                pdf = pd.concat([carry, pdf], ignore_index=True)
            if not len(pdf):
                continue
            # the last part may go on in the next batch
            last = pdf.iloc[-1]
            tail = np.logical_and.reduce([(pdf[k] == last[k]).to_numpy() for k in [*keys, "_part"]])
            ready, carry = pdf[~tail].reset_index(drop=True), pdf[tail].reset_index(drop=True)
            if len(ready):
                yield _solve_parts(ready, keys, left, right, cost, limit_of, level)[out]
        if carry is not None and len(carry):
            yield _solve_parts(carry, keys, left, right, cost, limit_of, level)[out]

    schema = T.StructType([T.StructField(c, parts.schema[c].dataType) for c in out])
    return settled.unionByName(parts.mapInPandas(solve, schema))


def match_cascade(edges: DataFrame, max_distance: float, level: str = "time_since_update",
                  depth: int = 30, **kw) -> DataFrame:
    """Matching cascade: levels 1..depth of ``level`` in order, each on the
    detections left free by the previous levels."""
    e = edges.where((F.col(level) >= 1) & (F.col(level) <= depth))
    return match_min_cost(e, max_distance, level=level, **kw)


def track_samples(tracks: DataFrame, gallery: DataFrame, gallery_keys=("camera_id", "track_id"), g_feature: str = "g_feature",
                  out: str = "samples") -> DataFrame:
    """``tracks`` with their gallery samples as an array of unit vectors: a track's samples are what
    the tracker holds for it (at most ``budget``, or one a frame of its life)."""
    unit = V.l2_normalize(V.as_double_array(g_feature))
    held = gallery.select(*gallery_keys, unit.alias("_u")).groupBy(*gallery_keys).agg(F.collect_list("_u").alias(out))
    return tracks.join(held, list(gallery_keys), "left")


def match_two_stage(tracks: DataFrame, dets: DataFrame, cfg=None, keys=("camera_id", "frame_no"),
                    track_id: str = "track_id", det_id: str = "det_id", samples: str = "samples",
                    keep=(), cell: float = 128.0) -> DataFrame:
    """Association of one frame's predicted tracks with its detections.

    Stage 1: confirmed tracks, appearance cost inside the motion gate,
    matching cascade by ``time_since_update`` (max ``cfg.max_cosine``).
    Stage 2: unconfirmed tracks plus confirmed ones left over with
    ``time_since_update == 1``, IoU cost on the detections still free
    (max ``cfg.max_iou``).  Returns the union of both stages' matches with
    ``stage`` and the tracks' ``keep`` columns.

    One pass: tracks (with their gallery samples, see :func:`track_samples`) and detections
    are shuffled together by frame, pairs whose gate or box meets a detection come from
    cells, and each pair gives at most one edge: a pair that stage 1 may match and
    does not is never free on both sides for stage 2.  The edges are written once (tracks often come
    from Python stages, which Spark would run again for each use), and both stages are
    levels of one solver over them.

    ``tracks``: keys, track_id, ``kf`` (predicted state), ``state``,
    ``time_since_update``, tlwh ``t_x, t_y, t_w, t_h``, ``samples``.  ``dets``: keys,
    det_id, xyah ``d_cx, d_cy, d_a, d_h``, tlwh ``d_x, d_y, d_w`` and ``d_feature``."""
    from ..config import TrackerConfig

    cfg = cfg or TrackerConfig()
    keys, keep = list(keys), list(keep)
    threshold = KF.gating_threshold(cfg.only_position)
    # the gate needs a state's means and their variances, not all of it; as an exploded row they are computed
    # once, and not again in every test of a corner, which together is more code than a JVM compiles
    row = F.struct(F.col(track_id), KF.project("kf").alias("_proj"), *[F.col(c) for c in ("state", "time_since_update", "t_x", "t_y", "t_w", "t_h", samples)],
                   *[F.col(c).alias(f"_keep_{c}") for c in keep])
    t = tracks.select(*keys, F.inline(F.array(row)))
    d = dets.select(*keys, det_id, "d_cx", "d_cy", "d_a", "d_h", "d_x", "d_y", "d_w",
                    V.l2_normalize(V.as_double_array("d_feature")).alias("d_feature"))
    gate = KF.projected_box("_proj", threshold)
    x, y, x2, y2 = F.col("t_x"), F.col("t_y"), F.col("t_x") + F.col("t_w"), F.col("t_y") + F.col("t_h")
    reach = (F.least(gate[0], x), F.least(gate[1], y), F.greatest(gate[2], x2), F.greatest(gate[3], y2))
    dx, dy, dx2, dy2 = F.col("d_x"), F.col("d_y"), F.col("d_x") + F.col("d_w"), F.col("d_y") + F.col("d_h")
    place = (F.least(dx, dx2, "d_cx"), F.least(dy, dy2, "d_cy"), F.greatest(dx, dx2, "d_cx"), F.greatest(dy, dy2, "d_cy"))
    p = cell_pairs(t, d, keys, reach, place, cell)
    sure, since = F.col("state") == 2, F.col("time_since_update")
    d2 = KF.projected_distance("_proj", "d_cx", "d_cy", "d_a", "d_h", only_position=cfg.only_position)
    nearest = F.array_min(F.transform(samples, lambda s: V.cosine_distance(s, "d_feature", normalized=True)))
    p = p.withColumn("_look", F.when(sure & since.between(1, cfg.max_age) & (d2 <= threshold), nearest))
    meets = (F.greatest(x, dx) < F.least(x2, dx2)) & (F.greatest(y, dy) < F.least(y2, dy2))
    p = p.withColumn("_over", F.when((~sure | (since == 1)) & (since <= 1) & meets,
                                     F.lit(1.0) - B.iou_tlwh("t_x", "t_y", "t_w", "t_h", "d_x", "d_y", "d_w", "d_h")))
    after = cfg.max_age + 1
    edge = F.when(F.col("_look") <= cfg.max_cosine, F.struct(since.cast("int").alias("level"), F.col("_look").alias("cost"))) \
            .when(F.col("_over") <= cfg.max_iou, F.struct(F.lit(after).alias("level"), F.col("_over").alias("cost")))
    e = p.withColumn("_e", edge).where(F.col("_e").isNotNull()).select(
        *keys, track_id, det_id, "_e.cost", F.col("_e.level").alias("_level"), *[F.col(f"_keep_{c}").alias(c) for c in keep])
    m = match_min_cost(written_once(e, "edges"), cfg.max_cosine, keys=keys, left=track_id, right=det_id, level="_level",
                       other_limits={after: cfg.max_iou}, keep=["_level", *keep])
    return m.select(*keys, track_id, det_id, "cost", F.when(F.col("_level") == after, 2).otherwise(1).alias("stage"), *keep)


def unmatched_sides(tracks: DataFrame, dets: DataFrame, matches: DataFrame,
                    keys=("camera_id", "frame_no"), track_id: str = "track_id",
                    det_id: str = "det_id") -> tuple[DataFrame, DataFrame]:
    """Tracks and detections without a match.

    Tracks, detections and both ends of every match are shuffled together once by
    frame; a row stays if no match shares its id.  Both results read that one shuffle."""
    keys = list(keys)
    t_type, d_type = tracks.schema[track_id].dataType, dets.schema[det_id].dataType

    def rows(df, mine, other, own, row, other_row, other_type, other_row_type):
        return df.select(*keys, F.col(own).alias(mine), F.lit(None).cast(other_type).alias(other),
                         F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in keys]).alias(row),
                         F.lit(None).cast(other_row_type).alias(other_row), F.lit(0).alias("_m"))

    t_row = T.StructType([f for f in tracks.schema.fields if f.name not in keys])
    d_row = T.StructType([f for f in dets.schema.fields if f.name not in keys])
    t = rows(tracks, "_t", "_d", track_id, "_trow", "_drow", d_type, d_row)
    d = rows(dets, "_d", "_t", det_id, "_drow", "_trow", t_type, t_row)
    ends = F.array(F.struct(F.col(track_id).cast(t_type).alias("_t"), F.lit(None).cast(d_type).alias("_d")),
                   F.struct(F.lit(None).cast(t_type).alias("_t"), F.col(det_id).cast(d_type).alias("_d")))
    m = matches.select(*keys, F.inline(ends)).select(
        *keys, "_t", "_d", F.lit(None).cast(t_row).alias("_trow"), F.lit(None).cast(d_row).alias("_drow"), F.lit(1).alias("_m"))
    every = t.unionByName(d).unionByName(m).repartition(*keys)
    every = every.withColumn("_used", F.max("_m").over(Window.partitionBy(*keys, "_t", "_d")))
    free = every.where((F.col("_used") == 0) & (F.col("_m") == 0))
    return (free.where(F.col("_trow").isNotNull()).select(*keys, "_trow.*"),
            free.where(F.col("_drow").isNotNull()).select(*keys, "_drow.*"))
