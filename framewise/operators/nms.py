"""Greedy non-maximum suppression, per frame and per (image, class).

Each frame's boxes are gathered once (a frame is bounded: the detector emits
at most ``max_boxes`` per class), sorted, and folded with ``aggregate``: a box
survives iff no box kept before it overlaps it beyond the threshold.  No
Python worker is involved; the fold runs inside the JVM.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.common import col


def _own_area_overlap(p, c):
    """Intersection with the kept box p over c's own area, +1 pixel sides."""
    w = F.greatest(F.lit(0.0), F.least(p["x2"], c["x2"]) - F.greatest(p["x1"], c["x1"]) + 1)
    h = F.greatest(F.lit(0.0), F.least(p["y2"], c["y2"]) - F.greatest(p["y1"], c["y1"]) + 1)
    return F.try_divide(w * h, (c["x2"] - c["x1"] + 1) * (c["y2"] - c["y1"] + 1))


def _iou(p, c):
    """Symmetric IoU of corner boxes, no +1 pixel."""
    w = F.greatest(F.lit(0.0), F.least(p["x2"], c["x2"]) - F.greatest(p["x1"], c["x1"]))
    h = F.greatest(F.lit(0.0), F.least(p["y2"], c["y2"]) - F.greatest(p["y1"], c["y1"]))
    inter = w * h
    area_p = (p["x2"] - p["x1"]) * (p["y2"] - p["y1"])
    area_c = (c["x2"] - c["x1"]) * (c["y2"] - c["y1"])
    return F.try_divide(inter, area_p + area_c - inter)


def greedy_fold(df: DataFrame, keys, id_col: str, rank_desc, x1, y1, x2, y2,
                threshold: float, measure: str = "own_area",
                max_keep: int | None = None) -> DataFrame:
    """Generic greedy suppression: rank by ``rank_desc`` (then id desc), keep
    a box unless a kept box overlaps it by more than ``threshold``; stop at
    ``max_keep`` kept boxes.  The row rides along inside the fold, so no join
    back is needed.  Returns kept rows with ``pick`` (0-based)."""
    keys = list(keys)
    overlap = _own_area_overlap if measure == "own_area" else _iou
    item = F.struct(
        (-col(rank_desc)).alias("o1"), (-col(id_col)).alias("o2"),
        col(id_col).alias("id"),
        col(x1).cast("double").alias("x1"), col(y1).cast("double").alias("y1"),
        col(x2).cast("double").alias("x2"), col(y2).cast("double").alias("y2"),
        F.struct(*[c for c in df.columns if c not in keys and not c.startswith("_")]).alias("row"))
    grouped = df.groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias("_boxes"))
    empty = F.array_compact(F.array(F.lit(None).cast(grouped.schema["_boxes"].dataType.elementType)))

    def step(kept, c):
        hit = F.exists(kept, lambda p: F.coalesce(overlap(p, c) > threshold, F.lit(False)))
        full = F.size(kept) >= max_keep if max_keep is not None else F.lit(False)
        return F.when(hit | full, kept).otherwise(F.concat(kept, F.array(c)))

    kept = grouped.select(*keys, F.aggregate("_boxes", empty, step).alias("_kept"))
    out = kept.select(*keys, F.posexplode("_kept").alias("pick", "_b"))
    return out.select(*keys, "_b.row.*", "pick")


def nms_per_frame(dets: DataFrame, max_overlap: float = 1.0, by: str = "score",
                  keys=("camera_id", "frame_no"), id_col: str = "det_id",
                  box=("x", "y", "w", "h"), score: str = "score") -> DataFrame:
    """Greedy NMS on tlwh boxes: highest score first (``by="bottom"``: largest
    bottom edge first); a box is dropped when its intersection with a kept
    box, over its own area (+1 pixel sides), exceeds ``max_overlap``.  Ties go
    to the larger id.  Returns the surviving rows with their ``pick`` order."""
    x, y, w, h = map(col, box)
    rank = col(score) if by == "score" else (y + h)
    if max_overlap >= 1.0:
        # The intersection never exceeds a box's own (+1) area, and degenerate
        # boxes give 0 or null, so nothing can be suppressed: only the pick
        # order remains, a ranking without gathering the frame.
        w_ = Window.partitionBy(*keys).orderBy(rank.desc(), col(id_col).desc())
        return dets.withColumn("pick", (F.row_number().over(w_) - 1).cast("int"))
    tmp = dets.withColumn("_rank", rank).withColumn("_x2", x + w).withColumn("_y2", y + h)
    return greedy_fold(tmp, keys, id_col, "_rank", box[0], box[1], "_x2", "_y2", max_overlap)
