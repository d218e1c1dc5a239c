"""Box geometry operators: codings, overlap pairs, IoU cost.

Pairs are only ever formed inside a frame and only for boxes that can
overlap (:mod:`.cells`).  Pairs that do not overlap have IoU 0 and cost 1, above
any usable threshold, so they are implied rather than materialised.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import INFTY_COST
from ..functions import boxes as B
from ..functions.common import col
from .cells import cell_pairs

DEFAULT_CELL = 128.0


def convert_boxes(df: DataFrame, from_: str, to: str, cols=None, prefix: str = "") -> DataFrame:
    """Add columns of another box coding.

    ``from_``/``to`` in {tlwh, tlbr, xyah}; input column names default to
    x,y,w,h / x1,y1,x2,y2 / cx,cy,a,h.  A zero height gives a null aspect.
    """
    defaults = {"tlwh": ("x", "y", "w", "h"), "tlbr": ("x1", "y1", "x2", "y2"),
                "xyah": ("cx", "cy", "a", "h")}
    c = cols or defaults[from_]
    if from_ == "tlbr":
        x1, y1, x2, y2 = map(col, c)
        c = (x1, y1, x2 - x1, y2 - y1)
        from_ = "tlwh"
    if (from_, to) == ("tlwh", "tlbr"):
        out = B.tlwh_to_tlbr(*c)
    elif (from_, to) == ("tlwh", "xyah"):
        out = B.tlwh_to_xyah(*c)
    elif (from_, to) == ("xyah", "tlwh"):
        out = B.xyah_to_tlwh(*c)
    elif (from_, to) == ("xyah", "tlbr"):
        out = B.xyah_to_tlbr(*c)
    elif (from_, to) == ("tlwh", "tlwh"):
        out = dict(zip(("x", "y", "w", "h"), map(col, c)))
    else:
        raise ValueError(f"unsupported conversion {from_} -> {to}")
    return df.select("*", *[v.alias(prefix + k) for k, v in out.items()])


def overlapping_pairs(left: DataFrame, right: DataFrame, keys, lbox, rbox,
                      cell: float = DEFAULT_CELL) -> DataFrame:
    """All (left, right) pairs with the same keys whose tlwh boxes intersect
    with positive area; none for w/h <= 0.  Column names other than ``keys``
    must be disjoint."""
    lx, ly, lw, lh = map(col, lbox)
    rx, ry, rw, rh = map(col, rbox)
    pairs = cell_pairs(left.where((lw > 0) & (lh > 0)), right.where((rw > 0) & (rh > 0)), keys,
                       (lx, ly, lx + lw, ly + lh), (rx, ry, rx + rw, ry + rh), cell)
    return pairs.where((F.greatest(lx, rx) < F.least(lx + lw, rx + rw)) & (F.greatest(ly, ry) < F.least(ly + lh, ry + rh)))


def pairwise_iou(left: DataFrame, right: DataFrame, keys=("camera_id", "frame_no"),
                 lbox=("l_x", "l_y", "l_w", "l_h"), rbox=("r_x", "r_y", "r_w", "r_h"),
                 cell: float = DEFAULT_CELL) -> DataFrame:
    """IoU of every overlapping pair in the same frame (tlwh, no +1 pixel)."""
    pairs = overlapping_pairs(left, right, keys, lbox, rbox, cell)
    return pairs.withColumn("iou", B.iou_tlwh(*lbox, *rbox))


def iou_cost(tracks: DataFrame, dets: DataFrame, keys=("camera_id", "frame_no"),
             tbox=("t_x", "t_y", "t_w", "t_h"), dbox=("d_x", "d_y", "d_w", "d_h"),
             tsu: str = "time_since_update", cell: float = DEFAULT_CELL) -> DataFrame:
    """Association cost ``1 - IoU``, or the infeasible cost for tracks not
    updated in the previous frame.  Emits overlapping pairs; all others have
    cost >= 1."""
    p = pairwise_iou(tracks, dets, keys, tbox, dbox, cell)
    return p.withColumn("cost", F.when(col(tsu) > 1, F.lit(INFTY_COST))
                        .otherwise(F.lit(1.0) - F.col("iou")))
