"""Box codings and overlap measures as Catalyst Column expressions.

Codings: ``tlwh`` (top-left x, y, width, height), ``tlbr`` (x1, y1, x2, y2),
``xyah`` (centre x, centre y, aspect w/h, height) and centre-``xywh``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import col, safe_div


def tlwh_to_tlbr(x, y, w, h) -> dict[str, Column]:
    x, y, w, h = map(col, (x, y, w, h))
    return {"x1": x, "y1": y, "x2": x + w, "y2": y + h}


def tlwh_to_xyah(x, y, w, h) -> dict[str, Column]:
    x, y, w, h = map(col, (x, y, w, h))
    return {"cx": x + w / 2, "cy": y + h / 2, "a": safe_div(w, h), "h": h}


def xyah_to_tlwh(cx, cy, a, h) -> dict[str, Column]:
    cx, cy, a, h = map(col, (cx, cy, a, h))
    w = a * h
    return {"x": cx - w / 2, "y": cy - h / 2, "w": w, "h": h}


def xyah_to_tlbr(cx, cy, a, h) -> dict[str, Column]:
    t = xyah_to_tlwh(cx, cy, a, h)
    return tlwh_to_tlbr(t["x"], t["y"], t["w"], t["h"])


def iou_tlwh(ax, ay, aw, ah, bx, by, bw, bh) -> Column:
    """IoU without the +1 pixel convention; intersection sides clamp at 0.
    A zero union gives null instead of nan."""
    ax, ay, aw, ah, bx, by, bw, bh = map(col, (ax, ay, aw, ah, bx, by, bw, bh))
    iw = F.greatest(F.lit(0.0), F.least(ax + aw, bx + bw) - F.greatest(ax, bx))
    ih = F.greatest(F.lit(0.0), F.least(ay + ah, by + bh) - F.greatest(ay, by))
    inter = iw * ih
    return safe_div(inter, aw * ah + bw * bh - inter)
