"""Detector geometry and post-processing as DataFrame operations.

Grid predictions are rows ``(image_id, level, gy, gx, anchor_id, logits)``;
anchors and class names are tiny fixed dimensions, applied as literal
arrays or broadcast joins of a proven size (9 and 80 rows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import ANCHOR_MASK, COCO_CLASSES, DEFAULT_ANCHORS, LEVEL_STRIDES
from ..functions.common import col, sigmoid
from .cells import cell_pairs
from .nms import greedy_fold
from .sorted_groups import cpu_parallelism


def classes_frame(spark: SparkSession, names=COCO_CLASSES) -> DataFrame:
    return spark.createDataFrame(list(enumerate(names)), "class_id int, class_name string")


def _level_of_anchor(anchor_id: Column) -> Column:
    expr = None
    for lvl, ids in enumerate(ANCHOR_MASK):
        cond = anchor_id.isin(ids)
        expr = F.when(cond, F.lit(lvl)) if expr is None else expr.when(cond, F.lit(lvl))
    return expr


def _grid(level: Column, input_size: int) -> Column:
    return F.element_at(F.array(*[F.lit(input_size // s) for s in LEVEL_STRIDES]), level + 1)


def decode_grid_predictions(raw: DataFrame, anchors=DEFAULT_ANCHORS, input_size=(416, 416),
                            logits: str = "logits") -> DataFrame:
    """Box centre/size (relative to the input), objectness and per-class
    probabilities from raw logits: xy = (sigmoid(t) + cell) / grid,
    wh = exp(t) * anchor / input, probabilities = sigmoid."""
    in_h, in_w = input_size
    aw = F.element_at(F.array(*[F.lit(float(a[0])) for a in anchors]), F.col("anchor_id") + 1)
    ah = F.element_at(F.array(*[F.lit(float(a[1])) for a in anchors]), F.col("anchor_id") + 1)
    t = F.col(logits)
    lvl = F.col("level")
    return raw.select(
        "*",
        ((sigmoid(t[0]) + F.col("gx")) / _grid(lvl, in_w)).alias("bx"),
        ((sigmoid(t[1]) + F.col("gy")) / _grid(lvl, in_h)).alias("by"),
        (F.exp(t[2]) * aw / in_w).alias("bw"),
        (F.exp(t[3]) * ah / in_h).alias("bh"),
        sigmoid(t[4]).alias("objectness"),
        F.transform(F.slice(t, 6, 1 << 20), lambda v: sigmoid(v)).alias("class_probs"))


def unletterbox_boxes(df: DataFrame, image_w: str = "image_w", image_h: str = "image_h",
                      input_size=(416, 416)) -> DataFrame:
    """Map relative input boxes back to image pixels (undo letterboxing):
    ``new = round_half_even(image * min(input / image))``, offset and
    scale per axis, corners times image size.  Adds y1, x1, y2, x2."""
    in_h, in_w = float(input_size[0]), float(input_size[1])
    ih, iw = col(image_h).cast("double"), col(image_w).cast("double")
    ratio = F.least(F.lit(in_h) / ih, F.lit(in_w) / iw)
    new_h, new_w = F.bround(ih * ratio, 0), F.bround(iw * ratio, 0)
    off_y, off_x = (F.lit(in_h) - new_h) / 2 / in_h, (F.lit(in_w) - new_w) / 2 / in_w
    sc_y, sc_x = F.lit(in_h) / new_h, F.lit(in_w) / new_w
    cy, cx = (F.col("by") - off_y) * sc_y, (F.col("bx") - off_x) * sc_x
    hh, ww = F.col("bh") * sc_y, F.col("bw") * sc_x
    return df.select("*", ((cy - hh / 2) * ih).alias("y1"), ((cx - ww / 2) * iw).alias("x1"),
                     ((cy + hh / 2) * ih).alias("y2"), ((cx + ww / 2) * iw).alias("x2"))


def score_candidates(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """One row per (box, class) with ``score = objectness * p >= threshold``;
    a box may survive under several classes."""
    base = [c for c in df.columns if c != "class_probs"]
    e = df.select(*base, F.posexplode("class_probs").alias("class_id", "_p"))
    return e.withColumn("score", F.col("objectness") * F.col("_p")).where(F.col("score") >= threshold) \
            .drop("_p")


def filter_class(dets: DataFrame, classes: DataFrame, names=("person",)) -> DataFrame:
    """Keep boxes whose class name is in ``names`` (80-row dimension,
    broadcast)."""
    keep = classes.where(F.col("class_name").isin(list(names))).select("class_id", "class_name")
    return dets.join(F.broadcast(keep), "class_id")


def nms_per_class_topk(cands: DataFrame, iou_threshold: float = 0.5, max_boxes: int = 20,
                       image: str = "image_id", id_col: str = "vec_id") -> DataFrame:
    """Greedy NMS per (image, class): highest score first, suppress IoU
    (no +1 pixel) > threshold, at most ``max_boxes`` kept per class."""
    return greedy_fold(cands, [image, "class_id"], id_col, "score", "x1", "y1", "x2", "y2",
                       iou_threshold, measure="iou", max_keep=max_boxes)


def detector_box_to_tlwh(df: DataFrame) -> DataFrame:
    """Integer tlwh from corners: truncate toward zero, then shift negative
    x/y to 0 and shrink w/h by the overshoot (no right/bottom clipping)."""
    x, y = F.col("x1").cast("int"), F.col("y1").cast("int")
    w, h = (F.col("x2") - F.col("x1")).cast("int"), (F.col("y2") - F.col("y1")).cast("int")
    return df.select("*", F.greatest(x, F.lit(0)).alias("x"), F.greatest(y, F.lit(0)).alias("y"),
                     F.when(x < 0, w + x).otherwise(w).alias("w"),
                     F.when(y < 0, h + y).otherwise(h).alias("h"))


def detect_from_raw(raw: DataFrame, images: DataFrame, classes: DataFrame,
                    anchors=DEFAULT_ANCHORS, input_size=(416, 416), score_threshold: float = 0.5,
                    iou_threshold: float = 0.5, max_boxes: int = 20, names=("person",)) -> DataFrame:
    """Raw predictions to integer boxes of the wanted classes.

    The class filter commutes with per-class NMS, so it runs before it
    (the other classes never reach the shuffle).  ``det_id`` numbers the
    surviving boxes per image in reverse detector order (class descending,
    pick order descending), as the pipeline lists them."""
    d = decode_grid_predictions(raw, anchors, input_size)
    d = d.join(images.select("image_id", "image_w", "image_h"), "image_id")
    d = unletterbox_boxes(d, input_size=input_size)
    c = score_candidates(d.drop("logits"), score_threshold)
    c = filter_class(c, classes, names)
    kept = nms_per_class_topk(c, iou_threshold, max_boxes)
    t = detector_box_to_tlwh(kept)
    w = Window.partitionBy("image_id").orderBy(F.col("class_id").desc(), F.col("pick").desc())
    return t.withColumn("det_id", F.row_number().over(w).cast("bigint"))


def letterbox_geometry(frames: DataFrame, size=(416, 416), width: str = "width",
                       height: str = "height", fixed: bool = True) -> DataFrame:
    """Resize-and-pad geometry of the detector input: scale, resized size
    (truncated), paste offset; with ``fixed=False`` the target is the image
    floored to multiples of 32."""
    iw, ih = F.col(width), F.col(height)
    if fixed:
        tw, th = F.lit(size[0]), F.lit(size[1])
    else:
        tw, th = iw - iw % 32, ih - ih % 32
    s = F.least(tw.cast("double") / iw, th.cast("double") / ih)
    new_w, new_h = (iw * s).cast("int"), (ih * s).cast("int")
    return frames.select("*", tw.alias("target_w"), th.alias("target_h"), s.alias("scale"),
                         new_w.alias("new_w"), new_h.alias("new_h"),
                         F.floor((tw - new_w) / 2).cast("int").alias("offset_x"),
                         F.floor((th - new_h) / 2).cast("int").alias("offset_y"))


def crop_window(dets: DataFrame, width: str = "width", height: str = "height",
                patch=(128, 64), integer_input: bool = True, prefix: str = "crop_") -> DataFrame:
    """Crop window of the appearance encoder: widen/narrow the box to the
    patch aspect around its centre, truncate to int, clip to the image; an
    empty window is null.  Integer boxes truncate x and w before forming the
    corners, float boxes only after (as the two input paths do)."""
    aspect = float(patch[1]) / patch[0]
    x, y, w, h = (F.col(c).cast("double") for c in ("x", "y", "w", "h"))
    new_w = F.lit(aspect) * h
    if integer_input:
        x1 = (x - (new_w - w) / 2).cast("int")
        ww = new_w.cast("int")
        x2, y1, y2 = x1 + ww, y.cast("int"), (y + h).cast("int")
    else:
        xf = x - (new_w - w) / 2
        x1, y1 = xf.cast("int"), y.cast("int")
        x2, y2 = (xf + new_w).cast("int"), (y + h).cast("int")
    cx1, cy1 = F.greatest(x1, F.lit(0)), F.greatest(y1, F.lit(0))
    cx2, cy2 = F.least(F.col(width) - 1, x2), F.least(F.col(height) - 1, y2)
    empty = (cx1 >= cx2) | (cy1 >= cy2)
    out = {"x1": cx1, "y1": cy1, "x2": cx2, "y2": cy2}
    return dets.select("*", *[F.when(empty, F.lit(None)).otherwise(v).cast("int").alias(prefix + k)
                              for k, v in out.items()])


def best_anchor_shape(truths: DataFrame, anchors=DEFAULT_ANCHORS, w: str = "bw_px",
                      h: str = "bh_px") -> DataFrame:
    """Anchor whose shape best overlaps the box (both centred at the origin);
    first anchor wins ties.  The 9 anchors are a literal array, so this is a
    projection, not a join."""
    bw, bh = F.col(w), F.col(h)
    scored, cols = truths, truths.columns
    for i, (aw, ah) in enumerate(anchors):
        inter = F.least(bw, F.lit(float(aw))) * F.least(bh, F.lit(float(ah)))
        scored = scored.withColumn(f"_iou{i}", inter / (bw * bh + F.lit(float(aw)) * F.lit(float(ah)) - inter))
    # plain columns in steps, not an array of structs: compiled, and each overlap is computed once
    ious = [F.col(f"_iou{i}") for i in range(len(anchors))]
    scored = scored.withColumn("_best", F.greatest(*ious) if len(ious) > 1 else ious[0])
    best = F.coalesce(*[F.when(v.eqNullSafe(F.col("_best")), F.lit(i)) for i, v in enumerate(ious)])
    return scored.select(*[F.col(f"`{c}`") for c in cols], best.alias("anchor_id"), F.col("_best").alias("anchor_iou"))


def best_truth_iou(preds: DataFrame, truths: DataFrame, keys=("image_id",), ignore: float = 0.5,
                   pred_id: str = "vec_id", cell: float = 0.125) -> DataFrame:
    """Best IoU of each prediction with any true box of the same image (both
    centre-xywh, relative units) and ``ignore = best < threshold``.  Only
    overlapping pairs are formed (cells); a prediction with none has best IoU 0.
    Predictions travel through the pass, so they are read once; ``pred_id`` must be unique
    within the keys, and rows with a null key are left out."""
    keys = list(keys)
    p = preds.select(*keys, F.col(pred_id).alias("_id"), F.struct(*[F.col(f"`{c}`") for c in preds.columns]).alias("_pred"),
                     (F.col("bx") - F.col("bw") / 2).alias("_px"), (F.col("by") - F.col("bh") / 2).alias("_py"),
                     (F.col("bx") + F.col("bw") / 2).alias("_px2"), (F.col("by") + F.col("bh") / 2).alias("_py2"))
    t = truths.where((F.col("tw") > 0) & (F.col("th") > 0)).select(
        *keys, (F.col("tx") - F.col("tw") / 2).alias("_tx"), (F.col("ty") - F.col("th") / 2).alias("_ty"),
        (F.col("tx") + F.col("tw") / 2).alias("_tx2"), (F.col("ty") + F.col("th") / 2).alias("_ty2"))
    pairs = cell_pairs(p, t, keys, tuple(map(F.col, ("_px", "_py", "_px2", "_py2"))),
                       tuple(map(F.col, ("_tx", "_ty", "_tx2", "_ty2"))), cell, keep_left=True)
    iw = F.least("_px2", "_tx2") - F.greatest("_px", "_tx")
    ih = F.least("_py2", "_ty2") - F.greatest("_py", "_ty")
    inter = iw * ih
    iou = inter / ((F.col("_px2") - F.col("_px")) * (F.col("_py2") - F.col("_py"))
                   + (F.col("_tx2") - F.col("_tx")) * (F.col("_ty2") - F.col("_ty")) - inter)
    best = pairs.groupBy(*keys, "_id").agg(
        F.max(F.when((iw > 0) & (ih > 0), iou)).alias("best_iou"), F.first(F.when(F.col("_tx").isNull(), F.col("_pred")), True).alias("_pred"))
    out = best.select("_pred.*", F.coalesce("best_iou", F.lit(0.0)).alias("best_iou"))
    return out.withColumn("ignore", F.col("best_iou") < ignore)


def assign_truth_to_anchors(truths: DataFrame, anchors=DEFAULT_ANCHORS, input_size=(416, 416)) -> DataFrame:
    """Sparse training targets: one row per (image, level, j, i, k) cell that
    holds a true box.  Centre = floor((min + max) / 2), size = max - min, both
    relative to the input; best anchor by shape; the later box of a cell
    gives the coordinates, class bits accumulate."""
    in_h, in_w = input_size
    t = truths.where(F.col("x2") - F.col("x1") > 0)
    t = t.select("*", (F.col("x2") - F.col("x1")).alias("bw_px"), (F.col("y2") - F.col("y1")).alias("bh_px"),
                 (F.floor((F.col("x1") + F.col("x2")) / 2) / in_w).alias("tx"),
                 (F.floor((F.col("y1") + F.col("y2")) / 2) / in_h).alias("ty"))
    t = t.withColumn("tw", F.col("bw_px") / in_w).withColumn("th", F.col("bh_px") / in_h)
    t = best_anchor_shape(t)
    lvl = _level_of_anchor(F.col("anchor_id"))
    k = F.col("anchor_id") - F.element_at(F.array(*[F.lit(m[0]) for m in ANCHOR_MASK]), lvl + 1)
    t = t.withColumn("level", lvl).withColumn("k", k)
    t = t.withColumn("i", F.floor(F.col("tx") * _grid(F.col("level"), in_w)).cast("int")) \
         .withColumn("j", F.floor(F.col("ty") * _grid(F.col("level"), in_h)).cast("int"))
    keys = ["image_id", "level", "j", "i", "k"]
    # a fixed count: few bytes of boxes would be put together into a few long tasks with much memory
    t = t.repartition(cpu_parallelism(t), *keys)
    return t.groupBy(*keys).agg(*[F.max_by(c, "box_no").alias(c) for c in ("tx", "ty", "tw", "th")],
                                F.array_sort(F.collect_set("class_id")).alias("classes"))


def _with_anchor_place(decoded: DataFrame) -> DataFrame:
    """Predictions with ``k``, the place of their anchor within its level."""
    return decoded.withColumn("k", F.col("anchor_id") - F.element_at(
        F.array(*[F.lit(m[0]) for m in ANCHOR_MASK]), F.col("level") + 1))


def truths_without_prediction(decoded: DataFrame, targets: DataFrame) -> DataFrame:
    """Targets whose cell and anchor have no prediction row: a sparse grid leaves them out of
    :func:`detector_loss`, a whole grid has none."""
    cells = _with_anchor_place(decoded).select("image_id", "level", F.col("gy").alias("j"), F.col("gx").alias("i"), "k")
    return targets.join(cells, ["image_id", "level", "j", "i", "k"], "left_anti")


def detector_loss(decoded: DataFrame, targets: DataFrame, input_size=(416, 416)) -> DataFrame:
    """Per image and level: box, objectness and class loss over the given
    prediction rows (sparse grid; see :func:`truths_without_prediction`), which carry the ``ignore`` flag of
    :func:`best_truth_iou`, with targets from :func:`assign_truth_to_anchors`."""
    in_h, in_w = input_size
    keys = ["image_id", "level"]
    p = _with_anchor_place(decoded)
    tg = targets.select("image_id", "level", F.col("j").alias("gy"), F.col("i").alias("gx"), "k",
                        "tx", "ty", "tw", "th", "classes", F.lit(1.0).alias("obj"))
    j = p.join(tg, ["image_id", "level", "gy", "gx", "k"], "left")
    obj = F.coalesce(F.col("obj"), F.lit(0.0))
    gw, gh = _grid(F.col("level"), in_w), _grid(F.col("level"), in_h)
    dx, dy = (F.col("tx") - F.col("bx")) * gw, (F.col("ty") - F.col("by")) * gh
    dw, dh = F.log(F.col("tw")) - F.log(F.col("bw")), F.log(F.col("th")) - F.log(F.col("bh"))
    scale = F.lit(2.0) - F.col("tw") * F.col("th")
    box = F.when(obj > 0, (dx * scale) ** 2 + (dy * scale) ** 2 + (dw * scale) ** 2 + (dh * scale) ** 2) \
           .otherwise(F.lit(0.0))
    pconf = F.col("objectness")
    ign = F.when(F.coalesce(F.col("ignore"), F.lit(True)), F.lit(1.0)).otherwise(F.lit(0.0))
    conf = obj * (1 - pconf) ** 2 + (1 - obj) * pconf ** 2 * ign
    cls = F.when(obj > 0, F.aggregate(
        F.transform(F.col("class_probs"),
                    lambda p_, c: (F.when(F.array_contains(F.col("classes"), c), F.lit(1.0)).otherwise(F.lit(0.0)) - p_) ** 2),
        F.lit(0.0), lambda a, b: a + b)).otherwise(F.lit(0.0))
    return j.groupBy(*keys).agg(F.sum(box).alias("box_loss"), F.sum(conf).alias("conf_loss"),
                                F.sum(cls).alias("class_loss"))


def batch_loss(losses: DataFrame) -> DataFrame:
    """One row: the losses of :func:`detector_loss` summed over all levels and
    parts, divided by the number of images."""
    total = F.sum(F.col("box_loss") + F.col("conf_loss") + F.col("class_loss"))
    return losses.agg(F.count_distinct("image_id").alias("n_images"), (total / F.count_distinct("image_id")).alias("loss"))
