"""Registered queries: detector decoding and post-processing, encoder
geometry and batched scoring, label assignment and loss."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT_ANCHORS
from ..functions.common import round6
from ..operators import detector as D
from ..operators import inference as INF
from ..operators import vectors as VO
from ..operators.sorted_groups import cpu_parallelism
from ..session import written_once
from .fixtures import duck_with, fixture
from .registry import query

AW = "[" + ", ".join(str(float(a[0])) for a in DEFAULT_ANCHORS) + "]"
AH = "[" + ", ".join(str(float(a[1])) for a in DEFAULT_ANCHORS) + "]"
GRID = "[13, 26, 52]"


def raw_images(raw):
    """Image sizes for the prediction fixture, derived from the image id."""
    return raw.select("image_id").distinct().select(
        "image_id", (F.lit(320) + (F.col("image_id") % 4) * 160).cast("int").alias("image_w"),
        (F.lit(240) + (F.col("image_id") % 3) * 120).cast("int").alias("image_h"))


DEC_SQL = f"""
, dec as (select r.vec_id, r.image_id, r.level, r.gy, r.gx, r.anchor_id,
                 (1.0 / (1.0 + exp(-r.logits[1])) + r.gx) / {GRID}[r.level + 1] as bx,
                 (1.0 / (1.0 + exp(-r.logits[2])) + r.gy) / {GRID}[r.level + 1] as "by",
                 exp(r.logits[3]) * {AW}[r.anchor_id + 1] / 416 as bw,
                 exp(r.logits[4]) * {AH}[r.anchor_id + 1] / 416 as bh,
                 1.0 / (1.0 + exp(-r.logits[5])) as objectness,
                 list_transform(r.logits[6:], lambda v: 1.0 / (1.0 + exp(-v))) as class_probs
          from fx_raw r),
img as (select distinct image_id, cast(320 + (image_id % 4) * 160 as int) as image_w,
               cast(240 + (image_id % 3) * 120 as int) as image_h from fx_raw),
ul0 as (select d.*, i.image_w, i.image_h,
               round_even(i.image_h * least(416.0 / i.image_h, 416.0 / i.image_w), 0) as nh,
               round_even(i.image_w * least(416.0 / i.image_h, 416.0 / i.image_w), 0) as nw
        from dec d join img i on i.image_id = d.image_id),
ul1 as (select *, (d."by" - (416.0 - nh) / 2 / 416.0) * (416.0 / nh) as ccy,
               (d.bx - (416.0 - nw) / 2 / 416.0) * (416.0 / nw) as ccx,
               d.bh * (416.0 / nh) as hh, d.bw * (416.0 / nw) as ww
        from ul0 d),
ul as (select *, (ccy - hh / 2) * image_h as y1, (ccx - ww / 2) * image_w as x1,
              (ccy + hh / 2) * image_h as y2, (ccx + ww / 2) * image_w as x2 from ul1),
cand as (select * from (
           select vec_id, image_id, x1, y1, x2, y2, objectness,
                  unnest(list_transform(class_probs, lambda p, i: {{'class_id': cast(i - 1 as int), 'p': p}}),
                         recursive := true)
           from ul) c0
         where objectness * p >= 0.5)
"""


def greedy_oracle(source: str, keys: list[str], id_col: str, order: str, thr: float,
                  measure: str = "iou", max_keep: int | None = None) -> str:
    """DuckDB recursive greedy suppression over ``source`` (x1..y2 corners)."""
    k = ", ".join(keys)
    on = " and ".join(f"r.{c} = s.{c}" for c in keys)
    if measure == "iou":
        ov = ("greatest(0.0, least(p.x2, r.x2) - greatest(p.x1, r.x1)) * greatest(0.0, least(p.y2, r.y2) - greatest(p.y1, r.y1))"
              " / ((p.x2 - p.x1) * (p.y2 - p.y1) + (r.x2 - r.x1) * (r.y2 - r.y1)"
              " - greatest(0.0, least(p.x2, r.x2) - greatest(p.x1, r.x1)) * greatest(0.0, least(p.y2, r.y2) - greatest(p.y1, r.y1)))")
    else:
        ov = ("greatest(0.0, least(p.x2, r.x2) - greatest(p.x1, r.x1) + 1) * greatest(0.0, least(p.y2, r.y2) - greatest(p.y1, r.y1) + 1)"
              " / ((r.x2 - r.x1 + 1) * (r.y2 - r.y1 + 1))")
    full = f" or len(s.kept) >= {max_keep}" if max_keep else ""
    return f"""
, gr as (select {k}, {id_col} as gid, x1, y1, x2, y2,
                row_number() over (partition by {k} order by {order}) as rk from {source}),
gs as (select {k}, cast(0 as bigint) as rk,
              cast([] as struct(gid bigint, x1 double, y1 double, x2 double, y2 double)[]) as kept
       from (select distinct {k} from gr) f
       union all
       select {', '.join('s.' + c for c in keys)}, r.rk,
              case when len(list_filter(s.kept, lambda p: {ov} > {thr})) > 0{full} then s.kept
                   else list_append(s.kept, {{'gid': r.gid, 'x1': r.x1, 'y1': r.y1, 'x2': r.x2, 'y2': r.y2}}) end
       from gs s join gr r on {on} and r.rk = s.rk + 1),
glast as (select * from gs qualify row_number() over (partition by {k} order by rk desc) = 1),
gkept as (select {k}, gk.gid as {id_col}, cast(gk.pick as int) as pick
          from (select {k}, unnest(list_transform(kept, lambda b, i: {{'gid': b.gid, 'pick': i - 1}})) as gk
                from glast) u)
"""


def _decoded(spark, sf):
    raw = fixture(spark, sf, "fx_raw")
    return raw, D.decode_grid_predictions(raw)


def _corners(spark, sf):
    raw, dec = _decoded(spark, sf)
    return D.unletterbox_boxes(dec.join(raw_images(raw), "image_id"))


_RAW = duck_with("fx_raw").rstrip()
_RAW_REC = _RAW.replace("with ", "with recursive ", 1)


@query("g9_decode_grid_predictions", _RAW + DEC_SQL + """
select vec_id, round(bx, 6) as bx, round("by", 6) as "by", round(bw, 6) as bw, round(bh, 6) as bh,
       round(objectness, 6) as objectness, round(list_reduce(class_probs, lambda a, b: a + b), 6) as sum_probs
from dec
""")
def q_g9(spark, sf):
    _, d = _decoded(spark, sf)
    return d.select("vec_id", *[round6(c).alias(c) for c in ("bx", "by", "bw", "bh", "objectness")],
                    round6(F.aggregate("class_probs", F.lit(0.0), lambda a, b: a + b)).alias("sum_probs"))


@query("g8_unletterbox_boxes", _RAW + DEC_SQL + """
select vec_id, round(x1, 6) as x1, round(y1, 6) as y1, round(x2, 6) as x2, round(y2, 6) as y2 from ul
""")
def q_g8(spark, sf):
    return _corners(spark, sf).select("vec_id", *[round6(c).alias(c) for c in ("x1", "y1", "x2", "y2")])


@query("f6_score_candidates", _RAW + DEC_SQL + """
select vec_id, class_id, round(objectness * p, 6) as score from cand
""")
def q_f6(spark, sf):
    c = D.score_candidates(_corners(spark, sf), 0.5)
    return c.select("vec_id", F.col("class_id").cast("int").alias("class_id"), round6("score").alias("score"))


@query("f4_filter_class", _RAW + DEC_SQL + """
select vec_id, class_id, case class_id when 0 then 'person' when 2 then 'car' end as class_name
from cand where class_id in (0, 2)
""")
def q_f4(spark, sf):
    c = D.score_candidates(_corners(spark, sf), 0.5).withColumn("class_id", F.col("class_id").cast("int"))
    k = D.filter_class(c, D.classes_frame(spark), ("person", "car"))
    return k.select("vec_id", "class_id", "class_name")


@query("f5_detector_box_to_tlwh", _RAW + DEC_SQL + """
select vec_id, cast(greatest(trunc(x1), 0) as int) as x, cast(greatest(trunc(y1), 0) as int) as y,
       cast(case when trunc(x1) < 0 then trunc(x2 - x1) + trunc(x1) else trunc(x2 - x1) end as int) as w,
       cast(case when trunc(y1) < 0 then trunc(y2 - y1) + trunc(y1) else trunc(y2 - y1) end as int) as h
from ul
""")
def q_f5(spark, sf):
    t = D.detector_box_to_tlwh(_corners(spark, sf))
    return t.select("vec_id", "x", "y", "w", "h")


@query("n2_nms_per_class_topk", _RAW_REC + DEC_SQL.rstrip()
       + greedy_oracle("cand", ["image_id", "class_id"], "vec_id", "objectness * p desc, vec_id desc", 0.5,
                       "iou", 20) + """
select image_id, class_id, vec_id, pick from gkept
""")
def q_n2(spark, sf):
    # the fold takes along all columns of a box, once for each of its classes
    boxes = _corners(spark, sf).select("image_id", "vec_id", "x1", "y1", "x2", "y2", "objectness", "class_probs")
    c = D.score_candidates(boxes, 0.5).withColumn("class_id", F.col("class_id").cast("int"))
    k = D.nms_per_class_topk(c.drop("objectness"), 0.5, 20)
    return k.select("image_id", "class_id", "vec_id", F.col("pick").cast("int").alias("pick"))


@query("n3_detect_from_raw", _RAW_REC + DEC_SQL.rstrip() + ", pcand as (select * from cand where class_id = 0)"
       + greedy_oracle("pcand", ["image_id", "class_id"], "vec_id", "objectness * p desc, vec_id desc", 0.5,
                       "iou", 20) + """
select g.image_id, cast(row_number() over (partition by g.image_id order by g.class_id desc, g.pick desc) as bigint) as det_id,
       g.vec_id,
       cast(greatest(trunc(u.x1), 0) as int) as x, cast(greatest(trunc(u.y1), 0) as int) as y,
       cast(case when trunc(u.x1) < 0 then trunc(u.x2 - u.x1) + trunc(u.x1) else trunc(u.x2 - u.x1) end as int) as w,
       cast(case when trunc(u.y1) < 0 then trunc(u.y2 - u.y1) + trunc(u.y1) else trunc(u.y2 - u.y1) end as int) as h
from gkept g join ul u on u.vec_id = g.vec_id
""")
def q_n3(spark, sf):
    raw = fixture(spark, sf, "fx_raw")
    d = D.detect_from_raw(raw, raw_images(raw), D.classes_frame(spark))
    return d.select("image_id", "det_id", "vec_id", "x", "y", "w", "h")


def _sized_frames(spark, sf):
    fr = fixture(spark, sf, "fx_frames")
    return fr.select("event_id", (F.lit(320) + (F.col("event_id") % 7) * 97).cast("int").alias("width"),
                     (F.lit(240) + (F.col("event_id") % 5) * 61).cast("int").alias("height"))


_LB_SQL = """
select event_id, target_w, target_h, round(s, 6) as scale, cast(trunc(width * s) as int) as new_w,
       cast(trunc(height * s) as int) as new_h,
       cast(floor((target_w - cast(trunc(width * s) as int)) / 2) as int) as offset_x,
       cast(floor((target_h - cast(trunc(height * s) as int)) / 2) as int) as offset_y
from (select *, least(cast(target_w as double) / width, cast(target_h as double) / height) as s
      from (select event_id, cast(320 + (event_id % 7) * 97 as int) as width,
                   cast(240 + (event_id % 5) * 61 as int) as height,
                   {tw} as target_w, {th} as target_h from fx_frames) a) b
"""


@query("g7_letterbox_geometry", duck_with("fx_frames") + _LB_SQL.format(tw="416", th="416"))
def q_g7(spark, sf):
    g = D.letterbox_geometry(_sized_frames(spark, sf))
    return g.select("event_id", "target_w", "target_h", round6("scale").alias("scale"), "new_w", "new_h",
                    "offset_x", "offset_y")


@query("g7v_letterbox_multiple_of_32", duck_with("fx_frames") + _LB_SQL.format(
    tw="cast(320 + (event_id % 7) * 97 - (320 + (event_id % 7) * 97) % 32 as int)",
    th="cast(240 + (event_id % 5) * 61 - (240 + (event_id % 5) * 61) % 32 as int)"))
def q_g7v(spark, sf):
    g = D.letterbox_geometry(_sized_frames(spark, sf), fixed=False)
    return g.select("event_id", "target_w", "target_h", round6("scale").alias("scale"), "new_w", "new_h",
                    "offset_x", "offset_y")


_CROP_SQL = """
, c as (select camera_id, frame_no, det_id, x, y, w, h, 0.5 * h as nw from fx_dets),
ci as (select *, cast(trunc(x - (nw - w) / 2) as int) as ax1, cast(trunc(y) as int) as ay1,
              cast(trunc(x - (nw - w) / 2) as int) + cast(trunc(nw) as int) as ax2, cast(trunc(y + h) as int) as ay2,
              cast(trunc(x - (nw - w) / 2) as int) as bx1, cast(trunc(y) as int) as by1,
              cast(trunc(x - (nw - w) / 2 + nw) as int) as bx2, cast(trunc(y + h) as int) as by2 from c),
cl as (select *, greatest(ax1, 0) as a1, greatest(ay1, 0) as a2, least(639, ax2) as a3, least(479, ay2) as a4,
              greatest(bx1, 0) as b1, greatest(by1, 0) as b2, least(639, bx2) as b3, least(479, by2) as b4 from ci)
select camera_id, frame_no, det_id,
       case when a1 >= a3 or a2 >= a4 then null else a1 end as i_x1, case when a1 >= a3 or a2 >= a4 then null else a2 end as i_y1,
       case when a1 >= a3 or a2 >= a4 then null else a3 end as i_x2, case when a1 >= a3 or a2 >= a4 then null else a4 end as i_y2,
       case when b1 >= b3 or b2 >= b4 then null else b1 end as f_x1, case when b1 >= b3 or b2 >= b4 then null else b2 end as f_y1,
       case when b1 >= b3 or b2 >= b4 then null else b3 end as f_x2, case when b1 >= b3 or b2 >= b4 then null else b4 end as f_y2
from cl
"""


@query("g6_crop_window", duck_with("fx_dets").rstrip() + _CROP_SQL)
def q_g6(spark, sf):
    d = fixture(spark, sf, "fx_dets").withColumn("width", F.lit(640)).withColumn("height", F.lit(480))
    d = D.crop_window(d, integer_input=True, prefix="i_")
    d = D.crop_window(d, integer_input=False, prefix="f_")
    return d.select("camera_id", "frame_no", "det_id",
                    *[f"{p}{c}" for p in ("i_", "f_") for c in ("x1", "y1", "x2", "y2")])


ENCODER_W = [[1.0, 0.0, 0.5, 0.0], [0.0, 1.0, 0.0, 0.5], [0.25, 0.25, 1.0, 0.0], [0.0, 0.0, 0.5, 1.0]]


def _encoder_sql():
    rows = []
    for r in ENCODER_W:
        rows.append(" + ".join(f"{w!r} * {c}" for w, c in zip(r, ("x", "y", "w", "h"))))
    v = [f"({e})" for e in rows]
    norm = "sqrt(1e-8 + " + " + ".join(f"{e} * {e}" for e in v) + ")"
    return ", ".join(f"round({e} / {norm}, 6) as f{i}" for i, e in enumerate(v))


def _encoded(spark, sf):
    d = fixture(spark, sf, "fx_dets").select("camera_id", "frame_no", "det_id", "x", "y", "w", "h", "score")
    schema = T.StructType([T.StructField("camera_id", T.StringType()), T.StructField("frame_no", T.LongType()),
                           T.StructField("det_id", T.LongType()),
                           T.StructField("feature", T.ArrayType(T.DoubleType()))])
    factory = INF.linear_encoder(ENCODER_W, keep=("camera_id", "frame_no", "det_id"))
    return d, INF.score_in_batches(d.repartition(cpu_parallelism(d), "camera_id", "frame_no"), factory, schema, batch_size=32)


@query("v6_score_in_batches", duck_with("fx_dets") + f"""
select camera_id, frame_no, det_id, {_encoder_sql()} from fx_dets
""")
def q_v6(spark, sf):
    _, e = _encoded(spark, sf)
    return e.select("camera_id", "frame_no", "det_id", *[round6(F.col("feature")[i]).alias(f"f{i}") for i in range(4)])


@query("v7_build_detections", duck_with("fx_dets") + f"""
select camera_id, frame_no, det_id, 1.0 as confidence, score, {_encoder_sql()} from fx_dets
""")
def q_v7(spark, sf):
    d, e = _encoded(spark, sf)
    b = VO.build_detections(d, e)
    return b.select("camera_id", "frame_no", "det_id", "confidence", "score",
                    *[round6(F.col("feature")[i]).alias(f"f{i}") for i in range(4)])


_ANCHOR_VALUES = ", ".join(f"({i}, {float(a)}, {float(b)})" for i, (a, b) in enumerate(DEFAULT_ANCHORS))


@query("g5_best_anchor_shape", duck_with("fx_truth") + f"""
, an(anchor_id, aw, ah) as (values {_ANCHOR_VALUES})
select image_id, box_no, cast(anchor_id as int) as anchor_id, round(iou, 6) as anchor_iou from (
  select t.image_id, t.box_no, an.anchor_id,
         least(t.x2 - t.x1, an.aw) * least(t.y2 - t.y1, an.ah)
         / ((t.x2 - t.x1) * (t.y2 - t.y1) + an.aw * an.ah - least(t.x2 - t.x1, an.aw) * least(t.y2 - t.y1, an.ah)) as iou
  from fx_truth t, an) s
qualify row_number() over (partition by image_id, box_no order by iou desc, anchor_id) = 1
""")
def q_g5(spark, sf):
    t = fixture(spark, sf, "fx_truth").withColumn("bw_px", F.col("x2") - F.col("x1")) \
        .withColumn("bh_px", F.col("y2") - F.col("y1"))
    b = D.best_anchor_shape(t)
    return b.select("image_id", "box_no", F.col("anchor_id").cast("int").alias("anchor_id"),
                    round6("anchor_iou").alias("anchor_iou"))


def _truth_rel(spark, sf):
    t = fixture(spark, sf, "fx_truth")
    return t.select("image_id", ((F.col("x1") + F.col("x2")) / 2 / 416).alias("tx"),
                    ((F.col("y1") + F.col("y2")) / 2 / 416).alias("ty"),
                    ((F.col("x2") - F.col("x1")) / 416).alias("tw"), ((F.col("y2") - F.col("y1")) / 416).alias("th"))


_G4_IOU = """greatest(0.0, least(p.bx + p.bw / 2, t.tx + t.tw / 2) - greatest(p.bx - p.bw / 2, t.tx - t.tw / 2))
             * greatest(0.0, least(p."by" + p.bh / 2, t.ty + t.th / 2) - greatest(p."by" - p.bh / 2, t.ty - t.th / 2))"""


@query("g4_best_truth_iou", duck_with("fx_raw", "fx_truth").rstrip() + DEC_SQL.rstrip() + f"""
, tr as (select image_id, (x1 + x2) / 2 / 416 as tx, (y1 + y2) / 2 / 416 as ty, (x2 - x1) / 416 as tw,
                (y2 - y1) / 416 as th from fx_truth),
pi as (select p.vec_id, max({_G4_IOU} / (p.bw * p.bh + t.tw * t.th - {_G4_IOU})) as best
       from dec p join tr t on t.image_id = p.image_id
       where greatest(p.bx - p.bw / 2, t.tx - t.tw / 2) < least(p.bx + p.bw / 2, t.tx + t.tw / 2)
         and greatest(p."by" - p.bh / 2, t.ty - t.th / 2) < least(p."by" + p.bh / 2, t.ty + t.th / 2)
       group by p.vec_id)
select d.vec_id, round(coalesce(pi.best, 0.0), 6) as best_iou, coalesce(pi.best, 0.0) < 0.5 as "ignore"
from dec d left join pi on pi.vec_id = d.vec_id
""")
def q_g4(spark, sf):
    _, dec = _decoded(spark, sf)
    b = D.best_truth_iou(dec.select("image_id", "vec_id", "bx", "by", "bw", "bh"), _truth_rel(spark, sf))
    return b.select("vec_id", round6("best_iou").alias("best_iou"), "ignore")


_L1_SQL = f"""
, an(anchor_id, aw, ah) as (values {_ANCHOR_VALUES}),
tv as (select *, x2 - x1 as bw_px, y2 - y1 as bh_px, floor((x1 + x2) / 2) / 416 as tx,
              floor((y1 + y2) / 2) / 416 as ty, (x2 - x1) / 416 as tw, (y2 - y1) / 416 as th
       from fx_truth where x2 - x1 > 0),
ba as (select * from (
         select tv.*, an.anchor_id,
                least(tv.bw_px, an.aw) * least(tv.bh_px, an.ah)
                / (tv.bw_px * tv.bh_px + an.aw * an.ah - least(tv.bw_px, an.aw) * least(tv.bh_px, an.ah)) as aiou
         from tv, an) s
       qualify row_number() over (partition by image_id, box_no order by aiou desc, anchor_id) = 1),
lv as (select *, cast(case when anchor_id >= 6 then 0 when anchor_id >= 3 then 1 else 2 end as int) as level from ba),
cells as (select *, cast(anchor_id - [6, 3, 0][level + 1] as int) as k,
                 cast(floor(tx * {GRID}[level + 1]) as int) as i, cast(floor(ty * {GRID}[level + 1]) as int) as j from lv),
targets as (select image_id, level, j, i, k, arg_max(tx, box_no) as tx, arg_max(ty, box_no) as ty,
                   arg_max(tw, box_no) as tw, arg_max(th, box_no) as th,
                   list_sort(list_distinct(list(class_id))) as classes
            from cells group by image_id, level, j, i, k)
"""


@query("l1_assign_truth_to_anchors", duck_with("fx_truth").rstrip() + _L1_SQL + """
select image_id, level, j, i, k, round(tx, 6) as tx, round(ty, 6) as ty, round(tw, 6) as tw, round(th, 6) as th,
       array_to_string(classes, ',') as classes
from targets
""")
def q_l1(spark, sf):
    a = D.assign_truth_to_anchors(fixture(spark, sf, "fx_truth"))
    return a.select("image_id", F.col("level").cast("int").alias("level"), "j", "i",
                    F.col("k").cast("int").alias("k"), *[round6(c).alias(c) for c in ("tx", "ty", "tw", "th")],
                    F.array_join("classes", ",").alias("classes"))


_L2_IOU = """greatest(0.0, least(p.bx + p.bw / 2, t.tx + t.tw / 2) - greatest(p.bx - p.bw / 2, t.tx - t.tw / 2))
             * greatest(0.0, least(p."by" + p.bh / 2, t.ty + t.th / 2) - greatest(p."by" - p.bh / 2, t.ty - t.th / 2))"""


_L2_SQL = duck_with("fx_raw", "fx_truth").rstrip() + DEC_SQL.rstrip() + _L1_SQL.rstrip() + f"""
, ign as (select p.vec_id, max({_L2_IOU} / (p.bw * p.bh + t.tw * t.th - {_L2_IOU})) as best
          from dec p join targets t on t.image_id = p.image_id and t.level = p.level
          where greatest(p.bx - p.bw / 2, t.tx - t.tw / 2) < least(p.bx + p.bw / 2, t.tx + t.tw / 2)
            and greatest(p."by" - p.bh / 2, t.ty - t.th / 2) < least(p."by" + p.bh / 2, t.ty + t.th / 2)
          group by p.vec_id),
j as (select p.*, t.tx, t.ty, t.tw, t.th, t.classes, case when t.tx is null then 0.0 else 1.0 end as obj,
             case when coalesce(ign.best, 0.0) < 0.5 then 1.0 else 0.0 end as ig
      from dec p
      left join targets t on t.image_id = p.image_id and t.level = p.level and t.j = p.gy and t.i = p.gx
                         and t.k = p.anchor_id - [6, 3, 0][p.level + 1]
      left join ign on ign.vec_id = p.vec_id)
"""


_L2_LOSSES = f"""
select image_id, level,
       round(sum(case when obj > 0 then
             power((tx - bx) * {GRID}[level + 1] * (2.0 - tw * th), 2) + power((ty - "by") * {GRID}[level + 1] * (2.0 - tw * th), 2)
           + power((ln(tw) - ln(bw)) * (2.0 - tw * th), 2) + power((ln(th) - ln(bh)) * (2.0 - tw * th), 2)
           else 0.0 end), 6) as box_loss,
       round(sum(obj * power(1 - objectness, 2) + (1 - obj) * power(objectness, 2) * ig), 6) as conf_loss,
       round(sum(case when obj > 0 then list_reduce(list_transform(class_probs, lambda q, c:
             power(case when list_contains(classes, c - 1) then 1.0 else 0.0 end - q, 2)), lambda a, b: a + b)
           else 0.0 end), 6) as class_loss
from j group by image_id, level
"""


def _losses(spark, sf):
    raw, dec = _decoded(spark, sf)
    # used twice, by the overlaps and by the loss
    targets = written_once(D.assign_truth_to_anchors(fixture(spark, sf, "fx_truth")), "targets")
    # predictions are decoded once and take their best overlap along
    dec = dec.select("image_id", "level", "vec_id", "gy", "gx", "anchor_id", "bx", "by", "bw", "bh", "objectness", "class_probs")
    seen = D.best_truth_iou(dec, targets.select("image_id", "level", "tx", "ty", "tw", "th"), keys=("image_id", "level"))
    return D.detector_loss(seen, targets)


@query("l2_detector_loss", _L2_SQL + _L2_LOSSES)
def q_l2(spark, sf):
    return _losses(spark, sf).select("image_id", F.col("level").cast("int").alias("level"),
                       *[round6(c).alias(c) for c in ("box_loss", "conf_loss", "class_loss")])


@query("l2_batch_loss", _L2_SQL + ", losses as (" + _L2_LOSSES + """)
select count(distinct image_id) as n_images, round(sum(box_loss + conf_loss + class_loss) / count(distinct image_id), 3) as loss
from losses
""")
def q_l2_batch(spark, sf):
    """Compared to three places, as the oracle sums rounded parts."""
    return D.batch_loss(_losses(spark, sf)).select("n_images", F.round("loss", 3).alias("loss"))


@query("l2u_truths_without_prediction", _L2_SQL + """
select t.image_id, t.level, count(*) as n_truths from targets t
where not exists (select 1 from dec p where t.image_id = p.image_id and t.level = p.level and t.j = p.gy and t.i = p.gx
                  and t.k = p.anchor_id - [6, 3, 0][p.level + 1])
group by t.image_id, t.level
""")
def q_l2u(spark, sf):
    _, dec = _decoded(spark, sf)
    missing = D.truths_without_prediction(dec, D.assign_truth_to_anchors(fixture(spark, sf, "fx_truth")))
    return missing.groupBy("image_id", F.col("level").cast("int").alias("level")).agg(F.count(F.lit(1)).alias("n_truths"))
