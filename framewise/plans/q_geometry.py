"""Registered queries: intake filters, rates, box geometry, NMS."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.common import epoch_micros, round6
from ..operators import frames as FR
from ..operators import geometry as G
from ..operators import nms as N
from .fixtures import duck_with, fixture
from .registry import query


def _now_col():
    # per-row batch time: ten seconds past the frame's minute
    return F.date_trunc("minute", F.col("frame_ts")).cast("timestamp") + F.expr("interval 10 seconds")


@query("f1_drop_stale_frames", duck_with("fx_frames") + """
select camera_id, frame_no, event_id,
       cast(floor((epoch_us(date_trunc('minute', frame_ts) + interval 10 second) - epoch_us(frame_ts)) / 1000000) as bigint) as age_s
from fx_frames
where floor((epoch_us(date_trunc('minute', frame_ts) + interval 10 second) - epoch_us(frame_ts)) / 1000000) between 0 and 5
""")
def q_f1(spark, sf):
    fr = fixture(spark, sf, "fx_frames")
    kept = FR.drop_stale_frames(fr, _now_col(), "frame_ts", 5)
    return kept.select("camera_id", "frame_no", "event_id",
                       FR.frame_age_seconds("frame_ts", _now_col()).cast("bigint").alias("age_s"))


@query("f2_latest_frame_per_camera", duck_with("fx_frames") + """
select strftime(frame_ts, '%Y-%m-%d') as batch_day, camera_id, event_id, frame_no,
       epoch_us(frame_ts) as frame_us
from fx_frames
qualify row_number() over (partition by strftime(frame_ts, '%Y-%m-%d'), camera_id
                           order by frame_ts desc, event_id desc) = 1
""")
def q_f2(spark, sf):
    fr = fixture(spark, sf, "fx_frames").withColumn(
        "batch_day", F.date_format("frame_ts", "yyyy-MM-dd"))
    last = FR.latest_frame_per_camera(fr, ("frame_ts", "event_id"), ("batch_day", "camera_id"))
    return last.select("batch_day", "camera_id", "event_id", "frame_no",
                       epoch_micros("frame_ts").alias("frame_us"))


@query("m1_frame_rate", duck_with("fx_frames") + """
select camera_id, frame_no, round(dt_s, 6) as dt_s, round(fps, 6) as fps,
       round(avg(fps) over (partition by camera_id order by frame_no
                            rows between 9 preceding and current row), 6) as fps_avg
from (select camera_id, frame_no, dt_s, case when dt_s = 0 then null else 1.0 / dt_s end as fps
      from (select camera_id, frame_no,
                   (epoch_us(frame_ts) - lag(epoch_us(frame_ts)) over (partition by camera_id order by frame_no)) / 1e6 as dt_s
            from fx_frames) a) b
""")
def q_m1(spark, sf):
    fr = fixture(spark, sf, "fx_frames")
    # small buckets so the halo path is exercised at test scale
    r = FR.frame_rate(fr, n=10, bucket=64)
    return r.select("camera_id", "frame_no", round6("dt_s").alias("dt_s"),
                    round6("fps").alias("fps"), round6("fps_avg").alias("fps_avg"))


@query("g1_convert_boxes", duck_with("fx_dets") + """
select camera_id, frame_no, det_id, x as x1, y as y1, x + w as x2, y + h as y2,
       round(x + w / 2, 6) as cx, round(y + h / 2, 6) as cy, round(w / h, 6) as a,
       round((x + w / 2) - (w / h) * h / 2, 6) as bx, round((y + h / 2) - h / 2, 6) as by_,
       round((w / h) * h, 6) as bw
from fx_dets
""")
def q_g1(spark, sf):
    d = fixture(spark, sf, "fx_dets")
    t = G.convert_boxes(d, "tlwh", "tlbr")
    t = G.convert_boxes(t, "tlwh", "xyah", prefix="q_")
    t = G.convert_boxes(t, "xyah", "tlwh", cols=("q_cx", "q_cy", "q_a", "q_h"), prefix="b")
    return t.select("camera_id", "frame_no", "det_id", "x1", "y1", "x2", "y2",
                    round6("q_cx").alias("cx"), round6("q_cy").alias("cy"), round6("q_a").alias("a"),
                    round6("bx").alias("bx"), round6("by").alias("by_"), round6("bw").alias("bw"))


def _track_det_sides(spark, sf):
    t = fixture(spark, sf, "fx_tracks").select(
        "camera_id", "frame_no", "track_id", "time_since_update",
        *[F.col(c).alias(f"t_{c}") for c in ("x", "y", "w", "h")])
    d = fixture(spark, sf, "fx_meas").select(
        "camera_id", "frame_no", "det_id",
        *[F.col(c).alias(f"d_{c}") for c in ("x", "y", "w", "h")])
    return t, d


_IOU_SQL = """
(greatest(0.0, least(t.x + t.w, d.x + d.w) - greatest(t.x, d.x))
 * greatest(0.0, least(t.y + t.h, d.y + d.h) - greatest(t.y, d.y)))
/ (t.w * t.h + d.w * d.h
   - greatest(0.0, least(t.x + t.w, d.x + d.w) - greatest(t.x, d.x))
   * greatest(0.0, least(t.y + t.h, d.y + d.h) - greatest(t.y, d.y)))
"""
_OVERLAP_SQL = """
greatest(t.x, d.x) < least(t.x + t.w, d.x + d.w) and greatest(t.y, d.y) < least(t.y + t.h, d.y + d.h)
"""


@query("g2_pairwise_iou", duck_with("fx_tracks", "fx_meas") + f"""
select t.camera_id, t.frame_no, t.track_id, d.det_id, round({_IOU_SQL}, 6) as iou
from fx_tracks t join fx_meas d on t.camera_id = d.camera_id and t.frame_no = d.frame_no
where {_OVERLAP_SQL}
""")
def q_g2(spark, sf):
    t, d = _track_det_sides(spark, sf)
    p = G.pairwise_iou(t, d, lbox=("t_x", "t_y", "t_w", "t_h"), rbox=("d_x", "d_y", "d_w", "d_h"))
    return p.select("camera_id", "frame_no", "track_id", "det_id", round6("iou").alias("iou"))


@query("g3_iou_cost", duck_with("fx_tracks", "fx_meas") + f"""
select t.camera_id, t.frame_no, t.track_id, d.det_id,
       round(case when t.time_since_update > 1 then 100000.0 else 1.0 - {_IOU_SQL} end, 6) as cost
from fx_tracks t join fx_meas d on t.camera_id = d.camera_id and t.frame_no = d.frame_no
where {_OVERLAP_SQL}
""")
def q_g3(spark, sf):
    t, d = _track_det_sides(spark, sf)
    p = G.iou_cost(t, d, tbox=("t_x", "t_y", "t_w", "t_h"), dbox=("d_x", "d_y", "d_w", "d_h"))
    return p.select("camera_id", "frame_no", "track_id", "det_id", round6("cost").alias("cost"))


NMS_ORACLE_TEMPLATE = """
, r as (select camera_id, frame_no, det_id, x as x1, y as y1, x + w as x2, y + h as y2,
               row_number() over (partition by camera_id, frame_no order by {order}) as rk
        from {source}),
s as (select camera_id, frame_no, cast(0 as bigint) as rk,
             cast([] as struct(det_id bigint, x1 double, y1 double, x2 double, y2 double)[]) as kept
      from (select distinct camera_id, frame_no from r) f
      union all
      select s.camera_id, s.frame_no, r.rk,
             case when len(list_filter(s.kept, lambda p:
                    greatest(0.0, least(p.x2, r.x2) - greatest(p.x1, r.x1) + 1)
                  * greatest(0.0, least(p.y2, r.y2) - greatest(p.y1, r.y1) + 1)
                  / ((r.x2 - r.x1 + 1) * (r.y2 - r.y1 + 1)) > {thr})) > 0
                  then s.kept
                  else list_append(s.kept, {{'det_id': r.det_id, 'x1': r.x1, 'y1': r.y1, 'x2': r.x2, 'y2': r.y2}}) end
      from s join r on r.camera_id = s.camera_id and r.frame_no = s.frame_no and r.rk = s.rk + 1),
last as (select * from s qualify row_number() over (partition by camera_id, frame_no order by rk desc) = 1)
select camera_id, frame_no, k.det_id as det_id, cast(k.pick as int) as pick
from (select camera_id, frame_no,
             unnest(list_transform(kept, lambda b, i: {{'det_id': b.det_id, 'pick': i - 1}})) as k
      from last) u
"""


@query("n1_nms_per_frame", duck_with("fx_dets").replace("with ", "with recursive ", 1).rstrip()
       + NMS_ORACLE_TEMPLATE.format(order="score desc, det_id desc", source="fx_dets", thr=0.5))
def q_n1(spark, sf):
    d = fixture(spark, sf, "fx_dets")
    kept = N.nms_per_frame(d, max_overlap=0.5)
    return kept.select("camera_id", "frame_no", "det_id", F.col("pick").cast("int").alias("pick"))
