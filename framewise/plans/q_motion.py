"""Registered queries: appearance vectors, Kalman filter, association."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import boxes as B
from ..functions.common import round6
from ..functions.motion import AXES, STATE_FIELDS
from ..operators import geometry as G
from ..operators import matching as A
from ..operators import motion as K
from ..operators import vectors as VO
from . import kalman_sql as KS
from ..session import register_tables
from .fixtures import duck_with, fixture
from .registry import query

# ---------------------------------------------------------------- vectors


@query("v1_l2_normalize", """
select vec_id, cast(i - 1 as int) as i, round(v / sqrt(1e-8 + s), 6) as v
from (select vec_id, unnest(cast(embedding as double[])) as v,
             generate_subscripts(embedding, 1) as i,
             list_reduce(list_transform(cast(embedding as double[]), lambda x: x * x), lambda p, q: p + q) as s
      from embeddings) t
""")
def q_v1(spark, sf):
    register_tables(spark, sf)
    e = spark.table("embeddings")
    n = VO.l2_normalize(e, "embedding", eps=1e-8, out="unit")
    return n.select("vec_id", F.posexplode("unit").alias("i", "v")).select(
        "vec_id", F.col("i").cast("int").alias("i"), round6("v").alias("v"))


def _q_and_g(spark, sf):
    q = fixture(spark, sf, "fx_queries").withColumnRenamed("feature", "q_feature")
    g = fixture(spark, sf, "fx_gallery").withColumnRenamed("feature", "g_feature")
    return q, g


_DOT = "list_reduce(list_transform(range(1, len(q.feature) + 1), lambda i: q.feature[i] * g.feature[i]), lambda p, r: p + r)"
_QQ = "list_reduce(list_transform(q.feature, lambda x: x * x), lambda p, r: p + r)"
_GG = "list_reduce(list_transform(g.feature, lambda x: x * x), lambda p, r: p + r)"
_COS = f"(1.0 - {_DOT} / (sqrt({_QQ}) * sqrt({_GG})))"
_SQE = ("greatest(0.0, list_reduce(list_transform(range(1, len(q.feature) + 1), "
        "lambda i: (q.feature[i] - g.feature[i]) * (q.feature[i] - g.feature[i])), lambda p, r: p + r))")


@query("v2_cosine_distance_pairs", duck_with("fx_queries", "fx_gallery") + f"""
select q.camera_id, q.query_id, g.seq, round({_COS}, 6) as distance
from fx_queries q join fx_gallery g on q.camera_id = g.camera_id
""")
def q_v2(spark, sf):
    q, g = _q_and_g(spark, sf)
    p = VO.cosine_distance_pairs(q, g, ["camera_id"], "q_feature", "g_feature")
    return p.select("camera_id", "query_id", "seq", round6("distance").alias("distance"))


@query("v3_squared_euclidean_pairs", duck_with("fx_queries", "fx_gallery") + f"""
select q.camera_id, q.query_id, g.seq, round({_SQE}, 6) as distance
from fx_queries q join fx_gallery g on q.camera_id = g.camera_id
""")
def q_v3(spark, sf):
    q, g = _q_and_g(spark, sf)
    p = VO.squared_euclidean_pairs(q, g, ["camera_id"], "q_feature", "g_feature")
    return p.select("camera_id", "query_id", "seq", round6("distance").alias("distance"))


@query("v4_nearest_gallery_distance", duck_with("fx_queries", "fx_gallery") + f"""
select q.camera_id, q.query_id, g.target_id, round(min({_COS}), 6) as distance
from fx_queries q join fx_gallery g on q.camera_id = g.camera_id
group by q.camera_id, q.query_id, g.target_id
""")
def q_v4(spark, sf):
    q, g = _q_and_g(spark, sf)
    d = VO.nearest_gallery_distance(q, g, "cosine", ["camera_id"])
    return d.select("camera_id", "query_id", "target_id", round6("distance").alias("distance"))


@query("v4e_nearest_gallery_euclidean", duck_with("fx_queries", "fx_gallery") + f"""
select q.camera_id, q.query_id, g.target_id, round(min({_SQE}), 6) as distance
from fx_queries q join fx_gallery g on q.camera_id = g.camera_id
group by q.camera_id, q.query_id, g.target_id
""")
def q_v4e(spark, sf):
    q, g = _q_and_g(spark, sf)
    d = VO.nearest_gallery_distance(q, g, "euclidean", ["camera_id"])
    return d.select("camera_id", "query_id", "target_id", round6("distance").alias("distance"))


_SAMPLES = """
with samples as (select cast(floor(vec_id / 50) as bigint) as camera_id, cast(label as bigint) as target_id, vec_id as seq
                 from embeddings)
"""


@query("v5_gallery_update", _SAMPLES + """
select camera_id, target_id, seq from (
  select camera_id, target_id, seq,
         row_number() over (partition by camera_id, target_id order by seq desc) as rn
  from samples
  where (camera_id, target_id) in (select camera_id, target_id from samples
                                   where seq % 10 >= 6 and target_id <> camera_id % 10)) t
where rn <= 3
""")
def q_v5(spark, sf):
    register_tables(spark, sf)
    g = spark.table("embeddings").select(F.floor(F.col("vec_id") / 50).alias("camera_id"), F.col("label").cast("long").alias("target_id"),
                                         F.col("vec_id").alias("seq"), F.col("embedding").alias("feature"))
    old = g.where(F.col("seq") % 10 < 6)
    new = g.where(F.col("seq") % 10 >= 6)
    active = new.where(F.col("target_id") != F.col("camera_id") % 10).select("camera_id", "target_id")
    return VO.gallery_update(old, new, active, budget=3).select("camera_id", "target_id", "seq")


# ---------------------------------------------------------------- Kalman

def _xyah(df, prefix=""):
    c = B.tlwh_to_xyah("x", "y", "w", "h")
    return df.select("*", *[v.alias(prefix + k) for k, v in c.items()])


def _state_cols(state="kf", fields=STATE_FIELDS):
    return [round6(F.col(state)[f]).alias(f) for f in fields]


_XYAH_SQL = ("x + w / 2", "y + h / 2", "w / h", "h")


_ALL_TRACKS = duck_with("fx_dets").rstrip() + """
, all_tracks as (select camera_id, frame_no, det_id as track_id, x, y, w, h,
                        cast(1 + det_id % 2 as int) as time_since_update from fx_dets)
"""


def _all_tracks(spark, sf):
    """Every detection as a track of its own."""
    return fixture(spark, sf, "fx_dets").select("camera_id", "frame_no", F.col("det_id").alias("track_id"), "x", "y", "w", "h",
                                                (1 + F.col("det_id") % 2).cast("int").alias("time_since_update"))


def _tracks_predicted(spark, sf, steps=1, tracks=None):
    t = _xyah(fixture(spark, sf, "fx_tracks") if tracks is None else tracks, "z_")
    t = K.initiate_tracks(t, ("z_cx", "z_cy", "z_a", "z_h"))
    return K.forecast_tracks(t, steps)


def _pred_sql(steps=1, prefix="t."):
    s = KS.init(f"{prefix}x + {prefix}w / 2", f"{prefix}y + {prefix}h / 2",
                f"{prefix}w / {prefix}h", f"{prefix}h")
    for _ in range(steps):
        s = KS.predict(s)
    return s


@query("k1_initiate_tracks", duck_with("fx_dets") + f"""
select camera_id, frame_no, det_id, {KS.select_list(KS.init(*_XYAH_SQL))}
from fx_dets
""")
def q_k1(spark, sf):
    d = _xyah(fixture(spark, sf, "fx_dets"), "z_")
    s = K.initiate_tracks(d, ("z_cx", "z_cy", "z_a", "z_h"))
    return s.select("camera_id", "frame_no", "det_id", *_state_cols())


@query("k2_forecast_tracks", _ALL_TRACKS + f"""
select camera_id, frame_no, track_id, time_since_update + 2 as time_since_update,
       {KS.select_list(_pred_sql(2))}
from all_tracks t
""")
def q_k2(spark, sf):
    s = _tracks_predicted(spark, sf, 2, _all_tracks(spark, sf))
    return s.select("camera_id", "frame_no", "track_id", "time_since_update", *_state_cols())


def _proj_select(s):
    parts = [f"round({s[k]}, 6) as {k}" for k in AXES]
    parts += [f"round({KS.variance(s, k)}, 6) as s_{k}" for k in AXES]
    return ", ".join(parts)


@query("k3_project_tracks", _ALL_TRACKS + f"""
select camera_id, frame_no, track_id, {_proj_select(_pred_sql(1))}
from all_tracks t
""")
def q_k3(spark, sf):
    s = K.project_tracks(_tracks_predicted(spark, sf, 1, _all_tracks(spark, sf)))
    return s.select("camera_id", "frame_no", "track_id",
                    *[round6(F.col("proj")[f]).alias(f) for f in list(AXES) + [f"s_{k}" for k in AXES]])


@query("k4_correct_tracks", duck_with("fx_tracks", "fx_meas") + f"""
select t.camera_id, t.frame_no, t.track_id, d.det_id,
       {KS.select_list(KS.update(_pred_sql(1), dict(zip(AXES, ("d.x + d.w / 2", "d.y + d.h / 2", "d.w / d.h", "d.h")))))}
from fx_tracks t join fx_meas d
  on t.camera_id = d.camera_id and t.frame_no = d.frame_no and d.det_id = t.track_id + 1
""")
def q_k4(spark, sf):
    s = _tracks_predicted(spark, sf, 1).select("camera_id", "frame_no", "track_id", "kf")
    m = _xyah(fixture(spark, sf, "fx_meas"), "z_").select(
        "camera_id", "frame_no", "det_id", "z_cx", "z_cy", "z_a", "z_h",
        (F.col("det_id") - 1).alias("track_id"))
    c = K.correct_tracks(s, m, ["camera_id", "frame_no", "track_id"])
    return c.select("camera_id", "frame_no", "track_id", "det_id", *_state_cols())


def _k5_oracle():
    s = KS.columns("s.")
    z = dict(zip(AXES, ("o.cx", "o.cy", "o.a", "o.h")))
    step = KS.update(KS.predict(s), z)
    init = KS.init("cx", "cy", "a", "h")
    fields = ", ".join(STATE_FIELDS)
    return duck_with("fx_obs").replace("with ", "with recursive ", 1).rstrip() + f"""
, f(track_id, frame_no, {fields}) as (
  select track_id, frame_no, {KS.select_list(init, round_to=None)} from fx_obs where frame_no = 1
  union all
  select o.track_id, o.frame_no, {KS.select_list(step, round_to=None)}
  from f s join fx_obs o on o.track_id = s.track_id and o.frame_no = s.frame_no + 1)
select track_id, frame_no, true as observed, {KS.select_list(KS.columns(''))} from f
"""


@query("k5_kalman_filter_tracks", _k5_oracle())
def q_k5(spark, sf):
    o = fixture(spark, sf, "fx_obs")
    f = K.kalman_filter_tracks(o, "track_id", "frame_no", ("cx", "cy", "a", "h"))
    return f.select("track_id", "frame_no", "observed", *[round6(c).alias(c) for c in STATE_FIELDS])


def _gate_sides(spark, sf):
    t = _tracks_predicted(spark, sf, 1).select("camera_id", "frame_no", "track_id", "kf")
    d = _xyah(fixture(spark, sf, "fx_meas"), "d_").select(
        "camera_id", "frame_no", "det_id", "d_cx", "d_cy", "d_a", "d_h")
    return t, d


_DZ = dict(zip(AXES, ("d.x + d.w / 2", "d.y + d.h / 2", "d.w / d.h", "d.h")))


def _k6_oracle(only_position):
    thr = 5.9915 if only_position else 9.4877
    d2 = KS.gating(_pred_sql(1), _DZ, only_position)
    return duck_with("fx_tracks", "fx_meas") + f"""
select t.camera_id, t.frame_no, t.track_id, d.det_id, round({d2}, 6) as d2
from fx_tracks t join fx_meas d on t.camera_id = d.camera_id and t.frame_no = d.frame_no
where {d2} <= {thr}
"""


@query("k6_mahalanobis_pairs", _k6_oracle(False))
def q_k6(spark, sf):
    t, d = _gate_sides(spark, sf)
    p = K.mahalanobis_pairs(t, d)
    return p.select("camera_id", "frame_no", "track_id", "det_id", round6("d2").alias("d2"))


@query("k6p_mahalanobis_position_only", _k6_oracle(True))
def q_k6p(spark, sf):
    t, d = _gate_sides(spark, sf)
    p = K.mahalanobis_pairs(t, d, only_position=True)
    return p.select("camera_id", "frame_no", "track_id", "det_id", round6("d2").alias("d2"))


_IOU = """
(greatest(0.0, least(t.x + t.w, d.x + d.w) - greatest(t.x, d.x))
 * greatest(0.0, least(t.y + t.h, d.y + d.h) - greatest(t.y, d.y)))
/ (t.w * t.h + d.w * d.h
   - greatest(0.0, least(t.x + t.w, d.x + d.w) - greatest(t.x, d.x))
   * greatest(0.0, least(t.y + t.h, d.y + d.h) - greatest(t.y, d.y)))
"""
_OVL = "greatest(t.x, d.x) < least(t.x + t.w, d.x + d.w) and greatest(t.y, d.y) < least(t.y + t.h, d.y + d.h)"


@query("k7_gate_pairs", duck_with("fx_tracks", "fx_meas") + f"""
select t.camera_id, t.frame_no, t.track_id, d.det_id,
       round(case when {KS.gating(_pred_sql(1), _DZ)} > 9.4877 then 100000.0
                  when t.time_since_update > 1 then 100000.0 else 1.0 - {_IOU} end, 6) as cost
from fx_tracks t join fx_meas d on t.camera_id = d.camera_id and t.frame_no = d.frame_no
where {_OVL}
""")
def q_k7(spark, sf):
    tr = fixture(spark, sf, "fx_tracks").select(
        "camera_id", "frame_no", "track_id", "time_since_update",
        *[F.col(c).alias(f"t_{c}") for c in ("x", "y", "w", "h")])
    me = fixture(spark, sf, "fx_meas").select(
        "camera_id", "frame_no", "det_id", *[F.col(c).alias(f"d_{c}") for c in ("x", "y", "w", "h")])
    cost = G.iou_cost(tr, me, tbox=("t_x", "t_y", "t_w", "t_h"), dbox=("d_x", "d_y", "d_w", "d_h"))
    t, d = _gate_sides(spark, sf)
    gate = K.mahalanobis_pairs(t, d)
    g = K.gate_pairs(cost.select("camera_id", "frame_no", "track_id", "det_id", "cost"), gate,
                     ["camera_id", "frame_no", "track_id", "det_id"])
    return g.select("camera_id", "frame_no", "track_id", "det_id", round6("cost").alias("cost"))


# ---------------------------------------------------------------- association

_A1_DFEAT = "[d.w, d.h, d.x + 1, d.y + 1]"


def _a1_oracle():
    d2 = KS.gating(_pred_sql(1), _DZ)
    return duck_with("fx_tracks", "fx_meas") + f"""
, g as (select camera_id, frame_no, track_id, [w, h, x + 1, y + 1] as feature from fx_tracks
        union all select camera_id, frame_no, track_id, [h, w, y + 1, x + 1] from fx_tracks),
p as (select t.camera_id, t.frame_no, t.track_id, d.det_id, {_A1_DFEAT} as df
      from fx_tracks t join fx_meas d on t.camera_id = d.camera_id and t.frame_no = d.frame_no
      where {d2} <= 9.4877)
select p.camera_id, p.frame_no, p.track_id, p.det_id,
       round(min(1.0 - list_reduce(list_transform(range(1, 5), lambda i: p.df[i] * g.feature[i]), lambda a, b: a + b)
             / (sqrt(list_reduce(list_transform(p.df, lambda x: x * x), lambda a, b: a + b))
                * sqrt(list_reduce(list_transform(g.feature, lambda x: x * x), lambda a, b: a + b)))), 6) as cost
from p join g on p.camera_id = g.camera_id and p.frame_no = g.frame_no and p.track_id = g.track_id
group by p.camera_id, p.frame_no, p.track_id, p.det_id
"""


def _a1_inputs(spark, sf):
    t, d = _gate_sides(spark, sf)
    ft = fixture(spark, sf, "fx_tracks")
    gal = ft.select("camera_id", "frame_no", "track_id",
                    F.array("w", "h", F.col("x") + 1, F.col("y") + 1).alias("g_feature")) \
        .unionByName(ft.select("camera_id", "frame_no", "track_id",
                               F.array("h", "w", F.col("y") + 1, F.col("x") + 1).alias("g_feature")))
    me = fixture(spark, sf, "fx_meas")
    d = d.join(me.select("camera_id", "frame_no", "det_id",
                         F.array("w", "h", F.col("x") + 1, F.col("y") + 1).alias("d_feature")),
               ["camera_id", "frame_no", "det_id"])
    return t, gal, d


@query("a1_association_costs", _a1_oracle())
def q_a1(spark, sf):
    t, gal, d = _a1_inputs(spark, sf)
    # fixture tracks are per-frame rows, so a track's gallery is keyed by frame too
    c = A.association_costs(t, gal, d, gallery_keys=("camera_id", "frame_no", "track_id"))
    return c.select("camera_id", "frame_no", "track_id", "det_id", round6("cost").alias("cost"))


def match_oracle(edges_sql: str, max_distance: float, level: bool = False) -> str:
    """Exhaustive search per frame: tracks in order (by level when given),
    each either unmatched or matched to a free detection; the best leaf
    maximises the total of ``max + 1e-5 - cost`` (lexicographically per
    level for the cascade)."""
    c = max_distance + 1e-5
    lvl = "level" if level else "cast(1 as bigint)"
    return f"""
, e as (select camera_id, frame_no, track_id, det_id, cost, {lvl} as level
        from ({edges_sql}) x where cost <= {max_distance}),
tr as (select camera_id, frame_no, track_id, level,
              row_number() over (partition by camera_id, frame_no order by level, track_id) as ti,
              count(*) over (partition by camera_id, frame_no) as nt
       from (select distinct camera_id, frame_no, track_id, level from e) u),
opt as (select tr.camera_id, tr.frame_no, tr.ti, tr.level, e.track_id, e.det_id, e.cost
        from tr join e on e.camera_id = tr.camera_id and e.frame_no = tr.frame_no and e.track_id = tr.track_id
        union all
        select camera_id, frame_no, ti, level, track_id, null, null from tr),
s as (select camera_id, frame_no, cast(0 as bigint) as ti, cast([] as bigint[]) as used,
             cast([] as struct(track_id bigint, det_id bigint, cost double)[]) as matched,
             cast(list_transform(range(30), lambda i: 0.0) as double[]) as w
      from (select distinct camera_id, frame_no from tr) f
      union all
      select s.camera_id, s.frame_no, o.ti,
             case when o.det_id is null then s.used else list_append(s.used, o.det_id) end,
             case when o.det_id is null then s.matched
                  else list_append(s.matched, {{'track_id': o.track_id, 'det_id': o.det_id, 'cost': o.cost}}) end,
             case when o.det_id is null then s.w
                  else list_transform(s.w, lambda v, i: v + case when i = o.level then {c!r} - o.cost else 0.0 end) end
      from s join opt o on o.camera_id = s.camera_id and o.frame_no = s.frame_no and o.ti = s.ti + 1
      where o.det_id is null or not list_contains(s.used, o.det_id)),
best as (select s.camera_id, s.frame_no, s.matched
         from s join (select distinct camera_id, frame_no, nt from tr) n
           on n.camera_id = s.camera_id and n.frame_no = s.frame_no and s.ti = n.nt
         qualify row_number() over (partition by s.camera_id, s.frame_no order by s.w desc) = 1)
select camera_id, frame_no, m.track_id as track_id, m.det_id as det_id, round(m.cost, 6) as cost
from (select camera_id, frame_no, unnest(matched) as m from best) b
"""


_G3_EDGES = f"""
select t.camera_id, t.frame_no, t.track_id, d.det_id, t.time_since_update as level,
       case when t.time_since_update > 1 then 100000.0 else 1.0 - {_IOU} end as cost
from fx_tracks t join fx_meas d on t.camera_id = d.camera_id and t.frame_no = d.frame_no
where {_OVL}
"""

_G3_EDGES_PLAIN = f"""
select t.camera_id, t.frame_no, t.track_id, d.det_id, t.level,
       1.0 - {_IOU} as cost
from fx_tracks t join fx_meas d on t.camera_id = d.camera_id and t.frame_no = d.frame_no
where {_OVL}
"""


def _iou_edges(spark, sf, plain=False):
    tr = fixture(spark, sf, "fx_tracks").select(
        "camera_id", "frame_no", "track_id", "time_since_update", "level",
        *[F.col(c).alias(f"t_{c}") for c in ("x", "y", "w", "h")])
    if plain:  # twelve levels of the cascade
        tr = tr.withColumn("_tsu", F.col("level")).withColumn("time_since_update", F.lit(1))
    me = fixture(spark, sf, "fx_meas").select(
        "camera_id", "frame_no", "det_id", *[F.col(c).alias(f"d_{c}") for c in ("x", "y", "w", "h")])
    c = G.iou_cost(tr, me, tbox=("t_x", "t_y", "t_w", "t_h"), dbox=("d_x", "d_y", "d_w", "d_h"))
    if plain:
        c = c.withColumn("time_since_update", F.col("_tsu"))
    return c.select("camera_id", "frame_no", "track_id", "det_id", "cost", "time_since_update")


_REC = duck_with("fx_tracks", "fx_meas").replace("with ", "with recursive ", 1).rstrip()


@query("a2_match_min_cost", _REC + match_oracle(_G3_EDGES, 0.7))
def q_a2(spark, sf):
    m = A.match_min_cost(_iou_edges(spark, sf), 0.7)
    return m.select("camera_id", "frame_no", "track_id", "det_id", round6("cost").alias("cost"))


@query("a3_match_cascade", _REC + match_oracle(_G3_EDGES_PLAIN, 0.7, level=True))
def q_a3(spark, sf):
    m = A.match_cascade(_iou_edges(spark, sf, plain=True), 0.7)
    return m.select("camera_id", "frame_no", "track_id", "det_id", round6("cost").alias("cost"))


@query("a5_unmatched_sides", _REC + match_oracle(_G3_EDGES, 0.7).replace(
    "select camera_id, frame_no, m.track_id as track_id", ", mm as (select camera_id, frame_no, m.track_id as track_id", 1)
    .rstrip() + """)
select camera_id, frame_no, 'track' as side, track_id as id from fx_tracks t
where not exists (select 1 from mm where mm.camera_id = t.camera_id and mm.frame_no = t.frame_no and mm.track_id = t.track_id)
union all
select camera_id, frame_no, 'detection' as side, det_id as id from fx_meas d
where not exists (select 1 from mm where mm.camera_id = d.camera_id and mm.frame_no = d.frame_no and mm.det_id = d.det_id)
""")
def q_a5(spark, sf):
    m = A.match_min_cost(_iou_edges(spark, sf), 0.7)
    tr = fixture(spark, sf, "fx_tracks")
    me = fixture(spark, sf, "fx_meas")
    ut, ud = A.unmatched_sides(tr, me, m)
    return (ut.select("camera_id", "frame_no", F.lit("track").alias("side"), F.col("track_id").alias("id"))
            .unionByName(ud.select("camera_id", "frame_no", F.lit("detection").alias("side"),
                                   F.col("det_id").alias("id"))))
