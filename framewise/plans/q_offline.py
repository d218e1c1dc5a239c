"""Registered queries: two-stage association on tracker snapshots, intake
counters, latency, MOT-style detection files and the offline feature job."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..config import TrackerConfig
from ..functions import motion as KF
from ..functions.boxes import tlwh_to_xyah
from ..functions.common import epoch_micros, round6
from ..functions.motion import STATE_FIELDS
from ..operators import frames as FR
from ..operators import inference as INF
from ..operators import matching as A
from ..operators import motion as K
from ..operators import tracking as TR
from ..operators.sorted_groups import cpu_parallelism
from ..session import scratch_path
from ..sources import dims as DM
from ..sources import mot as MOT
from .fixtures import duck_with, fixture
from .q_detector import ENCODER_W
from .q_sources import frame_messages
from .q_tracking import LIFECYCLE_SQL, _SCENE_WITH, one_hot, scene_inputs
from .registry import query


@query("a4_match_two_stage", _SCENE_WITH + LIFECYCLE_SQL + """
select camera_no, frame_no, birth_frame, obj from lifecycle where time_since_update = 0 and hits > 1
""")
def q_a4(spark, sf):
    """Tracker snapshots after frame f-1, predicted to f, associated with the
    detections of f: every detection that continues a track must be matched
    to the track the lifecycle rule assigns it to."""
    frames, dets = scene_inputs(spark, sf)
    cfg = TrackerConfig(budget=None)
    t = TR.track_batch(frames, dets, cfg, key="camera_no", with_state=True)
    prev = t.select("camera_no", (F.col("frame_no") + 1).alias("frame_no"), "track_id", "state",
                    "time_since_update", "birth_frame", "birth_det",
                    F.struct(*[F.col("kf")[i].alias(f) for i, f in enumerate(STATE_FIELDS)]).alias("kf"))
    prev = K.forecast_tracks(prev, 1)
    box = KF.state_tlwh("kf")
    prev = prev.select("*", *[v.alias(f"t_{k}") for k, v in box.items()])
    prev = prev.withColumn("samples", F.when(F.col("state") == 2, F.array(one_hot("birth_det"))))
    xyah = tlwh_to_xyah("x", "y", "w", "h")
    d = dets.select("camera_no", "frame_no", "det_id", *[v.alias(f"d_{k}") for k, v in xyah.items()],
                    *[F.col(c).alias(f"d_{c}") for c in ("x", "y", "w")], F.col("feature").alias("d_feature"))
    d = d.withColumn("d_y", F.col("d_cy") - F.col("d_h") / 2)
    m = A.match_two_stage(prev, d, cfg, keys=("camera_no", "frame_no"), keep=["birth_frame"])
    return m.select("camera_no", "frame_no", "birth_frame", F.col("det_id").alias("obj"))


def _intake(spark, sf):
    msgs = frame_messages(spark, sf)
    fr = fixture(spark, sf, "fx_frames").select(F.col("event_id").alias("key"), F.col("frame_ts").alias("arrival_ts"))
    return msgs.join(fr, "key")


_REASON = """case when event_id % 97 = 0 then 'missing_camera' when event_id % 89 = 0 then 'bad_time'
                  when event_id % 83 = 0 then 'bad_base64' when event_id % 79 = 0 then 'bad_json'
                  when payload is null then 'bad_base64' end"""


@query("f3_batch_intake_counts", duck_with("fx_frames") + f"""
, m as (select strftime(frame_ts, '%Y-%m-%d') as batch_day,
               case when {_REASON} in ('missing_camera', 'bad_json') then null else camera_id end as camera_id,
               {_REASON} as reason,
               floor((epoch_us(date_trunc('minute', frame_ts) + interval 10 second) - epoch_us(frame_ts)) / 1000000) as age
        from fx_frames)
select batch_day, camera_id, count(*) as received, cast(count(reason) as bigint) as malformed,
       cast(sum(case when reason is null and not (age between 0 and 5) then 1 else 0 end) as bigint) as stale,
       cast(greatest(sum(case when reason is null and age between 0 and 5 then 1 else 0 end) - 1, 0) as bigint) as superseded,
       cast(least(sum(case when reason is null and age between 0 and 5 then 1 else 0 end), 1) as bigint) as processed
from m group by batch_day, camera_id
""")
def q_f3(spark, sf):
    msgs = _intake(spark, sf).withColumn("batch_day", F.date_format("arrival_ts", "yyyy-MM-dd"))
    now = F.date_trunc("minute", F.col("arrival_ts")).cast("timestamp") + F.expr("interval 10 seconds")
    c = FR.batch_intake_counts(msgs, now, batch_col="batch_day")
    return c.select("batch_day", "camera_id", "received", "malformed", "stale", "superseded", "processed")


@query("m2_processing_latency", duck_with("fx_frames") + """
select camera_id, count(*) as n_frames, round(avg(lat), 6) as avg_latency_s, round(min(lat), 6) as min_latency_s,
       round(max(lat), 6) as max_latency_s, round(quantile_disc(lat, 0.5), 6) as p50_latency_s,
       round(quantile_disc(lat, 0.95), 6) as p95_latency_s
from (select camera_id, (event_id % 7) * 100000 / 1e6 as lat from fx_frames) t
group by camera_id
""")
def q_m2(spark, sf):
    fr = fixture(spark, sf, "fx_frames")
    done = fr.select("camera_id", "frame_no",
                     F.timestamp_micros(epoch_micros("frame_ts") + (F.col("event_id") % 7) * 100000).alias("done_ts"))
    r = FR.processing_latency(fr, done)
    return r.select("camera_id", "n_frames", *[round6(c).alias(c) for c in
                                               ("avg_latency_s", "min_latency_s", "max_latency_s", "p50_latency_s", "p95_latency_s")])


def _write_mot(spark, sf):
    """fx_dets as MOT rows of 12 columns (frame, -1, x, y, w, h, conf, -1, -1, -1,
    det_id, class_id), one directory per sequence."""
    d = fixture(spark, sf, "fx_dets")
    root = scratch_path(spark, "mot")
    (d.select(F.col("camera_id").alias("sequence"), F.col("frame_no").cast("double"), F.lit(-1.0), "x", "y", "w", "h",
              "score", F.lit(-1.0), F.lit(-1.0), F.lit(-1.0), F.col("det_id").alias("own_id"), "class_id")
      .write.partitionBy("sequence").csv(root))
    return root


_MOT_GLOB, _MOT_PATTERN = "sequence=*/*.csv", r"sequence=([^/]+)/[^/]+$"


@query("s5_read_mot_detections", duck_with("fx_dets") + """
select camera_id as sequence, cast(frame_no as int) as frame_no, x, y, w, h, score as conf, 12 as n_columns,
       cast(det_id as double) as c10, cast(class_id as double) as c11
from fx_dets
""")
def q_s5(spark, sf):
    root = _write_mot(spark, sf)
    m = MOT.read_mot_detections(spark, root, glob=_MOT_GLOB, pattern=_MOT_PATTERN)
    return m.select("sequence", "frame_no", "x", "y", "w", "h", F.col("row")[6].alias("conf"), F.size("row").alias("n_columns"),
                    F.col("row")[10].alias("c10"), F.col("row")[11].alias("c11"))


def _frame_index(spark, sf):
    """Images exist for every order that is not pending."""
    o = spark.read.parquet(f"{sf}/orders.parquet")
    return o.where(F.col("o_orderstatus") != "P").select(
        F.concat(F.lit("cam"), (F.col("o_orderkey") % 16).cast("string")).alias("sequence"),
        F.col("o_orderkey").cast("int").alias("frame_no"))


_IDX_SQL = """
, idx as (select 'cam' || cast(o_orderkey % 16 as varchar) as sequence, cast(o_orderkey as int) as frame_no
          from orders where o_orderstatus <> 'P')
"""


@query("s7_frame_coverage", duck_with("fx_dets").rstrip() + _IDX_SQL + """
, rng as (select camera_id as sequence, cast(min(frame_no) as int) as lo, cast(max(frame_no) as int) as hi
          from fx_dets group by camera_id),
spine as (select sequence, cast(unnest(range(lo, hi + 1)) as int) as frame_no from rng)
select s.sequence, s.frame_no,
       exists (select 1 from fx_dets d where d.camera_id = s.sequence and d.frame_no = s.frame_no) as has_dets,
       exists (select 1 from idx i where i.sequence = s.sequence and i.frame_no = s.frame_no) as has_image
from spine s
""")
def q_s7(spark, sf):
    d = fixture(spark, sf, "fx_dets").select(F.col("camera_id").alias("sequence"),
                                             F.col("frame_no").cast("int").alias("frame_no"))
    cov, _ = MOT.frame_coverage(d, _frame_index(spark, sf))
    return cov


def _crop_enc_sql():
    v = []
    for r in ENCODER_W:
        v.append("(" + " + ".join(f"{w!r} * {c}" for w, c in zip(r, ("b1", "b2", "b3", "b4"))) + ")")
    norm = "sqrt(1e-8 + " + " + ".join(f"{e} * {e}" for e in v) + ")"
    return ", ".join(f"case when b1 >= b3 or b2 >= b4 then null else round({e} / {norm}, 6) end as f{i}"
                     for i, e in enumerate(v))


@query("v8_mot_feature_job", duck_with("fx_dets").rstrip() + _IDX_SQL + f"""
, c as (select d.camera_id as sequence, cast(d.frame_no as int) as frame_no, x, y, w, h, 0.5 * h as nw
        from fx_dets d join idx i on i.sequence = d.camera_id and i.frame_no = d.frame_no),
cl as (select *, greatest(cast(trunc(x - (nw - w) / 2) as int), 0) as b1, greatest(cast(trunc(y) as int), 0) as b2,
              least(639, cast(trunc(x - (nw - w) / 2 + nw) as int)) as b3, least(479, cast(trunc(y + h) as int)) as b4
       from c)
select sequence, frame_no, x, y, w, h, {_crop_enc_sql()} from cl
""")
def q_v8(spark, sf):
    root = _write_mot(spark, sf)
    sizes = spark.createDataFrame([(f"cam{i}", 640, 480) for i in range(16)], "sequence string, width int, height int")
    enc = INF.linear_encoder(ENCODER_W, inputs=("crop_x1", "crop_y1", "crop_x2", "crop_y2"),
                             keep=("sequence", "frame_no", "row"))
    store, _ = INF.mot_feature_job(spark, root, _frame_index(spark, sf), sizes, enc, scratch_path(spark, "features"),
                                   glob=_MOT_GLOB, pattern=_MOT_PATTERN)
    v = F.col("values")
    return store.select("sequence", "frame_no", *[v[i].alias(c) for i, c in zip((2, 3, 4, 5), "xywh")],
                        *[round6(F.try_element_at(v, F.lit(13 + i))).alias(f"f{i}") for i in range(4)])


@query("s6_read_frame_index", """
select cast(c_nationkey as varchar) as sequence, cast(c_custkey as int) as frame_no, count(*) as n_files from customer
group by c_nationkey, c_custkey
""")
def q_s6(spark, sf):
    """One small file a customer, in a folder of its nation's sequence and its own frame; listed, not read."""
    root = scratch_path(spark, "frames")
    c = spark.read.parquet(f"{sf}/customer.parquet")
    MOT.write_frame_tree(c.select(F.col("c_nationkey").alias("sequence"), F.col("c_custkey").alias("frame_no"), F.col("c_name").alias("value")), root)
    idx = MOT.read_frame_index(spark, root, **MOT.FRAME_TREE)
    return idx.groupBy("sequence", "frame_no").agg(F.count(F.lit(1)).alias("n_files"))


@query("s7d_dropped_detections", duck_with("fx_dets").rstrip() + _IDX_SQL + """
select camera_id as sequence, cast(frame_no as int) as frame_no, count(*) as n_dropped from fx_dets d
where not exists (select 1 from idx i where i.sequence = d.camera_id and i.frame_no = d.frame_no)
group by camera_id, frame_no
""")
def q_s7d(spark, sf):
    d = fixture(spark, sf, "fx_dets").select(F.col("camera_id").alias("sequence"), F.col("frame_no").cast("int").alias("frame_no"), "det_id")
    _, dropped = MOT.frame_coverage(d, _frame_index(spark, sf))
    return dropped.groupBy("sequence", "frame_no").agg(F.count(F.lit(1)).alias("n_dropped"))


@query("s8_load_dimensions", """
select 'class' as kind, cast(row_number() over (order by n_nationkey) - 1 as int) as id, trim(n_name) as name,
       cast(null as double) as w, cast(null as double) as h from nation
union all
select 'anchor', cast(row_number() over (order by s_suppkey) - 1 as int), null, cast(s_suppkey as double), cast(s_nationkey + 1 as double) from supplier
""")
def q_s8(spark, sf):
    """A class file of the nations' names, padded with blanks, one a line, and an anchor file of one line of suppliers' pairs."""
    root = scratch_path(spark, "dimensions")
    nation, supplier = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("nation", "supplier"))
    lines = F.transform(F.sort_array(F.collect_list(F.struct("n_nationkey", "n_name"))), lambda r: F.concat(F.lit("  "), r["n_name"], F.lit(" ")))
    nation.agg(F.array_join(lines, "\n").alias("value")).coalesce(1).write.text(f"{root}/classes")
    pairs = F.transform(F.sort_array(F.collect_list(F.struct("s_suppkey", "s_nationkey"))),
                        lambda r: F.concat(r["s_suppkey"].cast("string"), F.lit(", "), (r["s_nationkey"] + 1).cast("string")))
    supplier.agg(F.array_join(pairs, ",  ").alias("value")).coalesce(1).write.text(f"{root}/anchors")
    classes, anchors = DM.load_dimensions(spark, f"{root}/classes", f"{root}/anchors")
    none = F.lit(None).cast("double")
    return classes.select(F.lit("class").alias("kind"), F.col("class_id").alias("id"), F.col("class_name").alias("name"), none.alias("w"), none.alias("h")) \
        .unionByName(anchors.select(F.lit("anchor").alias("kind"), F.col("anchor_id").alias("id"), F.lit(None).cast("string").alias("name"),
                                    F.col("anchor_w").alias("w"), F.col("anchor_h").alias("h")))


@query("s10_write_feature_store", duck_with("fx_dets") + """
select camera_id as sequence, cast(frame_no as double) as frame, cast(det_id as double) as det, x, y, w * h as area, true as in_order from fx_dets
""")
def q_s10(spark, sf):
    """The store read back, with the order of the rows inside its files checked."""
    path = scratch_path(spark, "store")
    d = fixture(spark, sf, "fx_dets").select(F.col("camera_id").alias("sequence"), "frame_no", F.array(F.col("frame_no").cast("double"), F.col("det_id").cast("double"), "x", "y").alias("row"),
                                             F.array(F.col("w") * F.col("h")).alias("feature"))
    MOT.write_feature_store(d, path, span=512)
    # a file is one below the store's root: its folder and name tell it from the others
    v, file = F.col("values"), F.substring_index("_metadata.file_path", "/", -2)
    rows = spark.read.parquet(path).select("sequence", "frame_no", *[v[i].alias(c) for i, c in enumerate(("frame", "det", "x", "y", "area"))],
                                           file.alias("_file"), F.col("_metadata.row_index").alias("_at"))
    before = F.lag("frame_no").over(Window.partitionBy("_file").orderBy("_at"))
    return rows.repartition(cpu_parallelism(rows), "_file").select("sequence", "frame", "det", "x", "y", "area",
                                                                  F.coalesce(before <= F.col("frame_no"), F.lit(True)).alias("in_order"))
