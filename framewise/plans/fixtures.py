"""Deterministic fixture views over the driver tables.

Each view has one text that both Spark SQL and DuckDB run; where the dialects
differ the DuckDB text is given next to it.  Spark registers them as temp
views over lazily scanned parquet tables; the oracle side prepends them as
CTEs.  Every view keeps all rows of its source table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import register_tables

FRAMES = """
select concat('cam', cast(user_id % 8 as string)) as camera_id,
       event_id as frame_no, event_id, ts as frame_ts, cast(640 as int) as width, cast(480 as int) as height,
       props as payload
from events
"""

DETS = """
select concat('cam', cast(l_orderkey % 16 as string)) as camera_id, l_orderkey as frame_no, det_id,
       cast((l_partkey * 7) % 200 as double) as x, cast((l_suppkey * 13) % 200 as double) as y,
       cast(40 as double) + l_quantity * 2 as w, cast(60 as double) + l_quantity * 3 as h,
       l_extendedprice as score, cast(l_partkey % 80 as int) as class_id
from (select *, cast(row_number() over (partition by l_orderkey
      order by l_linenumber, l_partkey, l_suppkey) as bigint) as det_id from lineitem) t
"""

TRACKS = """
select camera_id, frame_no, det_id as track_id, x, y, w, h,
       cast(1 + det_id % 2 as int) as time_since_update, cast(1 + (det_id * 5 + class_id) % 12 as int) as level
from fx_dets where class_id % 2 = 0
"""

MEAS = """
select camera_id, frame_no, det_id, x, y, w, h, score from fx_dets where class_id % 2 = 1
"""

OBS = """
select user_id as track_id,
       cast(row_number() over (partition by user_id order by ts, event_id) as bigint) as frame_no,
       cast(300 as double) + value as cx, cast(200 as double) + value / 2 as cy,
       cast(0.5 as double) + value / 1000 as a, cast(80 as double) + value / 10 as h
from events
"""

TRUTH = """
select l_orderkey as image_id, det_id as box_no,
       cast((l_partkey * 7) % 300 as double) as x1, cast((l_suppkey * 13) % 300 as double) as y1,
       cast((l_partkey * 7) % 300 + 5 + (l_suppkey * 3) % 110 as double) as x2,
       cast((l_suppkey * 13) % 300 + 5 + (l_partkey * 11) % 110 as double) as y2,
       cast(l_suppkey % 80 as int) as class_id
from (select *, cast(row_number() over (partition by l_orderkey
      order by l_linenumber, l_partkey, l_suppkey) as bigint) as det_id from lineitem) t
"""

# A scene per camera: an order is one frame of one of 40 cameras, its line
# numbers are the objects seen, so cameras run longer as the tables grow.
# Objects 0 to 3 vanish for stretches now and then (some longer than 30
# frames); object 4 never stays three frames in a row.
SCENE = """
select distinct camera_no, frame_no, obj, obj as det_id,
       cast(20 + 3 * frame_no as double) as x, cast(120 * obj as double) as y,
       cast(40 as double) as w, cast(80 as double) as h
from (select l_orderkey % 40 as camera_no, cast(floor(l_orderkey / 40) as bigint) + 1 as frame_no,
             cast(l_linenumber % 5 as bigint) as obj from lineitem) s
where case when obj = 4 then frame_no % 7 in (0, 1)
      else (frame_no + 13 * obj + 7 * camera_no) % (70 + 5 * obj) >= (camera_no * (obj + 1)) % 36 end
"""

SCENE_FRAMES = """
select o_orderkey % 40 as camera_no, cast(floor(o_orderkey / 40) as bigint) + 1 as frame_no from orders
"""

# Predictions, 59 classes each: one a vector, spread over the cells of a few
# crowded images, and one a level on the cell of every true box of many images.
_RAW = """
select vec_id, image_id, level, anchor_id, cast(row_px * size as int) as gy, cast(col_px * size as int) as gx,
       {logits} as logits
from (select vec_id, cast(floor(vec_id / 250) as bigint) as image_id, cast(vec_id % 3 as int) as level,
             cast(6 - 3 * (vec_id % 3) + floor(vec_id / 3) % 3 as int) as anchor_id,
             case vec_id % 3 when 0 then 13 when 1 then 26 else 52 end as size,
             ((vec_id * 7) % 52) / cast(52 as double) as row_px, ((vec_id * 11) % 52) / cast(52 as double) as col_px, embedding
      from embeddings
      union all
      select 1000000000 + (e.vec_id * 100 + t.box_no) * 3 + l.level, t.image_id, cast(l.level as int),
             cast(6 - 3 * l.level + (e.vec_id + t.box_no) % 3 as int), l.size,
             floor((t.y1 + t.y2) / 2) / 416, floor((t.x1 + t.x2) / 2) / 416, e.embedding
      from embeddings e join fx_truth t on t.image_id = e.vec_id + 1
           cross join (select 0 as level, 13 as size union all select 1, 26 union all select 2, 52) l) p
"""
RAW_SPARK = _RAW.format(logits="transform(embedding, (v, i) -> cast(v as double) * case when i < 4 then 2 else 16 end)")
RAW_DUCK = _RAW.format(
    logits="list_transform(embedding, lambda v, i: cast(v as double) * case when i <= 4 then 2 else 16 end)"
).replace("cast(row_px * size as int)", "cast(floor(row_px * size) as int)").replace(
    "cast(col_px * size as int)", "cast(floor(col_px * size) as int)")

# Appearance gallery / queries, blocked by camera = vec_id div 50.
GALLERY_SPARK = """
select cast(floor(vec_id / 50) as bigint) as camera_id, cast(label as bigint) as target_id,
       vec_id as seq, cast(embedding as array<double>) as feature
from embeddings where vec_id % 5 <> 0
"""
GALLERY_DUCK = """
select cast(floor(vec_id / 50) as bigint) as camera_id, cast(label as bigint) as target_id,
       vec_id as seq, cast(embedding as double[]) as feature
from embeddings where vec_id % 5 <> 0
"""
QUERIES_SPARK = """
select cast(floor(vec_id / 50) as bigint) as camera_id, vec_id as query_id,
       cast(embedding as array<double>) as feature
from embeddings where vec_id % 5 = 0
"""
QUERIES_DUCK = """
select cast(floor(vec_id / 50) as bigint) as camera_id, vec_id as query_id,
       cast(embedding as double[]) as feature
from embeddings where vec_id % 5 = 0
"""

# name -> (spark text, duckdb text, dependencies)
VIEWS: dict[str, tuple[str, str, tuple[str, ...]]] = {
    "fx_frames": (FRAMES, FRAMES, ()),
    "fx_dets": (DETS, DETS, ()),
    "fx_tracks": (TRACKS, TRACKS, ("fx_dets",)),
    "fx_meas": (MEAS, MEAS, ("fx_dets",)),
    "fx_obs": (OBS, OBS, ()),
    "fx_truth": (TRUTH, TRUTH, ()),
    "fx_scene": (SCENE, SCENE, ()),
    "fx_scene_frames": (SCENE_FRAMES, SCENE_FRAMES, ()),
    "fx_raw": (RAW_SPARK, RAW_DUCK, ("fx_truth",)),
    "fx_gallery": (GALLERY_SPARK, GALLERY_DUCK, ()),
    "fx_queries": (QUERIES_SPARK, QUERIES_DUCK, ()),
}


def _closure(names) -> list[str]:
    order: list[str] = []

    def visit(n):
        for d in VIEWS[n][2]:
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    return order


_DEFINED: dict[int, set] = {}


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Spark DataFrame of a fixture view over the tables in ``sf_dir``."""
    if register_tables(spark, sf_dir):
        _DEFINED[id(spark)] = set()
    defined = _DEFINED.setdefault(id(spark), set())
    for n in _closure([name]):
        if n not in defined:
            spark.sql(VIEWS[n][0]).createOrReplaceTempView(n)
            defined.add(n)
    return spark.table(name)


def duck_with(*names: str) -> str:
    """``WITH`` prefix defining the fixture views for a DuckDB oracle."""
    parts = [f"{n} as ({VIEWS[n][1].strip()})" for n in _closure(names)]
    return "with " + ",\n".join(parts) + "\n"
