import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewise.operators import nms as N
from framewise.plans.fixtures import fixture
from framewise.sources import logs as LG

from .conftest import SF_SMALL


def naive_nms(boxes, scores, ids, thr):
    """Greedy suppression loop written independently of the operator."""
    order = sorted(range(len(boxes)), key=lambda i: (-scores[i], -ids[i]))
    kept = []
    for i in order:
        x, y, w, h = boxes[i]
        ok = True
        for j in kept:
            a, b, c, d = boxes[j]
            iw = max(0.0, min(a + c, x + w) - max(a, x) + 1)
            ih = max(0.0, min(b + d, y + h) - max(b, y) + 1)
            if iw * ih / ((w + 1) * (h + 1)) > thr:
                ok = False
                break
        if ok:
            kept.append(i)
    return [ids[i] for i in kept]


def test_nms_matches_naive_loop(spark):
    d = fixture(spark, SF_SMALL, "fx_dets")
    got = N.nms_per_frame(d, max_overlap=0.5).select("frame_no", "det_id", "pick").toPandas()
    pdf = d.toPandas()
    for frame, g in pdf.groupby("frame_no"):
        want = naive_nms(g[["x", "y", "w", "h"]].to_numpy(), g["score"].tolist(), g["det_id"].tolist(), 0.5)
        mine = got[got.frame_no == frame].sort_values("pick")["det_id"].tolist()
        assert mine == want


def test_nms_threshold_one_keeps_all(spark):
    d = fixture(spark, SF_SMALL, "fx_dets")
    assert N.nms_per_frame(d, max_overlap=1.0).count() == d.count()


def test_detection_log_roundtrip_with_empty_frames(spark, tmp_path):
    frames = spark.createDataFrame([("c", 0), ("c", 1), ("c", 2)], "camera_id string, frame_no bigint")
    dets = spark.createDataFrame([("c", 0, 1, 10, 20, 30, 40), ("c", 2, 1, 1, 2, 3, 4), ("c", 2, 2, 5, 6, 7, 8)],
                                 "camera_id string, frame_no bigint, det_id bigint, x int, y int, w int, h int")
    lines = LG.write_detection_log(frames, dets, path=str(tmp_path / "log"))
    got = {r.frame_no: r.line for r in lines.collect()}
    assert got == {0: "0 10 20 30 40 ", 1: "1 ", 2: "2 1 2 3 4 5 6 7 8 "}
    back = LG.read_detection_log(spark.read.text(str(tmp_path / "log")), cast="int")
    rows = sorted((r.frame_no, r.box_no, r.x, r.y, r.w, r.h) for r in back.collect())
    assert rows == [(0, 0, 10, 20, 30, 40), (1, None, None, None, None, None),
                    (2, 0, 1, 2, 3, 4), (2, 1, 5, 6, 7, 8)]


def test_iou_pairs_symmetric_and_bounded(spark):
    from framewise.operators import geometry as G
    d = fixture(spark, SF_SMALL, "fx_dets").select("camera_id", "frame_no", "det_id", "x", "y", "w", "h")
    left = d.select("camera_id", "frame_no", F.col("det_id").alias("a"),
                    *[F.col(c).alias("l_" + c) for c in "xywh"])
    right = d.select("camera_id", "frame_no", F.col("det_id").alias("b"),
                     *[F.col(c).alias("r_" + c) for c in "xywh"])
    p = G.pairwise_iou(left, right).toPandas()
    assert ((p.iou > 0) & (p.iou <= 1 + 1e-12)).all()
    fwd = {(r.frame_no, r.a, r.b): r.iou for r in p.itertuples()}
    for (f, a, b), v in fwd.items():
        assert np.isclose(fwd[(f, b, a)], v)
    assert all(np.isclose(v, 1.0) for (f, a, b), v in fwd.items() if a == b)


def test_lifecycle_is_independent_of_bucket_size(spark):
    from framewise.operators import tracking as TR
    from framewise.plans.q_tracking import scene_inputs
    frames, dets = scene_inputs(spark, SF_SMALL)
    results = [sorted(map(tuple, TR.track_lifecycle(dets, frames, key="camera_no", bucket=b).collect()))
               for b in (31, 57, 4096)]
    assert results[0] == results[1] == results[2]
    assert len(results[0]) > 0


def test_frame_rate_with_holes_matches_plain_window(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from framewise.operators.frames import frame_rate
    fr = fixture(spark, SF_SMALL, "fx_frames").where(F.col("event_id") % 3 != 0)   # holes in frame numbers
    got = frame_rate(fr, n=4, bucket=16).select("camera_id", "frame_no", F.round("fps_avg", 6).alias("a"))
    w = Window.partitionBy("camera_id").orderBy("frame_no")
    us = F.unix_micros(F.col("frame_ts").cast("timestamp"))
    ref = fr.withColumn("fps", F.try_divide(F.lit(1e6), us - F.lag(us).over(w))) \
            .withColumn("a", F.round(F.avg("fps").over(w.rowsBetween(-3, 0)), 6)).select("camera_id", "frame_no", "a")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, ref.collect()))


def test_tiny_arrow_batches_give_same_results(spark):
    """Carried state across Arrow batch boundaries (series filter, tracker)."""
    import __spark_entry__ as entry
    names = ["k5_kalman_filter_tracks", "t1_track_batch"]
    normal = {n: sorted(map(tuple, entry.queries()[n](spark, SF_SMALL).collect())) for n in names}
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, "7")
    try:
        tiny = {n: sorted(map(tuple, entry.queries()[n](spark, SF_SMALL).collect())) for n in names}
    finally:
        spark.conf.set(key, old)
    assert tiny == normal


def test_invalid_metric_and_budget_are_rejected(spark):
    import pytest

    from framewise.operators import vectors as VO
    q = spark.createDataFrame([(1, 1, [1.0, 0.0])], "camera_id long, query_id long, q_feature array<double>")
    g = spark.createDataFrame([(1, 7, 1, [1.0, 0.0])], "camera_id long, target_id long, seq long, g_feature array<double>")
    with pytest.raises(ValueError):
        VO.nearest_gallery_distance(q, g, metric="manhattan")
    with pytest.raises(ValueError):
        VO.gallery_update(g, g, g, budget=0)


def test_grid_join_equals_brute_force_on_awkward_boxes(spark):
    import random

    from framewise.operators import geometry as G
    rnd = random.Random(5)
    boxes = []
    for i in range(120):
        x, y = rnd.choice([-40.0, 0.0, 16.0, 31.5]) + rnd.randint(-20, 60), rnd.randint(-30, 60) * 1.0
        w, h = rnd.choice([0.0, 1.0, 16.0, 40.0, 95.5, rnd.randint(1, 70) * 1.0]), rnd.choice([0.0, 16.0, 33.0, 80.0])
        boxes.append(("c", 1, i, x, y, w, h))
    boxes += [("c", 1, 500, 0.0, 0.0, 16.0, 16.0), ("c", 1, 501, 16.0, 0.0, 16.0, 16.0)]   # touching edges
    df = spark.createDataFrame(boxes, "camera_id string, frame_no long, id long, x double, y double, w double, h double")
    left = df.select("camera_id", "frame_no", F.col("id").alias("a"), *[F.col(c).alias("l_" + c) for c in "xywh"])
    right = df.select("camera_id", "frame_no", F.col("id").alias("b"), *[F.col(c).alias("r_" + c) for c in "xywh"])
    got = {(r.a, r.b) for r in G.pairwise_iou(left, right, cell=16.0).collect()}
    want = set()
    for _, _, i, x, y, w, h in boxes:
        for _, _, j, u, v, p, q in boxes:
            if max(x, u) < min(x + w, u + p) and max(y, v) < min(y + h, v + q):
                want.add((i, j))
    assert got == want


def test_enormous_boxes_stay_cheap(spark):
    """A box of 1e9 pixels touches a handful of cells, not millions."""
    from framewise.operators import geometry as G

    rnd = random.Random(6)
    boxes = [(1, i, rnd.uniform(-500, 500), rnd.uniform(-500, 500), rnd.uniform(1, 90), rnd.uniform(1, 90)) for i in range(60)]
    boxes += [(1, 100, -5e8, -5e8, 1e9, 1e9), (1, 101, 0.0, -3.0, 1e9, 2.0), (1, 102, 5e8 - 1, 5e8 - 1, 40.0, 40.0)]
    df = spark.createDataFrame(boxes, "frame_no long, id long, x double, y double, w double, h double")
    left = df.select("frame_no", F.col("id").alias("a"), *[F.col(c).alias("l_" + c) for c in "xywh"])
    right = df.select("frame_no", F.col("id").alias("b"), *[F.col(c).alias("r_" + c) for c in "xywh"])
    got = sorted((r.a, r.b) for r in G.pairwise_iou(left, right, keys=("frame_no",)).collect())
    want = sorted((p[1], q[1]) for p in boxes for q in boxes
                  if max(p[2], q[2]) < min(p[2] + p[4], q[2] + q[4]) and max(p[3], q[3]) < min(p[3] + p[5], q[3] + q[5]))
    assert got == want


def test_forecast_of_no_steps_is_the_state(spark):
    from framewise.functions import motion as KF

    df = spark.createDataFrame([(1.0, 2.0, 0.5, 4.0)], "cx double, cy double, a double, h double").withColumn("kf", KF.initiate("cx", "cy", "a", "h"))
    r = df.select("kf", KF.predict_n("kf", 0).alias("same"), KF.predict_n("kf", 2).alias("two")).first()
    assert r["kf"] == r["same"] and r["two"] != r["kf"]
    with pytest.raises(ValueError, match="negative"):
        KF.predict_n("kf", -1)


def test_shared_folder_is_asked_for_away_from_one_machine():
    from framewise.session import ensure_checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    session = type("Session", (), {"sparkContext": Context(), "conf": Conf()})()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(session)
    session.sparkContext.master = "local-cluster[2,1,1024]"
    with pytest.raises(RuntimeError, match="share"):
        ensure_checkpoint_dir(session)
