"""The streaming tracker must equal the batch tracker for any micro-batch split."""

from pyspark.sql import functions as F

from framewise.config import TrackerConfig
from framewise.operators import tracking as TR
from framewise.plans.q_tracking import scene_inputs
from framewise.streaming.tracking import track_stream

from .conftest import SF_SMALL

COLS = ["camera_no", "frame_no", "track_id", "state", "hits", "age", "time_since_update", "birth_frame", "birth_det"]


def _rows(df):
    return sorted(tuple(r[c] for c in COLS) + tuple(round(r[c], 6) for c in ("x", "y", "w", "h"))
                  for r in df.collect())


def test_uneven_split_equals_batch(spark, tmp_path):
    cfg = TrackerConfig(budget=3)
    frames, dets = scene_inputs(spark, SF_SMALL)
    batch = TR.track_batch(frames, dets, cfg, key="camera_no")
    rows = frames.join(dets.select("camera_no", "frame_no", "det_id", "x", "y", "w", "h", "feature"),
                       ["camera_no", "frame_no"], "left")
    src, out, ckpt = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    cuts = [(1, 7), (8, 20), (21, 21), (22, 10_000)]
    rows.where(F.col("frame_no").between(*cuts[0])).write.parquet(src)
    stream = spark.readStream.schema(rows.schema).parquet(src)
    q = (track_stream(stream, cfg, key="camera_no").writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", ckpt).outputMode("append").start())
    try:
        q.processAllAvailable()
        for lo, hi in cuts[1:]:
            rows.where(F.col("frame_no").between(lo, hi)).write.mode("append").parquet(src)
            q.processAllAvailable()
    finally:
        q.stop()
    assert _rows(spark.read.parquet(out)) == _rows(batch)


def test_late_frames_are_dropped(spark, tmp_path):
    cfg = TrackerConfig()
    schema = "camera_id string, frame_no bigint, det_id bigint, x double, y double, w double, h double, feature array<double>"
    first = [("c", 5, 1, 10.0, 10.0, 20.0, 40.0, [1.0, 0.0])]
    late = [("c", 3, 1, 10.0, 10.0, 20.0, 40.0, [1.0, 0.0]), ("c", 6, 1, 11.0, 10.0, 20.0, 40.0, [1.0, 0.0])]
    src, out, ckpt = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    spark.createDataFrame(first, schema).write.parquet(src)
    stream = spark.readStream.schema(schema).parquet(src)
    q = (track_stream(stream, cfg).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", ckpt).outputMode("append").start())
    try:
        q.processAllAvailable()
        spark.createDataFrame(late, schema).write.mode("append").parquet(src)
        q.processAllAvailable()
    finally:
        q.stop()
    got = sorted((r.frame_no, r.track_id, r.hits) for r in spark.read.parquet(out).collect())
    assert got == [(5, 1, 1), (6, 1, 2)]


TRACK_ROW = "camera_id string, frame_no bigint, det_id bigint, x double, y double, w double, h double, feature array<double>"


def test_late_frames_are_counted(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    box = (1, 10.0, 10.0, 20.0, 40.0, [1.0, 0.0])
    spark.createDataFrame([("c", 5, *box), ("d", 1, *box)], TRACK_ROW).write.parquet(src)
    stream = spark.readStream.schema(TRACK_ROW).parquet(src)
    q = (track_stream(stream, count_late=True).writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "ckpt"))
         .outputMode("append").start())
    try:
        q.processAllAvailable()
        spark.createDataFrame([("c", 3, *box), ("c", 4, *box), ("c", 4, *box), ("c", 6, *box), ("d", 2, *box)], TRACK_ROW).write.mode("append").parquet(src)
        q.processAllAvailable()
    finally:
        q.stop()
    rows = spark.read.parquet(out)
    late = [(r.camera_id, r.frame_no, r.late_frames) for r in rows.where("track_id is null").collect()]
    assert late == [("c", 5, 2)]
    assert rows.where("track_id is not null and late_frames is not null").count() == 0


def test_idle_cameras_keep_ids_and_frames():
    import numpy as np

    from framewise.operators.tracker_core import CameraTracker
    tr = CameraTracker(TrackerConfig(budget=5))
    box, feat = np.array([[10.0, 10.0, 20.0, 40.0]]), np.array([[1.0, 0.0]])
    for f in range(1, 6):
        tr.step(f, np.array([1]), box, feat)
    tr.forget_tracks()
    again = CameraTracker.from_state(TrackerConfig(budget=5), tr.to_state())
    assert (len(again.ids), again.gallery, again.next_id, again.last_frame) == (0, {}, 2, 5)
    snap, _ = again.step(9, np.array([1]), box, feat)
    assert snap["track_id"].tolist() == [2]


POSITION = "camera_id string, frame_no bigint, ID bigint, timestamp timestamp, location_x double, w double"


def test_positions_survive_a_restart_once_each(spark, tmp_path, monkeypatch):
    import datetime as dt

    import pytest

    from framewise.sources import messages as MS

    src, out, ckpt = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    now = dt.datetime(2024, 1, 1)

    def send(frames):
        spark.createDataFrame([("c", f, i, now, 1.0 * i, 2.0) for f in frames for i in range(4)], POSITION).write.mode("append").parquet(src)

    send([1])
    stream = spark.readStream.schema(POSITION).parquet(src)
    q = MS.publish_positions(stream, "text", path=out, checkpoint=ckpt)
    q.processAllAvailable()
    send([2])
    q.processAllAvailable()
    q.stop()
    # the third batch is written and then its commit is lost
    write = MS.write_text_batch

    def break_after(values, path, batch_id):
        write(values, path, batch_id)
        raise RuntimeError("executor lost")

    monkeypatch.setattr(MS, "write_text_batch", break_after)
    send([3])
    q = MS.publish_positions(stream, "text", path=out, checkpoint=ckpt)
    with pytest.raises(Exception, match="executor lost"):
        q.processAllAvailable()
    q.stop()
    monkeypatch.setattr(MS, "write_text_batch", write)
    send([4])
    q = MS.publish_positions(stream, "text", path=out, checkpoint=ckpt)
    q.processAllAvailable()
    q.stop()
    back = MS.read_positions(spark.read.text(out))
    assert sorted((r.frame_no, r.ID) for r in back.collect()) == [(f, i) for f in range(1, 5) for i in range(4)]
    with pytest.raises(ValueError, match="checkpoint"):
        MS.publish_positions(stream, "text", path=out)
    with pytest.raises(ValueError, match="unknown sink"):
        MS.publish_positions(back, "csv", path=out)


def test_pipeline_reports_every_batch_and_observes_in_passing(spark):
    """One progress row per micro-batch; the counters observed while parsing equal the counts by camera."""
    import time

    from framewise.plans.q_sources import run_scene_pipeline
    from framewise.streaming.progress import read_progress, stream_latency

    h = run_scene_pipeline(spark, SF_SMALL)
    for _ in range(60):  # reports reach the listener a little later
        rows = read_progress(spark, h.progress).collect()
        intake = sorted((r for r in rows if "intake" in r["query"]), key=lambda r: r.batch_id)
        if len(intake) == 5:
            break
        time.sleep(1)
    assert [r.batch_id for r in intake] == list(range(5)) and all(r.duration_s > 0 and r.phases for r in intake)
    counts = spark.read.parquet(h.counts).groupBy("batch_id").agg(*[F.sum(c).alias(c) for c in ("received", "malformed", "stale")]).collect()
    assert {r.batch_id: (r.received, r.malformed, r.stale) for r in counts} == \
        {r.batch_id: tuple(r.observed["intake"][c] for c in ("received", "malformed", "stale")) for r in intake}
    assert all(r.rows == r.observed["intake"]["received"] for r in intake)
    total = {r["query"]: r for r in stream_latency(read_progress(spark, h.progress)).collect()}
    assert total[intake[0]["query"]].n_batches == 5 and total[intake[0]["query"]].total_s > 0


def test_replayed_batch_keeps_its_clock(spark, tmp_path, monkeypatch):
    """The freshness clock is recorded with the batch: a batch that runs again later drops the same frames."""
    import json
    import time

    import pytest

    from framewise.streaming import pipeline as PL

    base, src = str(tmp_path / "base"), str(tmp_path / "in")
    stamp = spark.sql("select date_format(current_timestamp(), \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")").first()[0]
    rows = [(c, json.dumps({"camera_id": c, "timestamp": stamp, "image": "W10="})) for c in ("a", "b")]
    rows.append(("old", json.dumps({"camera_id": "old", "timestamp": "2020-01-01T00:00:00.000000", "image": "W10="})))
    spark.createDataFrame(rows, "key string, value string").write.json(src)

    def detector():
        import pandas as pd
        return lambda pdf: pd.DataFrame({"camera_id": pdf["camera_id"], "frame_no": pdf["frame_no"],
                                         **{c: [None] * len(pdf) for c in ("det_id", "x", "y", "w", "h", "score", "feature")}})

    stream = spark.readStream.schema("key string, value string").json(src)
    count = PL.count_classified

    def lost(*a):
        raise RuntimeError("lost")

    monkeypatch.setattr(PL, "count_classified", lost)
    h = PL.tracking_pipeline(spark, stream, detector, base, max_age_s=4)
    with pytest.raises(Exception, match="lost"):
        h.intake.processAllAvailable()
    h.stop()
    first = sorted((r.claimed, r.status) for r in spark.read.parquet(f"{base}/intake/batch_id=0").collect())
    time.sleep(6)  # by the wall clock the fresh frames are stale now
    monkeypatch.setattr(PL, "count_classified", count)
    h = PL.tracking_pipeline(spark, stream, detector, base, max_age_s=4)
    h.intake.processAllAvailable()
    h.stop()
    again = sorted((r.claimed, r.status) for r in spark.read.parquet(f"{base}/intake/batch_id=0").collect())
    assert again == first and ("old", "stale") in again
    assert len({s for c, s in again if c != "old"}) == 1


def test_a_micro_batch_is_taken_in_slices_and_its_samples_stay_numbers(monkeypatch):
    """Memory: rows of a batch as arrays, outputs slice by slice, galleries as bytes in the state."""
    import numpy as np
    import pandas as pd

    from framewise.operators.tracker_core import CameraTracker
    from framewise.streaming import tracking as ST

    monkeypatch.setattr(ST, "SLICE", 10)
    n = 60
    rows = [(f, None, None, *[np.nan] * 4, None) for f in range(n)] + [(f, o, o, 200.0 * o + f, 0.0, 40.0, 80.0, np.eye(2)[o]) for f in range(n) for o in range(2)]
    pdf = pd.DataFrame(rows, columns=["frame_no", "det_id", "_place", "x", "y", "w", "h", "feature"]).sample(frac=1, random_state=1)
    batch = ST._Batch(iter([pdf.iloc[:70], pdf.iloc[70:70], pdf.iloc[70:]]), "frame_no", "feature")
    assert batch.late(4) == 5 and batch.late(None) == 0
    parts = list(batch.slices(4))
    assert len(parts) > 10 and max(len(p[0]) for p in parts) <= 12
    frames = np.concatenate([p[0] for p in parts])
    assert frames.tolist() == sorted([*range(5, n)] * 3)
    assert np.isnan(np.concatenate([p[1] for p in parts])[::3]).all()
    assert len({f for p in parts for f in set(p[0].tolist())}) == sum(len(set(p[0].tolist())) for p in parts)
    tr = CameraTracker(TrackerConfig())
    for f in range(200):
        tr.step(f, np.array([1]), np.array([[10.0, 10, 20, 40]]), np.array([[1.0, 0.1]]))
    state = tr.to_state()
    assert isinstance(state[0][0][9], bytes) and len(state[0][0][9]) == 200 * 16
    again = CameraTracker.from_state(TrackerConfig(), state)
    assert (again.gallery[1].samples == tr.gallery[1].samples).all() and again.gallery[1].balls[0][2] == 3
