import base64
import json

import pytest

from framewise.sources import dims as DM
from framewise.sources import messages as MS
from framewise.sources import mot as MOT


def test_frame_index_reads_paths_only(spark, tmp_path):
    for seq, frames in {"MOT-02": [1, 2, 5], "MOT-04": [3]}.items():
        d = tmp_path / seq / "img1"
        d.mkdir(parents=True)
        for f in frames:
            (d / f"{f:06d}.jpg").write_bytes(b"\xff\xd8not-an-image")
        (tmp_path / seq / "det").mkdir()
    idx = MOT.read_frame_index(spark, str(tmp_path))
    got = sorted((r.sequence, r.frame_no) for r in idx.collect())
    assert got == [("MOT-02", 1), ("MOT-02", 2), ("MOT-02", 5), ("MOT-04", 3)]


def test_mot_layout_and_coverage(spark, tmp_path):
    seq = tmp_path / "S1"
    (seq / "det").mkdir(parents=True)
    (seq / "img1").mkdir()
    (seq / "det" / "det.txt").write_text("1,-1,10,20,30,40,0.9,-1,-1,-1\n3,-1,1,2,3,4,0.5,-1,-1,-1\n"
                                         "3,-1,5,6,7,8,0.7,-1,-1,-1\n")
    for f in (1, 2):
        (seq / "img1" / f"{f:06d}.jpg").write_bytes(b"x")
    dets = MOT.read_mot_detections(spark, str(tmp_path))
    rows = sorted((r.sequence, r.frame_no, r.x, r.y, r.w, r.h) for r in dets.collect())
    assert rows == [("S1", 1, 10.0, 20.0, 30.0, 40.0), ("S1", 3, 1.0, 2.0, 3.0, 4.0), ("S1", 3, 5.0, 6.0, 7.0, 8.0)]
    cov, dropped = MOT.frame_coverage(dets, MOT.read_frame_index(spark, str(tmp_path)))
    assert sorted((r.frame_no, r.has_dets, r.has_image) for r in cov.collect()) == \
        [(1, True, True), (2, False, True), (3, True, False)]
    assert dropped.count() == 2


def test_load_dimensions_keeps_file_order(spark, tmp_path):
    (tmp_path / "classes.txt").write_text("person\n bicycle \ncar\n")
    (tmp_path / "anchors.txt").write_text("10,13,  16,30, 33,23\n")
    classes, anchors = DM.load_dimensions(spark, str(tmp_path / "classes.txt"), str(tmp_path / "anchors.txt"))
    assert [(r.class_id, r.class_name) for r in classes.orderBy("class_id").collect()] == \
        [(0, "person"), (1, "bicycle"), (2, "car")]
    assert [(r.anchor_id, r.anchor_w, r.anchor_h) for r in anchors.orderBy("anchor_id").collect()] == \
        [(0, 10.0, 13.0), (1, 16.0, 30.0), (2, 33.0, 23.0)]


def test_parse_frame_messages_reasons(spark):
    img = base64.b64encode(b"abc").decode()
    msgs = [
        (1, json.dumps({"camera_id": "c1", "timestamp": "2024-01-01T00:00:01.500000", "image": img})),
        (2, json.dumps({"timestamp": "2024-01-01T00:00:01.500000", "image": img})),
        (3, json.dumps({"camera_id": "c1", "timestamp": "yesterday", "image": img})),
        (4, json.dumps({"camera_id": "c1", "timestamp": "2024-01-01T00:00:01.500000", "image": "!!"})),
        (5, '{"camera_id": "c1", "times'),
    ]
    df = spark.createDataFrame(msgs, "key long, value string")
    good, rejects = MS.parse_frame_messages(df)
    g = good.collect()
    assert [(r.key, r.camera_id, bytes(r.image)) for r in g] == [(1, "c1", b"abc")]
    assert sorted((r.key, r.reason) for r in rejects.collect()) == \
        [(2, "missing_camera"), (3, "bad_time"), (4, "bad_base64"), (5, "bad_json")]


def test_stale_filter_whole_seconds(spark):
    from pyspark.sql import functions as F

    from framewise.operators.frames import drop_stale_frames
    rows = [(i, f"2024-01-01 00:00:{s}") for i, s in enumerate(["00.000000", "04.100000", "05.000000",
                                                                    "10.500000", "11.000000"])]
    df = spark.createDataFrame(rows, "id int, ts string").withColumn("ts", F.to_timestamp("ts"))
    now = F.lit("2024-01-01 00:00:10").cast("timestamp")
    kept = sorted(r.id for r in drop_stale_frames(df, now, "ts", 5).collect())
    # ages: 10 s, 5.9 s, 5.0 s, -0.5 s (future), -1 s (future)
    assert kept == [1, 2]


def test_kafka_gate_turns_a_missing_connector_into_a_clear_error():
    def absent():
        raise ValueError("Failed to find data source: kafka")

    def other():
        raise ValueError("no such topic")

    with pytest.raises(RuntimeError, match="not deployed"):
        MS._kafka_gated(absent)
    with pytest.raises(ValueError, match="no such topic"):
        MS._kafka_gated(other)
    assert MS._kafka_gated(lambda: 5) == 5


def test_wide_mot_rows_pass_through(spark, tmp_path):
    d = tmp_path / "s1" / "det"
    d.mkdir(parents=True)
    (d / "det.txt").write_text("3,-1,1,2,30,40,0.5,-1,-1,-1,7,8\n\n4,-1, 5,6,7,8,1\n")
    rows = {r["frame_no"]: r for r in MOT.read_mot_detections(spark, str(tmp_path)).collect()}
    assert rows[3]["row"] == [3, -1, 1, 2, 30, 40, 0.5, -1, -1, -1, 7, 8]
    assert (rows[4]["x"], rows[4]["h"], len(rows[4]["row"])) == (5, 8, 7)


def test_blank_class_lines_keep_their_number(spark, tmp_path):
    (tmp_path / "c").write_text("person\n\ncar\n")
    (tmp_path / "a").write_text("1,2, 3,4\n")
    classes, _ = DM.load_dimensions(spark, str(tmp_path / "c"), str(tmp_path / "a"))
    assert {r["class_id"]: r["class_name"] for r in classes.collect()} == {0: "person", 1: "", 2: "car"}
