"""Findings of round 3: anchors, targets, frame coverage, feature store and candidates at size."""

from pyspark.sql import functions as F

from framewise.config import DEFAULT_ANCHORS
from framewise.operators import detector as DET
from framewise.plans import q_detector as QD
from framewise.plans import q_offline as QO
from framewise.sources import mot as MOT

TRUTH = "image_id long, box_no long, x1 double, y1 double, x2 double, y2 double, class_id int"
TRUTHS = [(1, 1, 10.0, 20.0, 70.0, 90.0, 3), (1, 2, 12.0, 22.0, 72.0, 92.0, 5), (1, 3, 12.0, 22.0, 72.0, 92.0, 3),
          (2, 1, 100.0, 100.0, 112.0, 116.0, 1), (2, 2, 200.0, 200.0, 200.0, 216.0, 1), (3, 1, None, 1.0, 2.0, 3.0, 1)]
RAW = "vec_id long, image_id long, level int, anchor_id int, gy int, gx int, logits array<double>"


def raw_rows(spark):
    rows = [(10 * im + a, im, 0 if a >= 6 else 1 if a >= 3 else 2, a, 3, 4, [0.1 * a, -0.2, 0.3, 0.1, 3.0, 2.5, -1.0, 3.0])
            for im in (1, 2) for a in range(9)]
    return spark.createDataFrame(rows, RAW)


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_best_anchor_is_compiled_and_first_of_equals(spark):
    rows = [(float(w), float(h)) for w, h in [*DEFAULT_ANCHORS, (1, 1), (15, 18), (500, 400), (61, 62)]]
    sizes = spark.createDataFrame([*rows, (None, 5.0)], "bw_px double, bh_px double")

    def iou(w, h, aw, ah):
        inter = min(w, aw) * min(h, ah)
        return inter / (w * h + aw * ah - inter)

    for anchors in (DEFAULT_ANCHORS, [(30, 30), (10, 90), (90, 10), (30, 30)], [(7, 9)]):
        out = DET.best_anchor_shape(sizes, anchors)
        assert out.columns == ["bw_px", "bh_px", "anchor_id", "anchor_iou"] and "lambda" not in plan_of(out)
        for r in out.collect():
            if r.bw_px is None:
                assert (r.anchor_id, r.anchor_iou) == (0, None)
                continue
            all_ = [iou(r.bw_px, r.bh_px, *map(float, a)) for a in anchors]
            assert (r.anchor_id, r.anchor_iou) == (all_.index(max(all_)), max(all_))


def test_targets_of_equal_cells_on_all_tasks(spark):
    t = DET.assign_truth_to_anchors(spark.createDataFrame(TRUTHS, TRUTH))
    assert "RepartitionByExpression" in plan_of(t)
    got = {(r.image_id, r.classes[0]): r for r in t.collect()}
    assert len(got) == 2 and got[(2, 1)].tw == 12 / 416
    one = got[(1, 3)]
    assert one.classes == [3, 5] and (one.tx, one.ty) == (42 / 416, 57 / 416)


def test_loss_takes_its_targets_from_one_pass(spark, monkeypatch):
    monkeypatch.setattr(QD, "fixture", lambda s, sf, name: raw_rows(spark) if name == "fx_raw" else spark.createDataFrame(TRUTHS, TRUTH))
    losses = QD._losses(spark, None)
    assert "collect_set" not in plan_of(losses)
    assert sorted({r.image_id for r in losses.collect()}) == [1, 2]


def test_coverage_is_made_by_all_tasks(spark):
    dets = [("a", f) for f in (3, 3, 3999, 17, 40_000)] + [("b", -5000), ("b", 3), ("c", 7), (None, 1), (None, 2), ("d", None), ("a", None)]
    images = [("a", 2), ("a", 3), ("a", 3), ("a", 40_001), ("b", -4097), ("b", None), (None, 1), ("e", 1), ("c", 7)]
    d = spark.createDataFrame(dets, "sequence string, frame_no int")
    i = spark.createDataFrame(images, "sequence string, frame_no int")
    for wide in (d, d.withColumn("frame_no", F.col("frame_no").cast("long")), d.withColumn("frame_no", F.col("frame_no").cast("double"))):
        cov, dropped = MOT.frame_coverage(wide, i)
        want = []
        for s in ("a", "b", "c", None):
            have = [f for k, f in dets if k == s and f is not None]
            want += [(s, f, s is not None and f in have, s is not None and (s, f) in images) for f in range(min(have), max(have) + 1)]
        assert sorted(map(tuple, cov.collect()), key=str) == sorted(want, key=str)
        assert cov.schema["frame_no"].dataType.typeName() == "integer"
        assert dropped.count() == len(dets) - 3
    assert "Join" not in plan_of(cov)
    assert cov.select(F.spark_partition_id().alias("p")).distinct().count() > 2


def dets_of(spark):
    return spark.range(4000).select(F.concat(F.lit("cam"), (F.col("id") % 2).cast("string")).alias("camera_id"), F.col("id").alias("frame_no"),
                                    F.lit(1).cast("long").alias("det_id"), *[F.col("id").cast("double").alias(c) for c in "xywh"])


def test_store_is_written_and_checked_by_all_tasks(spark, monkeypatch):
    monkeypatch.setattr(QO, "fixture", lambda s, sf, name: dets_of(spark))
    out = QO.q_s10(spark, None)
    assert out.columns == ["sequence", "frame", "det", "x", "y", "area", "in_order"]
    assert out.select(F.spark_partition_id().alias("p")).distinct().count() > 2
    rows = out.collect()
    assert len(rows) == 4000 and all(r.in_order and r.area == r.frame ** 2 for r in rows)


def test_candidates_leave_logits_behind(spark, monkeypatch):
    monkeypatch.setattr(QD, "fixture", lambda s, sf, name: raw_rows(spark))
    out = QD.q_n2(spark, None)
    fold = [line for line in plan_of(out).splitlines() if "collect_list" in line]
    assert fold and not any("logits" in line or "gy" in line or "image_w" in line for line in fold)
    assert out.columns == ["image_id", "class_id", "vec_id", "pick"] and out.count() > 0
