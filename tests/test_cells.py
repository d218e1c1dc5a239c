"""Pairs through cells against all pairs, and the plan that makes them."""

import random

import pytest
from pyspark.sql import functions as F

from framewise.operators import cells
from framewise.operators import detector as DET
from framewise.operators import geometry as G
from framewise.operators.cells import cell_pairs


def boxes(n, seed, frames=3):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        size = rnd.choice([0, 1, 30, 200, 5000])
        x, y = rnd.uniform(-300, 300), rnd.uniform(-300, 300)
        out.append((rnd.choice([None, *range(frames)]), i, x, y, x + size * rnd.random(), y + size * rnd.random()))
    return [*out, (0, n, None, 0.0, 1.0, 1.0), (1, n + 1, -128.0, -128.0, 128.0, 128.0), (1, n + 2, 128.0, 128.0, 128.0, 128.0)]


def meet(a, b):
    return (a[0] is not None and a[0] == b[0] and None not in a and None not in b
            and max(a[2], b[2]) <= min(a[4], b[4]) and max(a[3], b[3]) <= min(a[5], b[5]))


def corners(p):
    return tuple(F.col(f"{p}_{c}") for c in ("x1", "y1", "x2", "y2"))


def frame_of(spark, rows, p):
    return spark.createDataFrame(rows, f"frame int, {p} int, {p}_x1 double, {p}_y1 double, {p}_x2 double, {p}_y2 double")


@pytest.mark.parametrize("small", [0, 256, 10**6])
@pytest.mark.parametrize("cell", [16.0, 128.0])
def test_every_pair_once(spark, monkeypatch, cell, small):
    monkeypatch.setattr(cells, "SMALL_FRAME", small)
    left, right = boxes(60, 1), boxes(60, 2)
    a, b = frame_of(spark, left, "a"), frame_of(spark, right, "b")
    want = sorted((x[1], y[1]) for x in left for y in right if meet(x, y))
    got = cell_pairs(a, b, ["frame"], corners("a"), corners("b"), cell)
    assert sorted((r.a, r.b) for r in got.collect()) == want and len(want) > 100
    kept = cell_pairs(a, b, ["frame"], corners("a"), corners("b"), cell, keep_left=True).collect()
    assert sorted((r.a, r.b) for r in kept if r.b is not None) == want
    assert sorted(r.a for r in kept if r.b is None) == sorted(x[1] for x in left if x[0] is not None)


def test_one_shuffle_and_no_lookup(spark):
    """Each side is read once, both are shuffled together, and no subquery runs before."""
    a, b = frame_of(spark, boxes(20, 3), "a"), frame_of(spark, boxes(20, 4), "b")
    df = cell_pairs(a, b, ["frame"], corners("a"), corners("b"), 64.0)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Scan ExistingRDD") == 2 and "ubquery" not in plan and "Join" not in plan


def test_iou_is_symmetric(spark):
    a, b = boxes(40, 5), boxes(40, 6)

    def tlwh(rows, p):
        return frame_of(spark, rows, p).select("frame", p, F.col(f"{p}_x1").alias(f"{p}_x"), F.col(f"{p}_y1").alias(f"{p}_y"),
                                               (F.col(f"{p}_x2") - F.col(f"{p}_x1")).alias(f"{p}_w"), (F.col(f"{p}_y2") - F.col(f"{p}_y1")).alias(f"{p}_h"))

    names = {p: tuple(f"{p}_{c}" for c in "xywh") for p in "lr"}
    one = {(r.l, r.r): r.iou for r in G.pairwise_iou(tlwh(a, "l"), tlwh(b, "r"), ["frame"], names["l"], names["r"]).collect()}
    other = {(r.r, r.l): r.iou for r in G.pairwise_iou(tlwh(b, "l"), tlwh(a, "r"), ["frame"], names["l"], names["r"]).collect()}
    assert one.keys() == other.keys() and all(0 < v <= 1 and v == pytest.approx(other[k]) for k, v in one.items())


def test_predictions_without_truth_stay(spark):
    preds = spark.createDataFrame([(1, 10, .5, .5, .2, .2, [.1]), (1, 11, .9, .9, .1, .1, [.2]), (2, 12, .5, .5, .2, .2, [.3])],
                                  "image_id int, vec_id int, bx double, by double, bw double, bh double, class_probs array<double>")
    truths = spark.createDataFrame([(1, .5, .5, .2, .2), (1, .55, .5, .2, .2), (3, .5, .5, .2, .2), (1, .9, .9, 0.0, .1)],
                                   "image_id int, tx double, ty double, tw double, th double")
    out = DET.best_truth_iou(preds, truths)
    assert out.columns == [*preds.columns, "best_iou", "ignore"]
    got = {r.vec_id: (round(r.best_iou, 6), r.ignore, r.class_probs) for r in out.collect()}
    assert got == {10: (1.0, False, [.1]), 11: (0.0, True, [.2]), 12: (0.0, True, [.3])}
