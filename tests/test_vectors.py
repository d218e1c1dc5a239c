"""Nearest samples with pruning against all samples."""


import numpy as np
import pytest

from framewise.operators import vectors as VO


def scene(seed, samples, dims=8, targets=6, queries=40):
    """Targets of three tight poses each; queries near some pose, in cameras of very different size."""
    rnd = np.random.default_rng(seed)
    poses = rnd.normal(size=(targets, 3, dims)) * 3
    g, q = [], []
    for t in range(targets):
        for s in range(samples):
            g.append((int(s % 5 == 0), t, s, (poses[t, s % 3] + rnd.normal(size=dims) * 0.05).tolist()))
    for i in range(queries):
        q.append((int(i % 4 == 0), i, (poses[rnd.integers(targets), rnd.integers(3)] + rnd.normal(size=dims) * 0.05).tolist()))
    return g, q


def brute(g, q, metric):
    out = {}
    for cam, i, v in q:
        for c, t, _, w in g:
            if c == cam:
                a, b = np.array(v), np.array(w)
                d = 1 - a @ b / np.linalg.norm(a) / np.linalg.norm(b) if metric == "cosine" else ((a - b) ** 2).sum()
                out[cam, i, t] = min(d, out.get((cam, i, t), np.inf))
    return out


def frames(spark, g, q):
    return (spark.createDataFrame(q, "camera_id int, query_id int, q_feature array<double>"),
            spark.createDataFrame(g, "camera_id int, target_id int, seq int, g_feature array<double>"))


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
@pytest.mark.parametrize("pivots", [1, 4])
def test_same_distances_with_few_comparisons(spark, metric, pivots):
    g, q = scene(1, 150)
    qs, gs = frames(spark, g, q)
    rows = VO.nearest_gallery_distance(qs, gs, metric, pivots=pivots, with_work=True).collect()
    want = brute(g, q, metric)
    got = {(r.camera_id, r.query_id, r.target_id): r.distance for r in rows}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)
    if pivots > 1:
        assert sum(r.compared for r in rows) < sum(1 for c, *_ in q for d, *_ in g if c == d) / 1.5


def test_share_of_comparisons_falls_as_the_gallery_grows(spark):
    share = []
    for n in (30, 300):
        g, q = scene(2, n)
        qs, gs = frames(spark, g, q)
        rows = VO.nearest_gallery_distance(qs, gs, "euclidean", pivots=8, with_work=True).collect()
        share.append(sum(r.compared for r in rows) / sum(1 for c, *_ in q for d, *_ in g if c == d))
    assert share[1] < share[0] and share[1] < 0.5


def test_limit_prunes_whole_targets(spark):
    g, q = scene(3, 90)
    qs, gs = frames(spark, g, q)
    rows = VO.nearest_gallery_distance(qs, gs, "cosine", pivots=8, max_distance=0.01, with_work=True).collect()
    want = {k: d for k, d in brute(g, q, "cosine").items() if d <= 0.01}
    assert {(r.camera_id, r.query_id, r.target_id) for r in rows} == want.keys() and want
    assert sum(r.compared for r in rows) < sum(1 for c, *_ in q for d, *_ in g if c == d) / 4


def test_empty_sides_and_repeated_samples(spark):
    g, q = scene(4, 10)
    qs, gs = frames(spark, g, q)
    assert VO.nearest_gallery_distance(qs, gs.limit(0)).count() == 0
    assert VO.nearest_gallery_distance(qs.limit(0), gs).count() == 0
    twice = VO.nearest_gallery_distance(qs, gs.union(gs), "euclidean").collect()
    want = brute(g, q, "euclidean")
    assert {(r.camera_id, r.query_id, r.target_id): round(r.distance, 9) for r in twice} == {k: round(v, 9) for k, v in want.items()}


def test_slices_change_nothing(spark):
    g, q = scene(5, 12)
    qs, gs = frames(spark, g, q)
    one = sorted((r.query_id, r.seq, r.target_id, round(r.distance, 9)) for r in VO.cosine_distance_pairs(qs, gs, ["camera_id"], "q_feature", "g_feature", slices=1).collect())
    many = sorted((r.query_id, r.seq, r.target_id, round(r.distance, 9)) for r in VO.cosine_distance_pairs(qs, gs, ["camera_id"], "q_feature", "g_feature", slices=5).collect())
    assert one == many and len(one) == sum(1 for c, *_ in q for d, *_ in g if c == d)
