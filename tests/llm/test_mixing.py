import numpy as np

from framewise.llm import mixing
from framewise.llm.common import read_documents

SF = "/root/testdata/sf0.01"


def test_timetable_keeps_pfair_windows():
    rng = np.random.default_rng(0)
    for _ in range(60):
        parts = mixing.shares(rng.random(rng.integers(1, 30)).tolist(), 256)
        assert sum(parts) == 256 and min(parts) >= 1
        slots = np.array(mixing.timetable(parts))
        for i, q in enumerate(parts):
            lag = np.arange(1, 257) * q / 256 - np.cumsum(slots == i)
            assert (np.abs(lag) < 1).all()


def test_segments_cover_all_blocks():
    rng = np.random.default_rng(1)
    for _ in range(40):
        n = int(rng.integers(1, 8))
        blocks, weights = rng.integers(0, 60, n).tolist(), rng.random(n).tolist()
        segments, slots = mixing.schedule(blocks, weights, 64)
        place = {(a, b, c): t for a, b, c, t in slots}
        at = sorted(s["start"] + k // s["share"] * 64 + place[s["seg"], s["src"], k % s["share"]] for s in segments for k in range(s["blocks"]))
        assert at == list(range(sum(blocks)))
        for i, b in enumerate(blocks):
            assert sum(s["blocks"] for s in segments if s["src"] == i) == b


def test_positions_and_deviation(spark):
    docs = read_documents(spark, SF)
    out = mixing.op6_mix(docs).toPandas().sort_values("position")
    assert out.position.tolist() == list(range(docs.count()))
    n = out.groupby("source").size()
    w = np.sqrt(n) / np.sqrt(n).sum()
    first_out = min(n[s] / w[s] for s in n.index)  # rows until some source runs out
    for s in n.index:
        seen = (out.source == s).cumsum().to_numpy()[: int(first_out * 0.9)]
        # one block, the rounding of weights to the period, and a source's unfinished block
        assert np.abs(seen - w[s] * np.arange(1, len(seen) + 1)).max() < 8 * 2 + len(seen) / mixing.PERIOD


def test_given_weights_pooled_and_null_sources(spark):
    rows = [(i, ["a", "b", None, "rare1", "rare2"][min(i % 7, 4)]) for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, source string")
    for kw in ({"weights": {"a": 0.7, "b": 0.2, "zz": 0.1}}, {"max_sources": 3}, {"block": 1}, {"block": 1000}):
        out = mixing.mix(df, ["doc_id"], **kw).toPandas()
        assert sorted(out.position) == list(range(500)) and out.doc_id.is_unique
    heavy = mixing.mix(df, ["doc_id"], weights={"a": 0.9, "b": 0.1}, block=1).toPandas().sort_values("position")
    assert (heavy.source[:70] == "a").sum() > 40


def test_rows_in_mixed_order(spark):
    docs = read_documents(spark, SF)
    mixed = mixing.in_mixed_order(docs, ["doc_id"])
    assert mixed.columns == docs.columns
    want = mixing.op6_mix(docs).orderBy("position").select("doc_id").collect()
    assert [r["doc_id"] for r in mixed.collect()] == [r["doc_id"] for r in want]


def test_deviation_from_true_weights_stays_below_one_block():
    """The bound holds against the weights as given, however many periods pass."""
    rng = np.random.default_rng(2)
    cases = [[1.0] * 20, [1.0, 1e-5, 0.3], rng.random(30).tolist()]
    for weights in cases:
        target = np.array(weights) / sum(weights)
        blocks = np.floor(40_000 * target).astype(int) + 1
        segments, slots = mixing.schedule(blocks.tolist(), weights)
        order = np.empty(blocks.sum(), int)
        place = {(a, b, c): t for a, b, c, t in slots}
        for s in segments:
            for k in range(s["blocks"]):
                order[s["start"] + k // s["share"] * mixing.PERIOD + place[s["seg"], s["src"], k % s["share"]]] = s["src"]
        order = order[:39_000]  # no source has run out
        for i, w in enumerate(target):
            lag = np.cumsum(order == i) - w * np.arange(1, len(order) + 1)
            assert np.abs(lag).max() < 1


def test_sources_keep_to_the_fluid_after_one_runs_out():
    blocks, weights = np.array([500, 2000, 3000]), np.array([0.5, 0.3, 0.2])
    seen = np.cumsum(np.eye(3, dtype=int)[[i for i, _ in mixing.deal(blocks.tolist(), weights.tolist())]], axis=0)
    t = np.arange(1, len(seen) + 1)[:, None]
    late = weights[1:] * 1000  # what the two had when the first ran out, after 1000 slots
    want = np.hstack([np.minimum(t * 0.5, 500), np.where(t <= 1000, t * weights[1:], late + (t - 1000) * weights[1:] / 0.5)])
    assert np.abs(seen - want)[:3800].max() < 1


def test_places_leave_the_driver_in_stretches(spark, monkeypatch):
    monkeypatch.setattr(mixing, "STRETCH", 7)
    df = spark.createDataFrame([(i, "ab"[i % 3 == 0]) for i in range(200)], "doc_id long, source string")
    assert sorted(r["position"] for r in mixing.mix(df, ["doc_id"], block=4).collect()) == list(range(200))


def lags(out, weights):
    """Largest deviation of each source from its target, in rows, while all have rows left."""
    left = int(min((out.source == s).sum() / w for s, w in weights.items()) * 0.9)
    head = out.sort_values("position").source[:left]
    return {s: np.abs(np.cumsum(head == s) - w * np.arange(1, left + 1)).max() for s, w in weights.items()}


def test_each_of_many_sources_keeps_to_its_weight(spark):
    sizes = {f"s{i}": 12 + i % 17 for i in range(150)}
    df = spark.createDataFrame([(i, s) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))], "doc_id long, source string")
    out = mixing.mix(df, ["doc_id"], block=1).toPandas()
    assert sorted(out.position) == list(range(sum(sizes.values())))
    total = sum(n ** 0.5 for n in sizes.values())
    assert max(lags(out, {s: n ** 0.5 / total for s, n in sizes.items()}).values()) < 1


def test_small_sources_keep_given_weights(spark):
    rows = [(i, f"big{i % 70}") for i in range(1400)] + [(1400 + i, "small") for i in range(10)] + [(1410 + i, None) for i in range(10)]
    df = spark.createDataFrame(rows, "doc_id long, source string")
    goal = {"small": 0.25, None: 0.25, "big0": 0.5}
    out = mixing.mix(df, ["doc_id"], weights={**goal, "absent": 5.0}, block=1).toPandas().sort_values("position")
    out["source"] = out.source.astype(object).where(out.source.notna(), None)
    assert out.position.tolist() == list(range(1420))
    assert set(out.source[:40]) == set(goal)  # the others have no weight, and the absent source's goes to nobody
    head = out.source[:36].map(lambda s: s or "none")
    for s, w in {"small": 0.25, "none": 0.25, "big0": 0.5}.items():
        assert np.abs(np.cumsum(head == s) - w * np.arange(1, 37)).max() < 1


def test_asked_for_pool_has_the_summed_weight(spark):
    df = spark.createDataFrame([(i, "big" if i < 100 else f"s{i % 25}") for i in range(200)], "doc_id long, source string")
    out = mixing.mix(df, ["doc_id"], block=1, max_sources=2).toPandas()
    out["source"] = np.where(out.source == "big", "big", "pool")
    share = 10 / (10 + 25 * 2)
    assert max(lags(out, {"big": share, "pool": 1 - share}).values()) < 1


def test_sources_of_any_type(spark):
    """Whole numbers and dates as sources: the same order as their texts, with and without weights."""
    rows = [(i, i % 3 if i % 10 else None) for i in range(400)]
    numbers = spark.createDataFrame(rows, "doc_id long, source int")
    texts = numbers.withColumn("source", numbers.source.cast("string"))
    for weights in (None, {0: 3.0, 1: 1.0, None: 2.0}):
        named = weights and {None if s is None else str(s): w for s, w in weights.items()}
        a = {r["doc_id"]: r["position"] for r in mixing.mix(numbers, ["doc_id"], weights).collect()}
        b = {r["doc_id"]: r["position"] for r in mixing.mix(texts, ["doc_id"], named).collect()}
        assert a == b and sorted(a.values()) == list(range(400))
