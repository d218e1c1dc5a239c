"""Product codes against a search that evaluates every entry."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewise.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, parts=8, entries=16, rounds=6):
    kept = [(i, [math.floor(4096 * float(np.float32(x))) for x in v], lab) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] if r[0] is not None else 0, r[1]))
    w = len(kept[0][1]) // parts

    def cut(v, p):
        return v[p * w:(p + 1) * w]

    def gap(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))

    books = [[cut(v, p) for _, v, _ in kept[:entries]] for p in range(parts)]

    def nearest(p, v):
        return min((gap(cut(v, p), e), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for _, v, _ in kept:
                groups.setdefault(nearest(p, v)[1], []).append(cut(v, p))
            for k, g in groups.items():
                books[p][k] = [sum(c) // len(g) for c in zip(*g, strict=True)]
    out, sums = [], {}
    for i, v, lab in kept:
        best = [nearest(p, v) for p in range(parts)]
        error = sum(d for d, _ in best)
        out.append((i, "".join(f"{k:02x}" for _, k in best), error, lab))
        sums[lab] = sums.get(lab, 0) + error
    text = ",".join(str(x) for b in books for e in b for x in e)
    return sorted((str(i), c, e, sums[lab], hashlib.sha256(text.encode()).hexdigest()) for i, c, e, lab in out)


def rows_of(df):
    return sorted((str(r["vec_id"]), r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in df.collect())


def some_rows(n, seed, width=16):
    rnd = random.Random(seed)
    centres = [[rnd.gauss(0, 0.2) for _ in range(width)] for _ in range(5)]
    rows = [(i, [c + rnd.gauss(0, 0.05) for c in rnd.choice(centres)], rnd.choice([None, 1, 2, 3])) for i in range(n)]
    rows += [(5, rows[5][1], 1), (3, rows[9][1], None), (None, rows[2][1], 2)]  # repeated id and vector, null id
    rows += [(900, None, 1), (901, [None] * width, 1), (902, [float("nan")] * width, 1), (903, [float("-inf")] + [0.0] * (width - 1), None)]
    return rows


@pytest.mark.parametrize("n", [3, 40, 200])
def test_equals_full_search(spark, n):
    rows = some_rows(n, n) if n > 9 else some_rows(40, 1)[:n]
    got = vc.op11_vector_codes(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert rows_of(got) == brute(rows)


def test_ties_go_to_the_lower_entry(spark):
    rows = [(i, [0.25 if (i >> k) & 1 else -0.25 for k in range(8)], 0) for i in range(64)]
    assert rows_of(vc.op11_vector_codes(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_undominated_entries_hold_the_nearest_one():
    rnd = np.random.default_rng(3)
    entries = rnd.integers(-900, 900, (16, 4))
    points = rnd.integers(-1000, 1000, (5000, 4))
    gaps = ((points[:, None] - entries) ** 2).sum(2)
    for cell in (1, 100, 256, 5000):
        search = vc.GridSearch(entries, cell)
        for _ in range(2):  # the second time from the memo
            index, dist = search.nearest(points)
            assert (index == gaps.argmin(1)).all() and (dist == gaps.min(1)).all()
    search = vc.GridSearch(entries, 256)
    search.nearest(points)
    assert search.evaluated < points.shape[0] * 16 / 2
    search = vc.GridSearch(entries, 512)
    search.nearest(points)
    assert len(search.memo) <= 4 ** 4 and search.evaluated < points.shape[0] * 16


def test_memo_is_bounded():
    rnd = np.random.default_rng(1)
    search = vc.GridSearch(rnd.integers(-900, 900, (16, 8)), 16, most=100)
    for _ in range(5):
        search.nearest(rnd.integers(-1000, 1000, (500, 8)))
        assert len(search.memo) <= 100


def test_empty_and_all_refused(spark):
    assert vc.op11_vector_codes(spark.createDataFrame([], SCHEMA)).count() == 0
    assert vc.op11_vector_codes(spark.createDataFrame([(1, None, 2), (2, [None], 3)], SCHEMA)).count() == 0
    empty_vectors = vc.op11_vector_codes(spark.createDataFrame([(1, [], 2), (2, [], 2)], SCHEMA)).collect()
    assert [(r["error"], r["label_error"]) for r in empty_vectors] == [(0, 0)] * 2


def test_other_lengths_and_clashing_names(spark):
    rows = [r for r in some_rows(30, 4)] + [(800, [0.5] * 7, 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    plain, books = vc.compress_vectors(df)
    clash, _ = vc.compress_vectors(df.withColumns({c: F.lit("x") for c in ("code", "error", "ints", "__ints", "part", "__n")}))
    assert plain.columns == ["vec_id", "label", "code", "error"]
    assert {r["vec_id"] for r in plain.collect()} == {r[0] for r in some_rows(30, 4)} - {900, 901, 902, 903}
    assert sorted(map(str, plain.select("vec_id", "code").collect())) == sorted(map(str, clash.select("vec_id", "code").collect()))
    assert dict(clash.dtypes)["__ints"] == "string" and len(books.entries) == 8
    with pytest.raises(Exception, match="components must be below"):
        vc.op11_vector_codes(spark.createDataFrame([(1, [1e30] * 8, 1)], SCHEMA)).collect()


def test_group_sum_with_hot_and_many_keys(spark):
    df = spark.range(20000).select(F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 9000).alias("k"), F.col("id").alias("v"))
    want = {}
    for r in df.collect():
        want[r["k"]] = want.get(r["k"], 0) + r["v"]
    got = vc.with_group_sum(df, "k", "v", "s").collect()
    assert len(got) == 20000 and all(r["s"] == want[r["k"]] for r in got)
