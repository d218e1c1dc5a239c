import itertools

from pyspark.sql import functions as F

from framewise.llm import sharding
from framewise.llm.common import read_documents

SF = "/root/testdata/sf0.01"


def brute_hilbert(point, bits):
    """Place on the curve by Skilling's transform in plain integers."""
    x, n = list(point), len(point)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            if x[i] & q:
                x[0] ^= p
            else:
                t = (x[0] ^ x[i]) & p
                x[0] ^= t
                x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t, q = 0, 1 << (bits - 1)
    while q > 1:
        if x[n - 1] & q:
            t ^= q - 1
        q >>= 1
    x = [v ^ t for v in x]
    out = 0
    for b in range(bits - 1, -1, -1):
        for v in x:
            out = out * 2 + (v >> b & 1)
    return out


def test_index_is_a_hilbert_curve(spark):
    points = list(itertools.product(range(8), repeat=3))
    df = spark.createDataFrame(points, "a int, b int, c int")
    got = {(r.a, r.b, r.c): r.h for r in df.withColumn("h", sharding.hilbert_index([F.col(c) for c in "abc"], 3)).collect()}
    assert got == {p: brute_hilbert(p, 3) for p in points}
    order = sorted(points, key=got.get)
    assert sorted(got.values()) == list(range(512))
    assert all(sum(abs(a - b) for a, b in zip(p, q, strict=True)) == 1 for p, q in zip(order, order[1:], strict=False))


def test_shards_are_equal_runs(spark):
    docs = read_documents(spark, SF)
    out = sharding.op1_hilbert(docs).toPandas()
    assert len(out) == docs.count() and out.doc_id.is_unique
    counts = out.groupby("shard").size()
    assert set(counts.index) == set(range(8)) and counts.max() - counts.min() <= 1
    for _, g in out.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    placed = out.sort_values(["shard", "slot"])
    assert placed.curve.is_monotonic_increasing


def test_files_are_prunable(spark, tmp_path):
    docs = read_documents(spark, SF)
    out = sharding.hilbert_shards(docs.select("doc_id", "source", "lang", "n_chars"), ["source", "lang", "n_chars"], ["doc_id"], 8)
    sharding.write_shards(out, str(tmp_path / "s"), 8)
    back = spark.read.parquet(str(tmp_path / "s"))
    spans = back.groupBy("shard").agg(F.count_distinct("lang").alias("l"), F.count_distinct("source").alias("s")).toPandas()
    assert back.count() == docs.count()
    assert spans.l.mean() * spans.s.mean() < 0.6 * 4 * 20  # far fewer combinations than all of them
