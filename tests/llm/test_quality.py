import numpy as np

from framewise.llm import quality as q
from framewise.llm.common import read_documents

SF = "/root/testdata/sf0.01"


def test_held_out_ranking(spark):
    docs, labels = read_documents(spark, SF), spark.read.parquet(f"{SF}/labels.parquet")
    out = q.op8_quality(docs, labels).toPandas()
    assert len(out) == docs.count() and out.score.between(0, 1).all()
    assert ((out.score >= 0.5) == (out.predicted == 1)).all()
    held = out[out.held_out].merge(labels.toPandas(), on="doc_id")
    ranks, pos = held.score.rank(), held.quality == 1
    auc = (ranks[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())
    assert auc > 0.95 and (held.predicted == held.quality).mean() > 0.95


def test_held_out_labels_do_not_matter(spark):
    docs, labels = read_documents(spark, "/root/testdata/sf0.001"), spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    turned = labels.selectExpr("doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 3 = 1 then 1 - quality else quality end as quality")
    a, b = (q.op8_quality(docs, x).toPandas().sort_values("doc_id").score.to_numpy() for x in (labels, turned))
    assert np.allclose(a, b)


def test_partition_sums_equal_one_matrix(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, len(q.STATS)))
    y = (x[:, 0] + 0.3 * rng.normal(size=200) > 0).astype(int)
    df = spark.createDataFrame([(a.tolist(), int(b)) for a, b in zip(x, y, strict=True)], "stats array<double>, y int")
    many = q.fit_quality(df.repartition(7), features=32)
    z = many.features(x)
    w = np.where(y > 0, 200 / (2 * y.sum()), 200 / (2 * (1 - y).sum()))
    want = np.linalg.solve(z.T @ (z * w[:, None]) + 1e-3 * 200 * np.eye(z.shape[1]), z.T @ (w * y))
    assert np.allclose(many.weights, want, atol=1e-6)
    assert (np.diff(many.knots_y) >= 0).all()


def test_isotonic_pools_violators():
    assert np.allclose(q.isotonic(np.array([0.0, 2, 0, 3]), np.array([1.0, 2, 2, 3])), [0, 0.5, 0.5, 1])


def test_degenerate_labels(spark):
    row = [0.0] * len(q.STATS)
    x = np.zeros((2, len(q.STATS)))
    none = q.fit_quality(spark.createDataFrame([], "stats array<double>, y int"))
    one = q.fit_quality(spark.createDataFrame([(row, 1), (row, 1), (row, None)], "stats array<double>, y int"))
    assert none.score(x).tolist() == [0.5, 0.5] and one.score(x).tolist() == [1.0, 1.0]
    assert q.statistics(None).tolist() == q.statistics("").tolist()
