"""Every operator and stage over the awkward tables."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from framewise.llm import fingerprints, language_id, mixing, near_duplicates, packing, personal_data, quality, quality_rules, sharding, token_counts

from .cases import edge_docs, edge_rows, empty_docs, with_clashes


def labels(spark):
    return spark.createDataFrame([(i, i % 2, 0) for i in range(70)] + [(None, 1, 0), (5, 0, 0), (6, None, None)], "doc_id long, quality int, toxic int")


OPERATORS = {
    "1": lambda s, d: sharding.op1_hilbert(d),
    "2": lambda s, d: packing.pack_documents(d),
    "3": lambda s, d: personal_data.op3_personal_data(d),
    "4": lambda s, d: quality_rules.op4_rules(d),
    "5": lambda s, d: near_duplicates.op5_jaccard(d),
    "6": lambda s, d: mixing.op6_mix(d),
    "7": lambda s, d: token_counts.op7_token_counts(d),
    "8": lambda s, d: quality.op8_quality(d, labels(s)),
    "9": lambda s, d: fingerprints.op9_spotsigs(d),
    "10": lambda s, d: language_id.op10_language_id(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_awkward_rows(spark, name):
    plain = OPERATORS[name](spark, edge_docs(spark))
    rows = plain.collect()
    assert {r["doc_id"] for r in rows} == {r[0] for r in edge_rows()}
    if name != "2":
        assert len(rows) == len(edge_rows())


@pytest.mark.parametrize("name", OPERATORS)
def test_extra_columns_change_nothing(spark, name):
    a = OPERATORS[name](spark, edge_docs(spark))
    b = OPERATORS[name](spark, with_clashes(edge_docs(spark)))
    assert a.schema == b.schema and a.count() == b.count()


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](spark, empty_docs(spark)).count() == 0


@pytest.mark.parametrize("stage", range(len(corpus_pipeline.STAGES)))
@pytest.mark.parametrize("make", [edge_docs, empty_docs, lambda s: with_clashes(edge_docs(s))], ids=["edge", "empty", "clash"])
def test_stages(spark, tmp_path, stage, make):
    labels(spark).write.parquet(str(tmp_path / "labels.parquet"))
    docs = make(spark)
    out = corpus_pipeline.STAGES[stage][1](spark, docs, str(tmp_path))
    n = out.count()
    if stage + 1 < len(corpus_pipeline.STAGES):
        assert out.columns == docs.columns
        assert n <= docs.count()
    if stage in (2, 3):
        assert n == docs.count()


def test_stage_keeps_one_of_repeated_rows(spark):
    kept = near_duplicates.one_of_each_group(edge_docs(spark)).groupBy("doc_id").count()
    n = {r["doc_id"]: r["count"] for r in kept.collect()}
    assert n[5] == 1 and 6 not in n and 7 not in n
    assert n[0] == n[1] == n[2] == 1 and n[None] == 2


def test_general_forms_replace_columns_they_add(spark):
    docs = edge_docs(spark).withColumn("score", F.lit("x")).withColumn("kept", F.lit("x")).withColumn("n_tokens", F.lit("x"))
    model = language_id.train(["the thing", "la chose", "das ding"] * 5, ["en", "fr", "de"] * 5)
    assert dict(language_id.identify(docs, model).dtypes)["score"] == "double"
    assert dict(quality_rules.apply_rules(docs).dtypes)["kept"] == "boolean"
    assert dict(token_counts.token_counts(docs).dtypes)["n_tokens"] == "bigint"
