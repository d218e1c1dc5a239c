"""The entry file's part of this subpackage."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from framewise.llm import mixing, packing
from framewise.llm.common import read_documents, stored
from framewise.llm.queries import ORACLES, QUERIES
from framewise.session import TABLES

SF = "/root/testdata/sf0.001"


def test_every_numbered_query_is_registered():
    names = entry.queries()
    for n in range(1, 14):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1
    assert "pipeline" in names and set(QUERIES) <= set(names)
    assert [k for k, _ in corpus_pipeline.STAGES] == ["quality classifier", "n-gram Jaccard join", "personal data", "source mix", "best-fit packing"]


def test_pipeline_equals_its_stages(spark):
    """run() packs every document that the stages keep, whole."""
    out = corpus_pipeline.run(spark, SF).toPandas()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = corpus_pipeline.keep_good(spark, docs, SF)
    kept = corpus_pipeline.drop_near_duplicates(spark, good, SF)
    assert set(out.doc_id) == {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert 0 < len(set(out.doc_id)) < docs.count()
    assert out.groupby("sequence_id").length.sum().max() <= 2048


def test_sequences_follow_the_mix(spark, monkeypatch):
    """Rising sequence ids run through the sources by their target weights."""
    monkeypatch.setattr(packing, "STRETCH", 100)
    docs = read_documents(spark, "/root/testdata/sf0.01")
    mixed = stored(corpus_pipeline.mix_sources(spark, docs, SF), "mixed")
    out = corpus_pipeline.pack(spark, mixed, SF).toPandas()
    place = {r["doc_id"]: (r["position"], r["source"]) for r in mixing.mix(docs, ["doc_id"]).select("doc_id", "position", "source").collect()}
    assert set(out.doc_id) == set(place)
    out["position"], out["source"] = zip(*out.doc_id.map(place), strict=True)
    # a stretch is a run of the mixed order, and stretches rise with the ids
    ranges = out.groupby(out.sequence_id.to_numpy() >> 24).position.agg(["min", "max"]).sort_index()
    assert len(ranges) == -(-len(place) // 100)
    assert (ranges["max"].to_numpy()[:-1] < ranges["min"].to_numpy()[1:]).all()
    # source shares of the first documents by sequence id: within a block after every stretch
    sizes = pd.Series([s for _, s in place.values()]).value_counts()
    target = sizes ** 0.5 / (sizes ** 0.5).sum()
    first = out[out.piece == 0].sort_values(["sequence_id", "offset"])
    for n in range(100, int((sizes / target).min() * 0.9), 100):
        seen = first.source[:n].value_counts().reindex(sizes.index, fill_value=0)
        # a document of several pieces can begin anywhere in its stretch, not elsewhere
        assert (seen - n * target).abs().max() < 8 * 2
    # inside a stretch too, the ids rise with the places
    assert first.groupby(first.sequence_id.to_numpy() >> 24)[["sequence_id", "position"]].corr(method="spearman").iloc[0::2, 1].mean() > 0.5


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got, want = QUERIES[name](spark, SF).toPandas(), con.execute(ORACLES[name]).df()
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    assert sorted(map(tuple, got[cols].to_numpy().tolist())) == sorted(map(tuple, want[cols].to_numpy().tolist()))
