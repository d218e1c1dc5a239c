"""The corpus pipeline: stages over ``documents``, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from framewise.llm.common import read_documents, stored
from framewise.llm.mixing import in_mixed_order
from framewise.llm.near_duplicates import one_of_each_group
from framewise.llm.packing import pack_in_order
from framewise.llm.personal_data import fit_tagger, mask_personal_data
from framewise.llm.quality import quality_model, score_quality


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject, all columns as they were."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return score_quality(docs, quality_model(docs, labels), keep_from=0.5)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    return one_of_each_group(docs)


def mask(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; n_chars follows the text."""
    return mask_personal_data(docs, fit_tagger(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, written in an order that mixes sources by the square root of their sizes."""
    return in_mixed_order(docs, ["doc_id"])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their places in sequences, which follow the order of ``docs``."""
    return pack_in_order(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("personal data", mask),
    ("source mix", mix_sources),
    ("best-fit packing", pack),
]

#: The stages learn models and pack greedily; SQL does not express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written before the next reads it."""
    docs = read_documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, f"stage-{k}")
    return docs
