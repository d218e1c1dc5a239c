"""The queries of this subpackage: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import ship_package
from .common import read_documents
from .fingerprints import op9_spotsigs
from .language_id import op10_language_id
from .lm_scoring import op12_lm_scoring
from .mixing import op6_mix
from .near_duplicates import op5_jaccard
from .oracles import OP4, OP5, OP11, OP13
from .packing import pack_documents
from .personal_data import op3_personal_data
from .quality import op8_quality
from .quality_rules import op4_rules
from .ranked_search import op13_ranked_search
from .sharding import op1_hilbert
from .token_counts import op7_token_counts
from .vector_codes import op11_vector_codes


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _over_documents(operator) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: operator(read_documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_hilbert_shards": _over_documents(op1_hilbert),
    "op2_packing": _over_documents(pack_documents),
    "op3_personal_data": _over_documents(op3_personal_data),
    "op4_quality_rules": _over_documents(op4_rules),
    "op5_jaccard_join": _over_documents(op5_jaccard),
    "op6_source_mix": _over_documents(op6_mix),
    "op7_token_counts": _over_documents(op7_token_counts),
    "op8_quality": lambda spark, sf_dir: op8_quality(read_documents(spark, sf_dir), _table(spark, sf_dir, "labels")),
    "op9_spotsigs": _over_documents(op9_spotsigs),
    "op10_language_id": _over_documents(op10_language_id),
    "op11_vector_codes": lambda spark, sf_dir: op11_vector_codes(_table(spark, sf_dir, "embeddings")),
    "op12_lm_scoring": _over_documents(op12_lm_scoring),
    "op13_ranked_search": lambda spark, sf_dir: op13_ranked_search(read_documents(spark, sf_dir), _table(spark, sf_dir, "benchmark")),
}

ORACLES: dict[str, str] = {"op4_quality_rules": OP4, "op5_jaccard_join": OP5, "op11_vector_codes": OP11, "op13_ranked_search": OP13}
