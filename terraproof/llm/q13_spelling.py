"""Query of operator 13."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terraproof.llm.common import table
from terraproof.llm.spelling import group_variants


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_variants(table(spark, sf_dir, "documents"), "doc_id", "text")
