"""Query of operator 1."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terraproof.llm.common import table
from terraproof.llm.simhash import label_near_duplicates


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_near_duplicates(table(spark, sf_dir, "documents"), "doc_id", "text")
