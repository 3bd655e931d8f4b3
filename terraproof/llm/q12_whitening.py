"""Query of operator 12."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraproof.llm.common import table
from terraproof.llm.whitening import whiten


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deviation as a long, which raises an error where none holds it."""
    found = whiten(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return found.withColumn("deviation", F.col("deviation").cast("long"))
