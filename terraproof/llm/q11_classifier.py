"""Query of operator 11."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraproof.llm.classifier import fit, score
from terraproof.llm.common import id_crc32, table

FOLDS, HELD_OUT = 3, 1


def op11_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(id_crc32("doc_id") % FOLDS == HELD_OUT, F.lit(False))
    network = fit(docs, table(spark, sf_dir, "labels"), "doc_id", "text", "quality", ~held_out)
    scored = score(docs.select("doc_id", held_out.alias("held_out"), "text"), "text", network)
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
