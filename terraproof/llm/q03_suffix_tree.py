"""Query of operator 3."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraproof.llm.common import id_crc32, table
from terraproof.llm.suffix_tree import score_texts

FOLDS, HELD_OUT = 7, 2


def op3_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score_texts(docs, "doc_id", "text", id_crc32("doc_id") % FOLDS != HELD_OUT)
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
