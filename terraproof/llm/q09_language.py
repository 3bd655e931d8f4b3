"""Query of operator 9."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraproof.llm.common import id_crc32, table
from terraproof.llm.language import fit, identify

FOLDS, HELD_OUT = 3, 1


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(id_crc32("doc_id") % FOLDS == HELD_OUT, F.lit(False))
    crf = fit(docs, "doc_id", "text", "lang", ~held_out)
    return identify(docs.select("doc_id", held_out.alias("held_out"), "text"), "text", crf, ("lang_pred", "score"))
