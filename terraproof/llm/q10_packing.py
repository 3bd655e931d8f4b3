"""Query of operator 10."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terraproof.llm.common import table
from terraproof.llm.packing import pack_documents
from terraproof.llm.q04_bpe import tokenizer_file


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), "doc_id", "text", tokenizer_file("byte_bpe_50k.json"))
