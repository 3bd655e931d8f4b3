"""Query of operator 4."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terraproof.llm.bpe import encode_texts
from terraproof.llm.common import table


def tokenizer_file(name: str) -> str:
    """Where the installed vocabulary lies; the same on every machine that has the package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_texts(table(spark, sf_dir, "documents"), "doc_id", "text", tokenizer_file("word_bpe_49k.json"))
