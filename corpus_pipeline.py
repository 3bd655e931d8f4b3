"""Corpus pipeline: language identification, quality rules, near-duplicate removal, packing.

Every stage but the last returns the columns that it was given, whatever their names. Documents without a text or
without a letter have no language and go in the first stage. Null ids are kept; rows that repeat an id, or copies of a
text, are one document of a group in the third stage. A table without rows gives no rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraproof.llm.common import ensure_checkpoint_dir, id_crc32, table
from terraproof.llm.language import fit, keep_identified
from terraproof.llm.packing import pack_documents
from terraproof.llm.q04_bpe import tokenizer_file
from terraproof.llm.q09_language import FOLDS, HELD_OUT
from terraproof.llm.quality import keep_good
from terraproof.llm.simhash import keep_one


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; what it learns from is the input's own labelled documents."""
    crf = fit(docs, "doc_id", "text", "lang", F.coalesce(id_crc32("doc_id") % FOLDS != HELD_OUT, F.lit(True)))
    return keep_identified(docs, "text", crf)


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, "text")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group.

    Fingerprints of three-word shingles, as the operator's contract has them, that differ in at most 4 of 64 bits:
    of the measured pairs with a five-word similarity of 0.8 or more, five-word fingerprints link far fewer.
    """
    return keep_one(docs, "doc_id", "text", threshold=4, width=3)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A smaller cache than the packing query's, as the stages share their workers' memory."""
    return pack_documents(docs, "doc_id", "text", tokenizer_file("byte_bpe_50k.json"), cache=100_000)


STAGES = [
    ("language_id", identify_language),
    ("quality_rules", apply_quality_rules),
    ("near_dedup", drop_near_duplicates),
    ("packing", pack_sequences),
]
#: The language model and the tokenizer are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written to the shared checkpoint folder and read again."""
    docs = table(spark, sf_dir, "documents")
    home = f"{ensure_checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs.write.parquet(f"{home}/{name}")
            docs = spark.read.parquet(f"{home}/{name}")
    return docs
