"""Query of operator 5."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terraproof.llm.common import table
from terraproof.llm.html import extract_main_text


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"), "page_id", "url", "html")
