"""Query of operator 6."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terraproof.llm.common import table
from terraproof.llm.urls import UrlRule, judge

#: Fixed values of the contract.
RULES = (
    UrlRule("block", "com", "/en/"),
    UrlRule("allow", "example.com", "/en/7"),
    UrlRule("allow", "net", "/de/"),
    UrlRule("block", "example.net", "/de/8"),
    UrlRule("block", "org", "/es/"),
)


def op6_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), "page_id", "url", RULES)
