"""Content-addressed recompute: keys, what is missing, and a Parquet store of results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def missing(work: DataFrame, stored: DataFrame, key: str = "content_key") -> DataFrame:
    """The rows of ``work`` without a stored result."""
    return work.join(stored.select(key).distinct(), key, "left_anti")


def still_valid(fingerprints: DataFrame, files: DataFrame) -> DataFrame:
    """Stored fingerprints (file, size, modified) that no file bears out any more; none means that all still hold."""
    return fingerprints.join(files.select("file", "size", "modified"), ["file", "size", "modified"], "left_anti")


#: Fixed value: the version of ingest that evidence keys are made for.
INGEST_VERSION = 2


def evidence_key(entries: DataFrame, ingest_version: int = INGEST_VERSION) -> DataFrame:
    """One digest of a set of documents (schemaVersion, status, url, file, bytes, sha256, mime), whatever their order.

    Letter case of digests and media types does not count, the number of copies does. Entries' digests are sorted and
    digested by their first four digits, then these digests are; so no task gets the list of all entries.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    h = F.sha2(F.concat_ws("|", text("schemaVersion"), text("status"), text("url"), text("file"), text("bytes"), F.lower(text("sha256")), F.lower(text("mime"))), 256)
    held = entries.select(h.alias("h")).groupBy(F.substring("h", 1, 4).alias("at")).agg(F.count(F.lit(1)).alias("n"), F.sha2(F.array_join(F.array_sort(F.collect_list("h")), ","), 256).alias("d"))
    total = held.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("entries"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "d"))), lambda x: x["d"]), ",").alias("all"))
    return total.select("entries", F.concat(F.lit("planning-prefetch-"), F.sha2(F.concat_ws("|", F.lit(str(ingest_version)), "all"), 256)).alias("evidence_key"))


class ResultStore:
    """Results by content key in a Parquet folder that all executors share; appends are committed whole."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path, schema

    def read(self) -> DataFrame:
        try:
            return self.spark.read.schema(self.schema).parquet(self.path)
        except Exception as e:  # the folder comes with the first result
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], self.schema)

    def get_or_create(self, work: DataFrame, compute: Callable[[DataFrame], DataFrame], key: str = "content_key") -> DataFrame:
        """One result for each key of ``work``; only those missing are computed.

        Two jobs that compute the same key at once both append it; one of the equal results is read.
        """
        compute(missing(work, self.read(), key).dropDuplicates([key])).write.mode("append").parquet(self.path)
        return self.read().join(work.select(key).distinct(), key, "left_semi").dropDuplicates([key])
