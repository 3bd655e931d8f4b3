"""Evidence that arrives over time. An extension: micro-batches resolve only the keys they touch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from terraproof.operators.evidence import resolve_evidence


def resolve_stream(features: DataFrame, store: str, decisions: str, checkpoint: str) -> StreamingQuery:
    """Append arriving features to ``store`` and write the decisions of the keys they touch, with their batch.

    Batches are written under their number and replaced when one is run again, so a restart repeats nothing.
    """

    def batch(arrived: DataFrame, number: int) -> None:
        spark = arrived.sparkSession
        arrived.dropDuplicates(["authority_key", "ordinal"]).write.mode("overwrite").parquet(f"{store}/batch={number}")
        known = spark.read.option("basePath", store).parquet(f"{store}/batch=*").filter(F.col("batch") <= number).drop("batch")
        touched = known.join(arrived.select("authority_key").distinct(), "authority_key", "left_semi").dropDuplicates(["authority_key", "ordinal"])
        resolve_evidence(touched).write.mode("overwrite").parquet(f"{decisions}/batch={number}")

    return features.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(features: DataFrame, ts: str = "ts", late: str = "10 minutes", size: str = "1 hour") -> DataFrame:
    """Features by event-time window and source, closed after ``late``."""
    return features.withWatermark(ts, late).groupBy(F.window(ts, size), "source").agg(F.count(F.lit(1)).alias("n"))
