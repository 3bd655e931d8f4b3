"""State of operators that go in rounds: written to the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's checkpoint folder; below a temporary one only where none is set and the master is local."""
    home = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not home:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        home = tempfile.mkdtemp(prefix="terraproof-state-")
    return f"{home}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str) -> DataFrame:
    """``df`` as a table at ``path``: computed once, whatever is done with it, and without lineage."""
    schema = df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def salted_join(many: DataFrame, few: DataFrame, key: str, spread: str, salts: int = 16) -> DataFrame:
    """Inner join on ``key`` where a key may be hot in ``many``: its rows are dealt out by the column ``spread``, and the rows
    of ``few`` are repeated ``salts`` times."""
    a = many.withColumn("_salt", F.pmod(F.xxhash64(F.col(spread)), F.lit(salts)).cast("int"))
    b = few.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return a.join(b, [key, "_salt"]).drop("_salt")
