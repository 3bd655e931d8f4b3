"""What several operators of this subpackage share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The five white-space characters and the blank that separate words, as a Java regex class.
WORD_BREAK = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, through Spark's own reader so that any store works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a temporary one only where none is set (tests)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        current = tempfile.mkdtemp(prefix="terraproof-checkpoint-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def forget_files(spark: SparkSession, folder: str) -> None:
    """Removes what an operator wrote meanwhile, through the file system that holds it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)  # noqa: SLF001
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)  # noqa: SLF001


def id_crc32(id_column: str) -> Column:
    """CRC-32 of an id's decimal text."""
    return F.crc32(F.col(id_column).cast("string").cast("binary"))


def slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 4 << 20, most_rows: int = 2000) -> Iterator[pa.RecordBatch]:
    """Arrow batches in runs of rows that hold about ``most_bytes`` of a text column, one row at least.

    Spark fills a batch with thousands of whole texts; in this way a worker has Python objects for a few of them only.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends, low = np.cumsum(sizes, dtype=np.int64), 0
        while low < len(batch):
            done = ends[low - 1] if low else 0
            high = min(low + most_rows, max(low + 1, int(np.searchsorted(ends, done + most_bytes, side="right"))))
            yield batch.slice(low, high - low)
            low = high


def release_memory() -> None:
    """Gives a worker's free memory back to the system at the end of a task, as workers live on idle."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def forget_shuffles(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of ended jobs, which it does when the driver collects its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()  # noqa: SLF001
