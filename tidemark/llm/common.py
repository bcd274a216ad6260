"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path

# The separators between words (space and \x09-\x0D).
WORD_GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole table of the data folder."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared scratch folder and read it back.

    Cuts the lineage: what follows survives lost executors and never repeats
    the work (or a nondeterministic choice) that made ``df``.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    """Number of words of a text; null counts as none. Built-in expressions."""
    gaps = F.split(F.coalesce(text, F.lit("")), WORD_GAP)
    return F.size(F.array_remove(gaps, "")).cast("long")


def spark_partitions(spark: SparkSession) -> int:
    """The session's shuffle partition count, which the user sizes to the data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_memory() -> None:
    """Give memory that this process has freed back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only glibc has it
    if trim is not None:
        trim(0)


def handing_back(run: Callable) -> Callable:
    """``run`` for mapInArrow, whose worker is small again when a task is over:
    Spark keeps workers for later tasks, beside those that are then at work."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        free_memory()

    return task
