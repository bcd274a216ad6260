"""Table scans, seeds and date-bounded reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.expr import days_before
from tidemark.schemas import SEED_EQUITY


def read_seed(spark: SparkSession, path: str, schema: T.StructType = SEED_EQUITY) -> DataFrame:
    """A CSV seed with a header row and a declared schema."""
    return (spark.read.option("header", True).option("mode", "FAILFAST")
            .schema(schema).csv(path))


def within_days(df: DataFrame, date_col: str, days: int, as_of=None) -> DataFrame:
    """Rows from ``as_of - days`` (inclusive) on; pushed to the scan."""
    return df.where(F.col(date_col) >= days_before(as_of, days))
