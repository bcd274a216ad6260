"""K7: type-2 history with the "check" strategy.

History columns are the tracked columns plus ``scd_id``, ``updated_at``,
``valid_from`` and ``valid_to`` (NULL = current). Rules per key:

* new key -> open a row at ``as_of``;
* any check column differs, NULL-safe -> close the current row at ``as_of``
  and open a new one;
* unchanged -> keep the current row;
* key absent from the source -> the current row stays current;
* closed history is copied untouched.

One full outer join of the *current* rows with the source; each joined row
emits up to two output rows through ``explode`` (no second pass).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.expr import as_of_timestamp

SCD_COLUMNS = ["scd_id", "updated_at", "valid_from", "valid_to"]


def history_schema(source_schema: T.StructType) -> T.StructType:
    fields = list(source_schema.fields) + [
        T.StructField("scd_id", T.StringType()),
        T.StructField("updated_at", T.TimestampNTZType()),
        T.StructField("valid_from", T.TimestampNTZType()),
        T.StructField("valid_to", T.TimestampNTZType()),
    ]
    return T.StructType(fields)


def empty_history(spark: SparkSession, source: DataFrame) -> DataFrame:
    return spark.createDataFrame([], history_schema(source.schema))


def scd_id(key: str, ts) -> F.Column:
    return F.md5(F.concat_ws("|", F.col(key).cast("string"), ts.cast("string")))


def scd2_merge(history: DataFrame, source: DataFrame, key: str,
               check_cols: Sequence[str], as_of) -> DataFrame:
    """Apply one snapshot of ``source`` to ``history`` at time ``as_of``.

    A NULL key would open a new version on every snapshot, so it fails the
    job (checked inside the projection, no extra pass).
    """
    from tidemark.operators.quality import require_not_null
    source = require_not_null(source, [key], "scd2 source")
    cols = [c for c in source.columns]
    ts = as_of_timestamp(as_of)
    closed = history.where(F.col("valid_to").isNotNull()).select(*cols, *SCD_COLUMNS)
    current = history.where(F.col("valid_to").isNull()).select(*cols, *SCD_COLUMNS)

    c = current.select(*[F.col(x).alias(f"c_{x}") for x in current.columns])
    s = source.select(*[F.col(x).alias(f"s_{x}") for x in cols])
    j = c.join(s, F.col(f"c_{key}") == F.col(f"s_{key}"), "full_outer")

    has_c = F.col(f"c_{key}").isNotNull()
    has_s = F.col(f"s_{key}").isNotNull()
    same = reduce(lambda a, b: a & b,
                  [F.col(f"c_{x}").eqNullSafe(F.col(f"s_{x}")) for x in check_cols])
    changed = has_c & has_s & ~same

    old_row = F.struct(*[F.col(f"c_{x}").alias(x) for x in cols],
                       F.col("c_scd_id").alias("scd_id"),
                       F.col("c_updated_at").alias("updated_at"),
                       F.col("c_valid_from").alias("valid_from"),
                       F.when(changed, ts).otherwise(F.col("c_valid_to")).alias("valid_to"))
    new_row = F.struct(*[F.col(f"s_{x}").alias(x) for x in cols],
                       scd_id(f"s_{key}", ts).alias("scd_id"),
                       ts.alias("updated_at"), ts.alias("valid_from"),
                       F.lit(None).cast(T.TimestampNTZType()).alias("valid_to"))
    rows = F.array(F.when(has_c, old_row), F.when(has_s & (~has_c | changed), new_row))
    touched = (j.select(F.explode(rows).alias("r")).where(F.col("r").isNotNull())
                .select("r.*"))
    return closed.unionByName(touched)


def scd2_snapshot(source: DataFrame, base: str, key: str, check_cols: Sequence[str], as_of) -> DataFrame:
    """K7 on storage: apply one snapshot and return the full history.

    History is kept as two tables under ``base``: ``current`` (open rows,
    one version directory per run) and ``closed`` (rows that will never
    change again, partitioned by the time they were closed). A run reads
    and rewrites only the current rows and adds one ``closed`` partition;
    rerunning the same snapshot overwrites that partition, so a retry after
    a failure between the two writes leaves no duplicates.
    """
    from tidemark.operators.sinks import drop_old_versions, read_current, write_version
    from tidemark.session import cut_lineage

    spark = source.sparkSession
    schema = history_schema(source.schema)
    cur_path, closed_path = f"{base.rstrip('/')}/current", f"{base.rstrip('/')}/closed"
    current = read_current(spark, cur_path, schema)
    merged = cut_lineage(scd2_merge(current, source, key, check_cols, as_of))
    (merged.where(F.col("valid_to").isNotNull())
     .withColumn("closed_at", F.col("valid_to"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("closed_at").parquet(closed_path))
    write_version(merged.where(F.col("valid_to").isNull()), cur_path)
    drop_old_versions(spark, cur_path)
    return read_history(spark, base, schema)


def read_history(spark: SparkSession, base: str, schema: T.StructType) -> DataFrame:
    """Closed and current rows of a history kept by ``scd2_snapshot``."""
    from tidemark.operators.sinks import path_exists, read_current

    current = read_current(spark, f"{base.rstrip('/')}/current", schema)
    closed_path = f"{base.rstrip('/')}/closed"
    if not path_exists(spark, closed_path):
        return current
    closed = spark.read.schema(schema).parquet(closed_path).select(*schema.fieldNames())
    return closed.unionByName(current)
