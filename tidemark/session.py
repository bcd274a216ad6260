"""Spark session settings and the shared scratch location.

The library never creates machine-local scratch space on a cluster: work that
must cut lineage or stage a table goes under ``spark.checkpoint.dir``, which the
cluster names. Only when that setting is absent (local runs, tests) do we pick a
temporary folder ourselves and record it in the session.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators rely on: ANSI casts raise on bad input (strict
# parsing), UTC session time so DATE/TIMESTAMP_NTZ never shift, AQE for
# runtime broadcast conversion, partition coalescing and skew-join splitting.
# Partition overwrite mode is set per write, never for the whole session.
DEFAULT_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # rows may hold whole texts: smaller Arrow batches bound a task's memory
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
}


def build_session(master: str | None = None, app_name: str = "tidemark",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's settings.

    On a cluster pass ``master=None`` and let spark-submit decide; size
    ``shuffle_partitions`` to the data (AQE coalesces small ones away).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    conf["spark.ui.enabled"] = "false"
    # checkpoints taken by the partition-scoped merges are removed once unused
    conf["spark.cleaner.referenceTracking.cleanCheckpoints"] = "true"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Apply the runtime SQL settings to an existing session."""
    for k, v in DEFAULT_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on a shared session: leave as is
            pass


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Set only when unset and the master is local (tests); on a cluster a missing
    setting is an error, since executors would write to folders of their own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=eager)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared scratch folder and read it back: what
    follows never repeats the work, or a choice such as a row's position, that
    made it, also when an executor is lost."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
