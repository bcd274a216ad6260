"""Continuous keyed upsert of landed price files (re-aim of K1/K3).

``readStream`` over a landing directory -> ``foreachBatch`` that merges each
micro-batch into the target with the same set-based ``upsert`` as batch loads.

One commit a batch: each batch writes a new table version, and the version
carries the stream's name and the batch's number, put there before the marker
that makes it visible. A batch that is delivered again (the job died after the
version was written and before the stream's checkpoint knew) finds its number
and is skipped, so its merge never runs twice, whatever it holds by then. A
failed batch leaves the previous version current. Two versions stay.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.sinks import (
    current_note,
    drop_old_versions,
    merge_partitions,
    read_current,
    read_text,
    upsert,
    write_text,
    write_version,
)

BATCHES = "_BATCHES"  # the last batch that each stream has committed, by stream name


def committed_batches(spark: SparkSession, target_path: str, partitioned: bool = False) -> dict[str, int]:
    """The number of the last batch that each stream has merged into the table."""
    text = (read_text(spark, f"{target_path.rstrip('/')}/{BATCHES}") if partitioned
            else current_note(spark, target_path, BATCHES))
    return json.loads(text) if text else {}


def merge_batch(target_path: str, schema: T.StructType, keys: Sequence[str],
                order: Sequence[str | Column] | None = None,
                stamp: tuple[str, object] | None = None,
                transform: Callable[[DataFrame], DataFrame] | None = None,
                partition_col: str | None = None, stream: str = ""):
    """A ``foreachBatch`` function: merge one micro-batch into the target.

    ``stream`` names the stream (its checkpoint folder will do): batches that
    it has committed already are skipped. With ``partition_col`` only the
    partitions the batch touches are read and rewritten (``merge_partitions``);
    the batch's number is then written after them, and a merge that ran without
    it is run again, by key. Otherwise the merged table is written as a new
    version.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        done = committed_batches(spark, target_path, bool(partition_col))
        if batch_id <= done.get(stream, -1):
            return
        src = transform(batch) if transform else batch
        note = json.dumps({**done, stream: batch_id}, sort_keys=True)
        if partition_col:
            merge_partitions(src, target_path, keys, partition_col, schema, order, stamp)
            write_text(spark, f"{target_path.rstrip('/')}/{BATCHES}", note)
            return
        target = read_current(spark, target_path, schema)
        merged = upsert(target, src, keys, order=order, stamp=stamp)
        write_version(merged.select(*[f.name for f in schema.fields]), target_path, notes=lambda: {BATCHES: note})
        drop_old_versions(spark, target_path)

    return run


def stream_upsert(spark: SparkSession, landing: str, source_schema: T.StructType,
                  target_path: str, target_schema: T.StructType, keys: Sequence[str],
                  checkpoint: str, fmt: str = "parquet",
                  order: Sequence[str | Column] | None = None,
                  stamp: tuple[str, object] | None = None,
                  transform: Callable[[DataFrame], DataFrame] | None = None,
                  available_now: bool = True, options: dict | None = None,
                  partition_col: str | None = None) -> StreamingQuery:
    """Start the streaming upsert. ``checkpoint`` is a shared folder of this
    stream's own; a restart with the same one resumes. ``available_now=True`` processes what has
    landed and stops (scheduled runs); False keeps running every trigger."""
    reader = spark.readStream.format(fmt).schema(source_schema)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    stream = reader.load(landing)
    writer = (stream.writeStream.foreachBatch(
        merge_batch(target_path, target_schema, keys, order, stamp, transform, partition_col, checkpoint))
        .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
