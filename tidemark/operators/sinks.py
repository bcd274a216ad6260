"""Write semantics.

Every merge is set-based: one shuffle on the key, never a statement per row.
The state-producing operators (``upsert``, ``incremental_merge``,
``scd2_merge``) are pure ``DataFrame -> DataFrame`` functions; writing is a
separate step that always targets a new directory (a version) or rewrites
only the touched partitions, never the path being read.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.expr import as_of_timestamp, col_of
from tidemark.session import cut_lineage

# --------------------------------------------------------------------------- K1


def _has_null_key(keys: Sequence[str]) -> Column:
    cond = F.lit(False)
    for k in keys:
        cond = cond | F.col(k).isNull()
    return cond


def dedupe_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Keep the last row per key under ``order`` (later wins).

    Written as ``max_by(struct, order)`` per key: a partial + final hash
    aggregate, so duplicates are combined map-side and a heavily repeated key
    never lands in one task as a whole. Rows with a NULL key part are never
    duplicates of each other (they match nothing) and pass through.
    """
    others = [c for c in df.columns if c not in keys]
    okey = F.struct(*[col_of(o) for o in order])
    row = F.struct(*[F.col(c) for c in others])
    # rows with a NULL key part get a number each, which also spreads them
    own = F.when(_has_null_key(keys), F.monotonically_increasing_id())
    picked = df.withColumn("__own", own).groupBy(*keys, "__own").agg(F.max_by(row, okey).alias("__row"))
    return picked.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in others]).select(*df.columns)


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           order: Sequence[str | Column] | None = None,
           stamp: tuple[str, object] | None = None,
           update_cols: Sequence[str] | None = None) -> DataFrame:
    """MERGE by key, as one set-based plan.

    matched -> the source row replaces the target row (or, with
    ``update_cols``, only those columns change); not matched -> inserted;
    target rows without a source row stay as they are. ``order`` resolves
    duplicate source keys (last wins); without it the source must be unique.
    ``stamp=("loaded_at", as_of)`` sets the load time on every inserted or
    updated row. Columns missing on either side are NULL-padded (additive
    schema evolution). Result columns: target's, then new source columns.
    NULL keys never match (SQL MERGE semantics): such source rows are
    inserted and such target rows kept (an anti join on equality keeps them).
    """
    src = dedupe_by_key(source, keys, order) if order else source
    if stamp is not None:
        name, as_of = stamp
        src = src.withColumn(name, as_of_timestamp(as_of))
    cols = list(target.columns) + [c for c in src.columns if c not in target.columns]
    if update_cols is None:
        kept = target.join(src.select(*keys), list(keys), "left_anti")
        return kept.unionByName(src, allowMissingColumns=True).select(*cols)
    # Partial update: matched rows keep the target's other columns.
    upd = set(update_cols) | ({stamp[0]} if stamp else set())
    t = target.alias("t")
    s = src.alias("s").withColumn("__src", F.lit(True))
    j = t.join(s, [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) & F.col(f"t.{k}").isNotNull()
                   for k in keys], "full_outer")
    sel = []
    for c in cols:
        in_t, in_s = c in target.columns, c in src.columns
        if c in keys:
            sel.append(F.coalesce(F.col(f"t.{c}"), F.col(f"s.{c}")).alias(c))
        elif in_t and in_s and c in upd:
            sel.append(F.when(F.col("__src").isNotNull(), F.col(f"s.{c}"))
                       .otherwise(F.col(f"t.{c}")).alias(c))
        elif in_t and in_s:
            sel.append(F.when(F.col(f"t.{keys[0]}").isNull(), F.col(f"s.{c}"))
                       .otherwise(F.col(f"t.{c}")).alias(c))
        elif in_t:
            sel.append(F.col(f"t.{c}").alias(c))
        else:
            sel.append(F.col(f"s.{c}").alias(c))
    return j.select(*sel)


# --------------------------------------------------------------------------- K10 K11


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty frame with the declared schema (create-if-missing)."""
    return spark.createDataFrame([], schema)


def add_missing_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """ADD COLUMN IF NOT EXISTS — append declared columns as typed NULLs."""
    out = df
    for f in schema.fields:
        if f.name not in out.columns:
            out = out.withColumn(f.name, F.lit(None).cast(f.dataType))
    return out


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


# --------------------------------------------------------------------------- K2 K4 K5 K8


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] | None = None,
                mode: str = "overwrite", replace_all: bool = False, deal: bool = True) -> str:
    """K4: materialize as parquet. With ``partition_by`` and dynamic partition
    overwrite only the partitions present in ``df`` are replaced;
    ``replace_all`` replaces the whole table (static overwrite). Rows are dealt
    by partition before the write (``deal``), and AQE splits large ones again,
    so a partition gets few files and a hot one is written by many tasks."""
    if partition_by and deal:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
        w = w.option("partitionOverwriteMode", "static" if replace_all else "dynamic")
    w.parquet(path)
    return path


def _versions(spark: SparkSession, base: str, complete: bool = True) -> list[int]:
    """Version numbers under ``base``; with ``complete`` only those whose
    write finished (``_SUCCESS`` present)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(base)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name.startswith("v=") and (
                not complete or fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS"))):
            out.append(int(name[2:]))
    return sorted(out)


def write_version(df: DataFrame, base: str, partition_by: Sequence[str] | None = None,
                  notes: Callable[[], Mapping[str, str]] | None = None, deal: bool = True) -> str:
    """Atomic full reload. Writes a new version directory; readers
    switch only once its ``_SUCCESS`` marker exists, so there is no moment
    where the table is empty (the reference truncates, then inserts). A
    version left incomplete by a failed job is skipped, never reused.

    ``notes`` is called after the data is written and gives small texts by file
    name; they are put beside the data before the marker, so a complete version
    has its notes."""
    spark = df.sparkSession
    versions = _versions(spark, base, complete=False)
    path = f"{base.rstrip('/')}/v={(versions[-1] + 1) if versions else 1:08d}"
    if notes is None:
        return write_table(df, path, partition_by, mode="errorifexists", deal=deal)
    df.write.mode("errorifexists").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
    for name, text in {**notes(), "_SUCCESS": ""}.items():
        write_text(spark, f"{path}/{name}", text)
    return path


def merge_partitions(source: DataFrame, path: str, keys: Sequence[str], partition_col: str,
                     schema: T.StructType, order: Sequence[str | Column] | None = None,
                     stamp: tuple[str, object] | None = None, stored: bool = False) -> DataFrame:
    """K1 at scale: merge ``source`` into a table partitioned by
    ``partition_col``, rewriting only the partitions the source touches.

    The source is checkpointed into the shared checkpoint folder (unless it is
    ``stored`` already) and read from there for both its partition values and the merge. The values (at most as
    many as the table has partition directories, which the driver lists anyway)
    prune the target read as literals; a NULL partition value, which the writer
    keeps in a directory of its own, counts as one of them. The merged
    partitions are checkpointed too, so the write never reads the path it
    overwrites, and a failed write can be retried. The partition column must be
    part of the key (a row never moves between partitions).
    """
    if partition_col not in keys:
        raise ValueError("the partition column must be one of the keys")
    spark = source.sparkSession
    source = source if stored else cut_lineage(source)
    if path_exists(spark, path):
        target = spark.read.schema(schema).parquet(path)
        touched = [r[0] for r in source.select(partition_col).distinct().collect()]
        hit = F.col(partition_col).isin([v for v in touched if v is not None])
        target = target.where(hit | F.col(partition_col).isNull() if None in touched else hit)
    else:
        target = empty_table(spark, schema)
    merged = upsert(target, source, keys, order=order, stamp=stamp).select(*schema.fieldNames())
    merged = cut_lineage(merged.hint("rebalance", F.col(partition_col)))
    (merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).parquet(path))
    return merged


def replace_partitions_from(df: DataFrame, path: str, partition_col: str, since) -> None:
    """Replace every ``partition_col`` partition ``>= since`` with ``df``'s rows.

    ``df`` must hold exactly the rows of those partitions, and those with a NULL
    partition value if that partition is to be replaced too; it is checkpointed
    first, so it may read ``path``. Partitions present in ``df`` are overwritten
    (dynamic overwrite); partitions at or after ``since`` that ``df`` no longer
    has are removed, so the table equals a full rebuild. Partitions before
    ``since``, and the NULL partition if ``df`` has none, stay.
    """
    spark = df.sparkSession
    df = cut_lineage(df)
    keep = {str(r[0]) for r in df.select(partition_col).distinct().collect()}
    write_table(df, path, [partition_col])
    gone = (spark.read.parquet(path).select(partition_col).where(F.col(partition_col) >= F.lit(since))
            .distinct().withColumn("name", F.col(partition_col).cast("string")).collect())
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(path)
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    gone = {r["name"] for r in gone} - keep
    for st in fs.listStatus(base):
        if st.getPath().getName() in {f"{partition_col}={v}" for v in gone}:
            fs.delete(st.getPath(), True)


def drop_old_versions(spark: SparkSession, base: str, keep: int = 2) -> None:
    """Remove all but the newest ``keep`` complete versions of a table, and
    incomplete ones older than those. Readers of the current version are safe;
    keep more for readers that hold on to a version longer than a run."""
    complete = _versions(spark, base)
    if len(complete) <= keep:
        return
    jvm = spark.sparkContext._jvm
    fs = jvm.org.apache.hadoop.fs.Path(base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for v in _versions(spark, base, complete=False):
        if v < complete[-keep]:
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/v={v:08d}"), True)


def read_current(spark: SparkSession, base: str, schema: T.StructType | None = None) -> DataFrame:
    """Read the newest complete version written by ``write_version``."""
    versions = _versions(spark, base)
    if not versions:
        if schema is None:
            raise FileNotFoundError(base)
        return empty_table(spark, schema)
    df = spark.read.parquet(f"{base.rstrip('/')}/v={versions[-1]:08d}")
    return add_missing_columns(df, schema) if schema is not None else df


# --------------------------------------------------------------------------- notes and marks


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file (a note, a mark, a commit marker) in the table's store."""
    p, fs = _hadoop(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """What ``write_text`` wrote; None if there is no such file."""
    p, fs = _hadoop(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def remove_file(spark: SparkSession, path: str) -> None:
    p, fs = _hadoop(spark, path)
    fs.delete(p, False)


MARK = "_MARK"  # readers skip files that begin with an underscore


def write_mark(spark: SparkSession, path: str, mark: date | None) -> None:
    """Keep a high-water mark beside the table at ``path``."""
    write_text(spark, f"{path.rstrip('/')}/{MARK}", _mark_text(mark))


def _mark_text(mark: date | None) -> str:
    return "" if mark is None else mark.isoformat()


def read_mark(spark: SparkSession, path: str) -> date | None:
    """The mark that was kept beside the table at ``path``, if any."""
    text = read_text(spark, f"{path.rstrip('/')}/{MARK}")
    return date.fromisoformat(text) if text else None


def write_marked_version(df: DataFrame, base: str, date_col: str) -> date | None:
    """``write_version`` whose version keeps ``max(date_col)`` beside its
    files; the maximum is observed by the write itself, so the table is not read
    again. Returns the mark."""
    seen = Observation()

    def notes():
        return {MARK: _mark_text(seen.get.get("mark"))}
    write_version(df.observe(seen, F.max(date_col).alias("mark")), base, notes=notes)
    return seen.get.get("mark")


def current_note(spark: SparkSession, base: str, name: str) -> str | None:
    """A note of the newest complete version; None if there is none."""
    versions = _versions(spark, base)
    return read_text(spark, f"{base.rstrip('/')}/v={versions[-1]:08d}/{name}") if versions else None


def current_mark(spark: SparkSession, base: str) -> date | None:
    """The mark of the newest complete version; None if the table is new."""
    text = current_note(spark, base, MARK)
    return date.fromisoformat(text) if text else None


def register_view(df: DataFrame, name: str) -> DataFrame:
    """K5: a staging model as a temporary view."""
    df.createOrReplaceTempView(name)
    return df


def schema_for(layer: str | None, default: str, overrides: Mapping[str, str] | None = None) -> str:
    """K8: the custom schema name, trimmed, when set; else the target default."""
    custom = (overrides or {}).get(layer, layer) if layer else None
    return default if custom is None else str(custom).strip()


def layer_path(root: str, layer: str | None, table: str, default: str = "public") -> str:
    return f"{root.rstrip('/')}/{schema_for(layer, default)}/{table}"


def with_load_stamp(df: DataFrame, name: str = "loaded_at", as_of=None) -> DataFrame:
    """The load time column (``as_of`` argument; wall clock if None)."""
    return df.withColumn(name, as_of_timestamp(as_of))


# --------------------------------------------------------------------------- K3


def high_water_mark(target: DataFrame, date_col: str):
    """``max(date_col)`` of the target, as a value (runs a job).

    For jobs, which prune stored partitions with it. Plans that are built
    without running anything use ``mark_of``.
    """
    return target.agg(F.max(date_col).alias("m")).first()["m"]


def mark_of(target: DataFrame, date_col: str, lookback_days: int = 0) -> Column:
    """The same mark as a scalar subquery, moved back by ``lookback_days``."""
    mark = target.agg(F.max(date_col)).scalar()
    return F.date_sub(mark, lookback_days) if lookback_days else mark


def incremental_candidates(target: DataFrame, source: DataFrame, date_col: str, lookback_days: int = 0,
                           mark_by: Sequence[str] | None = None) -> DataFrame:
    """The rows of ``source`` at or after the target's high-water mark.

    G3: an empty target (NULL mark) loads everything. ``lookback_days`` (G2)
    moves the mark back. With ``mark_by`` every key has its own mark (a small
    key -> mark table).
    """
    if mark_by:
        marks = target.groupBy(*mark_by).agg(F.max(date_col).alias("__mark"))
        j = source.join(marks, list(mark_by), "left")
        bound = F.date_sub(F.col("__mark"), lookback_days) if lookback_days else F.col("__mark")
        return j.where(F.col("__mark").isNull() | (F.col(date_col) >= bound)).drop("__mark")
    mark = mark_of(target, date_col, lookback_days)
    return source.where(mark.isNull() | (F.col(date_col) >= mark))


def incremental_merge(target: DataFrame, source: DataFrame,
                      keys: Sequence[str], date_col: str, lookback_days: int = 0,
                      mark_by: Sequence[str] | None = None,
                      order: Sequence[str | Column] | None = None) -> DataFrame:
    """K3: ``materialized='incremental', strategy='merge'`` — merge the rows at
    or after the high-water mark into the target on ``keys``."""
    cand = incremental_candidates(target, source, date_col, lookback_days, mark_by)
    return upsert(target, cand, keys, order=order)


def stored_incremental_merge(source: DataFrame, base: str, schema: T.StructType, keys: Sequence[str],
                             date_col: str, lookback_days: int = 0,
                             order: Sequence[str | Column] | None = None) -> DataFrame:
    """K3 into the versioned table at ``base``: the mark is read as a value from
    beside the newest version, so the source is pruned by a literal and the
    target is read once, by the merge alone. The merged table is written as the
    next version with its own mark; two versions stay."""
    spark = source.sparkSession
    mark = move_back(current_mark(spark, base), lookback_days)
    fresh = source if mark is None else source.where(F.col(date_col) >= F.lit(mark))
    merged = upsert(read_current(spark, base, schema), fresh, keys, order=order)
    write_marked_version(merged.select(*schema.fieldNames()), base, date_col)
    drop_old_versions(spark, base)
    return read_current(spark, base, schema)


def move_back(mark, days: int):
    return mark - timedelta(days=days) if mark is not None and days else mark


def incremental_window_merge(target: DataFrame, source: DataFrame, keys: Sequence[str],
                             date_col: str, by: Sequence[str], context_rows: int,
                             compute: Callable[[DataFrame], DataFrame],
                             lookback_days: int = 0) -> DataFrame:
    """K3 + G1: incremental merge of a windowed model that stays equal to a
    full rebuild.

    The reference filters the input to ``date >= mark`` before its row
    windows, so a re-run computes volatility from the newest rows only. Here
    the last ``context_rows`` source rows per ``by`` key before the mark are
    read as context (a per-key top-k, limited map-side), ``compute`` runs on
    context + new rows, and only rows at or after the mark are merged.
    """
    mark = mark_of(target, date_col, lookback_days)
    return upsert(target, incremental_window_rows(source, mark, date_col, by, context_rows, compute),
                  keys)


def incremental_window_rows(source: DataFrame, mark, date_col: str, by: Sequence[str],
                            context_rows: int, compute: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows a windowed incremental model (G1) must (re)write: ``compute``
    over the source rows at or after ``mark`` plus the last ``context_rows``
    rows per key before it, keeping only rows at or after ``mark``. ``mark`` is
    a value or a column (``mark_of``); NULL (empty target) computes everything."""
    if mark is None:
        return compute(source)
    m = mark if isinstance(mark, Column) else F.lit(mark)
    fresh = m.isNull() | (F.col(date_col) >= m)
    from tidemark.operators.relational import topk_per_key
    ctx = topk_per_key(source.where(F.col(date_col) < m), by, [F.col(date_col).desc()], context_rows)
    return compute(source.where(fresh).unionByName(ctx)).where(fresh)


# --------------------------------------------------------------------------- K3 with stored windows


def stored_window_increment(source: DataFrame, path: str, state: str, schema: T.StructType, keys: Sequence[str],
                            date_col: str, by: Sequence[str], context_rows: int,
                            compute: Callable[[DataFrame], DataFrame], lookback_days: int = 0,
                            full_refresh: bool = False, order: Sequence[str | Column] = ()) -> DataFrame:
    """K3 + G1 from stored state: one run of a windowed incremental model whose
    table, partitioned by ``date_col``, lies at ``path``.

    The versioned table ``state`` holds, for each ``by`` key, the last
    ``context_rows`` source rows before its *cut*, a date kept beside it. A run
    reads the state and the source from the cut on (a literal bound on the
    scan), never the history: ``compute`` runs over both, the rows at or after
    the mark replace or join those of their days, and the state moves on to the
    new mark (``lookback_days`` earlier, so that later runs may go back that
    far). The first run, a full refresh, and a run that asks for days before the
    cut read the whole source, and give the same table.

    The state is written after the table. A run that died between the two finds
    an older cut, reads from there, and merges the same rows again.
    """
    from tidemark.operators.relational import topk_per_key

    spark = source.sparkSession
    mark = None if full_refresh else read_mark(spark, path)
    since, cut = move_back(mark, lookback_days), None if full_refresh else current_mark(spark, state)
    if since is None or cut is None or since < cut:
        known = source  # nothing stored reaches back far enough
    else:
        known = read_current(spark, state).select(*source.columns).unionByName(source.where(F.col(date_col) >= F.lit(cut)))
    if since is None:
        rows = compute(known).select(*schema.fieldNames())
        seen = Observation()
        write_table(rows.observe(seen, F.max(date_col).alias("mark")), path, [date_col], replace_all=True)
        mark = seen.get.get("mark")
    else:
        ctx = topk_per_key(known.where(F.col(date_col) < F.lit(since)), by, [F.col(date_col).desc(), *[o for o in order]], context_rows)
        window = known.where(F.col(date_col) >= F.lit(since)).unionByName(ctx)
        rows = compute(window).where(F.col(date_col) >= F.lit(since)).select(*schema.fieldNames())
        merged = merge_partitions(rows, path, [*keys, date_col], date_col, schema)
        mark = max(d for d in (mark, merged.agg(F.max(date_col)).first()[0]) if d is not None)
    if mark is not None:
        write_mark(spark, path, mark)
        cut = move_back(mark, lookback_days)
        kept = topk_per_key(known.where(F.col(date_col) < F.lit(cut)), by, [F.col(date_col).desc(), *order], context_rows)
        write_version(kept, state, notes=lambda: {MARK: _mark_text(cut)})
        drop_old_versions(spark, state)
    return spark.read.schema(schema).parquet(path)
