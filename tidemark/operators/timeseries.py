"""Time-series operators: pivot, forward fill, rolling volatility, ranking
(SURVEY §2.6 A1, §2.7 W1–W5).

Frames count rows, not calendar days (a "7d" window is 7 observations), so
the ordering inside a key must be unique; pass a tie-break column otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.expr import col_of
from tidemark.operators.ranges import AT, positions, range_of, ranged


def _join_same_keys(big: DataFrame, small: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join on ``keys`` with NULL-safe equality.

    An inner equi join would infer ``IS NOT NULL`` filters on the big side and
    push them below its window, so the two uses of that side would no longer
    share one shuffle; NULL-safe equality infers nothing and matches NULL keys.
    """
    s = small.select(*[F.col(k).alias(f"__j_{k}") for k in keys],
                     *[c for c in small.columns if c not in keys])
    cond = [F.col(k).eqNullSafe(F.col(f"__j_{k}")) for k in keys]
    return big.join(s, cond, "left").drop(*[f"__j_{k}" for k in keys])


_AGGS = {"max": F.max, "min": F.min, "sum": F.sum, "first": F.first, "any_value": F.any_value}


def pivot_wide(df: DataFrame, index: Sequence[str], key: str, value: str,
               keys: Mapping[str, str], agg: str = "max") -> DataFrame:
    """A1: long to wide by conditional aggregation, one hash aggregate.

    ``keys`` maps each key value to its output column. Rows with other key
    values still produce their index row (all outputs NULL), as the
    reference's ``max(case when ...) group by`` does. The aggregate is split
    into partial and final stages, so a hot index value is combined map-side.
    """
    fn = _AGGS[agg]
    return df.groupBy(*index).agg(*[
        fn(F.when(F.col(key) == F.lit(k), F.col(value))).alias(out) for k, out in keys.items()])


def time_bucket(df: DataFrame, col: str):
    """The default time bucket of an ordering column: the month of a DATE, the
    day of a timestamp. One key's rows of one bucket meet in one task."""
    kind = df.schema[col].dataType
    if isinstance(kind, T.DateType):
        return F.date_trunc("month", F.col(col))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_trunc("day", F.col(col))
    raise ValueError(f"{col} is no date or timestamp: give a bucket that is monotone in it")


def forward_fill(df: DataFrame, order: str | Sequence[str], cols: Sequence[str] | Mapping[str, str],
                 partition_by: Sequence[str] | None = None, bucket: Column | None = None) -> DataFrame:
    """``last_value(c ignore nulls) over (order by t rows unbounded preceding)``.

    Two passes that never put a whole key into one task: (1) per (key, range)
    the last non-NULL value by ``max_by`` (partial + final aggregate), (2) carry
    those over the small table of ranges with a window per key, (3) fill inside
    each (key, range) and fall back to the carry. Ranges are cut from the data
    (``ranged``), so a hot key or day is split; the rows are written for that.
    With ``bucket``, an expression that is monotone in the order, rows of one
    (key, bucket) meet in one task and nothing is written: for tables that the
    calendar bounds, pass ``time_bucket``.

    ``order`` lists the ordering columns (the first is the time, the rest
    break ties); NULLs before the first value stay NULL; a NULL key is a key.
    """
    order_cols = [order] if isinstance(order, str) else list(order)
    mapping = dict(cols) if isinstance(cols, Mapping) else {c: c for c in cols}
    keys = list(partition_by or [])

    b = "__ff_bucket"
    if bucket is None:
        x = ranged(df, keys, order_cols).withColumn(b, range_of())
        order_cols = [AT]
    else:
        x = df.withColumn(b, bucket)
    order_exprs = [F.col(c).asc() for c in order_cols]
    okey = F.struct(*[F.col(c) for c in order_cols])
    names = {src: (f"__ff_in_{i}", f"__ff_last_{i}", f"__ff_carry_{i}")
             for i, src in enumerate(mapping)}
    last = x.groupBy(*keys, b).agg(*[
        F.max_by(F.col(src), F.when(F.col(src).isNotNull(), okey)).alias(n[1])
        for src, n in names.items()])
    wb = (Window.partitionBy(*keys) if keys else Window).orderBy(b) \
        .rowsBetween(Window.unboundedPreceding, -1)
    carry = last.select(*keys, b, *[
        F.last(F.col(n[1]), ignorenulls=True).over(wb).alias(n[2]) for n in names.values()])
    # most keys lie in one range and carry nothing
    carry = carry.where(reduce(lambda a, c: a | c, [F.col(n[2]).isNotNull() for n in names.values()]))
    wi = Window.partitionBy(*keys, b).orderBy(*order_exprs) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = x.select("*", *[F.last(F.col(src), ignorenulls=True).over(wi).alias(n[0])
                             for src, n in names.items()])
    out = _join_same_keys(filled, carry, [*keys, b])
    for src, (n_in, _, n_carry) in names.items():
        out = out.withColumn(mapping[src], F.coalesce(F.col(n_in), F.col(n_carry)))
    return out.drop(b, AT, *[n for trio in names.values() for n in (trio[0], trio[2])])


def row_index(df: DataFrame, by: Sequence[str], order: Sequence[Column], bucket: Column,
              name: str = "__idx") -> DataFrame:
    """1-based position of each row within its key under ``order``, without
    sorting a whole key in one task.

    Rows are counted per (key, bucket) (a partial aggregate), the counts are
    summed over earlier buckets on that small table, and the row number
    inside each (key, bucket) is shifted by that offset. ``bucket`` must be
    monotone in ``order`` (e.g. the month of the ordering date).
    """
    b, n, off, rn = "__ri_bucket", "__ri_n", "__ri_off", "__ri_rn"
    x = df.withColumn(b, bucket)
    local = x.withColumn(rn, F.row_number().over(Window.partitionBy(*by, b).orderBy(*order)))
    # The counts read all columns of the windowed rows, so neither branch is
    # pruned and both share one shuffle of the input (a reused exchange).
    counts = local.groupBy(*by, b).agg(F.max(F.struct(rn, *df.columns)).getField(rn).alias(n))
    before = (Window.partitionBy(*by) if by else Window).orderBy(b) \
        .rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*by, b, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(off))
    return (_join_same_keys(local, offsets, [*by, b])
                 .withColumn(name, (F.col(off) + F.col(rn)).cast("bigint"))
                 .drop(b, off, rn))


def rolling_std(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], value: str,
                windows: Mapping[str, int], digits: int | None = 4,
                chunk_rows: int = 100_000, bucket: Column | None = None) -> DataFrame:
    """Sample stddev over the last ``n`` rows per key, rounded.

    Rows sorted by key and order get their position over the whole table (a
    prefix sum by range, ``positions``), the table is cut into chunks of
    ``chunk_rows`` positions, and the last ``max(n) - 1`` rows of each chunk are
    copied into the next one as context only. A key holding a third of all rows,
    or all rows of a day, spreads over many tasks. All frames share one window
    operator, whose groups are the keys of a chunk. With ``bucket``, monotone in
    the order, positions come from counts per (key, bucket) instead
    (``row_index``) and nothing is written.
    """
    order_cols = [col_of(o) for o in order]
    overlap = max(windows.values()) - 1
    if chunk_rows <= overlap:
        raise ValueError("chunk_rows must exceed the largest window")
    idx, chunk, ctx = "__rs_idx", "__rs_chunk", "__rs_ctx"
    if bucket is None:
        x = positions(ranged(df, by, order_cols), idx).drop(AT).withColumn(idx, F.col(idx) + 1)
    else:
        x = row_index(df, by, order_cols, bucket, idx)
    pos = (F.col(idx) - 1) % chunk_rows
    c = F.floor((F.col(idx) - 1) / F.lit(chunk_rows)).cast("bigint")
    copies = F.array(F.struct(c.alias(chunk), F.lit(False).alias(ctx)),
                     F.when(pos >= chunk_rows - overlap,
                            F.struct((c + 1).alias(chunk), F.lit(True).alias(ctx))))
    x = (x.withColumn("__rs_copy", F.explode(F.array_compact(copies)))
          .withColumn(chunk, F.col("__rs_copy." + chunk)).withColumn(ctx, F.col("__rs_copy." + ctx))
          .drop("__rs_copy"))
    w = Window.partitionBy(*by, chunk).orderBy(idx)
    for name, n in windows.items():
        sd = F.stddev_samp(F.col(value)).over(w.rowsBetween(-(n - 1), Window.currentRow))
        # from 9 decimals, so that the last bits of the sum do not decide a tie
        x = x.withColumn(name, F.round(F.round(sd, 9), digits) if digits is not None else sd)
    return x.where(~F.col(ctx)).drop(idx, chunk, ctx)


def rank_by_value(df: DataFrame, by: Sequence[str], value: Column, name: str,
                  descending: bool = True, method: str = "rank") -> DataFrame:
    """``rank()`` or ``dense_rank()`` over (partition by by order by value)
    as bigint, for a numeric ``value``.

    Ranked from counts: rows are counted per (group, value) by a partial
    aggregate, so a common value is one row however often it occurs; the counts
    are summed over the values before it, slice by slice of the value range;
    and the rank is joined back by value. Slices are cut by a fixed monotone
    function of the value (64 to a power of two), so no group is sorted in
    one task and no statistics are gathered first. NULLs order as Spark's
    default (last when descending, first when ascending).
    """
    v, s, n, at = "__rv_v", "__rv_slice", "__rv_n", "__rv_at"
    x = df.withColumn(v, value)
    number = F.col(v).cast("double")
    steps = F.least((F.log2(F.abs(number)) + 1100) * 64, F.lit(1e9))  # positive for any double
    cut = F.when(F.isnan(number), F.lit(2 ** 31)).when(number == 0, F.lit(0)) \
        .when(number.isNotNull(), F.floor(F.signum(number) * steps)).cast("bigint")
    counts = x.groupBy(*by, cut.alias(s), v).agg(F.count(F.lit(1)).alias(n))
    if method == "dense_rank":
        counts = counts.withColumn(n, F.lit(1).cast("bigint"))
    elif method != "rank":
        raise ValueError(f"unknown method {method!r}")
    order = (lambda c: F.col(c).desc_nulls_last()) if descending else (lambda c: F.col(c).asc_nulls_first())
    rows_before = (Window.unboundedPreceding, -1)
    inside = F.sum(n).over(Window.partitionBy(*by, s).orderBy(order(v)).rowsBetween(*rows_before))
    slices = counts.groupBy(*by, s).agg(F.sum(n).alias(n))
    before = F.sum(n).over(Window.partitionBy(*by).orderBy(order(s)).rowsBetween(*rows_before))
    slices = slices.select(*by, s, F.coalesce(before, F.lit(0)).alias(at))
    ranks = _join_same_keys(counts.withColumn("__rv_in", F.coalesce(inside, F.lit(0))), slices, [*by, s])
    ranks = ranks.select(*by, v, (F.col("__rv_in") + F.col(at) + 1).cast("bigint").alias(name))
    return _join_same_keys(x, ranks, [*by, v]).drop(v)
