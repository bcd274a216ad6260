"""As-of left join, backward and inclusive.

For each left row, the right row whose time is the greatest one at or before
the left time (optionally within the same ``by`` key); no earlier right row
gives NULLs. Spark does not take the reference's correlated ``max`` in ``ON``,
and a range join would pair every left row with every earlier right row. Two
linear plans are used instead:

* no key, DATE times: a *calendar spine* from the right side alone (each
  right date covers the days until the next one), joined to the left by
  date; left dates past the last right date take the last one.
* otherwise: a *merge*. Left and right rows go into one table sorted by (key,
  time, side), right rows first; each left row takes the last right row before
  it, and a range of that table takes the last one of earlier ranges of its key
  (``forward_fill``). Neither side is joined, so repeated times and hot keys
  cost no more than their rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.timeseries import forward_fill


def _right_columns(right: DataFrame, right_on: str, by: Sequence[str],
                   right_cols: Sequence[str] | None) -> list[str]:
    if right_cols is not None:
        return list(right_cols)
    return [c for c in right.columns if c not in by]


def asof_join(left: DataFrame, right: DataFrame, left_on: str, right_on: str,
              by: Sequence[str] | None = None, right_cols: Sequence[str] | None = None,
              flag_col: str | None = None, bucket=None, check_unique: bool = False) -> DataFrame:
    """Backward inclusive as-of left join.

    ``right_cols`` are the right columns to attach (default: all but ``by``;
    they must not clash with left column names). ``flag_col`` adds a boolean
    "a match exists" column (X12). The right side must be unique on
    ``(by, right_on)``; ``check_unique=True`` verifies it with one aggregate.
    ``bucket`` is a function ``Column -> Column`` giving the time bucket of the
    merge (default: ranges cut from the data). A NULL key or time matches
    nothing.
    """
    keys = list(by or [])
    cols = _right_columns(right, right_on, keys, right_cols)
    clash = [c for c in cols if c in left.columns]
    if clash:
        raise ValueError(f"right columns clash with left columns: {clash}")
    if check_unique:
        dup = right.groupBy(*keys, right_on).count().filter("count > 1").limit(1).count()
        if dup:
            raise ValueError("as-of right side is not unique on its key and time")
    if (not keys and bucket is None and isinstance(left.schema[left_on].dataType, T.DateType)
            and isinstance(right.schema[right_on].dataType, T.DateType)):
        return _asof_calendar(left, right, left_on, right_on, cols, flag_col)
    return _asof_merge(left, right, left_on, right_on, keys, cols, flag_col, bucket)


def _asof_calendar(left, right, left_on, right_on, cols, flag_col):
    """DATE times: a calendar spine built from the right side alone.

    Each right date covers the days up to the day before the next right date
    (one row per calendar day between the first and the last right date, so
    the spine is bounded by the calendar, not by the data); left dates on or
    after the last right date take the last one (a scalar subquery). The left
    side is only joined, never aggregated, so an expensive left input is
    computed once.
    """
    d, m = "__asof_day", "__asof_match"
    rd = right.select(F.col(right_on).alias(m)).where(F.col(m).isNotNull()).distinct()
    nxt = F.lead(m).over(Window.orderBy(m))  # distinct right dates: calendar-bounded
    spine = (rd.withColumn("__asof_next", nxt)
               .where(F.col("__asof_next").isNotNull())
               .select(F.explode(F.sequence(F.col(m), F.date_sub("__asof_next", 1))).alias(d),
                       F.col(m)))
    last = rd.agg(F.max(m)).scalar()  # uncorrelated scalar subquery, run once
    x = (left.join(spine, F.col(left_on) == F.col(d), "left")
             .withColumn(m, F.when(F.col(left_on) >= last, last).otherwise(F.col(m)))
             .drop(d))
    rsel = right.select(F.col(right_on).alias("__asof_r"), *[F.col(c) for c in cols if c != right_on],
                        *([F.col(right_on)] if right_on in cols else []))
    out = x.join(rsel, F.col(m) == F.col("__asof_r"), "left").drop("__asof_r")
    if flag_col:
        out = out.withColumn(flag_col, F.col(m).isNotNull())
    return out.drop(m)


def _asof_merge(left, right, left_on, right_on, keys, cols, flag_col, bucket):
    t, side, row, match = "__asof_t", "__asof_side", "__asof_row", "__asof_match"
    kind = right.schema[right_on].dataType
    names = [f"__asof_k_{k}" for k in keys]

    def rows(df, on, number, own, other):
        return df.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(on).cast(kind).alias(t),
                         F.lit(number).alias(side), own, other)

    here = F.struct(*[F.col(c) for c in left.columns])
    there = F.struct(F.col(right_on).alias("__asof_r"), *[F.col(c) for c in cols])
    lefts = rows(left, left_on, 1, here.alias(row), F.lit(None).cast(right.select(there).schema[0].dataType).alias(match))
    rights = rows(right, right_on, 0, F.lit(None).cast(left.select(here).schema[0].dataType).alias(row), there.alias(match))
    found = forward_fill(lefts.unionByName(rights.dropna(subset=[*names, t])), [t, side], [match], partition_by=names,
                         bucket=bucket(F.col(t)) if bucket is not None else None)
    # a left row without a key or time matches nothing
    known = F.lit(True)
    for c in [*names, t]:
        known = known & F.col(c).isNotNull()
    found = found.where(F.col(side) == 1).withColumn(match, F.when(known, F.col(match)))
    flag = [F.col(match).isNotNull().alias(flag_col)] if flag_col else []
    return found.select(*[F.col(row)[c].alias(c) for c in left.columns], *[F.col(match)[c].alias(c) for c in cols], *flag)
