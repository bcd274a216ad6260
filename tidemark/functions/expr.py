"""Column-level functions.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the null placeholder used by the public dbt_utils
# generate_surrogate_key macro; must be equal for keys to match.
SURROGATE_NULL_TOKEN = "_dbt_utils_surrogate_key_null_"


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_pct_change(from_col: str | Column, to_col: str | Column,
                    digits: int | None = 4) -> Column:
    """round((to - from) / nullif(from, 0) * 100, digits).

    A zero or NULL base gives NULL instead of an ANSI divide-by-zero error.
    """
    base = col_of(from_col)
    pct = (col_of(to_col) - base) / F.nullif(base, F.lit(0)) * F.lit(100)
    return F.round(pct, digits) if digits is not None else pct


def tier(value: str | Column, thresholds: Sequence[tuple[float, str]],
         default: str | None) -> Column:
    """Searched CASE over ordered lower bounds (first match wins, inclusive).

    NULL values fall through to ``default`` as SQL CASE does.
    """
    v = col_of(value)
    expr = None
    for lower, label in thresholds:
        cond = v >= F.lit(lower)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))


def label_map(value: str | Column, mapping: Mapping[str, str],
              default: str | None) -> Column:
    """X11: simple CASE lookup with a default.

    One branch per label, for fixed maps; lookups that come with the data
    belong in a join against a mapping table (``operators.relational.enrich``).
    """
    v = col_of(value)
    expr = None
    for key, label in mapping.items():
        cond = v == F.lit(key)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def surrogate_key(cols: Iterable[str | Column],
                  null_token: str = SURROGATE_NULL_TOKEN) -> Column:
    """md5 of the '-'-joined string forms, NULL replaced by a token."""
    parts = [F.coalesce(col_of(c).cast("string"), F.lit(null_token)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def add_surrogate_key(df: DataFrame, name: str, cols: Sequence[str],
                      null_token: str = SURROGATE_NULL_TOKEN) -> DataFrame:
    """X15 with a type check: floating columns print differently across
    engines (1.0E8 vs 100000000.0), so they are refused as key parts."""
    types = dict(df.dtypes)
    bad = [c for c in cols if types.get(c) in ("double", "float")]
    if bad:
        raise TypeError(f"surrogate key over floating columns is not stable: {bad}")
    return df.withColumn(name, surrogate_key(cols, null_token))


def day_of_week_sun0(d: str | Column) -> Column:
    """Day of week with Sunday = 0 (Spark's dayofweek gives Sunday = 1)."""
    return (F.dayofweek(col_of(d)) - 1).cast("bigint")


def calendar_parts(df: DataFrame, date_col: str, prefix: str) -> DataFrame:
    """Year, month and day of week (Sunday = 0) as bigint columns."""
    d = F.col(date_col)
    return (df.withColumn(f"{prefix}_year", F.year(d).cast("bigint"))
              .withColumn(f"{prefix}_month", F.month(d).cast("bigint"))
              .withColumn(f"{prefix}_day_of_week", day_of_week_sun0(d)))


def strict_double(c: str | Column, what: str = "value") -> Column:
    """Numeric parse that fails the job on unparsable text.

    Raises whatever the ANSI setting is (explicit ``raise_error``).
    """
    s = col_of(c)
    parsed = s.try_cast("double")
    return F.when(s.isNotNull() & parsed.isNull(),
                  F.raise_error(F.concat(F.lit(f"invalid {what}: "), s.cast("string")))
                  ).otherwise(parsed)


def strict_long(c: str | Column, what: str = "value") -> Column:
    """X4/X22 for integral measures (volume): whole numbers are kept exactly;
    other numbers ("12.0", "1e3") lose their fraction; bad text fails the job."""
    s = col_of(c)
    return F.coalesce(s.try_cast("bigint"), strict_double(s, what).cast("bigint"))


def lenient_double(c: str | Column) -> Column:
    """Numeric parse, unparsable text (e.g. '.') becomes NULL."""
    return col_of(c).try_cast("double")


def strict_date(c: str | Column, fmt: str = "yyyy-MM-dd") -> Column:
    """String to date; bad input fails the job."""
    s = col_of(c)
    parsed = F.call_function("try_to_date", s, F.lit(fmt))  # straight to DATE: no time zone
    return F.when(s.isNotNull() & parsed.isNull(),
                  F.raise_error(F.concat(F.lit("invalid date: "), s))).otherwise(parsed)


def json_text(c: str | Column) -> Column:
    """X16 + G8: object to JSON text; NULL becomes the text 'null'."""
    return F.coalesce(F.to_json(col_of(c)), F.lit("null"))


def nan_to_null(c: str | Column) -> Column:
    """Floating NaN becomes NULL."""
    v = col_of(c)
    return F.when(F.isnan(v), F.lit(None).cast("double")).otherwise(v)


def as_of_date(as_of) -> Column:
    """A fixed reference date (argument), never the wall clock by default
    inside tests; pass None to use current_date()."""
    return F.current_date() if as_of is None else F.lit(as_of).cast("date")


def as_of_timestamp(as_of) -> Column:
    return (F.localtimestamp() if as_of is None
            else F.lit(as_of).cast(T.TimestampNTZType()))


def days_before(as_of, days: int) -> Column:
    """The date ``days`` before ``as_of``."""
    return F.date_sub(as_of_date(as_of), days)


def typed_null(dtype: T.DataType | str) -> Column:
    """P5: a NULL of an explicit type (never rely on VOID widening)."""
    return F.lit(None).cast(dtype)
