"""Data-quality checks and source freshness.

``violations`` returns the offending rows; ``check_table`` returns a report
frame ``(check, table, column, severity, violations, passed, status)``.
All row-level checks of a table run in **one** aggregate pass; each unique
check is one partial/final group-by; each relationship is one anti join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, Row
from pyspark.sql import functions as F

from tidemark.functions.expr import as_of_date, as_of_timestamp
from tidemark.operators.sinks import write_version


@dataclass(frozen=True)
class NotNull:  # Q1 Q10
    column: str
    severity: str = "error"
    name: str = "not_null"

    def violation(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class AcceptedValues:  # Q3; NULL is not a violation
    column: str
    values: tuple
    severity: str = "error"
    name: str = "accepted_values"

    def violation(self) -> Column:
        return F.col(self.column).isNotNull() & ~F.col(self.column).isin(list(self.values))


@dataclass(frozen=True)
class Expectation:  # Q5–Q7: a row violates when ``predicate`` is true (NULL = no)
    label: str
    predicate: Column
    column: str = ""
    severity: str = "error"

    @property
    def name(self) -> str:
        return self.label

    def violation(self) -> Column:
        return F.coalesce(self.predicate, F.lit(False))


@dataclass(frozen=True)
class Unique:  # Q2 A6: number of non-NULL key values that occur more than once
    columns: tuple
    severity: str = "error"
    name: str = "unique"


@dataclass(frozen=True)
class Relationship:  # Q4 J5: non-NULL child keys absent from the parent
    column: str
    parent: DataFrame = field(compare=False)
    parent_column: str = ""
    severity: str = "warn"
    name: str = "relationships"


def violations(df: DataFrame, predicate: Column) -> DataFrame:
    """The rows for which ``predicate`` is true (NULL is not a violation)."""
    return df.where(predicate)


def positive(col: str) -> Column:
    """Q5: ``col <= 0`` is a violation."""
    return F.col(col) <= F.lit(0)


def not_in_future(col: str, as_of=None) -> Column:
    """Q6: ``col > as_of`` (default today) is a violation."""
    return F.col(col) > as_of_date(as_of)


def out_of_range(bounds: dict[str, tuple[float, float]]) -> Column:
    """Q7: any column outside its inclusive range; NULL is not a violation."""
    return reduce(lambda a, b: a | b,
                  [~F.col(c).between(lo, hi) for c, (lo, hi) in bounds.items()])


def require_not_null(df: DataFrame, cols: Sequence[str], table: str = "") -> DataFrame:
    """Q10: NOT NULL key columns at load — the job fails on the first NULL.

    Checked inside the projection that feeds the write (``raise_error``), so
    it costs no extra pass over the data.
    """
    out = df
    for c in cols:
        out = out.withColumn(c, F.when(F.col(c).isNull(), F.raise_error(
            F.lit(f"NULL in NOT NULL column {table}.{c}"))).otherwise(F.col(c)))
    return out


def duplicate_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Non-NULL key values with more than one row, and their counts."""
    nn = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    return (df.where(nn).groupBy(*cols).agg(F.count(F.lit(1)).alias("n_rows"))
              .where(F.col("n_rows") > 1))


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose non-NULL key is absent from the parent."""
    p = parent.select(F.col(parent_column).alias(column)).where(F.col(column).isNotNull())
    return child.where(F.col(column).isNotNull()).join(p, column, "left_anti")


def orphan_count(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Q4: number of child rows with a non-NULL key absent from the parent.

    Both sides are reduced to their distinct keys first (partial aggregates,
    the child side carrying its row count), so a key that holds a third of
    the child rows is one row in the join, not a skewed partition.
    """
    keys = (child.where(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("__rows")))
    p = parent.select(F.col(parent_column).alias(column)).where(F.col(column).isNotNull()).distinct()
    return keys.join(p, column, "left_anti").agg(
        F.coalesce(F.sum("__rows"), F.lit(0)).cast("bigint").alias("n"))


def _status(severity: str, n: Column) -> Column:
    return (F.when(n == 0, F.lit("pass"))
             .otherwise(F.lit("warn" if severity == "warn" else "fail")))


def _report_row(check: str, table: str, column: str, severity: str, n: Column) -> Column:
    n = n.cast("bigint")
    return F.struct(F.lit(check).alias("check"), F.lit(table).alias("table"),
                    F.lit(column).alias("column"), F.lit(severity).alias("severity"),
                    n.alias("violations"), (n == 0).alias("passed"),
                    _status(severity, n).alias("status"))


def check_table(df: DataFrame, table: str, checks: Sequence, severities: Mapping[str, str] | None = None) -> DataFrame:
    """Run ``checks`` against ``df``; one report row per check. ``severities``
    gives checks another severity, by name."""
    checks = [replace(c, severity=(severities or {}).get(c.name, c.severity)) for c in checks]
    row_checks = [c for c in checks if isinstance(c, (NotNull, AcceptedValues, Expectation))]
    parts: list[DataFrame] = []
    if row_checks:
        agg = df.agg(*[F.count_if(c.violation()).alias(f"v{i}") for i, c in enumerate(row_checks)])
        rows = [_report_row(c.name, table, getattr(c, "column", ""), c.severity, F.col(f"v{i}"))
                for i, c in enumerate(row_checks)]
        parts.append(agg.select(F.explode(F.array(*rows)).alias("r")).select("r.*"))
    for c in checks:
        if isinstance(c, Unique):
            n = duplicate_keys(df, list(c.columns)).agg(F.count(F.lit(1)).alias("n"))
            parts.append(n.select(_report_row(c.name, table, ",".join(c.columns), c.severity,
                                              F.col("n")).alias("r")).select("r.*"))
        elif isinstance(c, Relationship):
            n = orphan_count(df, c.column, c.parent, c.parent_column or c.column)
            parts.append(n.select(_report_row(c.name, table, c.column, c.severity,
                                              F.col("n")).alias("r")).select("r.*"))
    if not parts:
        raise ValueError("no checks given")
    return reduce(lambda a, b: a.unionByName(b), parts)


class CheckedWrite(NamedTuple):
    """A table that was checked while it was written."""

    rows: DataFrame      # the table, all rows
    rejected: DataFrame  # the rows that violate a check, with __failed, the labels of those checks
    report: DataFrame    # one row a check, as ``check_table`` gives it


def _label(check) -> str:
    return f"{check.name}({getattr(check, 'column', '')})"


def write_checked(df: DataFrame, base: str, table: str, checks: Sequence) -> CheckedWrite:
    """Q1 Q3 Q5–Q7 during the write: row checks are counted by the write itself
    (observed metrics), and rows that violate one are written into a folder of
    their own beside the others, so neither the report nor the rejected rows
    read the table again. A new version is written, as by ``write_version``.

    Checks over several rows (Unique, Relationship) read their key column of the
    version afterwards. Nothing is left out: ``rows`` has all rows, rejected ones
    included; what to do about them is the caller's decision.
    """
    spark = df.sparkSession
    row_checks = [c for c in checks if not isinstance(c, (Unique, Relationship))]
    others = [c for c in checks if isinstance(c, (Unique, Relationship))]
    failed = F.array_compact(F.array(*[F.when(c.violation(), F.lit(_label(c))) for c in row_checks]))
    seen = Observation()
    x = df.withColumn("__failed", failed.cast("array<string>"))
    if row_checks:
        x = x.observe(seen, *[F.count_if(F.array_contains("__failed", _label(c))).alias(f"v{i}") for i, c in enumerate(row_checks)])
    path = write_version(x.withColumn("__rejected", F.size("__failed") > 0), base, ["__rejected"], deal=False)
    written = spark.read.schema(x.schema.add("__rejected", "boolean")).parquet(path)
    counts = seen.get if row_checks else {}
    found = [Row(check=c.name, table=table, column=getattr(c, "column", ""), severity=c.severity,
                 violations=counts.get(f"v{i}", 0)) for i, c in enumerate(row_checks)]
    report = spark.createDataFrame(found, "check string, table string, column string, severity string, violations long").select(
        "*", (F.col("violations") == 0).alias("passed"),
        F.when(F.col("violations") == 0, "pass").when(F.col("severity") == "warn", "warn").otherwise("fail").alias("status"))
    rows = written.select(*df.columns)
    if others:
        report = report.unionByName(check_table(rows, table, others))
    return CheckedWrite(rows, written.where("__rejected").select(*df.columns, "__failed"), report)


def freshness(df: DataFrame, source: str, loaded_at: str, warn_after_hours: float,
              error_after_hours: float, as_of=None) -> DataFrame:
    """Age of the newest ``loaded_at`` against warn / error thresholds.

    One ``max`` aggregate; an empty source has no age and is an error.
    """
    now = as_of_timestamp(as_of)
    m = df.agg(F.max(loaded_at).alias("max_loaded_at"))
    # wall-clock difference of the two NTZ values: no session time zone (and
    # no daylight-saving shift) enters the age
    age = F.timestamp_diff("MICROSECOND", F.col("max_loaded_at"), now) / F.lit(3_600_000_000.0)
    return m.select(
        F.lit(source).alias("source"), F.col("max_loaded_at"),
        F.round(age, 4).alias("age_hours"),
        F.when(F.col("max_loaded_at").isNull(), F.lit("error"))
         .when(age > F.lit(error_after_hours), F.lit("error"))
         .when(age > F.lit(warn_after_hours), F.lit("warn"))
         .otherwise(F.lit("pass")).alias("status"))
