"""Projections, filters, unions, dimension joins and top-k."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T



def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def select_renamed(df: DataFrame, mapping: Mapping[str, str | Column]) -> DataFrame:
    """Keep only the mapped columns, in mapping order.

    ``mapping`` is ``{output_name: source column name or Column}``. A pure
    rename is sent as one SQL projection (one call per column, not three).
    """
    if all(isinstance(v, str) for v in mapping.values()):
        return df.selectExpr(*[f"{_quote(src)} AS {_quote(out)}" for out, src in mapping.items()])
    return df.select(*[F.expr(f"{_quote(src)} AS {_quote(out)}") if isinstance(src, str)
                       else src.alias(out) for out, src in mapping.items()])


def conform_union(branches: Sequence[DataFrame], schema: T.StructType) -> DataFrame:
    """UNION ALL by name into a declared schema.

    Missing columns become typed NULLs, present ones are cast to the declared
    type, and a column that the schema does not know is an error (the
    reference unions by position, which silently misaligns such columns).
    """
    if not branches:
        raise ValueError("conform_union needs at least one branch")
    names = [f.name for f in schema.fields]
    aligned = []
    for i, b in enumerate(branches):
        present = set(b.columns)
        extra = [c for c in b.columns if c not in names]
        if extra:
            raise ValueError(f"branch {i} has columns outside the schema: {extra}")
        aligned.append(b.selectExpr(*[
            f"CAST({_quote(f.name) if f.name in present else 'NULL'} AS {f.dataType.simpleString()})"
            f" AS {_quote(f.name)}" for f in schema.fields]))
    return reduce(lambda a, b: a.unionByName(b), aligned)


def enrich(fact: DataFrame, dim: DataFrame, on: str | Sequence[str],
           columns: Sequence[str] | None = None, how: str = "left") -> DataFrame:
    """Fact-to-dimension equi join that never multiplies facts.

    A dimension key that occurs twice fails the job. The check stands beside the
    join, as a scalar subquery over the dimension's keys alone that a filter
    above the join reads, so both inputs of the join are plain shuffles and
    adaptive execution can split a skewed key. NULL keys match nothing and may
    repeat.

    The broadcast decision is left to the planner by default: the static
    planner broadcasts a side whose estimated size is under
    ``spark.sql.autoBroadcastJoinThreshold`` and AQE re-plans a sort-merge
    join as a broadcast join when the shuffled dimension turns out small. Both
    are size-checked.
    """
    keys = [on] if isinstance(on, str) else list(on)
    others = [c for c in (dim.columns if columns is None else columns) if c not in keys]
    return fact.join(dim.select(*keys, *others), keys, how).where(no_duplicate_key(dim, keys))


def _told(keys: Sequence[str]) -> Column:
    return F.concat(F.lit(f"duplicate key {', '.join(keys)}: "),
                    F.concat_ws(", ", *[F.col(k).cast("string") for k in keys]))


def no_duplicate_key(df: DataFrame, keys: Sequence[str]) -> Column:
    """A scalar subquery that is true, and fails the job if ``df`` holds a
    non-NULL key twice. Only the keys are read and counted."""
    known = df.select(*keys).dropna()
    twice = known.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > 1)
    return twice.agg(F.min(F.raise_error(_told(keys)).cast("boolean"))).scalar().isNull()


def unique_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df``, whose rows with a repeated non-NULL key fail the job."""
    others = [c for c in df.columns if c not in keys]
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    rows = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), *[F.first(c).alias(c) for c in others])
            .withColumn("__n", F.when(known & (F.col("__n") > 1), F.raise_error(_told(keys)).cast("bigint")).otherwise(F.col("__n"))))
    return rows.where(F.col("__n") >= 1).select(*df.columns)


def topk_per_key(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int,
                 rank_col: str | None = None) -> DataFrame:
    """The first ``k`` rows per key under ``order``.

    ``row_number() <= k`` is planned as a WindowGroupLimit before the shuffle,
    so every map task keeps at most ``k`` rows per key and a hot key never
    ships all its rows to one task.
    """
    w = Window.partitionBy(*by).orderBy(*order)
    name = rank_col or "__rn"
    out = df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= k)
    return out if rank_col else out.drop(name)


def topk(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """Global top-k (planned as TakeOrderedAndProject: per-task top-k, then merge)."""
    return df.orderBy(*order).limit(k)
