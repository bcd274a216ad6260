"""Positions by range: the distributed prefix sum that the ordered operators share.

Rows are dealt into ranges of (key, order) of about equal size, sorted inside
each, and written with their place; a key that holds a third of all rows, or a
day that does, spreads over as many ranges as it fills. What an operator needs
from earlier ranges (a row count, a last value) is one row a range, carried
forward over that small table and joined back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.expr import col_of
from tidemark.session import materialize

AT = "__range_at"  # a row's range (upper bits) and place in it
_BITS = 33         # bits of monotonically_increasing_id that count the rows of a partition


def ranged(df: DataFrame, by: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """``df`` plus ``AT``, which grows with (by, order) over the whole table and
    tells the range. Rows that tie on (by, order) are ordered by a hash of the
    row, which also splits many ties over ranges.

    The ranges are cut from a sample, so the table is written once and read back:
    every use sees the same places.
    """
    cols = [*[F.col(k) for k in by], *[col_of(o) for o in order]]
    hashable = [c.name for c in df.schema.fields if not _holds_map(c.dataType)]
    tie = F.xxhash64(*hashable) if hashable else F.lit(0)
    x = df.repartitionByRange(*cols, tie).sortWithinPartitions(*cols, tie)
    return materialize(x.withColumn(AT, F.monotonically_increasing_id()), "ranges")


def range_of(at: str = AT) -> Column:
    return F.shiftright(F.col(at), _BITS)


def positions(x: DataFrame, name: str) -> DataFrame:
    """``ranged`` rows plus ``name``: the 0-based position over the whole table.

    Rows are counted by range, the counts are summed over earlier ranges (one
    row a range, so the table that is broadcast is as long as the number of
    partitions), and a row's place in its range is added.
    """
    r, n, before = "__range_bucket", "__range_n", "__range_before"
    counts = x.select(range_of().alias(r)).groupBy(r).agg(F.count(F.lit(1)).alias(n))
    w = Window.orderBy(r).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(r, F.coalesce(F.sum(n).over(w), F.lit(0)).alias(before))
    place = F.col(AT).bitwiseAND(F.lit((1 << _BITS) - 1))
    return (x.withColumn(r, range_of()).join(F.broadcast(offsets), r)
            .withColumn(name, F.col(before) + place).drop(r, before))


def _holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.MapType):
        return True
    if isinstance(kind, T.ArrayType):
        return _holds_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_holds_map(f.dataType) for f in kind.fields)
    return isinstance(kind, T.VariantType)
