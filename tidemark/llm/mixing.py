"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight that ramps over training time t from 0 to 1. The
integral of the ramp sets the source's share of the words to train on; the
running integral is its cumulative demand. A document stands at a place of its
source's word stream (the source's documents in hash order, repeated), and the
time when the demand reaches that place is its training position. Sorting by
position gives the training order.

All of it is built-in expressions. Per-source tables have one row a source and
are ordered by range, so there may be as many sources as web hosts; the place of
a document is a sum over hash buckets of its source plus a sum inside
its bucket, so a source with a third of all rows is spread over 4,096 groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored, word_count
from tidemark.operators.ranges import AT, positions, range_of, ranged

#: (weight at the start, weight at the end) of the sources in turn; the mean is
#: the source's overall weight: 5, 2, 1.
RAMPS = ((6.0, 4.0), (2.0, 2.0), (0.5, 1.5))
BUDGET = 1.5      # words to train on, as a share of all words
MOST_REPEATS = 2  # a source's target stops at so many times its size


def source_targets(sizes: DataFrame, ramps: Sequence[tuple[float, float]] = RAMPS, budget: float = BUDGET,
                   most: int = MOST_REPEATS, source_col: str = "source", size_col: str = "size") -> DataFrame:
    """(source, source_size, ramp_start, ramp_end, target) for every source.

    Sources take the ramps in turn, by code point, null last. Targets share
    ``budget`` times all sizes by weight, stop at ``most`` times the source's
    size, and what that leaves over is shared again by weight until none is
    above. In closed form: sources ordered by cap / weight; the first whose
    share of what the ones before it leave fits under its cap sets the level
    (words a unit of weight) for itself and all after it. Sources of size 0
    have target 0.
    """
    by_source = (F.col("source").isNull(), "source")
    sums = sizes.groupBy(F.col(source_col).alias("source")).agg(F.sum(size_col).cast("long").alias("source_size"))
    rows = positions(ranged(sums, [], by_source), "place").drop(AT)

    def pick(k: int) -> Column:
        return F.element_at(F.array(*[F.lit(float(r[k])) for r in ramps]), F.pmod("place", F.lit(len(ramps))).cast("int") + 1)

    rows = (rows.select("source", "source_size", pick(0).alias("ramp_start"), pick(1).alias("ramp_end"))
            .withColumn("weight", (F.col("ramp_start") + F.col("ramp_end")) / 2)
            .withColumn("cap", F.col("source_size") * F.lit(float(most))))
    rows = _levels(ranged(rows, [], (F.col("cap") / F.col("weight"), *by_source)), budget)
    fits = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(AT, "level"))
    found = rows.agg(F.min(fits).getField("level")).scalar()
    return rows.withColumn("found", found).select(
        "source", "source_size", "ramp_start", "ramp_end",
        F.coalesce(F.least("cap", F.col("found") * F.col("weight")), F.col("cap")).alias("target"))


def _levels(rows: DataFrame, budget: float) -> DataFrame:
    """``ranged`` sources plus level: what the sources before leave of the budget,
    a unit of weight of the source and those after it. Sums inside a range are
    windows; the sums of ranges are one row a range, so the table that is
    broadcast is as long as the number of partitions."""
    rows = rows.withColumn("__part", range_of())
    every = Window.partitionBy()
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (rows.groupBy("__part").agg(F.sum("source_size").alias("n"), F.sum("cap").alias("cap"), F.sum("weight").alias("weight"))
             .select("__part", (F.sum("n").over(every) * F.lit(float(budget))).alias("__budget"),
                     F.coalesce(F.sum("cap").over(before), F.lit(0.0)).alias("__caps"),
                     (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))).alias("__weights")))
    inside = Window.partitionBy("__part").orderBy(AT).rowsBetween(Window.unboundedPreceding, -1)

    def upto(column: str) -> Column:
        return F.coalesce(F.sum(column).over(inside), F.lit(0.0))

    rows = rows.withColumn("__cap_upto", upto("cap")).withColumn("__weight_upto", upto("weight"))
    level = (F.col("__budget") - F.col("__caps") - F.col("__cap_upto")) / (F.col("__weights") - F.col("__weight_upto"))
    return rows.join(F.broadcast(parts), "__part").withColumn("level", level)


def _time_of(share: Column) -> Column:
    """The time at which a ramp's running integral is ``share`` of the whole:
    the root of start * t + (end - start) * t**2 / 2 = share * (start + end) / 2."""
    start, end = F.col("__ramp_start"), F.col("__ramp_end")
    a, b, c = (end - start) / 2, start, share * ((start + end) / 2)
    return (c * 2) / (b + F.sqrt(b * b + a * 4 * c))


def _place(rows: DataFrame, ramps: Sequence[tuple[float, float]], budget: float, most: int) -> DataFrame:
    """``rows`` (with __id, __source, __size and __tie) plus a struct __mix of
    source_size, target, copies, taken and positions."""
    mark = F.coalesce(F.md5(F.col("__id").cast("string")), F.lit(""))
    # null ids, which all have the first mark, are spread by size
    bucket = F.when(F.col("__id").isNull(), F.concat(F.lit("!"), F.lpad(F.col("__size").cast("string"), 19, "0"))) \
        .otherwise(F.substring("__mark", 1, 3))
    sized = (rows.withColumn("__mark", mark).withColumn("__bucket", bucket)
             .withColumn("__stream", F.coalesce(F.concat(F.lit("s"), F.col("__source").cast("string")), F.lit(""))))
    sums = stored(sized.groupBy("__stream", "__bucket").agg(
        F.first("__source").alias("source"), F.sum("__size").alias("bucket_size")), "mix-buckets")
    targets = source_targets(sums, ramps, budget, most, size_col="bucket_size")
    before = F.sum("bucket_size").over(Window.partitionBy("__stream").orderBy("__bucket")) - F.col("bucket_size")
    buckets = sums.withColumn("__before", before).alias("b").join(
        targets.alias("t"), F.col("b.source").eqNullSafe(F.col("t.source"))).select(
        "__stream", "__bucket", "__before", *[F.col(c).alias(f"__{c}") for c in ("source_size", "ramp_start", "ramp_end", "target")])
    inside = Window.partitionBy("__stream", "__bucket").orderBy("__mark", "__id", "__size", "__tie") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (sized.withColumn("__upto", F.sum("__size").over(inside) - F.col("__size"))
              .join(buckets, ["__stream", "__bucket"])
              .withColumn("__start", F.col("__before") + F.col("__upto")))
    times = F.transform(F.sequence(F.lit(0), F.lit(most - 1)),
                        lambda k: F.col("__start") + k * F.col("__source_size") + F.col("__size") / 2)
    taken = F.filter(times, lambda x: (x < F.col("__target")) & (F.col("__size") > 0))
    return placed.withColumn("__middles", taken).select(*[F.col(f"`{c}`") for c in rows.columns], F.struct(
        F.col("__source_size").alias("source_size"), F.col("__target").alias("target"),
        F.size("__middles").alias("copies"), (F.size("__middles") * F.col("__size")).cast("long").alias("taken"),
        F.transform("__middles", lambda x: _time_of(x / F.col("__target"))).alias("positions")).alias("__mix"))


def placed_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                ramps: Sequence[tuple[float, float]] = RAMPS, budget: float = BUDGET,
                most: int = MOST_REPEATS) -> DataFrame:
    """All columns of ``df`` plus __positions, each row's own training times,
    and __tie, a hash of the row; see ``assign_positions``. Rows that share an
    id and a size are ordered by the hash of all their columns."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    rows = df.select(*columns, F.col(id_col).cast("long").alias("__id"), F.col(source_col).alias("__source"),
                     word_count(F.col(text_col)).alias("__size"),
                     F.xxhash64(*columns, *[c.isNull() for c in columns]).alias("__tie"))
    return _place(rows, ramps, budget, most).select(*columns, F.col("__mix.positions").alias("__positions"), "__tie")


def assign_positions(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                     ramps: Sequence[tuple[float, float]] = RAMPS, budget: float = BUDGET,
                     most: int = MOST_REPEATS) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken, positions)
    for every row of ``df``.

    A source's stream is its documents by the hash of their id, read ``most``
    times. Whole documents are taken while their middle lies before the target,
    so a source's taken words miss its target by half a document at most.
    ``positions`` has one training time (0 to 1) for each copy taken.

    Defined cases: a null text has size 0 and takes nothing; null sources form
    one source, last in order; null ids come first in hash order; equal rows
    are documents of their own, and tied ids are ordered by size, then by the
    hash of their text; an empty table gives no rows. Other columns are not read.
    """
    rows = stored(df.select(F.col(id_col).cast("long").alias("__id"), F.col(source_col).alias("__source"),
                            word_count(F.col(text_col)).alias("__size"), F.xxhash64(F.col(text_col)).alias("__tie")),
                  "mix-sized")
    return _place(rows, ramps, budget, most).select(
        F.col("__id").alias("doc_id"), F.col("__source").alias("source"), F.col("__size").alias("size"), "__mix.*")


def training_order(assigned: DataFrame) -> DataFrame:
    """(doc_id, copy, position) for every copy taken, range-sorted by position."""
    return (assigned.select("doc_id", F.posexplode("positions").alias("copy", "position"))
            .orderBy("position", "doc_id", "copy"))
