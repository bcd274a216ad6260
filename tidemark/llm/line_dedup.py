"""Line dedup by site-relative frequency.

For every host, the pages that have a line are divided by the host's pages;
lines above the boilerplate ratio are dropped from the host's pages. Copies of
a page are one page here: that a page was crawled a thousand times says nothing
about its lines. A caller that takes near copies for one page as well hands in
their groups (``page_groups``). Built-in expressions only: counts are partial aggregates over
hashes of host, line and page, so a hot host, line or page is summed where it is
read.

The lines dropped from one host number at most its distinct lines a page over
the ratio, so they go to its pages as one array. Hosts join their pages by hash
or, when the planner finds the table small, by broadcast; a hot host's pages
are split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import near_dup
from tidemark.llm.common import stored

RATIO = 0.05    # share of a host's pages above which a line is boilerplate
MIN_PAGES = 5   # pages a line must be on at least
BLANKS = " \t\r\x0b\x0c"


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _mark(line: Column) -> Column:
    return F.xxhash64(F.btrim(line, F.lit(BLANKS)))


def page_groups(df: DataFrame, text_col: str = "text") -> DataFrame:
    """(page, group) for the pages that are near copies of others (5-word
    shingles, 0.8) but for the one that names the group."""
    text = F.col(text_col)
    pages = stored(df.where(text.isNotNull()).select(F.xxhash64(text).alias("page"), text.alias("text"))
                   .dropDuplicates(["page"]), "line-pages")
    return stored(near_dup.near_duplicates(pages, "page").where("component_id <> doc_id").select(
        F.col("doc_id").alias("page"), F.col("component_id").alias("group")), "line-groups")


def boilerplate(df: DataFrame, host: Column, text_col: str = "text", ratio: float = RATIO,
                min_pages: int = MIN_PAGES, groups: DataFrame | None = None) -> DataFrame:
    """(host, marks): hashes of the lines that each host repeats too often. The
    pages of one of ``groups`` are one page."""
    def grouped(rows: DataFrame) -> DataFrame:
        if groups is None:
            return rows
        return rows.join(groups, "page", "left").withColumn("page", F.coalesce("group", "page")).drop("group").distinct()

    text = F.col(text_col)
    pages = df.where(text.isNotNull()).select(host.alias("host"), F.xxhash64(text).alias("page"), text.alias("text"))
    lines = pages.select("host", "page", F.explode(F.transform(_lines(F.col("text")), _mark)).alias("mark"))
    blank = F.xxhash64(F.lit(""))
    counts = (grouped(lines.where(F.col("mark") != blank).distinct())
              .groupBy("host", "mark").agg(F.count(F.lit(1)).alias("n")))
    totals = (grouped(pages.select(F.col("host").alias("total_host"), "page").distinct())
              .groupBy("total_host").agg(F.count(F.lit(1)).alias("pages")))
    often = (counts.where(F.col("n") >= min_pages)
             .join(totals, F.col("host").eqNullSafe(F.col("total_host")))
             .where(F.col("n") > F.lit(ratio) * F.col("pages")))
    return often.groupBy("host").agg(F.collect_list("mark").alias("marks"))


def cut_lines(df: DataFrame, host: Column, text_col: str = "text", ratio: float = RATIO,
              min_pages: int = MIN_PAGES, groups: DataFrame | None = None) -> DataFrame:
    """``df`` with boilerplate lines cut from ``text_col``, plus __n_lines and
    __n_dropped; see ``dedup_lines``."""
    marks = stored(boilerplate(df, host, text_col, ratio, min_pages, groups), "line-marks")
    marks = marks.select(F.col("host").alias("__host"), F.col("marks").alias("__marks"))
    lines = _lines(F.col(text_col))
    kept = F.filter(lines, lambda x: ~F.array_contains(F.col("__marks"), _mark(x)))
    missing = F.col(text_col).isNull()
    return (df.join(marks, host.eqNullSafe(F.col("__host")), "left")
            .withColumn("__kept", F.when(F.col("__marks").isNull(), lines).otherwise(kept))
            .withColumn("__n_lines", F.when(missing, 0).otherwise(F.size(lines)).cast("long"))
            .withColumn("__n_dropped", F.when(missing, 0).otherwise(F.size(lines) - F.size("__kept")).cast("long"))
            .withColumn(text_col, F.array_join("__kept", "\n"))
            .drop("__host", "__marks", "__kept"))


def dedup_lines(df: DataFrame, host: Column, text_col: str = "text", ratio: float = RATIO,
                min_pages: int = MIN_PAGES) -> DataFrame:
    """``df`` with boilerplate lines cut from ``text_col``, plus n_lines and
    n_dropped (long), which replace columns of these names.

    Lines are parted by line feeds and compared without blanks at their ends; a
    page counts once however often it repeats a line, and pages of equal text
    count once. Defined cases: lines without anything but blanks stay; a null
    text stays null with 0 lines and is no page; null hosts are one host; a page
    may become empty but no row is dropped; equal rows get equal results; an
    empty table gives no rows. Columns of any other name pass through.
    """
    return (cut_lines(df.drop("n_lines", "n_dropped"), host, text_col, ratio, min_pages)
            .withColumnsRenamed({"__n_lines": "n_lines", "__n_dropped": "n_dropped"}))
