"""The corpus pipeline over ``documents``.

Quality rules reject documents, line dedup cuts boilerplate lines, near-dedup
keeps one document of each group, mixing repeats and orders documents towards
the sources' target weights, and BPE encoding gives the token ids.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``docs``. ``run`` writes each stage's result under
the shared scratch folder and reads it back as the next one's documents, so a
lost executor costs work of one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, line_dedup, mixing, near_dup, quality
from tidemark.llm.common import read, stored
from tidemark.llm.queries import vocabulary
from tidemark.session import apply_conf

# BPE ids and the divergence verdict have no SQL form; tests hold run() against
# a brute-force version.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the divergence rules keep."""
    apply_conf(spark)
    return quality.judged(docs).where("__quality.kept").select(*[F.col(f"`{c}`") for c in docs.columns])


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that their source repeats too often;
    n_chars follows the text. The near copies that the next stage keeps one of
    are one page here, so that their common lines stay for it."""
    apply_conf(spark)
    out = line_dedup.cut_lines(docs, F.col("source"), groups=line_dedup.page_groups(docs))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(
        *[F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (5-word shingles, 0.8): the
    smallest doc_id, once; where no document of a group has an id, the one of the
    smallest text hash. Documents without words are no copies of each other, but
    repeated rows of one id and text are one document here too."""
    apply_conf(spark)
    found = near_dup.grouped(docs)
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "row")
    alone = F.when(F.col("component").isNull(), F.col("row"))  # without words: each id and text by itself
    kept = (found.groupBy("component", alone.alias("alone")).agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("n"))
            .select(F.col("first.row").alias("row"), (F.col("n") > 1).alias("repeated")))
    out = near_dup.rows_of(near_dup.marked(docs), stored(kept, "pipeline-kept"))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the curriculum takes it, in training order.
    Every row has its own positions, also where rows share an id or have none."""
    apply_conf(spark)
    return (mixing.placed_rows(docs).withColumn("__position", F.explode("__positions"))
            .orderBy("__position", "doc_id", "__tie").select(*[F.col(f"`{c}`") for c in docs.columns]))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) of every document."""
    apply_conf(spark)
    return bpe.encode_decode(docs, vocabulary("word_bpe_49k.json")).select(
        F.col("row_id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", dedup_lines),
    ("near_dedup", near_duplicates),
    ("mix_sources", mix_sources),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
