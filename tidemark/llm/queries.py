"""Registered queries of this package: one for each operator, over whole tables.

A query applies its operator with production parameters and derives the digest
columns of its contract from the operator's output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    alignment, bpe, chat_format, fim, language_id, line_dedup, mixing, near_dup, packing, quality, secret_scan,
    token_counts, topk,
)
from tidemark.llm.common import read


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file on the driver."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the three quarters that are not
    held out."""
    docs = read(spark, sf_dir, "documents")
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))
    model = language_id.fit(language_id.training_sample(docs.where(~held_out), "text", "lang", "doc_id"))
    return language_id.identify(docs, model, "text", F.col("doc_id"), held_out.alias("held_out"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boilerplate lines cut from every document; the source is its host."""
    out = line_dedup.dedup_lines(read(spark, sf_dir, "documents"), F.col("source"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document before and after three edits made from
    its own columns: some characters in the middle give way to the source, the
    language is put in front, and the end is cut off."""
    import public_tokenizers

    ranks = vocabulary("byte_bpe_50k.tiktoken")
    n = F.length(F.coalesce("text", F.lit("")))
    middle = F.floor(n / 2).cast("int")
    edits = token_counts.edits_of(
        (middle, middle + 20, F.concat(F.lit(" ["), F.coalesce("source", F.lit("")), F.lit("]'"))),
        (0, 0, F.concat(F.upper(F.coalesce("lang", F.lit(""))), F.lit(": "))),
        (n - 25, n + 100, F.lit("")))
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", edits.alias("edits"))
    trees = token_counts.build(docs, ranks, public_tokenizers.PATTERN).withColumn("n_tokens_before", F.col("n_tokens"))
    out = token_counts.apply_edits(trees, ranks, public_tokenizers.PATTERN)
    return out.select("doc_id", "n_tokens_before", F.col("n_tokens").alias("n_tokens_after"),
                      F.floor(F.length("tree_lengths") / 4).alias("n_pretokens"), "n_encoded",
                      F.sha2("text", 256).alias("text_sha256"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base figures and the divergence verdict of every document."""
    return quality.quality_rules(read(spark, sf_dir, "documents"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all documents, scanned into a new ledger."""
    docs = read(spark, sf_dir, "documents")
    out = secret_scan.scan(docs, secret_scan.new_ledger_path(spark), path_col="doc_id")

    def joined(findings):
        return F.array_join(F.transform(findings, lambda f: F.concat_ws(
            ":", f["kind"], f["start"].cast("string"), f["stop"].cast("string"))), ",")

    def count(kind: str):
        return F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("findings", lambda f: f["kind"].isin("assign", "access", "hex"))
    return out.select(F.col("path").alias("doc_id"), count("assign"), count("access"), count("hex"),
                      F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("findings")).alias("spans"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A preference pair of every conversation: chosen up to its last assistant
    turn; rejected breaks off half-way (by words) through that turn, or through
    the first one where the conversation's id is odd."""
    turns = chat_format.gather_turns(read(spark, sf_dir, "conversations"))
    spoken = F.transform("turns", lambda t: t["role"] == chat_format.ASSISTANT)
    first = F.array_position(spoken, F.lit(True)).cast("int")
    last = F.when(first > 0, F.size("turns") - F.array_position(F.reverse(spoken), F.lit(True)).cast("int") + 1).otherwise(0)
    cut = F.when(F.pmod(F.coalesce("conv_id", F.lit(0)), F.lit(2)) == 1, first).otherwise(last)
    words = F.split(F.get("turns", F.col("cut") - 1)["text"], " ", -1)
    half = F.array_join(F.slice(words, 1, F.floor((F.size(words) + 1) / 2).cast("int")), " ")
    pairs = (turns.withColumn("last", last).withColumn("cut", cut)
             .withColumn("chosen", F.when(F.col("last") > 0, F.slice("turns", 1, F.col("last"))).otherwise(F.col("turns")))
             .withColumn("rejected", F.when(F.col("last") > 0, F.concat(
                 F.slice("turns", 1, F.greatest(F.col("cut") - 1, F.lit(0))),
                 F.array(F.struct(F.lit(chat_format.ASSISTANT).alias("role"), half.alias("text")))))
                 .otherwise(F.col("turns"))))
    out = chat_format.format_preferences(pairs.select("conv_id", "chosen", "rejected"))

    def spans(column: str):
        return F.array_join(F.transform(column, lambda s: F.concat_ws(
            ":", s["start"].cast("string"), s["stop"].cast("string"))), ",").alias(column)

    return out.select("conv_id", "n_common", F.sha2("prompt", 256).alias("prompt_sha256"),
                      F.sha2("chosen", 256).alias("chosen_sha256"), F.sha2("rejected", 256).alias("rejected_sha256"),
                      spans("chosen_spans"), spans("rejected_spans"), "usable")


def op7_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents over 4-word shingles."""
    return near_dup.near_duplicates(read(spark, sf_dir, "documents"), shingle=4, percent=80)


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best other vectors of every vector whose id is divisible by 20."""
    return topk.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken from every document by the curriculum, in training order of
    the first copy; documents that are not taken come last."""
    out = mixing.assign_positions(read(spark, sf_dir, "documents"))
    first = F.when(F.col("copies") > 0, F.element_at("positions", 1))
    return (out.select("doc_id", "size", "source_size", "target", "taken", first.alias("first_position"))
            .orderBy(F.col("first_position").asc_nulls_last(), "doc_id"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    return bpe.encode_decode(read(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json")).select(
        F.col("row_id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form, cuts and digests of every document's rearrangement and restoration."""
    return fim.fill_in_middle_digests(read(spark, sf_dir, "documents"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every piece of all documents in sequences of 1,024 tokens."""
    packed = packing.pack(read(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token groups and links of two tokenizers for every document."""
    docs = read(spark, sf_dir, "documents")
    return alignment.align(docs, vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")).documents


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_line_dedup": op2_line_dedup,
    "op3_token_counts": op3_token_counts,
    "op4_quality": op4_quality,
    "op5_secrets": op5_secrets,
    "op6_chat_format": op6_chat_format,
    "op7_near_dup": op7_near_dup,
    "op8_topk": op8_topk,
    "op9_mixing": op9_mixing,
    "op10_bpe": op10_bpe,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_packing": op12_packing,
    "op13_alignment": op13_alignment,
}

BLANKS = "' ' || chr(9) || chr(13) || chr(11) || chr(12)"

ORACLE_SQL: dict[str, str] = {
    "op2_line_dedup": f"""
WITH lines AS (
  SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line,
         unnest(generate_series(1, len(string_split(text, chr(10))))) AS place
  FROM documents WHERE text IS NOT NULL),
marked AS (SELECT doc_id, source, text, place, line, trim(line, {BLANKS}) AS mark FROM lines),
often AS (
  SELECT n.source, n.mark
  FROM (SELECT source, mark, count(DISTINCT text) AS n FROM marked WHERE mark <> '' GROUP BY source, mark) n
  JOIN (SELECT source, count(DISTINCT text) AS pages FROM documents GROUP BY source) p ON n.source IS NOT DISTINCT FROM p.source
  WHERE n.n >= {line_dedup.MIN_PAGES} AND n.n > {line_dedup.RATIO}::DOUBLE * p.pages),
kept AS (
  SELECT m.doc_id, count(*) AS n_lines, count(o.mark) AS n_dropped,
         coalesce(string_agg(m.line, chr(10) ORDER BY m.place) FILTER (WHERE o.mark IS NULL), '') AS text
  FROM marked m LEFT JOIN often o ON m.source IS NOT DISTINCT FROM o.source AND m.mark = o.mark
  GROUP BY m.doc_id)
SELECT d.doc_id, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_dropped, 0) AS n_dropped,
       sha256(coalesce(k.text, '')) AS text_sha256
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id""",
    "op6_chat_format": """
WITH t AS (
  SELECT key, conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY key ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
  FROM (SELECT *, coalesce(CAST(conv_id AS VARCHAR), 'row ' || row_number() OVER ()) AS key FROM conversations)),
c AS (
  SELECT key, count(*) AS n, coalesce(max(place) FILTER (WHERE role = 'assistant'), 0) AS last,
         CASE WHEN abs(coalesce(conv_id, 0)) % 2 = 1 THEN coalesce(min(place) FILTER (WHERE role = 'assistant'), 0)
              ELSE coalesce(max(place) FILTER (WHERE role = 'assistant'), 0) END AS cut
  FROM t GROUP BY key, conv_id),
halves AS (
  SELECT t.key, t.conv_id, t.place, t.role,
         array_to_string(list_slice(string_split(t.text, ' '), 1, (len(string_split(t.text, ' ')) + 1) // 2), ' ') AS text
  FROM t JOIN c ON t.key = c.key AND t.place = c.cut),
sides AS (
  SELECT 'c' AS side, t.key, t.conv_id, t.place, t.role, t.text FROM t JOIN c ON t.key = c.key
  WHERE c.last = 0 OR t.place <= c.last
  UNION ALL
  SELECT 'r', t.key, t.conv_id, t.place, t.role, t.text FROM t JOIN c ON t.key = c.key
  WHERE c.last = 0 OR t.place < c.cut
  UNION ALL SELECT 'r', key, conv_id, place, role, text FROM halves),
common AS (
  SELECT x.key, coalesce(min(x.place) FILTER (WHERE y.place IS NULL OR x.role <> y.role OR x.text <> y.text),
                             max(x.place) + 1) - 1 AS n_common
  FROM sides x LEFT JOIN sides y ON y.side = 'r' AND x.key = y.key AND x.place = y.place
  WHERE x.side = 'c' GROUP BY x.key),
shown AS (
  SELECT s.*, k.n_common, '<|' || s.role || '|>' || chr(10) AS head, chr(10) || '<|end|>' || chr(10) AS tail
  FROM sides s JOIN common k ON s.key = k.key),
placed AS (
  SELECT *, coalesce(sum(length(head) + length(text) + length(tail)) OVER (
           PARTITION BY side, key, place > n_common ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begun
  FROM shown),
rendered AS (
  SELECT conv_id, n_common,
         string_agg(head || text || tail, '' ORDER BY place) FILTER (WHERE side = 'c' AND place <= n_common) AS prompt,
         string_agg(head || text || tail, '' ORDER BY place) FILTER (WHERE side = 'c' AND place > n_common) AS chosen,
         string_agg(head || text || tail, '' ORDER BY place) FILTER (WHERE side = 'r' AND place > n_common) AS rejected,
         string_agg((begun + length(head)) || ':' || (begun + length(head) + length(text) + length(tail)), ',' ORDER BY place)
           FILTER (WHERE side = 'c' AND place > n_common AND role = 'assistant') AS chosen_spans,
         string_agg((begun + length(head)) || ':' || (begun + length(head) + length(text) + length(tail)), ',' ORDER BY place)
           FILTER (WHERE side = 'r' AND place > n_common AND role = 'assistant') AS rejected_spans
  FROM placed GROUP BY key, conv_id, n_common)
SELECT conv_id, CAST(n_common AS INTEGER) AS n_common, sha256(coalesce(prompt, '')) AS prompt_sha256,
       sha256(coalesce(chosen, '')) AS chosen_sha256, sha256(coalesce(rejected, '')) AS rejected_sha256,
       coalesce(chosen_spans, '') AS chosen_spans, coalesce(rejected_spans, '') AS rejected_spans,
       chosen_spans IS NOT NULL AND rejected_spans IS NOT NULL AS usable
FROM rendered""",
    "op8_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 20""",
    "op9_mixing": r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(md5(CAST(doc_id AS VARCHAR)), '') AS mark,
         CAST(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[ 	-
]+'), lambda x: x <> '')) AS BIGINT) AS size
  FROM documents),
sums AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS turn
  FROM sized GROUP BY source),
weighed AS (
  SELECT source, source_size, [6.0::DOUBLE, 2.0, 0.5][turn + 1] AS ramp_start, [4.0::DOUBLE, 2.0, 1.5][turn + 1] AS ramp_end,
         [5.0::DOUBLE, 2.0, 1.0][turn + 1] AS weight, 2.0::DOUBLE * source_size AS cap,
         1.5::DOUBLE * CAST(sum(source_size) OVER () AS DOUBLE) AS budget
  FROM sums),
levels AS (
  SELECT *, row_number() OVER o AS place,
         (budget - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed WINDOW o AS (ORDER BY cap / weight, source NULLS LAST)),
found AS (SELECT arg_min(level, place) AS level FROM levels WHERE level * weight <= cap),
targets AS (
  SELECT l.source, l.source_size, l.ramp_start, l.ramp_end,
         coalesce(least(l.cap, f.level * l.weight), l.cap) AS target
  FROM levels l CROSS JOIN found f),
placed AS (
  SELECT s.*, t.source_size, t.target, t.ramp_start, t.ramp_end,
         CAST(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.mark, s.doc_id, s.size
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - s.size AS DOUBLE) + s.size / 2.0::DOUBLE AS middle
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
shares AS (
  SELECT *, CASE WHEN size > 0 AND middle < target
                 THEN middle / target * ((ramp_start + ramp_end) / 2) END AS share
  FROM placed)
SELECT doc_id, size, source_size, target,
       CASE WHEN share IS NULL THEN 0 WHEN middle + source_size < target THEN 2 * size ELSE size END AS taken,
       share * 2 / (ramp_start + sqrt(ramp_start * ramp_start + (ramp_end - ramp_start) / 2 * 4 * share)) AS first_position
FROM shares""",
}
