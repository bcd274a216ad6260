"""Secret scans with an incremental blob ledger.

Every version of every path is content-addressed: its blob is the SHA-256 of
its text. The ledger holds the findings of (blob, rules version) pairs. A scan
takes only the pairs that the ledger does not hold, each distinct blob once
however many paths or versions have it, and appends its findings; findings are
then joined back to all paths by blob. Scanning the same corpus again reads no
text beyond its hashes, and a new rules version scans every blob once more.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.session import scratch_path

# The base kinds.
ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")   # runs below 20 characters fail
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_VALUE = 6

#: Rules that this scanner adds to the base kinds: key blocks, signed tokens,
#: and keys with the fixed prefixes of their services.
ADDED = {
    "keyblock": re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    "jwt": re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    "prefixed": re.compile(r"(?:ghp_[A-Za-z0-9]{36,}|xox[abpr]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,})"),
}
KINDS = ("assign", "access", "hex", *ADDED)
RULES_VERSION = "1"

FINDINGS = "array<struct<kind:string,start:long,stop:long>>"
LEDGER = f"blob binary, rules string, findings {FINDINGS}"


def find_secrets(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start, then kind as listed."""
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= ASSIGN_VALUE]
    for kind, rule in (("access", ACCESS), ("hex", HEX), *ADDED.items()):
        found += [(kind, m.start(), m.end()) for m in rule.finditer(text)]
    return sorted(found, key=lambda f: (f[1], KINDS.index(f[0])))


def _scan_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())])
    for batch in batches:
        found = [find_secrets(t.as_py()) for t in batch.column(1)]
        flat = [f for fs in found for f in fs]
        values = pa.StructArray.from_arrays(
            [pa.array([f[k] for f in flat], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64()))],
            fields=list(kind))
        offsets = pa.array([0, *accumulate(len(f) for f in found)], pa.int32())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, values)],
                                         names=["blob", "findings"])


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger at a shared path; empty where none has been written. Entries
    of a scan that was cut short were never committed and are not seen."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.read.schema(LEDGER).parquet(path)
    return spark.createDataFrame([], LEDGER)


def scan(versions: DataFrame, ledger_path: str, path_col: str = "path", text_col: str = "text",
         rules: str = RULES_VERSION) -> DataFrame:
    """(path, blob, findings) for every row of ``versions``; the ledger at
    ``ledger_path`` grows by the blobs that it lacked.

    ``versions`` has one row for every path and historical version. Defined
    cases: a null text counts as empty; equal texts share a blob, equal rows
    come back as often as they come; a null path is kept; an empty table gives
    no rows. Other columns are not read.
    """
    rows = versions.select(F.col(path_col).alias("path"),
                           F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    blob = F.unhex(F.sha2("text", 256)).alias("blob")
    held = stored(rows.select("path", blob), "blob-paths")
    known = read_ledger(versions.sparkSession, ledger_path).where(F.col("rules") == rules)
    # one path stands for each unseen blob: its text is the one to read
    unseen = (held.groupBy("blob").agg(F.min("path").alias("path"))
              .join(known.select("blob"), "blob", "left_anti"))
    texts = rows.withColumn("blob", F.unhex(F.sha2("text", 256)))
    named = texts.where("path is not null").join(
        unseen.where("path is not null").hint("shuffle_hash"), ["path", "blob"], "left_semi").select("blob", "text")
    nameless = texts.where("path is null").join(unseen.where("path is null").select("blob"), "blob", "left_semi")
    fresh = named.unionByName(nameless.select("blob", "text")).mapInArrow(_scan_task, f"blob binary, findings {FINDINGS}")
    (fresh.select("blob", F.lit(rules).alias("rules"), "findings")
     .write.mode("append").parquet(ledger_path))
    ledger = read_ledger(versions.sparkSession, ledger_path).where(F.col("rules") == rules)
    return held.join(ledger.dropDuplicates(["blob"]).select("blob", "findings"), "blob", "left").select(
        "path", "blob", "findings")


def new_ledger_path(spark: SparkSession) -> str:
    """A fresh ledger in the shared scratch folder."""
    return scratch_path(spark, "blob-ledger")
