"""Landed API payloads.

Fetching over the network is not part of the library; jobs start from a
directory of landed JSON files, one payload per file, read by one distributed
scan (no driver loop over keys). The key of each payload (ticker, series id)
comes from the file name stem unless given in the payload.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.expr import (
    days_before,
    lenient_double,
    nan_to_null,
    strict_date,
    strict_double,
    strict_long,
)
from tidemark.schemas import CRYPTO_PAYLOAD_COLUMNS, RAW_CRYPTO

# The public field names of the daily time-series payload.
DAILY_SERIES_ROOT = "Time Series (Daily)"
DAILY_FIELDS = {
    "open": "1. open",
    "high": "2. high",
    "low": "3. low",
    "close": "4. close",
    "volume": "5. volume",
}


def _file_stem() -> Column:
    return F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.[^.]*)?$", 1)


def _landed() -> Column:
    """Order of landing: the file's time, then its name."""
    return F.struct(F.col("_metadata.file_modification_time").alias("at"), F.col("_metadata.file_name").alias("file"))


def _json(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True) -> DataFrame:
    """A JSON scan that fails on broken text and on values of another type."""
    return spark.read.schema(schema).option("multiLine", multi_line).option("mode", "FAILFAST").json(path)


def _required(value: Column, what: str, key: Column) -> Column:
    """``value``; the job fails where it is missing."""
    return F.when(value.isNull(), F.raise_error(F.concat(F.lit(f"no {what} for "), key))).otherwise(value)


def read_timeseries_payload(spark: SparkSession, path: str, root: str = DAILY_SERIES_ROOT,
                            fields: Mapping[str, str] = DAILY_FIELDS, key_col: str = "symbol",
                            date_col: str = "trade_date", integral: Sequence[str] = ("volume",),
                            key_field: tuple[str, str] | None = None,
                            landed_col: str | None = None, multi_line: bool = True) -> DataFrame:
    """``{root: {date: {field: "text"}}}`` per file.

    Each date entry becomes a row; values parse strictly (bad or missing text
    fails the job) and a payload that is broken or has no ``root`` fails the
    job, as the reference raises. The key is the file name stem, or with
    ``key_field=(object, field)`` the text at that place in the payload (the
    file stem when it is absent). ``landed_col`` adds a column that orders rows
    by their file's time and name, for loads where the last file wins.
    ``multi_line=False`` reads one payload a line instead of one a file.
    """
    inner = T.MapType(T.StringType(), T.StringType())
    fields_ = [T.StructField(root, T.MapType(T.StringType(), inner))]
    if key_field:
        fields_.append(T.StructField(key_field[0], T.MapType(T.StringType(), T.StringType())))
    key = _file_stem()
    if key_field:
        key = F.coalesce(F.col(f"`{key_field[0]}`").getItem(key_field[1]), key)
    landed = [_landed().alias(landed_col)] if landed_col else []
    series = _required(F.col(f"`{root}`"), f"'{root}' in payload", key)
    raw = _json(spark, path, T.StructType(fields_), multi_line).select(series.alias("series"), key.alias(key_col), *landed)
    rows = raw.select(key_col, *[c for c in (landed_col,) if c], F.explode("series").alias("d", "v"))
    out = [F.col(key_col), strict_date(F.col("d")).alias(date_col)]
    for name, field in fields.items():
        conv = strict_long if name in integral else strict_double
        out.append(conv(_required(F.col("v").getItem(field), f"'{field}'", F.col(key_col)), name).alias(name))
    return rows.select(*out, *[c for c in (landed_col,) if c])


def _missing(spark: SparkSession, path: str, columns: Sequence[str], multi_line: bool) -> list[str]:
    """Those of ``columns`` that no record has.

    Reading stops at the first record that has all of them, as API records do;
    only where there is none are the names of all records collected, at most
    one row a column. Text that is not JSON has no names here and fails the
    read itself.
    """
    text = spark.read.text(path, wholetext=multi_line)
    wanted = [c for c in columns if c not in text.columns or c == "value"]
    record = T.MapType(T.StringType(), T.StringType())
    records = F.explode(F.from_json("value", T.ArrayType(record))) if multi_line else F.from_json("value", record)
    names = text.select(records.alias("record")).select(F.map_keys("record").alias("names"))
    if not names.where(F.size(F.array_except(F.array(*[F.lit(c) for c in wanted]), "names")) == 0).isEmpty():
        return []
    seen = names.select(F.explode("names").alias("name")).where(F.col("name").isin(wanted)).distinct().collect()
    return [c for c in wanted if c not in {r["name"] for r in seen}]


def read_records_payload(spark: SparkSession, path: str,
                         columns: Sequence[str] = CRYPTO_PAYLOAD_COLUMNS,
                         schema: T.StructType = RAW_CRYPTO,
                         json_cols: Sequence[str] = ("roi",), multi_line: bool = True) -> DataFrame:
    """A JSON array of flat records per file.

    Only ``columns`` are kept (extra payload fields are ignored); a column that
    no record has fails the read, as does a value of another type. ``json_cols``
    hold nested objects: they are kept as the JSON text that landed, numbers as
    numbers, and a missing or null object becomes the text ``null`` (G8). Doubles have NaN turned to NULL.
    Timestamps are read as text and parsed without any zone shift.

    ``multi_line=True`` reads API-style files (one JSON array per file, each
    file parsed by one task); ``False`` reads JSON Lines (one record per
    line), which Spark splits across tasks however large a file is.
    """
    read_fields = []
    for c in columns:
        f = schema[c]
        if c in json_cols:
            read_fields.append(T.StructField(c, T.StringType()))
        elif isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)):
            read_fields.append(T.StructField(c, T.StringType()))
        else:
            read_fields.append(f)
    missing = _missing(spark, path, columns, multi_line)
    if missing:
        raise ValueError(f"no record has {missing}")
    raw = _json(spark, path, T.StructType(read_fields), multi_line)
    out = []
    for c in columns:
        f = schema[c]
        if c in json_cols:
            out.append(F.coalesce(F.col(c), F.lit("null")).alias(c))
        elif isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)):
            ts = F.regexp_replace(F.col(c), "Z$", "")
            out.append(ts.cast(T.TimestampNTZType()).alias(c))
        elif isinstance(f.dataType, T.DoubleType):
            out.append(nan_to_null(c).alias(c))
        else:
            out.append(F.col(c).cast(f.dataType).alias(c))
    return raw.select(*out)


def read_observations_payload(spark: SparkSession, path: str,
                              names: Mapping[str, str] | None = None,
                              since_days: int | None = None, as_of=None,
                              landed_col: str | None = None, key_field: str | None = None,
                              multi_line: bool = True) -> DataFrame:
    """``{"observations": [{"date", "value"}]}`` per file.

    The series id is the file stem, or with ``key_field`` the text of that field
    (the file stem when it is absent); ``names`` gives the series name. A payload
    that is broken or has no observations list fails the job. Unparsable values ('.') become NULL and the row is dropped; with
    ``since_days`` only observations from ``as_of - since_days`` on are kept.
    """
    obs = T.StructType([T.StructField("date", T.StringType()), T.StructField("value", T.StringType())])
    schema = T.StructType([T.StructField("observations", T.ArrayType(obs))])
    key = _file_stem()
    if key_field:
        schema = schema.add(key_field, T.StringType())
        key = F.coalesce(F.col(f"`{key_field}`"), key)
    landed = [c for c in (landed_col,) if c]
    found = _required(F.col("observations"), "observations in payload", key)
    raw = _json(spark, path, schema, multi_line).select(key.alias("series_id"), found.alias("found"),
                                                        *[_landed().alias(c) for c in landed])
    raw = raw.select("series_id", F.explode("found").alias("o"), *landed)
    name_col = F.lit(None).cast("string")
    if names:
        m = F.create_map(*[x for k, v in names.items() for x in (F.lit(k), F.lit(v))])
        name_col = m[F.col("series_id")]
    df = raw.select("series_id", name_col.alias("series_name"),
                    strict_date(F.col("o.date")).alias("observation_date"),
                    lenient_double(F.col("o.value")).alias("value"), *landed)
    df = df.dropna(subset=["value"])
    if since_days is not None:
        df = df.where(F.col("observation_date") >= days_before(as_of, since_days))
    return df
