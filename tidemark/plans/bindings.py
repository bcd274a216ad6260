"""Bind the driver's tables to the raw market tables.

The test data has no market feeds, so each raw table is derived from a
driver table with the same grain and the same schema as the reference's raw
tables; the market tables then run on them unchanged. Work grows with the
driver tables: every binding reads its whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.expr import label_map

AS_OF = "2024-02-01 00:00:00"

# Fixed values (binding choice): order priority -> macro series id and name.
PRIORITY_SERIES = {
    "1-URGENT": "FEDFUNDS",
    "2-HIGH": "CPIAUCSL",
    "3-MEDIUM": "UNRATE",
    "4-NOT SPECIFIED": "DGS10",
    "5-LOW": "DEXUSEU",
}
# The macro series names of the reference's load.
SERIES_NAMES = {
    "FEDFUNDS": "Fed Funds Rate",
    "CPIAUCSL": "CPI",
    "UNRATE": "Unemployment Rate",
    "DGS10": "10-Year Treasury",
    "DEXUSEU": "USD/EUR Exchange Rate",
}
MACRO_SCALE = 100000.0
MACRO_LOADED_AT = "2024-01-25 12:00:00"
CRYPTO_LOADED_AT = "2024-01-31 06:00:00"
CRYPTO_CAP_FACTOR = 2000000


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The driver table as a lazy DataFrame."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_equity(events: DataFrame) -> DataFrame:
    """Daily OHLCV per user: open/close = first/last value of the day by
    time, high/low = max/min, volume = event count, loaded_at = last event.
    A partial + final hash aggregate keyed by (user, day)."""
    d = F.col("ts").cast("date")
    return (events.groupBy("user_id", d.alias("trade_date"))
            .agg(F.min_by("value", "ts").alias("open"), F.max("value").alias("high"),
                 F.min("value").alias("low"), F.max_by("value", "ts").alias("close"),
                 F.count(F.lit(1)).alias("volume"), F.max("ts").alias("loaded_at"))
            .select(F.concat(F.lit("EQ"), F.col("user_id").cast("string")).alias("symbol"),
                    "trade_date", "open", "high", "low", "close", "volume", "loaded_at"))


def raw_crypto(customer: DataFrame, loaded_at: str = CRYPTO_LOADED_AT) -> DataFrame:
    """Crypto market snapshot per customer: price = balance, market cap =
    balance x 2,000,000 (covers all four tiers and negatives); the coin's
    last update falls on one of 30 days at 23:59:59. One SQL projection."""
    return customer.selectExpr(
        "concat('cust-', CAST(c_custkey AS STRING)) AS id",
        "concat('c', CAST(c_custkey AS STRING)) AS symbol",
        "c_name AS name",
        "CAST(NULL AS STRING) AS image",
        "c_acctbal AS current_price",
        f"c_acctbal * {CRYPTO_CAP_FACTOR} AS market_cap",
        "CAST(c_custkey AS INT) AS market_cap_rank",
        "CAST(NULL AS DOUBLE) AS fully_diluted_valuation",
        "abs(c_acctbal) * 1000 AS total_volume",
        "c_acctbal + 1 AS high_24h",
        "c_acctbal - 1 AS low_24h",
        "CAST(NULL AS DOUBLE) AS price_change_24h",
        "CAST(c_nationkey - 12 AS DOUBLE) / 4 AS price_change_percentage_24h",
        "CAST(NULL AS DOUBLE) AS market_cap_change_24h",
        "CAST(NULL AS DOUBLE) AS market_cap_change_percentage_24h",
        "CAST(c_custkey AS DOUBLE) * 1000 AS circulating_supply",
        "CAST(c_custkey AS DOUBLE) * 1000 AS total_supply",
        "CAST(NULL AS DOUBLE) AS max_supply",
        "c_acctbal * 1.5D AS ath",
        "CAST(NULL AS DOUBLE) AS ath_change_percentage",
        "TIMESTAMP_NTZ '2021-11-10 14:24:11' AS ath_date",
        "CAST(NULL AS DOUBLE) AS atl",
        "CAST(NULL AS DOUBLE) AS atl_change_percentage",
        "CAST(NULL AS TIMESTAMP_NTZ) AS atl_date",
        "'null' AS roi",
        "TIMESTAMP_NTZ '2024-01-01 23:59:59' + make_dt_interval(CAST(c_custkey % 30 AS INT)) AS last_updated",
        f"TIMESTAMP_NTZ '{loaded_at}' AS loaded_at",
    )


def raw_macro(orders: DataFrame) -> DataFrame:
    """Macro series: one per order priority, value = max price of the day /
    100,000; a series has no value on days without an order of its priority."""
    sid = label_map("o_orderpriority", PRIORITY_SERIES, None)
    return (orders.groupBy(sid.alias("series_id"), F.col("o_orderdate").cast("date").alias("observation_date"))
            .agg(F.max("o_totalprice").alias("mx"))
            .select("series_id",
                    label_map("series_id", SERIES_NAMES, None).alias("series_name"),
                    "observation_date",
                    (F.col("mx") / F.lit(MACRO_SCALE)).alias("value"),
                    F.lit(MACRO_LOADED_AT).cast("timestamp_ntz").alias("loaded_at")))


def seed_equity(nation: DataFrame, region: DataFrame) -> DataFrame:
    """Equity reference seed: ticker per nation key, company = nation name,
    sector = region name (25 rows; most equity tickers have no seed row)."""
    return (nation.join(region, nation.n_regionkey == region.r_regionkey, "inner")
            .select(F.concat(F.lit("EQ"), F.col("n_nationkey").cast("string")).alias("ticker_symbol"),
                    F.col("n_name").alias("company_name"), F.col("r_name").alias("sector")))


# ------------------------------------------------------------------- SQL twins
# The same bindings for the DuckDB oracle (one CTE each).

def _case(col: str, mapping: dict[str, str]) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {col} {whens} END"


SQL_RAW_EQUITY = """raw_equity AS (
  SELECT 'EQ' || CAST(user_id AS VARCHAR) AS symbol, CAST(ts AS DATE) AS trade_date,
         arg_min(value, ts) AS open, max(value) AS high, min(value) AS low,
         arg_max(value, ts) AS close, count(*) AS volume, max(ts) AS loaded_at
  FROM events GROUP BY user_id, CAST(ts AS DATE))"""

SQL_RAW_CRYPTO_FROM = """SELECT
    'cust-' || CAST(c_custkey AS VARCHAR) AS id, 'c' || CAST(c_custkey AS VARCHAR) AS symbol,
    c_name AS name, CAST(NULL AS VARCHAR) AS image, c_acctbal AS current_price,
    c_acctbal * 2000000 AS market_cap, CAST(c_custkey AS INTEGER) AS market_cap_rank,
    CAST(NULL AS DOUBLE) AS fully_diluted_valuation, abs(c_acctbal) * 1000 AS total_volume,
    c_acctbal + 1 AS high_24h, c_acctbal - 1 AS low_24h, CAST(NULL AS DOUBLE) AS price_change_24h,
    CAST(c_nationkey - 12 AS DOUBLE) / 4 AS price_change_percentage_24h,
    CAST(NULL AS DOUBLE) AS market_cap_change_24h, CAST(NULL AS DOUBLE) AS market_cap_change_percentage_24h,
    CAST(c_custkey AS DOUBLE) * 1000 AS circulating_supply, CAST(c_custkey AS DOUBLE) * 1000 AS total_supply,
    CAST(NULL AS DOUBLE) AS max_supply, c_acctbal * 1.5 AS ath, CAST(NULL AS DOUBLE) AS ath_change_percentage,
    TIMESTAMP '2021-11-10 14:24:11' AS ath_date, CAST(NULL AS DOUBLE) AS atl,
    CAST(NULL AS DOUBLE) AS atl_change_percentage, CAST(NULL AS TIMESTAMP) AS atl_date, 'null' AS roi,
    TIMESTAMP '2024-01-01 23:59:59' + to_days(CAST(c_custkey % 30 AS INTEGER)) AS last_updated,
    TIMESTAMP '{loaded_at}' AS loaded_at
  FROM {source}"""

SQL_RAW_CRYPTO = ("raw_crypto AS (" + SQL_RAW_CRYPTO_FROM.format(
    loaded_at=CRYPTO_LOADED_AT, source="customer") + ")")

SQL_RAW_MACRO = f"""raw_macro AS (
  SELECT series_id, {_case('series_id', SERIES_NAMES)} AS series_name, observation_date,
         mx / {MACRO_SCALE} AS value, TIMESTAMP '{MACRO_LOADED_AT}' AS loaded_at
  FROM (SELECT {_case('o_orderpriority', PRIORITY_SERIES)} AS series_id,
               CAST(o_orderdate AS DATE) AS observation_date, max(o_totalprice) AS mx
        FROM orders GROUP BY 1, 2))"""

SQL_SEED = """seed AS (
  SELECT 'EQ' || CAST(n_nationkey AS VARCHAR) AS ticker_symbol, n_name AS company_name,
         r_name AS sector
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""
