"""The market tables, composed from the operators.

Each function takes DataFrames and returns a lazy DataFrame; nothing is
materialized here (staging models are views, intermediates are inlined).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.expr import (
    calendar_parts,
    label_map,
    safe_pct_change,
    surrogate_key,
    tier,
)
from tidemark.operators.asof import asof_join
from tidemark.operators.relational import conform_union, enrich, select_renamed
from tidemark.operators.timeseries import forward_fill, pivot_wide, rank_by_value, rolling_std, time_bucket
from tidemark.schemas import DIM_ASSETS, PRICES_COMBINED

# Macro series id -> category label (X11), default 'other'.
INDICATOR_CATEGORIES = {
    "FEDFUNDS": "interest_rate",
    "CPIAUCSL": "inflation",
    "UNRATE": "employment",
    "DGS10": "interest_rate",
    "DEXUSEU": "fx_rate",
}
INDICATOR_CATEGORY_DEFAULT = "other"

# Macro series id -> column of the daily wide table (A1).
INDICATOR_COLUMNS = {
    "FEDFUNDS": "fed_funds_rate",
    "CPIAUCSL": "cpi",
    "UNRATE": "unemployment_rate",
    "DGS10": "treasury_10y_yield",
    "DEXUSEU": "usd_eur_rate",
}

# Market-cap tier lower bounds in USD, inclusive, first match
# wins; anything else (including NULL) is 'micro_cap' (X10, G6).
MARKET_CAP_TIERS = [
    (10_000_000_000, "large_cap"),
    (1_000_000_000, "mid_cap"),
    (100_000_000, "small_cap"),
]
MARKET_CAP_TIER_DEFAULT = "micro_cap"

# Rolling volatility windows, in rows.
VOLATILITY_WINDOWS = {"volatility_7d": 7, "volatility_30d": 30, "volatility_90d": 90}

# Inclusive plausible ranges of the macro indicators (Q7).
INDICATOR_RANGES = {
    "fed_funds_rate": (0, 20),
    "cpi": (0, 500),
    "unemployment_rate": (0, 30),
    "treasury_10y_yield": (0, 20),
    "usd_eur_rate": (0.5, 2),
}


# ----------------------------------------------------------------- staging
# The output column names of the staging, intermediate and
# mart tables below are the data model users query, so they equal the
# reference's names (FIXTURES.md §3); the maps pair them with raw columns.


def stg_equity_prices(raw: DataFrame) -> DataFrame:
    """M1: rename + derived metrics of daily OHLCV."""
    return select_renamed(raw, {
        "ticker_symbol": "symbol",
        "trade_date": "trade_date",
        "open_usd": "open",
        "high_usd": "high",
        "low_usd": "low",
        "close_usd": "close",
        "shares_traded": "volume",
        "price_change_usd": F.col("close") - F.col("open"),
        "price_change_pct": safe_pct_change("open", "close", 4),
        "intraday_range_usd": F.col("high") - F.col("low"),
        "loaded_at": "loaded_at",
    })


def stg_crypto_prices(raw: DataFrame) -> DataFrame:
    """M2: rename of the crypto market snapshot; ``image`` and ``roi`` dropped."""
    return select_renamed(raw, {
        "coin_id": "id",
        "coin_symbol": "symbol",
        "coin_symbol_upper": F.upper(F.col("symbol")),
        "coin_name": "name",
        "market_cap_rank": "market_cap_rank",
        "price_usd": "current_price",
        "high_usd_24h": "high_24h",
        "low_usd_24h": "low_24h",
        "price_change_usd_24h": "price_change_24h",
        "price_change_pct_24h": "price_change_percentage_24h",
        "market_cap_usd": "market_cap",
        "fully_diluted_valuation_usd": "fully_diluted_valuation",
        "market_cap_change_usd_24h": "market_cap_change_24h",
        "market_cap_change_pct_24h": "market_cap_change_percentage_24h",
        "circulating_supply": "circulating_supply",
        "total_supply": "total_supply",
        "max_supply": "max_supply",
        "all_time_high_usd": "ath",
        "pct_below_ath": "ath_change_percentage",
        "all_time_high_date": "ath_date",
        "all_time_low_usd": "atl",
        "pct_above_atl": "atl_change_percentage",
        "all_time_low_date": "atl_date",
        "volume_usd_24h": "total_volume",
        "price_updated_at": "last_updated",
        "loaded_at": "loaded_at",
    })


def stg_macro_indicators(raw: DataFrame,
                         categories: Mapping[str, str] = INDICATOR_CATEGORIES) -> DataFrame:
    """M3: rename + category label of macro observations."""
    return select_renamed(raw, {
        "indicator_id": "series_id",
        "indicator_name": "series_name",
        "indicator_category": label_map("series_id", categories, INDICATOR_CATEGORY_DEFAULT),
        "observation_date": "observation_date",
        "indicator_value": "value",
        "loaded_at": "loaded_at",
    })


# ----------------------------------------------------------------- intermediate


def int_prices_combined(stg_crypto: DataFrame, stg_equity: DataFrame) -> DataFrame:
    """M4: conformed union of crypto and equity prices."""
    crypto = stg_crypto.select(
        F.col("coin_id").alias("asset_id"), F.col("coin_symbol").alias("asset_symbol"),
        F.col("coin_name").alias("asset_name"), F.lit("crypto").alias("asset_class"),
        F.col("price_updated_at").cast("date").alias("price_date"),
        F.col("price_usd"), F.col("volume_usd_24h").alias("volume_usd"),
        F.col("market_cap_usd"), F.col("price_change_pct_24h").alias("price_change_pct"))
    equity = stg_equity.select(
        F.col("ticker_symbol").alias("asset_id"), F.col("ticker_symbol").alias("asset_symbol"),
        F.col("ticker_symbol").alias("asset_name"), F.lit("equity").alias("asset_class"),
        F.col("trade_date").alias("price_date"), F.col("close_usd").alias("price_usd"),
        F.col("price_change_pct"))
    return conform_union([crypto, equity], PRICES_COMBINED)


def int_macro_daily(stg_macro: DataFrame, columns: Mapping[str, str] = INDICATOR_COLUMNS,
                    bucket: Column | None = None) -> DataFrame:
    """M5: pivot the five series to one row per observation date, then carry
    each value forward over dates without a release (by month, or ``bucket``)."""
    seen = {k: f"seen_{v}" for k, v in columns.items()}
    wide = pivot_wide(stg_macro, ["observation_date"], "indicator_id", "indicator_value", seen)
    bucket = time_bucket(wide, "observation_date") if bucket is None else bucket
    filled = forward_fill(wide, "observation_date", {f"seen_{v}": v for v in columns.values()}, bucket=bucket)
    return filled.select("observation_date", *columns.values())


# ----------------------------------------------------------------- marts


def crypto_assets(stg_crypto: DataFrame) -> DataFrame:
    """M6 crypto branch: one row per coin with its market-cap tier."""
    return conform_union([stg_crypto.select(
        F.col("coin_id").alias("asset_id"), F.col("coin_symbol").alias("asset_symbol"),
        F.col("coin_name").alias("asset_name"), F.lit("crypto").alias("asset_class"),
        "market_cap_rank", "market_cap_usd",
        tier("market_cap_usd", MARKET_CAP_TIERS, MARKET_CAP_TIER_DEFAULT).alias("market_cap_tier"),
        "all_time_high_usd", "all_time_high_date", "circulating_supply", "max_supply")], DIM_ASSETS)


def equity_assets(stg_equity: DataFrame, seed: DataFrame) -> DataFrame:
    """M6 equity branch. G9: distinct tickers are taken before the seed join,
    so the join touches one row per ticker instead of every price row."""
    tickers = stg_equity.select(F.col("ticker_symbol")).distinct()
    equity = (enrich(tickers, seed, "ticker_symbol", ["company_name", "sector"])
              .select(F.col("ticker_symbol").alias("asset_id"),
                      F.col("ticker_symbol").alias("asset_symbol"),
                      F.col("ticker_symbol").alias("asset_name"),
                      F.lit("equity").alias("asset_class"), "company_name", "sector")
              .distinct())
    return conform_union([equity], DIM_ASSETS)


def dim_assets(stg_crypto: DataFrame, stg_equity: DataFrame, seed: DataFrame) -> DataFrame:
    """M6: one row per asset, crypto with tier, equity with company and sector."""
    return crypto_assets(stg_crypto).unionByName(equity_assets(stg_equity, seed))


def fct_daily_prices(prices: DataFrame, assets: DataFrame, since=None) -> DataFrame:
    """M7: prices enriched with tier and rank, surrogate key and calendar parts.

    ``since`` is the incremental lower bound on ``price_date`` (F4); it is a
    literal, so it reaches the scans below the union and the join.
    """
    p = prices if since is None else prices.where(F.col("price_date") >= F.lit(since))
    j = enrich(p, assets.select("asset_id", "market_cap_tier", "market_cap_rank"), "asset_id")
    j = calendar_parts(j, "price_date", "price")
    return j.select(
        surrogate_key(["asset_id", "price_date"]).alias("price_id"),
        "asset_id", "asset_symbol", "asset_name", "asset_class", "price_date",
        "market_cap_tier", "market_cap_rank", "price_usd", "volume_usd", "market_cap_usd",
        "price_change_pct", "price_year", "price_month", "price_day_of_week")


_VOLATILITY_BASE = ["price_id", "asset_id", "asset_symbol", "asset_name", "asset_class", "market_cap_tier",
                    "price_date", "price_usd", "price_change_pct"]


def asset_volatility_schema(fct: T.StructType) -> T.StructType:
    """The columns of ``asset_volatility`` for a fact of this schema."""
    return T.StructType([*[fct[c] for c in _VOLATILITY_BASE], *[T.StructField(w, T.DoubleType()) for w in VOLATILITY_WINDOWS],
                         T.StructField("volatility_rank_daily", T.LongType())])


def asset_volatility(fct: DataFrame, chunk_rows: int = 100_000) -> DataFrame:
    """M8 computation: rolling volatility per asset (the sorted fact is cut into
    chunks of ``chunk_rows``) and daily move rank (from counts per value)."""
    base = fct.where(F.col("price_change_pct").isNotNull()).select(*_VOLATILITY_BASE)
    vol = rolling_std(base, ["asset_id"], ["price_date"], "price_change_pct", VOLATILITY_WINDOWS,
                      chunk_rows=chunk_rows)
    return rank_by_value(vol, ["price_date"], F.abs(F.col("price_change_pct")), "volatility_rank_daily")


def fct_asset_volatility(fct: DataFrame) -> DataFrame:
    """M8 (full refresh)."""
    return asset_volatility(fct)


def fct_macro_correlation(fct: DataFrame, macro_daily: DataFrame) -> DataFrame:
    """M9: each priced day with the latest macro row at or before it."""
    p = fct.where(F.col("price_change_pct").isNotNull()).select(
        "price_id", "asset_id", "asset_symbol", "asset_name", "asset_class", "market_cap_tier",
        "price_date", "price_year", "price_month", "price_usd", "price_change_pct", "volume_usd")
    out = asof_join(p, macro_daily, "price_date", "observation_date",
                    right_cols=list(INDICATOR_COLUMNS.values()), flag_col="has_macro_data")
    return out


def crypto_tier_snapshot_source(assets: DataFrame) -> DataFrame:
    """M10 source: crypto rows of the dimension, tracked columns only."""
    return assets.where(F.col("asset_class") == "crypto").select(
        "asset_id", "asset_symbol", "asset_name", "market_cap_rank", "market_cap_usd",
        "market_cap_tier")


SNAPSHOT_CHECK_COLS = ["market_cap_tier", "market_cap_rank", "market_cap_usd"]
