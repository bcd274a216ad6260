"""Declared schemas of the raw, staging and mart tables (FIXTURES.md §2–3)."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(), "date": T.DateType(), "double": T.DoubleType(),
    "bigint": T.LongType(), "int": T.IntegerType(), "boolean": T.BooleanType(),
    "timestamp_ntz": T.TimestampNTZType(), "timestamp": T.TimestampType(),
}


def ddl(spec: str) -> T.StructType:
    """``"name type, ..."`` with flat types to a StructType (no JVM needed)."""
    fields = []
    for part in spec.split(","):
        name, typ = part.split()
        fields.append(T.StructField(name, _TYPES[typ]))
    return T.StructType(fields)


RAW_EQUITY = ddl(
    "symbol string, trade_date date, open double, high double, low double, close double, "
    "volume bigint, loaded_at timestamp_ntz")

RAW_CRYPTO = ddl(
    "id string, symbol string, name string, image string, current_price double, "
    "market_cap double, market_cap_rank int, fully_diluted_valuation double, "
    "total_volume double, high_24h double, low_24h double, price_change_24h double, "
    "price_change_percentage_24h double, market_cap_change_24h double, "
    "market_cap_change_percentage_24h double, circulating_supply double, "
    "total_supply double, max_supply double, ath double, ath_change_percentage double, "
    "ath_date timestamp_ntz, atl double, atl_change_percentage double, atl_date timestamp_ntz, "
    "roi string, last_updated timestamp_ntz, loaded_at timestamp_ntz")

RAW_MACRO = ddl(
    "series_id string, series_name string, observation_date date, value double, "
    "loaded_at timestamp_ntz")

SEED_EQUITY = ddl("ticker_symbol string, company_name string, sector string")

PRICES_COMBINED = ddl(
    "asset_id string, asset_symbol string, asset_name string, asset_class string, "
    "price_date date, price_usd double, volume_usd double, market_cap_usd double, "
    "price_change_pct double")

DIM_ASSETS = ddl(
    "asset_id string, asset_symbol string, asset_name string, asset_class string, "
    "market_cap_rank int, market_cap_usd double, market_cap_tier string, "
    "all_time_high_usd double, all_time_high_date timestamp_ntz, circulating_supply double, "
    "max_supply double, company_name string, sector string")

# The 26 columns the crypto load keeps from the wider API payload.
CRYPTO_PAYLOAD_COLUMNS = [f.name for f in RAW_CRYPTO.fields if f.name != "loaded_at"]
