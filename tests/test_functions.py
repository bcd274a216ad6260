import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from tidemark.functions import expr as X
from tidemark.plans import market as M


def test_safe_pct_change_zero_and_null_base(spark):
    df = spark.createDataFrame([(0.0, 5.0), (None, 5.0), (100.0, 101.23456)], "o double, c double")
    got = [r[0] for r in df.select(X.safe_pct_change("o", "c")).collect()]
    assert got[0] is None and got[1] is None
    assert got[2] == pytest.approx(1.2346)


@pytest.mark.parametrize("cap,label", [
    (10_000_000_000, "large_cap"), (1_000_000_000, "mid_cap"), (100_000_000, "small_cap"),
    (99_999_999.0, "micro_cap"), (None, "micro_cap"), (-5.0, "micro_cap")])
def test_tier_inclusive_bounds(spark, cap, label):
    df = spark.createDataFrame([(float(cap) if cap is not None else None,)], "m double")
    t = df.select(X.tier("m", M.MARKET_CAP_TIERS, M.MARKET_CAP_TIER_DEFAULT)).first()[0]
    assert t == label


def test_label_map_default(spark):
    df = spark.createDataFrame([("FEDFUNDS",), ("XYZ",), (None,)], "s string")
    got = [r[0] for r in df.select(X.label_map("s", M.INDICATOR_CATEGORIES, "other")).collect()]
    assert got == ["interest_rate", "other", "other"]


def test_surrogate_key_matches_md5_and_null_token(spark):
    df = spark.createDataFrame([("btc", dt.date(2024, 1, 7)), (None, dt.date(2024, 1, 7))],
                               "a string, d date")
    got = [r[0] for r in df.select(X.surrogate_key(["a", "d"])).collect()]
    assert got[0] == hashlib.md5(b"btc-2024-01-07").hexdigest()
    token = X.SURROGATE_NULL_TOKEN
    assert got[1] == hashlib.md5(f"{token}-2024-01-07".encode()).hexdigest()


def test_surrogate_key_refuses_doubles(spark):
    df = spark.createDataFrame([(1.0,)], "x double")
    with pytest.raises(TypeError):
        X.add_surrogate_key(df, "k", ["x"])


def test_day_of_week_sunday_zero(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 7),), (dt.date(2024, 1, 8),)], "d date")
    assert [r[0] for r in df.select(X.day_of_week_sun0("d")).collect()] == [0, 1]


def test_calendar_parts_types(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 3),)], "d date")
    out = X.calendar_parts(df, "d", "p")
    assert dict(out.dtypes)["p_year"] == "bigint"
    assert out.first()["p_month"] == 2


def test_strict_double_raises_lenient_nulls(spark):
    df = spark.createDataFrame([("1.5",), (".",)], "s string")
    assert [r[0] for r in df.select(X.lenient_double("s")).collect()] == [1.5, None]
    with pytest.raises(Exception):
        df.select(X.strict_double("s")).collect()


def test_strict_date_raises(spark):
    df = spark.createDataFrame([("2024-13-45",)], "s string")
    with pytest.raises(Exception):
        df.select(X.strict_date("s")).collect()


def test_json_text_null_is_text_null(spark):
    df = spark.createDataFrame([({"times": "1.2"},), (None,)], "m map<string,string>")
    got = [r[0] for r in df.select(X.json_text("m")).collect()]
    assert got == ['{"times":"1.2"}', "null"]


def test_nan_to_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    assert [r[0] for r in df.select(X.nan_to_null("x")).collect()] == [None, 1.0]


def test_cast_ts_to_date_no_shift(spark):
    df = spark.createDataFrame([("2024-01-05 23:59:59",)], "s string") \
        .select(F.col("s").cast("timestamp_ntz").cast("date").alias("d"))
    assert df.first()[0] == dt.date(2024, 1, 5)
