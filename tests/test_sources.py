import datetime as dt

import pytest

from tidemark.sources import read_observations_payload, read_records_payload, read_seed, read_timeseries_payload
from tests.conftest import rows
from tests.fixtures import coin, equity_payload, write_json, write_landing


def test_timeseries_payload(spark, tmp_root):
    land = write_landing(tmp_root)
    df = read_timeseries_payload(spark, land["equity"])
    assert dict(df.dtypes) == {"symbol": "string", "trade_date": "date", "open": "double", "high": "double",
                               "low": "double", "close": "double", "volume": "bigint"}
    assert df.count() == 8
    r = df.where("symbol = 'AAPL' and trade_date = '2024-01-02'").first()
    assert (r.open, r.close, r.volume) == (100.0, 100.5, 1000)


def test_timeseries_payload_missing_root_raises(spark, tmp_root):
    write_json(f"{tmp_root}/bad", "MSFT.json", {"Note": "rate limit"})
    with pytest.raises(Exception, match="Time Series"):
        read_timeseries_payload(spark, f"{tmp_root}/bad").collect()


def test_timeseries_payload_bad_number_raises(spark, tmp_root):
    p = equity_payload({"2024-01-02": ("abc", 1, 1, 1, 1)})
    write_json(f"{tmp_root}/badnum", "X.json", p)
    with pytest.raises(Exception):
        read_timeseries_payload(spark, f"{tmp_root}/badnum").collect()


def test_records_payload(spark, tmp_root):
    land = write_landing(tmp_root)
    df = read_records_payload(spark, land["crypto"])
    assert len(df.columns) == 26 and "unexpected_field" not in df.columns
    got = {r.id: r for r in df.collect()}
    assert got["ether"].roi == "null"
    assert '"times"' in got["bitcoin"].roi
    assert got["bitcoin"].last_updated == dt.datetime(2024, 1, 7, 23, 59, 59)
    assert got["tiny"].market_cap is None


def test_observations_payload(spark, tmp_root):
    land = write_landing(tmp_root)
    df = read_observations_payload(spark, land["macro"], {"FEDFUNDS": "Fed Funds Rate"})
    assert rows(df.where("series_id = 'FEDFUNDS'"), "observation_date", "value") == [
        (dt.date(2024, 1, 1), 5.33), (dt.date(2024, 1, 5), 5.3)]
    assert df.where("series_id = 'FEDFUNDS'").first().series_name == "Fed Funds Rate"
    recent = read_observations_payload(spark, land["macro"], None, since_days=30, as_of="2024-02-01")
    assert recent.where("observation_date < '2024-01-02'").count() == 0


def test_seed_csv(spark, tmp_root):
    p = f"{tmp_root}/seed.csv"
    with open(p, "w") as f:
        f.write("ticker_symbol,company_name,sector\nAAPL,Apple,Technology\nSPY,SPDR S&P 500 ETF Trust,Broad Market Index\n")
    df = read_seed(spark, p)
    assert rows(df) == [("AAPL", "Apple", "Technology"), ("SPY", "SPDR S&P 500 ETF Trust", "Broad Market Index")]


def test_records_payload_json_lines(spark, tmp_root):
    import json
    import os
    os.makedirs(f"{tmp_root}/jl")
    with open(f"{tmp_root}/jl/part-0.json", "w") as f:
        for i in range(5):
            f.write(json.dumps(coin(f"coin{i}", 1e9 * i, i + 1, "2024-01-05T10:00:00.000Z")) + "\n")
    df = read_records_payload(spark, f"{tmp_root}/jl", multi_line=False)
    assert df.count() == 5 and df.where("roi = 'null'").count() == 5


def test_timeseries_key_from_payload(spark, tmp_root):
    from tests.fixtures import equity_payload
    p = equity_payload({"2024-01-02": (1, 2, 0.5, 1.5, 10)})
    p["Meta Data"] = {"2. Symbol": "IBM"}
    write_json(f"{tmp_root}/k", "download-001.json", p)
    df = read_timeseries_payload(spark, f"{tmp_root}/k", key_field=("Meta Data", "2. Symbol"))
    assert [r.symbol for r in df.collect()] == ["IBM"]


def test_broken_and_incomplete_payloads_fail(spark, tmp_root):
    write_json(f"{tmp_root}/m1", "GDP.json", {"error_message": "bad key"})
    with pytest.raises(Exception, match="observations"):
        read_observations_payload(spark, f"{tmp_root}/m1").collect()
    import os
    os.makedirs(f"{tmp_root}/m2")
    with open(f"{tmp_root}/m2/GDP.json", "w") as f:
        f.write('{"observations": [{"date": "2024-01-01", "val')
    with pytest.raises(Exception):
        read_observations_payload(spark, f"{tmp_root}/m2").collect()
    write_json(f"{tmp_root}/e1", "X.json", {"Time Series (Daily)": {"2024-01-02": {"1. open": "1.0"}}})
    with pytest.raises(Exception, match="no .*for X"):
        read_timeseries_payload(spark, f"{tmp_root}/e1").collect()
    bad = coin("c", 1e9, 1, "2024-01-05T10:00:00.000Z")
    bad["market_cap"] = "abc"
    write_json(f"{tmp_root}/c1", "page.json", [bad])
    with pytest.raises(Exception):
        read_records_payload(spark, f"{tmp_root}/c1").collect()
    gone = coin("c", 1e9, 1, "2024-01-05T10:00:00.000Z")
    del gone["market_cap"]
    write_json(f"{tmp_root}/c2", "page.json", [gone])
    with pytest.raises(ValueError, match="market_cap"):
        read_records_payload(spark, f"{tmp_root}/c2")


@pytest.mark.parametrize("multi_line", [True, False])
def test_columns_may_be_spread_over_records(spark, tmp_root, multi_line):
    """A column is missing only if no record has it, whatever each one lacks."""
    import json
    import os
    a, b = (coin(x, 1e9, 1, "2024-01-05T10:00:00.000Z") for x in "ab")
    del a["market_cap"], b["name"]
    os.makedirs(f"{tmp_root}/s{multi_line}")

    def land(name, records):
        with open(f"{tmp_root}/s{multi_line}/{name}.json", "w") as f:
            f.write(json.dumps(records) if multi_line else "\n".join(json.dumps(r) for r in records))

    land("p1", [a])
    with pytest.raises(ValueError, match="market_cap"):
        read_records_payload(spark, f"{tmp_root}/s{multi_line}", multi_line=multi_line)
    land("p2", [b])
    got = {r.id: (r.name, r.market_cap) for r in read_records_payload(
        spark, f"{tmp_root}/s{multi_line}", multi_line=multi_line).collect()}
    assert got["a"][1] is None and got["b"] == (None, 1e9)


def test_exact_integers_and_json_numbers(spark, tmp_root):
    p = equity_payload({"2024-01-02": (1, 2, 0.5, 1.5, 9007199254740993)})
    write_json(f"{tmp_root}/big", "X.json", p)
    assert read_timeseries_payload(spark, f"{tmp_root}/big").first().volume == 9007199254740993
    import json
    c = coin("c", 1e9, 1, "2024-01-05T10:00:00.000Z")
    c["roi"] = {"times": 106.8, "currency": "btc", "percentage": 10680}
    write_json(f"{tmp_root}/roi", "page.json", [c])
    assert json.loads(read_records_payload(spark, f"{tmp_root}/roi").first().roi) == c["roi"]
