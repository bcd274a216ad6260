import datetime as dt

from pyspark.sql import functions as F

from tidemark.plans import jobs
from tidemark.plans import market as M
from tidemark.plans.bindings import SERIES_NAMES
from tests.conftest import rows
from tests.fixtures import write_landing


def _seed(spark):
    return spark.createDataFrame([("AAPL", "Apple", "Technology")],
                                 "ticker_symbol string, company_name string, sector string")


def test_daily_run_twice_equals_full_rebuild(spark, tmp_root):
    root = f"{tmp_root}/wh"
    t1, rep1 = jobs.daily_run(spark, root, "2024-01-10 00:00:00", write_landing(f"{tmp_root}/d1", 0),
                              _seed(spark), SERIES_NAMES, gate=False)
    t2, rep2 = jobs.daily_run(spark, root, "2024-01-12 00:00:00", write_landing(f"{tmp_root}/d2", 2),
                              _seed(spark), SERIES_NAMES, lookback_days=2, gate=False)
    fct = t2["fct_daily_prices"]
    assert spark.sql("SELECT count(*) AS n FROM stg_equity_prices").first().n == 12  # K5 view: AAPL 8 days + ZERO 4
    assert spark.sql("SELECT count(*) AS n FROM fct_daily_prices").first().n == fct.count()
    # equity: union of both loads' dates; crypto: only what raw still holds + history
    assert fct.where("asset_class = 'equity' and asset_id = 'AAPL'").count() == 8
    assert fct.select("price_id").distinct().count() == fct.count()
    # volatility merged incrementally equals a full refresh over the accumulated fact
    full = M.fct_asset_volatility(fct)
    assert rows(t2["fct_asset_volatility"], "price_id", "volatility_7d", "volatility_rank_daily") == \
        rows(full, "price_id", "volatility_7d", "volatility_rank_daily")
    # open = 0 row: pct NULL, absent from volatility
    zero = fct.where("asset_id = 'ZERO' and price_date = '2024-01-02'").first()
    assert zero.price_change_pct is None
    for t in ("fct_asset_volatility", "fct_macro_correlation"):  # open = 0: absent downstream
        assert t2[t].where("asset_id = 'ZERO' and price_date = '2024-01-02'").count() == 0
    # tier history: bitcoin price moved -> closed + open rows
    snap = t2["snapshot"]
    assert snap.where("asset_id = 'bitcoin'").count() == 1  # cap unchanged
    assert snap.where("asset_id = 'tiny' and market_cap_tier = 'micro_cap'").count() == 1
    # report: future-date test passes, seeds join, freshness computed
    rep = {(r.table, r.check, r.column): r for r in rep2.collect()}
    assert rep[("fct_daily_prices", "unique", "price_id")].passed
    assert rep[("dim_assets", "unique", "asset_id")].passed
    dim = t2["dim_assets"]
    assert dim.where("asset_id = 'AAPL'").first().company_name == "Apple"
    assert dim.where("asset_id = 'ZERO'").first().company_name is None
    corr = t2["fct_macro_correlation"]
    # the partially rebuilt macro fact equals a full rebuild from the final tables
    macro = M.int_macro_daily(M.stg_macro_indicators(
        spark.read.parquet(f"{root}/raw/macro_observations/v=00000002")))
    full_corr = M.fct_macro_correlation(fct, macro)
    assert rows(corr, *full_corr.columns) == rows(full_corr, *full_corr.columns)
    early = corr.where("price_date < '2024-01-01'").count()
    assert early == 0
    assert corr.where("has_macro_data").count() == corr.count()


def test_raw_equity_keeps_newest_days(spark, tmp_root):
    land = write_landing(f"{tmp_root}/d", 0)
    raw = jobs.load_equity(spark, land["equity"], f"{tmp_root}/wh", "2024-01-10 00:00:00", days=3)
    assert raw.where("symbol = 'AAPL'").agg(F.min("trade_date")).first()[0] == dt.date(2024, 1, 5)


def test_seed_load_and_counts(spark, tmp_root):
    p = f"{tmp_root}/seed.csv"
    with open(p, "w") as f:
        f.write("ticker_symbol,company_name,sector\nAAPL,Apple,Technology\nMSFT,Microsoft,Technology\n")
    loaded = jobs.Loaded()
    seed = jobs.load_seed(spark, p, f"{tmp_root}/wh", loaded=loaded)
    land, at = write_landing(f"{tmp_root}/d", 0), "2024-01-10 00:00:00"
    jobs.load_crypto(spark, land["crypto"], f"{tmp_root}/wh", at, loaded=loaded)
    jobs.load_equity(spark, land["equity"], f"{tmp_root}/wh", at, loaded=loaded)
    jobs.load_macro(spark, land["macro"], f"{tmp_root}/wh", at, SERIES_NAMES, loaded=loaded)
    assert seed.count() == 2
    assert loaded.rows == {"seed_equity_reference": 2, "crypto_markets": 3, "equity_daily_prices": 8, "macro_observations": 4}
    assert loaded.macro_since == dt.date(2024, 1, 1)


def test_require_not_null_fails_fast(spark):
    import pytest
    from tidemark.operators.quality import require_not_null
    df = spark.createDataFrame([("a",), (None,)], "k string")
    with pytest.raises(Exception, match="NOT NULL"):
        require_not_null(df, ["k"], "t").collect()


def test_crypto_append_mode_and_guarded_full_refresh(spark, tmp_root):
    import pytest
    root = f"{tmp_root}/wh"
    l1, l2 = write_landing(f"{tmp_root}/a", 0), write_landing(f"{tmp_root}/b", 2)
    jobs.load_crypto(spark, l1["crypto"], root, "2024-01-10 00:00:00", mode="append")
    raw = jobs.load_crypto(spark, l2["crypto"], root, "2024-01-12 00:00:00", mode="append")
    assert raw.count() == 6  # two snapshots of three coins
    with pytest.raises(ValueError, match="history"):
        jobs.daily_run(spark, root, "2024-01-12 00:00:00", l2, _seed(spark), SERIES_NAMES,
                       full_refresh=True, gate=False)


def test_command_line_daily_run(spark, tmp_root, capsys):
    from tidemark.__main__ import main
    land = write_landing(f"{tmp_root}/d", 0)
    seed = f"{tmp_root}/seed.csv"
    with open(seed, "w") as f:
        f.write("ticker_symbol,company_name,sector\nAAPL,Apple,Technology\n")
    code = main(["daily-run", "--report-only", "--root", f"{tmp_root}/wh", "--as-of", "2024-01-10 00:00:00",
                 "--equity", land["equity"], "--crypto", land["crypto"], "--macro", land["macro"],
                 "--seed", seed])
    out = capsys.readouterr().out
    assert "freshness equity_daily" in out and "fct_daily_prices.price_id unique" in out
    assert code in (0, 1)
    code = main(["test", "--root", f"{tmp_root}/wh", "--as-of", "2024-01-10 00:00:00"])
    out = capsys.readouterr().out
    assert "dim_assets.asset_id unique" in out and code in (0, 1)
    assert main(["seed", "--root", f"{tmp_root}/wh2", "--csv", seed]) == 0


def test_last_landed_file_wins_a_day(spark, tmp_root):
    import os
    from tests.fixtures import equity_payload, write_json
    for n, close in (("a", 1.0), ("b", 2.0)):
        p = equity_payload({"2024-01-02": (1, 2, 0.5, close, 10), "2024-01-03": (1, 2, 0.5, close, 10)})
        p["Meta Data"] = {"2. Symbol": "X"}
        write_json(f"{tmp_root}/land/{n}", "X.json", p)
        os.utime(f"{tmp_root}/land/{n}/X.json", (1.7e9 + ord(n) * 100, 1.7e9 + ord(n) * 100))
    raw = jobs.load_equity(spark, f"{tmp_root}/land/*", f"{tmp_root}/wh", "2024-01-10 00:00:00", days=2)
    assert rows(raw, "trade_date", "close") == [(dt.date(2024, 1, 2), 2.0), (dt.date(2024, 1, 3), 2.0)]


def test_duplicate_coin_fails_the_run_and_leaves_facts(spark, tmp_root):
    import pytest
    from tests.fixtures import coin, write_json
    root = f"{tmp_root}/wh"
    t, _ = jobs.daily_run(spark, root, "2024-01-10 00:00:00", write_landing(f"{tmp_root}/d1", 0), _seed(spark), SERIES_NAMES, gate=False)
    before = rows(t["fct_daily_prices"], "price_id", "price_usd"), rows(t["dim_assets"], "asset_id")
    land = write_landing(f"{tmp_root}/d2", 2)
    write_json(land["crypto"], "again.json", [coin("bitcoin", 1e12, 1, "2024-01-09T10:00:00.000Z")])
    with pytest.raises(Exception, match="duplicate key"):
        jobs.daily_run(spark, root, "2024-01-12 00:00:00", land, _seed(spark), SERIES_NAMES, gate=False)
    from tidemark.operators.sinks import read_current
    stored = spark.read.parquet(f"{root}/marts_core/fct_daily_prices"), read_current(spark, f"{root}/marts_core/dim_assets")
    assert (rows(stored[0], "price_id", "price_usd"), rows(stored[1], "asset_id")) == before


def test_steps_stop_at_a_failed_check_and_go_on_from_there(spark, tmp_root):
    import os
    import pytest
    from tidemark.operators import quality as Q
    built, good = [], {"b": False}

    def checks(name):
        value = None if name == "b" and not good["b"] else 1
        return Q.check_table(spark.createDataFrame([(value,)], "x int"), name, [Q.NotNull("x"), Q.NotNull("x", severity="warn")])
    steps = [jobs.Step(n, lambda n=n: built.append(n), lambda n=n: checks(n)) for n in "abc"] + [jobs.Step("d", lambda: built.append("d"))]
    record = f"{tmp_root}/_runs/day.steps"
    with pytest.raises(jobs.ChecksFailed, match="after b: b.x not_null: 1") as e:
        jobs.run_steps(spark, steps, record)
    assert built == ["a", "b"] and e.value.step == "b" and len(e.value.report) == 4
    good["b"] = True
    report = jobs.run_steps(spark, steps, record)
    assert built == ["a", "b", "b", "c", "d"] and {r.table for r in report} == {"b", "c"} and not os.path.exists(record)
    jobs.run_steps(spark, steps[:1], record)  # a finished run begins anew
    good["b"] = False
    assert [r.status for r in jobs.run_steps(spark, steps, record, gate=False) if r.table == "b"] == ["fail", "warn"]
