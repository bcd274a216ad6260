"""Batch jobs that read and write tables.

Layout: ``<root>/<schema>/<table>`` with the schema names of the reference's
layers (K8). A daily run is a list of steps, each of which builds one table and
then checks it (Q1–Q8). The first failed error-level check stops the run, so
what depends on the table is left as it was; a run that is started again for
the same time goes on from the step that failed.

The raw equity table and the facts are partitioned by day: a load or a run
reads and rewrites only the days it touches (``merge_partitions``). The crypto
snapshot is a full reload (K2), the macro series (one row a series and day) a
keyed merge, the dimension a rebuild, all as new version directories, so no job overwrites the path it reads and a job that dies
leaves the previous version current. The tier history is an SCD2 snapshot (K7).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import quality as Q
from tidemark.operators.relational import topk, topk_per_key, unique_by
from tidemark.operators.scd2 import history_schema, read_history, scd2_snapshot
from tidemark.operators.sinks import (
    dedupe_by_key,
    drop_old_versions,
    high_water_mark,
    layer_path,
    merge_partitions,
    move_back,
    path_exists,
    read_current,
    read_mark,
    read_text,
    register_view,
    remove_file,
    replace_partitions_from,
    stored_window_increment,
    upsert,
    with_load_stamp,
    write_mark,
    write_table,
    write_text,
    write_version,
)
from tidemark.plans import market as M
from tidemark.session import materialize
from tidemark.schemas import DIM_ASSETS, RAW_CRYPTO, RAW_EQUITY, RAW_MACRO
from tidemark.sources.tables import read_seed
from tidemark.sources.payloads import (
    read_observations_payload,
    read_records_payload,
    read_timeseries_payload,
)

EQUITY_DAYS = 30          # newest rows kept per symbol per load (G18)
CRYPTO_TOP_N = 50         # coins kept per load, by market cap
MACRO_SINCE_DAYS = 365    # observation window of the macro load

EQUITY, CRYPTO, MACRO = "equity_daily_prices", "crypto_markets", "macro_observations"
RAW_SCHEMAS = {EQUITY: RAW_EQUITY, CRYPTO: RAW_CRYPTO, MACRO: RAW_MACRO}
RAW, STAGING, CORE, FINANCE, SNAPSHOTS = "raw", "staging", "marts_core", "marts_finance", "snapshots"


# ------------------------------------------------------------------ M11–M13


@dataclass
class Loaded:
    """What the loads of one run have read: rows by table (A5), and the earliest
    observation date of the macro load, from which on its marts may change."""

    rows: dict[str, int] = field(default_factory=dict)
    macro_since: date | None = None


def _counted(df: DataFrame, **more) -> tuple[DataFrame, Observation]:
    """A5: rows per load, gathered while the write runs (no extra job)."""
    obs = Observation()
    return df.observe(obs, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in more.items()]), obs


def write_counted(df: DataFrame, path: str, name: str, loaded: Loaded | None = None) -> int:
    """Write a new version, drop old ones, and return the rows written."""
    counted, obs = _counted(df)
    write_version(counted, path)
    n = obs.get.get("rows", 0)
    if loaded is not None:
        loaded.rows[name] = n
    drop_old_versions(df.sparkSession, path)
    return n


def load_seed(spark: SparkSession, csv_path: str, root: str, table: str = "seed_equity_reference",
              loaded: Loaded | None = None) -> DataFrame:
    """K9: a CSV seed (S5) materialized in the seeds layer (K4)."""
    path = layer_path(root, "seeds", table)
    write_counted(read_seed(spark, csv_path), path, table, loaded)
    return read_current(spark, path)


def raw_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A raw table as it is stored; empty before its first load."""
    schema, path = RAW_SCHEMAS[table], layer_path(root, RAW, table)
    return _read_partitioned(spark, path, schema) if table == EQUITY else read_current(spark, path, schema)


def load_equity(spark: SparkSession, landing: str, root: str, as_of, days: int = EQUITY_DAYS,
                loaded: Loaded | None = None, multi_line: bool = True, key_field=None) -> DataFrame:
    """Parse daily series payloads, keep the newest ``days`` per symbol,
    merge into the raw table on (symbol, trade_date); only the days that landed
    are read and rewritten."""
    parsed = read_timeseries_payload(spark, landing, landed_col="landed", multi_line=multi_line, key_field=key_field)
    # The last landed file wins a day, before days are counted
    parsed = dedupe_by_key(parsed, ["symbol", "trade_date"], ["landed"]).drop("landed")
    newest = topk_per_key(parsed, ["symbol"], [F.col("trade_date").desc()], days)
    newest, obs = _counted(Q.require_not_null(newest, ["symbol", "trade_date"], EQUITY))
    merge_partitions(materialize(newest, EQUITY), layer_path(root, RAW, EQUITY), ["symbol", "trade_date"], "trade_date",
                     RAW_EQUITY, stamp=("loaded_at", as_of), stored=True)
    if loaded is not None:
        loaded.rows[EQUITY] = obs.get.get("rows", 0)
    return raw_table(spark, root, EQUITY)


def load_crypto(spark: SparkSession, landing: str, root: str, as_of, top_n: int = CRYPTO_TOP_N,
                mode: str = "replace", loaded: Loaded | None = None, multi_line: bool = True) -> DataFrame:
    """Parse the market records, keep the top ``top_n`` by market cap.

    ``mode="replace"`` swaps the raw table as a whole, as the reference
    does, but as a new version (never truncate-then-insert, G20).
    ``mode="append"`` keeps every snapshot (merged on coin and update time),
    so the raw layer holds crypto history too (G13).
    """
    recs = read_records_payload(spark, landing, multi_line=multi_line)
    top = with_load_stamp(topk(recs, [F.col("market_cap").desc_nulls_last(), F.col("id")], top_n),
                          "loaded_at", as_of)
    path = layer_path(root, RAW, CRYPTO)
    if mode == "append":
        top = upsert(read_current(spark, path, RAW_CRYPTO), top, ["id", "last_updated"])
    elif mode != "replace":
        raise ValueError(f"unknown mode {mode!r}")
    write_counted(top, path, CRYPTO, loaded)
    return raw_table(spark, root, CRYPTO)


def load_macro(spark: SparkSession, landing: str, root: str, as_of, names: dict[str, str],
               since_days: int = MACRO_SINCE_DAYS, loaded: Loaded | None = None, multi_line: bool = True,
               key_field=None) -> DataFrame:
    """Parse observation payloads of the last ``since_days`` days, merge on
    (series_id, observation_date); updates value, name and load time. The table
    has one row a series and day, so it is rewritten as a new version rather than
    kept in a folder a day."""
    keys = ["series_id", "observation_date"]
    obs = read_observations_payload(spark, landing, names, since_days, as_of, landed_col="landed", multi_line=multi_line,
                                    key_field=key_field)
    obs = Q.require_not_null(dedupe_by_key(obs, keys, ["landed"]).drop("landed"), keys, MACRO)
    obs, seen = _counted(obs, first=F.min("observation_date"))
    merged = upsert(raw_table(spark, root, MACRO), materialize(obs, MACRO), keys, stamp=("loaded_at", as_of))
    write_version(merged.select(*RAW_MACRO.fieldNames()), layer_path(root, RAW, MACRO))
    drop_old_versions(spark, layer_path(root, RAW, MACRO))
    if loaded is not None:
        loaded.rows[MACRO], loaded.macro_since = seen.get.get("rows", 0), seen.get.get("first")
    return raw_table(spark, root, MACRO)


# ------------------------------------------------------------------ M14


class ChecksFailed(RuntimeError):
    """An error-level check failed after a step; later steps have not run."""

    def __init__(self, step: str, report: list[Row]):
        self.step, self.report = step, report
        bad = [f"{r.table}.{r.column} {r.check}: {r.violations}" for r in report if r.status == "fail"]
        super().__init__(f"checks failed after {step}: " + "; ".join(bad))


@dataclass
class Step:
    """``build`` writes a table; ``checks`` gives its report (None: no checks)."""

    name: str
    build: Callable[[], None]
    checks: Callable[[], DataFrame] | None = None


def run_steps(spark: SparkSession, steps: list[Step], record: str, resume: bool = True, gate: bool = True) -> list[Row]:
    """Run steps in order; each is checked before the next one begins.

    A step whose checks fail at error level raises ``ChecksFailed``, with the
    report so far, and nothing after it runs. Finished steps are listed in the
    small file ``record``; with ``resume`` a later call goes on behind them (the
    failed step is built again). The file is removed when all steps are done.
    Without ``gate`` failed checks are reported and nothing stops. Returns the
    report rows of this call's steps.
    """
    done = (read_text(spark, record) or "").split("\n") if resume else []
    report: list[Row] = []
    for step in steps:
        if step.name in done:
            continue
        step.build()
        if step.checks is not None:
            rows = step.checks().collect()  # one row a check
            report += rows
            if gate and any(r.status == "fail" for r in rows):
                raise ChecksFailed(step.name, report)
        done.append(step.name)
        write_text(spark, record, "\n".join(d for d in done if d))
    remove_file(spark, record)
    return report


REPORT = "check string, table string, column string, severity string, violations long, passed boolean, status string"


@dataclass
class DailyRun:
    """The tables of a daily run under a root, and how each is built and checked."""

    spark: SparkSession
    root: str
    as_of: str
    seed: DataFrame | None = None
    full_refresh: bool = False
    allow_history_loss: bool = False
    lookback_days: int = 0               # G2: re-merge this many days below the mark (late rows)
    severities: dict[str, str] = field(default_factory=dict)  # other severities, by check name

    def path(self, layer, table):
        return layer_path(self.root, layer, table)

    def raw(self, table):
        return raw_table(self.spark, self.root, table)

    # K5: staging models are functions of the raw tables, registered as views
    def stg_equity(self):
        return register_view(M.stg_equity_prices(self.raw(EQUITY)), "stg_equity_prices")

    def stg_crypto(self):
        return register_view(M.stg_crypto_prices(self.raw(CRYPTO)), "stg_crypto_prices")

    def stg_macro(self):
        return register_view(M.stg_macro_indicators(self.raw(MACRO)), "stg_macro_indicators")

    def prices(self):
        return M.int_prices_combined(self.stg_crypto(), self.stg_equity())

    def dim(self):
        return read_current(self.spark, self.path(CORE, "dim_assets"), DIM_ASSETS)

    def fct_schema(self):
        return M.fct_daily_prices(self.prices().limit(0), self.dim().limit(0)).schema

    def fct(self):
        return _read_partitioned(self.spark, self.path(CORE, "fct_daily_prices"), self.fct_schema())

    def volatility(self):
        return _read_partitioned(self.spark, self.path(CORE, "fct_asset_volatility"),
                                 M.asset_volatility_schema(self.fct_schema()))

    def _correlation_model(self, fct: DataFrame) -> DataFrame:
        return M.fct_macro_correlation(fct, M.int_macro_daily(self.stg_macro()))

    def correlation(self):
        schema = self._correlation_model(self.fct().limit(0)).schema
        return _read_partitioned(self.spark, self.path(FINANCE, "fct_macro_correlation"), schema)

    def build_dim(self):
        dim = unique_by(M.dim_assets(self.stg_crypto(), self.stg_equity(), self.seed), ["asset_id"])
        write_version(dim, self.path(CORE, "dim_assets"))
        drop_old_versions(self.spark, self.path(CORE, "dim_assets"))

    def build_fct(self):
        """K3: merged from the high-water mark on (inclusive); only the days at or
        after it are read and rewritten (price_id determines price_date)."""
        path, schema = self.path(CORE, "fct_daily_prices"), self.fct_schema()
        if self.full_refresh:
            # The fact is the only place crypto history survives when the
            # raw crypto table is replaced on each load; refuse to drop it
            # unless asked to.
            if not self.allow_history_loss:
                raise ValueError("full refresh of fct_daily_prices drops history not held in raw "
                                 "tables; pass allow_history_loss=True or load crypto in append mode")
            write_table(M.fct_daily_prices(self.prices(), self.dim()), path, ["price_date"], replace_all=True)
        else:
            mark = read_mark(self.spark, path) or high_water_mark(self.fct(), "price_date")
            rows = M.fct_daily_prices(self.prices(), self.dim(), since=move_back(mark, self.lookback_days))
            merge_partitions(rows, path, ["price_id", "price_date"], "price_date", schema)
        write_mark(self.spark, path, high_water_mark(self.fct(), "price_date"))

    def build_volatility(self):
        """K3 + G1: from the days at or after its mark and the stored last rows of
        each asset, equal to a full refresh."""
        fct = self.fct()
        stored_window_increment(fct.where(F.col("price_change_pct").isNotNull()), self.path(CORE, "fct_asset_volatility"),
                                self.path(CORE, "fct_asset_volatility_state"), M.asset_volatility_schema(fct.schema),
                                ["price_id"], "price_date", ["asset_id"], 89, M.asset_volatility,
                                self.lookback_days, self.full_refresh)

    def build_correlation(self):
        """K4 (rebuild) limited to the days that can change: a day's macro values
        depend only on observations at or before it, so only days at or after
        min(this table's mark, the earliest macro date loaded since the last
        build) are recomputed; their partitions are replaced whole."""
        path, fct = self.path(FINANCE, "fct_macro_correlation"), self.fct()
        stored = self.correlation()
        mark = None if self.full_refresh else move_back(high_water_mark(stored, "price_date"), self.lookback_days)
        changed = read_mark(self.spark, self.pending())
        if mark is None:
            write_table(self._correlation_model(fct), path, ["price_date"], replace_all=True)
        else:
            since = min(d for d in (mark, changed) if d is not None)
            rows = self._correlation_model(fct.where(F.col("price_date").isNull() | (F.col("price_date") >= F.lit(since))))
            replace_partitions_from(rows.select(*stored.columns), path, "price_date", since)
        write_mark(self.spark, self.pending(), None)

    def build_snapshot(self):
        """K7: tier history; only the open rows are rewritten, closed versions are
        appended once."""
        scd2_snapshot(M.crypto_tier_snapshot_source(self.dim()), self.path(SNAPSHOTS, "snapshot_crypto_market_cap_tier"),
                      "asset_id", M.SNAPSHOT_CHECK_COLS, self.as_of)

    def snapshot(self):
        schema = history_schema(M.crypto_tier_snapshot_source(self.dim()).schema)
        return read_history(self.spark, self.path(SNAPSHOTS, "snapshot_crypto_market_cap_tier"), schema)

    def pending(self):
        """Where the earliest macro date waits that the correlation has not taken in."""
        return f"{self.root.rstrip('/')}/_runs/macro_pending"

    def note_macro(self, since: date | None):
        before = read_mark(self.spark, self.pending())
        write_mark(self.spark, self.pending(), min((d for d in (before, since) if d is not None), default=None))

    # Q1–Q8 of the reference's YAML and SQL tests, by table
    def _checked(self, df, table, checks):
        return Q.check_table(df, table, checks, self.severities)

    def check_equity(self):
        return self._checked(self.stg_equity(), "stg_equity_prices", [
            Q.NotNull(c) for c in ("ticker_symbol", "trade_date", "close_usd", "open_usd")])

    def check_crypto(self):
        return self._checked(self.stg_crypto(), "stg_crypto_prices", [
            *[Q.NotNull(c) for c in ("coin_id", "coin_symbol", "coin_name", "price_usd", "market_cap_usd")],
            Q.Unique(("coin_id",))])

    def check_macro(self):
        return self._checked(self.stg_macro(), "stg_macro_indicators", [
            *[Q.NotNull(c) for c in ("indicator_id", "indicator_category", "observation_date", "indicator_value")],
            Q.AcceptedValues("indicator_category", ("interest_rate", "inflation", "employment", "fx_rate", "other"))])

    def check_dim(self):
        return self._checked(self.dim(), "dim_assets", [
            Q.NotNull("asset_id"), Q.Unique(("asset_id",)), Q.NotNull("asset_symbol"),
            Q.NotNull("asset_class"), Q.AcceptedValues("asset_class", ("crypto", "equity"))])

    def check_fct(self):
        return self._checked(self.fct(), "fct_daily_prices", [
            *[Q.NotNull(c) for c in ("price_id", "asset_id", "price_date", "price_usd", "asset_class")],
            Q.AcceptedValues("asset_class", ("crypto", "equity")),
            Q.Expectation("price_is_positive", Q.positive("price_usd"), "price_usd"),
            Q.Expectation("price_date_not_in_future", Q.not_in_future("price_date", self.as_of), "price_date"),
            Q.Unique(("price_id",)),
            Q.Relationship("asset_id", self.dim(), "asset_id", severity="warn")])

    def check_volatility(self):
        return self._checked(self.volatility(), "fct_asset_volatility", [
            *[Q.NotNull(c) for c in ("price_id", "asset_id", "price_date")], Q.Unique(("price_id",))])

    def check_correlation(self):
        return self._checked(self.correlation(), "fct_macro_correlation", [
            *[Q.NotNull(c) for c in ("price_id", "asset_id", "price_date")], Q.Unique(("price_id",)),
            Q.AcceptedValues("asset_class", ("crypto", "equity")),
            Q.Expectation("indicators_within_bounds", Q.out_of_range(M.INDICATOR_RANGES))])

    def marts(self) -> list[Step]:
        return [Step("dim_assets", self.build_dim, self.check_dim),
                Step("fct_daily_prices", self.build_fct, self.check_fct),
                Step("fct_asset_volatility", self.build_volatility, self.check_volatility),
                Step("fct_macro_correlation", self.build_correlation, self.check_correlation),
                Step("snapshot", self.build_snapshot)]

    def tables(self) -> dict[str, DataFrame]:
        """The staging views and the stored tables, also queryable by name with spark.sql."""
        out = {"stg_equity": self.stg_equity(), "stg_crypto": self.stg_crypto(), "stg_macro": self.stg_macro(),
               "dim_assets": self.dim(), "fct_daily_prices": self.fct(), "fct_asset_volatility": self.volatility(),
               "fct_macro_correlation": self.correlation()}
        for name in ("dim_assets", "fct_daily_prices", "fct_asset_volatility", "fct_macro_correlation"):
            register_view(out[name], name)
        return out

    def freshness(self) -> DataFrame:
        parts = [Q.freshness(self.raw(t), name, "loaded_at", warn, error, self.as_of) for t, name, warn, error in (
            (EQUITY, "equity_daily", 25, 48), (CRYPTO, "crypto_markets", 25, 48), (MACRO, "macro_series", 49, 168))]
        return parts[0].unionByName(parts[1]).unionByName(parts[2])


def test_tables(spark: SparkSession, root: str, as_of: str) -> tuple[DataFrame, DataFrame]:
    """Q1–Q8 on the tables already under ``root`` (no load, no build):
    returns (test report, source freshness)."""
    run = DailyRun(spark, root, as_of)
    report = run.check_equity()
    for check in (run.check_crypto, run.check_macro, run.check_dim, run.check_fct, run.check_volatility, run.check_correlation):
        report = report.unionByName(check())
    return report, run.freshness()


def _read_partitioned(spark, path, schema):
    """A date-partitioned table, or an empty one before the first run."""
    if path_exists(spark, path):
        return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())
    return spark.createDataFrame([], schema)


def daily_run(spark: SparkSession, root: str, as_of: str, landing: dict[str, str],
              seed: DataFrame, macro_names: dict[str, str], crypto_mode: str = "replace",
              full_refresh: bool = False, allow_history_loss: bool = False,
              lookback_days: int = 0, resume: bool = True, gate: bool = True, loaded: Loaded | None = None,
              crypto_top_n: int = CRYPTO_TOP_N, payload_options: dict[str, dict] | None = None,
              severities: dict[str, str] | None = None) -> tuple[dict, DataFrame]:
    """Loads (crypto, equity, macro, as in the reference's order), then marts,
    each checked before what depends on it is built.

    Raises ``ChecksFailed`` at the first failed error-level check: the tables of
    later steps are as they were. Called again with the same ``as_of`` it goes on
    from that step (``resume``), building it again from what has landed by then.
    ``gate=False`` only reports failed checks.
    ``payload_options`` gives more arguments of the loads, by load; ``severities``
    other severities of checks, by check name: one that only warns is reported
    and its rows stay, as where a source has true zeros for prices.
    """
    run = DailyRun(spark, root, as_of, seed, full_refresh=full_refresh,
                   allow_history_loss=allow_history_loss, lookback_days=lookback_days, severities=severities or {})
    loaded = Loaded() if loaded is None else loaded
    more = payload_options or {}

    def crypto():
        load_crypto(spark, landing["crypto"], root, as_of, crypto_top_n, crypto_mode, loaded, **more.get("crypto", {}))

    def equity():
        load_equity(spark, landing["equity"], root, as_of, loaded=loaded, **more.get("equity", {}))

    def macro():
        load_macro(spark, landing["macro"], root, as_of, macro_names, loaded=loaded, **more.get("macro", {}))
        run.note_macro(loaded.macro_since)

    steps = [Step("load_crypto", crypto, run.check_crypto), Step("load_equity", equity, run.check_equity),
             Step("load_macro", macro, run.check_macro), *run.marts()]
    name = "".join(c if c.isalnum() else "-" for c in as_of)
    rows = run_steps(spark, steps, f"{root.rstrip('/')}/_runs/{name}.steps", resume, gate)
    tables = run.tables()
    tables["snapshot"] = register_view(run.snapshot(), "snapshot_crypto_market_cap_tier")
    tables["source_freshness"] = run.freshness()
    return tables, spark.createDataFrame(rows, REPORT)


__all__ = ["load_equity", "load_crypto", "load_macro", "load_seed", "DailyRun", "daily_run", "test_tables",
           "ChecksFailed", "Loaded", "Step", "run_steps"]
