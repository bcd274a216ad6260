"""Command line: ``python -m tidemark daily-run ...``.

Runs the ordered daily job (loads, marts, data tests, freshness) on landed
payload directories and prints the test report; exits non-zero when a test
of severity ``error`` fails.
"""

from __future__ import annotations

import argparse
import json
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="tidemark")
    sub = ap.add_subparsers(dest="cmd", required=True)
    d = sub.add_parser("daily-run", help="load payloads, build marts, run data tests")
    d.add_argument("--root", required=True, help="table root (one folder per layer)")
    d.add_argument("--as-of", required=True, help="load time, e.g. '2024-02-01 00:00:00'")
    d.add_argument("--equity", required=True, help="folder of daily time-series payloads")
    d.add_argument("--crypto", required=True, help="folder of market record payloads")
    d.add_argument("--macro", required=True, help="folder of observation payloads")
    d.add_argument("--seed", required=True, help="equity reference CSV")
    d.add_argument("--series-names", default="{}", help="JSON map series id -> name")
    d.add_argument("--crypto-mode", choices=["replace", "append"], default="replace")
    d.add_argument("--lookback-days", type=int, default=0)
    d.add_argument("--full-refresh", action="store_true")
    d.add_argument("--allow-history-loss", action="store_true")
    d.add_argument("--report-only", action="store_true", help="go on after a failed check")
    d.add_argument("--master", default=None)
    t = sub.add_parser("test", help="data tests and source freshness on existing tables")
    t.add_argument("--root", required=True)
    t.add_argument("--as-of", required=True)
    t.add_argument("--master", default=None)
    sd = sub.add_parser("seed", help="load a CSV seed into the seeds layer")
    sd.add_argument("--root", required=True)
    sd.add_argument("--csv", required=True)
    sd.add_argument("--table", default="seed_equity_reference")
    sd.add_argument("--master", default=None)
    a = ap.parse_args(argv)

    from tidemark.plans import jobs
    from tidemark.session import build_session

    spark = build_session(a.master)
    if a.cmd == "seed":
        n = jobs.load_seed(spark, a.csv, a.root, a.table).count()
        print(f"seeded {a.table}: {n} rows")
        return 0
    if a.cmd == "test":
        report, fresh = jobs.test_tables(spark, a.root, a.as_of)
        return _print_report(report.collect(), fresh.collect())
    seed = jobs.load_seed(spark, a.seed, a.root)
    loaded = jobs.Loaded()
    try:
        tables, report = jobs.daily_run(
            spark, a.root, a.as_of, {"equity": a.equity, "crypto": a.crypto, "macro": a.macro},
            seed, json.loads(a.series_names), crypto_mode=a.crypto_mode,
            full_refresh=a.full_refresh, allow_history_loss=a.allow_history_loss,
            lookback_days=a.lookback_days, gate=not a.report_only, loaded=loaded)
        code = _print_report(report.collect(), tables["source_freshness"].collect())
    except jobs.ChecksFailed as e:
        code = _print_report(e.report, [])
        print(f"stopped after {e.step}; run again for the same time to go on from there")
    print("loaded:", json.dumps(loaded.rows))
    return code


def _print_report(rows, fresh) -> int:
    """One line per check (the report has one row per check: small)."""
    for r in rows:
        print(f"{r.status:5s} {r.table}.{r.column} {r.check}: {r.violations}")
    for r in fresh:
        print(f"{r.status:5s} freshness {r.source}: {r.age_hours} h")
    return 1 if any(r.status == "fail" for r in rows) or any(r.status == "error" for r in fresh) else 0


if __name__ == "__main__":
    sys.exit(main())
