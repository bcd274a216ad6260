"""Every registered query against its DuckDB oracle (sf0.001), plus plan checks."""

import os

import pytest

from tidemark.plans import catalog
from tests.oracle import compare, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data absent")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(n for n in catalog.QUERIES if n in catalog.ORACLE_SQL))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, con, name, SF)
    assert ok, msg


def test_two_days_go_on_past_a_price_of_zero(spark, tmp_root):
    """Its check warns, the rows belong to the marts, and the run still stops at the coin without a price."""
    import duckdb
    rows = {
        "region": "SELECT i::INTEGER AS r_regionkey, 'R' || i AS r_name FROM range(2) t(i)",
        "nation": "SELECT i::INTEGER AS n_nationkey, 'N' || i AS n_name, (i % 2)::INTEGER AS n_regionkey FROM range(3) t(i)",
        "customer": "SELECT i AS c_custkey, 'C' || i AS c_name, (i % 3)::INTEGER AS c_nationkey, 100.5::DOUBLE * (i + 1) AS c_acctbal,"
                    " 'X' AS c_mktsegment FROM range(4) t(i)",
        "orders": "SELECT i AS o_orderkey, 0 AS o_custkey, 'F' AS o_orderstatus, 50000::DOUBLE AS o_totalprice,"
                  " TIMESTAMP '1997-01-15' + to_days(i::INTEGER) AS o_orderdate, '5-LOW' AS o_orderpriority FROM range(3) t(i)",
        # readings of two users on days 12 to 21, one closing value of a first day's and one of a second day's zero
        "events": "SELECT i AS event_id, TIMESTAMP '2024-01-12 08:00:00' + to_days((i // 4)::INTEGER) + to_hours((i % 4)::INTEGER) AS ts,"
                  " 1 + i % 2 AS user_id, 'e' AS event_type, CASE WHEN i IN (7, 38) THEN 0::DOUBLE ELSE 10::DOUBLE + i * i % 7 END AS value,"
                  " '{}' AS props FROM range(40) t(i)"}
    for name in ("supplier", "part", "lineitem"):  # not read
        rows[name] = "SELECT 1 AS i"
    for name, sql in rows.items():
        duckdb.sql(f"COPY ({sql}) TO '{tmp_root}/{name}.parquet' (FORMAT parquet)")
    ok, msg = compare(spark, duck(tmp_root), "daily_run_two_days", tmp_root)
    assert ok, msg


def test_every_query_has_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLE_SQL)


_PLANS: dict[str, str] = {}


def _plan(spark, name: str) -> str:
    """The physical plan of a query, built once for both plan checks."""
    if name not in _PLANS:
        _PLANS[name] = catalog.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    return _PLANS[name]


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_plan_has_no_pair_explosion(spark, name):
    plan = _plan(spark, name)
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert set(catalog.QUERIES) <= set(e.queries())
    assert set(catalog.ORACLE_SQL) <= set(e.oracle_sql()) <= set(e.queries())


def _nodes(plan: str):
    import re
    out = []
    for line in plan.splitlines():
        m = re.search(r"[A-Za-z*]", line)
        if m:
            out.append((m.start(), line[m.start():]))
    return out


def _grouped_by_calendar(node: str) -> bool:
    """An aggregate by dates or time buckets alone, or of all rows into one."""
    import re
    m = re.match(r"\w*Aggregate\(keys?=\[(.*?)\], functions", node)
    if not m:
        return False
    names = [re.sub(r"#.*", "", k.split(" AS ")[-1].strip().rstrip("]")) for k in re.split(r", (?![^(]*\))", m[1]) if k]
    return all(re.search(r"date|day|bucket|_match$|_t$", n) for n in names)


def _unguarded_single_partition_windows(plan: str) -> list[str]:
    """Single-partition exchanges feeding a window whose input reaches a scan
    without passing an aggregate (distinct / pivot): such a window would put
    fact-sized data into one task."""
    nodes, bad = _nodes(plan), []
    for i, (depth, text) in enumerate(nodes):
        if not (text.startswith("Exchange SinglePartition") and i
                and nodes[i - 1][1].startswith(("Sort", "Window"))):
            continue
        stack, j = [], i + 1
        while j < len(nodes) and nodes[j][0] > depth:
            d, t = nodes[j]
            while stack and stack[-1][0] >= d:
                stack.pop()
            stack.append((d, t))
            if "Scan" in t and not any(_grouped_by_calendar(s[1]) for s in stack):
                bad.append(text[:80])
            j += 1
    return bad


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_single_partition_window_over_fact_rows(spark, name):
    assert _unguarded_single_partition_windows(_plan(spark, name)) == []


def test_plan_check_flags_a_fact_sized_single_partition_window(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    from tidemark.operators.timeseries import forward_fill
    from tidemark.plans.bindings import load
    ev = load(spark, SF, "events")
    bad = ev.withColumn("v", F.last("value", ignorenulls=True).over(Window.orderBy("ts")))  # must be flagged
    assert _unguarded_single_partition_windows(bad._jdf.queryExecution().executedPlan().toString())
    # an aggregate that groups by a unique id bounds nothing
    worse = ev.groupBy("event_id").agg(F.max("ts").alias("ts")).withColumn("n", F.row_number().over(Window.orderBy("ts")))
    assert _unguarded_single_partition_windows(worse._jdf.queryExecution().executedPlan().toString())
    good = forward_fill(ev, "ts", ["value"])
    assert _unguarded_single_partition_windows(good._jdf.queryExecution().executedPlan().toString()) == []
