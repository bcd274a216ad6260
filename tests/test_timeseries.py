import datetime as dt
import random

from pyspark.sql import functions as F

from pyspark.sql import Window

from tidemark.operators.timeseries import forward_fill, pivot_wide, rank_by_value, rolling_std, row_index
from tests.conftest import rows

D = dt.date


def test_pivot_keeps_unknown_series_dates(spark):
    df = spark.createDataFrame([
        ("A", D(2024, 1, 1), 1.0), ("B", D(2024, 1, 1), 2.0), ("Z", D(2024, 1, 2), 9.0),
        ("A", D(2024, 1, 3), 3.0), ("A", D(2024, 1, 3), 4.0)], "k string, d date, v double")
    out = pivot_wide(df, ["d"], "k", "v", {"A": "a", "B": "b"})
    assert rows(out, "d", "a", "b") == [(D(2024, 1, 1), 1.0, 2.0), (D(2024, 1, 2), None, None),
                                        (D(2024, 1, 3), 4.0, None)]


def test_forward_fill_leading_gap_stays_null(spark):
    df = spark.createDataFrame([(D(2024, 1, 1), None), (D(2024, 1, 2), 5.0), (D(2024, 1, 3), None)],
                               "d date, v double")
    out = forward_fill(df, "d", ["v"])
    assert rows(out, "d", "v") == [(D(2024, 1, 1), None), (D(2024, 1, 2), 5.0), (D(2024, 1, 3), 5.0)]


def _random_series(spark, n=400, keys=3, seed=7):
    rnd = random.Random(seed)
    data = []
    for k in range(keys):
        day = D(2023, 1, 1)
        for i in range(n):
            day = day + dt.timedelta(days=rnd.randint(1, 9))
            v = rnd.random() if rnd.random() < 0.15 else None
            w = rnd.random() if rnd.random() < 0.05 else None
            data.append((k, day, v, w))
    return spark.createDataFrame(data, "k int, d date, v double, w double")


def test_two_pass_fill_equals_window_fill(spark):
    df = _random_series(spark)
    w = Window.partitionBy("k").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    one = df.select("k", "d", *[F.last(c, ignorenulls=True).over(w).alias(c) for c in ("v", "w")])
    two = forward_fill(df, "d", ["v", "w"], partition_by=["k"])
    assert rows(one, "k", "d", "v", "w") == rows(two, "k", "d", "v", "w")
    g1 = forward_fill(df.where("k = 0"), "d", {"v": "fv"})
    g2 = forward_fill(df.where("k = 0"), "d", {"v": "fv"}, bucket=F.date_trunc("quarter", "d"))
    assert rows(g1, "d", "fv") == rows(g2, "d", "fv")


def test_rolling_std_counts_rows_not_days(spark):
    df = spark.createDataFrame([("x", D(2024, 1, 1), 1.0), ("x", D(2024, 1, 20), 3.0),
                                ("y", D(2024, 1, 1), 5.0)], "a string, d date, p double")
    out = rolling_std(df, ["a"], ["d"], "p", {"v2": 2})
    got = {(r.a, r.d): r.v2 for r in out.collect()}
    assert got[("x", D(2024, 1, 1))] is None          # one row: NULL
    assert abs(got[("x", D(2024, 1, 20))] - 1.4142) < 1e-9  # gap of 19 days still 2 rows
    assert got[("y", D(2024, 1, 1))] is None


def test_rank_ties_share_rank_and_skip(spark):
    df = spark.createDataFrame([("a", 1, -2.0), ("b", 1, 2.0), ("c", 1, 1.0)], "s string, d int, p double")
    out = rank_by_value(df, ["d"], F.abs(F.col("p")), "r")
    assert rows(out, "s", "r") == [("a", 1), ("b", 1), ("c", 3)]
    assert dict(out.dtypes)["r"] == "bigint"


def _hot(spark, seed=11):
    rnd = random.Random(seed)
    data = []
    for a in range(5):
        n = 700 if a == 0 else rnd.randint(1, 60)   # asset 0 is hot
        day = D(2020, 1, 1)
        for i in range(n):
            day = day + dt.timedelta(days=rnd.randint(1, 3))
            v = None if rnd.random() < 0.05 else round(rnd.uniform(-5, 5), 2)
            data.append((a, day, v))
    return spark.createDataFrame(data, "a int, d date, p double")


def _brute_std(df, wins):
    import statistics
    by, out = {}, []
    for r in df.collect():
        by.setdefault(r.a, []).append((r.d, r.p))
    for a, vals in by.items():
        vals.sort()
        for i, (d, _) in enumerate(vals):
            row = [a, d]
            for n in wins.values():
                w = [p for _, p in vals[max(0, i - n + 1):i + 1] if p is not None]
                row.append(round(round(statistics.stdev(w), 9), 4) if len(w) > 1 else None)
            out.append(tuple(row))
    return out


def test_rolling_std_equals_brute_force_on_a_hot_key(spark):
    df = _hot(spark)
    wins = {"v7": 7, "v30": 30, "v90": 90}
    want = {(a, d): v for a, d, *v in _brute_std(df, wins)}
    for chunk_rows in (90, 100_000):
        got = rolling_std(df, ["a"], ["d"], "p", wins, chunk_rows=chunk_rows).collect()
        assert len(got) == len(want)
        for r in got:
            for g, w in zip((r.v7, r.v30, r.v90), want[(r.a, r.d)]):
                assert (g is None) == (w is None) and (g is None or abs(g - w) <= 1.01e-4)
    idx = row_index(df, ["a"], [F.col("d")], F.date_trunc("quarter", "d"), "i")
    assert idx.groupBy("a").agg(F.max("i").alias("m"), F.count("*").alias("c")) \
        .where("m != c").count() == 0


def test_rank_by_value_equals_window_on_hot_group_and_value(spark):
    rnd = random.Random(2)
    special = [None, float("nan"), float("inf"), float("-inf"), 0.0, 1e-9, -1e300]
    data = [(rnd.choice([0, 0, 0, 1, 2, None]),
             7.0 if rnd.random() < 0.5 else rnd.choice(special) if rnd.random() < 0.2 else float(rnd.randint(-30, 30)))
            for _ in range(2000)]
    df = spark.createDataFrame(data, "g int, x double").withColumn("id", F.monotonically_increasing_id())
    for desc in (True, False):
        o = F.col("x").desc() if desc else F.col("x").asc()
        w = Window.partitionBy("g").orderBy(o)
        for method, fn in (("rank", F.rank), ("dense_rank", F.dense_rank)):
            plain = df.withColumn("r", fn().over(w).cast("bigint"))
            assert rows(plain, "id", "r") == rows(rank_by_value(df, ["g"], F.col("x"), "r", desc, method), "id", "r")


def test_forward_fill_null_key_is_a_key(spark):
    df = spark.createDataFrame([(None, D(2024, 1, 1), 1.0), (None, D(2024, 3, 1), None), ("a", D(2024, 2, 1), None)],
                               "k string, d date, v double")
    assert rows(forward_fill(df, "d", ["v"], partition_by=["k"]), "k", "d", "v") == rows(
        spark.createDataFrame([(None, D(2024, 1, 1), 1.0), (None, D(2024, 3, 1), 1.0), ("a", D(2024, 2, 1), None)],
                              "k string, d date, v double"), "k", "d", "v")
    # any order will do, not only dates and timestamps
    assert rows(forward_fill(df, ["v", "d"], {"k": "last_k"}), "d", "last_k") == [
        (D(2024, 1, 1), "a"), (D(2024, 2, 1), "a"), (D(2024, 3, 1), "a")]


def _one_day(spark, n=3000):
    """A key with a third of all rows, inside one day."""
    rnd = random.Random(4)
    start = dt.datetime(2024, 1, 1)
    data = [(0, start + dt.timedelta(seconds=rnd.randrange(86400)), i, round(rnd.uniform(-5, 5), 2) if i % 4 else None)
            for i in range(n // 3)]
    data += [(1 + i % 40, start + dt.timedelta(hours=rnd.randrange(2000)), n + i, round(rnd.uniform(-5, 5), 2) if i % 4 else None)
             for i in range(n - n // 3)]
    rnd.shuffle(data)
    return spark.createDataFrame(data, "k int, ts timestamp_ntz, id int, v double").repartition(8)


def test_a_hot_key_inside_one_day_spreads_over_ranges(spark, monkeypatch):
    from tidemark.operators import ranges
    df = _one_day(spark)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        x = ranges.ranged(df, ["k"], ["ts", "id"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    per = {r["r"]: (r["n"], r["hot"]) for r in x.groupBy(ranges.range_of().alias("r")).agg(
        F.count("*").alias("n"), F.count_if(F.col("k") == 0).alias("hot")).collect()}
    assert len(per) == 4 and max(n for n, _ in per.values()) < 0.4 * df.count()
    assert sum(hot > 0 for _, hot in per.values()) >= 2
    placed = ranges.positions(x, "i").collect()
    assert [(r["k"], r["ts"], r["id"]) for r in sorted(placed, key=lambda r: r["i"])] == sorted((r["k"], r["ts"], r["id"]) for r in df.collect())
    assert sorted(r["i"] for r in placed) == list(range(df.count()))


def test_fill_and_rolling_over_ranges_equal_plain_windows(spark):
    df = _one_day(spark)
    w = Window.partitionBy("k").orderBy("ts", "id")
    plain = df.withColumn("f", F.last("v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        filled = forward_fill(df, ["ts", "id"], {"v": "f"}, partition_by=["k"])
        rolled = rolling_std(df, ["k"], ["ts", "id"], "v", {"s": 7}, chunk_rows=10)
        assert rows(filled, "id", "f") == rows(plain, "id", "f")
        sd = F.round(F.round(F.stddev_samp("v").over(w.rowsBetween(-6, 0)), 9), 4)
        got = {r["id"]: r["s"] for r in rolled.collect()}
        want = {r["id"]: r["s"] for r in df.withColumn("s", sd).collect()}
        assert got.keys() == want.keys()
        assert all((got[i] is None) == (s is None) and (s is None or abs(got[i] - s) <= 1.01e-4) for i, s in want.items())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_ranges_of_rows_with_maps_and_of_an_empty_table(spark):
    df = spark.createDataFrame([("a", 1, {"x": 1}), ("a", 2, None)], "k string, t int, m map<string,int>")
    assert rows(forward_fill(df, "t", {"t": "f"}, partition_by=["k"]), "t", "f") == [(1, 1), (2, 2)]
    assert forward_fill(df.limit(0), "t", {"t": "f"}, partition_by=["k"]).count() == 0
    assert rolling_std(df.limit(0), ["k"], ["t"], "t", {"s": 3}, chunk_rows=10).count() == 0
