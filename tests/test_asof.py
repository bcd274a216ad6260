import datetime as dt
import random

from pyspark.sql import functions as F

from tidemark.operators.asof import asof_join
from tests.conftest import rows

D = dt.date


def _macro(spark):
    return spark.createDataFrame([(D(2024, 1, 3), 1.0), (D(2024, 1, 6), 2.0), (D(2024, 1, 9), None)],
                                 "od date, rate double")


def test_unkeyed_before_equal_between(spark):
    left = spark.createDataFrame([(1, D(2024, 1, 1)), (2, D(2024, 1, 3)), (3, D(2024, 1, 5)),
                                  (4, D(2024, 1, 10)), (5, None)], "id int, pd date")
    out = asof_join(left, _macro(spark), "pd", "od", flag_col="has")
    assert rows(out, "id", "od", "rate", "has") == [
        (1, None, None, False), (2, D(2024, 1, 3), 1.0, True), (3, D(2024, 1, 3), 1.0, True),
        (4, D(2024, 1, 9), None, True), (5, None, None, False)]


def _brute(left, right):
    out = []
    for lk, lt, lid in left:
        cands = [r for r in right if r[0] == lk and lk is not None and lt is not None and r[1] <= lt]
        best = max(cands, key=lambda r: r[1]) if cands else None
        out.append((lid, best[1] if best else None, best[2] if best else None))
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_keyed_equals_brute_force_and_bucketed(spark):
    rnd = random.Random(3)
    left, right, seen = [], [], set()
    for i in range(600):
        k = rnd.choice([0, 0, 0, 1, 2, None])  # key 0 is hot
        left.append((k, D(2023, 1, 1) + dt.timedelta(days=rnd.randint(0, 700)), i))
    for _ in range(300):
        k = rnd.choice([0, 1, 2, 3])
        t = D(2023, 1, 1) + dt.timedelta(days=rnd.randint(0, 700))
        if (k, t) not in seen:
            seen.add((k, t))
            right.append((k, t, rnd.random()))
    L = spark.createDataFrame(left, "k int, t date, id int")
    R = spark.createDataFrame(right, "k int, rt date, x double")
    expect = _brute(left, right)
    plain = asof_join(L, R, "t", "rt", by=["k"], right_cols=["rt", "x"])
    assert rows(plain, "id", "rt", "x") == expect
    bucketed = asof_join(L, R, "t", "rt", by=["k"], right_cols=["rt", "x"],
                         bucket=lambda c: F.date_trunc("month", c))
    assert rows(bucketed, "id", "rt", "x") == expect


def test_time_map_equals_keyed_form(spark):
    rnd = random.Random(5)
    left = [(D(2020, 1, 1) + dt.timedelta(days=rnd.randint(0, 900)), i) for i in range(500)]
    right = sorted({D(2020, 1, 1) + dt.timedelta(days=rnd.randint(0, 900)) for _ in range(60)})
    L = spark.createDataFrame(left, "t date, id int").withColumn("one", F.lit(1))
    R = spark.createDataFrame([(d, float(i)) for i, d in enumerate(right)], "rt date, x double") \
        .withColumn("one", F.lit(1))
    a = asof_join(L.drop("one"), R.drop("one"), "t", "rt")
    b = asof_join(L, R, "t", "rt", by=["one"], right_cols=["rt", "x"])
    c = asof_join(L.drop("one"), R.drop("one"), "t", "rt", bucket=lambda x: F.date_trunc("year", x))
    assert rows(a, "id", "rt", "x") == rows(b, "id", "rt", "x") == rows(c, "id", "rt", "x")


def test_plan_has_no_nested_loop_or_cartesian(spark):
    L = spark.range(100).select(F.col("id"), F.date_add(F.lit(D(2024, 1, 1)), F.col("id").cast("int")).alias("t"))
    R = spark.range(10).select(F.date_add(F.lit(D(2024, 1, 1)), (F.col("id") * 7).cast("int")).alias("rt"),
                               F.col("id").alias("x"))
    for out in (asof_join(L, R, "t", "rt"), asof_join(L.withColumn("k", F.lit(1)),
                                                     R.withColumn("k", F.lit(1)), "t", "rt", by=["k"])):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_unkeyed_timestamps_auto_bucket_equals_brute_force(spark):
    rnd = random.Random(9)
    t0 = dt.datetime(2024, 1, 1)
    left = [(t0 + dt.timedelta(minutes=rnd.randint(0, 6000)), i) for i in range(300)]
    right = sorted({t0 + dt.timedelta(minutes=rnd.randint(0, 6000)) for _ in range(40)})
    L = spark.createDataFrame(left, "t timestamp_ntz, id int")
    R = spark.createDataFrame([(t, float(i)) for i, t in enumerate(right)], "rt timestamp_ntz, x double")
    out = asof_join(L, R, "t", "rt", flag_col="has")  # auto: day buckets, time map
    expect = []
    for t, i in left:
        c = [r for r in right if r <= t]
        best = max(c) if c else None
        expect.append((i, best, float(right.index(best)) if best else None, best is not None))
    key = lambda t: tuple((x is None, str(x)) for x in t)
    assert rows(out, "id", "rt", "x", "has") == sorted(expect, key=key)


def test_keyed_hot_key_and_time_equals_brute_force(spark):
    rnd = random.Random(4)
    left = [(0, D(2024, 1, 1) + dt.timedelta(days=rnd.choice([5, rnd.randint(0, 60)])), i) for i in range(400)]
    right = [(0, D(2024, 1, 1) + dt.timedelta(days=d), float(d)) for d in range(0, 60, 7)]
    L = spark.createDataFrame(left, "k int, t date, id int")
    R = spark.createDataFrame(right, "k int, rt date, x double")
    out = asof_join(L, R, "t", "rt", by=["k"], right_cols=["rt", "x"])
    assert rows(out, "id", "rt", "x") == _brute(left, right)
    # the key itself may be attached, and NULL keys or times match nothing
    L2 = L.union(spark.createDataFrame([(None, D(2024, 2, 1), 900), (0, None, 901)], "k int, t date, id int"))
    got = {r.id: r.x for r in asof_join(L2, R, "t", "rt", by=["k"], right_cols=["x"]).collect()}
    assert got[900] is None and got[901] is None and len(got) == 402
