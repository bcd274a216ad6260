import datetime as dt

from tidemark.operators.scd2 import empty_history, scd2_merge
from tests.conftest import rows

T1, T2 = "2024-01-15 00:00:00", "2024-02-01 00:00:00"
S = "k string, tier string, cap double"


def test_scd2_rules(spark):
    load1 = spark.createDataFrame([("same", "a", 1.0), ("chg", "a", 1.0), ("gone", "a", 1.0),
                                   ("n2v", "a", None), ("v2n", "a", 1.0)], S)
    load2 = spark.createDataFrame([("same", "a", 1.0), ("chg", "b", 1.0), ("new", "a", 2.0),
                                   ("n2v", "a", 5.0), ("v2n", "a", None)], S)
    h1 = scd2_merge(empty_history(spark, load1), load1, "k", ["tier", "cap"], T1)
    assert h1.count() == 5 and h1.where("valid_to is null").count() == 5
    h2 = scd2_merge(h1, load2, "k", ["tier", "cap"], T2)
    t1, t2 = dt.datetime(2024, 1, 15), dt.datetime(2024, 2, 1)
    got = rows(h2, "k", "tier", "cap", "valid_from", "valid_to")
    assert got == sorted([
        ("chg", "a", 1.0, t1, t2), ("chg", "b", 1.0, t2, None),
        ("gone", "a", 1.0, t1, None),
        ("n2v", "a", None, t1, t2), ("n2v", "a", 5.0, t2, None),
        ("new", "a", 2.0, t2, None),
        ("same", "a", 1.0, t1, None),
        ("v2n", "a", 1.0, t1, t2), ("v2n", "a", None, t2, None)],
        key=lambda t: tuple((x is None, str(x)) for x in t))
    # applying the same snapshot again changes nothing
    h3 = scd2_merge(h2, load2, "k", ["tier", "cap"], "2024-03-01 00:00:00")
    assert rows(h3) == rows(h2)
    assert h2.select("scd_id").distinct().count() == h2.count()


def test_scd2_null_key_fails(spark):
    import pytest
    src = spark.createDataFrame([(None, "a", 1.0)], S)
    with pytest.raises(Exception, match="NOT NULL"):
        scd2_merge(empty_history(spark, src), src, "k", ["tier", "cap"], T1).collect()


def test_scd2_snapshot_on_storage_equals_in_memory(spark, tmp_root):
    from tidemark.operators.scd2 import scd2_snapshot
    load1 = spark.createDataFrame([("same", "a", 1.0), ("chg", "a", 1.0), ("gone", "a", 1.0)], S)
    load2 = spark.createDataFrame([("same", "a", 1.0), ("chg", "b", 1.0), ("new", "a", 2.0)], S)
    base = f"{tmp_root}/hist"
    scd2_snapshot(load1, base, "k", ["tier", "cap"], T1)
    stored = scd2_snapshot(load2, base, "k", ["tier", "cap"], T2)
    again = scd2_snapshot(load2, base, "k", ["tier", "cap"], T2)  # a retried run: no duplicates
    h1 = scd2_merge(empty_history(spark, load1), load1, "k", ["tier", "cap"], T1)
    mem = scd2_merge(h1, load2, "k", ["tier", "cap"], T2)
    cols = ["k", "tier", "cap", "scd_id", "valid_from", "valid_to"]
    assert rows(stored, *cols) == rows(mem, *cols)
    assert again.count() == mem.count()
