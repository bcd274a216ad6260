import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators.relational import conform_union
from tidemark.operators.sinks import (
    incremental_merge,
    incremental_window_merge,
    read_current,
    upsert,
    write_version,
)
from tidemark.schemas import ddl
from tests.conftest import rows

D = dt.date
T0, T1 = "2024-01-01 00:00:00", "2024-02-01 00:00:00"


def _target(spark):
    return spark.createDataFrame([("A", D(2024, 1, 1), 1.0), ("A", D(2024, 1, 2), 2.0),
                                  ("B", D(2024, 1, 1), 3.0)], "s string, d date, v double") \
        .withColumn("loaded_at", F.lit(T0).cast("timestamp_ntz"))


def test_upsert_matched_inserted_kept_and_idempotent(spark):
    src = spark.createDataFrame([("A", D(2024, 1, 2), 20.0), ("C", D(2024, 1, 1), 5.0)],
                                "s string, d date, v double")
    once = upsert(_target(spark), src, ["s", "d"], stamp=("loaded_at", T1))
    twice = upsert(once, src, ["s", "d"], stamp=("loaded_at", T1))
    expect = [("A", D(2024, 1, 1), 1.0), ("A", D(2024, 1, 2), 20.0), ("B", D(2024, 1, 1), 3.0),
              ("C", D(2024, 1, 1), 5.0)]
    assert rows(once, "s", "d", "v") == expect
    assert rows(twice, "s", "d", "v", "loaded_at") == rows(once, "s", "d", "v", "loaded_at")
    stamps = {(r.s, r.d): r.loaded_at for r in once.collect()}
    assert stamps[("A", D(2024, 1, 1))] == dt.datetime(2024, 1, 1)
    assert stamps[("A", D(2024, 1, 2))] == dt.datetime(2024, 2, 1)


def test_upsert_duplicate_source_key_later_wins(spark):
    src = spark.createDataFrame([("A", D(2024, 1, 2), 7.0, 1), ("A", D(2024, 1, 2), 8.0, 2)],
                                "s string, d date, v double, seq int")
    out = upsert(_target(spark), src, ["s", "d"], order=["seq"])
    assert [r.v for r in out.where("s = 'A' and d = '2024-01-02'").collect()] == [8.0]


def test_upsert_null_key_is_inserted(spark):
    src = spark.createDataFrame([(None, D(2024, 1, 2), 9.0)], "s string, d date, v double")
    out = upsert(_target(spark), src, ["s", "d"])
    assert out.count() == 4


def test_upsert_schema_evolution_and_partial_update(spark):
    src = spark.createDataFrame([("A", D(2024, 1, 1), 10.0, "Alpha")], "s string, d date, v double, name string")
    out = upsert(_target(spark), src, ["s", "d"])
    assert out.columns == ["s", "d", "v", "loaded_at", "name"]
    assert rows(out.where("s = 'B'"), "name") == [(None,)]
    part = upsert(_target(spark), src, ["s", "d"], update_cols=["name"])
    got = {(r.s, r.d): (r.v, r.name) for r in part.collect()}
    assert got[("A", D(2024, 1, 1))] == (1.0, "Alpha")   # v not in update_cols
    assert got[("B", D(2024, 1, 1))] == (3.0, None)


def test_incremental_merge_empty_target_is_full_load(spark):
    empty = spark.createDataFrame([], "s string, d date, v double")
    src = spark.createDataFrame([("A", D(2024, 1, 1), 1.0)], "s string, d date, v double")
    assert incremental_merge(empty, src, ["s", "d"], "d").count() == 1


def test_incremental_merge_mark_and_lookback(spark):
    tgt = spark.createDataFrame([("A", D(2024, 1, 5), 1.0)], "s string, d date, v double")
    src = spark.createDataFrame([("A", D(2024, 1, 5), 2.0), ("B", D(2024, 1, 3), 3.0),
                                 ("A", D(2024, 1, 6), 4.0)], "s string, d date, v double")
    out = incremental_merge(tgt, src, ["s", "d"], "d")
    assert rows(out, "s", "d", "v") == [("A", D(2024, 1, 5), 2.0), ("A", D(2024, 1, 6), 4.0)]
    late = incremental_merge(tgt, src, ["s", "d"], "d", lookback_days=3)
    assert ("B", D(2024, 1, 3), 3.0) in rows(late, "s", "d", "v")
    per_key = incremental_merge(tgt, src, ["s", "d"], "d", mark_by=["s"])
    assert ("B", D(2024, 1, 3), 3.0) in rows(per_key, "s", "d", "v")


def test_incremental_window_merge_equals_full_refresh(spark):
    from tidemark.operators.timeseries import rolling_std
    data = [(a, D(2024, 1, 1) + dt.timedelta(days=i), float((i * 7 + a * 3) % 11))
            for a in range(3) for i in range(40)]
    src = spark.createDataFrame(data, "a int, d date, p double")

    def compute(df):
        return rolling_std(df, ["a"], ["d"], "p", {"v5": 5})
    full = compute(src)
    first = compute(src.where(F.col("d") < F.lit(D(2024, 1, 30))))
    inc = incremental_window_merge(first, src, ["a", "d"], "d", ["a"], 4, compute)
    assert rows(inc, "a", "d", "v5") == rows(full, "a", "d", "v5")


def test_write_version_and_read_current(spark, tmp_root):
    schema = ddl("s string, v double")
    base = f"{tmp_root}/t"
    assert read_current(spark, base, schema).count() == 0
    write_version(spark.createDataFrame([("a", 1.0)], schema), base)
    write_version(spark.createDataFrame([("b", 2.0), ("c", 3.0)], schema), base)
    assert rows(read_current(spark, base), "s") == [("b",), ("c",)]


def test_conform_union_pads_and_rejects(spark):
    schema = ddl("a string, b double")
    x = spark.createDataFrame([("x",)], "a string")
    out = conform_union([x, spark.createDataFrame([("y", 1.0)], "a string, b double")], schema)
    assert rows(out) == [("x", None), ("y", 1.0)]
    import pytest
    with pytest.raises(ValueError):
        conform_union([spark.createDataFrame([("x", 1)], "a string, c int")], schema)


def test_null_key_rows_are_never_merged_together(spark):
    src = spark.createDataFrame([(None, D(2024, 1, 2), 9.0, 1), (None, D(2024, 1, 2), 8.0, 2)],
                                "s string, d date, v double, seq int")
    out = upsert(_target(spark), src, ["s", "d"], order=["seq"])
    assert out.where("s is null").count() == 2


def test_write_version_skips_incomplete(spark, tmp_root):
    import os
    schema = ddl("s string")
    base = f"{tmp_root}/t2"
    write_version(spark.createDataFrame([("a",)], schema), base)
    os.makedirs(f"{base}/v=00000002")  # a failed job left this behind, no _SUCCESS
    assert rows(read_current(spark, base)) == [("a",)]
    write_version(spark.createDataFrame([("b",)], schema), base)
    assert rows(read_current(spark, base)) == [("b",)]


def test_replace_partitions_from_keeps_older_and_drops_vanished(spark, tmp_root):
    from tidemark.operators.sinks import replace_partitions_from, write_table
    schema = ddl("k string, d date, v double")
    path = f"{tmp_root}/p"
    write_table(spark.createDataFrame([("a", D(2024, 1, 1), 1.0), ("a", D(2024, 1, 2), 2.0),
                                       ("a", D(2024, 1, 3), 3.0)], schema), path, ["d"], replace_all=True)
    new = spark.createDataFrame([("a", D(2024, 1, 2), 20.0)], schema)  # day 3 vanished
    replace_partitions_from(new, path, "d", D(2024, 1, 2))
    got = rows(spark.read.parquet(path), "k", "d", "v")
    assert got == [("a", D(2024, 1, 1), 1.0), ("a", D(2024, 1, 2), 20.0)]


def test_partition_writes_keep_null_partitions(spark, tmp_root):
    from tidemark.operators.sinks import merge_partitions, replace_partitions_from
    schema = ddl("k string, d date, v double")
    path = f"{tmp_root}/n"

    def load(*data):
        return spark.createDataFrame(list(data), schema)
    merge_partitions(load(("a", None, 1.0), ("b", D(2024, 1, 1), 2.0)), path, ["k", "d"], "d", schema)
    merge_partitions(load(("c", None, 3.0), ("b", D(2024, 1, 1), 4.0)), path, ["k", "d"], "d", schema)
    want = [("a", None, 1.0), ("b", D(2024, 1, 1), 4.0), ("c", None, 3.0)]
    assert rows(spark.read.schema(schema).parquet(path), "k", "d", "v") == want
    # without a NULL in the source the NULL partition is neither read nor written
    merge_partitions(load(("e", D(2024, 1, 2), 5.0)), path, ["k", "d"], "d", schema)
    replace_partitions_from(load(("f", D(2024, 1, 3), 6.0)), path, "d", D(2024, 1, 2))
    assert rows(spark.read.schema(schema).parquet(path), "k", "d", "v") == sorted(
        want + [("f", D(2024, 1, 3), 6.0)])
    replace_partitions_from(load(("g", None, 7.0)), path, "d", D(2024, 1, 2))  # reloads NULLs, empties the rest
    assert rows(spark.read.schema(schema).parquet(path), "k", "d", "v") == [("b", D(2024, 1, 1), 4.0), ("g", None, 7.0)]


def test_old_versions_are_dropped(spark, tmp_root):
    import os
    from tidemark.operators.sinks import drop_old_versions
    schema = ddl("s string")
    base = f"{tmp_root}/old"
    for s in "abcd":
        write_version(spark.createDataFrame([(s,)], schema), base)
    drop_old_versions(spark, base, keep=2)
    assert sorted(os.listdir(base)) == ["v=00000003", "v=00000004"]
    assert rows(read_current(spark, base)) == [("d",)]


def test_enrich_fails_on_a_repeated_dimension_key(spark):
    import pytest
    from tidemark.operators.relational import enrich
    fact = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, x int")
    dim = spark.createDataFrame([("a", "A"), (None, "n1"), (None, "n2")], "k string, name string")
    assert rows(enrich(fact, dim, "k"), "x", "name") == [(1, "A"), (2, None), (3, None)]
    twice = dim.union(spark.createDataFrame([("a", "B")], "k string, name string"))
    with pytest.raises(Exception, match="duplicate key"):
        enrich(fact, twice, "k").collect()


def test_enrich_leaves_a_skewed_key_to_be_split(spark):
    from tidemark.operators.relational import enrich
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k"}
    fact = spark.range(40_000, numPartitions=4).selectExpr("if(id % 2 = 0, 7, id % 100) AS k", "uuid() AS payload", "id")
    dim = spark.range(100).selectExpr("id AS k", "concat('n', id) AS name")
    before = {c: spark.conf.get(c, None) for c in conf}
    try:
        for c, v in conf.items():
            spark.conf.set(c, v)
        out = enrich(fact, dim, "k")
        assert out.where("name = concat('n', k)").count() == 40_000
        plan = out.agg(F.max("payload"), F.max("name"))
        plan.collect()
        assert "skew=true" in plan._jdf.queryExecution().executedPlan().toString()
    finally:
        for c, v in before.items():
            spark.conf.unset(c) if v is None else spark.conf.set(c, v)


def test_marks_are_kept_with_versions(spark, tmp_root):
    from tidemark.operators.sinks import current_mark, stored_incremental_merge, write_marked_version
    schema = ddl("s string, d date, v double")
    base = f"{tmp_root}/marked"
    assert current_mark(spark, base) is None

    def load(*data):
        return spark.createDataFrame(list(data), schema)
    assert write_marked_version(load(), base, "d") is None and current_mark(spark, base) is None
    days = [D(2024, 1, k) for k in range(1, 6)]
    # an empty target loads everything
    stored_incremental_merge(load(("a", days[0], 1.0), ("a", days[2], 3.0), ("n", None, 9.0)), base, schema, ["s", "d"], "d")
    assert current_mark(spark, base) == days[2]
    # rows before the mark are not merged, rows on it are
    again = load(("a", days[0], -1.0), ("a", days[2], 30.0), ("b", days[4], 5.0))
    out = stored_incremental_merge(again, base, schema, ["s", "d"], "d")
    assert rows(out, "s", "d", "v") == [("a", days[0], 1.0), ("a", days[2], 30.0), ("b", days[4], 5.0), ("n", None, 9.0)]
    assert current_mark(spark, base) == days[4]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ubquery" not in plan
    # going back over two days takes the late row in
    out = stored_incremental_merge(load(("c", days[3], 4.0)), base, schema, ["s", "d"], "d", lookback_days=2)
    assert ("c", days[3], 4.0) in rows(out, "s", "d", "v") and current_mark(spark, base) == days[4]


def _windowed(df):
    from pyspark.sql import Window
    w = Window.partitionBy("k").orderBy("d").rowsBetween(-3, 0)
    return df.withColumn("s", F.sum("v").over(w))


def test_stored_windows_equal_a_full_rebuild(spark, tmp_root):
    import random
    from tidemark.operators.sinks import current_mark, read_current, stored_window_increment
    rnd = random.Random(1)
    schema = ddl("k string, d date, v double, s double")
    data = [(k, D(2024, 1, 1 + i), float(rnd.randrange(100))) for k in "abc" for i in range(28) if rnd.random() < (0.3 if k == "c" else 0.9)]
    kw = dict(path=f"{tmp_root}/t", state=f"{tmp_root}/s", schema=schema, keys=["k"], date_col="d", by=["k"],
              context_rows=3, compute=_windowed)

    def upto(day):
        return spark.createDataFrame([r for r in data if r[1] <= D(2024, 1, day)], "k string, d date, v double")
    for day in (5, 6, 6, 15, 28):
        source = upto(day)
        out = stored_window_increment(source, lookback_days=2, **kw)
        assert rows(out, "k", "d", "s") == rows(_windowed(source), "k", "d", "s")
    state = read_current(spark, f"{tmp_root}/s")
    cut = current_mark(spark, f"{tmp_root}/s")
    assert cut == max(r[1] for r in data) - dt.timedelta(days=2)
    assert state.where(F.col("d") >= F.lit(cut)).count() == 0 and state.groupBy("k").count().where("count > 3").count() == 0
    # history before the cut is not read: rows that vanished there change nothing
    recent = spark.createDataFrame([r for r in data if r[1] >= cut], "k string, d date, v double")
    out = stored_window_increment(recent, lookback_days=2, **kw)
    assert rows(out, "k", "d", "s") == rows(_windowed(upto(28)), "k", "d", "s")
    # a late row inside the lookback, then one before the cut, which reads the source again
    late = ("c", D(2024, 1, 27), 1000.0)
    source = spark.createDataFrame([r for r in data if r[:2] != late[:2]] + [late], "k string, d date, v double")
    out = stored_window_increment(source, lookback_days=2, **kw)
    assert rows(out, "k", "d", "s") == rows(_windowed(source), "k", "d", "s")
    late = ("c", D(2024, 1, 12), 500.0)
    source = source.where(~((F.col("k") == "c") & (F.col("d") == F.lit(late[1])))).union(
        spark.createDataFrame([late], "k string, d date, v double"))
    out = stored_window_increment(source, lookback_days=20, **kw)
    assert rows(out, "k", "d", "s") == rows(_windowed(source), "k", "d", "s")


def test_building_incremental_plans_runs_no_job(spark):
    tgt = spark.createDataFrame([("A", D(2024, 1, 5), 1.0)], "s string, d date, v double")
    spark.sparkContext.setJobGroup("build-only", "plans only")
    incremental_merge(tgt, tgt, ["s", "d"], "d", lookback_days=1)
    incremental_window_merge(tgt, tgt, ["s", "d"], "d", ["s"], 3, lambda x: x)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("build-only")
    spark.sparkContext._jsc.clearJobGroup()


def test_checkpoint_folder_must_be_named_on_a_cluster(spark, monkeypatch):
    import pytest
    from tidemark import session

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Session())
