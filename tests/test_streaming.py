import datetime as dt
import os

from tidemark.operators.sinks import read_current
from tidemark.schemas import ddl
from tidemark.streaming import stream_upsert
from tests.conftest import rows

SRC = ddl("symbol string, trade_date date, close double, seq bigint")
TGT = ddl("symbol string, trade_date date, close double, seq bigint, loaded_at timestamp_ntz")


def test_stream_upsert_available_now(spark, tmp_root):
    landing, target, ckpt = f"{tmp_root}/landing", f"{tmp_root}/target", f"{tmp_root}/ckpt"
    os.makedirs(landing)
    d1, d2 = dt.date(2024, 1, 2), dt.date(2024, 1, 3)
    spark.createDataFrame([("A", d1, 1.0, 1), ("B", d1, 2.0, 1)], SRC).write.parquet(f"{landing}/b1")
    q = stream_upsert(spark, f"{landing}/*", SRC, target, TGT, ["symbol", "trade_date"], ckpt,
                      order=["seq"], stamp=("loaded_at", "2024-02-01 00:00:00"))
    q.awaitTermination(120)
    spark.createDataFrame([("A", d1, 5.0, 2), ("A", d1, 6.0, 3), ("A", d2, 7.0, 1)], SRC) \
        .write.parquet(f"{landing}/b2")
    q = stream_upsert(spark, f"{landing}/*", SRC, target, TGT, ["symbol", "trade_date"], ckpt,
                      order=["seq"], stamp=("loaded_at", "2024-02-01 00:00:00"))
    q.awaitTermination(120)
    out = read_current(spark, target)
    assert rows(out, "symbol", "trade_date", "close") == [("A", d1, 6.0), ("A", d2, 7.0), ("B", d1, 2.0)]


def test_stream_upsert_partitioned_touches_only_batch_partitions(spark, tmp_root):
    landing, target, ckpt = f"{tmp_root}/landing", f"{tmp_root}/target", f"{tmp_root}/ckpt"
    os.makedirs(landing)
    d1, d2, d3 = dt.date(2024, 1, 2), dt.date(2024, 1, 3), dt.date(2024, 1, 4)
    spark.createDataFrame([("A", d1, 1.0, 1), ("B", d1, 2.0, 1), ("A", d2, 3.0, 1)], SRC) \
        .write.parquet(f"{landing}/b1")
    kw = dict(order=["seq"], stamp=("loaded_at", "2024-02-01 00:00:00"), partition_col="trade_date")
    stream_upsert(spark, f"{landing}/*", SRC, target, TGT, ["symbol", "trade_date"], ckpt, **kw) \
        .awaitTermination(120)
    before = {p for p in os.listdir(target) if p.startswith("trade_date=")}
    mtime_d1 = os.path.getmtime(f"{target}/trade_date=2024-01-02")
    spark.createDataFrame([("A", d2, 5.0, 2), ("C", d3, 7.0, 1)], SRC).write.parquet(f"{landing}/b2")
    stream_upsert(spark, f"{landing}/*", SRC, target, TGT, ["symbol", "trade_date"], ckpt, **kw) \
        .awaitTermination(120)
    out = spark.read.parquet(target)
    assert rows(out, "symbol", "trade_date", "close") == [
        ("A", d1, 1.0), ("A", d2, 5.0), ("B", d1, 2.0), ("C", d3, 7.0)]
    assert before == {"trade_date=2024-01-02", "trade_date=2024-01-03"}
    assert os.path.getmtime(f"{target}/trade_date=2024-01-02") == mtime_d1  # untouched


def test_a_batch_is_committed_once_and_two_versions_stay(spark, tmp_root):
    from tidemark.streaming.upsert_stream import committed_batches, merge_batch
    target, day = f"{tmp_root}/t", dt.date(2024, 1, 2)

    def batch(*data):
        return spark.createDataFrame([(s, day, c, q) for s, c, q in data], SRC)
    merge = merge_batch(target, TGT, ["symbol", "trade_date"], order=["seq"], stamp=("loaded_at", "2024-02-01 00:00:00"), stream="s1")
    merge(batch(("A", 1.0, 1)), 0)
    merge(batch(("A", 2.0, 1), ("B", 3.0, 1)), 1)
    merge(batch(("Z", 9.0, 1)), 1)      # delivered again, with other keys
    merge(batch(("Z", 9.0, 1)), 0)
    assert rows(read_current(spark, target), "symbol", "close") == [("A", 2.0), ("B", 3.0)]
    merge(batch(("C", 4.0, 1)), 2)
    other = merge_batch(target, TGT, ["symbol", "trade_date"], stamp=("loaded_at", "2024-02-01 00:00:00"), stream="s2")
    other(batch(("D", 5.0, 1)), 0)      # another stream counts its own batches
    assert rows(read_current(spark, target), "symbol", "close") == [("A", 2.0), ("B", 3.0), ("C", 4.0), ("D", 5.0)]
    assert committed_batches(spark, target) == {"s1": 2, "s2": 0}
    assert sorted(os.listdir(target)) == ["v=00000003", "v=00000004"]
    # a version without its marker was never committed: the batch runs again
    os.remove(f"{target}/v=00000004/_SUCCESS")
    assert committed_batches(spark, target) == {"s1": 2}
    other(batch(("E", 6.0, 1)), 0)
    assert rows(read_current(spark, target), "symbol") == [("A",), ("B",), ("C",), ("E",)]


def test_partitioned_batches_are_committed_once(spark, tmp_root):
    from tidemark.streaming.upsert_stream import merge_batch
    target = f"{tmp_root}/p"
    merge = merge_batch(target, TGT, ["symbol", "trade_date"], stamp=("loaded_at", "2024-02-01 00:00:00"),
                        partition_col="trade_date", stream="s")
    merge(spark.createDataFrame([("A", dt.date(2024, 1, 2), 1.0, 1)], SRC), 0)
    merge(spark.createDataFrame([("B", dt.date(2024, 1, 3), 1.0, 1)], SRC), 0)
    assert rows(spark.read.parquet(target), "symbol") == [("A",)]
