"""Exact top-k inner-product search with KD-trees over shards dealt by space.

A bounded sample of the vectors is split at the median of its widest dimension
until there is a cell for every ``SHARD_ROWS`` vectors (at most ``MAX_CELLS``).
Every vector goes to its cell, and a cell that holds more is dealt on by a hash
of the id, so that equal vectors do not make a large shard. The tight box of
every cell, over all its vectors, is known everywhere (one row a cell).

Each shard has its own KD-tree: median splits of the widest dimension down to
leaves, with the tight bounding box of every node. The largest inner product
that a query can reach inside a box bounds all that is below it. A query walks a
tree best bound first and stops when the best bound left is under its k-th score.

The k-th score is propagated: each query first searches the shard it lies in.
Then it is sent to the shards of those cells alone whose box bound reaches the
k-th score found there, and takes that score along. Ties at the k-th score are
kept until the last merge.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored

SHARD_ROWS = 8192        # vectors of a shard, on average at most
QUERY_ROWS = 16384       # queries that one task searches a shard for, on average at most
LEAF_ROWS = 64
SAMPLE_ROWS = 16384      # vectors that the cells are fitted on, and no more
SAMPLE_VALUES = 1 << 20  # than so many components of the longest ones
MAX_CELLS = 1024         # cells of one vector length; their boxes go to every task
EXACT = 2 ** 53          # sums under this are exact in floating point
LONG = 2 ** 63


def bounds(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """At least the largest inner product of each query inside each box (whole
    numbers as doubles). Sums past 2**53 are raised by what rounding may take."""
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    with np.errstate(over="ignore", invalid="ignore"):
        best = up @ high.T + down @ low.T
        size = np.abs(queries) @ np.maximum(np.abs(low), np.abs(high)).T
        best = np.where(size < EXACT, best, best + size * (low.shape[1] + 4) * 2.0 ** -51)
    return np.where(np.isnan(best), np.inf, best)


def scores(points: np.ndarray, query: np.ndarray, size: float) -> np.ndarray:
    """Exact inner products as longs; ``size`` bounds the sum of their terms'
    sizes. A score that a long cannot hold fails the job."""
    if size < EXACT:
        return (points @ query).astype(np.int64)
    if size < LONG:
        return points.astype(np.int64) @ query.astype(np.int64)
    q = [int(x) for x in query.tolist()]
    found = [sum(a * int(b) for a, b in zip(q, p)) for p in points.tolist()]
    if any(not -LONG <= s < LONG for s in found):
        raise OverflowError("an inner product does not fit in a long")
    return np.array(found, np.int64)


class Tree:
    """A KD-tree over the rows of a matrix of whole numbers."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, leaf_rows: int):
        self.low, self.high, self.span, self.children = [], [], [], []
        self.leaf_rows = leaf_rows
        order = np.arange(len(points))
        self._build(points, order, 0, len(points))
        self.low, self.high = np.array(self.low), np.array(self.high)
        self.points, self.ids = points[order], ids[order]
        self.most = np.maximum(np.abs(self.low[0]), np.abs(self.high[0]))

    def _build(self, points, order, start, stop) -> int:
        part = points[order[start:stop]]
        node = len(self.span)
        self.low.append(part.min(0))
        self.high.append(part.max(0))
        self.span.append((start, stop))
        self.children.append(None)
        if stop - start > self.leaf_rows and part.shape[1]:
            wide = int((self.high[node] - self.low[node]).argmax())
            middle = (stop - start) // 2
            order[start:stop] = order[start:stop][np.argpartition(part[:, wide], middle)]
            self.children[node] = (self._build(points, order, start, start + middle),
                                   self._build(points, order, start + middle, stop))
        return node

    def search(self, query: np.ndarray, own: int, bound: list[float], k: int, least: int | None) -> tuple:
        """(ids, scores) of the best k, and of nothing below ``least``; rows with
        the id ``own`` are left out."""
        with np.errstate(over="ignore"):
            size = float(np.abs(query) @ self.most)
        ids, found = np.zeros(0, np.int64), np.zeros(0, np.int64)
        heap, take = [(-bound[0], 0)], 1
        while heap and (least is None or -heap[0][0] >= least):
            leaves = []
            while heap and len(leaves) < take and (least is None or -heap[0][0] >= least):
                _, node = heappop(heap)
                if self.children[node] is None:
                    leaves.append(node)
                else:
                    for child in self.children[node]:
                        heappush(heap, (-bound[child], child))
            take *= 2
            at = np.concatenate([np.arange(*self.span[n]) for n in leaves]) if leaves else np.zeros(0, np.int64)
            at = at[self.ids[at] != own]
            new = scores(self.points[at], query, size)
            keep = slice(None) if least is None else new >= least
            ids, found = np.append(ids, self.ids[at][keep]), np.append(found, new[keep])
            if len(ids) > k:
                best = np.lexsort((ids, -found))[:k]
                ids, found = ids[best], found[best]
            if len(ids) == k:
                least = int(found.min()) if least is None else max(least, int(found.min()))
        return ids, found


class Cells:
    """Median splits of a sample into at most ``n`` cells."""

    def __init__(self, sample: np.ndarray, n: int):
        self.splits: list[tuple | int] = []
        self.count = 0
        self._build(sample, n)

    def _build(self, part: np.ndarray, n: int) -> int:
        node = len(self.splits)
        self.splits.append(0)
        spread = part.max(0) - part.min(0) if len(part) > 1 and part.shape[1] else np.zeros(1)
        if n < 2 or not spread.max() > 0:
            self.splits[node] = self.count
            self.count += 1
            return node
        wide = int(spread.argmax())
        middle = float(np.sort(part[:, wide])[len(part) // 2])
        if middle == part[:, wide].min():  # more than half are the smallest: they make one side
            middle = float(part[:, wide][part[:, wide] > middle].min())
        below = part[:, wide] < middle
        left = self._build(part[below], n // 2)
        right = self._build(part[~below], n - n // 2)
        self.splits[node] = (wide, middle, left, right)
        return node

    def of(self, points: np.ndarray) -> np.ndarray:
        """The cell of each row."""
        out = np.zeros(len(points), np.int32)
        todo = [(0, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            split = self.splits[node]
            if isinstance(split, int):
                out[rows] = split
            else:
                wide, middle, left, right = split
                below = points[rows, wide] < middle
                todo += [(left, rows[below]), (right, rows[~below])]
        return out


def _vectors(batch: pa.RecordBatch, name: str = "v") -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _by_length(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Parts of batches whose vectors have one length."""
    for batch in batches:
        dims = batch.column("dim").to_numpy()
        for d in np.unique(dims).tolist():
            yield d, batch.filter(pa.array(dims == d))


def _whole_numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, v, asks) with v = floor(64 * x); rows that take no part are left out."""
    for batch in batches:
        ids, rows, asks = [], [], []
        for i, v, a in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
            if i is None or not v.is_valid or v.values.null_count:
                continue
            x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
            if np.isfinite(x).all():
                with np.errstate(over="ignore"):
                    x = np.floor(64 * x) + 0.0
                if not np.isfinite(x).all():
                    raise OverflowError("a vector's component is too large for a score in a long")
                ids.append(i)
                rows.append(x)
                asks.append(bool(a))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(rows, pa.list_(pa.float64())),
                                          pa.array(asks, pa.bool_())], names=["id", "v", "asks"])


def _cell_task(cells: dict[int, Cells]):
    """Adds the cell to (id, v, asks, dim)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, part in _by_length(batches):
            found = cells[dim].of(_vectors(part)) if dim in cells else np.zeros(part.num_rows, np.int32)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found)], names=[*part.schema.names, "cell"])

    return run


def _boxes_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(dim, cell, n, low, high) of the rows, or of boxes of a task's rows."""
    found: dict[tuple[int, int], tuple] = {}
    for dim, part in _by_length(batches):
        cells = part.column("cell").to_numpy()
        whole = "v" in part.schema.names
        low, high = (_vectors(part, c) for c in (("v", "v") if whole else ("low", "high")))
        n = np.ones(len(cells), np.int64) if whole else part.column("n").to_numpy()
        for c in np.unique(cells).tolist():
            own = cells == c
            box = int(n[own].sum()), low[own].min(0), high[own].max(0)
            if (dim, c) in found:
                old = found[dim, c]
                box = old[0] + box[0], np.minimum(old[1], box[1]), np.maximum(old[2], box[2])
            found[dim, c] = box
    vectors = pa.list_(pa.float64())
    yield pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in found], pa.int32()), pa.array([k[1] for k in found], pa.int32()),
         pa.array([b[0] for b in found.values()], pa.int64()), pa.array([b[1] for b in found.values()], vectors),
         pa.array([b[2] for b in found.values()], vectors)], names=["dim", "cell", "n", "low", "high"])


def _reach_task(boxes: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]):
    """One row for each query and cell whose box may hold a score that counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, part in _by_length(batches):
            cells, low, high = boxes[dim]
            kth = part.column("kth").to_pylist()
            best = bounds(_vectors(part), low, high)
            ask, cell = np.nonzero(np.array([np.ones(len(cells), bool) if t is None else row >= t for row, t in zip(best, kth)]))
            rows = part.take(pa.array(ask))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(cells[cell].astype(np.int32))],
                                             names=[*rows.schema.names, "cell"])

    return run


_FOUND = "ask long, query_id long, times int, vec_id long, score long"


def _search_task(k: int, leaf_rows: int):
    schema = pa.schema([("ask", pa.int64()), ("query_id", pa.int64()), ("times", pa.int32()),
                        ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, tree, held = None, None, []
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("dim", "shard", "block", "step"))))
            cuts = [i for i in range(len(keys)) if not i or keys[i] != keys[i - 1]] + [len(keys)]
            for a, b in zip(cuts, cuts[1:]):
                part, (*key, step) = batch.slice(a, b - a), keys[a]
                if key != shard:
                    shard, tree, held = key, None, []
                if not step:
                    held.append((_vectors(part), part.column("id").to_numpy()))
                    continue
                if tree is None:
                    if not held:
                        continue
                    tree, held = Tree(*(np.concatenate(x) for x in zip(*held)), leaf_rows), []
                queries, kths = _vectors(part), part.column("kth").to_pylist()
                reach, owns = bounds(queries, tree.low, tree.high).tolist(), part.column("id").to_numpy()
                found = [tree.search(*x, k, kth) for *x, kth in zip(queries, owns, reach, kths)]
                n = [len(ids) for ids, _ in found]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(part.column("ask").to_numpy(), n)), pa.array(np.repeat(owns, n)),
                    pa.array(np.repeat(part.column("times").to_numpy(), n)),
                    pa.array(np.concatenate([ids for ids, _ in found])),
                    pa.array(np.concatenate([s for _, s in found]))], schema=schema)

    return run


def top_k(df: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for every row with ``is_query`` (a
    column over ``df``) the ``k`` other rows of largest integer inner product.

    Components count as floor(64 * x), x as double; sums are exact, and a score
    that a long cannot hold fails the job. Ties go to the smaller id; queries
    with fewer candidates return all of them.

    Defined cases: rows with a null id or vector, or a null or non-finite
    component, take no part; vectors of different length do not meet; rows with
    the query's id are its own, so repeated rows are not each other's candidates.
    Every row is a candidate of its own: a repeated one is listed as often as it
    occurs. If several rows of one id ask, their candidates are ranked together,
    each as often as it was found. An empty table gives no rows.
    """
    spark = df.sparkSession
    flagged = df.select(F.col(id_col).cast("long"), F.col(vector_col), F.coalesce(is_query, F.lit(False)).cast("boolean"))
    rows = stored(flagged.mapInArrow(_whole_numbers, "id long, v array<double>, asks boolean")
                  .withColumn("dim", F.size("v")), "knn-rows")
    sizes = {r["dim"]: r["n"] for r in rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a length
    sample: dict[int, list] = {}
    taken = min(SAMPLE_ROWS, SAMPLE_VALUES // max([1, *sizes]) + 1)
    for r in rows.select("dim", "v").orderBy(F.xxhash64("id", "v")).limit(taken).collect():
        sample.setdefault(r["dim"], []).append(r["v"])
    cells = {d: Cells(np.array(v), min(MAX_CELLS, SAMPLE_VALUES // max(1, d) + 1, -(-sizes[d] // SHARD_ROWS)))
             for d, v in sample.items()}
    placed = rows.mapInArrow(_cell_task(cells), "id long, v array<double>, asks boolean, dim int, cell int")
    of_box = "dim int, cell int, n long, low array<double>, high array<double>"
    found = (placed.mapInArrow(_boxes_task, of_box).repartition("dim", "cell").mapInArrow(_boxes_task, of_box)
             .orderBy("dim", "cell").collect())
    boxes = {d: tuple(np.array(x) for x in zip(*((r["cell"], r["low"], r["high"]) for r in found if r["dim"] == d)))
             for d in {r["dim"] for r in found}}
    pieces = [-(-r["n"] // SHARD_ROWS) for r in found]
    firsts = np.cumsum([0, *pieces]).tolist()
    # one row a cell, MAX_CELLS a length at most
    table = F.broadcast(spark.createDataFrame(
        [(r["dim"], r["cell"], a, n) for r, a, n in zip(found, firsts, pieces)], "dim int, cell int, first long, pieces long"))
    home = (F.col("first") + F.pmod(F.xxhash64("id"), F.col("pieces"))).alias("shard")
    vectors = placed.join(table, ["dim", "cell"]).select("dim", home, "id", "v")

    asking = (placed.where("asks").groupBy("dim", "cell", "id", "v").agg(F.least(F.count(F.lit(1)), F.lit(k)).cast("int").alias("times"))
              .join(table, ["dim", "cell"]).select("dim", home, "id", "v", "times"))
    queries = stored(asking.withColumn("ask", F.monotonically_increasing_id()), "knn-queries")
    blocks = queries.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / QUERY_ROWS).alias("blocks"))
    queries = (queries.join(F.broadcast(blocks), "dim")  # one row a length
               .withColumn("block", F.pmod(F.xxhash64("id", F.lit(1)), F.col("blocks"))).drop("blocks"))
    in_blocks = vectors.join(F.broadcast(blocks), "dim").withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))

    def search(asked: DataFrame) -> DataFrame:
        none = F.lit(None)
        dealt = (in_blocks.select("dim", "shard", "block", F.lit(0).alias("step"), "id", "v", none.cast("long").alias("kth"),
                                  none.cast("long").alias("ask"), none.cast("int").alias("times"))
                 .unionByName(asked.select("dim", "shard", "block", F.lit(1).alias("step"), "id", "v", "kth", "ask", "times")))
        return (dealt.repartition("dim", "shard", "block").sortWithinPartitions("dim", "shard", "block", "step")
                .mapInArrow(_search_task(k, LEAF_ROWS), _FOUND))

    near = stored(search(queries.withColumn("kth", F.lit(None).cast("long"))), "knn-home")
    kth = near.groupBy("ask").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("kth"))
    columns = "dim int, home long, id long, v array<double>, times int, ask long, block long, kth long"
    # pairs of a query and a cell that cannot reach the k-th score end here, before any vector moves
    reached = (queries.withColumnRenamed("shard", "home").join(kth, "ask", "left")
               .select(*[c.split()[0] for c in columns.split(", ")])
               .mapInArrow(_reach_task(boxes), columns + ", cell int").join(table, ["dim", "cell"]))
    away = (reached.withColumn("shard", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("pieces") - 1)))
            .where("shard <> home"))
    ranked = near.unionByName(search(away)).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times"))))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (ranked.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
