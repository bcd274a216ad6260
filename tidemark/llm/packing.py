"""Packing of token sequences: shortest pack first over the length histogram.

1. *Cut.* Tasks encode the texts, cut each document's ids into full sequences
   and a rest, and write the pieces with their rank among the task's pieces of
   the same length.
2. *Plan.* The histogram of piece lengths (at most ``size`` numbers) is packed
   on the driver, longest lengths first, each into the shortest open pack that
   takes it. Packs are counted by pattern, never listed: all packs with the same
   lengths are one entry. The shortest packs are then taken apart again and fill
   the gaps of the others, cut to measure, down to gaps of ``MIN_CUT``.
3. *Join.* A pattern's places for a length are an interval of ranks. Pieces get
   their global rank (the tasks' counts summed up by length) and find their
   place by a join on length and rank.

No step orders or groups all pieces of one length in a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.byte_bpe import ByteBpe, cut, gather, numbered
from tidemark.llm.common import stored

SIZE = 1024
MIN_CUT = 8               # tokens: smaller gaps stay, and no smaller piece is cut off
BLOCK_CHARS = 16_000_000  # characters after which a task encodes what it has read
MAX_PLACES = 200_000      # rows of the plan that is broadcast; the plan of 1,024 has at most a quarter of them


class Place(NamedTuple):
    """Where the pieces of a length with ranks from ``low`` to below ``high`` go:
    tokens ``start`` to ``start + taken`` of piece low + i go to sequence
    ``sequence + i // each`` at ``offset + taken * (i % each)``."""

    length: int
    low: int
    high: int
    start: int
    taken: int
    each: int
    sequence: int
    offset: int


class Item(NamedTuple):
    """Pieces (or ends of pieces) to pack: those of ``length`` from rank ``low``
    on, without their first ``start`` tokens."""

    length: int
    low: int
    start: int
    count: int

    @property
    def size(self) -> int:
        return self.length - self.start


def shortest_pack_first(items: list[Item], size: int) -> list[tuple[int, list[tuple[int, int]], int]]:
    """Patterns of packs as (used, runs, count), runs being (item, how many).

    Longest items go first. Each piece goes to the shortest open pack that it
    fits in, or opens one; all packs of one pattern move at once.
    """
    levels: dict[int, list[tuple[tuple, int]]] = {}
    heap: list[int] = []

    def put(used: int, runs: tuple, count: int):
        if not levels.get(used):
            levels[used] = []
            heappush(heap, used)
        levels[used].append((runs, count))

    for item, n in sorted(((k, x.count) for k, x in enumerate(items)), key=lambda x: -items[x[0]].size):
        long = items[item].size
        while n:
            while heap and not levels[heap[0]]:
                heappop(heap)
            if heap and heap[0] + long <= size:
                used = heap[0]
                runs, count = levels[used].pop()
                k = min(n, count)
                if count > k:
                    levels[used].append((runs, count - k))
                if runs[-1][0] == item:
                    runs = (*runs[:-1], (item, runs[-1][1] + 1))
                else:
                    runs = (*runs, (item, 1))
                put(used + long, runs, k)
                n -= k
            else:
                each = size // long
                full, rest = divmod(n, each)
                if full:
                    put(each * long, ((item, each),), full)
                if rest:
                    put(rest * long, ((item, rest),), 1)
                n = 0
    return [(used, list(runs), count) for used, packs in levels.items() for runs, count in packs]


def plan(histogram: dict[int, int], size: int = SIZE, min_cut: int = MIN_CUT) -> list[Place]:
    """Places for all pieces of a histogram (length -> count)."""
    places: list[Place] = []
    sequences = 0

    def settle(items, packs, next_low):
        """Number the packs and hand out the ranks of their runs."""
        nonlocal sequences
        for used, runs, count in packs:
            at = 0
            for item, each in runs:
                it, low = items[item], next_low[item]
                places.append(Place(it.length, low, low + count * each, it.start, it.size, each, sequences, at))
                next_low[item] += count * each
                at += each * it.size
            sequences += count

    items = [Item(length, 0, 0, n) for length, n in histogram.items() if n]
    packs = sorted(shortest_pack_first(items, size), key=lambda p: p[0])
    room = sum((size - used) * count for used, _, count in packs if size - used >= min_cut)
    broken, need = [], 0
    for k, (used, runs, count) in enumerate(packs):
        gap = size - used if size - used >= min_cut else 0
        if not gap:
            break
        x = min(count, max(0, room - need) // (used + gap))
        if x:
            broken.append((used, runs, x))
            packs[k] = (used, runs, count - x)
            need, room = need + x * used, room - x * gap
        if x < count:
            break
    packs = [p for p in packs if p[2]]
    next_low = [0] * len(items)
    gaps, number = [], sequences
    for used, _, count in packs:
        if size - used >= min_cut:
            gaps.append((used, number, count))
        number += count
    settle(items, packs, next_low)
    loose = []
    for _, runs, count in broken:
        for item, each in runs:
            loose.append((-items[item].length, items[item].length, next_low[item], 0, count * each))
            next_low[item] += count * each
    heapify(gaps)
    heapify(loose)
    # the longest loose piece into the shortest pack, as many at once as there are of both
    while gaps and loose and len(places) < MAX_PLACES // 2:
        _, length, low, start, n = heappop(loose)
        used, first, count = heappop(gaps)
        k, gap, left = min(n, count), size - used, length - start
        taken = left if left <= gap else gap if left - gap >= min_cut else left - min_cut
        if taken < min(min_cut, left):
            taken = gap
        places.append(Place(length, low, low + k, start, taken, 1, first, used))
        if n > k:
            heappush(loose, (start - length, length, low + k, start, n - k))
        if count > k:
            heappush(gaps, (used, first + k, count - k))
        if taken < left:
            heappush(loose, (start + taken - length, length, low, start + taken, k))
        if gap - taken >= min_cut:
            heappush(gaps, (used + taken, first, k))
    rest = [Item(length, low, start, n) for _, length, low, start, n in loose]
    settle(rest, shortest_pack_first(rest, size), [x.low for x in rest])
    return places


_PIECES = "task int, rank long, doc_id long, start long, length int, doc_tokens long, ids binary"


def _cut_task(vocab_json: str, end_id: int | None, size: int):
    schema = pa.schema([("task", pa.int32()), ("rank", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()),
                        ("length", pa.int32()), ("doc_tokens", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        coder = ByteBpe(vocab_json)
        task = TaskContext.get().partitionId()
        seen = np.zeros(size + 1, np.int64)
        end = [] if end_id is None else [end_id]

        def ranks(lengths: np.ndarray) -> np.ndarray:
            """Ranks among the task's pieces of the same length."""
            order = np.argsort(lengths, kind="stable")
            ordered = lengths[order]
            first = np.searchsorted(ordered, ordered)
            out = np.empty(len(lengths), np.int64)
            out[order] = seen[ordered] + np.arange(len(lengths)) - first
            seen[:] += np.bincount(lengths, minlength=size + 1)
            return out

        def pieces(doc_ids: list, texts: pa.Array) -> Iterator[pa.RecordBatch]:
            words, counts, order = cut(texts)
            begun = np.cumsum(counts) - counts
            heads = words.take(pa.array(begun)).to_pylist()
            inner = np.ones(len(words), bool)
            inner[begun] = False
            table, numbers = numbered(words.filter(pa.array(inner)))
            flat, sizes = gather(*(x.astype(np.int32) for x in coder.ids_of_pieces(table)), numbers)
            cuts = np.append(0, np.cumsum(sizes))[np.append(0, np.cumsum(counts - 1))]
            marked = np.zeros(len(texts), bool)
            for token in coder.special:
                marked |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
            rows = []
            for k, (at, head) in enumerate(zip(order.tolist(), heads)):
                if marked[at]:
                    parts = [coder.ids(texts[at].as_py(), with_special=True), end]
                else:
                    parts = [coder.ids(head), flat[cuts[k]:cuts[k + 1]], end]
                ids = np.concatenate([np.asarray(x, "<u4") for x in parts])
                rows += [(doc_ids[at], a, ids[a:a + size].tobytes(), len(ids)) for a in range(0, len(ids), size)]
            lengths = np.array([len(r[2]) // 4 for r in rows], np.int64)
            rank = ranks(lengths)
            for a in range(0, len(rows), 4000):
                ids, starts, data, tokens = zip(*rows[a:a + 4000])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([task] * len(ids), pa.int32()), pa.array(rank[a:a + 4000]), pa.array(ids, pa.int64()),
                     pa.array(starts, pa.int64()), pa.array(lengths[a:a + 4000].astype(np.int32)),
                     pa.array(tokens, pa.int64()), pa.array(data, pa.binary())], schema=schema)

        ids, held, chars = [], [], 0
        for batch in batches:
            texts = batch.column(1).fill_null("")
            ids += batch.column(0).to_pylist()
            held.append(texts)
            chars += texts.nbytes
            if chars >= BLOCK_CHARS:
                yield from pieces(ids, pa.concat_arrays(held))
                ids, held, chars = [], [], 0
        if held:
            yield from pieces(ids, pa.concat_arrays(held))

    return run


def pack(df: DataFrame, vocab_path: str, end_id: int | None = 0, size: int = SIZE, min_cut: int = MIN_CUT,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset) of every
    piece of the documents' ids.

    ``ids`` are little-endian unsigned 32-bit numbers; ``start`` counts the
    document's ids before the piece; pieces of one sequence lie one after the
    other without a gap. ``vocab_path`` names a byte-level tokenizer file;
    ``end_id`` follows each document's ids (none if None).

    Defined cases: a null text counts as empty (its only id is the end id; no
    piece without one); special tokens in a text are their ids; repeated rows
    and rows with a null id are documents of their own; other columns are not
    read; an empty table gives no rows.
    """
    with open(vocab_path, encoding="utf-8") as f:
        vocab = f.read()
    spark = df.sparkSession
    texts = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    pieces = stored(texts.mapInArrow(_cut_task(vocab, end_id, size), _PIECES), "pack-pieces")
    counts = stored(pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")), "pack-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = plan(histogram, size, min_cut)
    table = spark.createDataFrame(places, "length int, low long, high long, cut long, taken int, each int, first long, at int")
    if len(places) <= MAX_PLACES:
        table = F.broadcast(table)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(base.hint("shuffle_hash"), ["length", "task"]).withColumn("rank", F.col("base") + F.col("rank"))
    i = F.col("rank") - F.col("low")
    return (ranked.join(table.withColumnRenamed("length", "of"),
                        (F.col("length") == F.col("of")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")))
            .select("doc_id", (F.col("start") + F.col("cut")).alias("start"), F.col("taken").cast("long").alias("length"),
                    F.substring("ids", (4 * F.col("cut") + 1).cast("int"), 4 * F.col("taken")).alias("ids"), "doc_tokens",
                    (F.col("first") + F.floor(i / F.col("each"))).alias("sequence_id"),
                    (F.col("at") + F.col("taken") * (i % F.col("each"))).cast("long").alias("offset")))


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids, doc_ids, offsets): the sequences themselves,
    each with the documents that its pieces come from. A sequence holds at most
    ``size`` ids, so a group is bounded."""
    rows = packed.groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct("offset", "length", "doc_id", "ids"))).alias("p"))
    # as bytes in hexadecimal letters, since arrays of binary cannot be joined
    joined = F.unhex(F.array_join(F.transform("p", lambda x: F.hex(x["ids"])), ""))
    return rows.select("sequence_id", F.aggregate("p", F.lit(0).cast("long"), lambda a, x: a + x["length"]).alias("length"),
                       joined.alias("ids"), F.col("p.doc_id").alias("doc_ids"), F.col("p.offset").alias("offsets"))
