"""Alignment of two tokenizers over the bytes of each text, with corpus-wide
counts of the linked id pairs.

1. *Align.* Tasks cut texts into pieces at whose borders tokens of both
   tokenizers end, and align each distinct piece of a block once: token ends of
   both sides in one merged order give the groups and the links. A block keeps,
   for its documents, the pieces that they consist of, and radix-partitions its
   records (pair, occurrences) by pair into runs: sorted side-major (B id, then
   A id) and compressed with zstd. A pair that half of the corpus has is one
   record of a block.
2. *Count.* A radix partition's runs meet in one task. It keeps them compressed
   and merges them with a heap; records of one pair follow each other, which
   counts the pair, and the pairs of one B id follow each other, which gives the
   partition's maximum of that id. The counts then stream back, run by run in
   the run's own order.
3. *Join back.* A block's counts return to its documents, where a link is best
   if its count is the maximum of its B id (one number an id of the vocabulary).

Runs and blocks are written tables in the shared folder, so nothing is
recomputed after a loss, and a task holds one block or one radix partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from heapq import merge
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.byte_bpe import ByteBpe, cut, numbered
from tidemark.llm.common import spark_partitions, stored

BLOCK_CHARS = 8_000_000
MOST_PARTITIONS = 4096


def _pack(numbers: np.ndarray) -> bytes:
    """Whole numbers as byte planes in a zstd frame, their count in front."""
    planes = np.ascontiguousarray(numbers.astype("<i8").view(np.uint8).reshape(-1, 8).T)
    return len(numbers).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(planes.tobytes(), asbytes=True)


def _unpack(blob: bytes) -> np.ndarray:
    n = int.from_bytes(blob[:8], "little")
    if not n:
        return np.zeros(0, np.int64)
    raw = pa.Codec("zstd").decompress(blob[8:], 8 * n, asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, n).T).view("<i8").ravel()


class PieceBpe:
    """Ids of a sentencepiece model (its file's content) for pieces of texts.

    Pieces can be encoded apart where no entry of the vocabulary has a space
    after another character, and the model puts a space before a text; a model
    that differs is refused.
    """

    def __init__(self, model: bytes):
        import sentencepiece

        self.coder = sentencepiece.SentencePieceProcessor(model_proto=model)
        shown = [self.coder.id_to_piece(i) for i in range(self.coder.get_piece_size())]
        if any("▁" in s.lstrip("▁") for s in shown) or self.coder.normalize("a  b ") != "▁a▁▁b▁":
            raise ValueError("this model does not encode the parts of a text between spaces by themselves")
        self.pieces = []
        for i, s in enumerate(shown):
            if self.coder.is_byte(i):
                self.pieces.append(bytes([int(s[3:5], 16)]))
            elif self.coder.is_unknown(i) or self.coder.is_control(i):
                self.pieces.append(b"")
            else:
                self.pieces.append(s.replace("▁", " ").encode())
        self.sizes = np.array([len(p) for p in self.pieces])

    def ids_of_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self.coder.encode(pieces, num_threads=1) if pieces else []
        lens = np.array([len(x) for x in found], np.int64)
        return np.fromiter(chain.from_iterable(found), np.int64, int(lens.sum())), lens


class Aligned(NamedTuple):
    """Alignment of the distinct pieces of a block; those whose bytes a
    tokenizer changes have no links and are not ``whole``."""

    whole: np.ndarray    # of each piece: whether both tokenizers give its bytes
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    links: np.ndarray    # B id << 32 | A id, piece by piece
    groups: list[str]    # "a1,a2|b1;" for each group of a piece


def align_pieces(pieces: pa.Array, a: ByteBpe, b: PieceBpe) -> Aligned:
    """Align the tokens of both sides over the bytes of space + piece."""
    shown = pieces.to_pylist()
    texts = [b" " + p.encode() for p in shown]
    a_ids, n_a = a.ids_of_pieces(pieces)
    b_ids, n_b = b.ids_of_pieces(shown)

    def whole(ids, lens, table):
        cuts = np.append(0, np.cumsum(lens)).tolist()
        if b"".join([table[i] for i in ids.tolist()]) == b"".join(texts) and np.array_equal(
                np.add.reduceat(np.array([len(x) for x in table])[ids], cuts[:-1]) if len(ids) and (lens > 0).all() else None,
                np.array([len(t) for t in texts])):
            return np.ones(len(texts), bool)
        ids = ids.tolist()
        return np.array([b"".join([table[i] for i in ids[x:y]]) == t for x, y, t in zip(cuts, cuts[1:], texts)], bool)

    good = whole(a_ids, n_a, a.pieces) & whole(b_ids, n_b, b.pieces)
    a_ids, b_ids = a_ids[np.repeat(good, n_a)], b_ids[np.repeat(good, n_b)]
    n_a, n_b = n_a * good, n_b * good
    ends = np.cumsum(np.array([len(t) for t in texts], np.int64) * good)
    a_ends, b_ends = np.cumsum(a.sizes[a_ids]), np.cumsum(b.sizes[b_ids])

    both = np.union1d(a_ends, b_ends)  # every stretch between two ends is one link
    links = (b_ids[np.searchsorted(b_ends, both)] << 32) | a_ids[np.searchsorted(a_ends, both)]
    n_links = np.diff(np.searchsorted(both, ends, "right"), prepend=0)
    common = np.intersect1d(a_ends, b_ends, assume_unique=True)
    n_groups = np.diff(np.searchsorted(common, ends, "right"), prepend=0)

    a_group, b_group = np.searchsorted(common, a_ends), np.searchsorted(common, b_ends)
    group = np.concatenate([a_group, b_group])
    order = np.argsort(group, kind="stable")  # A's tokens of a group, then B's
    ids = np.concatenate([a_ids, b_ids])[order]
    mark = np.concatenate([np.append(a_group[1:] != a_group[:-1], True)[:len(a_ids)],
                           2 * np.append(b_group[1:] != b_group[:-1], True)[:len(b_ids)]])[order]
    known, at = np.unique(ids * 3 + mark, return_inverse=True)
    written = [f"{k // 3}{',|;'[k % 3]}" for k in known.tolist()]
    tokens = [written[k] for k in at.tolist()]
    cuts = np.append(0, np.cumsum(n_a + n_b)).tolist()
    groups = ["".join(tokens[x:y]) for x, y in zip(cuts, cuts[1:])]
    return Aligned(good, n_a, n_b, n_groups, n_links, links, groups)


def _partition_of(pairs: np.ndarray, partitions: int) -> np.ndarray:
    """The radix partition of each pair: the top of its multiplicative hash."""
    with np.errstate(over="ignore"):
        return ((pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % partitions


_BLOCKS = ("block long, part int, doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, "
           "n_links array<long>, digests array<string>, sizes binary, first binary, second binary, third binary")
DOCS, TABLE = -2, -1  # parts that are no radix partition


def _align_task(vocab_json: str, model: bytes, partitions: int):
    longs, strings = pa.list_(pa.int64()), pa.list_(pa.string())
    schema = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("doc_ids", longs), ("n_a", longs), ("n_b", longs),
                        ("n_groups", longs), ("n_links", longs), ("digests", strings), ("sizes", pa.binary()),
                        ("first", pa.binary()), ("second", pa.binary()), ("third", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        a, b = ByteBpe(vocab_json), PieceBpe(model)
        blocks = TaskContext.get().partitionId() << 32

        def rows(block: int, doc_ids: list, texts: pa.Array) -> Iterator[pa.RecordBatch]:
            empty = np.array([not n for n in pa.compute.binary_length(texts).to_pylist()], bool)
            full = np.flatnonzero(~empty)
            words, counts, order = cut(texts.filter(pa.array(~empty)))
            table, numbers = numbered(words)
            found = align_pieces(table, a, b)
            begun = np.append(0, np.cumsum(counts))
            bad = np.add.reduceat(~found.whole[numbers], begun[:-1], dtype=np.int64) > 0 if len(counts) else np.zeros(0, bool)
            shown = np.array(found.groups, object)
            at, digests = full[order], [""] * len(doc_ids)
            sums = {}
            for name in ("n_a", "n_b", "n_groups", "n_links"):
                out = sums[name] = np.zeros(len(doc_ids), np.int64)
                if len(counts):
                    out[at] = np.add.reduceat(getattr(found, name)[numbers], begun[:-1]) * ~bad
            sizes = np.zeros(len(doc_ids), np.int64)
            sizes[at] = counts * ~bad
            for k in np.flatnonzero(~bad).tolist():
                text = "".join(shown[numbers[begun[k]:begun[k + 1]]].tolist())
                digests[at[k]] = sha256(text[:-1].encode()).hexdigest()
            # the documents' pieces, in the order of the documents
            taken = [numbers[begun[k]:begun[k + 1]] for k in np.argsort(at, kind="stable").tolist() if not bad[k]]
            taken = np.concatenate([np.zeros(0, np.int32), *taken])

            pairs, place = np.unique(found.links, return_inverse=True)
            uses = np.bincount(taken, minlength=len(table))
            times = np.bincount(place, weights=np.repeat(uses, found.n_links), minlength=len(pairs)).astype(np.int64)
            part = _partition_of(pairs, partitions)
            none = dict.fromkeys(schema.names)

            def batch(*records: dict) -> pa.RecordBatch:
                return pa.RecordBatch.from_pylist([none | r for r in records], schema)

            yield batch({"block": block, "part": DOCS, "doc_ids": doc_ids, "digests": digests,
                         "sizes": _pack(sizes), "first": _pack(taken), **{k: v.tolist() for k, v in sums.items()}})
            yield batch({"block": block, "part": TABLE, "sizes": _pack(found.n_links), "first": _pack(pairs >> 32),
                         "second": _pack(pairs & 0xFFFFFFFF), "third": _pack(place)})
            by = np.argsort(part, kind="stable")  # keeps the side-major order inside a partition
            borders = np.flatnonzero(np.diff(part[by], prepend=-1))
            yield batch(*({"block": block, "part": int(part[i[0]]), "first": _pack(np.diff(pairs[i] >> 32, prepend=0)),
                           "second": _pack(pairs[i] & 0xFFFFFFFF), "third": _pack(times[i])}
                          for i in np.split(by, borders[1:]) if len(i)))

        ids, held, chars = [], [], 0
        for batch in batches:
            texts = batch.column(1).fill_null("")
            ids += batch.column(0).to_pylist()
            held.append(texts)
            chars += texts.nbytes
            if chars >= BLOCK_CHARS:
                yield from rows(blocks, ids, pa.concat_arrays(held))
                blocks, ids, held, chars = blocks + 1, [], [], 0
        if held:
            yield from rows(blocks, ids, pa.concat_arrays(held))

    return run


def _records(first: bytes, second: bytes, third: bytes) -> Iterator[tuple[int, int]]:
    """(pair, occurrences) of a run, in its order; numbers are made one by one."""
    pairs = (np.cumsum(_unpack(first)) << 32) | _unpack(second)
    return zip(memoryview(pairs), memoryview(_unpack(third)))


_COUNTS = "block long, part int, counts binary, pairs binary, b_ids array<long>, most array<long>"


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("counts", pa.binary()), ("pairs", pa.binary()),
                        ("b_ids", pa.list_(pa.int64())), ("most", pa.list_(pa.int64()))])

    def counted(part: int, runs: list[tuple]) -> Iterator[pa.RecordBatch]:
        pairs, totals = [], []
        last = None
        for pair, n in merge(*(_records(*r[1:]) for r in runs)):
            if pair == last:
                totals[-1] += n
            else:
                pairs.append(pair)
                totals.append(n)
                last = pair
        pairs, totals = np.array(pairs, np.int64), np.array(totals, np.int64)
        side, first = np.unique(pairs >> 32, return_index=True)  # side-major: an id's pairs lie together
        yield pa.RecordBatch.from_arrays([
            pa.array([None], pa.int64()), pa.array([part], pa.int32()), pa.array([_pack(totals)]), pa.array([_pack(pairs)]),
            pa.array([side.tolist()], pa.list_(pa.int64())),
            pa.array([np.maximum.reduceat(totals, first).tolist()], pa.list_(pa.int64()))], schema=schema)
        for block, first, second, _ in runs:
            own = (np.cumsum(_unpack(first)) << 32) | _unpack(second)
            yield pa.RecordBatch.from_arrays([
                pa.array([block], pa.int64()), pa.array([part], pa.int32()), pa.array([_pack(totals[np.searchsorted(pairs, own)])]),
                pa.nulls(1, pa.binary()), pa.nulls(1, pa.list_(pa.int64())), pa.nulls(1, pa.list_(pa.int64()))], schema=schema)

    part, runs = None, []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("part", "block", "first", "second", "third"))):
            if row[0] != part:
                if runs:
                    yield from counted(part, runs)
                part, runs = row[0], []
            runs.append(row[1:])
    if runs:
        yield from counted(part, runs)


def _join_task(most: np.ndarray, partitions: int):
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
                       + [("groups_sha256", pa.string())])

    def run(rows: pa.Table, counts: pa.Table) -> pa.Table:
        rows = rows.to_pylist()
        table = next(r for r in rows if r["part"] == TABLE)
        docs = next(r for r in rows if r["part"] == DOCS)
        b_ids, place, n_links = _unpack(table["first"]), _unpack(table["third"]), _unpack(table["sizes"])
        part = _partition_of((b_ids << 32) | _unpack(table["second"]), partitions)
        by = np.argsort(part, kind="stable")
        found = np.zeros(len(b_ids), np.int64)
        for p, blob in zip(counts.column("part").to_pylist(), counts.column("counts").to_pylist()):
            found[by[np.searchsorted(part[by], p):np.searchsorted(part[by], p, "right")]] = _unpack(blob)
        best = found == most[b_ids]

        def of_documents(of_pairs: np.ndarray) -> np.ndarray:
            reach = np.append(0, np.cumsum(of_pairs[place]))[np.append(0, np.cumsum(n_links))]
            of_pieces = np.diff(reach)
            reach = np.append(0, np.cumsum(of_pieces[_unpack(docs["first"])]))
            return np.diff(reach[np.append(0, np.cumsum(_unpack(docs["sizes"])))])

        return pa.Table.from_arrays(
            [pa.array(docs["doc_ids"], pa.int64()), *(pa.array(docs[c], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")),
             pa.array(of_documents(best.astype(np.int64))), pa.array(of_documents(found)), pa.array(docs["digests"])],
            schema=schema)

    return run


def _pairs_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for pairs, totals in zip(batch.column("pairs").to_pylist(), batch.column("counts").to_pylist()):
            pairs = _unpack(pairs)
            yield pa.RecordBatch.from_arrays([pa.array(pairs & 0xFFFFFFFF), pa.array(pairs >> 32), pa.array(_unpack(totals))],
                                             names=["a_id", "b_id", "count"])


class Alignment(NamedTuple):
    documents: DataFrame  # doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256
    pairs: DataFrame      # a_id, b_id, count: each linked id pair of the corpus once


def align(df: DataFrame, a_vocab_path: str, b_model_path: str, id_col: str = "doc_id", text_col: str = "text") -> Alignment:
    """Align the tokens of a byte-level tokenizer file (A) and a sentencepiece
    model (B) over the bytes of a space and each text.

    Groups are cut at the bytes where tokens of both sides end; a link is a pair
    of tokens whose bytes overlap; a pair's count is the number of links of the
    whole corpus that hold it; a link is best if no other pair with its B id has
    a higher count. Special tokens in texts are plain text.

    Defined cases: a text that is null or empty, or whose bytes either side
    changes (such as U+2581), has no tokens: zeros and an empty digest, and its
    pairs count nowhere. Repeated rows and rows with a null id are documents of
    their own; other columns are not read; an empty table gives no rows.
    """
    with open(a_vocab_path, encoding="utf-8") as f:
        vocab = f.read()
    with open(b_model_path, "rb") as f:
        model = f.read()
    spark = df.sparkSession
    partitions = min(MOST_PARTITIONS, max(64, spark_partitions(spark)))
    texts = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    blocks = stored(texts.mapInArrow(_align_task(vocab, model, partitions), _BLOCKS), "align-blocks")
    runs = blocks.where("part >= 0").select("block", "part", "first", "second", "third")
    counts = stored(runs.repartition("part").sortWithinPartitions("part").mapInArrow(_count_task, _COUNTS), "align-counts")
    of_parts = counts.where("block is null")
    # one row an id of B's vocabulary at most
    maxima = (of_parts.select(F.explode(F.arrays_zip("b_ids", "most")).alias("x")).groupBy("x.b_ids")
              .agg(F.max("x.most").alias("most")).collect())
    most = np.zeros(max((r["b_ids"] for r in maxima), default=0) + 1, np.int64)
    for r in maxima:
        most[r["b_ids"]] = r["most"]
    documents = (blocks.where("part < 0").groupBy("block").cogroup(counts.where("block is not null").groupBy("block"))
                 .applyInArrow(_join_task(most, partitions), "doc_id long, n_a long, n_b long, n_groups long, n_links long, "
                               "n_best long, count_sum long, groups_sha256 string"))
    return Alignment(documents, of_parts.select("pairs", "counts").mapInArrow(_pairs_task, "a_id long, b_id long, count long"))
