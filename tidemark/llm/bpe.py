"""BPE encoding and decoding through a distinct-word table.

Texts are split into pre-tokens; each distinct one is encoded once; the ids are
joined back by position; decoding joins ids to the pieces of the vocabulary.

Three passes over compact columns, none of which moves a text:

1. *Split.* Each task cuts its texts into pre-tokens and closes a block every
   two million of them: its distinct pre-tokens plus, for every text, the
   positions into that list. Blocks are dealt out by number.
2. *Encode.* The lists are dealt out by a hash of the word, so all blocks'
   copies of a word meet in one task, which encodes it once.
3. *Join back.* The ids return to their block (which is read from the first
   exchange again) and are put in place of the positions.

Memory in a task is bounded by one block or by the distinct words of one
partition. A word in every block gives one entry a block, not one a use.

A block's number is a hash of its list. If a task that is run again on a lost
executor's behalf got its texts in another order, its block would find no ids
and the job would fail rather than mix up positions; files are always read in
the same order, so only texts that come out of another shuffle need storing
before.

Defined cases: a null text counts as empty and has no ids; rows repeat as often
as they come; a null id column value is kept; other columns are not read; an
empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import handing_back, spark_partitions, stored

BLOCK_TOKENS = 2_000_000  # pre-tokens after which a task closes a block
SEGMENT_CHARS = 250_000   # characters that are split at once
MOST_PIECES = 500_000     # entries of a vocabulary whose pieces are broadcast
DECODE_BYTES = 64 << 20   # rows that share a list of distinct ids when they are decoded
_ENCODED = "row_id long, ids array<int>"
NO_ID = -(1 << 62)        # stands before a block's ids


def _byte_chars() -> list[str]:
    """The character that stands for each byte: itself when printable in
    Latin-1, else the next one from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class Splitter:
    """Pre-tokens of texts, as the tokenizer's normalizer and splitter give them.

    Characters are classed (space, letter, digit, other) by asking the
    tokenizer once for each character met, then whole segments are cut with
    array operations.
    """

    # The endings cut off after an apostrophe.
    SHORT_ENDINGS = "stmd"
    LONG_ENDINGS = ("re", "ve", "ll")

    def __init__(self, vocab_json: str):
        import re

        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_str(vocab_json)
        special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        # outside this set a text goes through the tokenizer's own normalizer
        self.plain = re.compile("[^\\u0000-\\u012f\\u0131-\\u02ff\\u2010-\\u2027\\u20ac]")
        self.classes = np.full(0x110000, 255, np.uint8)

    def _class_of(self, char: str) -> int:
        cut = self.tok.pre_tokenizer.pre_tokenize_str
        if not cut(char):
            return 0
        if len(cut(char + char)) == 2:
            return 2
        return 1 if len(cut(char + "a")) == 1 else 3

    def normalized(self, text: str) -> str:
        if text.isascii() or not self.plain.search(text):
            return text.lower()
        return self.tok.normalizer.normalize_str(text)

    def segments(self, text: str) -> Iterator[str]:
        """Normalized pieces of a text, cut at white space."""
        start = 0
        while len(text) - start > SEGMENT_CHARS:
            cut = max(text.rfind(" ", start, start + SEGMENT_CHARS), text.rfind("\n", start, start + SEGMENT_CHARS))
            if cut <= start:
                ends = [e for e in (text.find(" ", start + 1), text.find("\n", start + 1)) if e > 0]
                if not ends:
                    break
                cut = min(ends)
            yield self.normalized(text[start:cut])
            start = cut
        yield self.normalized(text[start:] if start else text)

    def split(self, pieces: list[str]) -> tuple[pa.Array, np.ndarray]:
        """The pre-tokens of normalized pieces, in order, and how many each has."""
        joined = "\n".join(pieces) + "\n\n\n"
        chars = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        cls = self.classes[chars]
        if (cls == 255).any():
            for c in np.unique(chars[cls == 255]):
                self.classes[c] = self._class_of(chr(c))
            cls = self.classes[chars]
        start = cls != 0
        start[1:] &= (cls[1:] != cls[:-1]) | (cls[1:] == 2)
        marks = np.flatnonzero(start & (chars == 39))
        if len(marks):
            one, two = chars[marks + 1], chars[marks + 2]
            size = np.isin(one, [ord(c) for c in self.SHORT_ENDINGS]).astype(np.int64)
            for a, b in self.LONG_ENDINGS:
                size[(one == ord(a)) & (two == ord(b))] = 2
            marks, size = marks[size > 0], size[size > 0]
            start[marks + 1] = False
            start[marks + 1 + size] = cls[marks + 1 + size] != 0
        at = np.flatnonzero(start)
        kept = cls != 0
        first = (np.cumsum(kept) - 1)[at]
        chars = chars[kept]
        if len(chars) and chars.max() >= 128:
            width = 1 + (chars >= 0x80).astype(np.int64) + (chars >= 0x800) + (chars >= 0x10000)
            ends = np.cumsum(width)
            total = int(ends[-1])
            first = (ends - width)[first]
            data = chars.tobytes().decode("utf-32-le").encode()
        else:
            total, data = len(chars), chars.astype(np.uint8).tobytes()
        offsets = np.append(first, total).astype(np.int32)
        words = pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(data))
        ends = np.cumsum([len(p) + 1 for p in pieces])
        return words, np.diff(np.searchsorted(at, ends), prepend=0)

    def chunks(self, texts: Iterable[str | None]) -> Iterator[tuple[pa.Array, list[tuple[int, int]]]]:
        """Pre-tokens of texts, with (text's number, pre-tokens) for each piece."""
        pieces: list[str] = []
        owners: list[int] = []
        size = 0

        def flush():  # the words of a text follow those of the texts before it
            words, counts = self.split(pieces)
            return words, list(zip(owners, counts.tolist()))

        for n, text in enumerate(texts):
            text = text or ""
            if self.special is not None and "<" in text and self.special.search(text):
                if pieces:
                    yield flush()
                    pieces, owners, size = [], [], 0
                for k, part in enumerate(self.special.split(text)):
                    if k % 2:
                        yield pa.array([part]), [(n, 1)]
                    elif part:
                        for s in self.segments(part):
                            words, counts = self.split([s])
                            yield words, [(n, int(counts[0]))]
                continue
            for s in self.segments(text):
                pieces.append(s)
                owners.append(n)
                size += len(s)
                if size >= SEGMENT_CHARS:
                    yield flush()
                    pieces, owners, size = [], [], 0
        if pieces:
            yield flush()

    def ids(self, word: str) -> list[int]:
        """The ids of one pre-token."""
        if self.special is not None and self.special.fullmatch(word):
            return [self.tok.token_to_id(word)]
        shown = "".join([self.shown[b] for b in word.encode()])
        return [t.id for t in self.tok.model.tokenize(shown)]

    shown = _byte_chars()


@lru_cache(maxsize=1)
def splitter_of(vocab_json: str) -> Splitter:
    """The one splitter of a worker, for all its tasks: the tokenizers library
    keeps what a tokenizer has cached when it is dropped, so one a task would
    let the worker grow with the number of its tasks."""
    return Splitter(vocab_json)


def _pack(numbers: np.ndarray) -> bytes:
    """Numbers under 2**32 as byte planes, compressed."""
    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return pa.Codec("zstd", 1).compress(np.ascontiguousarray(planes).tobytes(), asbytes=True)


def _unpack(blob: bytes, size: int) -> np.ndarray:
    if not size:
        return np.zeros(0, np.int64)
    raw = pa.Codec("zstd").decompress(blob, 4 * size, asbytes=True)
    planes = np.frombuffer(raw, np.uint8).reshape(4, size)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


_SPLIT = "block long, bucket int, row_ids array<long>, sizes array<int>, packed binary, words binary"


def _split_task(vocab_json: str, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        splitter = splitter_of(vocab_json)
        task = str(TaskContext.get().partitionId()).encode()
        chunks: list[pa.Array] = []
        docs: list[tuple[list, list[int]]] = []
        held = 0
        schema = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("row_ids", pa.list_(pa.int64())),
                            ("sizes", pa.list_(pa.int32())), ("packed", pa.binary()), ("words", pa.binary())])

        def close() -> Iterator[pa.RecordBatch]:
            # numbered by what it holds: the same texts give the same block again
            coded = pa.chunked_array(chunks, pa.string()).dictionary_encode()
            parts = coded.unify_dictionaries().chunks
            words = parts[0].dictionary.to_pylist() if parts else []
            block = int.from_bytes(blake2b("\n".join(words).encode(), digest_size=8, key=task).digest(), "little", signed=True)
            at = np.concatenate([np.zeros(0, np.int64), *(p.indices.to_numpy(zero_copy_only=False) for p in parts)])
            done = 0
            for ids, sizes in docs:
                n = sum(sizes)
                yield pa.RecordBatch.from_pydict({"block": [block], "bucket": [-1], "row_ids": [ids], "sizes": [sizes],
                                                  "packed": [_pack(at[done:done + n])], "words": [None]}, schema)
                done += n
            by: dict[int, list[int]] = {}
            for i, w in enumerate(words):
                by.setdefault(zlib.crc32(w.encode()) % buckets, []).append(i)
            yield pa.RecordBatch.from_pydict({
                "block": [block] * len(by), "bucket": list(by), "row_ids": [None] * len(by),
                "sizes": [[len(x)] for x in by.values()],
                "packed": [_pack(np.diff(x, prepend=0)) for x in by.values()],
                "words": [zlib.compress("\n".join([words[i] for i in x]).encode(), 1) for x in by.values()]}, schema)

        for batch in batches:
            row_ids = batch.column(0).to_pylist()
            counts: dict[int, int] = {}
            for words, owned in splitter.chunks(t.as_py() for t in batch.column(1)):
                chunks.append(words)
                held += len(words)
                for n, size in owned:
                    counts[n] = counts.get(n, 0) + size
            docs.append((row_ids, [counts[n] for n in range(len(row_ids))]))
            if held >= BLOCK_TOKENS:
                yield from close()
                chunks, docs, held = [], [], 0
        if docs:
            yield from close()

    return run


def _only_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A function, so that both uses of the blocks read the same exchange."""
    for batch in batches:
        yield batch.filter(pc.greater_equal(batch.column("bucket"), 0))


def _encode_task(vocab_json: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = splitter_of(vocab_json)
        known: dict[str, list[int]] = {}
        for batch in batches:
            sizes, lens, ids = [], [], []
            for words in batch.column("words"):
                found = []
                for w in zlib.decompress(words.as_py()).decode().split("\n"):
                    got = known.get(w)
                    if got is None:
                        got = known[w] = np.array(splitter.ids(w), np.int64)
                    found.append(got)
                lens.append(_pack(np.array([len(f) for f in found])))
                flat = np.concatenate(found)
                ids.append(_pack(flat))
                sizes.append([len(found), len(flat)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("block"), pa.array(sizes, pa.list_(pa.int32())), batch.column("packed"),
                 pa.array(lens, pa.binary()), pa.array(ids, pa.binary())],
                names=["block", "sizes", "packed", "lens", "ids"])

    return run


def _join_block(rows: pa.Table, table: pa.Table) -> pa.Table:
    """Put the ids of a block's word table in place of the positions."""
    none = np.zeros(0, np.int64)
    parts = [(np.cumsum(_unpack(r["packed"], r["sizes"][0])), _unpack(r["lens"], r["sizes"][0]),
              _unpack(r["ids"], r["sizes"][1])) for r in table.to_pylist()]
    at, lens, flat = (np.concatenate(x) for x in zip((none, none, none), *parts))
    size, begin = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    size[at] = lens
    begin[at] = np.cumsum(lens) - lens
    row_ids, found = [], []
    for row in rows.filter(pc.equal(rows["bucket"], -1)).to_pylist():
        at = _unpack(row["packed"], sum(row["sizes"]))
        if len(at) and not len(size):
            raise RuntimeError("a task that ran again got its texts in another order; store them first")
        lens = size[at]
        ends = np.cumsum(lens)
        ids = flat[np.repeat(begin[at] - (ends - lens), lens) + np.arange(int(ends[-1]) if len(ends) else 0)]
        offsets = np.append(0, np.append(0, ends)[np.cumsum(row["sizes"])])
        found.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids.astype(np.int32))))
        row_ids += row["row_ids"]
    return pa.table({"row_id": pa.array(row_ids, pa.int64()), "ids": pa.chunked_array(found, pa.list_(pa.int32()))})


def _dealt_and_encoded(df: DataFrame, vocab_path: str, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The texts as positions, by block, and the ids of the words of each block."""
    with open(vocab_path, encoding="utf-8") as f:
        vocab = f.read()
    buckets = max(512, spark_partitions(df.sparkSession))
    texts = df.select(F.col(id_col).cast("long").alias("row_id"), F.col(text_col).cast("string").alias("text"))
    dealt = texts.mapInArrow(handing_back(_split_task(vocab, buckets)), _SPLIT).repartition("block")
    words = dealt.mapInArrow(_only_words, _SPLIT).select("block", "bucket", "packed", "words").repartition("bucket")
    table = words.mapInArrow(handing_back(_encode_task(vocab)), "block long, sizes array<int>, packed binary, lens binary, ids binary")
    return dealt, table


def encode(df: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row_id, ids): the token ids of every text, without special tokens added.

    ``vocab_path`` names a tokenizer file of the splitting and word-end kind
    this module reads; the driver reads it (a few MB) and ships its content.
    """
    dealt, table = _dealt_and_encoded(df, vocab_path, id_col, text_col)
    return dealt.groupBy("block").cogroup(table.groupBy("block")).applyInArrow(_join_block, _ENCODED)


def pieces(vocab_path: str) -> list[str]:
    """The id-to-piece table: the piece of each id, ordered by id."""
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(vocab_path)
    return [tok.id_to_token(i) for i in range(tok.get_vocab_size(with_added_tokens=True))]


def _lines(block: list[pa.RecordBatch], ids_col: str) -> Iterator[pa.RecordBatch]:
    """Lines (id, n_ids, row) of a block of rows: its distinct ids, in order, one
    a line, then its rows with the number of those ids."""
    kind = pa.struct(list(block[0].schema))
    flat = pa.chunked_array([b.column(ids_col).flatten() for b in block]).drop_null()
    ids = np.append(NO_ID, np.unique(flat.to_numpy())).astype(np.int64)  # a first line, also without ids
    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.nulls(len(ids), pa.int32()), pa.nulls(len(ids), kind)],
                                     names=["id", "n_ids", "row"])
    for b in block:
        yield pa.RecordBatch.from_arrays([
            pa.nulls(b.num_rows, pa.int64()), pa.array(np.full(b.num_rows, len(ids), np.int32)),
            pa.StructArray.from_arrays(b.columns, fields=list(b.schema))], names=["id", "n_ids", "row"])


def _line_type(rows: T.StructType) -> T.StructType:
    return T.StructType([T.StructField("id", T.LongType()), T.StructField("n_ids", T.IntegerType()), T.StructField("row", rows)])


def _lines_task(ids_col: str):
    """Rows to the lines of blocks of ``DECODE_BYTES``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            block.append(batch)
            size += batch.nbytes
            if size >= DECODE_BYTES:
                yield from _lines(block, ids_col)
                block, size = [], 0
        if block:
            yield from _lines(block, ids_col)

    return run


def _block_lines(left: pa.Table, right: pa.Table) -> pa.Table:
    """The lines of a block whose ids are joined back."""
    block = _join_block(left, right).combine_chunks().to_batches()
    return pa.Table.from_batches(_lines(block, "ids"))


def _decode_task(schema: T.StructType, ids_col: str, out_col: str):
    """Lines with their pieces (id, n_ids, row, piece) back to rows with their text."""
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: list[tuple[pa.Array, pa.Array]] = []  # a block's ids and pieces
        in_rows = False

        def decoded(row: pa.StructArray, n_ids: int) -> pa.RecordBatch:
            ids = pa.concat_arrays([t[0] for t in table]).to_numpy()
            words = pa.concat_arrays([t[1] for t in table])
            if len(ids) != n_ids or (np.diff(ids) <= 0).any():
                raise RuntimeError("the ids of a block are missing or out of order")
            found = dict(zip((f.name for f in row.type), row.flatten()))
            own = found[ids_col]
            flat = own.flatten()
            place = np.searchsorted(ids, flat.fill_null(-1).to_numpy())
            texts = words.take(pa.array(place, mask=flat.is_null().to_numpy(zero_copy_only=False)))
            keep = texts.is_valid().to_numpy(zero_copy_only=False)
            ends = np.cumsum(pc.fill_null(pc.list_value_length(own), 0).to_numpy(zero_copy_only=False))
            offsets = np.append(0, np.cumsum(keep))[np.append(0, ends)]
            joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), texts.drop_null()), " ")
            found[out_col] = pc.if_else(own.is_null(), pa.scalar(None, pa.string()), joined)
            return pa.RecordBatch.from_arrays([found[n] for n in names], names=names)

        for batch in batches:
            id_, n_ids, row, piece = batch.columns
            is_row = n_ids.is_valid().to_numpy(zero_copy_only=False)
            cuts = np.append(0, np.flatnonzero(np.diff(is_row)) + 1) if len(is_row) else []
            for at, end in zip(cuts, np.append(cuts[1:], len(is_row))):
                part = slice(int(at), int(end))
                if is_row[at]:
                    yield decoded(row[part], n_ids[part][0].as_py())
                else:
                    if in_rows:
                        table.clear()
                    table.append((id_[part], piece[part]))
                in_rows = bool(is_row[at])

    return run


def decode(df: DataFrame, vocab_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``df`` plus the decoded text of ``ids_col``: its pieces joined by one space.

    Tasks put the distinct ids of a block of rows (``DECODE_BYTES``) before its
    rows, one a line; lines are joined to the id-to-piece table; the pieces then
    stand before the rows that need them and replace their ids by place. The
    table is broadcast: it has one row an id of the vocabulary, at most
    ``MOST_PIECES`` whatever the data. Such a join keeps the order of lines
    inside their task, which is checked; nothing is shuffled.

    Null ids stay null; no ids give an empty text; ids that the table lacks, and
    nulls among the ids, are left out of the text; other columns pass through.
    """
    rows = df.select(*[F.col(f"`{c}`") for c in df.columns if c != out_col])
    lines = rows.mapInArrow(handing_back(_lines_task(ids_col)), _line_type(rows.schema))
    return _decoded(lines, vocab_path, rows.schema, ids_col, out_col)


def _decoded(lines: DataFrame, vocab_path: str, rows: T.StructType, ids_col: str, out_col: str) -> DataFrame:
    """Rows with their text from lines, by a join with the id-to-piece table."""
    table = pieces(vocab_path)
    if len(table) > MOST_PIECES:
        raise ValueError(f"a vocabulary of {len(table)} pieces is more than {MOST_PIECES}")
    by_id = stored(lines.sparkSession.createDataFrame(list(enumerate(table)), "piece_id long, piece string"), "bpe-pieces")
    schema = T.StructType([*rows.fields, T.StructField(out_col, T.StringType())])
    found = lines.join(F.broadcast(by_id), F.col("id") == F.col("piece_id"), "left").select("id", "n_ids", "row", "piece")
    return found.mapInArrow(handing_back(_decode_task(schema, ids_col, out_col)), schema)


def encode_decode(df: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row_id, ids, decoded): ``decode`` of ``encode``, where the blocks of the
    one are the blocks of the other, which saves each task a Python worker."""
    rows = T.StructType.fromDDL(_ENCODED)
    dealt, table = _dealt_and_encoded(df, vocab_path, id_col, text_col)
    lines = dealt.groupBy("block").cogroup(table.groupBy("block")).applyInArrow(_block_lines, _line_type(rows))
    return _decoded(lines, vocab_path, rows, "ids", "decoded")
