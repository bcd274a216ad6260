"""Fill-in-the-middle rearrangement with a piece table for each document.

A document becomes a list of descriptors (buffer, start, length) over two
buffers that never change: the document's bytes and the sentinels. It begins as
one descriptor. A cut splits a descriptor in two; an arrangement permutes the
descriptors and puts sentinels between them; the inverse permutation restores
the document. Digests read the buffers through the descriptors.

All work is done in the tasks that read the texts: nothing is shuffled. Units
are counted in blocks of ``BLOCK`` bytes, so a task holds a text and little
more.

Defined cases: a null text is empty, and an empty text stays plain; a null id
counts as the empty string in the draw; repeated rows are all returned; other
columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The sentinels before prefix, suffix and middle.
SENTINELS = b"<P><S><M>"
PLAIN_PERCENT = 10  # of documents that stay as they are
SPM_PERCENT = 20    # of the others that put the suffix first
BLOCK = 1 << 20

TEXT, MARK = 0, 1
P, S, M = (MARK, 0, 3), (MARK, 3, 3), (MARK, 6, 3)

Piece = tuple[int, int, int]


def _unit_starts(data: np.ndarray, after_letter: bool) -> tuple[np.ndarray, bool]:
    """Whether a unit (a run of ASCII letters, or one other character) begins at
    each byte, and whether the last byte is a letter."""
    letter = ((data | 0x20) >= 0x61) & ((data | 0x20) <= 0x7A)
    begins = (data & 0xC0) != 0x80
    begins[1:] &= ~(letter[1:] & letter[:-1])
    if after_letter and letter[0]:
        begins[0] = False
    return begins, bool(letter[-1])


class Units:
    """Number and places of the units of a text (UTF-8)."""

    def __init__(self, text: bytes):
        self.data = np.frombuffer(text, np.uint8)
        self.blocks: list[tuple[int, int, bool]] = []  # units before, first byte, follows a letter
        self.count, letter = 0, False
        for at in range(0, len(text), BLOCK):
            self.blocks.append((self.count, at, letter))
            begins, letter = _unit_starts(self.data[at:at + BLOCK], letter)
            self.count += int(begins.sum())

    def place(self, k: int) -> int:
        """The byte at which unit ``k`` begins; the end for k = count."""
        if k >= self.count:
            return len(self.data)
        before, at, letter = next(b for b in reversed(self.blocks) if b[0] <= k)
        begins, _ = _unit_starts(self.data[at:at + BLOCK], letter)
        return at + int(np.flatnonzero(begins)[k - before])


def cut(pieces: list[Piece], *places: int) -> list[Piece]:
    """``pieces`` with a border at each of ``places`` (bytes from the start);
    a border at a border leaves an empty piece, so n cuts of one piece always
    give n + 1."""
    out = []
    begun, places = 0, list(places)
    for k, (buffer, start, length) in enumerate(pieces):
        last = k == len(pieces) - 1
        while places and (places[0] < begun + length or last and places[0] <= begun + length):
            head = places.pop(0) - begun
            out.append((buffer, start, head))
            begun, start, length = begun + head, start + head, length - head
        out.append((buffer, start, length))
        begun += length
    return out


def arrange(pieces: list[Piece], form: str) -> list[Piece]:
    """Prefix, middle and suffix in the order of ``form``, behind sentinels."""
    if form == "plain":
        return pieces
    prefix, middle, suffix = pieces
    return [P, prefix, S, suffix, M, middle] if form == "psm" else [S, suffix, P, prefix, M, middle]


def inverse(output: bytes, form: str) -> list[Piece]:
    """The document's pieces, in its own order, over an output as buffer."""
    if form == "plain":
        return [(TEXT, 0, len(output))]
    first, second = (b"<P>", b"<S>") if form == "psm" else (b"<S>", b"<P>")
    if not output.startswith(first):
        raise ValueError("the output does not begin with its sentinel")
    two = output.index(second, 3)
    three = output.index(b"<M>", two + 3)
    pieces = cut([(TEXT, 0, len(output))], 3, two, two + 3, three, three + 3)
    order = (1, 5, 3) if form == "psm" else (3, 5, 1)
    return [pieces[k] for k in order]


def _views(pieces: list[Piece], text: bytes) -> Iterator[memoryview]:
    buffers = memoryview(text), memoryview(SENTINELS)
    for buffer, start, length in pieces:
        yield buffers[buffer][start:start + length]


def digest(pieces: list[Piece], text: bytes) -> str:
    """SHA-256 of what the pieces show."""
    h = sha256()
    for view in _views(pieces, text):
        h.update(view)
    return h.hexdigest()


def rearranged(text: bytes, key: str, plain_percent: int, spm_percent: int) -> tuple[int, str, list[Piece]]:
    """(units, form, pieces in the document's order): three pieces, or one if
    the form is plain. The draw depends on ``key`` and the number of units alone."""
    h = [int(x, 16) for x in map(sha256(f"1:{key}".encode()).hexdigest().__getitem__,
                                 (slice(0, 8), slice(8, 16), slice(16, 24), slice(24, 32)))]
    units = Units(text)
    n = units.count
    whole = [(TEXT, 0, len(text))]
    if not text or h[2] % 100 >= 100 - plain_percent or any(SENTINELS[k:k + 3] in text for k in (0, 3, 6)):
        return n, "plain", whole
    borders = sorted(x % (n + 1) for x in h[:2])
    return n, "spm" if h[3] % 100 < spm_percent else "psm", cut(whole, *map(units.place, borders))


def _chars(piece: Piece, text: bytes) -> int:
    data = np.frombuffer(text, np.uint8)[piece[1]:piece[1] + piece[2]]
    return sum(int(((data[a:a + BLOCK] & 0xC0) != 0x80).sum()) for a in range(0, len(data), BLOCK))


_HEAD = "doc_id long, n long, form string, prefix_chars long, middle_chars long"


def _task(plain_percent: int, spm_percent: int, digests: bool):
    head = [("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()),
            ("prefix_chars", pa.int64()), ("middle_chars", pa.int64())]
    tail = ([("output_sha256", pa.string()), ("restored_sha256", pa.string())] if digests else
            [("pieces", pa.list_(pa.struct([("buffer", pa.string()), ("start", pa.int64()), ("length", pa.int64())]))),
             ("output", pa.binary())])
    schema = pa.schema(head + tail)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = value.as_py() or b""
                n, form, parts = rearranged(text, "" if i is None else str(i), plain_percent, spm_percent)
                sizes = (None, None) if form == "plain" else (_chars(parts[0], text), _chars(parts[1], text))
                pieces = arrange(parts, form)
                output = b"".join(_views(pieces, text))
                if digests:
                    rows.append((i, n, form, *sizes, digest(pieces, text), digest(inverse(output, form), output)))
                else:
                    rows.append((i, n, form, *sizes, [{"buffer": ("text", "sentinels")[b], "start": s, "length": c}
                                                      for b, s, c in pieces], output))
            columns = list(zip(*rows)) or [[]] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def _rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("doc_id"),
                     F.col(text_col).cast("string").cast("binary").alias("text"))


def fill_in_middle(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   plain_percent: int = PLAIN_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, pieces, output) of every row.

    ``n`` counts the units a cut can fall between; ``pieces`` are the
    descriptors (buffer, start, length in bytes) that make up ``output``. A text
    that contains a sentinel stays plain, so that every output can be restored.
    """
    out = _rows(df, id_col, text_col).mapInArrow(
        _task(plain_percent, spm_percent, False),
        _HEAD + ", pieces array<struct<buffer:string,start:bigint,length:bigint>>, output binary")
    return out.withColumn("output", F.col("output").cast("string"))


def fill_in_middle_digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                           plain_percent: int = PLAIN_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """As ``fill_in_middle``, with the SHA-256 of the output and of the text that
    output and form give back instead of the texts."""
    return _rows(df, id_col, text_col).mapInArrow(
        _task(plain_percent, spm_percent, True), _HEAD + ", output_sha256 string, restored_sha256 string")


def _restore_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for value, form in zip(batch.column("output"), batch.column("form").to_pylist()):
            output = value.as_py()
            texts.append(None if output is None or form is None else b"".join(_views(inverse(output, form), output)))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.binary())], names=["doc_id", "text"])


def restore(df: DataFrame, id_col: str = "doc_id", output_col: str = "output", form_col: str = "form") -> DataFrame:
    """(doc_id, text): the documents that outputs were made of, from output and
    form alone. A null output or form gives a null text; an output that lacks the
    sentinels of its form fails the job."""
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"),
                     F.col(output_col).cast("string").cast("binary").alias("output"), F.col(form_col).alias("form"))
    return rows.mapInArrow(_restore_task, "doc_id long, text binary").withColumn("text", F.col("text").cast("string"))
