"""Edit-aware token counts over pre-token segment trees.

A document's text is cut into pre-tokens, and each has its length and its number
of tokens. Groups of pre-tokens are the leaves of a binary tree whose nodes hold
the characters and tokens below them. An edit finds its place by descending the
character sums, re-splits from a few characters before it until a boundary falls
on an old one again, re-encodes only those pre-tokens, and updates the sums on
the paths above. The root holds the document's count at any time.

The state is a DataFrame of flat arrays (``build``), so it can be stored and
edited again later (``apply_edits``); texts of one document never leave its row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEAF = 32                 # pre-tokens of a leaf when a tree is built
SPAN_CHARS = 1_000_000    # characters that are split at once
KNOWN_PIECES = 500_000    # pre-token counts a task keeps before it starts anew
#: Characters after a pre-token's end that its match may have looked at: the two
#: letters of an ending after an apostrophe, or the one after white space.
LOOKAHEAD = 3


class Counter(dict):
    """Tokens of a pre-token, encoded when first met."""

    def __init__(self, ranks: bytes, pattern: str):
        import base64

        import regex
        import tiktoken

        pairs = (line.split() for line in ranks.splitlines() if line)
        table = {base64.b64decode(piece): int(rank) for piece, rank in pairs}
        self.coder = tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.pattern = regex.compile(pattern)

    def __missing__(self, piece: str) -> int:
        if len(self) >= KNOWN_PIECES:
            self.clear()
        n = self[piece] = len(self.coder._encode_single_piece(piece))
        return n

    def split(self, text: str) -> Iterator[list[str]]:
        """Pre-tokens, span by span. Spans are cut before white space that
        follows other characters, which is a boundary in any text."""
        start = 0
        while start < len(text):
            cut = text.find(" ", start + SPAN_CHARS)
            while cut > 0 and text[cut - 1].isspace():
                cut = text.find(" ", cut + 1)
            stop = cut if cut > 0 else len(text)
            yield self.pattern.findall(text[start:stop] if start or stop < len(text) else text)
            start = stop


class SegmentTree:
    """Leaves are [lengths, counts] of consecutive pre-tokens."""

    def __init__(self, lengths: list[int], counts: list[int]):
        self._load(lengths, counts)

    def _load(self, lengths, counts):
        self.leaves = [[lengths[i:i + LEAF], counts[i:i + LEAF]] for i in range(0, len(lengths), LEAF)] or [[[], []]]
        self.width = 1 << (len(self.leaves) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.width), [0] * (2 * self.width)
        for i, (a, b) in enumerate(self.leaves):
            self.chars[self.width + i], self.tokens[self.width + i] = sum(a), sum(b)
        for i in range(self.width - 1, 0, -1):
            self._sum(i)

    def _sum(self, i: int) -> None:
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def flat(self) -> tuple[list[int], list[int]]:
        return [x for a, _ in self.leaves for x in a], [x for _, b in self.leaves for x in b]

    @property
    def total(self) -> int:
        return self.tokens[1]

    def locate(self, char: int) -> tuple[int, int, int]:
        """(leaf, place in it, first character) of the pre-token that holds a
        character; the end of the last one for a character beyond."""
        node, before = 1, 0
        while node < self.width:
            node *= 2
            if before + self.chars[node] <= char and self.chars[node + 1]:
                before += self.chars[node]
                node += 1
        leaf, place = node - self.width, 0
        if leaf >= len(self.leaves):
            leaf = len(self.leaves) - 1
            return leaf, len(self.leaves[leaf][0]), self.chars[1]
        for n in self.leaves[leaf][0]:
            if before + n > char:
                break
            before += n
            place += 1
        return leaf, place, before

    def replace(self, first: tuple[int, int], last: tuple[int, int], lengths: list[int], counts: list[int]) -> None:
        """Put new pre-tokens in place of those from ``first`` up to ``last``
        (leaf and place, last excluded)."""
        (a, i), (b, j) = first, last
        if a == b:
            old = self.leaves[a]
            self.leaves[a] = [old[0][:i] + lengths + old[0][j:], old[1][:i] + counts + old[1][j:]]
        else:
            self.leaves[a] = [self.leaves[a][0][:i] + lengths, self.leaves[a][1][:i] + counts]
            for k in range(a + 1, b):
                self.leaves[k] = [[], []]
            self.leaves[b] = [self.leaves[b][0][j:], self.leaves[b][1][j:]]
        if len(self.leaves[a][0]) > 8 * LEAF:  # grown out of balance
            self._load(*self.flat())
            return
        nodes = set()
        for k in range(a, b + 1):
            self.chars[self.width + k], self.tokens[self.width + k] = (sum(x) for x in self.leaves[k])
            nodes.add((self.width + k) // 2)
        while nodes and nodes != {0}:
            for n in nodes:
                self._sum(n)
            nodes = {n // 2 for n in nodes} - {0}


def edit(tree: SegmentTree, text: str, start: int, stop: int, put: str, counter: Counter) -> tuple[str, int]:
    """Replace text[start:stop] by ``put``: (new text, pre-tokens encoded again).
    Places outside the text are moved to its ends."""
    start = min(max(start, 0), len(text))
    stop = min(max(stop, start), len(text))
    new = text[:start] + put + text[stop:]
    leaf, place, at = tree.locate(max(0, start - LOOKAHEAD))
    first, old = (leaf, place), at
    settled, shift = start + len(put), len(new) - len(text)
    lengths, counts = [], []
    while at < len(new) or old < len(text):
        # pass the old pre-tokens that the new ones have covered
        while old < at - shift or old < stop:
            while place >= len(tree.leaves[leaf][0]):
                leaf, place = leaf + 1, 0
            old += tree.leaves[leaf][0][place]
            place += 1
        if at >= settled and at - shift == old:
            break
        if at >= len(new):
            old = len(text)
            leaf, place = len(tree.leaves) - 1, len(tree.leaves[-1][0])
            break
        match = counter.pattern.match(new, at)
        piece = match[0]
        lengths.append(len(piece))
        counts.append(counter[piece])
        at = match.end()
    tree.replace(first, (leaf, place), lengths, counts)
    return new, len(lengths)


_STATE = T.StructType([T.StructField("tree_lengths", T.BinaryType()), T.StructField("tree_counts", T.BinaryType()),
                       T.StructField("n_tokens", T.LongType())])


def _with(df: DataFrame, fields: list[T.StructField], drop: tuple[str, ...] = ()) -> T.StructType:
    return T.StructType([f for f in df.schema.fields if f.name not in drop] + fields)


def build(df: DataFrame, ranks_path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """``df`` plus the tree of every text (``tree_lengths``, ``tree_counts``:
    32-bit numbers, one a pre-token) and ``n_tokens``.

    ``ranks_path`` names a rank file, which the driver reads (about a MB) and
    ships; ``pattern`` splits text before the merges. Defined cases: a null text
    is an empty tree with 0 tokens; other columns pass through; equal rows give
    equal trees; an empty table gives no rows.
    """
    ranks = open(ranks_path, "rb").read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(ranks, pattern)
        for batch in batches:
            lengths, counts, totals = [], [], []
            for text in batch.column(text_col):
                size, tokens = [], []
                for pieces in counter.split(text.as_py() or ""):
                    size.append(np.fromiter(map(len, pieces), "<u4", len(pieces)))
                    tokens.append(np.fromiter(map(counter.__getitem__, pieces), "<u4", len(pieces)))
                lengths.append(b"".join(x.tobytes() for x in size))
                counts.append(b"".join(x.tobytes() for x in tokens))
                totals.append(int(sum(int(x.sum()) for x in tokens)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lengths, pa.binary()), pa.array(counts, pa.binary()), pa.array(totals, pa.int64())],
                names=[*batch.schema.names, *_STATE.names])

    return df.mapInArrow(run, _with(df, _STATE.fields))


def apply_edits(df: DataFrame, ranks_path: str, pattern: str, edits_col: str = "edits",
                text_col: str = "text") -> DataFrame:
    """A ``build`` result with ``edits_col`` (array of struct<start, stop, put>,
    in code points) applied in turn, each to the text that the one before left.
    Text, tree and n_tokens are brought up to date; n_encoded is the number of
    pre-tokens that were encoded again.

    Defined cases: null edits, or none, change nothing; a null text is edited
    as an empty one (and stays null without edits); places outside the text are
    moved to its ends; a null ``put`` is empty, null places are 0.
    """
    ranks = open(ranks_path, "rb").read()
    changed = ("tree_lengths", "tree_counts", "n_tokens", text_col)
    schema = _with(df, [df.schema[text_col], *_STATE.fields, T.StructField("n_encoded", T.LongType())], changed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(ranks, pattern)
        for batch in batches:
            out: dict[str, list] = {k: [] for k in (text_col, *_STATE.names, "n_encoded")}
            columns = [batch.column(c) for c in (text_col, "tree_lengths", "tree_counts", "n_tokens", edits_col)]
            for row in zip(*columns):
                text, lengths, counts, total, edits = (x.as_py() for x in row)
                encoded = 0
                if edits:
                    tree = SegmentTree(np.frombuffer(lengths, "<u4").tolist(), np.frombuffer(counts, "<u4").tolist())
                    text = text or ""
                    for e in edits:
                        text, n = edit(tree, text, e["start"] or 0, e["stop"] or 0, e["put"] or "", counter)
                        encoded += n
                    a, b = tree.flat()
                    lengths, counts, total = np.array(a, "<u4").tobytes(), np.array(b, "<u4").tobytes(), tree.total
                for k, v in zip(out, (text, lengths, counts, total, encoded)):
                    out[k].append(v)
            kinds = [pa.string(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
            keep = [n for n in batch.schema.names if n not in changed]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in keep), *(pa.array(v, kind) for v, kind in zip(out.values(), kinds))],
                names=[*keep, *out])

    return df.mapInArrow(run, schema)


def edits_of(*edits: tuple) -> "F.Column":
    """An edits column from (start, stop, put) columns."""
    return F.array(*[F.struct(F.lit(a).cast("int").alias("start"), F.lit(b).cast("int").alias("stop"),
                              F.lit(p).cast("string").alias("put")) for a, b, p in edits])
