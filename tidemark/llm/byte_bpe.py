"""Byte-level BPE ids of many texts, each distinct piece of a block encoded once.

Texts are cut before every space that follows a character other than white
space. No pre-token of the byte-level splitter runs over such a place, and what
is left of it does not depend on what is right of it, so the pieces can be
encoded apart. A block's pieces are numbered by Arrow's dictionary encoding and
only the distinct ones are encoded, all in one call.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidemark.llm.bpe import _byte_chars

# The splitter's pattern of byte-level BPE, and white space.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_BLANK = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_ODD = rf"^{_BLANK}|{_BLANK}\z|{_BLANK} "
_ODD_PIECE = rf"^{_BLANK}|{_BLANK}\z|^\z"
_CUT = re.compile(r"(?<=\S) (?!\Z)")


def cut(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(pieces, number of pieces of each text, order of the texts): the pieces
    without the space that each but a text's first begins with. Texts whose white
    space is other than single spaces come last; ``order`` gives the places."""
    odd = pc.match_substring_regex(texts, _ODD).to_numpy(zero_copy_only=False).astype(bool)
    order = np.argsort(odd, kind="stable")
    plain = pc.split_pattern(texts.filter(pa.array(~odd)), " ")
    apart = [_CUT.split(t) for t in texts.filter(pa.array(odd)).to_pylist()]
    counts = np.append(np.diff(plain.offsets.to_numpy()), [len(p) for p in apart]).astype(np.int64)
    pieces = [plain.flatten(), pa.array([p for parts in apart for p in parts], pa.string())]
    return pa.concat_arrays(pieces), counts, order


def numbered(pieces: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(distinct pieces, the number of each piece among them)."""
    coded = pieces.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)


def gather(flat: np.ndarray, lens: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values, how many) of the lists ``numbers``, one after the other; list i
    has lens[i] values of ``flat``."""
    offsets = np.append(0, np.cumsum(lens)).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
    return lists.take(pa.array(numbers)).flatten().to_numpy(zero_copy_only=False), lens[numbers]


class ByteBpe:
    """Ids of a byte-level tokenizer file (the content of its JSON).

    Merges follow the order of the ids in such a file, so ids serve as ranks;
    a file where they do not is refused.
    """

    def __init__(self, vocab_json: str):
        import tiktoken

        data = json.loads(vocab_json)
        splitter = data["pre_tokenizer"] or {}
        if splitter.get("type") != "ByteLevel" or splitter.get("add_prefix_space") or data["normalizer"]:
            raise ValueError("not the file of a byte-level tokenizer that takes texts as they are")
        vocab = data["model"]["vocab"]
        merged = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in data["model"]["merges"]]
        if any(a >= b for a, b in zip(merged, merged[1:])):
            raise ValueError("the ids of this vocabulary are not in the order of its merges")
        byte = {c: b for b, c in enumerate(_byte_chars())}
        special = {t["content"]: t["id"] for t in data["added_tokens"]}
        ranks = {bytes(byte[c] for c in t): i for t, i in vocab.items() if t not in special}
        self.coder = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.special = special
        self.pieces = [b""] * (max([*ranks.values(), *special.values()]) + 1)
        for piece, i in [*ranks.items(), *((t.encode(), i) for t, i in special.items())]:
            self.pieces[i] = piece
        self.sizes = np.array([len(p) for p in self.pieces])

    def ids(self, text: str, with_special: bool = False) -> list[int]:
        """Ids of one text; special tokens in it are plain text unless wanted."""
        if with_special and any(s in text for s in self.special):
            return self.coder.encode(text, allowed_special="all")
        return self.coder.encode_ordinary(text)

    def ids_of_pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each piece) of distinct pieces of ``cut``, the
        space before each included."""
        if not len(pieces):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        odd = pc.match_substring_regex(pieces, _ODD_PIECE).to_numpy(zero_copy_only=False).astype(bool)
        sizes = pc.binary_length(pieces).to_numpy().astype(np.int64) + 1
        plain = pieces.filter(pa.array(~odd)).to_pylist()
        flat = np.array(self.coder.encode_ordinary(" " + " ".join(plain)) if plain else [], np.int64)
        lens = np.zeros(len(pieces), np.int64)
        reach = np.searchsorted(np.cumsum(self.sizes[flat]), np.cumsum(sizes[~odd])) + 1
        lens[~odd] = np.diff(reach, prepend=0)
        if not odd.any():
            return flat, lens
        apart = [self.coder.encode_ordinary(" " + p) for p in pieces.filter(pa.array(odd)).to_pylist()]
        lens[odd] = [len(x) for x in apart]
        owner = np.repeat(odd, lens)
        out = np.zeros(int(lens.sum()), np.int64)
        out[~owner] = flat
        out[owner] = np.array([i for x in apart for i in x], np.int64)
        return out, lens
