"""Word shingles of texts as sorted 64-bit hashes, for use inside tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

GROUP_BYTES = 4_000_000  # texts that are hashed at once; longer ones go alone
KNOWN_WORDS = 100_000  # word hashes a task keeps before it starts anew


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words, kept while there is room."""

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh64_intdigest

        if len(self) >= KNOWN_WORDS:
            self.clear()
        h = self[word] = xxh64_intdigest(word)
        return h

    def of(self, text: bytes) -> np.ndarray:
        """Hashes of the words of a text (A-Z lowered, cut at ASCII white space)."""
        found = [np.fromiter(map(self.__getitem__, words), np.uint64, len(words))
                 for words in (part.lower().split() for part in parts(text))]
        return found[0] if len(found) == 1 else np.concatenate(found)


def parts(text: bytes) -> Iterator[bytes]:
    """A text in parts of a few MB, cut at ASCII white space; at least one."""
    start = 0
    while True:
        end = start + GROUP_BYTES
        while end < len(text) and text[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        yield text[start:end] if start or end < len(text) else text
        if end >= len(text):
            return
        start = end


def groups(texts: Iterable[bytes]) -> Iterator[list[bytes]]:
    """Consecutive texts of a few MB together."""
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t)
        if size >= GROUP_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def shingle_sets(texts: list[bytes], width: int, known: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after the other, and
    the offsets between texts. A text of 1 to width-1 words is one shingle; a
    text without words has none."""
    odd = np.uint64(0x9E3779B97F4A7C15)
    words = [known.of(t) for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    with np.errstate(over="ignore"):
        flat = np.concatenate(words) if words else np.zeros(0, np.uint64)
        n = max(0, len(flat) - width + 1)
        rolled = np.zeros(n, np.uint64)
        for k in range(width):
            rolled = rolled * odd + flat[k:k + n]
        rolled = mix(rolled)
        ends = np.cumsum(sizes)
        parts = []
        for size, end, w in zip(sizes.tolist(), ends.tolist(), words):
            if size >= width:
                part = rolled[end - size:end - width + 1]
                part.sort()
            elif size:
                one = np.uint64(size)
                for h in w:
                    one = one * odd + h
                part = mix(np.array([one], np.uint64))
            else:
                part = w
            parts.append(part)
    flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    ends = np.cumsum([len(p) for p in parts], dtype=np.int64)
    keep = np.ones(len(flat), bool)
    keep[1:] = flat[1:] != flat[:-1]
    starts = np.append(0, ends[:-1])
    keep[starts[starts < ends]] = True
    before = np.append(0, np.cumsum(keep))
    return flat[keep], np.append(0, before[ends])
