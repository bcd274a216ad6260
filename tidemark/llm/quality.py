"""Quality rules by distribution divergence.

Two histograms of a document, its character classes and its common words, are
compared with those of the languages by the Jensen-Shannon distance (base 2,
so 0 to 1). A document far from its language's reference is rejected; a
document too short to fill a histogram is not judged by it. The sampling noise
of a histogram falls with the square root of its size, and so does the distance
that is allowed.

The references are corpus counts over all rows: character classes and words by
language, summed in Spark. A reference has the ``COMMON_WORDS`` most frequent
words of a language, so what reaches the driver and the tasks is bounded by the
number of languages, never by the corpus.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import handing_back, stored
from tidemark.llm.shingles import parts

COMMON_WORDS = 100          # words of a language's reference
REFERENCE_WORDS = 1000      # words a language needs to have a reference
MIN_CHARS, MIN_WORDS = 400, 60       # below these a histogram is not judged
CHAR_LIMIT = (0.25, 1.5)    # allowed distance: first + second / sqrt(characters)
WORD_LIMIT = (0.32, 1.5)    # allowed distance: first + second / sqrt(words)
HELD_WORDS = 200_000        # distinct words a counting task holds at once, of all languages

# The base rules.
BASE_WORDS = 20
WINDOW_WORDS = 8
REPEAT_PERCENT = 30
SYMBOLS = b"#*$%&|<>"
GAPS = b"\x20\x09\x0a\x0b\x0c\x0d"

#: Character classes: lower, upper, digit, space, other gap, punctuation, other
#: ASCII, beyond ASCII.
CLASSES = 8


def _class_of_bytes() -> np.ndarray:
    """A class for each byte that begins a character; 255 for other bytes."""
    def one(b: int) -> int:
        c = chr(b)
        if b >= 128:
            return 7 if b >= 192 else 255
        if c.islower() or c.isupper():
            return int(c.isupper())
        if c.isdigit():
            return 2
        if b in GAPS:
            return 3 if c == " " else 4
        return 5 if c in ".,;:!?'\"-()" else 6

    return np.array([one(b) for b in range(256)], np.uint8)


BYTE_CLASS = _class_of_bytes()


def byte_counts(text: bytes) -> np.ndarray:
    return np.bincount(np.frombuffer(text, np.uint8), minlength=256)


def class_counts(by_byte: np.ndarray) -> np.ndarray:
    heads = BYTE_CLASS != 255
    return np.bincount(BYTE_CLASS[heads], by_byte[heads], CLASSES)


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance (base 2) of two histograms with a positive sum."""
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2

    def divergence(a):
        on = a > 0
        return float((a[on] * np.log2(a[on] / m[on])).sum())

    return max(0.0, (divergence(p) + divergence(q)) / 2) ** 0.5


def repeated_words(ids: np.ndarray) -> int:
    """Words inside windows of ``WINDOW_WORDS`` words that occur twice or more.
    Windows are numbered exactly, by pairs of pairs of pairs."""
    step = 1
    codes = ids
    while step < WINDOW_WORDS:
        if len(codes) <= step:
            return 0
        pairs = codes[:-step] * (int(codes.max()) + 1) + codes[step:]
        seen, codes = np.unique(pairs, return_inverse=True)
        if len(seen) == len(pairs):
            return 0
        step *= 2
    often = (np.bincount(codes) > 1)[codes]
    delta = np.zeros(len(ids) + 1, np.int64)
    delta[:len(codes)] += often
    delta[WINDOW_WORDS:WINDOW_WORDS + len(codes)] -= often
    return int((np.cumsum(delta) > 0).sum())


def _texts(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words: dict[str, Counter] = {}
    classes: dict[str, np.ndarray] = {}
    held = 0

    def flush():
        rows = [(k, w, n) for k, c in words.items() for w, n in c.items()]
        rows += [(k, None, 0) for k in classes]
        sums = [None] * (len(rows) - len(classes)) + [v.tolist() for v in classes.values()]
        words.clear()
        classes.clear()
        return pa.RecordBatch.from_pydict({
            "lang": pa.array([r[0] for r in rows], pa.string()), "word": pa.array([r[1] for r in rows], pa.binary()),
            "n": pa.array([r[2] for r in rows], pa.int64()), "classes": pa.array(sums, pa.list_(pa.int64()))})

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), _texts(batch.column(1))):
            counter = words.setdefault(lang, Counter())
            held -= len(counter)
            for part in parts(text):
                counter.update(part.lower().split())
            counts = class_counts(byte_counts(text)).astype(np.int64)
            classes[lang] = classes[lang] + counts if lang in classes else counts
            held += len(counter)
            if held >= HELD_WORDS:
                yield flush()
                held = 0
    yield flush()


def references(df: DataFrame, text_col: str = "text", lang_col: str = "lang",
               common: int = COMMON_WORDS) -> dict[str, tuple[dict[bytes, int], np.ndarray, np.ndarray]]:
    """For each language: its common words with their places, their counts with
    all other words last, and its character class counts. Counted over all rows
    with a language; small languages have no reference."""
    counted = stored(df.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
                     .where("lang is not null and text is not null")
                     .mapInArrow(handing_back(_count_task), "lang string, word binary, n long, classes array<long>")
                     .where("word is not null or classes is not null"), "quality-counts")
    by_word = counted.where("word is not null").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.col("n").desc(), "word")
    top = by_word.withColumn("place", F.row_number().over(order)).where(F.col("place") <= common)
    total = (counted.where("classes is not null").groupBy("lang")
             .agg(*[F.sum(F.col("classes")[k]).alias(f"c{k}") for k in range(CLASSES)]))
    words = counted.where("word is not null").groupBy("lang").agg(F.sum("n").alias("words"))
    classes = {r["lang"]: (r["words"], np.array([float(r[f"c{k}"]) for k in range(CLASSES)]))
               for r in total.join(words, "lang").collect()}
    found: dict[str, list] = {}
    for r in top.orderBy("lang", "place").collect():
        found.setdefault(r["lang"], []).append((bytes(r["word"]), r["n"]))
    return {lang: ({w: i for i, (w, _) in enumerate(rows)},
                   np.array([float(n) for _, n in rows] + [float(classes[lang][0] - sum(n for _, n in rows))]),
                   classes[lang][1])
            for lang, rows in found.items() if classes[lang][0] >= REFERENCE_WORDS}


def measure(text: bytes, lang: str | None, refs: dict) -> tuple:
    """The figures and verdict of one text; see ``quality_rules``."""
    by_byte = byte_counts(text)
    n_symbols = int(by_byte[list(SYMBOLS)].sum())
    chars = int(by_byte[BYTE_CLASS != 255].sum())
    word_chars = chars - int(by_byte[list(GAPS)].sum())
    number: dict[bytes, int] = {}
    ids = np.concatenate([np.array([number.setdefault(w, len(number)) for w in part.split()], np.int64)
                          for part in parts(text)])
    lines = Counter(text.split(b"\n")) if b"\n" in text else {}
    n_dup = sum(n - 1 for line, n in lines.items() if n > 1 and line.strip())
    n_words, n_repeat = len(ids), repeated_words(ids)
    failed = n_words < BASE_WORDS or 100 * n_repeat > REPEAT_PERCENT * n_words
    near = [refs[lang]] if lang in refs else list(refs.values())
    by_class, by_word, fits = None, None, True
    if near and chars:
        own = class_counts(by_byte)
        by_class = min(js_distance(own, r[2]) for r in near)
        if chars >= MIN_CHARS:
            fits = by_class <= CHAR_LIMIT[0] + CHAR_LIMIT[1] / chars ** 0.5
    if near and n_words:
        uses = np.bincount(ids)
        by_word = 1.0
        for places, counts, _ in near:
            hist = np.zeros(len(counts))
            for w, i in number.items():
                hist[places.get(w.lower(), -1)] += uses[i]
            by_word = min(by_word, js_distance(hist, counts))
        if n_words >= MIN_WORDS:
            fits = fits and by_word <= WORD_LIMIT[0] + WORD_LIMIT[1] / n_words ** 0.5
    return (n_words, word_chars, n_symbols, n_dup, n_repeat, failed, not failed and fits, by_class, by_word)


FIGURES = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "base_failed boolean, kept boolean, char_distance double, word_distance double")


def judged(df: DataFrame, text_col: str = "text", lang_col: str = "lang", refs: dict | None = None,
           out_col: str = "__quality") -> DataFrame:
    """All columns of ``df`` plus a struct of ``FIGURES``; see ``quality_rules``."""
    refs = references(df, text_col, lang_col) if refs is None else refs
    figures = T.StructType.fromDDL(FIGURES)
    kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(lang_col).cast(pa.string()).to_pylist()
            rows = [measure(t, lang, refs) for t, lang in zip(_texts(batch.column(text_col)), langs)]
            struct = pa.StructArray.from_arrays(
                [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)],
                names=[f.name for f in figures.fields])
            yield pa.RecordBatch.from_arrays([*batch.columns, struct], names=[*batch.schema.names, out_col])

    return df.mapInArrow(handing_back(run), T.StructType([*df.schema.fields, T.StructField(out_col, figures)]))


def quality_rules(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  refs: dict | None = None) -> DataFrame:
    """(doc_id, figures, verdict) for every row of ``df``; the columns are
    ``FIGURES``.

    ``kept`` is false when a base rule fails or when a histogram is farther
    than allowed from the reference of the row's language. ``refs`` defaults to
    those of ``df`` itself.

    Defined cases: a null text counts as empty: no words, base failed, null
    distances; a null language, or one without a reference, takes the nearest
    reference; without any reference only the base rules judge; equal rows get
    equal results; an empty table gives no rows. Other columns are not read.
    """
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"),
                     F.col(text_col).cast("string").alias("text"))
    return judged(rows, refs=refs).select("doc_id", "__quality.*")
