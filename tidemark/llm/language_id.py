"""Language identification with averaged hashed subword embeddings.

A text is the mean embedding of its hashed byte 2- to 4-grams (case folded,
everything but letters as a gap), followed by a linear softmax. The model is
trained by stochastic gradient descent in numpy on a bounded, documented
sample: of each language the ``SAMPLE_PER_LANG`` rows with the smallest id hash,
and of each of those rows one window of ``SAMPLE_CHARS`` characters at a hashed
place. A part of the sample is held back to calibrate: a temperature for the
probabilities, and the probability below which a prediction is rejected.

Prediction reads whole texts. Since the mean is linear, each bucket's logits are
worked out once and a text is one gather and one sum.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shingles import parts

BUCKETS = 1 << 17
DIMENSIONS = 16
GRAMS = (2, 3, 4)
SAMPLE_PER_LANG = 1500   # bound on the labelled rows of a language that train
SAMPLE_CHARS = 400       # and on what is read of each
CALIBRATION_SHARE = 5    # one sampled row in so many calibrates
EPOCHS, BATCH, RATE = 5, 32, 15.0
ACCEPTED_PRECISION = 0.99
UNDETERMINED = "und"


def _folded() -> np.ndarray:
    """Bytes as the grams see them: letters lowered, other ASCII as a space."""
    return np.array([b if b >= 128 else ord(chr(b).lower()) if chr(b).isalpha() else 32 for b in range(256)], np.uint32)


FOLDED = _folded()
GAP = np.array([32], np.uint32)


def gram_buckets(text: bytes) -> np.ndarray:
    """The buckets of a text's grams; grams over two gaps in a row don't count."""
    b = FOLDED[np.frombuffer(text, np.uint8)]
    b = np.concatenate((GAP, b, GAP))
    keep = np.ones(len(b), bool)
    keep[1:] = (b[1:] != 32) | (b[:-1] != 32)
    b = b[keep]
    found = []
    for n in GRAMS:
        size = len(b) - n + 1
        if size <= 0:
            continue
        h = b[:size] + np.uint32(n << 24 if n < 4 else 0)  # no text byte is below 32
        for k in range(1, n):
            h |= b[k:k + size] << np.uint32(8 * k)
        h *= np.uint32(0x9E3779B1)
        h >>= np.uint32(32 - 17)
        found.append(h)
    return np.concatenate(found) if found else np.zeros(0, np.uint32)


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray        # logits of a bucket, or its embedding
    weights: np.ndarray | None  # embedding to logits, where the table has embeddings
    bias: np.ndarray
    temperature: float
    accept: float            # smallest probability that is accepted

    def logits(self, text: bytes) -> np.ndarray:
        total, n = np.zeros(self.table.shape[1]), 0
        for part in parts(text):
            buckets = gram_buckets(part)
            total += self.table.take(buckets, 0).sum(0)
            n += len(buckets)
        mean = total / max(n, 1)
        return (mean if self.weights is None else mean @ self.weights) + self.bias

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, probability, accepted)."""
        if not text or not self.langs or not has_letter(text):
            return UNDETERMINED, 0.0, False
        p = _softmax(self.logits(text.encode())[None] / self.temperature)[0]
        best = int(p.argmax())
        score = min(1.0, max(0.0, float(p[best])))
        return self.langs[best], score, score >= self.accept


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def fit(rows: list[tuple[str, str]], seed: int = 0) -> Model:
    """A model from (text, language) rows, in the order given."""
    rows = [(t.encode(), lang) for t, lang in rows if has_letter(t)]
    langs = sorted({lang for _, lang in rows})
    if not langs:
        return Model([], np.zeros((BUCKETS, 1), np.float32), None, np.zeros(1), 1.0, 1.0)
    place = {lang: i for i, lang in enumerate(langs)}
    grams = [gram_buckets(t) for t, _ in rows]
    labels = np.array([place[lang] for _, lang in rows])
    rng = np.random.default_rng(seed)
    held = np.arange(len(rows)) % CALIBRATION_SHARE == CALIBRATION_SHARE - 1
    train = np.flatnonzero(~held)
    counts = np.bincount(labels[train], minlength=len(langs))
    importance = (len(train) / (len(langs) * np.maximum(counts, 1)))[labels]  # rare languages count as much

    emb = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    weights = np.zeros((DIMENSIONS, len(langs)))
    bias = np.zeros(len(langs))
    steps, done = EPOCHS * -(-len(train) // BATCH), 0
    for _ in range(EPOCHS):
        order = rng.permutation(train)
        for at in range(0, len(order), BATCH):
            batch = [i for i in order[at:at + BATCH] if len(grams[i])]
            if not batch:
                continue
            sizes = np.array([len(grams[i]) for i in batch])
            flat = np.concatenate([grams[i] for i in batch])
            starts = np.cumsum(sizes) - sizes
            mean = np.add.reduceat(emb[flat], starts) / sizes[:, None]
            slope = _softmax(mean @ weights + bias)
            slope[np.arange(len(batch)), labels[batch]] -= 1
            slope *= importance[batch][:, None] / len(batch)
            rate = RATE * (1 - done / steps)
            back = (slope @ weights.T) * rate * len(batch) / sizes[:, None]
            weights -= rate * mean.T @ slope
            bias -= rate * slope.sum(0)
            np.subtract.at(emb, flat, np.repeat(back, sizes, 0).astype(np.float32))
            done += 1
    if len(langs) <= DIMENSIONS:
        model = Model(langs, (emb @ weights).astype(np.float32), None, bias, 1.0, 0.0)
    else:
        model = Model(langs, emb, weights, bias, 1.0, 0.0)
    return _calibrate(model, [rows[i][0] for i in np.flatnonzero(held)], labels[held])


def _calibrate(model: Model, texts: list[bytes], labels: np.ndarray) -> Model:
    """Temperature of least log loss; then the smallest probability above which
    the held-back rows are predicted with the precision asked for."""
    if not texts:
        return model
    logits = np.stack([model.logits(t) for t in texts])
    each = np.arange(len(texts))

    def loss(t):
        return -np.log(np.maximum(_softmax(logits / t)[each, labels], 1e-12)).mean()

    model.temperature = float(min(np.geomspace(0.05, 20, 61), key=loss))
    p = _softmax(logits / model.temperature)
    order = np.argsort(-p.max(1), kind="stable")
    right = np.cumsum(p.argmax(1)[order] == labels[order]) / (each + 1)
    good = np.flatnonzero(right >= ACCEPTED_PRECISION)
    model.accept = float(p.max(1)[order][good[-1]]) if len(good) else 1.0
    return model


def training_sample(df: DataFrame, text_col: str, lang_col: str, id_col: str) -> list[tuple[str, str]]:
    """The bounded sample: (window, language), by language and id hash."""
    text = F.col(text_col).cast("string")
    mark = F.xxhash64(F.col(id_col).cast("string"), F.length(text))
    places = F.greatest(F.length(text) - SAMPLE_CHARS, F.lit(0)) + 1
    window = F.substring(text, F.pmod(mark, places).cast("int") + 1, F.lit(SAMPLE_CHARS))
    rows = (df.where(F.col(lang_col).isNotNull() & text.isNotNull())
            .select(F.col(lang_col).cast("string").alias("lang"), mark.alias("mark"), window.alias("window")))
    # first in parts of a language, so that no task gets a whole language
    for group in (["lang", F.pmod("mark", F.lit(256))], ["lang"]):
        order = Window.partitionBy(*group).orderBy("mark", "window")
        rows = rows.withColumn("n", F.row_number().over(order)).where(F.col("n") <= SAMPLE_PER_LANG)
    return sorted_rows(rows.select("window", "lang", "mark").collect())


def sorted_rows(rows) -> list[tuple[str, str]]:
    return [(r["window"], r["lang"]) for r in sorted(rows, key=lambda r: (r["mark"], r["lang"], r["window"]))]


def identify(df: DataFrame, model: Model, text_col: str = "text", *keep: Column) -> DataFrame:
    """``keep`` plus lang_pred, score (calibrated probability) and accepted for
    every row.

    Defined cases: a null text, or one without any letter, is ``und`` with
    score 0 and not accepted, and so is every text if the model has learned
    no language; equal texts get equal results; an empty table gives no rows.
    """
    rows = df.select(*keep, F.col(text_col).cast("string").alias("__text"))
    schema = df.select(*keep).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.predict(t.as_py()) for t in batch.column(batch.num_columns - 1)]
            columns = [pa.array([f[k] for f in found], kind)
                       for k, kind in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns],
                                             names=[*batch.schema.names[:-1], "lang_pred", "score", "accepted"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return rows.mapInArrow(run, f"{kinds}, lang_pred string, score double, accepted boolean")
