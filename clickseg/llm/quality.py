"""Operator 6: document quality by kernel ridge regression on random Fourier features.

Every whole text is described by fixed statistics of its bytes, words and lines.
Standardised by the training rows, they go through ``FEATURES`` random cosines
that approximate a Gaussian kernel.  Each partition adds up its part of the
normal equations; the sums are a matrix of fixed size, solved once.  Ridge
scores of training rows that took no part in the fit are made monotone by
pool-adjacent-violators (isotonic calibration), which turns scores into shares of
good documents.

Training reads at most ``MAX_LABELLED`` labelled rows (smallest hash of the id);
every row is scored.

Defined results: null and empty texts have the statistics of a text without
words and get the score of such a text; repeated labels of a document count
once, the larger holds; null labels and null ids teach nothing; repeated rows
each get their row; without labels of both classes every score is the share of
good labels (0 without any); an empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickseg.llm.common import _BYTE, blocks, held_out, ship, span_hashes, table, tokens
from clickseg.llm.toxicity import training_rows

MAX_LABELLED = 20_000
THRESHOLD = 0.3
FEATURES = 256
#: Width of the Gaussian kernel in standard deviations of a statistic.
WIDTH = 4.0
RIDGE = 1e-3
TAIL_SHARE = 4
BINS = 500
NAMES = ("log_words", "log_lines", "word_length", "word_spread", "line_length", "letters", "upper", "digits", "symbols",
         "beyond_ascii", "sentence_ends", "distinct_words", "same_as_last", "repeated_lines", "odd_words", "no_vowel_start",
         "symbol_ends", "log_bytes")


def _per_row(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0.0], np.cumsum(mask, dtype=np.float64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of ``NAMES`` per text of a block."""
    rows = len(offsets) - 1
    size = np.maximum(np.diff(offsets), 1).astype(float)
    w = tokens(data, offsets)
    n = np.maximum(np.diff(w.first), 1).astype(float)
    length = (w.end - w.start).astype(float)
    lower, upper = (data >= 97) & (data < 123), (data >= 65) & (data < 91)
    digit, far = (data >= 48) & (data < 58), data >= 128
    symbol = (data > 32) & ~(lower | upper | digit | far)
    ends = np.isin(data, np.frombuffer(b".,;:?!", np.uint8))
    words = lambda mask: _per_row(mask, w.first) / n
    mean = words(length)
    distinct = np.bincount(np.unique(np.stack([w.doc.astype(np.uint64), w.hash]), axis=1)[0].astype(int), minlength=rows) \
        if len(w.hash) else np.zeros(rows)
    last = np.zeros(len(w.hash), bool)
    last[1:] = (w.hash[1:] == w.hash[:-1]) & (w.doc[1:] == w.doc[:-1])
    odd, tail_symbol = np.zeros(len(w.start), bool), np.zeros(len(w.start), bool)
    if len(w.start):
        letter = np.concatenate(([0], np.cumsum(lower | far)))
        odd = letter[w.end] - letter[w.start] < 0.5 * length
        tail_symbol = symbol[w.end - 1] & ~ends[w.end - 1]
    # Lines: cut after every line break and at the ends of texts.
    breaks = np.unique(np.concatenate((np.flatnonzero(data == 10) + 1, offsets)))
    breaks = breaks[breaks <= len(data)]
    start, end = breaks[:-1], breaks[1:]
    line_row = np.searchsorted(offsets, start, "right") - 1
    line = span_hashes(_BYTE[data], start, end - ((end > start) & (data[np.maximum(end - 1, 0)] == 10))) if len(start) else np.zeros(0, np.uint64)
    lines = np.maximum(np.bincount(line_row, minlength=rows), 1).astype(float)
    own = np.bincount(np.unique(np.stack([line_row.astype(np.uint64), line]), axis=1)[0].astype(int), minlength=rows) \
        if len(line) else np.zeros(rows)
    return np.column_stack([
        np.log1p(np.diff(w.first)), np.log1p(lines), mean, np.sqrt(np.maximum(words(length ** 2) - mean ** 2, 0)),
        np.log1p(size / lines), _per_row(lower, offsets) / size, _per_row(upper, offsets) / size,
        _per_row(digit, offsets) / size, _per_row(symbol & ~ends, offsets) / size, _per_row(far, offsets) / size,
        _per_row(ends, offsets) / size, distinct / n, words(last), 1 - own / lines, words(odd),
        words(upper[w.start] if len(w.start) else odd), words(tail_symbol), np.log(size)])


class Waves:
    """Standardisation and the random cosines (fixed by a seed)."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray):
        rng = np.random.default_rng(6)
        self.mean, self.spread = mean, np.where(spread > 1e-9, spread, 1.0)
        self.direction = rng.normal(size=(len(NAMES), FEATURES)) / WIDTH
        self.phase = rng.uniform(0, 2 * np.pi, FEATURES)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -8, 8)
        return np.column_stack([np.sqrt(2 / FEATURES) * np.cos(z @ self.direction + self.phase), np.ones(len(x))])


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(labels, statistics)`` per block of ``label, text``."""
    for b in batches:
        y = b.column(0).to_numpy(zero_copy_only=False)
        for at, data, offsets in blocks(b.column(1)):
            yield y[at: at + len(offsets) - 1], statistics(data, offsets)


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, total, square = 0, np.zeros(len(NAMES)), np.zeros(len(NAMES))
    for _, x in _described(batches):
        n, total, square = n + len(x), total + x.sum(axis=0), square + (x * x).sum(axis=0)
    yield pa.RecordBatch.from_arrays([pa.array(range(len(NAMES)), pa.int32()), pa.array(np.full(len(NAMES), n)),
                                      pa.array(total), pa.array(square)], ["i", "n", "total", "square"])


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED):
    """``(waves, weights, knots, shares)``; a float where labels do not have both classes."""
    train = training_rows(docs, labels, "quality", 5, 0, max_labelled)
    tail = F.pmod(F.xxhash64("doc_id", F.lit(6)), F.lit(TAIL_SHARE)) == 0
    n, good = train.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not 0 < good < n:
        return good / n if n else 0.0
    m = train.select("label", "text").mapInArrow(_moments, "i int, n long, total double, square double").groupBy("i").agg(
        F.sum("n").alias("n"), F.sum("total").alias("t"), F.sum("square").alias("s")).orderBy("i").toPandas()
    mean = (m["t"] / m["n"]).to_numpy()
    waves = Waves(mean, np.sqrt(np.maximum((m["s"] / m["n"]).to_numpy() - mean ** 2, 0)))
    size = FEATURES + 1

    def normal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = np.zeros((size, size + 1))  # the matrix and, last column, the right side
        for y, x in _described(batches):
            z = waves(x)
            a += z.T @ np.column_stack([z, y])
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(size), size + 1)), pa.array(np.tile(np.arange(size + 1), size)),
                                          pa.array(a.ravel())], ["i", "j", "a"])

    fitted = train.filter(~tail).select("label", "text")
    sums = fitted.mapInArrow(normal, "i long, j long, a double").groupBy("i", "j").agg(F.sum("a").alias("a")).toPandas()
    a = np.zeros((size, size + 1))
    a[sums["i"], sums["j"]] = sums["a"]
    ridge = np.eye(size) * RIDGE * max(a[-1, size - 1], 1.0) / size
    ridge[-1, -1] = 1e-9  # the constant is not shrunk
    weights = np.linalg.solve(a[:, :size] + ridge, a[:, size])

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for y, x in _described(batches):
            yield pa.RecordBatch.from_arrays([pa.array(y.astype(np.int32)), pa.array(waves(x) @ weights)], ["label", "raw"])

    held = train.filter(tail).select("label", "text").mapInArrow(raw, "label int, raw double").toPandas()
    knots, shares = isotonic(held["raw"].to_numpy(), held["label"].to_numpy(), good / n)
    return waves, weights, knots, shares


def isotonic(raw: np.ndarray, y: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """Monotone shares by pool-adjacent-violators over at most ``BINS`` groups of equal size; each
    pooled group leans on one document of the prior.  Returns knots (mean raw scores) and shares."""
    order = np.argsort(raw, kind="stable")
    groups = np.array_split(order, max(1, min(BINS, len(order))))
    pool: list[list[float]] = []  # weight, sum of labels, sum of raw
    for g in groups:
        if not len(g):
            continue
        pool.append([len(g), float(y[g].sum()), float(raw[g].sum())])
        while len(pool) > 1 and pool[-2][1] * pool[-1][0] >= pool[-1][1] * pool[-2][0]:
            last = pool.pop()
            pool[-1] = [a + b for a, b in zip(pool[-1], last)]
    if not pool:
        return np.array([0.0, 1.0]), np.array([0.0, 1.0])
    p = np.array(pool)
    return p[:, 2] / p[:, 0], np.maximum.accumulate((p[:, 1] + prior) / (p[:, 0] + 1))


def quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """Held-out flag, calibrated score, decision and ridge score per row."""
    ship(docs.sparkSession)
    model = fit(docs, labels, max_labelled)
    picked = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    if isinstance(model, float):
        s = picked.select("doc_id", F.lit(model).alias("score"), F.lit(model).alias("ridge"))
    else:
        waves, weights, knots, shares = model

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for at, data, offsets in blocks(b.column(1)):
                    raw = waves(statistics(data, offsets)) @ weights
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).slice(at, len(raw)), pa.array(np.clip(np.interp(raw, knots, shares), 0, 1)), pa.array(raw)],
                        ["doc_id", "score", "ridge"])

        s = picked.mapInArrow(run, "doc_id long, score double, ridge double")
    return s.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted"), "ridge")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
