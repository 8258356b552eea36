"""Operator 5: toxic passages as maximum-scoring segments of token log-odds.

Tokens are lower-cased runs of ASCII letters, digits and non-ASCII characters.
A token's share of toxic use is a posterior mean under a Dirichlet prior (two
classes) that is centred on the token's prefix, whose own prior is centred on a
shorter prefix and then on the base rate; its score is the log-odds against the
base rate less ``DRIFT``, so clean text drifts downwards.  The linear-time scan
of Ruzzo and Tompa then finds every maximal scoring segment of a document.
Scores of segments are read against the extreme-value law of clean documents,
E = K n exp(-lambda S); passages with a small E are reported, and a logistic
curve on log E of the document's strongest passages gives its score.

Training reads labelled rows only, at most ``MAX_LABELLED`` of them (those with
the smallest hash of the id); every row is scored over its whole text.  The
model is a fixed number of counters, so its broadcast is bounded.

Defined results: null and empty texts have no passage and score like any text
without one; repeated labels of a document count once, the larger label holds;
null labels teach nothing; a null ``doc_id`` is held out if the crc32 of the
empty text says so and never labelled; repeated rows each get their row; without
labels of both classes every score is 0; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickseg.llm.common import blocks, held_out, mix, span_hashes, table, tokens

MAX_LABELLED = 20_000
THRESHOLD = 0.3
#: Prefix lengths in bytes of the prior chain; the last level is the token itself.
PREFIXES = (4, 6)
SLOTS = 1 << 18
PRIOR = 20.0
DRIFT = 0.5
#: A passage is significant if a clean document is expected to hold fewer than this many.
MAX_EXPECTED = 0.01
#: The logistic curve is flat below this log E: stronger passages are all certain.
FLOOR = -40.0
#: One training row in so many calibrates; the others give the token scores.
TAIL_SHARE = 3
#: Strongest passages of a training row that the curve is fitted on (more reach FLOOR anyway).
TOP = 256


def _slots(t) -> list[np.ndarray]:
    """Counter of every token at each level of the prior chain."""
    levels = [span_hashes(_bytes(t), t.start, np.minimum(t.end, t.start + p)) for p in PREFIXES] + [t.hash]
    return [(mix(h + np.uint64(i)) % np.uint64(SLOTS)).astype(np.int64) + i * SLOTS for i, h in enumerate(levels)]


def _bytes(t) -> np.ndarray:
    return mix(t.data.astype(np.uint64) + np.uint64(1))


def labelled(labels: DataFrame, label: str, mod: int, rest: int, limit: int) -> DataFrame:
    """``(doc_id, label)`` of at most ``limit`` training rows, by smallest hash of the id."""
    return (labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels[label].cast("int").alias("label"))
            .filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull()).filter(~held_out("doc_id", mod, rest))
            .groupBy("doc_id").agg(F.max("label").alias("label"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, mod: int, rest: int, limit: int) -> DataFrame:
    """``(label, text, doc_id)`` of the training rows; the bounded label table is broadcast."""
    lab = labelled(labels, label, mod, rest, limit)
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")
                       ).join(F.broadcast(lab), "doc_id").select("label", "text", "doc_id")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((2, SLOTS * (len(PREFIXES) + 1)), np.int64)
    for b in batches:
        label = b.column(0).to_numpy(zero_copy_only=False)
        for at, data, offsets in blocks(b.column(1)):
            t = tokens(data, offsets, "alnum", lower=True)
            toxic = label[at: at + len(offsets) - 1] == 1
            for s in _slots(t):
                once = np.unique(t.doc * total.shape[1] + s)  # a document counts once per token
                doc, slot = once // total.shape[1], once % total.shape[1]
                for k in (0, 1):
                    np.add.at(total[k], slot[toxic[doc] == bool(k)], 1)
    slot = np.flatnonzero(total.any(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(total[0, slot]), pa.array(total[1, slot])],
                                     ["slot", "clean", "toxic"])


def fit_scores(train: DataFrame) -> np.ndarray | None:
    """Token scores by counter (float32, one per slot and level); None without both classes."""
    rows = train.mapInArrow(_count, "slot long, clean long, toxic long").groupBy("slot").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toPandas()
    n = np.zeros((2, SLOTS * (len(PREFIXES) + 1)))
    n[:, rows["slot"].to_numpy()] = rows[["clean", "toxic"]].to_numpy().T
    n = n.reshape(2, len(PREFIXES) + 1, SLOTS)
    if not n[0, -1].sum() or not n[1, -1].sum():
        return None
    return n


class Scorer:
    """Log-odds of tokens along the prior chain, from documents per counter and class."""

    def __init__(self, counts: np.ndarray):
        self.clean, self.toxic = (counts[k].astype(np.float32).ravel() for k in (0, 1))
        self.base = float(counts[1, -1].sum() / counts[:, -1].sum())

    def __call__(self, t) -> np.ndarray:
        share = np.full(len(t.start), self.base)
        for s in _slots(t):
            share = (self.toxic[s] + PRIOR * share) / (self.toxic[s] + self.clean[s] + PRIOR)
        share = np.clip(share, 1e-6, 1 - 1e-6)
        return np.log(share / (1 - share)) - np.log(self.base / (1 - self.base)) - DRIFT


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments ``(start, end, score)`` of a sequence, left to right.

    Each positive token opens a candidate that is joined to the nearest earlier
    candidate with a smaller left sum as long as that one's right sum is smaller.
    A candidate keeps where that earlier one stands: the candidates between have left
    sums at least as large as its own, so a later search jumps over them.  Every such
    jump is taken once and every candidate joined once: the scan is linear.
    """
    before = np.concatenate(([0.0], np.cumsum(scores)))
    stack: list[tuple[float, float, int, int, int]] = []  # left sum, right sum, start, end, nearest with a smaller left sum
    for i in np.flatnonzero(scores > 0).tolist():
        left, right, start = before[i], before[i + 1], i
        j = len(stack) - 1
        while j >= 0 and stack[j][0] >= left:
            j = stack[j][4]
        while j >= 0 and stack[j][1] < right:
            left, _, start, _, below = stack[j]
            del stack[j:]
            j = below
        stack.append((left, right, start, i + 1, j))
    return [(s, e, float(r - l)) for l, r, s, e, _ in stack]


def _segments(scorer: Scorer, column: pa.Array) -> Iterator[tuple[int, int, list]]:
    """``(row, tokens, segments)`` of every row."""
    for at, data, offsets in blocks(column):
        t = tokens(data, offsets, "alnum", lower=True)
        s = scorer(t)
        hot = np.zeros(len(offsets) - 1, bool)
        hot[t.doc[s > 0]] = True
        for i in range(len(offsets) - 1):
            a, b = t.first[i], t.first[i + 1]
            yield at + i, int(b - a), maximal_segments(s[a:b]) if hot[i] else []


def evidence(n: int, scores: list[float], lam: float, log_k: float) -> float:
    """log E of a document: every passage stronger than the best one that chance would
    give a clean document of ``n`` tokens adds its surplus; without one, log E of the best.
    Passages that repeat (the same score) count once."""
    chance = log_k + np.log(n + 1.0)
    surplus = sum(x for s in {round(s, 9) for s in scores} if (x := lam * s - chance) > 0)
    return max(FLOOR, -surplus if surplus else chance - lam * max(scores, default=0.0))


def fit_tail(rows) -> dict:
    """K and lambda of clean documents' best segments (quartiles of the Gumbel law) and the
    logistic curve on log E, from ``(label, tokens, best, segments)`` of the training rows."""
    clean = rows[rows["label"] == 0]
    if not len(clean) or len(clean) == len(rows):
        return {"lam": 1.0, "log_k": -3.0, "w0": -3.0, "w1": 1.0}  # too few rows: the law of log-likelihood ratios
    low, mid, high = np.quantile(clean["best"], [0.25, 0.5, 0.75])
    # Quartiles of the standard Gumbel law are -log(-log q) apart; a few odd documents do not move them.
    lam = (np.log(np.log(4.0)) - np.log(np.log(4.0 / 3.0))) / max(float(high - low), 0.3)
    log_k = lam * float(mid) + np.log(np.log(2.0)) - float(np.log(clean["tokens"] + 1.0).median())
    x = np.array([evidence(n, seg, lam, log_k) for n, seg in zip(rows["tokens"], rows["segments"])])
    y = (rows["label"].to_numpy() == 1).astype(float)
    scale = -FLOOR
    a = np.column_stack([np.ones_like(x), -x / scale])
    w, ridge = np.zeros(2), np.array([1e-3, 1e-3]) * len(y)
    for _ in range(50):  # Newton steps of a logistic fit with a little shrinkage
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + np.diag(ridge), a.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return {"lam": lam, "log_k": log_k, "w0": float(w[0]), "w1": float(w[1] / scale)}


def fit(docs: DataFrame, labels: DataFrame, mod: int = 4, rest: int = 2, max_labelled: int = MAX_LABELLED):
    """Token counters and tail of the training rows; None without both classes."""
    train = training_rows(docs, labels, "toxic", mod, rest, max_labelled)
    calibrates = F.pmod(F.xxhash64("doc_id"), F.lit(TAIL_SHARE)) == 0  # rows that taught no token score
    context = train.sparkSession.sparkContext
    partial, counts = fit_scores(train.filter(~calibrates)), fit_scores(train)
    if counts is None:
        return None
    shared = context.broadcast(counts if partial is None else partial)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for b in batches:
            got = [(n, sorted((s for *_, s in seg), reverse=True)[:TOP]) for _, n, seg in _segments(scorer, b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([n for n, _ in got], pa.int64()),
                                              pa.array([s[0] if s else 0.0 for _, s in got], pa.float64()),
                                              pa.array([s for _, s in got], pa.list_(pa.float64()))],
                                             ["label", "tokens", "best", "segments"])

    rows = train.filter(calibrates).mapInArrow(best, "label int, tokens long, best double, segments array<double>").toPandas()
    return {"counts": context.broadcast(counts), **fit_tail(rows)}


SCHEMA = ("doc_id long, score double, n_tokens long, passages array<struct<start:int,end:int,score:double,expected:double>>")


def score(docs: DataFrame, model, keep: list[str] | None = None) -> DataFrame:
    """Score and significant passages (token ranges of the whole text) of every row.

    ``keep`` names columns of ``docs`` to carry along.
    """
    carried = [docs.schema[c] for c in keep or []]
    picked = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"),
                         *[docs[f.name].alias(f"kept_{i}") for i, f in enumerate(carried)])
    if model is None:
        return picked.select("doc_id", F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("n_tokens"),
                             F.array().cast(SCHEMA.split("passages ")[1]).alias("passages"),
                             *[F.col(f"kept_{i}").alias(f.name) for i, f in enumerate(carried)])
    passage = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("expected", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, lam, log_k = Scorer(model["counts"].value), model["lam"], model["log_k"]
        for b in batches:
            scores, counts, found = [], [], []
            for _, n, seg in _segments(scorer, b.column(1)):
                log_e = evidence(n, [s for *_, s in seg], lam, log_k)
                scores.append(1 / (1 + np.exp(-np.clip(model["w0"] - model["w1"] * log_e, -30, 30))))
                counts.append(n)
                e = [(a, z, s, float(np.exp(min(log_k + np.log(n + 1.0) - lam * s, 700.0)))) for a, z, s in seg]
                found.append([dict(zip(("start", "end", "score", "expected"), x)) for x in e if x[3] < MAX_EXPECTED])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(scores, pa.float64()), pa.array(counts, pa.int64()),
                 pa.array(found, pa.list_(passage)), *b.columns[2:]],
                ["doc_id", "score", "n_tokens", "passages", *b.schema.names[2:]])

    kept = "".join(f", kept_{i} {f.dataType.simpleString()}" for i, f in enumerate(carried))
    out = picked.mapInArrow(run, SCHEMA + kept)
    return out.select("doc_id", "score", "n_tokens", "passages",
                      *[F.col(f"kept_{i}").alias(f.name) for i, f in enumerate(carried)])


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD,
             max_labelled: int = MAX_LABELLED) -> DataFrame:
    """Held-out flag, score, decision and passages per row."""
    scored = score(docs, fit(docs, labels, max_labelled=max_labelled))
    return scored.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"),
                         F.size("passages").alias("n_passages"), "passages")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str, threshold: float = THRESHOLD) -> DataFrame:
    """Pipeline stage: the documents whose score stays under the threshold, columns unchanged.
    The model is learned from the labelled rows of ``docs``."""
    model = fit(docs, table(spark, sf_dir, "labels"))
    names = [c for c in docs.columns]
    scored = score(docs, model, keep=names)
    place = {c: i for i, c in enumerate(scored.columns[:4])}
    renamed = scored.toDF(*[f"own_{c}" for c in place], *[f"col_{i}" for i in range(len(names))])
    return renamed.filter(F.col("own_score") < threshold).select(
        *[F.col(f"col_{i}").alias(c) for i, c in enumerate(names)])
