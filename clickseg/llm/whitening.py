"""Operator 12: whitening of vectors by an incremental eigendecomposition.

Entries become integers (``floor(SCALE * c) + SHIFT``).  Every partition holds the
eigenvalues and eigenvectors of its centred scatter matrix and takes its rows one at a
time: a row is a centred rank-one update, whose eigenvalues are the roots of the secular
equation; directions that the update does not move are deflated before.  Two partitions'
spectra are combined by successive rank-one updates, one for each eigenpair and one for
the distance of the means, in a tree of ``FAN`` summaries a task.  The basis found is then
refined by Rayleigh and Ritz: one more pass projects all exactly centred rows on it and
adds up the small projected covariance, whose eigenvectors turn the basis into the
components; errors of the updates thereby vanish.

What moves is a summary of dimension x dimension doubles a partition; the last one and the
projected covariance come to the driver, whatever the number of rows.  Sums are exact longs.

Defined results: rows whose vector is null, empty, or holds null, non-finite or huge
(``2**46`` and more in magnitude) entries are dropped; so are vectors that do not have the
most frequent length (of equally frequent ones, the largest); null, equal and repeated ids
each get their rows; ``deviation`` is null where it does not fit a long; a component without
variance (under 1e-12 of the largest eigenvalue) has null ``whitened`` and stays out of
``identity_error``; vectors shorter than ``COMPONENTS`` have as many components as
entries; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickseg.llm.common import cut, ship, table

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
HUGE = float(1 << 46)
FAN = 16
EPS = np.finfo(float).eps


# --- rank-one updates ---------------------------------------------------------

def secular(d: np.ndarray, z2: np.ndarray, r: float) -> tuple[np.ndarray, np.ndarray]:
    """Roots ``x`` of ``1 + r * sum(z2 / (d - x))`` for rising, distinct ``d`` and ``r > 0``; also
    the matrix ``d[i] - x[j]``, taken from the pole next to each root so that it is accurate."""
    k = len(d)
    upper = np.append(d[1:], d[-1] + r * z2.sum())
    half = (upper - d) / 2
    with np.errstate(all="ignore"):
        at_half = 1 + r * (z2[:, None] / (d[:, None] - (d + half))).sum(axis=0)
        left = at_half >= 0
        left[-1] = True  # the last root has no pole above it
        origin = np.where(left, d, upper)
        low, high = np.where(left, 0.0, -half), np.where(left, half, 0.0)
        high[-1] = 2 * half[-1]
        base = d[:, None] - origin
        below = np.tri(k).T  # [i, j]: 1 where pole i is at or below root j
        weight = r * z2
        t = (low + high) / 2
        for _ in range(100):
            gap = base - t
            near = 1 / gap
            f = 1 + weight @ near
            slope = near * near
            rise_low = weight @ (slope * below)
            rise_high = weight @ slope - rise_low
            low, high = np.where(f < 0, np.maximum(low, t), low), np.where(f >= 0, np.minimum(high, t), high)
            done = (np.abs(f) <= 4 * EPS * k * (1 + weight @ np.abs(near))) | (high - low <= 4 * EPS * np.abs(t))
            if done.all():
                break
            # Both sums are replaced by one pole each with the same value and slope.
            a1, a2 = np.diagonal(gap), (upper - origin) - t
            c = f - a1 * rise_low - a2 * rise_high
            a = (a1 + a2) * f - a1 * a2 * (rise_low + rise_high)
            b = a1 * a2 * f
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a > 0, 2 * b / (a + root), (a - root) / (2 * c))
            step[-1] = a1[-1] + a1[-1] ** 2 * rise_low[-1] / (f[-1] - a1[-1] * rise_low[-1])
            new = t + step
            ok = np.isfinite(new) & (new > low) & (new < high)
            t = np.where(done, t, np.where(ok, new, (low + high) / 2))
        return origin + t, base - t


def rank_one(values: np.ndarray, vectors: np.ndarray, v: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenpairs of ``vectors @ diag(values) @ vectors.T + rho * outer(v, v)``; values rise."""
    z = vectors.T @ v
    size = float(rho * (z @ z))
    if not size > 0:
        return values, vectors
    tol = 8 * EPS * max(float(values[-1]), size)
    vectors = vectors.copy()
    # Deflation of equal eigenvalues: a reflection leaves one of their directions in the update.
    edge = np.flatnonzero(np.diff(values) > tol) + 1
    first, last = np.concatenate(([0], edge)), np.append(edge, len(values))
    for a, b in zip(first[last - first > 1], last[last - first > 1]):
        norm = np.linalg.norm(z[a:b])
        if norm == 0:
            continue
        h = z[a:b].copy()
        h[-1] += norm if h[-1] >= 0 else -norm
        h /= np.linalg.norm(h)
        vectors[:, a:b] -= 2 * np.outer(vectors[:, a:b] @ h, h)
        z[a:b] -= 2 * h * (h @ z[a:b])
        z[a: b - 1] = 0.0
    z *= np.sqrt(rho / size)  # of unit length; the weight is ``size``
    live = np.flatnonzero(size * np.abs(z) > tol)  # the rest is deflated: the update does not move it
    if not len(live):
        return values, vectors
    d, part = values[live], z[live]
    roots, gap = secular(d, part * part, size)
    # The update that has exactly these roots: its eigenvectors are orthogonal to working accuracy.
    with np.errstate(all="ignore"):
        apart = d[:, None] - d
        np.fill_diagonal(apart, 1.0)
        between = gap[:, :-1] / np.where(np.arange(len(d) - 1) >= np.arange(len(d))[:, None], apart[:, 1:], apart[:, :-1])
        exact = np.sqrt(np.abs(np.prod(between, axis=1) * gap[:, -1])) * np.where(part < 0, -1.0, 1.0)
        u = exact[:, None] / gap
        u /= np.linalg.norm(u, axis=0)
    vectors[:, live] = vectors[:, live] @ u
    values = values.copy()
    values[live] = roots
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


class Spectrum:
    """Count, exact sums, mean (without ``SHIFT``) and eigenpairs of the centred scatter matrix of some rows."""

    def __init__(self, width: int):
        self.n, self.sums, self.mean = 0, np.zeros(width, np.int64), np.zeros(width)
        self.values, self.vectors = np.zeros(width), np.eye(width)

    def add(self, rows: np.ndarray) -> None:
        """Rows of longs, one update each."""
        self.sums += rows.sum(axis=0)
        for y in (rows - SHIFT).astype(float):
            step = y - self.mean
            self.n += 1
            self.mean += step / self.n
            if self.n > 1:
                self.values, self.vectors = rank_one(self.values, self.vectors, step, (self.n - 1) / self.n)

    def merge(self, other: Spectrum) -> None:
        n, step = self.n + other.n, other.mean - self.mean
        for value, v in zip(other.values, other.vectors.T):
            if value > 0:
                self.values, self.vectors = rank_one(self.values, self.vectors, v, value)
        self.values, self.vectors = rank_one(self.values, self.vectors, step, self.n * other.n / n)
        self.mean = self.mean + step * (other.n / n)
        self.n, self.sums = n, self.sums + other.sums

    def row(self, part: int) -> dict:
        return {"part": part, "n": self.n, "sums": self.sums.tolist(), "mean": self.mean.tolist(),
                "spectrum": self.values.tolist(), "basis": self.vectors.ravel().tolist()}

    @classmethod
    def of(cls, row) -> Spectrum:
        out = cls(len(row["sums"]))
        out.n, out.sums, out.mean = int(row["n"]), np.array(row["sums"], np.int64), np.array(row["mean"], float)
        out.values = np.array(row["spectrum"], float)
        out.vectors = np.array(row["basis"], float).reshape(len(out.sums), -1)
        return out


# --- passes over the rows ---------------------------------------------------------

_SUMMARY = "part long, n long, sums array<long>, mean array<double>, spectrum array<double>, basis array<double>"


def integers(embeddings: DataFrame, vector: str = "embedding", vec_id: str = "vec_id") -> DataFrame:
    """``vec_id, x`` of the rows that take part; ``x`` holds longs."""
    e = embeddings.select(embeddings[vec_id].cast("long").alias("vec_id"), embeddings[vector].cast("array<double>").alias("e"))
    e = e.filter(F.col("e").isNotNull() & (F.size("e") > 0)
                 & F.forall("e", lambda c: c.isNotNull() & (F.abs(c) < F.lit(HUGE))))
    x = e.select("vec_id", F.transform("e", lambda c: F.floor(c * SCALE).cast("long") + F.lit(SHIFT).cast("long")).alias("x"))
    top = x.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    return x.filter(F.size("x") == F.lit(top["width"] if top else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _spectra(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    mine = None
    for b in batches:
        if b.num_rows:
            x = _matrix(b.column(0))
            mine = mine or Spectrum(x.shape[1])
            mine.add(x)
    if mine:
        yield pa.RecordBatch.from_pylist([mine.row(TaskContext.get().partitionId())])


def _combine(pdf: pd.DataFrame) -> pd.DataFrame:
    rows = pdf.sort_values("part").to_dict("records")
    out = Spectrum.of(rows[0])
    for r in rows[1:]:
        out.merge(Spectrum.of(r))
    return pd.DataFrame([out.row(int(rows[0]["part"]) // FAN)])


def spectrum(x: DataFrame) -> Spectrum | None:
    """Summary of all rows, combined in a tree of tasks; nothing for an empty table."""
    parts = cut(x.select("x").mapInArrow(_spectra, _SUMMARY))
    while (n := parts.count()) > 1:
        parts = cut(parts.groupBy(F.expr(f"part div {FAN}").alias("g")).applyInPandas(_combine, _SUMMARY))
    return Spectrum.of(parts.first()) if n else None


def _grams(x: DataFrame, project, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of ``outer(w, w)`` and of ``w`` over all rows, ``w = project(row)``; added up per task first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, total = np.zeros((width, width)), np.zeros(width)
        for b in batches:
            w = project(_matrix(b.column(0)))
            gram += w.T @ w
            total += w.sum(axis=0)
        i, j = (a.ravel() for a in np.indices((width, width)))
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(gram.ravel()), pa.array(np.repeat(total, width))],
                                         ["i", "j", "gram", "total"])

    got = x.select("x").mapInArrow(run, "i long, j long, gram double, total double").groupBy("i", "j").agg(
        F.sum("gram").alias("gram"), F.sum("total").alias("total")).toPandas()  # width x width sums
    gram, total = np.zeros((width, width)), np.zeros(width)
    gram[got["i"], got["j"]] = got["gram"]
    total[got["i"]] = got["total"]
    return gram, total


class Whitening:
    """The fitted transformation: components fall by eigenvalue, all of them in ``values``."""

    def __init__(self, n: int, sums: np.ndarray, values: np.ndarray, vectors: np.ndarray, components: int):
        self.n, self.sums, self.values, self.vectors = n, sums, values, vectors
        self.k = min(components, len(sums))
        self.real = values[: self.k] > max(float(values[0]), 0.0) * 1e-12
        self.identity_error: float | None = None

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.n * x - self.sums).astype(float) / self.n

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """One row of whitened components per row; columns without variance are NaN."""
        with np.errstate(all="ignore"):
            return np.where(self.real, self.centred(x) @ self.vectors[:, : self.k] / np.sqrt(self.values[: self.k]), np.nan)

    def deviation(self, x: np.ndarray) -> np.ma.MaskedArray:
        apart = self.n * x - self.sums
        return np.ma.masked_array((apart * apart).sum(axis=1), (apart.astype(float) ** 2).sum(axis=1) >= 9.2e18)


def fit(x: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    ship(x.sparkSession)
    s = spectrum(x)
    if s is None:
        return None
    width = len(s.sums)
    rough = Whitening(s.n, s.sums, s.values, s.vectors, components)
    gram, _ = _grams(x, lambda rows: rough.centred(rows) @ rough.vectors, width)
    values, turn = np.linalg.eigh((gram + gram.T) / 2 / s.n)
    vectors = s.vectors @ turn[:, ::-1]
    vectors /= np.linalg.norm(vectors, axis=0)
    vectors *= np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(width)] < 0, -1.0, 1.0)
    model = Whitening(s.n, s.sums, np.maximum(values[::-1], 0.0), vectors, components)
    if model.real.any():
        gram, total = _grams(x, lambda rows: model(rows)[:, model.real], int(model.real.sum()))
        mean = total / s.n
        model.identity_error = float(np.abs(gram / s.n - np.outer(mean, mean) - np.eye(len(mean))).max())
    return model


_ROWS = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(embeddings: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", components: int = COMPONENTS) -> DataFrame:
    """One row per vector and component."""
    x = integers(embeddings, vector, vec_id)
    model = fit(x, components)
    if model is None:
        return embeddings.sparkSession.createDataFrame([], _ROWS)
    trace = float(model.values.sum())
    explained = pa.array(model.values[: model.k] / trace if trace else np.full(model.k, np.nan), from_pandas=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 2048):
                part = b.slice(at, 2048)
                rows, x = part.num_rows, _matrix(part.column(1))
                each, comp = np.repeat(np.arange(rows), model.k), np.tile(np.arange(model.k), rows)
                dev = model.deviation(x)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(each)), pa.array(comp + 1, pa.int32()), pa.array(np.full(len(each), model.n)),
                     pa.array(dev.data[each], mask=np.ma.getmaskarray(dev)[each]), pa.array(model(x).ravel(), from_pandas=True),
                     explained.take(pa.array(comp)), pa.array([model.identity_error] * len(each), pa.float64())],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return x.mapInArrow(run, _ROWS)


def op12_whiten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
