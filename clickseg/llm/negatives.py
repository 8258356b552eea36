"""Operator 11: hard negatives by a multiway hyperplane tree (GNAT).

Every node of the tree has up to ``FANOUT`` split points; a row goes down to the nearest
one.  For each pair of siblings the node stores the range of distances from one's split
point to all rows below the other, and each subtree stores the range of its squared norms.
A search is a window of scores (inner products) for an anchor.  With a subtree's norms it
becomes an annulus around the anchor, and siblings whose stored range cannot meet that
annulus are eliminated, by any of the split points.  Leaves that stay are compared exactly.

The split points are fitted on at most ``SAMPLE`` rows (smallest hash); every row is indexed,
every range covers all rows below it, so the search is exact whatever the sample.  An anchor
runs two searches: scores of its own label from a floor up (positives), then one window a
positive among the other labels.  Floors come from the sample: the score that as many sampled
rows reach as are asked for; without that many the window is whole.

Leaves meet their anchors in tiles of at most about ``TILE`` rows and ``QUERIES`` anchors: small
neighbouring leaves share a tile, an anchor that visits one of them comes once; a large leaf and
a leaf that many anchors visit are dealt by hash, so neither a leaf with a third of all rows nor
one that all anchors visit is one task.  A tile returns the first few rows of a search, not its pairs.  The tree, the leaf sizes
and the visits per leaf are bounded by the sample and come to the driver; nothing else does.

Defined results: rows with a null label, a null or empty vector, or null, non-finite or huge
(``LARGEST`` and more in magnitude) components take no part, nor do vectors that do not have the
most frequent length (of equally frequent ones, the largest); a null id is no anchor and
sorts before all others; rows that repeat an id are rows of their own; an anchor without rows of
its label, or whose windows are empty, returns nothing; an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

import collections
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickseg.llm.common import NULL_ID, cut, lists, real_id, ship, table

SCALE = 256
LARGEST = float(1 << 14)
SAMPLE = 20_000
FANOUT = 8
LEAF_ROWS = 512
TILE = 4096
QUERIES = 4096
POSITIVES, NEGATIVES = 5, 10
#: A negative's score lies between these hundredths of the positive's.
LOW, HIGH = 30, 90
NONE = -(1 << 62)


# --- the tree -------------------------------------------------------------------

def norms(x: np.ndarray) -> np.ndarray:
    return (x * x).sum(axis=1)


def distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(norms(x)[:, None] + norms(points) - 2 * (x @ points.T), 0))


class Tree:
    """``points[n]``: split points of node n; ``children[n]``: node numbers, or ``-1 - leaf``."""

    def __init__(self, sample: np.ndarray, leaf_rows: float, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.points: list[np.ndarray] = []
        self.children: list[list[int]] = []
        self.leaves = 0
        self.root = self._grow(sample, np.arange(len(sample)), leaf_rows, rng)
        if self.root is None:
            self.root = self._leaf()
        todo = [(self.root, np.arange(len(sample)))] if self.root >= 0 else []
        while todo:
            n, at = todo.pop()
            near = distances(sample[at], self.points[n]).argmin(axis=1)
            for j in range(len(self.points[n])):
                below = at[near == j]
                child = self._grow(sample, below, leaf_rows, rng)
                self.children[n].append(self._leaf() if child is None else child)
                if child is not None:
                    todo.append((child, below))
        width = max([FANOUT, *map(len, self.points)])
        #: [node, i, j]: distances from split point i to the rows below child j.
        self.low = np.full((len(self.points), width, width), np.inf)
        self.high = np.full((len(self.points), width, width), -np.inf)
        self.norm_low = np.full((len(self.points), width), np.inf)
        self.norm_high = np.full((len(self.points), width), -np.inf)

    def _leaf(self) -> int:
        self.leaves += 1
        return -self.leaves

    def _grow(self, sample: np.ndarray, at: np.ndarray, leaf_rows: float, rng) -> int | None:
        """A node over these rows with split points far from each other; None for a leaf."""
        if len(at) <= leaf_rows:
            return None
        some = sample[rng.permutation(at)[: 8 * FANOUT]]
        chosen, gap = [0], distances(some, some[:1])[:, 0]
        while len(chosen) < FANOUT and gap.max() > 0:
            chosen.append(int(gap.argmax()))
            gap = np.minimum(gap, distances(some, some[chosen[-1:]])[:, 0])
        if len(chosen) < 2:
            return None
        self.points.append(some[chosen])
        self.children.append([])
        return len(self.points) - 1

    def route(self, x: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """``(node, rows, distances, child)`` of every node that rows pass."""
        todo = [(self.root, np.arange(len(x)))] if self.root >= 0 else []
        while todo:
            n, at = todo.pop()
            far = distances(x[at], self.points[n])
            near = far.argmin(axis=1)
            yield n, at, far, near
            todo += [(c, at[near == j]) for j, c in enumerate(self.children[n]) if c >= 0 and (near == j).any()]

    def leaf(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), np.int64)
        for n, at, _, near in self.route(x):
            child = np.array(self.children[n])[near]
            out[at[child < 0]] = -1 - child[child < 0]
        return out

    def widen(self, x: np.ndarray) -> None:
        """Take rows into the ranges."""
        size = norms(x)
        for n, at, far, near in self.route(x):
            for j in np.unique(near):
                d, s, m = far[near == j], size[at[near == j]], far.shape[1]
                self.low[n, :m, j] = np.minimum(self.low[n, :m, j], d.min(axis=0))
                self.high[n, :m, j] = np.maximum(self.high[n, :m, j], d.max(axis=0))
                self.norm_low[n, j] = min(self.norm_low[n, j], s.min())
                self.norm_high[n, j] = max(self.norm_high[n, j], s.max())

    def search(self, x: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(anchor, leaf)`` of all leaves that can hold a row whose score lies in one of the
        anchor's windows ``low[a, k] .. high[a, k]``."""
        found: list[tuple[np.ndarray, int]] = []
        own = norms(x)
        todo = [(self.root, np.arange(len(x)))]
        while todo:
            n, at = todo.pop()
            if n < 0:
                found.append((at, -1 - n))
                continue
            far = distances(x[at], self.points[n])[:, None, :]
            m = far.shape[2]
            for j, child in enumerate(self.children[n]):
                outer = own[at, None] + self.norm_high[n, j] - 2 * low[at]
                inner = own[at, None] + self.norm_low[n, j] - 2 * high[at]
                near, wide = np.sqrt(np.maximum(inner, 0))[..., None], np.sqrt(np.maximum(outer, 0))[..., None]
                lo, hi = self.low[n, :m, j], self.high[n, :m, j]
                slack = 1e-9 * (1 + far + np.where(np.isfinite(hi), hi, 0))
                meets = (far - hi <= wide + slack) & (lo - far <= wide + slack) & (far + hi >= near - slack)
                stay = (meets.all(axis=2) & (outer >= -1e-6 * own[at, None]) & (low[at] <= high[at])).any(axis=1)
                if stay.any():
                    todo.append((child, at[stay]))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([a for a, _ in found]), np.repeat([leaf for _, leaf in found], [len(a) for a, _ in found])


# --- rows and index -----------------------------------------------------------------

def matrix(column) -> np.ndarray:
    """Vectors packed by :func:`vectors`, one row each."""
    packed = column.to_pylist() if isinstance(column, (pa.Array, pa.ChunkedArray)) else list(column)
    return np.frombuffer(b"".join(packed), np.int32).reshape(len(packed), -1).astype(float)


def vectors(embeddings: DataFrame, vector: str, vec_id: str, label: str) -> DataFrame:
    """``r, v, label, h, x`` of the rows that take part: row number, id, label of the task, hash,
    components packed as 32-bit integers."""
    i, y = embeddings[vec_id].cast("long"), embeddings[label].cast("int")
    e = embeddings.select(F.coalesce(i, F.lit(NULL_ID)).alias("v"), F.when(i % 7 == 0, (y + 1) % 10).otherwise(y).alias("label"),
                          embeddings[vector].cast("array<double>").alias("e"))
    e = e.filter(F.col("label").isNotNull() & F.col("e").isNotNull() & (F.size("e") > 0)
                 & F.forall("e", lambda c: c.isNotNull() & (F.abs(c) < F.lit(LARGEST))))
    top = e.groupBy(F.size("e").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    e = e.filter(F.size("e") == F.lit(top["width"] if top else 0)).select(
        "v", "label", F.transform("e", lambda c: F.floor(c * SCALE).cast("int")).alias("x"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(2).flatten().to_numpy().astype(np.int32).reshape(b.num_rows, -1)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([r.tobytes() for r in x], pa.binary())], ["v", "label", "x"])

    packed = e.mapInArrow(pack, "v long, label int, x binary")
    return cut(packed.withColumn("r", F.monotonically_increasing_id()).withColumn("h", F.xxhash64("v", "x")))


class Index:
    def __init__(self, sample: pd.DataFrame, rows: int, leaf_rows: int = LEAF_ROWS):
        self.x, self.label, self.r = matrix(sample["x"]), sample["label"].to_numpy(), sample["r"].to_numpy()
        self.tree = Tree(self.x, max(8, leaf_rows * len(sample) / rows))


def ranges(rows: DataFrame, index: Index) -> None:
    """Widen the tree's ranges by all rows; tasks return one row per entry they have touched."""
    tree = index.tree

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tree.widen(matrix(b.column(0)))
        n, i, j = np.nonzero(np.isfinite(tree.low))
        k, m = np.nonzero(np.isfinite(tree.norm_low))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(c)) for c in ((n, k), (i, np.full(len(k), -1)), (j, m), (tree.low[n, i, j], tree.norm_low[k, m]),
                                                   (tree.high[n, i, j], tree.norm_high[k, m]))], ["n", "i", "j", "low", "high"])

    got = rows.select("x").mapInArrow(run, "n long, i long, j long, low double, high double").groupBy("n", "i", "j").agg(
        F.min("low").alias("low"), F.max("high").alias("high")).toPandas()  # entries of the tree
    d, s = got[got["i"] >= 0], got[got["i"] < 0]
    tree.low[d["n"], d["i"], d["j"]], tree.high[d["n"], d["i"], d["j"]] = d["low"], d["high"]
    tree.norm_low[s["n"], s["j"]], tree.norm_high[s["n"], s["j"]] = s["low"], s["high"]


def build(rows: DataFrame, sample: int = SAMPLE, leaf_rows: int = LEAF_ROWS) -> tuple[DataFrame, Index] | None:
    """The rows with their ``leaf``, and the index; nothing for an empty table."""
    n = rows.count()
    if not n:
        return None
    index = Index(rows.orderBy("h", "r").limit(sample).select("r", "label", "x").toPandas(), n, leaf_rows)
    ranges(rows, index)
    tree = index.tree

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(tree.leaf(matrix(b.column(3))))], ["r", "v", "label", "x", "leaf"])

    return cut(rows.select("r", "v", "label", "x").mapInArrow(place, "r long, v long, label int, x binary, leaf long")), index


# --- searches ------------------------------------------------------------------------

def scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products."""
    if len(x) and len(q) and np.abs(q).max() * np.abs(x).max() * x.shape[1] >= 2 ** 53:
        return q.astype(np.int64) @ x.astype(np.int64).T
    return (q @ x.T).astype(np.int64)


def floors(s: np.ndarray, fits: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest fitting score of each row, ``NONE`` where fewer fit."""
    if s.shape[1] < k:
        return np.full(len(s), NONE)
    return np.partition(np.where(fits, s, NONE), s.shape[1] - k, axis=1)[:, -k]


def _in_window(s: np.ndarray, positive: np.ndarray) -> np.ndarray:
    return (100 * s >= LOW * positive[:, None]) & (100 * s <= HIGH * positive[:, None])


def visits(anchors: DataFrame, index: Index) -> DataFrame:
    """``r, leaf, floor`` for every leaf that a search of the anchor has to see.  ``anchors`` has
    ``r, label, x, positives``: an empty list asks for the positives, else one window each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                r, label, x = part.column(0).to_numpy(), part.column(1).to_numpy(), matrix(part.column(2))
                asked = part.column(3).to_pylist()
                s, same = scores(x, index.x), label[:, None] == index.label
                width = max(1, *map(len, asked))
                low, high = np.full((len(r), width), np.inf), np.full((len(r), width), -np.inf)
                floor = np.full((len(r), width), NONE)
                plain = np.array([not a for a in asked])
                if plain.any():
                    floor[plain, 0] = floors(s[plain], same[plain] & (r[plain, None] != index.r), POSITIVES)
                    low[plain, 0], high[plain, 0] = np.where(floor[plain, 0] == NONE, -np.inf, floor[plain, 0]), np.inf
                for k in range(width):
                    on = np.flatnonzero([len(a) > k for a in asked])
                    if len(on):
                        p = np.array([asked[i][k] for i in on], np.int64)
                        floor[on, k] = floors(s[on], ~same[on] & _in_window(s[on], p), NEGATIVES)
                        low[on, k], high[on, k] = np.maximum(floor[on, k], LOW / 100 * p - 0.5), HIGH / 100 * p + 0.5
                a, leaf = index.tree.search(x, low, high)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r[a]), pa.array(leaf.astype(np.int64)), lists(floor[a].ravel(), np.full(len(a), width), pa.int64())],
                    ["r", "leaf", "floor"])

    return cut(anchors.select("r", "label", "x", "positives").mapInArrow(run, "r long, leaf long, floor array<long>"))


def _first(q: np.ndarray, at: np.ndarray, s: np.ndarray, v: np.ndarray, k: int) -> np.ndarray:
    """Which of the pairs (query, row) are among the first k of their query: higher scores, then smaller ids."""
    order = np.lexsort((v[at], -s, q))
    q = q[order]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    return order[place < k]


_FOUND = "r long, k int, v long, score long"


def _search_tile(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
    out = []
    if len(rows) and len(asked):
        x, v, label, r = matrix(rows["x"]), rows["v"].to_numpy(), rows["label"].to_numpy(), rows["r"].to_numpy()
        for at in range(0, len(asked), 256):
            part = asked.iloc[at: at + 256]
            own, floor = part["r"].to_numpy(), list(part["floor"])
            s, same = scores(matrix(part["x"]), x), part["label"].to_numpy()[:, None] == label
            windows = list(part["positives"])
            for k in range(max(1, *map(len, windows))):
                if k == 0:
                    plain = np.array([not len(w) for w in windows])
                    q, i = np.nonzero(plain[:, None] & same & (own[:, None] != r) & (s >= np.array([f[0] for f in floor])[:, None]))
                    best = _first(q, i, s[q, i], v, POSITIVES)
                    out.append(pd.DataFrame({"r": own[q[best]], "k": -1, "v": v[i[best]], "score": s[q[best], i[best]]}))
                on = np.flatnonzero([len(w) > k for w in windows])
                if len(on):
                    p, least = np.array([windows[i][k] for i in on]), np.array([floor[i][k] for i in on])
                    q, i = np.nonzero(~same[on] & _in_window(s[on], p) & (s[on] >= least[:, None]))
                    best = _first(q, i, s[on][q, i], v, NEGATIVES)
                    out.append(pd.DataFrame({"r": own[on[q[best]]], "k": k, "v": v[i[best]], "score": s[on][q[best], i[best]]}))
    return pd.concat(out) if out else pd.DataFrame({"r": [], "k": [], "v": [], "score": []}).astype("int64")


def search(rows: DataFrame, anchors: DataFrame, index: Index) -> DataFrame:
    """``r, k, v, score`` of the first rows of every search, per tile; exact after a merge."""
    spark = rows.sparkSession
    seen = visits(anchors, index)
    size = dict(rows.groupBy("leaf").count().collect())  # at most as many leaves as sampled rows
    bins, at, filled = {}, -1, TILE
    for leaf in sorted(size):  # neighbours in the tree have numbers next to each other
        if filled + size[leaf] > TILE:
            at, filled = at + 1, 0
        bins[leaf], filled = at, filled + size[leaf]
    if not bins:
        return spark.createDataFrame([], _FOUND)
    bin_of = F.broadcast(spark.createDataFrame(list(bins.items()), "leaf long, bin long"))
    seen = cut(seen.join(bin_of, "leaf").groupBy("r", "bin").agg(F.first("floor").alias("floor")))  # the anchor's floor, whichever leaf
    rows_in = collections.Counter()
    for leaf, b in bins.items():
        rows_in[b] += size[leaf]
    load = dict(seen.groupBy("bin").count().collect())
    if not load:
        return spark.createDataFrame([], _FOUND)
    grid = F.broadcast(spark.createDataFrame([(b, -(-rows_in[b] // TILE), -(-n // QUERIES)) for b, n in load.items()],
                                             "bin long, parts int, loads int"))
    part = lambda n: F.pmod(F.xxhash64("r"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    mine = rows.join(bin_of, "leaf").join(grid, "bin").withColumn("p", part("parts")).select(
        "bin", "p", each("loads").alias("q"), "r", "v", "label", "x")
    asked = seen.join(grid, "bin").withColumn("q", part("loads")).join(anchors, "r").select(
        "bin", each("parts").alias("p"), "q", *[F.col(c).alias(c) for c in ("r", "label", "x", "positives", "floor")])
    keys = ["bin", "p", "q"]
    return mine.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(lambda a, b: _search_tile(a, b), _FOUND)


def _ranked(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The first ``k`` of each key; a tile returned at most ``k`` of them."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "v"))
    return found.withColumn("rank", place).filter(F.col("rank") <= k)


def hard_negatives(embeddings: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", label: str = "label",
                   every: int = 100, sample: int = SAMPLE, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """One row per anchor, positive and negative; anchors are the rows whose id ``every`` divides."""
    spark = embeddings.sparkSession
    ship(spark)
    built = build(vectors(embeddings, vector, vec_id, label), sample, leaf_rows)
    if built is None:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    rows, index = built
    anchors = rows.filter((F.col("v") != F.lit(NULL_ID)) & (F.col("v") % every == 0)).select("r", "v", "label", "x")
    none = F.array().cast("array<long>")
    positives = cut(_ranked(search(rows, anchors.withColumn("positives", none), index), ["r"], POSITIVES))
    windows = positives.groupBy("r").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "score"))), lambda p: p["score"]).alias("positives"))
    asking = cut(anchors.join(windows, "r"))
    negatives = _ranked(search(rows, asking, index), ["r", "k"], NEGATIVES)
    chosen = positives.select("r", (F.col("rank") - 1).alias("k"), F.col("v").alias("positive"), F.col("score").alias("positive_score"))
    return negatives.join(chosen, ["r", "k"]).join(anchors.select("r", F.col("v").alias("anchor")), "r").select(
        real_id("anchor").alias("anchor_id"), real_id("positive").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
        real_id("v").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(table(spark, sf_dir, "embeddings"))


OP11_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT) FOR c IN embedding] AS x
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
             CAST(list_sum([p[1] * p[2] FOR p IN list_zip(a.x, b.x)]) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, other AS negative_id, positive_score,
       score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)
QUALIFY rank <= 10
"""
