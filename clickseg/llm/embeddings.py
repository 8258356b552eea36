"""Operator 4: near-duplicate vectors by product quantisation.

Coarse centroids cut the unit sphere into inverted lists of about ``LIST_SIZE``
vectors; a vector's residual to its centroid is coded by ``SUBSPACES`` sub-vectors
of ``CODEWORDS`` entries each.  Every vector is a query of the lists that can hold
its links (below), and a table of its inner products with all codewords gives the
approximate cosine to each member by table look-up (asymmetric: the query itself
is not coded).  A member's coding error bounds how far that can be off, so a
member goes on exactly if the bound allows a cosine of ``SIMILARITY``, and the
exact cosine in double precision decides.

Centroids and codewords are fitted on at most ``SAMPLE`` vectors (those with the
smallest hash of the id); all vectors are coded and all are queries.

A query probes its ``PROBES`` nearest lists and every further list whose border
with the own list is within ``margin`` of it, without the lists whose radius
leaves no room for a cosine of ``SIMILARITY`` (that loses nothing).  The margin is
the largest that any link of ``CHECKED`` sampled vectors to any vector of the table
needs; it cannot exceed the distance of linked vectors.  The number of probes thus
follows from the data: members of a large group of near copies probe all lists that
the group is spread over.  Up to ``CHECKED`` distinct vectors no link is lost; above,
what is approximate is the margin.  A link is found if either end probes the other's
list.  Recall against brute force is measured in the tests and README.

Equal vectors collapse first and count by multiplicity.  Lists meet their
queries in blocks of ``BLOCK`` rows, so a list that holds a third of all vectors
is many small tasks.  A task returns link counts per vector and, instead of
pairs, the links of a spanning forest of what it found.

Defined results: null and zero vectors and vectors with null or non-finite
components have no links and stay; vectors of different lengths are not
compared; a null ``vec_id`` sorts first; rows that repeat an id are vectors of
their own with the same id, linked if their components say so; an empty table
gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickseg.llm.common import NULL_ID, cut, lists, real_id, ship, table
from clickseg.llm.components import components

SIMILARITY = 0.9
SAMPLE = 20_000
LIST_SIZE = 512
MAX_LISTS = 4096
PROBES = 12
#: Vectors whose links to all others are found by brute force, for the margin.
CHECKED = 2048
SUBSPACES = 8
CODEWORDS = 64
BLOCK = 1024
ROUNDS = 12


# --- the index ---------------------------------------------------------------

def k_means(x: np.ndarray, k: int, seed: int, rounds: int = ROUNDS, sphere: bool = False) -> np.ndarray:
    """Lloyd iterations from ``k`` rows picked with a fixed seed; empty centers stay where they are."""
    rng = np.random.default_rng(seed)
    c = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        near = nearest(x, c)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        n = np.bincount(near, minlength=len(c))[:, None]
        c = np.where(n > 0, total / np.maximum(n, 1), c)
        if sphere:
            c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    half = (c * c).sum(axis=1) / 2
    return np.concatenate([(x[i: i + 4096] @ c.T - half).argmax(axis=1) for i in range(0, len(x), 4096)]) \
        if len(x) else np.zeros(0, np.int64)


class Index:
    """Centroids and codebooks; vectors are padded with zeros to a common length."""

    def __init__(self, sample: np.ndarray, n_vectors: int):
        self.width = -(-max(1, sample.shape[1]) // SUBSPACES) * SUBSPACES
        x = self.pad(sample)
        n_lists = int(min(MAX_LISTS, max(1, n_vectors // LIST_SIZE), len(x)))
        self.centroids = k_means(x, n_lists, 1, sphere=True)
        rest = (x - self.centroids[nearest(x, self.centroids)]).reshape(len(x), SUBSPACES, -1)
        self.codebooks = [k_means(rest[:, s], min(CODEWORDS, len(x)), s + 2) for s in range(SUBSPACES)]
        between = self.centroids @ self.centroids.T
        self.apart = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * between))
        self.nearest_lists = min(PROBES, n_lists)
        self.checked = (x[:CHECKED], np.zeros(0, np.int32), np.zeros(0, np.int64))
        self.radius = np.full(n_lists, np.pi)
        self.margin = 0.0

    def pad(self, x: np.ndarray) -> np.ndarray:
        return np.pad(x, ((0, 0), (0, self.width - x.shape[1])))

    def own(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest list of each vector and the angle to its centroid."""
        score = x @ self.centroids.T
        own = score.argmax(axis=1)
        return own, np.arccos(np.clip(score[np.arange(len(x)), own], -1.0, 1.0))

    def beyond(self, score: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Distance of each vector to the border between its own list and each list; 0 for the nearest lists."""
        out = np.maximum(0.0, score[np.arange(len(own)), own][:, None] - score) / np.maximum(self.apart[own], 1e-12)
        k = self.nearest_lists
        out[score >= np.partition(score, -k, axis=1)[:, -k][:, None]] = 0.0
        return out

    def needed(self, x: np.ndarray, own: np.ndarray, size: np.ndarray, n: np.ndarray) -> float:
        """The largest margin that a link between these and the checked vectors needs."""
        q, q_size, q_n = self.checked
        u, v = np.nonzero(x @ q.T >= SIMILARITY - 1e-9)
        ok = (size[u] == q_size[v]) & (n[u] != q_n[v])
        u, v = u[ok], v[ok]
        if not len(u):
            return 0.0
        q_score = q @ self.centroids.T
        q_own = q_score.argmax(axis=1)
        there, back = self.beyond(x @ self.centroids.T, own), self.beyond(q_score, q_own)
        return float(np.minimum(there[u, q_own[v]], back[v, own[u]]).max())

    def probes(self, x: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Whether each vector probes each list."""
        score = x @ self.centroids.T
        out = self.beyond(score, own) <= self.margin + 1e-9
        out &= np.arccos(np.clip(score, -1.0, 1.0)) <= np.arccos(SIMILARITY) + self.radius + 1e-6
        out[np.arange(len(own)), own] = True
        return out

    def encode(self, x: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes and coding errors (distance between the residual and its code)."""
        rest = (x - self.centroids[own]).reshape(len(x), SUBSPACES, -1)
        codes = np.stack([nearest(rest[:, s], c) for s, c in enumerate(self.codebooks)], axis=1)
        coded = np.stack([c[codes[:, s]] for s, c in enumerate(self.codebooks)], axis=1)
        return codes.astype(np.uint8), np.sqrt(((rest - coded) ** 2).sum(axis=(1, 2)))

    def tables(self, q: np.ndarray) -> np.ndarray:
        """Inner products of each query's sub-vectors with all codewords."""
        parts = q.reshape(len(q), SUBSPACES, -1)
        out = np.zeros((len(q), SUBSPACES, CODEWORDS))
        for s, c in enumerate(self.codebooks):
            out[:, s, : len(c)] = parts[:, s] @ c.T
        return out


# --- vectors -------------------------------------------------------------------

def vectors(rows: DataFrame) -> DataFrame:
    """``v, k1, k2, x``: id, hash key and components of the vectors that can have links."""
    x = rows["embedding"].cast("array<double>")
    x = F.transform(x, lambda e: e + F.lit(0.0))  # no negative zeros
    good = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf")))) & F.exists(x, lambda e: e != 0)
    return rows.select(F.coalesce(rows["vec_id"].cast("long"), F.lit(NULL_ID)).alias("v"),
                       F.when(good, x).alias("x")).select(
        "v", F.when(F.col("x").isNotNull(), F.xxhash64("x")).alias("k1"), F.xxhash64(F.lit(1), F.col("x")).alias("k2"), "x")


def _matrix(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit rows padded to ``width``, and the lengths of the vectors."""
    size = np.diff(np.asarray(column.offsets))
    out = np.zeros((len(column), width))
    out[np.repeat(np.arange(len(size)), size), np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)] = column.flatten()
    out /= np.abs(out).max(axis=1, keepdims=True)  # squares of very large or small numbers leave the range
    return out / np.linalg.norm(out, axis=1, keepdims=True), size


def fit(distinct: DataFrame, n_vectors: int, sample: int = SAMPLE) -> Index | None:
    """The index from a bounded sample; None without vectors."""
    got = distinct.orderBy(F.xxhash64("n"), "n").limit(sample).select("n", "x").toArrow().combine_chunks()
    if not len(got):
        return None
    column = got.column("x").combine_chunks()
    width = max(len(v) for v in column.to_pylist())
    widest = distinct.agg(F.max(F.size("x"))).first()[0]
    x, size = _matrix(column, max(width, widest))
    index = Index(x, n_vectors)
    index.checked = (index.checked[0], size[:CHECKED], got.column("n").to_numpy()[:CHECKED])
    return index


CODED = "n long, m long, x array<double>, size int, own int, angle double, codes binary, error double"


def coded(distinct: DataFrame, index) -> DataFrame:
    """``distinct`` with the own list, the angle to its centroid, codes and coding errors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = index.value
        for b in batches:
            for at in range(0, b.num_rows, 2048):
                s = b.slice(at, 2048)
                x, size = _matrix(s.column(2), ix.width)
                own, angle = ix.own(x)
                codes, error = ix.encode(x, own)
                yield pa.RecordBatch.from_arrays(
                    [s.column(0), s.column(1), pa.array(list(x), pa.list_(pa.float64())), pa.array(size, pa.int32()),
                     pa.array(own, pa.int32()), pa.array(angle), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error)],
                    ["n", "m", "x", "size", "own", "angle", "codes", "error"])

    return distinct.select("n", "m", "x").mapInArrow(run, CODED)


def _rows(b: pa.RecordBatch, width: int, step: int) -> Iterator[tuple]:
    """Slices of a batch that starts with ``x, own``, with these as arrays."""
    for at in range(0, b.num_rows, step):
        s = b.slice(at, step)
        yield s, np.asarray(s.column(0).flatten()).reshape(-1, width), s.column(1).to_numpy()


def margin(file: DataFrame, index) -> float:
    """The largest margin that a link of the checked vectors needs (see :meth:`Index.needed`)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix, most = index.value, 0.0
        for b in batches:
            for s, x, own in _rows(b, ix.width, 1024):
                most = max(most, ix.needed(x, own, s.column(2).to_numpy(), s.column(3).to_numpy()))
        yield pa.RecordBatch.from_arrays([pa.array([most])], ["margin"])

    got = file.select("x", "own", "size", "n").mapInArrow(run, "margin double").agg(F.max("margin")).first()[0]
    return float(got or 0.0)


def inverted(file: DataFrame, index) -> DataFrame:
    """The inverted file: ``file`` with the lists to probe, as numbers and as bits."""
    keep = ["n", "m", "size", "codes", "error"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = index.value
        for b in batches:
            for s, x, own in _rows(b, ix.width, 1024):
                probed = ix.probes(x, own)
                yield pa.RecordBatch.from_arrays(
                    [*s.columns, lists(np.nonzero(probed)[1], probed.sum(axis=1), pa.int32()),
                     pa.array([p.tobytes() for p in np.packbits(probed, axis=1)], pa.binary())],
                    ["x", "own", *keep, "probes", "bits"])

    return file.select("x", "own", *keep).mapInArrow(
        run, "x array<double>, own int, n long, m long, size int, codes binary, error double, probes array<int>, bits binary")


# --- search ----------------------------------------------------------------------

def _forest(u: np.ndarray, v: np.ndarray) -> list[tuple[int, int]]:
    """Links of a spanning forest of the given links."""
    root: dict[int, int] = {}

    def find(a: int) -> int:
        while root.setdefault(a, a) != a:
            root[a] = root[root[a]]
            a = root[a]
        return a

    out = []
    for a, b in zip(u.tolist(), v.tolist()):
        ra, rb = find(a), find(b)
        if ra != rb:
            root[ra] = rb
            out.append((a, b))
    return out


def meet(ix: Index, list_id: int, q: pa.Table, y: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Links between a block of queries and a block of one list: pairs of row numbers."""
    xq, xy = (np.asarray(t.column("x").combine_chunks().flatten()).reshape(-1, ix.width) for t in (q, y))
    codes = np.frombuffer(b"".join(y.column("codes").to_pylist()), np.uint8).reshape(-1, SUBSPACES).astype(np.int64)
    error = y.column("error").to_numpy()
    sq, sy, nq, ny = q.column("size").to_numpy(), y.column("size").to_numpy(), q.column("n").to_numpy(), y.column("n").to_numpy()
    base, look = xq @ ix.centroids[list_id], ix.tables(xq)
    us, vs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i in range(0, len(xq), 64):
        approx = np.repeat(base[i: i + 64, None], len(xy), axis=1)
        for s in range(SUBSPACES):
            approx += look[i: i + 64, s][:, codes[:, s]]
        u, v = np.nonzero(approx + error[None, :] >= SIMILARITY - 1e-9)
        u += i
        ok = (nq[u] != ny[v]) & (sq[u] == sy[v])
        u, v = u[ok], v[ok]
        exact = np.concatenate([np.einsum("ij,ij->i", xq[u[k: k + 8192]], xy[v[k: k + 8192]]) for k in range(0, len(u), 8192)]) \
            if len(u) else np.zeros(0)
        us.append(u[exact >= SIMILARITY])
        vs.append(v[exact >= SIMILARITY])
    return np.concatenate(us), np.concatenate(vs)


def searcher(index):
    """Rows ``list, pq, py, side, n, m, own, x, size, bits, codes, error`` sorted so that the two
    blocks that meet stand together, to ``n, links, other``: links counted or a link of the forest."""
    def results(rows: pa.Table) -> pa.RecordBatch:
        ix, side = index.value, rows.column("side").to_numpy()
        q, y = (rows.take(pa.array(np.flatnonzero(side == k))) for k in (0, 1))
        n, links, other = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if len(q) and len(y):
            u, v = meet(ix, rows.column("list")[0].as_py(), q, y)
            nq, ny, mq, my = q.column("n").to_numpy(), y.column("n").to_numpy(), q.column("m").to_numpy(), y.column("m").to_numpy()
            own = q.column("own").to_numpy()
            # A link counts for the query here; for the member too unless it finds the query by a probe of its own.
            bits = np.frombuffer(b"".join(y.column("bits").to_pylist()), np.uint8).reshape(len(y), -1)
            blind = np.unpackbits(bits, axis=1)[v, own[u]] == 0
            for at, ids, weight in ((u, nq, my[v]), (v[blind], ny, mq[u][blind])):
                count = np.zeros(len(ids), np.int64)
                np.add.at(count, at, weight)
                n.append(ids[count > 0])
                links.append(count[count > 0])
                other.append(ids[count > 0])
            tree = np.array(_forest(nq[u], ny[v]), np.int64).reshape(-1, 2)
            n.append(tree[:, 0])
            links.append(np.zeros(len(tree), np.int64))
            other.append(tree[:, 1])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (n, links, other)], ["n", "links", "other"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = pa.concat_tables([held, t]).combine_chunks() if held else t
            if not t.num_rows:
                continue
            key = np.stack([t.column(c).to_numpy() for c in ("list", "pq", "py")])
            edge = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
            for lo, hi in zip(np.concatenate(([0], edge)), edge):
                yield results(t.slice(lo, hi - lo))
            held = t.slice(edge[-1] if len(edge) else 0)
        if held:
            yield results(held)

    return run



def links(file: DataFrame, index) -> DataFrame:
    """``n, links, other``: see :func:`searcher`."""
    queries = file.withColumn("list", F.explode("probes"))
    members = file.withColumn("list", F.col("own"))
    sizes = cut(queries.groupBy("list").agg(F.count("*").alias("q_rows")).join(
        members.groupBy("list").agg(F.count("*").alias("y_rows")), "list").withColumns(
        {"q_parts": F.ceil(F.col("q_rows") / BLOCK).cast("int"), "y_parts": F.ceil(F.col("y_rows") / BLOCK).cast("int")}))
    small = F.broadcast(sizes)  # one row per list: at most MAX_LISTS
    columns = ["n", "m", "own", "x", "size", "bits", "codes", "error"]
    part = lambda parts: F.pmod(F.xxhash64("n", "list"), F.col(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.col(parts) - 1))
    q = queries.join(small, "list").withColumn("pq", part("q_parts")).withColumn("py", every("y_parts")).select(
        "list", "pq", "py", F.lit(0).alias("side"), *columns)
    y = members.join(small, "list").withColumn("py", part("y_parts")).withColumn("pq", every("q_parts")).select(
        "list", "pq", "py", F.lit(1).alias("side"), *columns)
    return q.unionByName(y).repartition("list", "pq", "py").sortWithinPartitions("list", "pq", "py").mapInArrow(
        searcher(index), "n long, links long, other long")


def near_vectors(rows: DataFrame) -> DataFrame:
    """``v, n_links, component`` of every row."""
    spark = rows.sparkSession
    ship(spark)
    mine = vectors(rows)
    distinct = cut(mine.filter("k1 IS NOT NULL").groupBy("k1", "k2").agg(
        F.min("v").alias("n"), F.count("*").alias("m"), F.first("x").alias("x")))
    # Two different vectors may carry the same id: number them apart, in the order of the id.
    distinct = cut(distinct.orderBy("n", "k1", "k2").withColumn("v", F.col("n")).withColumn("n", F.monotonically_increasing_id()))
    model = fit(distinct, distinct.count())
    if model is None:
        return mine.select("v", F.lit(0).cast("long").alias("n_links"), F.col("v").alias("component"))
    index = spark.sparkContext.broadcast(model)
    file = cut(coded(distinct, index))
    for r in file.groupBy("own").agg(F.max("angle").alias("radius")).collect():  # at most MAX_LISTS
        model.radius[r["own"]] = r["radius"]
    model.margin = margin(file, index)
    index = spark.sparkContext.broadcast(model)
    found = cut(links(cut(inverted(file, index)), index))
    counts = found.groupBy("n").agg(F.sum("links").alias("links"))
    groups = components(found.filter("links = 0"), "n", "other")
    head = distinct.select(F.col("n").alias("component"), F.col("v").alias("head"))
    named = groups.join(head, "component").select(F.col("node").alias("n"), "head")
    known = cut(distinct.join(counts, "n", "left").join(named, "n", "left").select(
        "k1", "k2", (F.col("m") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("head", "v").alias("component")))
    return mine.drop("x").join(known, ["k1", "k2"], "left").select(
        "v", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "v").alias("component"))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings")).select(
        real_id("v").alias("vec_id"), "n_links", real_id("component").alias("component_id"),
        (F.col("v") == F.col("component")).alias("kept"))


OP4_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0),
l AS (SELECT a.vec_id AS u, b.vec_id AS w FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
r AS (SELECT u, w FROM l UNION SELECT r.u, l.w FROM r JOIN l ON r.w = l.u)
SELECT e.vec_id, coalesce(n, 0) AS n_links, least(e.vec_id, coalesce(m, e.vec_id)) AS component_id,
       m IS NULL OR m >= e.vec_id AS kept
FROM embeddings e
LEFT JOIN (SELECT u, count(*) AS n FROM l GROUP BY u) c ON c.u = e.vec_id
LEFT JOIN (SELECT u, min(w) AS m FROM r GROUP BY u) d ON d.u = e.vec_id
"""
