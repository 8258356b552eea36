"""Operator 1: near-duplicate documents by ProbMinHash.

A document is the weighted set of its ``SHINGLE``-word shingles (weight: how
often it occurs).  Each shingle is a Poisson process whose rate is its weight;
arrivals fall on random registers, a register keeps its earliest arrival's
shingle, and a shingle stops as soon as its next arrival is later than every
register.  Two registers agree with the probability Jaccard similarity
J_P = sum over shared i of 1 / sum_j max(x_j / x_i, y_j / y_i).

Registers are cut into bands; documents that share a band are compared on their
registers and then verified on their texts with the exact J_P.  Groups are the
connected components of the verified links.

No group is spelled out into pairs.  Exact copies (equal word sequences)
collapse to one text first.  Each band bucket then links its documents to one
of them, its pivot.  What is left are pairs that share a pivot but are not yet
connected: the documents of a pivot meet in blocks of ``BLOCK`` inside tasks, are
compared on their registers and then on their shingles, and a task returns a
spanning forest of the links it found.  So rows grow with the documents, though
a group of near copies that are not similar enough to be linked costs a
comparison of registers per pair.  A pair at 0.8 shares no band with a
probability of (1 - 0.8^ROWS)^BANDS, about 4e-7.

Defined results: words are runs of characters outside space and \\x09-\\x0D, as
they are; a text of one to four words has one shingle, all its words; null texts
and texts without words link with nothing; rows that repeat id and text are one
document; a null id sorts first; an empty table gives no rows; further columns
are kept by the pipeline stage and ignored by the query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickseg.llm.common import (blocks, cut, keyed, mix, of_documents, packed, real_id, ship, signed, span_hashes, table,
                                 tokens, unit)
from clickseg.llm.components import components

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 28, 4
REGISTERS = BANDS * ROWS
#: Registers that must agree before texts are compared: 4.5 standard deviations under 0.8.
AGREE = int(REGISTERS * (SIMILARITY - 4.5 * (SIMILARITY * (1 - SIMILARITY) / REGISTERS) ** 0.5))
BLOCK = 512
#: Rows a task at least, of keys and of sketches or texts: tables are laid out by their counted rows.
KEYS, TEXTS = 200_000, 5_000


def shingles(words: np.ndarray, first: np.ndarray, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, shingle hash, weight)`` of a block of rows, sorted by row."""
    size = np.diff(first)
    count = np.where(size >= n, size - n + 1, (size > 0).astype(np.int64))
    row = np.repeat(np.arange(len(size)), count)
    start = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + first[row]
    h = span_hashes(words, start, np.minimum(start + n, first[row + 1]))
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (row[1:] != row[:-1])))) if len(h) else np.zeros(0, int)
    return row[new], h[new], np.diff(np.append(new, len(h)))


def signatures(row: np.ndarray, h: np.ndarray, weight: np.ndarray, n_rows: int) -> np.ndarray:
    """ProbMinHash registers (16-bit marks of the winning shingles) per row."""
    m = REGISTERS
    when = np.full(n_rows * m, np.inf)
    mark = np.zeros(n_rows * m, np.uint16)
    t = np.zeros(len(h))
    live, k = np.arange(len(h)), 0
    while len(live):
        k += 1
        x = mix(h[live] + np.uint64((k * 0x9E3779B97F4A7C15) & (2 ** 64 - 1)))
        t[live] += -np.log(unit(x)) / weight[live]  # the next arrival of each process
        still, of = np.unique(row[live], return_inverse=True)
        live = live[t[live] < when.reshape(n_rows, m)[still].max(axis=1)[of]]
        x = mix(h[live] + np.uint64((k * 0xD1B54A32D192ED03 + 1) & (2 ** 64 - 1)))
        at = row[live] * m + (x % np.uint64(m)).astype(np.int64)
        np.minimum.at(when, at, t[live])
        won = t[live] == when[at]
        mark[at[won]] = (h[live][won] >> np.uint64(48)).astype(np.uint16)
    return mark.reshape(n_rows, m)


def sketches(docs: DataFrame) -> DataFrame:
    """``d, t, c1, c2, marks``: 128-bit hash of the word sequence and the registers of every
    document; nulls without words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, data, offsets in blocks(b.column(2)):
                w, rows = tokens(data, offsets), len(offsets) - 1
                none = np.diff(w.first) == 0
                c = [pa.array(signed(span_hashes(x, w.first[:-1], w.first[1:])), mask=none)
                     for x in (w.hash, mix(w.hash ^ np.uint64(0x5851F42D4C957F2D)))]
                marks = signatures(*shingles(w.hash, w.first), rows)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, rows), b.column(1).slice(at, rows), *c,
                     pa.array([x.tobytes() for x in marks], pa.binary())], ["d", "t", "c1", "c2", "marks"])

    return keyed(docs).select("d", "t", F.col("text").cast("string")).mapInArrow(
        run, "d long, t long, c1 long, c2 long, marks binary")


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``n, band`` rows of ``n, marks``."""
    for b in batches:
        rows = b.num_rows
        flat = mix(_marks(b.column(1)).astype(np.uint64) + np.uint64(1)).ravel()
        start = np.arange(rows * BANDS) * ROWS
        bands = span_hashes(flat, start, start + ROWS) + np.tile(np.arange(BANDS, dtype=np.uint64), rows)
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(b.column(0).to_numpy(), BANDS)), pa.array(signed(mix(bands)))],
                                         ["n", "band"])


def _marks(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs ``(u, v)`` whose registers ``(mu, mv)`` agree often enough for the texts to be compared."""
    for b in batches:
        if b.num_rows:
            ok = pa.array(np.flatnonzero((_marks(b.column(2)) == _marks(b.column(3))).sum(axis=1) >= AGREE))
            yield pa.RecordBatch.from_arrays([b.column(0).take(ok), b.column(1).take(ok)], ["u", "v"])


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact J_P of two weighted sets given as (sorted hashes, weights).

    For a shared i, sum_j max(x_j/x_i, y_j/y_i) splits at r_j = y_j/x_j against r_i,
    so sorting the ratios and two running sums do it in n log n.
    """
    keys = np.union1d(a[0], b[0])
    x, y = np.zeros(len(keys)), np.zeros(len(keys))
    x[np.searchsorted(keys, a[0])] = a[1]
    y[np.searchsorted(keys, b[0])] = b[1]
    with np.errstate(divide="ignore"):
        ratio = np.where(x > 0, y / np.where(x > 0, x, 1), np.inf)
    order = np.argsort(ratio, kind="stable")
    x, y, ratio = x[order], y[order], ratio[order]
    # Terms with ratio <= r_i take x_j / x_i, the others y_j / y_i.
    upto = np.cumsum(x)
    beyond = y.sum() - np.cumsum(y)
    both = (x > 0) & (y > 0)
    last = np.searchsorted(ratio, ratio[both], "right") - 1
    return float((1 / (upto[last] / x[both] + beyond[last] / y[both])).sum())


def shingle_sets(docs: DataFrame, wanted: DataFrame, rows: int) -> DataFrame:
    """``n, hashes, weights`` (sorted; weights null if all are 1) of the texts ``n, d, t``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, data, offsets in blocks(b.column(1)):
                w, rows = tokens(data, offsets), len(offsets) - 1
                row, h, weight = shingles(w.hash, w.first)
                cuts = np.searchsorted(row, np.arange(rows + 1))
                parts = [(h[lo:hi], weight[lo:hi]) for lo, hi in zip(cuts, cuts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, rows), pa.array([x.tobytes() for x, _ in parts], pa.binary()),
                     pa.array([None if (y == 1).all() else y.astype(np.int32).tobytes() for _, y in parts], pa.binary())],
                    ["n", "hashes", "weights"])

    # A merge join whatever the sizes: the plan of a small table is the plan of a large one.
    own = wanted.select("n", F.col("d").alias("own_d"), F.col("t").alias("own_t")).hint("merge")
    texts = keyed(docs).join(own, (F.col("d") == F.col("own_d")) & (F.col("t") == F.col("own_t")))
    one = texts.dropDuplicates(["n"]).select("n", F.col("text").cast("string"))
    return packed(one, rows, TEXTS).mapInArrow(run, "n long, hashes binary, weights binary")


def _set(hashes: bytes, weights: bytes | None) -> tuple[np.ndarray, np.ndarray | None]:
    return np.frombuffer(hashes, np.uint64), None if weights is None else np.frombuffer(weights, np.int32)


def similarity(a: tuple, b: tuple) -> float:
    """Exact J_P; with all weights 1 it is the share of common shingles."""
    if a[1] is None and b[1] is None:
        small, large = sorted((a[0], b[0]), key=len)
        at = np.minimum(np.searchsorted(large, small), len(large) - 1)
        common = int((large[at] == small).sum())
        return common / (len(small) + len(large) - common)
    return probability_jaccard(*[(h, np.ones(len(h)) if w is None else w.astype(float)) for h, w in (a, b)])


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs ``(u, v)`` with J_P of at least SIMILARITY, from ``u, v, hu, wu, hv, wv``."""
    for b in batches:
        hu, wu, hv, wv = (b.column(i) for i in range(2, 6))
        keep = [similarity(_set(hu[i].as_py(), wu[i].as_py()), _set(hv[i].as_py(), wv[i].as_py())) >= SIMILARITY - 1e-12
                for i in range(b.num_rows)]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["u", "v"]).filter(pa.array(keep, pa.bool_()))


def star_links(buckets: DataFrame, sketch: DataFrame, sets: DataFrame, rows: int) -> DataFrame:
    """``u, v``: the links of documents to the pivots of their ``rows`` buckets ``n, band, u``."""
    side = lambda n: sketch.select(F.col("n").alias(n), F.col("marks").alias(f"m{n}"))
    pairs = packed(buckets.filter("n != u").select("u", F.col("n").alias("v")).distinct(), rows, KEYS)
    met = packed(packed(pairs.join(side("u"), "u"), rows, TEXTS).join(side("v"), "v"), rows, TEXTS)
    near = cut(met.select("u", "v", "mu", "mv").mapInArrow(_agreeing, "u long, v long"))
    found = near.count()
    own = lambda n: sets.select(F.col("n").alias(n), F.col("hashes").alias(f"h{n}"), F.col("weights").alias(f"w{n}"))
    both = packed(packed(near.join(own("v"), "v"), found, TEXTS).join(own("u"), "u"), found, TEXTS)
    return both.select("u", "v", "hu", "wu", "hv", "wv").mapInArrow(_similar, "u long, v long")


def _meeting(rows: pa.Table) -> pa.RecordBatch:
    """Spanning forest of the links between components ``g``, of two blocks of a pivot's documents."""
    side, g = (rows.column(c).to_numpy() for c in ("side", "g"))
    marks = _marks(rows.column("marks"))
    pivot = rows.column("u")[0].as_py()
    pivots = [set(x) for x in rows.column("pivots").to_pylist()]
    hashes, weights = rows.column("hashes").to_pylist(), rows.column("weights").to_pylist()
    a = np.flatnonzero(side == 0)
    b = np.flatnonzero(side == 1) if rows.column("p")[0] != rows.column("q")[0] else a
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    found = []
    for i in a.tolist():
        other = b[g[b] != g[i]]
        other = other[(marks[other] == marks[i]).sum(axis=1) >= AGREE]
        for k in other.tolist():
            if a is b and k < i or find(int(g[i])) == find(int(g[k])):
                continue
            if min(pivots[i] & pivots[k]) != pivot:  # the two meet under a smaller pivot
                continue
            if similarity(_set(hashes[i], weights[i]), _set(hashes[k], weights[k])) >= SIMILARITY - 1e-12:
                root[find(int(g[i]))] = find(int(g[k]))
                found.append((int(g[i]), int(g[k])))
    return pa.RecordBatch.from_arrays([pa.array([min(x) for x in found], pa.int64()), pa.array([max(x) for x in found], pa.int64())],
                                      ["u", "v"])


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """:func:`_meeting` of rows sorted so that the two blocks that meet stand together."""
    held: pa.Table | None = None  # the rows of the last, perhaps unfinished, meeting
    for batch in batches:
        t = pa.Table.from_batches([batch])
        t = pa.concat_tables([held, t]).combine_chunks() if held else t
        if not t.num_rows:
            continue
        key = np.stack([t.column(c).to_numpy() for c in ("u", "p", "q")])
        edge = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
        for lo, hi in zip(np.concatenate(([0], edge)), edge):
            yield _meeting(t.slice(lo, hi - lo))
        held = t.slice(edge[-1] if len(edge) else 0)
    if held:
        yield _meeting(held)


def remaining_links(buckets: DataFrame, groups: DataFrame, sketch: DataFrame, sets: DataFrame, size: int) -> DataFrame:
    """``u, v``: components that links among the documents of a pivot connect.

    A pivot with k documents has ceil(k / BLOCK) blocks, and every two of them meet
    in one task, a few times ``BLOCK`` rows at once."""
    member = packed(buckets.select("u", "n").distinct(), size, KEYS).join(groups, "n", "left").withColumn("g", F.coalesce("g", "n"))
    member = cut(packed(member, size, KEYS))
    mixed = member.groupBy("u").agg(F.min("g").alias("lo"), F.max("g").alias("hi"), F.count("*").alias("k")
                                    ).filter("lo < hi").select("u", F.ceil(F.col("k") / BLOCK).cast("int").alias("parts"))
    rows = cut(packed(member.join(cut(packed(mixed, size, KEYS)), "u"), size, KEYS))
    met, copies = rows.agg(F.count("*"), F.coalesce(F.sum("parts"), F.lit(0))).first()
    pivots = packed(rows.groupBy("n").agg(F.collect_list("u").alias("pivots")), met, KEYS)  # at most BANDS
    own = cut(packed(packed(pivots.join(sketch, "n"), met, TEXTS).join(sets, "n"), met, TEXTS))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("n", "u"), F.col("parts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "u", F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"),
        (F.col("other") < F.col("part")).cast("int").alias("side"), "n", "g")
    rows = packed(rows.join(own, "n"), met, TEXTS).select("u", "p", "q", "side", "g", "marks", "pivots", "hashes", "weights")
    meetings = packed(rows.repartition("u", "p", "q"), copies, 4 * BLOCK)
    return meetings.sortWithinPartitions("u", "p", "q").mapInArrow(_meet, "u long, v long")


def classes(docs: DataFrame) -> DataFrame:
    """``d, t, class_d, class_t``: every document's class, named by its smallest member."""
    ship(docs.sparkSession)
    rows = cut(sketches(docs))
    size = rows.count()
    # One text per word sequence; numbers only tell texts apart.
    same = rows.filter("c1 IS NOT NULL").groupBy("c1", "c2").agg(F.min(F.struct("d", "t", "marks")).alias("f"))
    numbered = cut(packed(same, size, TEXTS).select("c1", "c2", "f.d", "f.t", "f.marks").withColumn("n", F.monotonically_increasing_id()))
    sketch = numbered.select("n", "marks")
    band = cut(sketch.mapInArrow(_bands, "n long, band long"))
    marked = size * BANDS
    pivots = band.groupBy("band").agg(F.min("n").alias("u"), F.count("*").alias("k")).filter("k > 1").drop("k")
    buckets = cut(packed(band.join(cut(packed(pivots, marked, KEYS)), "band"), marked, KEYS))
    shared = buckets.count()
    wanted = cut(packed(packed(buckets.select("n").distinct(), shared, KEYS).join(numbered, "n"), size, TEXTS).select("n", "d", "t"))
    sets = cut(shingle_sets(docs, wanted, wanted.count()))
    groups = cut(components(cut(star_links(buckets, sketch, sets, shared))).select(
        F.col("node").alias("n"), F.col("component").alias("g")))
    further = cut(remaining_links(buckets, groups, sketch, sets, shared))
    if not further.isEmpty():  # links between few components: only those are contracted again
        joined = cut(components(further).select(F.col("node").alias("g"), F.col("component").alias("h")))
        alone = joined.join(groups.select(F.col("n").alias("g")), "g", "left_anti")  # components of one document so far
        groups = cut(groups.join(joined, "g", "left").select("n", F.coalesce("h", "g").alias("g")).unionByName(
            alone.select(F.col("g").alias("n"), F.col("h").alias("g"))))
    linked = groups.count()
    members = cut(packed(groups.join(numbered.select("n", "d", "t"), "n"), linked, KEYS))
    head = packed(members.groupBy("g").agg(F.min(F.struct("d", "t")).alias("f")), linked, KEYS)
    named = cut(packed(members.select("n", "g").join(head, "g"), linked, KEYS).select("n", "f"))
    texts = numbered.select("n", "c1", "c2", F.struct("d", "t").alias("own")).join(named, "n", "left")
    first = cut(packed(texts, size, KEYS).select("c1", "c2", F.coalesce("f", "own").alias("f")))
    return rows.join(first, ["c1", "c2"], "left").select(
        "d", "t", F.coalesce("f.d", "d").alias("class_d"), F.coalesce("f.t", "t").alias("class_t"))


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: its class (smallest ``doc_id`` of the group) and whether it stays."""
    return classes(table(spark, sf_dir, "documents")).select(
        real_id("d").alias("doc_id"), real_id("class_d").alias("class_id"),
        ((F.col("d") == F.col("class_d")) & (F.col("t") == F.col("class_t"))).alias("kept"))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """Pipeline stage: one document of each group stays (its first), columns unchanged.
    Of rows that repeat id and text one stays; documents without words are no group."""
    c = cut(classes(docs))
    late = cut(c.filter((F.col("d") != F.col("class_d")) | (F.col("t") != F.col("class_t"))).select("d", "t").distinct())
    kept = of_documents(docs, late.hint("merge"), "left_anti")
    repeated = cut(c.groupBy("d", "t").count().filter("count > 1").select("d", "t"))
    # Repeated rows are few: only they meet to be told apart, not all texts.
    return of_documents(kept, repeated, "left_anti").unionByName(
        of_documents(kept, repeated, "left_semi").dropDuplicates(["doc_id", "text"]))
