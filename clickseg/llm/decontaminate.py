"""Operator 10: benchmark passages in training documents by spaced-seed hashing.

A seed is the hash of the tokens under a fixed mask; tokens under the mask's
zeros are free, so substitutions there do not hide a passage.  Training seeds
are joined to test seeds on their hash, and every hit is verified on the tokens
around it: a passage counts if ``WINDOW`` aligned tokens agree in all but
``MISSES``.  The three masks meet every such window (tests enumerate all
placements of the substitutions), so nothing is lost before verification.

Tokens are lower-cased runs of ASCII letters, digits and non-ASCII characters.
Test items of fewer than ``WINDOW`` but at least ``SHORTEST`` tokens must agree
over their whole length in all but ``SHORT_MISSES``; shorter items cannot
contaminate anything.

The scan drops training seeds whose bit in a table is not set by any test seed.  The
table has 16 bits a test seed, between ``2**FILTER_BITS`` and ``2**MAX_FILTER_BITS`` bits
(2 to 32 MB), and it only spares the shuffle rows that would not join.
Equal contexts, as copies of a passage make them, are joined and verified once.

Every window that passes is found, by any seed inside it.  A context carries its passing
windows as bits; a document's bits are gathered in blocks of 32 positions, so many seeds
of one passage collapse in the partial aggregate.  The document's windows, first and last
token are those of all items together; :func:`passages` gives the merged spans of each
item, one row per document, item and span.

Defined results: null, empty and too short texts on either side match nothing; a
null ``item_id`` or ``doc_id`` is reported as null; rows repeated in the
benchmark change nothing; rows of documents that share id and text are one
document; an empty table on either side gives no rows; further columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickseg.llm.common import (blocks, cut, keyed, lists, mix, of_documents, real_id, ship, signed, span_hashes,
                                 table, tokens)

#: Masks of weight 6 (fixed values): 1 reads the token, 0 ignores it.
MASKS = ("111111", "11010111", "11101011")
WINDOW, MISSES = 13, 2
SHORTEST, SHORT_MISSES = 8, 1
FILTER_BITS, MAX_FILTER_BITS = 24, 28
_WIDTH = 2 * WINDOW - 1  # tokens of a context; the seed starts in its middle


def seeds(words: np.ndarray, doc: np.ndarray, first: np.ndarray) -> Iterator[np.ndarray]:
    """Per mask: the seed hash at every word (0 where the mask leaves the document)."""
    end = first[1:][doc] if len(doc) else np.zeros(0, np.int64)
    at = np.arange(len(words))
    for m, mask in enumerate(MASKS):
        h = np.full(len(words), m + 1, np.uint64)
        for i, bit in enumerate(mask):
            if bit == "1":
                h[: len(h) - i or None] = mix(h[: len(h) - i or None] + words[i:]) if i < len(h) else 0
        h[at + len(mask) > end] = 0
        yield h


def contexts(words: np.ndarray, doc: np.ndarray, first: np.ndarray, at: np.ndarray, missing: int) -> np.ndarray:
    """The ``_WIDTH`` tokens around each position; ``missing`` outside the document."""
    i = at[:, None] + np.arange(1 - WINDOW, WINDOW)[None, :]
    inside = (i >= first[doc[at]][:, None]) & (i < first[doc[at] + 1][:, None])
    return np.where(inside, words[np.clip(i, 0, max(0, len(words) - 1))], np.uint64(missing))


def _rows(column: pa.Array, missing: int, wanted) -> Iterator[tuple]:
    """``(row, position, hash, context, tokens of the row)`` arrays of the wanted seeds, per block."""
    for base, data, offsets in blocks(column):
        t = tokens(data, offsets, "alnum", lower=True)
        size = np.diff(t.first)
        for h in seeds(t.hash, t.doc, t.first):
            at = np.flatnonzero(wanted(h) & (h != 0))
            at = at[size[t.doc[at]] >= SHORTEST]
            for k in range(0, len(at), 20_000):
                a = at[k: k + 20_000]
                row = t.doc[a]
                yield base + row, a - t.first[row], h[a], contexts(t.hash, t.doc, t.first, a, missing), size[row]


def _batch(ids: list, column: pa.Array, missing: int, wanted, names: list[str]) -> Iterator[pa.RecordBatch]:
    for row, pos, h, ctx, size in _rows(column, missing, wanted):
        key = span_hashes(ctx.ravel(), np.arange(len(ctx)) * _WIDTH, (np.arange(len(ctx)) + 1) * _WIDTH)
        yield pa.RecordBatch.from_arrays(
            [*[c.take(pa.array(row)) for c in ids], pa.array(pos, pa.int32()), pa.array(size, pa.int32()),
             pa.array(signed(h)), pa.array(signed(key)),
             lists(signed(ctx.ravel()), np.full(len(ctx), _WIDTH), pa.int64())], names)


def item_seeds(benchmark: DataFrame) -> DataFrame:
    """Distinct test contexts per item: ``hash, ikey, ictx, size, item``; ``size`` is ``WINDOW`` for all longer items."""
    names = ["item", "pos", "size", "hash", "key", "ctx"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield from _batch([b.column(0)], b.column(1), 1, lambda h: np.ones(len(h), bool), names)

    rows = benchmark.select(benchmark["item_id"].cast("long").alias("item"), benchmark["text"].cast("string").alias("text")
                            ).mapInArrow(run, "item long, pos int, size int, hash long, key long, ctx array<long>")
    return rows.groupBy("hash", F.col("key").alias("ikey"), F.least("size", F.lit(WINDOW)).alias("size"), "item").agg(
        F.first("ctx").alias("ictx"))


def seed_filter(test: DataFrame) -> np.ndarray:
    """Bit table of the test seeds, built by Spark's bitmap aggregates."""
    bits = min(MAX_FILTER_BITS, max(FILTER_BITS, int(16 * test.count()).bit_length()))
    bit = F.pmod("hash", F.lit(1 << bits)) + 1
    got = test.select(F.bitmap_bucket_number(bit).alias("b"), F.bitmap_bit_position(bit).alias("p")
                      ).groupBy("b").agg(F.bitmap_construct_agg("p").alias("m")).collect()
    out = np.zeros(1 << (bits - 3), np.uint8)
    for r in got:
        m = np.frombuffer(bytes(r["m"]), np.uint8)
        out[(r["b"] - 1) * len(m): r["b"] * len(m)] = m[: len(out)]
    return out


def training_hits(docs: DataFrame, filter_bits: np.ndarray) -> DataFrame:
    """``d, t, pos, size, hash, key, ctx`` of the training seeds that pass the filter."""
    shared = docs.sparkSession.sparkContext.broadcast(filter_bits)
    names = ["d", "t", "pos", "size", "hash", "key", "ctx"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table_ = shared.value
        mask = np.uint64(len(table_) * 8 - 1)

        def wanted(h: np.ndarray) -> np.ndarray:
            b = h & mask
            return (table_[b >> np.uint64(3)] >> (b & np.uint64(7)).astype(np.uint8)) & 1 == 1

        for b in batches:
            yield from _batch([b.column(0), b.column(1)], b.column(2), 0, wanted, names)

    return keyed(docs).select("d", "t", F.col("text").cast("string")).mapInArrow(
        run, "d long, t long, pos int, size int, hash long, key long, ctx array<long>")


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keep the context pairs with windows that pass: bit b of ``windows`` stands for the one that begins
    b places after the context's first token."""
    bits = np.int64(1) << np.arange(_WIDTH)
    for b in batches:
        if not b.num_rows:
            continue
        a, z = (np.asarray(b.column(i).flatten()).reshape(-1, _WIDTH) for i in (3, 4))
        size = b.column(5).to_numpy()
        inside = np.cumsum(np.pad((a != 0) & (z != 1), ((0, 0), (1, 0))), axis=1)
        same = np.cumsum(np.pad(a == z, ((0, 0), (1, 0))), axis=1)
        # Windows that leave the document or the item do not count.
        agree = np.where(inside[:, WINDOW:] - inside[:, :-WINDOW] == WINDOW, same[:, WINDOW:] - same[:, :-WINDOW], 0)
        long_ = (agree >= WINDOW - MISSES) @ bits[: agree.shape[1]]
        # A short item lies within the context as a whole: its tokens are those not missing.
        whole = np.where(inside[:, -1] == size, same[:, -1], 0)
        short = np.where(whole >= size - SHORT_MISSES, bits[(z != 1).argmax(axis=1)], 0)
        is_short = size < WINDOW
        windows = np.where(is_short, short, long_)
        ok = np.flatnonzero(windows)
        yield pa.RecordBatch.from_arrays(
            [*[b.column(i).take(pa.array(ok)) for i in range(3)], pa.array(size[ok], pa.int32()), pa.array(windows[ok]),
             pa.array(np.where(is_short, whole, agree.max(axis=1))[ok], pa.int32())],
            ["hash", "key", "ikey", "length", "windows", "agree"])


def overlaps(docs: DataFrame, benchmark: DataFrame, by_item: bool = False) -> DataFrame:
    """Verified windows: ``d, t, item, length, block, windows, agree``.  Bit b of ``windows`` stands for the window
    that begins at token ``32 * block + b - 64`` of the whole text; ``item`` is the smallest that matches there, or
    with ``by_item`` each of them, one row each."""
    ship(docs.sparkSession)
    test = cut(item_seeds(benchmark))
    hits = cut(training_hits(docs, seed_filter(test)))
    ours = hits.groupBy("hash", "key").agg(F.first("ctx").alias("ctx"))
    theirs = test.groupBy("hash", "ikey", "size").agg(F.first("ictx").alias("ictx"))
    checked = ours.join(theirs, "hash").select("hash", "key", "ikey", "ctx", "ictx", "size").mapInArrow(
        _verify, "hash long, key long, ikey long, length int, windows long, agree int")
    names = test.select("hash", "ikey", F.col("size").alias("length"), "item")
    if not by_item:
        names = names.groupBy("hash", "ikey", "length").agg(F.min("item").alias("item"))
    keys = ["hash", "key", "length", *(["item"] if by_item else [])]
    smallest = [] if by_item else [F.min("item").alias("item")]
    best = cut(checked).join(names, ["hash", "ikey", "length"]).groupBy(*keys).agg(
        F.bit_or("windows").alias("windows"), F.max("agree").alias("agree"), *smallest)
    base = F.col("pos") - (WINDOW - 1) + 64
    bits = F.expr(f"shiftleft(windows, CAST(pmod(pos - {WINDOW - 1}, 32) AS INT))")
    found = hits.select("d", "t", "pos", "hash", "key").join(best, ["hash", "key"]).select(
        "d", "t", "item", "length", "agree", F.explode(F.array(
            F.struct(F.floor(base / 32).alias("block"), bits.bitwiseAND(F.lit(0xFFFFFFFF)).alias("windows")),
            F.struct((F.floor(base / 32) + 1).alias("block"), F.shiftrightunsigned(bits, 32).alias("windows")))).alias("b"))
    keys = ["d", "t", "length", "block", *(["item"] if by_item else [])]
    return found.select("d", "t", "item", "length", "agree", "b.block", "b.windows").filter("windows != 0").groupBy(*keys).agg(
        F.bit_or("windows").alias("windows"), F.max("agree").alias("agree"), *smallest)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per contaminated document: ``d, t``, the verified windows, the tokens between the first and
    the last of them, the best agreement and the smallest item id met."""
    w, at = F.col("windows"), 32 * F.col("block") - 64
    lowest = F.bit_count(w.bitwiseAND(-w) - 1)
    return overlaps(docs, benchmark).groupBy("d", "t").agg(
        F.sum(F.bit_count(w)).alias("n_windows"), F.min(at + lowest).alias("first_token"),
        F.max(at + F.length(F.bin(w)) - 1 + F.col("length")).alias("last_token"), F.max("agree").alias("best_agreement"),
        F.min("item").alias("item_id"))


def passages(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Merged spans per document and item: ``d, t, item, first_token, last_token, n_windows``; windows
    that overlap or touch are one span.  The rows are the answer's own: documents times items that hold the passage."""
    windows = overlaps(docs, benchmark, by_item=True).select(
        "d", "t", "item", "length", F.posexplode(F.split(F.reverse(F.bin("windows")), "")).alias("b", "on"), "block"
    ).filter("on = '1'").withColumn("start", 32 * F.col("block") - 64 + F.col("b")).withColumn("end", F.col("start") + F.col("length"))
    own = Window.partitionBy("d", "t", "item").orderBy("start", "end")
    reach = F.max("end").over(own.rowsBetween(Window.unboundedPreceding, -1))
    span = F.sum(F.when(F.col("start") > F.col("reach"), 1).otherwise(0)).over(own)
    return windows.withColumn("reach", reach).withColumn("span", span).groupBy("d", "t", "item", "span").agg(
        F.min("start").alias("first_token"), F.max("end").alias("last_token"), F.count("*").alias("n_windows")
    ).drop("span")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contaminated documents; a document without a row is clean."""
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(real_id("d").alias("doc_id"), F.col("n_windows"), "first_token", "last_token",
                        "best_agreement", "item_id")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents without a benchmark passage, columns unchanged."""
    return of_documents(docs, cut(contaminated(docs, table(spark, sf_dir, "benchmark")).select("d", "t")), "left_anti")
