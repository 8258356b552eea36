"""Operator 2: repeated substrings of 20 words or more, by seed and extend.

A window is ``LENGTH`` consecutive words of a document.  Winnowing picks the
rightmost smallest hash of the ``SEED``-word grams of every window as its
anchor, so equal windows have equal anchors at equal places, and about one word
in nine is an anchor.  Anchors that occur in one text only are dropped.  Around
each other anchor the match is extended both ways to all windows that chose it.
Occurrences whose whole extension is equal form a class; the earliest member
(document, then start) stands for it and the later ones are copies.  Where an
anchor has several classes, their windows are compared one by one.  Copied
windows that touch join to maximal repeats, and their words are removed.

Texts with equal word sequences are compared once: the first stands for all.
Hash keys are 128 bits wide.  Every aggregate combines on the map side, and the
joins are plain ones whose hot anchors and classes Spark splits.

Defined results: words are runs of characters outside space and \\x09-\\x0D; a
null text has none; texts of fewer than ``LENGTH`` words lose nothing; rows that
repeat id and text are one document (each gets its row); texts that share an id
are at the same place in the order, so neither is earlier than the other; a null
id sorts first; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickseg.llm.common import blocks, cut, cut_bucketed, keyed, lists, mix, real_id, ship, signed, span_hashes, table, tokens

LENGTH = 20
SEED = 5
NOTHING = hashlib.sha256(b"").hexdigest()


def _second(words: np.ndarray) -> np.ndarray:
    """Another hash of each word, for the other half of a 128-bit key."""
    return mix(words ^ np.uint64(0x2545F4914F6CDD1D))


def anchors(words: np.ndarray, first: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """``(row, anchor, low, high, hash)``: the windows that start in ``low..high`` chose the anchor."""
    gram = span_hashes(words, np.arange(max(0, len(words) - SEED + 1)), np.arange(len(words) - SEED + 1 if len(words) >= SEED else 0) + SEED)
    count = np.maximum(np.diff(first) - length + 1, 0)
    row = np.repeat(np.arange(len(count)), count)
    start = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + first[:-1][row]
    if not len(start):
        none = np.zeros(0, np.int64)
        return none, none, none, none, none.astype(np.uint64)
    best, at = gram[start], start.copy()
    for o in range(1, length - SEED + 1):
        g = gram[start + o]
        less = g <= best
        best = np.where(less, g, best)
        at[less] = start[less] + o
    new = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (row[1:] != row[:-1]))))
    return row[new], at[new], start[new], start[np.append(new[1:], len(at)) - 1], best[new]


def summaries(docs: DataFrame) -> DataFrame:
    """``d, t, n_words, c1, c2, sha256`` of every row's words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, data, offsets in blocks(b.column(2)):
                w, rows = tokens(data, offsets), len(offsets) - 1
                raw = data.tobytes()
                sha = [hashlib.sha256(b" ".join(raw[offsets[i]: offsets[i + 1]].split())).hexdigest() for i in range(rows)]
                c = [pa.array(signed(span_hashes(x, w.first[:-1], w.first[1:]))) for x in (w.hash, _second(w.hash))]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, rows), b.column(1).slice(at, rows),
                                                  pa.array(np.diff(w.first)), *c, pa.array(sha)],
                                                 ["d", "t", "n_words", "c1", "c2", "sha256"])

    return _texts(docs).mapInArrow(run, "d long, t long, n_words long, c1 long, c2 long, sha256 string")


def _texts(docs: DataFrame) -> DataFrame:
    return keyed(docs).select("d", "t", F.col("text").cast("string").alias("text"))


def anchor_texts(docs: DataFrame) -> DataFrame:
    """``h, c``: each anchor with the hash of its text; a second row where the text repeats it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, data, offsets in blocks(b.column(0)):
                w = tokens(data, offsets)
                row, _, _, _, h = anchors(w.hash, w.first)
                c = span_hashes(w.hash, w.first[:-1], w.first[1:])[row]
                order = np.lexsort((h, row))
                row, h, c = row[order], h[order], c[order]
                again = np.concatenate(([False], (h[1:] == h[:-1]) & (row[1:] == row[:-1]))) if len(h) else np.zeros(0, bool)
                yield pa.RecordBatch.from_arrays([pa.array(signed(h)), pa.array(signed(np.where(again, ~c, c)))], ["h", "c"])

    return docs.select(docs["text"].cast("string").alias("text")).mapInArrow(run, "h long, c long")


def anchor_places(docs: DataFrame) -> DataFrame:
    """``h, d, p``: each anchor with its document and word position."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, data, offsets in blocks(b.column(1)):
                w = tokens(data, offsets)
                row, place, _, _, h = anchors(w.hash, w.first)
                yield pa.RecordBatch.from_arrays([pa.array(signed(h)), b.column(0).take(pa.array(row + at)),
                                                  pa.array(place - w.first[row], pa.int32())], ["h", "d", "p"])

    return _texts(docs).select("d", "text").mapInArrow(run, "h long, d long, p int")


def extensions(texts: DataFrame) -> DataFrame:
    """``d, t, h, e1, e2, low, high, windows`` of the marked anchors of ``d, t, text, marked``:
    the extension's key and its windows' hashes."""
    names = ["d", "t", "h", "e1", "e2", "low", "high", "windows"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, data, offsets in blocks(b.column(2)):
                w = tokens(data, offsets)
                marked = b.column(3).slice(at, len(offsets) - 1)
                sizes = np.array([len(x) for x in marked.to_pylist()], np.int64)
                places = marked.flatten().to_numpy() + np.repeat(w.first[:-1], sizes)
                row, place, low, high, h = anchors(w.hash, w.first)
                keep = np.isin(place, places)
                row, place, low, high, h = row[keep], place[keep], low[keep], high[keep], h[keep]
                n = high - low + 1
                start = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
                doc = pa.array(row + at)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(doc), b.column(1).take(doc), pa.array(signed(h)),
                     *[pa.array(signed(span_hashes(x, low, high + LENGTH))) for x in (w.hash, _second(w.hash))],
                     pa.array(low - w.first[row], pa.int32()), pa.array(high - w.first[row], pa.int32()),
                     lists(signed(span_hashes(w.hash, start, start + LENGTH)), n, pa.int64())], names)

    return texts.select("d", "t", "text", "marked").mapInArrow(
        run, "d long, t long, h long, e1 long, e2 long, low int, high int, windows array<long>")


def copied_windows(found: DataFrame) -> DataFrame:
    """``d, t, a, b``: word ranges of windows that start earlier somewhere too."""
    classes = cut(found.groupBy("e1", "e2").agg(F.min(F.struct("d", "low")).alias("f"), F.first("h").alias("h"),
                                                F.first("windows").alias("windows")))
    several = classes.groupBy("h").count().filter("count > 1").select("h")
    windows = classes.join(several, "h").select("e1", "e2", "h", "f", F.posexplode("windows").alias("o", "w"))
    windows = cut(windows.select("e1", "e2", "h", "w", "o", F.struct(F.col("f.d").alias("d"), (F.col("f.low") + F.col("o")).alias("s")).alias("f")))
    earliest = cut(windows.groupBy("h", "w").agg(F.min("f").alias("e")))
    late = windows.join(earliest, ["h", "w"]).filter("f > e").groupBy("e1", "e2").agg(F.collect_set("o").alias("late"))
    heads = cut(classes.select("e1", "e2", "f").join(late, ["e1", "e2"], "left"))
    j = found.select("e1", "e2", "d", "t", "low", "high").join(heads, ["e1", "e2"])
    whole = F.struct(F.col("low").alias("a"), (F.col("high") + LENGTH).alias("b"))
    single = F.transform("late", lambda o: F.struct((F.col("low") + o).alias("a"), (F.col("low") + o + LENGTH).alias("b")))
    is_copy = F.struct("d", "low") > F.col("f")
    return j.filter(is_copy | F.col("late").isNotNull()).select(
        "d", "t", F.explode(F.when(is_copy, F.array(whole)).otherwise(single)).alias("r")).select("d", "t", "r.a", "r.b")


def _strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Join the copied windows of a text to maximal repeats and remove them."""
    for b in batches:
        removed, sha, spans = [], [], []
        for text, ranges in zip(b.column(2), b.column(3)):
            words = text.as_py().encode().split()
            merged: list[list[int]] = []
            for r in sorted((r["a"], r["b"]) for r in ranges.as_py()):
                if merged and r[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], r[1])
                else:
                    merged.append(list(r))
            kept, at = [], 0
            for lo, hi in merged:
                kept += words[at:lo]
                at = hi
            kept += words[at:]
            removed.append(len(words) - len(kept))
            sha.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            spans.append([{"start": lo, "end": hi} for lo, hi in merged])
        span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(removed, pa.int64()), pa.array(sha, pa.string()),
                                          pa.array(spans, pa.list_(span))], ["d", "t", "gone", "left_sha256", "spans"])


def repeats(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``d, t, n_words, n_removed, kept_sha256, spans``
    (the maximal repeats as word ranges)."""
    ship(docs.sparkSession)
    rows = cut(summaries(docs))
    heads = cut(rows.groupBy("c1", "c2").agg(F.min("d").alias("first_d")))  # written: a hot text can be split below
    rows = cut(rows.join(heads, ["c1", "c2"]))
    copy = (F.col("d") > F.col("first_d")) & (F.col("n_words") >= LENGTH)
    shared = cut(anchor_texts(docs).groupBy("h").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo != hi").select("h"))
    marked = anchor_places(docs).join(shared, "h").groupBy(F.col("d").alias("own_d")).agg(F.collect_set("p").alias("marked"))
    marked = cut(rows.filter(~copy).select("d", F.col("t").alias("own_t")).distinct().join(
        marked, F.col("d") == F.col("own_d")).select("own_d", "own_t", "marked"))
    # Bucketed by document: the ranges come back to the texts below without another shuffle of them.
    texts = cut_bucketed(_texts(docs).join(marked, (F.col("d") == F.col("own_d")) & (F.col("t") == F.col("own_t"))).select(
        "d", "t", "text", "marked").dropDuplicates(["d", "t"]), "d", "t")
    ranges = copied_windows(cut(extensions(texts))).distinct().groupBy(F.col("d").alias("own_d"), F.col("t").alias("own_t")).agg(
        F.collect_list(F.struct("a", "b")).alias("ranges"))
    done = texts.join(ranges, (F.col("d") == F.col("own_d")) & (F.col("t") == F.col("own_t"))).select(
        "d", "t", "text", "ranges").mapInArrow(
        _strip, "d long, t long, gone long, left_sha256 string, spans array<struct<start:int,end:int>>")
    span = "array<struct<start:int,end:int>>"
    everything = F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").cast("int").alias("end"))).cast(span)
    return rows.join(done, ["d", "t"], "left").select(
        "d", "t", "n_words", F.when(copy, F.col("n_words")).otherwise(F.coalesce("gone", F.lit(0))).alias("n_removed"),
        F.when(copy, F.lit(NOTHING)).otherwise(F.coalesce("left_sha256", "sha256")).alias("kept_sha256"),
        F.when(copy, everything).otherwise(F.coalesce("spans", F.array().cast(span))).alias("spans"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats(table(spark, sf_dir, "documents")).select(
        real_id("d").alias("doc_id"), F.col("n_words").cast("long").alias("n_words"),
        F.col("n_removed").cast("long").alias("n_removed"), "kept_sha256")


OP2_SQL = r"""
WITH w AS (
  SELECT doc_id, CASE WHEN text IS NULL THEN [] ELSE regexp_extract_all(text, '[^\x20\x09-\x0D]+') END AS words
  FROM documents),
win AS (
  SELECT doc_id, s, array_to_string(words[s : s + 19], ' ') AS k
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS s FROM w WHERE len(words) >= 20)),
late AS (
  SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS r FROM win) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS i FROM late),
word AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM w),
kept AS (
  SELECT word.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY word.i) AS text
  FROM word ANTI JOIN gone ON word.doc_id = gone.doc_id AND word.i = gone.i GROUP BY word.doc_id)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id
"""
