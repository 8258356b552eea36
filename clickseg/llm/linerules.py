"""Operator 13: quality rules with cross-document line frequency.

Lines are normalised (ASCII letters lower-cased, digits made 0, words joined by one
space) and hashed.  A line counts once per distinct document of a host; exact copies
of a text on a host are one document, so copies alone make no line frequent.  Lines
that ``MIN_DOCS`` documents of the host hold, and at least ``SHARE`` of them, are
boilerplate and go.  A document is rejected if its own statistics fail (``base_failed``:
under ``MIN_WORDS`` words, or over half of the words in repeated 3-word windows), or
if removing the boilerplate leaves under ``MIN_WORDS`` words or under ``MIN_LEFT`` of
its words.

One pass over the texts writes the statistics and the distinct lines of every document;
only 64-bit keys and word counts are shuffled after that.  Copies and repeats collapse
in the partial aggregates; joins key on (host, line) or (host, text), and Spark splits
the rows of a hot line or a hot text, which the other side holds once.

Defined results: a null text has no words and fails; a null host is a host of its own;
repeated rows each get their row; a line is cut at ``\\n`` only and lines without a word
are never counted, removed or duplicates; an empty table gives no rows; further columns
pass through :func:`filter_documents` and are ignored elsewhere.  Memory of a task follows
the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickseg.llm.common import _BYTE, _U, blocks, cut, grams, lists, mix, ship, signed, span_hashes, table, tokens

MIN_WORDS = 50
MIN_DOCS = 10
SHARE = 0.001
MIN_LEFT = 0.3
SYMBOLS = b"#*$%&|<>"

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[48:58] = 48
_SYMBOL = np.isin(np.arange(256), np.frombuffer(SYMBOLS, np.uint8))


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values[first[i]:first[i + 1]]``."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[first[1:]] - total[first[:-1]]


def _own(x: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Hashes that are equal only within one row."""
    return mix(x ^ mix(row.astype(_U) + _U(1)))


def split_lines(data: np.ndarray, offsets: np.ndarray):
    """Words of a block and its lines that hold one: byte ``start``/``end``, ``row``, first and
    next word, hash of the normalised line."""
    w = tokens(data, offsets)
    cuts = np.unique(np.concatenate((np.flatnonzero(data == 10) + 1, offsets)))
    cuts = cuts[cuts <= len(data)]
    start, end = cuts[:-1], cuts[1:]
    if len(end):
        end = end - (data[end - 1] == 10)
    a, b = np.searchsorted(w.start, start), np.searchsorted(w.start, end)
    real = b > a
    start, end, a, b = start[real], end[real], a[real], b[real]
    folded = span_hashes(_BYTE[_FOLD[data]], w.start, w.end)
    return w, start, end, np.searchsorted(offsets, start, "right") - 1, a, b, span_hashes(folded, a, b)


def describe(data: np.ndarray, offsets: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """The five statistics of each row of a block; then the distinct normalised lines: row, hash, words."""
    rows = len(offsets) - 1
    w, start, end, row, a, b, line = split_lines(data, offsets)
    inside = np.zeros(len(data) + 1, np.int64)
    np.add.at(inside, w.start, 1)
    np.add.at(inside, w.end, -1)
    chars = (np.cumsum(inside)[:-1] > 0) & ((data & 0xC0) != 0x80)
    raw = np.unique(_own(span_hashes(_BYTE[data], start, end), row), return_index=True)[1]
    dup = np.bincount(row, minlength=rows) - np.bincount(row[raw], minlength=rows)
    covered = np.zeros(len(w.start) + 1, np.int64)
    if len(w.start) > 2:
        at = np.flatnonzero(w.doc[2:] == w.doc[:-2])
        _, back, n = np.unique(_own(grams(w.hash, 3)[at], w.doc[at]), return_inverse=True, return_counts=True)
        at = at[n[back] > 1]
        np.add.at(covered, at, 1)
        np.add.at(covered, at + 3, -1)
    repeated = np.cumsum(covered)[:-1] > 0
    stats = [np.diff(w.first), _sums(chars, offsets), _sums(_SYMBOL[data], offsets), dup, _sums(repeated, w.first)]
    _, one, back = np.unique(_own(line, row), return_index=True, return_inverse=True)
    words = np.bincount(back, weights=b - a, minlength=len(one)).astype(np.int64)
    order = np.argsort(row[one], kind="stable")
    one = one[order]
    return stats, row[one], line[one], words[order]


STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_DESCRIBED = "doc_id long, host long, text_key long, " + ", ".join(f"{c} long" for c in STATS) + ", lines array<long>, line_words array<long>"


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for x in batches:
        for at, data, offsets in blocks(x.column(3)):
            rows = len(offsets) - 1
            stats, row, line, words = describe(data, offsets)
            sizes = np.bincount(row, minlength=rows)
            yield pa.RecordBatch.from_arrays(
                [x.column(i).slice(at, rows) for i in range(3)] + [pa.array(s.astype(np.int64)) for s in stats]
                + [lists(signed(line), sizes, pa.int64()), lists(words, sizes, pa.int64())],
                ["doc_id", "host", "text_key", *STATS, "lines", "line_words"])


def _keys(docs: DataFrame, host: str) -> tuple[Column, Column]:
    """Keys of the host and of the text on it; a null host differs from an empty one."""
    h = docs[host].cast("string")
    key = F.xxhash64(F.coalesce(h, F.lit("")), h.isNull())
    return key, F.xxhash64(key, F.coalesce(docs["text"], F.lit("")), docs["text"].isNull())


def described(docs: DataFrame, host: str = "source") -> DataFrame:
    """Statistics and distinct lines per row, written to the shared folder."""
    ship(docs.sparkSession)
    h, t = _keys(docs, host)
    return cut(docs.select(docs["doc_id"].cast("long").alias("doc_id"), h.alias("host"), t.alias("text_key"),
                           docs["text"].cast("string").alias("text")).mapInArrow(_described, _DESCRIBED))


def boilerplate(stats: DataFrame, min_docs: int = MIN_DOCS, share: float = SHARE) -> DataFrame:
    """``text_key, line, words`` of the lines that go, of every document that holds one."""
    held = cut(stats.select("host", "text_key", F.explode(F.arrays_zip("lines", "line_words")).alias("l"))
               .groupBy("host", "text_key", F.col("l.lines").alias("line")).agg(F.max("l.line_words").alias("words")))
    hosts = stats.groupBy("host", "text_key").agg(F.lit(1).alias("one")).groupBy("host").agg(F.count("*").alias("docs"))
    often = (held.groupBy("host", "line").agg(F.count("*").alias("n")).filter(F.col("n") >= min_docs)
             .join(hosts, "host").filter(F.col("n") >= share * F.col("docs")).select("host", "line"))
    return held.join(cut(often), ["host", "line"]).select("text_key", "line", "words")


def verdicts(stats: DataFrame, gone: DataFrame, min_words: int = MIN_WORDS, min_left: float = MIN_LEFT) -> DataFrame:
    """The rows of ``stats`` with ``n_boilerplate_words``, ``base_failed`` and ``kept``."""
    lost = gone.groupBy("text_key").agg(F.sum("words").alias("lost"))
    n, left = F.col("n_words"), F.col("n_words") - F.col("n_boilerplate_words")
    failed = (n < min_words) | (100 * F.col("n_repeat_words") > 50 * n)
    return (stats.drop("lines", "line_words").join(lost, "text_key", "left")
            .withColumn("n_boilerplate_words", F.coalesce("lost", F.lit(0)).cast("long")).drop("lost")
            .withColumn("base_failed", failed)
            .withColumn("kept", ~failed & (left >= min_words) & (left >= min_left * n)))


def _cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for x in batches:
        out = []
        for text, gone in zip(x.column("__text").to_pylist(), x.column("__gone").to_pylist()):
            if gone:
                raw = np.frombuffer(text.encode(), np.uint8)
                _, start, end, _, _, _, line = split_lines(raw, np.array([0, len(raw)]))
                keep = np.ones(len(raw), bool)
                hit = np.isin(signed(line), gone)
                for s, e in zip(start[hit], end[hit]):
                    keep[s: e + 1] = False
                text = raw[keep].tobytes().decode()
            out.append(text)
        yield pa.RecordBatch.from_arrays([*x.columns[:-2], pa.array(out, pa.string())], x.schema.names[:-1])


def filter_documents(docs: DataFrame, host: str = "source") -> DataFrame:
    """The documents that stay, all columns as given, without their boilerplate lines."""
    stats = described(docs, host)
    gone = cut(boilerplate(stats))
    stay = verdicts(stats, gone).filter("kept").select(F.col("text_key").alias("__key")).distinct()
    lines = gone.groupBy(F.col("text_key").alias("__key")).agg(F.collect_list("line").alias("__gone"))
    rows = docs.withColumn("__key", _keys(docs, host)[1]).join(stay.join(lines, "__key", "left"), "__key")
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = docs.columns.index("text")
    plain = rows.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names)], F.col("__gone"),
                        F.col("text").cast("string").alias("__text"))
    schema = ", ".join([f"{n} {docs.schema[c].dataType.simpleString()}" for c, n in zip(docs.columns, names)] + ["__text string"])
    out = plain.mapInArrow(_cleaned, schema)
    return out.select(*[F.col("__text" if i == at else n).alias(c) for i, (c, n) in enumerate(zip(docs.columns, names))])


def line_rules(docs: DataFrame, host: str = "source", min_docs: int = MIN_DOCS, share: float = SHARE) -> DataFrame:
    """Statistics and verdict per row of ``docs``."""
    stats = described(docs, host)
    return verdicts(stats, boilerplate(stats, min_docs, share))


def op13_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", *STATS, "base_failed", "kept", "n_boilerplate_words")


OP13_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, chr(1)) AS host, coalesce(text, '') AS text FROM documents),
words AS (SELECT r, unnest(w) AS w, generate_subscripts(w, 1) AS i
          FROM (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM docs)),
win AS (SELECT r, i, w, lead(w) OVER (PARTITION BY r ORDER BY i) AS x, lead(w, 2) OVER (PARTITION BY r ORDER BY i) AS y FROM words),
often AS (SELECT r, w, x, y FROM win WHERE y IS NOT NULL GROUP BY ALL HAVING count(*) > 1),
rep AS (SELECT r, count(DISTINCT i + k) AS n FROM win JOIN often USING (r, w, x, y), (VALUES (0), (1), (2)) AS t(k) GROUP BY r),
lines AS (SELECT r, host, text, line, regexp_extract_all(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', 'abcdefghijklmnopqrstuvwxyz000000000'),
                 '[^\x20\x09-\x0D]+') AS w
          FROM (SELECT r, host, text, unnest(string_split(text, chr(10))) AS line FROM docs)),
full_lines AS (SELECT * FROM lines WHERE len(w) > 0),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM full_lines GROUP BY r),
freq AS (SELECT host, w FROM (SELECT host, w, count(DISTINCT text) AS n FROM full_lines GROUP BY host, w)
         JOIN (SELECT host, count(DISTINCT text) AS docs FROM docs GROUP BY host) USING (host) WHERE n >= 10 AND n >= 0.001 * docs),
lost AS (SELECT r, sum(len(w)) AS n FROM full_lines JOIN freq USING (host, w) GROUP BY r),
s AS (SELECT d.r, doc_id, CAST(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_words,
             CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
             CAST(coalesce(lost.n, 0) AS BIGINT) AS n_boilerplate_words
      FROM docs d LEFT JOIN dup USING (r) LEFT JOIN rep USING (r) LEFT JOIN lost USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_words - n_boilerplate_words >= 50
         AND n_words - n_boilerplate_words >= 0.3 * n_words AS kept, n_boilerplate_words
FROM s
"""
