"""Operator 8 [native]: repeated runs of lines, found by a distributed suffix array.

A document is the sequence of its non-blank lines; a line's ID is a 128-bit hash
of it.  Prefix doubling sorts the suffixes of all sequences: ranks of the
prefixes of 2^h lines come from sorting pairs of ranks of 2^(h-1) lines (a range
sort whose row numbers keep the order).  Suffixes whose prefix is unique are
finished and drop out, so each round works on repeated runs only and the last
round is the one in which nothing repeats.  A class of equal ranks is an
interval of the suffix array whose longest common prefix has 2^h lines or more;
its earliest suffix (smallest document, then line) is the first copy and the
others are later copies.  A suffix reaches as far as the longest such prefix
with an earlier copy, and the reaches of a document's suffixes joined are its
maximal repeated runs.  A line that lies in a repeated run of at least
``MIN_LINES`` lines, or that alone holds ``MIN_WORDS`` words and repeats, is
deleted.

Only DataFrame operations; every shuffle keys on a line class, a pair of ranks
or a document, counts combine on the map side, and a class with a third of all
lines is split by Spark's skew join.

Defined results: blank lines take no part and stay; null texts stay null, have
no line and lose none; lines are compared as they are, to the last character;
rows that repeat id and text are one document and both lose the same lines; a
null id sorts first; an empty table gives no rows; further columns are kept by
:func:`drop_repeated_lines` and ignored by the query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from clickseg.llm.common import cut, keyed, of_documents, table

MIN_LINES = 2
MIN_WORDS = 10
#: A line with a word (a character outside white space) is not blank.
FILLED = r"[^\x20\x09-\x0D]"
DOC = ["d", "t"]


def lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``d, t, i, ln, long, ra, rb``: index among the non-blank lines, line number,
    whether it has ``min_words`` words, and the two halves of its ID."""
    rows = keyed(docs).select(*DOC, F.posexplode(F.filter(F.transform(
        F.split("text", "\n"), lambda x, j: F.struct(j.alias("ln"), x.alias("line"))),
        lambda s: s["line"].rlike(FILLED))).alias("i", "s"))
    return rows.select(*DOC, "i", F.col("s.ln").alias("ln"),
                       (F.regexp_count(F.col("s.line"), F.lit(FILLED + "+")) >= min_words).alias("long"),
                       F.xxhash64("s.line").alias("ra"), F.xxhash64(F.lit(1), F.col("s.line")).alias("rb"))


def ranked(pairs: DataFrame) -> DataFrame:
    """Replace the pair ``(ra, rb)`` by its rank ``r``; rows with a unique pair drop out."""
    repeated = pairs.groupBy("ra", "rb").count().filter("count > 1").select("ra", "rb")
    names = repeated.orderBy("ra", "rb").withColumn("r", F.monotonically_increasing_id())
    return pairs.join(names, ["ra", "rb"]).drop("ra", "rb")


def suffix_classes(all_lines: DataFrame) -> DataFrame:
    """``d, t, i, h, r``: for every round h, the rank class of the 2^h lines from line i on,
    where that class has more than one suffix."""
    # Rows that repeat a whole document would pair with each other below: distinct.
    level = cut(ranked(all_lines.select(*DOC, "i", "ra", "rb")).distinct())
    h, found = 0, []
    while not level.isEmpty():
        found.append(level.withColumn("h", F.lit(h)))
        step = 1 << h
        at = W.partitionBy(*DOC).orderBy("i").rangeBetween(step, step)
        pairs = level.withColumn("rb", F.first("r").over(at)).filter("rb IS NOT NULL")
        level = cut(ranked(pairs.withColumnRenamed("r", "ra")))
        h += 1
    out = level.withColumn("h", F.lit(h))
    for x in found:
        out = out.unionByName(x)
    return out


def repeated_lines(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """``d, t, runs, n_removed, longest``: per document with deletions, the line number
    intervals of its deleted runs."""
    all_lines = cut(lines(docs, min_words))
    classes = suffix_classes(all_lines)
    # Written out, so that the join below is a plain one whose large classes Spark can split.
    first = cut(classes.groupBy("h", "r").agg(F.min(F.struct(*DOC, "i")).alias("f")))
    later = classes.join(first, ["h", "r"]).filter(F.struct(*DOC, "i") != F.col("f"))
    reach = later.groupBy(*DOC, "i").agg(F.max("h").alias("h"))
    here = all_lines.select(*DOC, "i", "ln", "long").distinct()
    reach = reach.join(here, [*DOC, "i"]).withColumn(
        "upto", F.col("i") + F.expr("shiftleft(1, h)"))
    ordered = W.partitionBy(*DOC).orderBy("i")
    covered = reach.withColumn("upto", F.max("upto").over(ordered.rowsBetween(W.unboundedPreceding, 0)))
    covered = covered.withColumn("opens", (F.coalesce(F.lag("upto").over(ordered), F.lit(0)) <= F.col("i")).cast("int"))
    covered = covered.withColumn("run", F.sum("opens").over(ordered.rowsBetween(W.unboundedPreceding, 0)))
    size = F.count("*").over(W.partitionBy(*DOC, "run"))
    gone = covered.withColumn("size", size).filter((F.col("size") >= min_lines) | F.col("long"))
    pieces = gone.withColumn("piece", F.col("i") - F.row_number().over(W.partitionBy(*DOC).orderBy("i"))).groupBy(
        *DOC, "piece").agg(F.min("ln").alias("a"), F.max("ln").alias("b"), F.count("*").alias("n"))
    return pieces.groupBy(*DOC).agg(F.collect_list(F.struct("a", "b")).alias("runs"),
                                    F.sum("n").alias("n_removed"), F.max("n").alias("longest"))


def without_runs(text: str = "text", runs: str = "runs") -> F.Column:
    """The text without the non-blank lines inside the runs."""
    kept = F.filter(F.split(text, "\n"), lambda x, j: ~(
        F.exists(runs, lambda r: (j >= r["a"]) & (j <= r["b"])) & x.rlike(FILLED)))
    return F.when(F.col(runs).isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))


def drop_repeated_lines(docs: DataFrame, **limits) -> DataFrame:
    """``docs`` with the text replaced and ``__n_removed`` and ``__n_runs`` added."""
    j = of_documents(docs, repeated_lines(docs, **limits), "left")
    text = without_runs("text", "__runs")
    return j.select(*[(text if c == "text" else F.col(c)).alias(c) for c in docs.columns],
                    F.coalesce("__n_removed", F.lit(0)).cast("long").alias("__n_removed"),
                    F.coalesce(F.size("__runs"), F.lit(0)).cast("long").alias("__n_runs"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = drop_repeated_lines(docs)
    return out.select("doc_id", F.col("__n_removed").alias("n_removed"), F.col("__n_runs").alias("n_runs"), F.sha2(F.col("text"), 256).alias("kept_sha256"))


OP8_SQL = r"""
WITH raw AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS ln
  FROM documents),
filled AS (
  SELECT doc_id, ln, line, row_number() OVER (PARTITION BY doc_id ORDER BY ln) - 1 AS i,
         len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) >= 10 AS long
  FROM raw WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
pairs AS (
  SELECT doc_id, i, ln, line, long, lead(line) OVER (PARTITION BY doc_id ORDER BY i) AS next FROM filled),
one AS (
  SELECT *, row_number() OVER (PARTITION BY line ORDER BY doc_id, i) > 1 AS line_later,
         next IS NOT NULL AND row_number() OVER (PARTITION BY line, next ORDER BY doc_id, i) > 1 AS pair_later
  FROM pairs),
marked AS (
  SELECT doc_id, i, ln,
         (line_later AND long) OR pair_later
         OR coalesce(lag(pair_later) OVER (PARTITION BY doc_id ORDER BY i), false) AS gone
  FROM one),
runs AS (
  SELECT doc_id, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS piece FROM marked WHERE gone),
counted AS (SELECT doc_id, count(*) AS n_removed, count(DISTINCT piece) AS n_runs FROM runs GROUP BY doc_id),
kept AS (
  SELECT raw.doc_id, string_agg(line, chr(10) ORDER BY raw.ln) AS text
  FROM raw LEFT JOIN marked m ON raw.doc_id = m.doc_id AND raw.ln = m.ln
  WHERE NOT coalesce(m.gone, false) GROUP BY raw.doc_id)
SELECT d.doc_id, coalesce(c.n_removed, 0) AS n_removed, coalesce(c.n_runs, 0) AS n_runs,
       CASE WHEN d.text IS NOT NULL THEN sha256(coalesce(k.text, '')) END AS kept_sha256
FROM documents d LEFT JOIN counted c ON d.doc_id = c.doc_id LEFT JOIN kept k ON d.doc_id = k.doc_id
"""
