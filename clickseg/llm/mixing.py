"""Operator 7: mix sources to target weights along a time-varying curriculum.

Each source has a schedule: its share of the training stream at time t in [0, 1]
is its target times ``1 + slope * (2t - 1)``, which integrates to the target.
The documents of a source, in a fixed pseudo-random order and repeated as often
as the target asks, lie on the source's word axis; a copy that starts at word c
is read when the source's cumulative demand reaches c.  That position is the
closed-form inverse of the integrated schedule, and range-sorting all copies by
it gives the training order.

Offsets are sums of four levels: over the buckets of a source, over a bucket's segments (65,536
a source, by the order key's first 16 bits), over the keys and sizes of a segment, and over the
parts of the input that hold rows of one key and size.  A source with a third of all rows is spread over its
segments; ids that repeat, or are null, in a third of all rows are counted before any
running sum, and their rows are ranked inside their part of the input only.
The table of sources (one row each) is summed as a whole.

Defined results: a null text or one without words has size 0 and takes nothing;
a null source is a source of its own, last in the order; rows that repeat are
separate documents; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from clickseg.llm.common import WORD, cut, table

WEIGHTS = (5.0, 2.0, 1.0)
#: Share of the stream that a source gains (or loses) from the middle to the end.
SLOPES = (0.0, 0.5, -0.5)
TOTAL_SHARE = 1.5
MAX_EPOCHS = 2.0
BUCKETS = 256


def sizes(docs: DataFrame) -> DataFrame:
    """``(row, doc_id, source, size, okey)``: a number of the row, words of the whole text and the order key.
    The number is fixed only once the rows are written."""
    return docs.select(F.monotonically_increasing_id().alias("row"), docs["doc_id"].cast("long").alias("doc_id"), docs["source"].alias("source"),
                       F.coalesce(F.regexp_count(docs["text"], F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
                       F.md5(F.coalesce(docs["doc_id"].cast("string"), F.lit("")).cast("binary")).alias("okey"))


def targets(per_source: DataFrame, weights: tuple = WEIGHTS, slopes: tuple = SLOPES,
            total_share: float = TOTAL_SHARE, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """Word target per source from ``(source, source_size)``.

    Weights and slopes repeat over the sources in code point order, null last.
    Shares by weight stop at ``max_epochs`` times the source; what is above goes
    to the others by weight until none is above.  That fixed point is
    ``least(cap, level * weight)``: with the sources sorted by cap/weight, the
    level is the first (and largest) one at which the next source stays below its cap.
    """
    n = len(weights)
    pick = lambda xs, i: F.element_at(F.array(*[F.lit(float(x)) for x in xs]), (i % n + 1).cast("int"))
    ordered = W.orderBy(F.col("source").asc_nulls_last())
    s = per_source.withColumn("i", F.row_number().over(ordered) - 1)
    s = s.select("source", "source_size", pick(weights, F.col("i")).alias("weight"),
                 pick(slopes, F.col("i")).alias("slope"),
                 (F.col("source_size") * F.lit(float(max_epochs))).alias("cap"), "i")
    by_ratio = W.orderBy(F.col("cap") / F.col("weight"), "i")
    everything = W.partitionBy(F.lit(1))
    s = s.withColumns({
        "capped": F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)),
        "left": F.sum("weight").over(by_ratio.rowsBetween(W.currentRow, W.unboundedFollowing)),
        "total": F.sum("source_size").over(everything) * F.lit(float(total_share))})
    s = s.withColumn("level", (F.col("total") - F.col("capped")) / F.col("left"))
    fits = F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.col("level"))
    s = s.withColumn("level", F.max(fits).over(everything))
    return s.select("source", "source_size", "slope",
                    F.coalesce(F.least("cap", F.col("level") * F.col("weight")), F.col("cap")).alias("target"))


def plan(docs: DataFrame, buckets: int = BUCKETS, **mix) -> DataFrame:
    """``sizes`` plus ``source_size``, ``target``, ``slope`` and the word offset of the
    document in one pass over its source.

    A source's order is by bucket, order key, size and row.  Rows of one order key and size
    are as long as each other, so they are counted per part of the input first and a row's
    place among them follows from its part's start and its rank inside the part."""
    key = F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))  # a null source joins like any other
    rows = cut(sizes(docs).withColumns({
        "key": key, "bucket": F.conv(F.substring("okey", 1, 4), 16, 10).cast("int") % buckets,
        "segment": F.substring("okey", 1, 4), "part": F.shiftright("row", 33)}))
    tie = ["key", "okey", "size"]
    parts = cut(rows.groupBy(*tie, "part", "source", "bucket", "segment").agg(F.count(F.lit(1)).alias("n")))
    ties = parts.groupBy(*tie, "source", "bucket", "segment").agg((F.sum("n") * F.col("size")).alias("words"))
    ties = cut(ties)
    segments = cut(ties.groupBy("key", "source", "bucket", "segment").agg(F.sum("words").alias("words")))
    whole = segments.groupBy("key", "source", "bucket").agg(F.sum("words").alias("words"))
    goal = targets(whole.groupBy("source").agg(F.sum("words").alias("source_size")), **mix).withColumn("key", key)

    def before(what: str, within: list[str], order: list[str]) -> F.Column:
        window = W.partitionBy(*within).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
        return F.coalesce(F.sum(what).over(window), F.lit(0))

    # Four levels: buckets of a source, segments of a bucket, order keys of a segment, parts of the rows that tie.
    whole = whole.select("key", "bucket", before("words", ["key"], ["bucket"]).alias("in_source"))
    segments = segments.select("key", "bucket", "segment", before("words", ["key", "bucket"], ["segment"]).alias("in_bucket"))
    segments = segments.join(whole, ["key", "bucket"]).withColumn("in_source", F.col("in_source") + F.col("in_bucket"))
    ties = ties.select(*tie, "segment", before("words", ["key", "segment"], ["okey", "size"]).alias("in_segment"))
    starts = ties.join(segments.select("key", "segment", "in_source"), ["key", "segment"]).select(*tie, (F.col("in_source") + F.col("in_segment")).alias("start"))
    parts = parts.select(*tie, "part", before("n", tie, ["part"]).alias("earlier"))
    rank = F.row_number().over(W.partitionBy(*tie, "part").orderBy("row")) - 1
    rows = rows.withColumn("rank", rank).join(parts, [*tie, "part"]).join(starts, tie)
    return rows.join(goal.drop("source"), "key").select(
        "row", "doc_id", "source", "size", "source_size", "target", "slope",
        (F.col("start") + (F.col("earlier") + F.col("rank")) * F.col("size")).alias("at"))


def position(offset: F.Column, target: F.Column, slope: F.Column) -> F.Column:
    """Time at which the integrated schedule reaches ``offset`` words: the root in
    [0, 1] of ``(1 - slope) t + slope t^2 = offset / target``."""
    share = offset / target
    a = F.lit(1.0) - slope
    return F.when(slope == 0, share).otherwise(
        F.lit(2.0) * share / (a + F.sqrt(F.greatest(F.lit(0.0), a * a + F.lit(4.0) * slope * share))))


def copies(p: DataFrame) -> DataFrame:
    """One row per copy that the mix reads, from the rows of :func:`plan`."""
    p = p.filter("size > 0")
    p = p.withColumn("copy", F.explode(F.expr(
        "CASE WHEN at < floor(target) THEN sequence(0, CAST((floor(target) - at - 1) DIV source_size AS INT)) END")))
    start = F.col("at") + F.col("copy") * F.col("source_size")
    return p.select("row", "doc_id", "source", "size", "copy",
                    F.least(F.col("size"), F.floor("target") - start).alias("taken"),
                    position(start.cast("double"), F.col("target"), F.col("slope")).alias("position"))


def in_order(c: DataFrame) -> DataFrame:
    """The copies range-sorted by training position."""
    return c.orderBy("position", "source", "doc_id", "copy")


def curriculum(docs: DataFrame, **mix) -> DataFrame:
    """One row per copy that the mix reads: ``doc_id, source, size, copy, taken, position``.

    A source's last copy is cut where its demand ends, so the words taken per
    source equal its target (rounded down)."""
    return copies(plan(docs, **mix)).drop("row")


def training_order(docs: DataFrame, **mix) -> DataFrame:
    """The copies range-sorted by training position."""
    return in_order(curriculum(docs, **mix))


def dealt(docs: DataFrame, **mix) -> DataFrame:
    """Per document: its size, its source's size and target, the words that its copies in
    the written training order take, and the position of the first (null without one).
    Documents come in the order of their first copies, those that take nothing last."""
    p = cut(plan(docs, **mix))
    stream = cut(in_order(copies(p)))
    read = stream.groupBy("row").agg(F.sum("taken").alias("taken"), F.min("position").alias("first_position"))
    out = p.join(read, "row", "left").select(
        "row", "doc_id", "source", "size", "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "first_position")
    return out.orderBy(F.col("first_position").asc_nulls_last(), "source", "doc_id", "row").drop("row", "source")


def mixture(docs: DataFrame, **mix) -> DataFrame:
    """Per document: its size, its source's size and target, and the words taken, in
    closed form without the copies. A check of :func:`dealt`; no query returns it."""
    p = plan(docs, **mix)
    room = F.floor("target") - F.col("at")
    whole = F.greatest(F.lit(0), F.floor(room / F.col("source_size")))
    rest = F.greatest(F.lit(0), F.least(F.col("size"), room - whole * F.col("source_size")))
    return p.select("doc_id", "size", "source_size", "target",
                    F.when(F.col("size") == 0, F.lit(0)).otherwise(whole * F.col("size") + rest)
                    .cast("long").alias("taken"))


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken per document by the dealt copies, in training order."""
    return dealt(table(spark, sf_dir, "documents")).drop("first_position")


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, source,
         CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS okey
  FROM documents),
k AS (SELECT *, CAST('0x' || substr(okey, 1, 4) AS INTEGER) % 256 AS bucket FROM d),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i FROM s),
c AS (SELECT source, source_size, i, CASE i % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
             source_size * 2.0::DOUBLE AS cap FROM w),
l AS (SELECT *,
        coalesce(sum(cap) OVER (ORDER BY cap / weight, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
        sum(weight) OVER (ORDER BY cap / weight, i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest,
        CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE AS total FROM c),
v AS (SELECT max((total - capped) / rest) FILTER ((total - capped) / rest <= cap / weight) AS level FROM l),
g AS (SELECT source, source_size, coalesce(least(cap, level * weight), cap) AS target FROM c, v),
p AS (SELECT k.*, source_size, target,
        coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY bucket, okey, doc_id, size
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ofs
      FROM k JOIN g ON k.source IS NOT DISTINCT FROM g.source),
q AS (SELECT doc_id, size, source_size, target, ofs, CAST(floor(target) AS BIGINT) - ofs AS room FROM p),
r AS (SELECT *, CASE WHEN size = 0 THEN 0 ELSE greatest(0, CAST(floor(room / source_size) AS BIGINT)) END AS whole FROM q)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(CASE WHEN size = 0 THEN 0
                 ELSE whole * size + greatest(0, least(size, room - whole * source_size)) END AS BIGINT) AS taken
FROM r
"""
