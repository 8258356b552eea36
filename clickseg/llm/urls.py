"""Operator 3: URL filter by host and path rules, then by a character model ratio.

A rule ``host/path`` fits its host and all subdomains if the URL's path starts
with the rule's; the longest fitting rule decides.  The URLs that rules decide
teach two character models, one of accepted and one of rejected URLs: Markov
models of variable order up to ``ORDER``, each order smoothed by the next shorter
one, so a context counts as far as it has been seen.  URLs without a rule are
judged by the length-normalised difference of the two log-likelihoods against a
threshold calibrated on a held part of the rule-decided URLs, by models that the
others taught; the models that judge are taught by all of them.

Counts are exact and gathered from all pages into a Spark table of the distinct
windows (a character with up to ``ORDER`` before it, packed into a long), which
grows with the input; nothing of it is collected or broadcast.  Each order's
probabilities join those of the next shorter one: a window has at most 256
extensions on either side, so no key of these joins is hot.  URLs are dealt into
blocks of ``BLOCK_ROWS``; a block gets each of its windows once, however often its
URLs hold it.

Defined results: a null URL or one without ``://`` has an empty host and path, no
rule and the score 0; without URLs of both classes the threshold is 0 and scores
are 0 (``allow``); where either part lacks a class the threshold is 0; repeated rows count and are judged each; an empty table gives
no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from clickseg.llm.common import blocks, cut, mix, ship, span_hashes, table

#: ``(verdict, rule)``: the rules of the production filter.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"),
         ("block", "com/de/"))
ORDER = 4
#: Of the counters of :func:`_count`, which no query uses.
SLOT_BITS = 17
SMOOTH = 4.0
#: One rule-decided URL in so many calibrates instead of teaching.
TAIL_SHARE = 5
BINS, RANGE = 2000, 5.0
BLOCK_ROWS = 4096
_SLOTS = 1 << SLOT_BITS


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (ASCII letters lower-cased) and path of a URL; empty where there is none."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest fitting rule, as ``struct(rule, verdict)``; null without one."""
    def fits(rule: str) -> Column:
        name, _, tail = rule.partition("/")
        return ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{tail}")

    ordered = sorted(rules, key=lambda r: (-len(r[1]), r[1]))
    return F.coalesce(*[F.when(fits(r), F.struct(F.lit(r).alias("rule"), F.lit(v).alias("verdict"))) for v, r in ordered],
                      F.lit(None).cast("struct<rule:string,verdict:string>"))


def judged(pages: DataFrame, rules=RULES) -> DataFrame:
    """``page_id, url, host, path, rule, rule_verdict`` of every row."""
    host, path = host_path(pages["url"])
    p = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].alias("url"),
                     host.alias("host"), path.alias("path"))
    return p.withColumn("r", rule_of(F.col("host"), F.col("path"), rules)).select(
        "page_id", "url", "host", "path", F.col("r.rule").alias("rule"), F.col("r.verdict").alias("rule_verdict"))


def _modelled(url: Column) -> Column:
    """What the character models read: all after the scheme."""
    return F.coalesce(F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))), F.lit(""))


def _contexts(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per order: the counter of each character's context, and of the context with the character."""
    values = mix(data.astype(np.uint64) + np.uint64(1))
    at = np.arange(len(data))
    begin = np.repeat(offsets[:-1], np.diff(offsets))
    for k in range(ORDER + 1):
        start = np.maximum(at - k, begin)
        yield tuple((span_hashes(values, start, end) % np.uint64(_SLOTS)).astype(np.int64) + k * _SLOTS
                    for end in (at, at + 1))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts in hashed counters of fixed size: with :func:`log_ratio`, a check of the exact models on small inputs."""
    total = np.zeros((4, (ORDER + 1) * _SLOTS), np.int64)  # (context, with character) x (accepted, rejected)
    for b in batches:
        accepted = np.asarray(b.column(0).to_pylist(), bool)
        for base, data, offsets in blocks(b.column(1)):
            ok = np.repeat(accepted[base: base + len(offsets) - 1], np.diff(offsets))
            for slots in _contexts(data, offsets):
                for i, s in enumerate(slots):
                    np.add.at(total[i], s[ok], 1)
                    np.add.at(total[2 + i], s[~ok], 1)
    slot = np.flatnonzero(total.any(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(slot), *[pa.array(x[slot]) for x in total]], ["slot", "a0", "a1", "r0", "r1"])


def log_ratio(model: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Difference of log-likelihoods per character of each URL (0 for an empty one)."""
    p = np.full((2, len(data)), 1 / 256)
    for context, full in _contexts(data, offsets):
        for c in (0, 1):
            p[c] = (model[2 * c + 1][full] + SMOOTH * p[c]) / (model[2 * c][context] + SMOOTH)
    total = np.concatenate(([0.0], np.cumsum(np.log(p[0]) - np.log(p[1]))))
    return (total[offsets[1:]] - total[offsets[:-1]]) / np.maximum(np.diff(offsets), 1)


# --- exact counts ----------------------------------------------------------------

_BITS = 8 * (ORDER + 1)  # bytes of a window; its length stands above them
COUNTS = ("a", "r", "ta", "tr")


def windows(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Each character with up to ``ORDER`` before it, packed with its length into a long."""
    back = np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))
    out = np.minimum(back + 1, ORDER + 1) << _BITS
    for k in range(ORDER + 1):
        at = np.flatnonzero(back >= k)
        out[at] |= data[at - k].astype(np.int64) << (8 * k)
    return out


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``block, role, modelled`` to the distinct windows per block with their counts as accepted and as
    rejected, in all URLs (``a, r``) and in those not held (``ta, tr``)."""
    for b in batches:
        block, place = np.unique(b.column(0).to_numpy(), return_inverse=True)
        role = b.column(1).to_numpy()
        for base, data, offsets in blocks(b.column(2)):
            row = base + np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
            key, at = np.unique(place[row] << (_BITS + 3) | windows(data, offsets), return_inverse=True)
            counts = [np.bincount(at[np.isin(role[row], k)], minlength=len(key)) for k in ((1, 3), (2, 4), 1, 2)]
            yield pa.RecordBatch.from_arrays([pa.array(block[key >> (_BITS + 3)]), pa.array(key & ((1 << (_BITS + 3)) - 1)),
                                              *[pa.array(c.astype(np.int64)) for c in counts]], ["block", "w", *COUNTS])


def _suffix(w: Column, n: int) -> Column:
    """The last ``n`` characters of a packed window (all of a shorter one)."""
    size = F.least(F.shiftright(w, _BITS), F.lit(n).cast("long"))
    full = F.element_at(F.array(*[F.lit((1 << 8 * k) - 1).cast("long") for k in range(ORDER + 2)]), (size + 1).cast("int"))
    return F.shiftleft(size, _BITS).bitwiseOR(w.bitwiseAND(full))


def _context(w: Column) -> Column:
    """A packed window without its last character."""
    return F.shiftleft(F.shiftright(w, _BITS) - 1, _BITS).bitwiseOR(F.shiftright(w.bitwiseAND(F.lit((1 << _BITS) - 1)), 8))


def window_ratios(counts: DataFrame) -> DataFrame:
    """``w, f, tf``: difference of the log-probabilities of each window's last character, from ``w`` and
    ``COUNTS``; ``tf`` of the models without the held URLs."""
    below = None
    for k in range(ORDER + 1):
        u = counts if k == ORDER else counts.groupBy(_suffix(F.col("w"), k + 1).alias("w")).agg(
            *[F.sum(c).alias(c) for c in COUNTS])
        ctx = W.partitionBy(_context(F.col("w")))
        u = u.withColumns({f"c{c}": F.sum(c).over(ctx) for c in COUNTS})
        if below is None:
            u = u.withColumns({f"p{c}": F.lit(1 / 256) for c in COUNTS})
        else:
            u = u.withColumn("s", _suffix(F.col("w"), k)).join(below, "s")
        level = u.select("w", *[((F.col(c) + SMOOTH * F.col(f"p{c}")) / (F.col(f"c{c}") + SMOOTH)).alias(f"p{c}") for c in COUNTS])
        below = level.withColumnRenamed("w", "s")
    return level.select("w", (F.log("pa") - F.log("pr")).alias("f"), (F.log("pta") - F.log("ptr")).alias("tf"))


def scored(rows: DataFrame) -> DataFrame:
    """``rows`` plus ``score`` and ``taught_score``: the models are taught by the ``role`` 1 (accepted), 2 (rejected)
    and, for ``score``, the held 3 and 4; ``block`` deals the rows."""
    found = cut(rows.select("block", "role", _modelled(F.col("url")).alias("modelled")).mapInArrow(
        _gathered, "block long, w long, a long, r long, ta long, tr long"))
    ratios = window_ratios(cut(found.groupBy("w").agg(*[F.sum(c).alias(c) for c in COUNTS])))
    known = found.select("block", "w").join(ratios, "w").select("block", "w", "f", "tf")

    def judge(left: pa.Table, right: pa.Table) -> pa.Table:
        w, f = right.column("w").to_numpy(), np.stack([right.column(c).to_numpy() for c in ("f", "tf")], axis=1)
        order = np.argsort(w, kind="stable")
        w, f = w[order], f[order]
        score = [np.zeros((0, 2))]
        for _, data, offsets in blocks(left.column("modelled")):
            each = f[np.searchsorted(w, windows(data, offsets))] if len(data) else np.zeros((0, 2))
            total = np.concatenate((np.zeros((1, 2)), np.cumsum(each, axis=0)))
            score.append((total[offsets[1:]] - total[offsets[:-1]]) / np.maximum(np.diff(offsets), 1)[:, None])
        score = np.concatenate(score)
        return left.drop_columns(["modelled"]).append_column("score", pa.array(score[:, 0])).append_column(
            "taught_score", pa.array(score[:, 1]))

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.withColumn("modelled", _modelled(F.col("url"))).groupBy("block").cogroup(
        known.groupBy("block")).applyInArrow(judge, f"{kinds}, score double, taught_score double")


def threshold(held: DataFrame) -> float:
    """The ``taught_score`` that best parts the ``ok`` rows from the others; 0 without both."""
    edge = F.least(F.greatest(F.floor((F.col("taught_score") + RANGE) * (BINS / (2 * RANGE))), F.lit(0)), F.lit(BINS - 1))
    n = np.zeros((2, BINS))
    for r in held.groupBy(edge.cast("int").alias("bin"), "ok").count().collect():
        n[int(r["ok"]), r["bin"]] += r["count"]
    if not n.sum(axis=1).all():
        return 0.0
    # Accepted at or above an edge plus rejected below it; the middle of the best edges.
    share = n / n.sum(axis=1, keepdims=True)
    good = np.concatenate((share[1][::-1].cumsum()[::-1], [0.0])) + np.concatenate(([0.0], share[0].cumsum()))
    best = np.flatnonzero(good >= good.max() - 1e-12)
    return float((best[0] + best[-1]) / 2 * (2 * RANGE / BINS) - RANGE)


def url_filter(pages: DataFrame, rules=RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` of every row."""
    ship(pages.sparkSession)
    tail = F.pmod(F.xxhash64("url"), F.lit(TAIL_SHARE)) == 0
    taught = F.when(F.col("rule_verdict") == "allow", 1).when(F.col("rule_verdict").isNotNull(), 2).otherwise(0)
    p = cut(judged(pages, rules).withColumns({
        "role": F.when(tail & (taught > 0), taught + 2).otherwise(taught).cast("int"),
        "block": F.expr(f"monotonically_increasing_id() DIV {BLOCK_ROWS}")}))
    roles = {r[0] for r in p.select("role").distinct().collect()}
    if not roles & {1, 3} or not roles & {2, 4}:
        s, least = p.withColumn("score", F.lit(0.0)), 0.0
    else:
        s = cut(scored(p))
        held = s.filter("role > 2").withColumn("ok", F.col("role") == 3)
        least = threshold(held) if {1, 2} <= roles else 0.0
    own = F.when(F.col("score") >= least, "allow").otherwise("block")
    return s.select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", own).alias("verdict"), "score")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(table(spark, sf_dir, "pages").select("page_id", "url"))
