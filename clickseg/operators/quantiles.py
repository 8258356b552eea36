"""Quantiles per scope: exact by distributed selection, or from stored mergeable sketches.

Exact: equal values are counted on the map side, the (scope, value) counts are
range-partitioned, each range's total per scope gives the running offset of its
first rank, and only the range that holds a wanted rank is looked through.  No
group holds the distinct values of a scope, so a scope with a third of all rows
is many balanced tasks.

Sketched: one KLL sketch per scope value, a few tens of kilobytes, stored and merged
for any coarser scope without reading the rows again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickseg.session import broadcast_if_small, materialize

QUARTILES = (0.25, 0.75)
#: KLL parameter and the rank error that its sketches stay within (99 % of sketches, both sides, n >> k).
SKETCH_K, SKETCH_ERROR = 4096, 0.002


def exact_quantiles(df: DataFrame, column: str, scope: str | None, ranks=QUARTILES) -> DataFrame:
    """``scope, q0, q1, ...``: the smallest value whose share of rows reaches each rank (as
    ``percentile_disc``).  Nulls of the column do not count; a null scope is a scope of its
    own; without ``scope`` one row, of nulls for an empty table."""
    values = df.select((F.col(scope) if scope else F.lit(0)).alias("s"), F.col(column).alias("x")).filter("x IS NOT NULL")
    counts = materialize(values.groupBy("s", "x").agg(F.count("*").alias("n")).repartitionByRange("s", "x")
                         .withColumn("range", F.spark_partition_id()))
    # One row per range and scope: scopes are contiguous, so at most ranges + scopes rows.
    totals = counts.groupBy("s", "range").agg(F.sum("n").alias("held"))
    upto = Window.partitionBy("s").orderBy("range")
    totals = totals.withColumn("before", F.sum("held").over(upto) - F.col("held")).withColumn(
        "rows", F.sum("held").over(Window.partitionBy("s")))
    wanted = F.array(*[F.struct(F.lit(i).alias("i"), F.greatest(F.lit(1), F.ceil(F.lit(r) * F.col("rows"))).alias("rank"))
                       for i, r in enumerate(ranks)])
    targets = totals.withColumn("w", F.explode(wanted)).filter(
        (F.col("w.rank") > F.col("before")) & (F.col("w.rank") <= F.col("before") + F.col("held"))).select(
        F.col("s").alias("ts"), F.col("range").alias("tr"), "w.i", (F.col("w.rank") - F.col("before")).alias("rank"))
    targets = broadcast_if_small(targets)  # one row per scope and rank
    here = F.col("s").eqNullSafe(F.col("ts")) & (F.col("range") == F.col("tr"))
    looked = counts.join(targets, here, "left_semi")
    running = looked.withColumn("upto", F.sum("n").over(Window.partitionBy("s", "range").orderBy("x")))
    found = running.join(targets, here).filter(F.col("upto") >= F.col("rank"))
    picked = [F.min(F.when(F.col("i") == i, F.col("x"))).alias(f"q{i}") for i in range(len(ranks))]
    if not scope:
        return found.agg(*picked)
    return found.groupBy(F.col("s").alias(scope)).agg(*picked)


def sketches(df: DataFrame, column: str, scope: str | None, k: int = SKETCH_K) -> DataFrame:
    """``scope, n_values, sketch``: one mergeable sketch per scope value (one row without ``scope``)."""
    values = df.select(*([scope] if scope else []), F.col(column).cast("double").alias("_x")).filter("_x IS NOT NULL")
    grouped = values.groupBy(scope) if scope else values
    return grouped.agg(F.count("*").alias("n_values"), F.kll_sketch_agg_double("_x", k).alias("sketch"))


def merged_sketches(stored: DataFrame, scope: str | None, k: int = SKETCH_K, fan: int = 64) -> DataFrame:
    """Sketches of a coarser scope from stored ones, merged in two levels of at most about ``fan`` a task
    for many scope values; no rows are read."""
    keys = [scope] if scope else []
    deal = F.pmod(F.xxhash64("sketch"), F.lit(fan))
    parts = stored.groupBy(*keys, deal.alias("_p")).agg(F.sum("n_values").alias("n_values"), F.kll_merge_agg_double("sketch", k).alias("sketch"))
    grouped = parts.groupBy(*keys) if keys else parts
    return grouped.agg(F.sum("n_values").alias("n_values"), F.kll_merge_agg_double("sketch", k).alias("sketch"))


def sketch_quantiles(stored: DataFrame, scope: str | None, ranks=QUARTILES) -> DataFrame:
    """``scope, q0, q1, ...`` from sketches with one row per scope value; null where no value was seen."""
    picked = [F.when(F.col("n_values") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(float(r)))).alias(f"q{i}")
              for i, r in enumerate(ranks)]
    return stored.select(*([scope] if scope else []), *picked)
