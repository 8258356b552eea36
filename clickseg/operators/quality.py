"""Data-quality reports (A5-A10, J2, O1) as long-form DataFrames.

The reference runs one action per column and per step (over 40 per input
file).  Here each report is one aggregate over the frame, reshaped to long form
with ``explode`` of a struct array; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickseg.functions import columns as C
from clickseg.operators import cleaning as CL
from clickseg.session import broadcast_if_small, kept
from clickseg.schemas import CRITICAL_COLUMNS, VALID_EVENT_TYPES

NUMERIC_TYPES = (T.DoubleType, T.LongType, T.IntegerType)


def _long(row_df: DataFrame, entries: list[Column]) -> DataFrame:
    """One wide row -> one row per struct in ``entries``."""
    return row_df.select(F.explode(F.array(*entries)).alias("_e")).select("_e.*")


def _completeness_rows(wide: DataFrame, cols: list[str]) -> DataFrame:
    """Long completeness rows from one row holding ``_n`` and ``_c<i>`` counts."""
    n = F.col("_n")
    entries = [F.struct(F.lit(c).alias("column_name"),
                        F.col(f"_c{i}").alias("non_null"),
                        (n - F.col(f"_c{i}")).alias("null_count"),
                        F.when(n > 0, C.percent(f"_c{i}", n)).otherwise(F.lit(0.0))
                         .alias("completeness_pct"))
               for i, c in enumerate(cols)]
    return _long(wide, entries)


def _counts(cols: list[str]) -> list[Column]:
    return [F.count(F.lit(1)).alias("_n"),
            *[F.count(F.col(f"`{c}`")).alias(f"_c{i}") for i, c in enumerate(cols)]]


def completeness(df: DataFrame) -> DataFrame:
    """Per column non-null count, null count and non-null % (0.0 on an empty frame)."""
    return _completeness_rows(df.agg(*_counts(df.columns)), df.columns)


def type_profile(df: DataFrame, column: str = "event_type") -> DataFrame:
    """Rows and non-null counts of every column, per value of ``column``: one aggregate.

    Persisted (it has one row per event type), so the completeness and the
    distribution reports derived from it read the data once.
    """
    return kept(df.groupBy(column).agg(*_counts(df.columns)))


def _distribution_from(grouped: DataFrame, column: str) -> DataFrame:
    total = grouped.agg(F.sum("_n")).scalar()  # one value: a scalar subquery
    return grouped.select(
        column, F.col("_n").alias("n_events"), C.percent("_n", total).alias("percent"))


def event_distribution(df: DataFrame, column: str = "event_type") -> DataFrame:
    """Rows and % of all rows per event type.

    The total is the sum of the per-type counts: a scalar subquery over the
    (persisted) grouped frame.
    """
    grouped = kept(df.groupBy(column).agg(F.count(F.lit(1)).alias("_n")))
    return _distribution_from(grouped, column)


def event_type_ranking(df: DataFrame, n: int = 20, column: str = "event_type") -> DataFrame:
    """O1: the ``n`` most frequent event types, by count descending then name."""
    return (event_distribution(df, column)
            .orderBy(F.col("n_events").desc(), F.col(column).asc_nulls_last())
            .limit(n))


def describe_numeric(df: DataFrame) -> DataFrame:
    """Count, mean, sample stddev, min, max of each double/bigint/int column (typed)."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)]
    if not cols:
        schema = "column_name string, count bigint, mean double, stddev double, min double, max double"
        return df.sparkSession.createDataFrame([], schema)
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(f"`{c}`")
        aggs += [F.count(x).alias(f"_n{i}"), F.avg(x).alias(f"_a{i}"),
                 F.stddev_samp(x).alias(f"_s{i}"),
                 F.min(x).cast("double").alias(f"_lo{i}"), F.max(x).cast("double").alias(f"_hi{i}")]
    wide = df.agg(*aggs)
    entries = [F.struct(F.lit(c).alias("column_name"), F.col(f"_n{i}").alias("count"),
                        F.col(f"_a{i}").alias("mean"), F.col(f"_s{i}").alias("stddev"),
                        F.col(f"_lo{i}").alias("min"), F.col(f"_hi{i}").alias("max"))
               for i, c in enumerate(cols)]
    return _long(wide, entries)


def quality_metrics(df: DataFrame, column: str = "event_type") -> DataFrame:
    """``{col}_completeness`` for every column and ``event_type_{t}_percent``.

    Both come from one grouped aggregate of the frame (``type_profile``).
    """
    if column not in df.columns:
        comp = completeness(df)
        return comp.select(F.concat(F.col("column_name"), F.lit("_completeness")).alias("metric"),
                           F.col("completeness_pct").alias("value"))
    cols = df.columns
    grouped = type_profile(df, column)
    totals = grouped.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c)
                           for c in ["_n"] + [f"_c{i}" for i in range(len(cols))]])
    comp = _completeness_rows(totals, cols).select(
        F.concat(F.col("column_name"), F.lit("_completeness")).alias("metric"),
        F.col("completeness_pct").alias("value"))
    dist = _distribution_from(grouped, column).select(
        F.concat(F.lit(f"{column}_"), F.coalesce(F.col(column), F.lit("None")),
                 F.lit("_percent")).alias("metric"),
        F.col("percent").alias("value"))
    return comp.unionByName(dist)


def metric_compare(final: DataFrame, initial: DataFrame) -> DataFrame:
    """Each final metric with its initial value (0 when absent)."""
    init = initial.select("metric", F.col("value").alias("_before"))
    return final.join(init, on="metric", how="left").select(
        "metric",
        F.coalesce(F.col("_before"), F.lit(0.0)).alias("before"),
        F.col("value").alias("after"))


def quality_comparison(before: DataFrame, after: DataFrame) -> DataFrame:
    """A10: before, after, absolute difference, relative change % (NULL when before is 0)."""
    joined = metric_compare(quality_metrics(after), quality_metrics(before))
    diff = F.col("after") - F.col("before")
    return joined.select(
        "metric", "before", "after", diff.alias("abs_diff"),
        F.when(F.col("before") != 0, diff / F.col("before") * 100).alias("relative_pct"))


def row_counts(raw: DataFrame, scope: str | None = "source_file", exact: bool = False) -> DataFrame:
    """A5: rows after each cleaning step and retention % of the initial rows.

    One aggregate over the raw rows carrying a survival flag per step (plus the
    per-scope quartile pass that the outlier step needs anyway), instead of a
    count per step.  Steps: initial, drop_invalid_rows, clean_event_types,
    remove_outliers, drop_duplicates, final.
    """
    crit = F.lit(True)
    for c in CRITICAL_COLUMNS:
        crit = crit & F.col(c).isNotNull()
    if isinstance(raw.schema["price"].dataType, (T.DoubleType, T.FloatType)):
        crit = crit & ~F.isnan("price")
    flagged = raw.withColumn("_p1", crit).withColumn(
        "_p2", F.col("_p1") & C.is_valid_event_type(C.normalized_event_type(), VALID_EVENT_TYPES))
    tidy = CL.fill_unknown(CL.split_categories(CL.clean_brands(CL.clean_prices(
        flagged.withColumn("event_type", C.normalized_event_type())))))
    if scope and scope not in raw.columns:
        scope = None
    bounds = CL.price_bounds(tidy.filter("_p2"), scope, exact)
    bounds = bounds.select(*([scope] if scope else []), "lower_bound", "upper_bound")
    if scope:
        joined = tidy.join(broadcast_if_small(bounds), on=scope, how="left")
    else:
        b = bounds.select(F.struct("lower_bound", "upper_bound")).scalar()  # one row
        joined = tidy.withColumns({"lower_bound": b["lower_bound"],
                                   "upper_bound": b["upper_bound"]})
    in_range = (F.col("price") >= F.col("lower_bound")) & (F.col("price") <= F.col("upper_bound"))
    joined = joined.withColumn("_p7", F.col("_p2") & F.coalesce(in_range, F.lit(False)))
    wide = joined.agg(
        F.count(F.lit(1)).alias("initial"),
        F.count_if("_p1").alias("drop_invalid_rows"),
        F.count_if("_p2").alias("clean_event_types"),
        F.count_if("_p7").alias("remove_outliers"),
        F.count_distinct(F.when(F.col("_p7"), F.struct(*CL.dedup_keys(raw, scope=scope)))).alias("drop_duplicates"))
    steps = ["initial", "drop_invalid_rows", "clean_event_types", "remove_outliers",
             "drop_duplicates"]
    entries = [F.struct(F.lit(i).alias("step_no"), F.lit(s).alias("step"),
                        F.col(s).alias("n_rows"),
                        C.percent(s, "initial").alias("retention_pct"))
               for i, s in enumerate(steps)]
    entries.append(F.struct(F.lit(len(steps)).alias("step_no"), F.lit("final").alias("step"),
                            F.col("drop_duplicates").alias("n_rows"),
                            C.percent("drop_duplicates", "initial").alias("retention_pct")))
    return _long(wide, entries)


def observed_clean_events(raw: DataFrame, salt: str, **kwargs) -> tuple[DataFrame, dict[str, Observation]]:
    """The cleaning chain with a row-count ``Observation`` after each step.

    The counts are filled in by whatever action consumes the returned frame
    (the write), with no extra pass over the data.  Like accumulators, they can
    over-count if a lost executor forces a finished stage to run again; the
    report that must be exact is ``row_counts`` (one aggregate).
    """
    obs = {name: Observation(name) for name in
           ["initial", "drop_invalid_rows", "clean_event_types", "remove_outliers",
            "drop_duplicates"]}

    def tap(df: DataFrame, name: str) -> DataFrame:
        return df.observe(obs[name], F.count(F.lit(1)).alias("rows"))

    scope = kwargs.get("scope", "source_file")
    df = tap(raw, "initial")
    df = tap(CL.drop_invalid_rows(df), "drop_invalid_rows")
    df = tap(CL.clean_event_types(df), "clean_event_types")
    df = CL.fill_unknown(CL.split_categories(CL.clean_brands(CL.clean_prices(df))))
    df = tap(CL.remove_outliers(df, scope=scope, exact=kwargs.get("exact", False),
                                bounds=kwargs.get("bounds")),
             "remove_outliers")
    df = tap(CL.drop_duplicates(df, tie_breaker=kwargs.get("tie_breaker"), scope=scope), "drop_duplicates")
    return CL.pseudonymize(df, salt), obs
