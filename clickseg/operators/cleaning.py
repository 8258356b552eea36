"""Cleaning operators (P1-P8, P10, D1): pure ``DataFrame -> DataFrame`` steps.

Each step is lazy; the whole chain compiles to one scan, one aggregate for the
price quartiles, one broadcast join of the per-file bounds and one aggregate for
deduplication.  No step runs a Spark job except ``remove_outliers``, which
materializes its small bounds table to check its size before broadcasting it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickseg.functions import columns as C
from clickseg.operators import quantiles as QT
from clickseg.schemas import CRITICAL_COLUMNS, DEDUP_KEYS, UNKNOWN_FILL, VALID_EVENT_TYPES
from clickseg.session import broadcast_if_small


def drop_invalid_rows(df: DataFrame, critical: list[str] = CRITICAL_COLUMNS) -> DataFrame:
    """Drop a row when any critical column is NULL (or NaN)."""
    return df.dropna(how="any", subset=critical)


def clean_event_types(df: DataFrame, valid: list[str] = VALID_EVENT_TYPES) -> DataFrame:
    """``lower(trim())``, NULL -> '', keep only the valid types."""
    return (df.withColumn("event_type", C.normalized_event_type("event_type"))
              .filter(C.is_valid_event_type("event_type", valid)))


def clean_prices(df: DataFrame) -> DataFrame:
    """Price as double, NULL or <= 0 -> 0.0."""
    return df.withColumn("price", C.clean_price("price"))


def clean_brands(df: DataFrame) -> DataFrame:
    """``trim(lower())``, NULL -> 'unknown' (a blank brand stays '')."""
    return df.withColumn("brand", C.clean_brand("brand"))


def split_categories(df: DataFrame, levels: int = 3) -> DataFrame:
    """P5: dotted ``category_code`` -> ``category_level_1..levels``, missing -> 'unknown'."""
    return df.withColumns({f"category_level_{i}": C.category_level("category_code", i)
                           for i in range(1, levels + 1)})


def fill_unknown(df: DataFrame, columns: list[str] = UNKNOWN_FILL,
                 value: str = "unknown") -> DataFrame:
    """NULL -> 'unknown' in the listed columns that exist."""
    present = [c for c in columns if c in df.columns]
    return df.fillna({c: value for c in present}) if present else df


def priced(df: DataFrame) -> DataFrame:
    """The rows whose price counts for the quartiles."""
    return df.filter(F.col("price").isNotNull() & (F.col("price") >= 0))


def price_bounds(df: DataFrame, scope: str | None = "source_file", exact: bool = False,
                 whisker: float = 1.5) -> DataFrame:
    """Q1, Q3 and the IQR fences of ``price`` per ``scope`` (or overall).

    Exact mode selects the ranks on range-partitioned counts; the default takes
    them from one sketch per scope value (see ``operators.quantiles``).
    """
    if exact:
        return fences(QT.exact_quantiles(priced(df), "price", scope), scope, whisker)
    return bounds_of_sketches(price_sketches(df, scope), scope, whisker)


def price_sketches(df: DataFrame, scope: str | None = "source_file") -> DataFrame:
    """One mergeable price sketch per scope value; stored, they give bounds of any scope."""
    return QT.sketches(priced(df), "price", scope)


def bounds_of_sketches(stored: DataFrame, scope: str | None = "source_file", whisker: float = 1.5,
                       merge: bool = False) -> DataFrame:
    """:func:`price_bounds` from sketches; ``merge`` for sketches finer than ``scope``."""
    stored = QT.merged_sketches(stored, scope) if merge else stored
    return fences(QT.sketch_quantiles(stored, scope), scope, whisker)


def fences(quartiles: DataFrame, scope: str | None, whisker: float = 1.5) -> DataFrame:
    """``scope, q1, q3`` and the IQR fences of quartiles ``q0, q1``."""
    named = quartiles.select(*([scope] if scope else []), F.col("q0").alias("q1"), F.col("q1").alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    return named.select(
        *([scope] if scope else []), "q1", "q3",
        (F.col("q1") - F.lit(whisker) * iqr).alias("lower_bound"),
        (F.col("q3") + F.lit(whisker) * iqr).alias("upper_bound"))


def clean_before_outliers(df: DataFrame) -> DataFrame:
    """The row-local part of the chain (one narrow stage)."""
    return (df.transform(drop_invalid_rows).transform(clean_event_types)
              .transform(clean_prices).transform(clean_brands)
              .transform(split_categories).transform(fill_unknown))


def remove_outliers(df: DataFrame, scope: str | None = "source_file", exact: bool = False,
                    whisker: float = 1.5, max_broadcast_rows: int = 100_000,
                    bounds: DataFrame | None = None) -> DataFrame:
    """Keep prices inside ``[Q1 - 1.5 IQR, Q3 + 1.5 IQR]`` of their scope.

    The bounds table has one row per scope value (per input file by default);
    it is broadcast only after its row count is checked, else it is joined by
    shuffle.  ``bounds`` takes a table of bounds computed before.
    """
    if scope and scope not in df.columns:
        scope = None
    if bounds is None:
        bounds = price_bounds(df, scope, exact, whisker)
    valid = priced(df)
    in_range = (F.col("price") >= F.col("lower_bound")) & (F.col("price") <= F.col("upper_bound"))
    if scope:
        small = broadcast_if_small(bounds.select(scope, "lower_bound", "upper_bound"),
                                   max_broadcast_rows)
        joined = valid.join(small, on=scope, how="inner")
    else:
        # One row by construction (a global aggregate): a scalar subquery, no join.
        b = bounds.select(F.struct("lower_bound", "upper_bound")).scalar()
        joined = valid.withColumns({"lower_bound": b["lower_bound"],
                                    "upper_bound": b["upper_bound"]})
    return joined.filter(in_range).select(*df.columns)


def dedup_keys(df: DataFrame, keys: list[str] = DEDUP_KEYS, scope: str | None = "source_file") -> list[str]:
    """The keys of D1, with the scope where the frame has it."""
    return [*keys, *([scope] if scope and scope in df.columns and scope not in keys else [])]


def drop_duplicates(df: DataFrame, keys: list[str] = DEDUP_KEYS,
                    tie_breaker: list[str] | None = None, scope: str | None = "source_file") -> DataFrame:
    """One row per key and ``scope`` value (input file, where the column exists); the
    survivor has the smallest ``tie_breaker`` values.  Files cleaned together or one
    after the other thus give the same rows.

    Written as an aggregate (``min`` of a struct led by the tie-breaker), not a
    window: duplicates collapse in the map-side partial aggregate, so a key
    repeated in a third of all rows never reaches one task whole.  Without a
    tie-breaker all other columns break ties, which is still repeatable.
    """
    keys = dedup_keys(df, keys, scope)
    others = [c for c in df.columns if c not in keys]
    order = list(tie_breaker or [])
    order += [c for c in others if c not in order]
    if not order:
        return df.select(*keys).distinct()
    survivor = F.min(F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(order)]))
    picked = df.groupBy(*keys).agg(survivor.alias("_s"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_s._{order.index(c)}").alias(c)
                           for c in df.columns])


def pseudonymize(df: DataFrame, salt: str, columns: tuple[str, ...] = ("user_id", "user_session")
                 ) -> DataFrame:
    """Replace identifiers by ``sha2(cast(x as string) || salt, 256)``.

    The salt is a required argument, one per data set, so one person keeps one
    pseudonym across files; it is never stored with the data.
    """
    if not salt:
        raise ValueError("a non-empty salt is required")
    return df.withColumns({c: C.pseudonym(c, salt) for c in columns if c in df.columns})


def clean_events(df: DataFrame, salt: str, scope: str | None = "source_file",
                 exact: bool = False, tie_breaker: list[str] | None = None) -> DataFrame:
    """P10: P1, P2, P3, P4, P5, P6, P7, D1, P8 in this order."""
    return (df.transform(drop_invalid_rows)
              .transform(clean_event_types)
              .transform(clean_prices)
              .transform(clean_brands)
              .transform(split_categories)
              .transform(fill_unknown)
              .transform(remove_outliers, scope=scope, exact=exact)
              .transform(drop_duplicates, tie_breaker=tie_breaker, scope=scope)
              .transform(pseudonymize, salt=salt))
