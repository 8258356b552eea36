"""Buyer features (A1-A4, J1), purchase filter (P9), distinct users (D2), union.

The feature table is one two-level aggregate.  Level 1 groups by
``(user_id, product_id)``, level 2 by ``user_id``; both levels combine on the
map side before they shuffle, so a user with a third of all events is spread
over many tasks at level 1 and arrives at level 2 as one row per map task.  The
distinct product count falls out of level 2 as a plain count, with no
``Expand``.  The reference date (latest purchase over all users) is a global
aggregate of the persisted level-2 table: a scalar subquery, no join.
"""

from __future__ import annotations

import datetime as _dt
import logging
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickseg.schemas import FEATURE_COLUMNS
from clickseg.session import kept

log = logging.getLogger(__name__)



def _is(event_type: str):
    return F.col("event_type") == event_type

# Money is summed as a decimal that keeps 18 places: exact and independent of row
# order, so feature values (and the K-Means fit on them) do not move with the layout.
# Amounts or sums of 1e20 and more do not fit; they are summed as doubles.
MONEY = "decimal(38,18)"


def _money(decimal, double):
    return F.coalesce(F.when(decimal[1] == 0, decimal[0].cast("double")), double, F.lit(0.0))


def purchase_filter(df: DataFrame) -> DataFrame:
    """Purchases only."""
    return df.filter(_is("purchase"))


def distinct_users(df: DataFrame) -> DataFrame:
    """Distinct ``user_id``."""
    return df.select("user_id").distinct()


def pair_counts(df: DataFrame, *more: str) -> DataFrame:
    """Level 1: counts, purchase money and last purchase per user and product (and ``more``)."""
    is_purchase = _is("purchase")
    paid = F.when(is_purchase, F.col("price").cast("double"))
    return df.groupBy("user_id", "product_id", *more).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("event_type") == "view").alias("v"),
        F.count_if(F.col("event_type") == "cart").alias("c"),
        F.count_if(is_purchase).alias("p"),
        F.try_sum(paid.try_cast(MONEY)).alias("m"),
        F.sum(paid).alias("m_double"),
        F.count_if(paid.isNotNull() & paid.try_cast(MONEY).isNull()).alias("m_unfit"),
        F.max(F.when(is_purchase, F.col("event_time"))).alias("t"),
    )


def _unfit():
    """Amounts, and sums of them, that did not fit the decimal."""
    return F.sum(F.col("m_unfit") + F.when(F.col("m").isNull() & F.col("m_double").isNotNull(), 1).otherwise(0))


def merge_pairs(pairs: DataFrame) -> DataFrame:
    """Rows of :func:`pair_counts` of several parts of the events, added up per user and product."""
    return pairs.groupBy("user_id", "product_id").agg(
        *[F.sum(c).alias(c) for c in ("n", "v", "c", "p")], F.try_sum("m").alias("m"),
        F.sum("m_double").alias("m_double"), _unfit().alias("m_unfit"), F.max("t").alias("t"))


def _per_user(pairs: DataFrame) -> DataFrame:
    """Level 2: per user counts, purchase money, last purchase, products."""
    return pairs.groupBy("user_id").agg(
        F.sum("n").alias("events"),
        F.sum("v").alias("views"),
        F.sum("c").alias("carts"),
        F.sum("p").alias("purchases"),
        _money((F.try_sum("m"), _unfit()), F.sum("m_double")).alias("monetary"),
        F.max("t").alias("last_purchase"),
        F.count_if((F.col("p") > 0) & F.col("product_id").isNotNull()).alias("unique_products"),
    )


def _with_reference(per_user: DataFrame, reference_date) -> DataFrame:
    """Attach the reference date: given, or the latest purchase over all users."""
    # The per-user table is read twice (rows and global max).  Persisting it
    # (lazily: no job here) keeps the scan and the cleaning chain to one pass;
    # it has one row per user, far fewer than the events.
    per_user = kept(per_user)
    # A global aggregate (one value): a scalar subquery, computed once and inlined.
    g = per_user.agg(F.struct(F.to_date(F.max("last_purchase")).alias("ref"),
                              F.sum("purchases").alias("all")).alias("g")).scalar()
    ref = g["ref"]
    if reference_date is not None:
        ref = (F.lit(reference_date).cast("date") if isinstance(reference_date, (_dt.date, _dt.datetime, str))
               else reference_date)
    return per_user.withColumns({"_ref": ref, "_all_purchases": g["all"]})


def reference_date(df: DataFrame) -> DataFrame:
    """A2: latest purchase time over all users (one row)."""
    return df.filter(_is("purchase")).agg(F.max("event_time").alias("reference_time"))


def rfm(df: DataFrame, reference_date=None) -> DataFrame:
    """A1 (and A3): recency, frequency, monetary, unique products per buyer.

    ``recency = datediff(reference, last purchase)``.  When the input holds no
    purchase at all, every distinct user is returned with recency NULL and
    zeros (the reference's fallback), decided inside the plan, not by an action.
    """
    return rfm_of_pairs(pair_counts(df), reference_date)


def rfm_of_pairs(pairs: DataFrame, reference_date=None) -> DataFrame:
    """:func:`rfm` from the rows of :func:`pair_counts`, one per user and product."""
    per_user = _with_reference(_per_user(pairs), reference_date)
    keep = (F.col("purchases") > 0) | (F.coalesce(F.col("_all_purchases"), F.lit(0)) == 0)
    return per_user.filter(keep).select(
        "user_id",
        F.datediff(F.col("_ref"), F.to_date("last_purchase")).alias("recency"),
        F.col("purchases").alias("frequency"),
        "monetary",
        "unique_products",
    )


def behavior(df: DataFrame) -> DataFrame:
    """A4: per user views, carts, purchases and purchases / all events."""
    return df.groupBy("user_id").agg(
        F.count_if(F.col("event_type") == "view").alias("views"),
        F.count_if(F.col("event_type") == "cart").alias("carts"),
        F.count_if(_is("purchase")).alias("purchases"),
        (F.count_if(_is("purchase")) / F.count(F.lit(1))).alias("conversion_rate"),
    )


def features(df: DataFrame, reference_date=None) -> DataFrame:
    """One row per buyer with the 8 feature columns (A1 + A4, frequency > 0).

    Same rows as ``features_by_join`` (the reference's left join of RFM and
    behavior, ``fillna(0)``, ``frequency > 0``) in one aggregate instead of two
    aggregates and a join.
    """
    return features_of_pairs(pair_counts(df), reference_date)


def features_of_pairs(pairs: DataFrame, reference_date=None) -> DataFrame:
    """:func:`features` from the rows of :func:`pair_counts`, one per user and product."""
    per_user = _with_reference(_per_user(pairs), reference_date)
    return per_user.filter(F.col("purchases") > 0).select(
        "user_id",
        F.datediff(F.col("_ref"), F.to_date("last_purchase")).alias("recency"),
        F.col("purchases").alias("frequency"),
        "monetary",
        "unique_products",
        "views", "carts", "purchases",
        (F.col("purchases") / F.col("events")).alias("conversion_rate"),
    )


def features_by_join(df: DataFrame, reference_date=None) -> DataFrame:
    """J1 in the reference's form: RFM left-joined with behavior; kept as a test."""
    joined = rfm(df, reference_date).join(behavior(df), on="user_id", how="left")
    return joined.fillna(0).filter(F.col("frequency") > 0).select("user_id", *FEATURE_COLUMNS)


def schema_drift(frames: list[DataFrame]) -> list[tuple[int, list[str], list[str]]]:
    """Per frame: (index, columns missing vs the first frame, extra columns). No job runs."""
    base = frames[0].columns
    out = []
    for i, f in enumerate(frames[1:], start=1):
        missing = [c for c in base if c not in f.columns]
        extra = [c for c in f.columns if c not in base]
        if missing or extra:
            out.append((i, missing, extra))
    return out


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """Fold by column name; missing columns become NULL; drift is logged."""
    if not frames:
        raise ValueError("no DataFrame to union")
    for i, missing, extra in schema_drift(frames):
        log.warning("schema drift in frame %d: missing %s, extra %s", i, missing, extra)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
