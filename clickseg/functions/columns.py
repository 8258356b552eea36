"""Column expressions shared by the operators.

All are built-in Spark expressions: they stay inside whole-stage codegen and
run the same in batch and streaming plans.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickseg.schemas import VALID_EVENT_TYPES


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalized_event_type(c: str | Column = "event_type") -> Column:
    """``lower(trim(x))`` with NULL mapped to the empty string."""
    return F.coalesce(F.lower(F.trim(col_(c))), F.lit(""))


def is_valid_event_type(c: str | Column = "event_type",
                        valid: list[str] = VALID_EVENT_TYPES) -> Column:
    return col_(c).isin(valid)


def clean_price(c: str | Column = "price") -> Column:
    """Double; NULL or non-positive becomes 0.0."""
    p = col_(c).try_cast("double")
    return F.when(p.isNull() | (p <= 0), F.lit(0.0)).otherwise(p)


def clean_brand(c: str | Column = "brand") -> Column:
    """``trim(lower(x))``; NULL becomes ``unknown``, a blank stays empty."""
    return F.coalesce(F.trim(F.lower(col_(c))), F.lit("unknown"))


def category_level(code: str | Column, level: int, default: str = "unknown") -> Column:
    """Level ``level`` (1-based) of a dotted category path, ``default`` if absent."""
    return F.coalesce(F.get(F.split(col_(code), r"\."), level - 1), F.lit(default))


def pseudonym(c: str | Column, salt: str) -> Column:
    """SHA-256 hex of the value as a string followed by the salt."""
    return F.sha2(F.concat(col_(c).cast("string"), F.lit(salt)), 256)


def percent(part: str | Column, whole: str | Column) -> Column:
    """``part / whole * 100`` as a double; NULL when ``whole`` is 0."""
    return F.try_divide(col_(part).cast("double"), col_(whole)) * 100
