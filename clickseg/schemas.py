"""Declared schemas and schema validation (IO5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Fixed values that must equal the reference's: the raw clickstream columns and
# their types, the valid event types, and the three column groups of cleaning.
CLICKS_RAW = T.StructType([
    T.StructField("event_time", T.TimestampType(), True),
    T.StructField("event_type", T.StringType(), True),
    T.StructField("product_id", T.LongType(), True),
    T.StructField("category_id", T.LongType(), True),
    T.StructField("category_code", T.StringType(), True),
    T.StructField("brand", T.StringType(), True),
    T.StructField("price", T.DoubleType(), True),
    T.StructField("user_id", T.LongType(), True),
    T.StructField("user_session", T.StringType(), True),
])
VALID_EVENT_TYPES = ["view", "cart", "purchase", "remove_from_cart"]
CRITICAL_COLUMNS = ["event_time", "event_type", "product_id", "user_id", "price"]
DEDUP_KEYS = ["event_time", "event_type", "product_id", "user_id", "user_session"]
UNKNOWN_FILL = ["brand", "category_level_1", "category_level_2", "category_level_3",
                "category_code", "user_session"]

# Feature table column order (one row per buyer).
FEATURE_COLUMNS = ["recency", "frequency", "monetary", "unique_products",
                   "views", "carts", "purchases", "conversion_rate"]

FEATURES = T.StructType([
    T.StructField("user_id", T.StringType(), True),
    T.StructField("recency", T.IntegerType(), True),
    T.StructField("frequency", T.LongType(), True),
    T.StructField("monetary", T.DoubleType(), True),
    T.StructField("unique_products", T.LongType(), True),
    T.StructField("views", T.LongType(), True),
    T.StructField("carts", T.LongType(), True),
    T.StructField("purchases", T.LongType(), True),
    T.StructField("conversion_rate", T.DoubleType(), True),
])


def schema_violations(df: DataFrame, expected: T.StructType = CLICKS_RAW) -> list[str]:
    """:func:`problems_of` the frame's schema; no Spark job runs."""
    return problems_of(df.schema, expected)


def problems_of(schema: T.StructType, expected: T.StructType = CLICKS_RAW) -> list[str]:
    """Missing columns and wrong type classes; extra columns are allowed."""
    actual = {f.name: f.dataType for f in schema.fields}
    problems = []
    for field in expected.fields:
        if field.name not in actual:
            problems.append(f"missing column {field.name}")
        elif type(actual[field.name]) is not type(field.dataType):
            problems.append(f"column {field.name}: expected {field.dataType.simpleString()}, "
                            f"got {actual[field.name].simpleString()}")
    return problems


def validate_schema(df: DataFrame, expected: T.StructType = CLICKS_RAW) -> bool:
    return not schema_violations(df, expected)


def require_schema(df: DataFrame, expected: T.StructType = CLICKS_RAW) -> DataFrame:
    problems = schema_violations(df, expected)
    if problems:
        raise ValueError("invalid schema: " + "; ".join(problems))
    return df
