"""Adapter: the driver's ``events`` and ``part`` tables -> ``clicks_raw``.

The driver tables are clean and use other event types, so the adapter renames
types, adds deterministic dirt (nulls, padding, negative prices, wrong case) and
re-emits every 50th event as a duplicate.  ``event_id`` is kept as the
tie-breaker for deterministic deduplication and ``source_file`` stands for the
monthly input file.  The same rows come out of the SQL text in
``clickseg.plans.oracle.ADAPTER_SQL``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _every(n: int) -> Column:
    return (F.col("event_id") % n) == 0


def clicks_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select(
        "p_partkey", "p_brand", "p_type", "p_name")

    renamed = F.when(F.col("event_type") == "click", "cart") \
        .when(F.col("event_type") == "signup", "remove_from_cart") \
        .otherwise(F.col("event_type"))
    base = events.select(
        "event_id",
        F.col("ts"),
        F.col("user_id").alias("uid"),
        F.col("value").alias("v"),
        F.regexp_extract("props", "([0-9]+)", 1).try_cast("bigint").alias("k"),
        renamed.alias("et"),
    )
    joined = base.join(part, base.k == part.p_partkey, "left")

    day = F.col("ts").cast("date")
    source_file = F.when(day < F.lit("2024-01-11").cast("date"), "2024-01-a") \
        .when(day < F.lit("2024-01-21").cast("date"), "2024-01-b") \
        .otherwise("2024-01-c")
    p_type = F.lower("p_type")
    one = joined.select(
        "event_id",
        source_file.alias("source_file"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.when(_every(101), F.lit(None).cast("string"))
         .when(_every(7), F.concat(F.lit("  "), F.upper("et"), F.lit(" ")))
         .otherwise(F.col("et")).alias("event_type"),
        F.when(_every(97), F.lit(None).cast("bigint")).otherwise(F.col("k")).alias("product_id"),
        (F.col("k") % 10).alias("category_id"),
        F.when(_every(13), F.lit(None).cast("string"))
         .when(_every(5), p_type)
         .otherwise(F.concat(p_type, F.lit("."), F.replace("p_name", F.lit(" "), F.lit("."))))
         .alias("category_code"),
        F.when(_every(11), F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit(" "), F.upper("p_brand"))).alias("brand"),
        F.when(_every(89), F.lit(None).cast("double"))
         .when(_every(83), -F.col("v")).otherwise(F.col("v")).alias("price"),
        F.col("uid").alias("user_id"),
        F.when(_every(17), F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("s"), F.col("uid").cast("string"), F.lit("-"),
                             day.cast("string"))).alias("user_session"),
    )
    # Every 50th event twice: one scan, rows repeated by a generator instead of
    # a self-union that would read and join the inputs a second time.
    copies = F.sequence(F.lit(1), F.when(_every(50), 2).otherwise(1))
    return one.withColumn("_copy", F.explode(copies)).drop("_copy")
