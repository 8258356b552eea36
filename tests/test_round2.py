"""Cases that earlier versions got wrong: money, drift, ties, done markers, layout."""
import datetime as dt
import logging
import os

import pytest
from pyspark.sql import functions as F

from clickseg.functions import columns as C
from clickseg.operators import clustering as CU
from clickseg.operators import features as FE
from clickseg.plans import jobs
from clickseg.sources import files as IO

EVENTS = "user_id string, product_id bigint, event_type string, price double, event_time timestamp"
T0 = dt.datetime(2024, 1, 1)


def _events(spark, prices, event_type="purchase"):
    return spark.createDataFrame([("u", i, event_type, p, T0) for i, p in enumerate(prices)], EVENTS)


@pytest.mark.parametrize("prices, total", [([0.004] * 3, 0.012), ([1e17], 1e17), ([1e17, 0.5], 1e17 + 0.5),
                                           ([1e25, 1.0], 1e25), ([9e19, 9e19], 1.8e20), ([0.1] * 3, 0.3), ([None], 0.0)])
def test_money_keeps_every_digit(spark, prices, total):
    row = FE.features(_events(spark, prices)).first()
    assert row.monetary == pytest.approx(total, rel=1e-15)
    if total < 1e10:
        assert row.monetary == total


def test_no_purchases_with_a_given_date(spark):
    views = _events(spark, [1.0, 2.0], "view")
    for ref in (None, dt.date(2024, 5, 1)):
        (row,) = FE.rfm(views, ref).collect()
        assert (row.user_id, row.recency, row.frequency, row.monetary) == ("u", None, 0, 0.0)


def test_share_ties_go_to_the_even_digit(spark):
    df = spark.range(400).select((F.col("id") < 49).cast("int").alias("prediction"), *[
        F.lit(1.0).alias(c) for c in ("recency", "frequency", "monetary", "conversion_rate")])
    got = {r.cluster: r.percentage for r in CU.cluster_profiles(df).collect()}
    assert got == {1: "12.2%", 0: "87.8%"}


def test_text_prices(spark):
    df = spark.createDataFrame([("abc",), ("2.5",), (None,), ("-1",)], "price string")
    assert [r[0] for r in df.select(C.clean_price("price")).collect()] == [0.0, 2.5, 0.0, 0.0]


def test_drifted_columns_are_kept_and_logged(spark, tmp, caplog):
    spark.createDataFrame([(1, "x")], "id int, a string").write.parquet(f"{tmp}/p/source_file=m1")
    spark.createDataFrame([(2, "y", 3.0)], "id int, a string, b double").write.parquet(f"{tmp}/p/source_file=m2")
    with caplog.at_level(logging.WARNING):
        rows = IO.prefix_scan(spark, f"{tmp}/p").orderBy("id").collect()
    assert [(r.id, r.a, r.b) for r in rows] == [(1, "x", None), (2, "y", 3.0)]
    assert "schema drift" in caplog.text


CSV = ("event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session\n"
       "2019-10-01 00:00:00 UTC,{},1,2,a.b,x,5.0,7,s\n")


def test_done_markers(spark, tmp):
    os.makedirs(f"{tmp}/csv")
    for name, kind in (("01.csv", "view"), ("1.csv", "purchase"), ("2.csv", "")):  # all rows of 2.csv are dropped
        with open(f"{tmp}/csv/{name}", "w") as f:
            f.write(CSV.format(kind))
    assert len(IO.csv_to_parquet(spark, f"{tmp}/csv", f"{tmp}/pq")) == 3
    assert IO.csv_to_parquet(spark, f"{tmp}/csv", f"{tmp}/pq") == []
    assert jobs.clean_job(spark, f"{tmp}/pq", f"{tmp}/clean", "salt", report_dir=f"{tmp}/rep")
    assert jobs.clean_job(spark, f"{tmp}/pq", f"{tmp}/clean", "salt") == {}
    assert {d for d in os.listdir(f"{tmp}/clean") if "=" in d} >= {"source_file=01", "source_file=1"}
    assert {"quality_comparison", "row_counts", "describe_numeric_before", "event_distribution_after"} <= set(
        os.listdir(f"{tmp}/rep"))


def test_half_written_partition_is_not_done(spark, tmp):
    spark.range(3).withColumn("source_file", F.lit("m")).write.partitionBy("source_file").parquet(f"{tmp}/out")
    assert IO.done_partitions(spark, f"{tmp}/out").count() == 0
    IO.mark_done(spark.createDataFrame([("m",)], "source_file string"), f"{tmp}/out")
    assert IO.done_partitions(spark, f"{tmp}/out").count() == 1


def test_layout_repeats(spark):
    df = spark.range(1_200_000).select(F.sha2(F.col("id").cast("string"), 256).alias("user_id"))

    def prints(frame):
        return sorted(tuple(r) for r in CU.layout(frame, 4).groupBy(F.spark_partition_id().alias("p")).agg(
            F.count("*"), F.bit_xor(F.xxhash64("user_id"))).collect())
    assert prints(df) == prints(df.repartition(7)) and len(prints(df)) == 4
