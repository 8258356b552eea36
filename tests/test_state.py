"""Feature state: months added one by one equal all events at once."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from clickseg.operators import features as FE
from clickseg.operators import state as ST
from clickseg.plans import catalog
from conftest import SF

SCHEMA = "source_file string, user_id string, event_type string, event_time timestamp, product_id bigint, price double"


def events(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def made(n, months, seed=3):
    r = random.Random(seed)
    t = dt.datetime(2024, 1, 1)
    return [(r.choice(months), None if r.random() < 0.02 else "hot" if r.random() < 0.33 else f"u{r.randrange(40)}",
             r.choice(["view", "cart", "purchase"]), t + dt.timedelta(minutes=r.randrange(10 ** 5)),
             None if r.random() < 0.02 else r.randrange(30), r.choice([0.1, 19.99, None, 3e21, 7.0])) for _ in range(n)]


def rows(df):
    # Amounts beyond the decimal are summed as doubles, whose last digits follow the order.
    return sorted((tuple(f"{x:.12g}" if isinstance(x, float) else x for x in r) for r in df.collect()), key=str)


def test_month_by_month_equals_all_at_once(spark, tmp):
    months = ["01", "2024-02", "x y"]
    every = events(spark, made(3000, months))
    for i, m in enumerate(months):
        ST.add_months(every.filter(F.col("source_file") == m), f"{tmp}/s", 4)
        assert ST.finished_months(spark, f"{tmp}/s") == sorted(months[:i + 1])
    assert rows(ST.features(spark, f"{tmp}/s")) == rows(FE.features(every))
    assert rows(ST.rfm(spark, f"{tmp}/s", "2024-06-01")) == rows(FE.rfm(every, "2024-06-01"))
    ST.drop(spark, f"{tmp}/s")
    with pytest.raises(FileNotFoundError):
        ST.features(spark, f"{tmp}/s")


def test_cleaned_months_and_the_second_reads_none_of_the_first(spark, tmp):
    every = catalog.cleaned(spark, SF).drop("event_id").cache()
    months = sorted(r[0] for r in every.select("source_file").distinct().collect())
    first, later = every.filter(F.col("source_file") == months[0]), every.filter(F.col("source_file") != months[0])
    first.write.partitionBy("source_file").parquet(f"{tmp}/clean")
    assert ST.update(spark, f"{tmp}/clean", f"{tmp}/s") == months[:1]
    assert ST.update(spark, f"{tmp}/clean", f"{tmp}/s") == []
    # The first month's events become unreadable: adding the others must not need them.
    for r in spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{tmp}/clean").collect():
        path = r.path.removeprefix("file:")
        with open(path, "wb") as f:
            f.write(b"no parquet")
        crc = path.rsplit("/", 1)
        open(f"{crc[0]}/.{crc[1]}.crc", "wb").close()
    later.write.mode("append").partitionBy("source_file").parquet(f"{tmp}/clean")
    assert ST.update(spark, f"{tmp}/clean", f"{tmp}/s") == months[1:]
    assert rows(ST.features(spark, f"{tmp}/s")) == rows(FE.features(every))
    every.unpersist()


def test_a_month_added_again_replaces_its_rows(spark, tmp):
    a, b = made(300, ["a"]), made(300, ["b"], seed=8)
    ST.add_months(events(spark, a + b), f"{tmp}/s", 3)
    again = made(200, ["a"], seed=9)
    ST.add_months(events(spark, again), f"{tmp}/s", 99)
    assert rows(ST.features(spark, f"{tmp}/s")) == rows(FE.features(events(spark, again + b)))
    ST.add_months(events(spark, []), f"{tmp}/s", 3, months=["a", "empty"])
    assert rows(ST.features(spark, f"{tmp}/s")) == rows(FE.features(events(spark, b)))
    assert ST.finished_months(spark, f"{tmp}/s") == ["a", "b", "empty"]
    with pytest.raises(ValueError, match="without"):
        ST.add_months(events(spark, made(9, [None])), f"{tmp}/s", 3)
    with pytest.raises(ValueError, match="holds"):
        ST.add_months(events(spark, a).withColumn("product_id", F.col("product_id").cast("string")), f"{tmp}/s", 3)


def test_unfinished_months_do_not_count(spark, tmp):
    ST.add_months(events(spark, made(200, ["a"])), f"{tmp}/s", 2)
    layout = ST._layout(spark, f"{tmp}/s")
    name = ST._table(spark, f"{tmp}/s", *layout)
    half = FE.pair_counts(events(spark, made(200, ["b"])))
    spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION (source_file = 'b') SELECT * FROM {{half}}", half=half)
    assert rows(ST.features(spark, f"{tmp}/s")) == rows(FE.features(events(spark, made(200, ["a"]))))


def test_merging_needs_no_exchange_and_another_session_reads_it(spark, tmp):
    every = events(spark, made(2000, ["a", "b"]))
    ST.add_months(every, f"{tmp}/s", 4)
    plan = ST.pairs(spark, f"{tmp}/s")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan
    spark.sql(f"DROP TABLE {ST.table_name(f'{tmp}/s')}")  # a session without the catalog entry
    assert rows(ST.features(spark, f"{tmp}/s")) == rows(FE.features(every))
