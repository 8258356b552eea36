"""Quartiles by distributed selection and from stored sketches."""
import random

import pytest
from pyspark.sql import functions as F

from clickseg.operators import cleaning as CL
from clickseg.operators import quantiles as QT
from clickseg.plans import jobs
from test_footers import month


def disc(values, rank):
    """The smallest value whose share of rows reaches the rank."""
    s = sorted(values)
    return s[max(1, -int(-rank * len(s) // 1)) - 1]


def test_exact_against_sorting(spark):
    rnd = random.Random(2)
    rows = [("hot", float(rnd.randrange(5000))) for _ in range(3000)] + [("ties", 7.0)] * 500 + [("one", 3.0), (None, 1.0), (None, 9.0)]
    rows += [(f"s{i}", rnd.choice([0.0, -0.0, 1.5, float(i)])) for i in range(40) for _ in range(i % 7)] + [("void", None)]
    df = spark.createDataFrame(rows, "f string, x double").repartition(9)
    ranks = (0.0, 0.25, 0.5, 0.75, 1.0)
    got = {r.f: [r[f"q{i}"] for i in range(5)] for r in QT.exact_quantiles(df, "x", "f", ranks).collect()}
    held = {}
    for f, x in rows:
        if x is not None:
            held.setdefault(f, []).append(x)
    assert got == {f: [disc(v, r) for r in ranks] for f, v in held.items()}
    every = [x for _, x in rows if x is not None]
    assert list(QT.exact_quantiles(df, "x", None, ranks).first()) == [disc(every, r) for r in ranks]
    assert QT.exact_quantiles(df.limit(0), "x", "f").count() == 0
    assert list(QT.exact_quantiles(df.limit(0), "x", None).first()) == [None, None]


def test_hot_file_of_distinct_prices_in_balanced_tasks(spark):
    n = 1_000_000
    df = spark.range(n).select(F.lit("hot").alias("source_file"), ((F.col("id") * 7919) % n).cast("double").alias("price"))
    df = df.union(spark.createDataFrame([("small", 1.0)], "source_file string, price double"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.source_file: (r.q1, r.q3) for r in CL.price_bounds(df, exact=True).collect()}
        assert got == {"hot": (n / 4 - 1, 3 * n / 4 - 1), "small": (1.0, 1.0)}
        values = df.groupBy("source_file", "price").count().repartitionByRange("source_file", "price")
        per_task = [r[0] for r in values.groupBy(F.spark_partition_id()).count().select("count").collect()]
        assert len(per_task) == 8 and max(per_task) < 1.5 * n / 8
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    plan = CL.price_bounds(df, exact=True)._jdf.queryExecution().toString()
    assert "ObjectHashAggregate" not in plan and "percentile" not in plan


@pytest.mark.parametrize("scope", ["f", None])
def test_sketches_merge_to_within_their_error(spark, scope):
    n = 60_000
    df = spark.range(n).select((F.col("id") % 5).cast("string").alias("f"), F.pmod(F.xxhash64("id"), F.lit(10_000)).cast("double").alias("x"))
    fine = QT.sketches(df.withColumn("part", F.col("x") % 7), "x", None)
    assert fine.first().n_values == n
    stored = QT.sketches(df, "x", "f")
    quantiles = QT.sketch_quantiles(stored if scope else QT.merged_sketches(stored, None), scope).collect()
    for r in quantiles:
        own = df.filter(F.col("f") == r.f) if scope else df
        size = own.count()
        for q, rank in ((r.q0, 0.25), (r.q1, 0.75)):
            assert own.filter(F.col("x") < q).count() <= (rank + QT.SKETCH_ERROR) * size
            assert own.filter(F.col("x") <= q).count() >= (rank - QT.SKETCH_ERROR) * size
    assert len(quantiles) == (5 if scope else 1)
    assert QT.sketch_quantiles(QT.sketches(df.limit(0), "x", None), None).first().q0 is None


def test_bounds_of_all_months_from_stored_sketches(spark, tmp):
    """The second run merges the first month's sketch; it reads none of its rows."""
    month(spark, 40).write.parquet(f"{tmp}/in/source_file=m1")
    jobs.clean_job(spark, f"{tmp}/in", f"{tmp}/out", "salt", scope=None)
    late = month(spark, 40, start=100).withColumn("price", F.col("price") + 100)
    late.write.parquet(f"{tmp}/in/source_file=m2")
    jobs.clean_job(spark, f"{tmp}/in", f"{tmp}/out", "salt", scope=None)
    stored = spark.read.schema("n_values long, sketch binary, source_file string").parquet(f"{tmp}/out/_sketches")
    assert {r.source_file: r.n_values for r in stored.collect()} == {"m1": 41, "m2": 41}
    both = month(spark, 40).select("price").union(late.select("price"))
    b, e = (x.first() for x in (CL.bounds_of_sketches(stored, None, merge=True), CL.price_bounds(both, None, exact=True)))
    assert (b.q1, b.q3) == (e.q1, e.q3)
