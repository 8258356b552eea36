"""The schema gate of every input file, and deduplication inside files."""
import datetime as dt
import itertools
import logging

import pytest
from pyspark.sql import functions as F

from clickseg.operators import cleaning as CL
from clickseg.operators import quality as QU
from clickseg.plans import jobs
from clickseg.schemas import CLICKS_RAW
from clickseg.sources import files as IO
from clickseg.sources import footers as FT

T0 = dt.datetime(2024, 1, 1)


def month(spark, n=6, start=0):
    """``n`` different events, the first of them twice."""
    rows = [(T0 + dt.timedelta(minutes=i), "view", i, 1, "a.b", "x", 5.0 + i % 3, i, "s") for i in range(start, start + n)]
    return spark.createDataFrame(rows + rows[:1], CLICKS_RAW)


def broken(df, how):
    if how == "text":
        return df.withColumn("price", F.col("price").cast("string"))
    if how == "int":
        return df.withColumn("user_id", F.col("user_id").cast("int"))
    return df.drop(how)


@pytest.mark.parametrize("order", list(itertools.permutations(["price", None, None]))[::2])
@pytest.mark.parametrize("how", ["price", "text"])
def test_one_bad_month_of_three(spark, tmp, caplog, order, how):
    bad = next(f"m{i}" for i, x in enumerate(order) if x)
    for i, x in enumerate(order):
        df = month(spark, start=10 * i)
        (broken(df, how) if x else df).write.parquet(f"{tmp}/in/source_file=m{i}")
    with pytest.raises(ValueError, match=f"{bad}.*price"):
        jobs.clean_job(spark, f"{tmp}/in", f"{tmp}/out", "salt", bad_files="raise")
    assert IO.done_partitions(spark, f"{tmp}/out").count() == 0
    with caplog.at_level(logging.ERROR):
        counts = jobs.clean_job(spark, f"{tmp}/in", f"{tmp}/out", "salt", report_dir=f"{tmp}/rep")
    assert counts["initial"] == 14 and counts["drop_duplicates"] == 12
    assert f"source_file={bad}" in caplog.text and "price" in caplog.text
    good = sorted({"m0", "m1", "m2"} - {bad})
    assert sorted(r[0] for r in IO.done_partitions(spark, f"{tmp}/out").collect()) == good
    assert sorted(tuple(r) for r in spark.read.parquet(f"{tmp}/out/source_file=*").groupBy().count().collect()) == [(12,)]
    told = {(r.source_file, r.ok) for r in spark.read.parquet(f"{tmp}/rep/file_verdicts").collect()}
    assert told == {(m, True) for m in good} | {(bad, False)}
    with pytest.raises(ValueError, match=bad):  # it stays pending, and alone it is an error
        jobs.clean_job(spark, f"{tmp}/in", f"{tmp}/out", "salt")


def test_a_month_with_one_bad_part_and_an_unreadable_file(spark, tmp):
    month(spark).write.parquet(f"{tmp}/in/source_file=m0")
    broken(month(spark), "brand").write.mode("append").parquet(f"{tmp}/in/source_file=m0")
    month(spark, start=50).write.parquet(f"{tmp}/in/source_file=m1")
    with open(f"{tmp}/in/m2.parquet", "w") as f:
        f.write("no footer here")
    assert jobs.clean_job(spark, f"{tmp}/in", f"{tmp}/out", "salt")["initial"] == 7
    assert [r[0] for r in IO.done_partitions(spark, f"{tmp}/out").collect()] == ["m1"]
    files = [tuple(r) for r in IO.list_files(spark, f"{tmp}/in", "*.parquet").select("path", "source_file").collect()]
    found = {f.source_file: f.problems for f in FT.read_footers(spark, files) if f.problems}
    assert found["m0"] == ["missing column brand"] and found["m2"][0].startswith("unreadable footer")


def test_undeclared_columns(spark, tmp, caplog):
    month(spark).withColumn("extra", F.lit(1)).withColumn("mixed", F.lit(1)).write.parquet(f"{tmp}/in/source_file=m0")
    month(spark, start=9).withColumn("mixed", F.lit("x")).write.parquet(f"{tmp}/in/source_file=m1")
    with caplog.at_level(logging.WARNING):
        jobs.clean_job(spark, f"{tmp}/in", f"{tmp}/out", "salt")
    out = IO.parquet_scan(spark, [f"{tmp}/out/source_file=m0", f"{tmp}/out/source_file=m1"], base_path=f"{tmp}/out", validate=False,
                          schema="extra int, price double, source_file string")
    got = {r[0]: (r[1], r[2]) for r in out.groupBy("source_file").agg(F.max("extra"), F.count("*")).collect()}
    assert got == {"m0": (1, 6), "m1": (None, 6)} and "mixed left out" in caplog.text


def test_together_equals_one_after_the_other(spark, tmp):
    """The same events in two months are events of both."""
    for m in ("m1", "m2"):
        month(spark).write.parquet(f"{tmp}/both/source_file={m}")
    jobs.clean_job(spark, f"{tmp}/both", f"{tmp}/a", "salt")
    month(spark).write.parquet(f"{tmp}/steps/source_file=m1")
    jobs.clean_job(spark, f"{tmp}/steps", f"{tmp}/b", "salt")
    month(spark).write.parquet(f"{tmp}/steps/source_file=m2")
    jobs.clean_job(spark, f"{tmp}/steps", f"{tmp}/b", "salt")
    a, b = (IO.parquet_scan(spark, [f"{tmp}/{x}/source_file=m1", f"{tmp}/{x}/source_file=m2"], base_path=f"{tmp}/{x}", validate=False)
            for x in "ab")
    assert a.count() == b.count() == 12 and a.exceptAll(b).count() == 0
    raw = month(spark).withColumn("source_file", F.lit("m1")).union(month(spark).withColumn("source_file", F.lit("m2")))
    assert CL.drop_duplicates(raw).count() == 12 and CL.drop_duplicates(raw, scope=None).count() == 6
    for scope, n in (("source_file", 12), (None, 6)):
        rows = {r.step: r.n_rows for r in QU.row_counts(raw, scope=scope).collect()}
        assert rows["drop_duplicates"] == rows["final"] == n


@pytest.mark.parametrize("first", [0, 1])
def test_drift_does_not_depend_on_the_order_of_files(spark, tmp, caplog, first):
    frames = [spark.createDataFrame([(1, "x")], "id int, a string"), spark.createDataFrame([(2, "y", 3.0)], "id int, a string, b double")]
    for i, df in enumerate((frames[first], frames[1 - first])):
        df.coalesce(1).write.parquet(f"{tmp}/p/source_file=m{i}")
    with caplog.at_level(logging.WARNING):
        assert IO.prefix_scan(spark, f"{tmp}/p").columns == ["id", "a", "b", "source_file"]
    assert "column b missing in 1 of 2 files" in caplog.text
    spark.createDataFrame([(3,)], "id long").coalesce(1).write.parquet(f"{tmp}/p/source_file=m3")
    with pytest.raises(ValueError, match="id bigint.*id int"):
        IO.prefix_scan(spark, f"{tmp}/p")
