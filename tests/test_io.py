"""Sources and sinks in a temporary folder (local paths stand for s3a://)."""

import gzip
import os

import pytest
from pyspark.ml import PipelineModel

from clickseg.operators import clustering as CU
from clickseg.plans import catalog, jobs
from clickseg.schemas import validate_schema
from clickseg.sources import files as IO
from clickseg.sources.s3a import s3a_options

CSV = """event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session
2019-10-01 00:00:00 UTC,view,44600062,2103807459595387724,,shiseido,35.79,541312140,72d76fde
2019-10-01 00:00:01 UTC,purchase,3900821,2053013552326770905,appliances.environment.water_heater,aqua,not-a-price,554748717,9333dfbd
"""


def _write(path, text, gz=False):
    if gz:
        with gzip.open(path, "wt") as f:
            f.write(text)
    else:
        with open(path, "w") as f:
            f.write(text)


def test_csv_scan_types_and_permissive(spark, tmp):
    _write(f"{tmp}/2019-Oct.csv", CSV)
    df = IO.csv_scan(spark, f"{tmp}/2019-Oct.csv")
    rows = df.orderBy("event_time").collect()
    assert rows[0].event_time.timestamp() == 1569888000  # session zone UTC
    assert rows[1].price is None  # bad field -> NULL
    assert rows[0].source_file == "2019-Oct"
    assert validate_schema(df.drop("source_file"))


def test_csv_gz_and_convert_skips_done(spark, tmp):
    os.makedirs(f"{tmp}/csv")
    _write(f"{tmp}/csv/2019-Oct.csv", CSV)
    _write(f"{tmp}/csv/2019-Nov.csv.gz", CSV, gz=True)
    gz = IO.csv_gz_scan(spark, f"{tmp}/csv/2019-Nov.csv.gz", partitions=2)
    assert gz.count() == 2
    done = IO.csv_to_parquet(spark, f"{tmp}/csv", f"{tmp}/pq")
    assert len(done) == 2
    out = spark.read.parquet(f"{tmp}/pq")
    assert sorted(r.source_file for r in out.select("source_file").distinct().collect()) == \
        ["2019-Nov", "2019-Oct"]
    assert IO.csv_to_parquet(spark, f"{tmp}/csv", f"{tmp}/pq") == []
    _write(f"{tmp}/csv/2019-Dec.csv", CSV)
    assert [os.path.basename(p) for p in IO.csv_to_parquet(spark, f"{tmp}/csv", f"{tmp}/pq")] == \
        ["2019-Dec.csv"]
    assert spark.read.parquet(f"{tmp}/pq").count() == 6


def test_discover_and_prefix_scan(spark, tmp):
    with pytest.raises(ValueError):
        IO.discover_inputs(spark, tmp)
    df = spark.createDataFrame([(1, "a")], "x int, source_file string")
    IO.write_clean(df, f"{tmp}/clean")
    assert IO.discover_inputs(spark, f"{tmp}/clean").count() >= 1
    back = IO.prefix_scan(spark, f"{tmp}/clean")
    assert back.columns == ["x", "source_file"] and back.count() == 1


def test_write_clean_keeps_other_partitions(spark, tmp):
    a = spark.createDataFrame([(1, "m1"), (2, "m2")], "x int, source_file string")
    IO.write_clean(a, f"{tmp}/o")
    IO.write_clean(spark.createDataFrame([(3, "m2")], "x int, source_file string"), f"{tmp}/o")
    got = sorted(tuple(r) for r in spark.read.parquet(f"{tmp}/o").collect())
    assert got == [(1, "m1"), (3, "m2")]


def test_parquet_scan_validates(spark, tmp):
    spark.createDataFrame([(1,)], "x int").write.parquet(f"{tmp}/bad")
    with pytest.raises(ValueError):
        IO.parquet_scan(spark, f"{tmp}/bad")


def test_model_save_and_load_latest(spark, tmp):
    feats = CU.layout(catalog.buyer_features(spark, "/root/testdata/sf0.001"), 2)
    model = CU.fit_kmeans(feats, 2)
    import datetime as dt
    p1 = IO.save_model(model, f"{tmp}/models", dt.datetime(2025, 6, 26, 14, 3))
    p2 = IO.save_model(model, f"{tmp}/models", dt.datetime(2025, 6, 27, 9, 0))
    assert IO.list_models(spark, f"{tmp}/models").count() == 2
    latest = IO.load_model(spark, f"{tmp}/models")
    assert isinstance(latest, PipelineModel)
    a = latest.transform(feats).select("prediction").collect()
    assert a == model.transform(feats).select("prediction").collect()
    assert p2.endswith("model_20250627_090000") and p1 != p2


def test_s3a_options():
    with pytest.raises(ValueError):
        s3a_options({})
    opts = s3a_options({"S3_ENDPOINT": "http://store:9000", "S3_ACCESS_KEY": "a", "S3_SECRET_KEY": "b"})
    assert opts["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert opts["spark.hadoop.fs.s3a.path.style.access"] == "true"


def test_clean_job_end_to_end(spark, tmp):
    raw = catalog.raw(spark, "/root/testdata/sf0.001")
    # several part files per month: the month, not the part file, is the unit
    raw.drop("event_id").repartition(3).write.partitionBy("source_file").parquet(f"{tmp}/in")
    assert IO.list_files(spark, f"{tmp}/in", "*.parquet").count() > 3
    counts = jobs.clean_job(spark, f"{tmp}/in", f"{tmp}/out", "salt", report_dir=f"{tmp}/rep",
                            exact=True)
    assert counts["initial"] == 1020 and counts["clean_event_types"] == 786
    assert counts["remove_outliers"] == 765  # per-month quartiles, as in the chain
    out = spark.read.parquet(f"{tmp}/out")
    assert out.count() == counts["drop_duplicates"]
    assert sorted(r.source_file for r in out.select("source_file").distinct().collect()) == \
        ["2024-01-a", "2024-01-b", "2024-01-c"]
    assert spark.read.parquet(f"{tmp}/rep/quality_comparison").count() > 0
    assert jobs.clean_job(spark, f"{tmp}/in", f"{tmp}/out", "salt") == {}


def test_csv_time_follows_session_zone(spark, tmp):
    """The pattern quotes 'UTC' as a literal: times are read in the session zone."""
    _write(f"{tmp}/m.csv", CSV)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        first = IO.csv_scan(spark, f"{tmp}/m.csv").orderBy("event_time").first()
        assert first.event_time.timestamp() == 1569902400
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_score_stream_job(spark, tmp):
    feats = CU.prepare(catalog.buyer_features(spark, "/root/testdata/sf0.001"))
    model = CU.fit_kmeans(feats, 2)
    IO.save_model(model, f"{tmp}/models")
    typed = feats.select("user_id", *[feats[c].cast("double").alias(c) for c in feats.columns[1:]])
    typed.write.parquet(f"{tmp}/profiles")
    q = jobs.start_score_stream(spark, f"{tmp}/models", f"{tmp}/profiles", f"{tmp}/scores",
                                f"{tmp}/ck", trigger={"availableNow": True})
    q.awaitTermination()
    got = spark.read.parquet(f"{tmp}/scores")
    want = model.transform(feats).select("user_id", "prediction")
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
