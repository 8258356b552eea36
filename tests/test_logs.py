"""Log metrics: the survey's session golden, batch and bounded stream."""

import datetime as dt
import os

from clickseg.streaming import logs as L

LOG = """2025-06-26 12:00:00,001 - src.processing.data_cleaning - INFO - 3 fichiers Parquet valides détectés
2025-06-26 12:00:01,002 - src.processing.data_cleaning - INFO - Analyse:
+---------+-----+
| Colonne | x   |
+---------+-----+
2025-06-26 12:00:30,003 - src.processing.data_cleaning - INFO - Doublons supprimés : 7
2025-06-26 12:05:00,004 - src.processing.data_cleaning - INFO - Doublons supprimés : 5
"""


def _totals(rows):
    return sorted((r.total_valid_parquet_files, r.total_duplicates_removed) for r in rows)


def test_bad_time_is_null_not_an_error(spark):
    df = spark.createDataFrame([("p", 1, "2025-06-26 24:00:00,000 - s - INFO - x")],
                               "path string, record_id bigint, message string")
    row = L.log_fields(df).first()
    assert row.ts is None and row.log_message == "x"


def test_records_and_fields(spark, tmp):
    with open(f"{tmp}/a.log", "w") as f:
        f.write("orphan line\n" + LOG)
    recs = L.log_records(L.log_lines(spark, f"{tmp}/a.log"))
    assert recs.count() == 5
    fields = L.log_fields(recs)
    multi = fields.filter("log_message LIKE 'Analyse:%'").first()
    # the record keeps its 4 lines; the message field is its first line only
    assert multi.message.count("\n") == 3 and multi.log_message == "Analyse:"
    assert multi.log_level == "INFO" and multi.source == "src.processing.data_cleaning"
    assert fields.filter("ts IS NULL").count() == 1  # the orphan line is kept
    m = L.log_metrics(fields).filter("duplicates_removed IS NOT NULL").count()
    assert m == 2
    tabbed = spark.createDataFrame([("p", 1, "2025-06-26 12:00:00,001 - s - INFO - a\t\tb   c")],
                                   "path string, record_id bigint, message string")
    norm = L.log_normalize(L.log_fields(tabbed)).first()
    assert norm.log_message == "a b c" and "message" in L.log_fields(tabbed).columns


def test_records_across_splits(spark, tmp):
    body = "".join(f"2025-06-26 12:{i // 60:02d}:{i % 60:02d},000 - s - INFO - r{i}\ncont {i}\n"
                   for i in range(3000))
    with open(f"{tmp}/big.log", "w") as f:
        f.write(body)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        lines = L.log_lines(spark, f"{tmp}/big.log")
        assert lines.rdd.getNumPartitions() > 4
        recs = L.log_records(lines)
        assert recs.count() == 3000
        bad = recs.filter("NOT message RLIKE '^2025.* - r([0-9]+)\\ncont \\\\1$'").count()
        assert bad == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_session_golden_batch(spark, tmp):
    with open(f"{tmp}/a.log", "w") as f:
        f.write(LOG)
    rows = L.log_pipeline(L.log_lines(spark, f"{tmp}/a.log")).collect()
    assert _totals(rows) == [(0, 5), (3, 7)]


def _stream(spark, tmp, folder="in", out="daily", **trigger):
    q = (L.stream_lines(spark, f"{tmp}/{folder}", **trigger).writeStream.foreachBatch(L.sessions_sink(f"{tmp}/{out}"))
         .option("checkpointLocation", f"{tmp}/ck-{folder}").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(f"{tmp}/{out}")


def test_session_golden_stream(spark, tmp):
    os.makedirs(f"{tmp}/in")
    with open(f"{tmp}/in/a.log", "w") as f:
        f.write(LOG)
    out = _stream(spark, tmp)
    assert _totals(out.collect()) == [(0, 5), (3, 7)]  # the last session too
    assert out.select("day").first().day == "2025.06.26"


def test_older_file_later_and_two_folders_on_one_day(spark, tmp):
    for folder, name, text in (("in", "a.log", LOG), ("other", "a.log", LOG)):
        os.makedirs(f"{tmp}/{folder}")
        with open(f"{tmp}/{folder}/{name}", "w") as f:
            f.write(text)
    assert _stream(spark, tmp).count() == 2
    with open(f"{tmp}/in/b.log", "w") as f:  # an older day arrives in the next trigger
        f.write(LOG.replace("2025-06-26", "2025-06-25"))
    assert _stream(spark, tmp).count() == 4
    both = _stream(spark, tmp, folder="other")  # the same day from another folder
    assert both.count() == 6 and both.filter("day = '2025.06.26'").count() == 4
    L.daily_sink(f"{tmp}/daily")(L.log_pipeline(L.log_lines(spark, f"{tmp}/other")), 0)  # again: an upsert
    assert spark.read.parquet(f"{tmp}/daily").count() == 6


def test_session_limit(spark, tmp):
    t0 = dt.datetime(2025, 6, 26, 12)
    for name, secs in (("a", range(0, 600, 30)), ("b", (0, 50, 100, 150, 200, 250, 300, 400))):
        with open(f"{tmp}/{name}.log", "w") as f:
            f.writelines(f"{(t0 + dt.timedelta(seconds=s)):%Y-%m-%d %H:%M:%S},000 - s - INFO - Doublons supprimés : 1\n"
                         for s in secs)
    got = L.log_pipeline(L.log_lines(spark, f"{tmp}/*.log")).collect()
    at = lambda n: sorted(((r.session_start - t0).total_seconds(), r.records) for r in got if n in r.path)
    assert at("a.log") == [(120.0 * i, 4) for i in range(5)]
    assert at("b.log") == [(0, 3), (150, 3), (300, 1), (400, 1)]


def test_levels(spark):
    levels = ["info", "SEVERE", "ALERT", "Warning", "ERR", "emerg", "nonsense"]
    df = spark.createDataFrame([("p", i, f"2025-06-26 12:00:00,000 - s - {x} - Doublons supprimés : 2") for i, x in enumerate(levels)],
                               "path string, record_id bigint, message string")
    rows = L.log_metrics(L.log_fields(df)).orderBy("record_id").collect()
    assert [r.log_level for r in rows] == levels[:-1] + [None]
    assert [r.duplicates_removed for r in rows] == [2] * 6 + [None]


def test_long_record_is_one_record(spark, tmp):
    body = "x\n" * 3 + "2025-06-26 12:00:00,000 - s - INFO - big\n" + "".join(
        f"row {i:05d}\n" for i in range(1202)) + "2025-06-26 12:00:05,000 - s - INFO - next\n"
    with open(f"{tmp}/cap.log", "w") as f:
        f.write(body)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        lines = L.log_lines(spark, f"{tmp}/cap.log")
        assert lines.rdd.getNumPartitions() > 3
        recs = L.log_records(lines).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(r.message.count("\n") + 1 for r in recs) == [1, 3, 1203]
    big = max(recs, key=lambda r: len(r.message)).message
    assert big.split("\n")[1:] == [f"row {i:05d}" for i in range(1202)]


def test_log_jobs(spark, tmp):
    from clickseg.plans import jobs

    os.makedirs(f"{tmp}/logs")
    with open(f"{tmp}/logs/a.log", "w") as f:
        f.write(LOG)
    out = jobs.log_metrics_job(spark, f"{tmp}/logs", f"{tmp}/daily")
    assert _totals(out.collect()) == [(0, 5), (3, 7)]
    queries = jobs.start_log_streams(spark, f"{tmp}/logs", f"{tmp}/sdaily", f"{tmp}/ck",
                                     records_dir=f"{tmp}/recs", trigger={"availableNow": True})
    for q in queries:
        q.awaitTermination()
    assert _totals(spark.read.parquet(f"{tmp}/sdaily").collect()) == [(0, 5), (3, 7)]
    recs = spark.read.parquet(f"{tmp}/recs")
    assert recs.count() == 7 and recs.select("record_id").distinct().count() == 4


def test_two_level_sessions_equal_one_level(spark, tmp):
    # sessions that span file splits, gaps just under / at / over 60 s
    secs, t = [], 0
    for i in range(2400):
        t += (1, 59, 60, 61, 5, 120)[i % 6]
        secs.append(t)
    t0 = dt.datetime(2025, 6, 26, 12)
    body = "".join(
        f"{(t0 + dt.timedelta(seconds=s)):%Y-%m-%d %H:%M:%S},000 - s - INFO - "
        f"Doublons supprimés : {i % 7}\nmore\n" for i, s in enumerate(secs))
    with open(f"{tmp}/s.log", "w") as f:
        f.write(body)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        lines = L.log_lines(spark, f"{tmp}/s.log")
        assert lines.rdd.getNumPartitions() > 8
        metrics = L.log_normalize(L.log_metrics(L.log_fields(L.record_heads(lines))))
        two = L.log_sessions(metrics)
        one = L.log_sessions(metrics.drop("block"))
        a = sorted(tuple(r) for r in two.collect())
        b = sorted(tuple(r) for r in one.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert a == b and len(a) > 100
    assert sum(r[-1] for r in a) == 2400
