"""Session cuts by pointer doubling, and the sinks of several writers."""

import datetime as dt
import threading

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickseg.streaming import logs as L

T0 = dt.datetime(2025, 6, 26, 12)
METRICS = "path string, ts timestamp, " + ", ".join(f"{n} int" for n, _ in L.METRICS)


def records(spark, seconds: dict):
    rows = [(p, T0 + dt.timedelta(seconds=s), 1, None, None, None) for p, ss in seconds.items() for s in ss]
    return spark.createDataFrame(rows, METRICS)


def followed(seconds, gap=60, limit=120):
    """Openings and record counts, record by record."""
    out, last = [], None
    for s in sorted(seconds):
        if last is None or s - last >= gap or s - out[-1][0] >= limit:
            out.append([s, 0])
        out[-1][1] += 1
        last = s
    return sorted(map(tuple, out))


def found(df):
    out = {}
    for r in df.collect():
        assert r.total_valid_parquet_files == r.records
        out.setdefault(r.path, []).append(((r.session_start - T0).total_seconds(), r.records))
    return {p: sorted(v) for p, v in out.items()}


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from([0, 0.5, 1, 30, 59, 59.999, 60, 61, 119, 120]), min_size=1, max_size=60),
                min_size=1, max_size=3))
def test_cuts_as_followed_record_by_record(spark, steps):
    seconds = {}
    for i, gaps in enumerate(steps):
        at, times = 3500.0, []  # around the change of the hour
        for g in gaps:
            at = round(at + g, 3)
            times.append(at)
        seconds[f"p{i}"] = times
    assert found(L.log_sessions(records(spark, seconds))) == {p: followed(s) for p, s in seconds.items()}


def test_no_records(spark):
    assert L.log_sessions(records(spark, {})).count() == 0


def test_long_file_without_pause(spark):
    n = 100_000
    heads = spark.range(n).select(
        F.lit("p").alias("path"), F.timestamp_seconds(F.col("id") + 1_700_000_000).alias("ts"), F.lit(1).alias(L.METRICS[0][0]),
        *[F.lit(None).cast("int").alias(name) for name, _ in L.METRICS[1:]])
    out = L.log_sessions(heads)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan
    got = out.agg(F.count("*"), F.sum("records"), F.max("records"), F.min(F.unix_seconds("session_start")),
                  F.max(F.unix_seconds("session_start"))).first()
    assert tuple(got) == (-(-n // 120), n, 120, 1_700_000_000, 1_700_000_000 + (n - 1) // 120 * 120)


def test_next_openings_meet_by_hours(spark):
    """The window that finds the next opening never holds more than an hour and a gap of a run."""
    times = spark.range(20_000).select(F.lit("p").alias("path"), F.timestamp_seconds(F.lit(0)).alias("_s"),
                                       (F.col("id") * 1_000_000).alias("t"))
    nexts = L._next_openings(times, "60 seconds", 120_000_000)
    assert nexts.count() == 20_000 - 120 and nexts.filter("nxt - t != 120000000").count() == 0
    assert "_h" in nexts._jdf.queryExecution().optimizedPlan().toString().split("Window [")[1].split("]", 2)[1]


def sessions(spark, totals: dict):
    rows = [(p, T0 + dt.timedelta(seconds=60 * i), v, 1) for i, (p, v) in enumerate(sorted(totals.items()))]
    df = spark.createDataFrame(rows, "path string, session_start timestamp, v long, records long")
    return df.select("path", "session_start", F.col("session_start").alias("session_end"),
                     *[F.col("v").alias(f"total_{n}") for n, _ in L.METRICS], "records")


def test_two_writers_on_one_day_lose_nothing(spark, tmp):
    out, errors = f"{tmp}/commits", []

    def writer(name):
        try:
            for i in range(3):
                L.commit_sink(out)(sessions(spark, {f"{name}{i}": i}), i)
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=writer, args=(n,)) for n in "ab"]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not errors
    assert sorted(r.path for r in L.read_daily(spark, out).collect()) == ["a0", "a1", "a2", "b0", "b1", "b2"]


def test_newest_row_wins_and_compaction_keeps_rows(spark, tmp):
    out = f"{tmp}/commits"
    assert L.read_daily(spark, out).count() == 0
    sink = L.commit_sink(out)
    sink(sessions(spark, {"a": 1, "b": 2}), 0)
    sink(sessions(spark, {"a": 5, "b": 2}), 1)
    sink(sessions(spark, {"a": 5, "b": 2}), 1)  # a batch written twice
    spark.range(1).write.parquet(f"{out}/commit=broken/day=2025.06.26")
    state = lambda: sorted((r.path, r.total_final_records, r.day) for r in L.read_daily(spark, out).collect())
    want = [("a", 5, "2025.06.26"), ("b", 2, "2025.06.26")]
    assert state() == want
    assert L.compact_daily(spark, out) == 3 and state() == want and L.compact_daily(spark, out) == 1


def test_no_cached_frame_after_a_sink(spark, tmp):
    kept = len(spark.sparkContext._jsc.getPersistentRDDs())
    lines = spark.createDataFrame([("p", 0, f"2025-06-26 12:{m:02d}:{s:02d},000 - s - INFO - Doublons supprimés : 1")
                                   for m in range(5) for s in (0, 30)], "path string, block long, line string")
    L.sessions_sink(f"{tmp}/daily")(lines, 0)
    L.sessions_sink(f"{tmp}/commits", L.commit_sink)(lines, 0)
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == kept
    plain = spark.read.parquet(f"{tmp}/daily").select("doc_id", "records")
    assert sorted(plain.collect()) == sorted(L.read_daily(spark, f"{tmp}/commits").select("doc_id", "records").collect())
