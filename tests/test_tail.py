"""Growing log files: bytes read once, rotation, restart, and sessions closed by record or timer."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from clickseg.streaming import logs as L
from clickseg.streaming import tail as T

T0 = dt.datetime(2025, 6, 26, 12)


def record(seconds, n=1):
    return f"{T0 + dt.timedelta(seconds=seconds):%Y-%m-%d %H:%M:%S},000 - s - INFO - Doublons supprimés : {n}\n"


def append(path, text):
    with open(path, "a") as f:
        f.write(text)


def reader(folder, **options):
    return T.TailReader({"path": folder, **options})


def lines(r, start, end):
    return [(x["path"].rsplit("/")[-1], x["generation"], x["line"]) for s in r.partitions(start, end)
            for b in r.read(s) for x in b.to_pylist()]


def test_appended_lines_are_read_once(tmp):
    r, path = reader(tmp), f"{tmp}/a.log"
    o0 = r.initialOffset()
    append(path, "one\ntwo\nhal")
    append(f"{tmp}/a.txt", "no log\n")
    append(f"{tmp}/empty.log", "")
    o1 = r.latestOffset()
    assert lines(r, o0, o1) == [("a.log", 0, "one"), ("a.log", 0, "two")]
    append(path, "f\r\nthree\n")
    o2 = r.latestOffset()
    assert lines(r, o1, o2) == [("a.log", 0, "half"), ("a.log", 0, "three")]
    o3 = r.latestOffset()
    assert lines(r, o2, o3) == []
    again = reader(tmp)  # restarted: the last batch is read again, then what came since
    assert lines(again, o1, o2) == [("a.log", 0, "half"), ("a.log", 0, "three")]
    append(path, "four\n")
    assert lines(again, o2, again.latestOffset()) == [("a.log", 0, "four")]


@pytest.mark.parametrize("split,budget", [(8, 1 << 20), (1 << 20, 16), (3, 5)])
def test_splits_and_budget_keep_every_line(tmp, split, budget):
    want = [f"line {i} " + "x" * (i % 23) for i in range(40)]
    append(f"{tmp}/a.log", "\n".join(want) + "\n")
    r, at, got = reader(tmp, splitbytes=split, maxbytesperfile=budget), None, []
    at = r.initialOffset()
    for _ in range(200):
        new = r.latestOffset()
        got += [x for _, _, x in lines(r, at, new)]
        if new["files"] == at["files"]:
            break
        at = new
    assert got == want


@pytest.mark.parametrize("how", ["renamed", "truncated"])
def test_rotation(tmp, how):
    r, path = reader(tmp), f"{tmp}/a.log"
    append(path, "one\n")
    o1 = r.latestOffset()
    append(path, "two\n")
    if how == "renamed":
        os.rename(path, f"{path}.1")
    else:
        os.truncate(path, 0)
    append(path, "new\nfile\nwith more\n")
    got = lines(r, o1, r.latestOffset())
    assert got == ([("a.log", 0, "two")] if how == "renamed" else []) + [("a.log", 1, x) for x in ("new", "file", "with more")]


@pytest.fixture()
def rocks(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield spark
    spark.conf.unset(key)


def start(spark, folder, out, check, gap=60, limit=120):
    sessions = T.tail_sessions(T.tail_lines(spark, folder), gap, limit)
    return (sessions.writeStream.outputMode("update").foreachBatch(L.commit_sink(out))
            .option("checkpointLocation", check).trigger(processingTime="1 second").start())


def wait(query, ready, seconds=90):
    end = time.monotonic() + seconds
    while time.monotonic() < end and not ready():
        assert query.exception() is None, query.exception()
        time.sleep(0.5)


def rows(df):
    return sorted((r.path.rsplit("/")[-1], r.session_start, r.session_end, r.total_duplicates_removed, r.records) for r in df.collect())


def test_growing_log_gives_the_batch_sessions(rocks, tmp):
    spark, folder, out = rocks, f"{tmp}/in", f"{tmp}/out"
    os.makedirs(folder)
    append(f"{folder}/a.log", "".join(record(s) for s in (0, 30, 59, 119, 140)))
    query = start(spark, folder, out, f"{tmp}/ck", gap=3, limit=6)
    try:
        wait(query, lambda: L.read_daily(spark, out).count() >= 5)  # each alone, the last one by its timer
        append(f"{folder}/a.log", "".join(record(s, 2) for s in (142, 143)))  # goes on with a session handed out
        append(f"{folder}/b.log", "".join(record(s - 86400) for s in range(0, 20, 2)))  # an older day
        want = lambda: rows(L.log_sessions(L.log_normalize(L.log_metrics(L.log_fields(
            L.record_heads(L.log_lines(spark, folder))))), gap="3 seconds", limit_s=6))
        expected = want()
        wait(query, lambda: rows(L.read_daily(spark, out)) == expected)
        assert rows(L.read_daily(spark, out)) == expected and len(expected) == 5 + 4
    finally:
        query.stop()
    append(f"{folder}/b.log", record(300))
    query = start(spark, folder, out, f"{tmp}/ck", gap=3, limit=6)  # restarted from its checkpoint
    try:
        expected = want()
        wait(query, lambda: rows(L.read_daily(spark, out)) == expected)
        assert rows(L.read_daily(spark, out)) == expected
    finally:
        query.stop()
    assert L.read_daily(spark, out).select(F.sum("records")).first()[0] == 18
