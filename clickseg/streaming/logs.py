"""Pipeline metrics from the jobs' own log files (L1-L8), batch or streaming.

Records: a record starts with ``yyyy-MM-dd HH:mm:ss,SSS``; other lines continue
the record before them.  Fields: time, millis, source, level and the message
of the record's first line (the layout pattern's last field does not cross a
line break).  Metrics: four integers parsed from that message.  Sessions: per
log file, records closer than 60 s form one session whose metrics are summed.

Because every field comes from a record's first line, the session totals are
computed from record-start lines alone.  Full multi-line records (L1) are
assembled split by split for whoever needs the text.  A stream reads closed
files, each whole in one micro-batch, and runs the batch form on them.
"""

from __future__ import annotations

import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickseg.session import broadcast_if_small, delete_paths, materialize, released

# Fixed values that must equal the reference's: the record-start pattern, the
# record layout, the four metric messages, the session gap and the session limit.
RECORD_START = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2},\d{3}"
# Log levels of the layout pattern: each may be all upper case or have a lower-case tail.
LEVEL = "|".join(rf"{w}|[{w[0]}{w[0].lower()}]{w[1:].lower()}" for w in (
    "ALERT", "TRACE", "DEBUG", "NOTICE", "INFORMATION", "INFO", "INF", "WARNING", "WARN", "WAR", "ERROR", "ERR", "ER",
    "CRITICAL", "CRIT", "CRI", "FATAL", "SEVERE", "EMERGENCY", "EMERG"))
RECORD = (r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}),(\d+) - (.*?) - "
          rf"({LEVEL}) - (.*)")
METRICS = [
    ("valid_parquet_files", r"([+-]?\d+) fichiers Parquet valides détectés"),
    ("initial_records", r"Nombre initial d'enregistrements : ([+-]?\d+)"),
    ("duplicates_removed", r"Doublons supprimés : ([+-]?\d+)"),
    ("final_records", r"Nombre final d'enregistrements : ([+-]?\d+)"),
]
SESSION_GAP = "60 seconds"
SESSION_LIMIT_S = 120

COMMIT_SCHEMA = ("path string, session_start timestamp, session_end timestamp, "
                 + ", ".join(f"total_{name} bigint" for name, _ in METRICS)
                 + ", records bigint, day string, doc_id string, version bigint, commit string")


def log_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the log files with their file, split start and order in the split.

    ``monotonically_increasing_id`` is taken on the scan itself, so within one
    split it follows the file order; splits of a file are ordered by their
    start offset.
    """
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line_id"),
        F.col("value").alias("line"))


def record_heads(lines: DataFrame) -> DataFrame:
    """First line of every record (``message`` = the line): all the fields need."""
    heads = lines.filter(F.col("line").rlike(RECORD_START))
    rid = F.col("line_id") if "line_id" in lines.columns else F.lit(None).cast("bigint")
    block = [F.col("block")] if "block" in lines.columns else []
    return heads.select("path", *block, rid.alias("record_id"), F.col("line").alias("message"))


def log_record_lines(lines: DataFrame) -> DataFrame:
    """L1: every line with its record: ``path, record_id, line_id, line``.

    Works split by split, never gathering a file or a record into one task:
    inside a split a line belongs to the latest record start at or before it;
    lines ahead of the first start of a split continue the record left open by
    earlier splits, found in a table with one row per split.  Lines before the
    first record of a file form a record of their own (id -1).  A record may
    have any number of lines; ``line_id`` orders them.
    """
    starts = F.col("line").rlike(RECORD_START)
    split_w = Window.partitionBy("path", "block")
    tagged = lines.withColumn("_start", F.max(F.when(starts, F.col("line_id"))).over(
        split_w.orderBy("line_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    per_split = lines.groupBy("path", "block").agg(F.max(F.when(starts, F.col("line_id"))).alias("_last"))
    order = Window.partitionBy("path").orderBy("block")
    carry = per_split.select("path", "block", F.last("_last", ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, -1)).alias("_carry"))
    return tagged.join(broadcast_if_small(carry), ["path", "block"], "left").select(
        "path", F.coalesce("_start", "_carry", F.lit(-1)).alias("record_id"), "line_id", "line")


def log_records(lines: DataFrame) -> DataFrame:
    """L1 as texts: one row per record, ``path, record_id, message`` with the lines joined.

    A record's lines meet in one task here, which whoever needs the joined text
    accepts; :func:`log_record_lines` has the same records without that.
    """
    grouped = log_record_lines(lines).groupBy("path", "record_id").agg(
        F.array_sort(F.collect_list(F.struct("line_id", "line"))).alias("_ls"))
    return grouped.select("path", "record_id", F.array_join(
        F.transform("_ls", lambda x: x["line"]), "\n").alias("message"))


def log_time(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss,SSS`` read as UTC (independent of the session zone).

    An unparsable time gives NULL (the record is kept, like a date-parse
    failure tag), never a failed job.
    """
    return F.try_to_timestamp(F.concat(text, F.lit("Z")), F.lit("yyyy-MM-dd HH:mm:ss,SSSX"))


def log_fields(records: DataFrame) -> DataFrame:
    """L2 + L5: time, millis, source, level, log_message; non-matching records kept with NULLs.

    ``log_message`` is the rest of the record's first line.
    """
    def part(i: int) -> Column:
        v = F.regexp_extract("message", RECORD, i)
        return F.when(v != "", v)

    return records.select(
        "*",
        log_time(F.concat(part(1), F.lit(","), part(2))).alias("ts"),
        part(2).try_cast("int").alias("millis"),
        part(3).alias("source"),
        part(4).alias("log_level"),
        part(5).alias("log_message"))


def log_metrics(fields: DataFrame) -> DataFrame:
    """L3: the four integer metrics parsed from ``log_message`` (NULL when absent)."""
    cols = {name: F.when(F.col("log_message").rlike(rx),
                         F.regexp_extract("log_message", rx, 1).try_cast("int"))
            for name, rx in METRICS}
    return fields.withColumns(cols)


def log_normalize(df: DataFrame) -> DataFrame:
    """tabs/newlines and whitespace runs -> one blank; drop helper fields."""
    msg = F.regexp_replace(F.regexp_replace("log_message", r"[\n\t]", " "), r"\s+", " ")
    return df.withColumn("log_message", msg).drop("message", "millis", "record_id")


def _gap_sessions(heads: DataFrame, gap: str) -> DataFrame:
    """``path, start, end`` of runs of records less than ``gap`` apart.

    Two levels, so one huge log file is not one task's work: sessions inside
    each file split first, then the partial sessions of a file, each entering
    ``session_window`` as one event whose dynamic gap spans it exactly.  That
    function joins events exactly its gap apart, so it gets a microsecond less:
    ``end`` is the last record's time plus ``gap`` less a microsecond.
    """
    gap = f"{gap} -1 microseconds"

    def runs(df, keys, ts, gap, n):
        return df.groupBy(*keys, F.session_window(ts, gap).alias("s")).agg(n.alias("n")).select(
            *keys, F.col("s.start").alias("start"), F.col("s.end").alias("end"), "n")

    if "block" in heads.columns:
        heads = runs(heads, ["path", "block"], F.col("ts"), gap, F.count(F.lit(1))).withColumnRenamed("start", "ts")
        span = F.unix_micros("end") - F.unix_micros("ts")
        gap = F.make_interval(secs=(span / F.lit(1_000_000)).cast("decimal(18,6)"))
        # The count is asked for so that the optimizer keeps the first level.
        return runs(heads, ["path"], F.col("ts"), gap, F.sum("n")).filter("n > 0")
    return runs(heads, ["path"], F.col("ts"), gap, F.count(F.lit(1)))


def _hour(micros: Column) -> Column:
    return F.floor(micros / F.lit(3_600_000_000))


def _next_openings(times: DataFrame, gap: str, limit_us: int) -> DataFrame:
    """``path, _s, t, nxt``: for each time of a run its first time at or after ``t + limit``.

    Inside a run that time is less than ``gap`` later, so hour by hour one
    backward pass over the hour's times and the limits that fall into it finds
    it; the times of the next hour's first ``gap`` take part too.
    """
    none = F.lit(None).cast("bigint")
    early = _hour(F.unix_micros(F.timestamp_micros("t") - F.expr(f"INTERVAL {gap}")))
    known = times.select("path", "_s", F.explode(F.sequence(early, _hour(F.col("t")))).alias("_h"), F.col("t").alias("_v"),
                         F.col("t").alias("_at"), none.alias("t"))
    asked = times.select("path", "_s", _hour(F.col("t") + limit_us).alias("_h"), (F.col("t") + limit_us).alias("_v"),
                         none.alias("_at"), "t")
    backward = Window.partitionBy("path", "_s", "_h").orderBy(F.desc("_v"), F.asc_nulls_last("_at"))
    found = known.unionByName(asked).withColumn("nxt", F.last("_at", ignorenulls=True).over(
        backward.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return found.filter(F.col("t").isNotNull() & F.col("nxt").isNotNull()).select("path", "_s", "t", "nxt")


def _openings(runs: DataFrame, times: DataFrame, gap: str, limit_s: int, hops: int) -> DataFrame:
    """``path, _s, _o, _e``: the sessions inside runs that last ``limit_s`` or longer.

    A session opens at the run's start and at the next opening of each opening;
    after ``i`` rounds of doubled pointers all openings up to ``2**i`` hops from
    the start are known, so a run of any length takes as many joins as its
    number of sessions has bits, each keyed by single times.
    """
    nexts = jump = materialize(_next_openings(times, gap, limit_s * 1_000_000))
    opens = runs.select("path", "_s", F.unix_micros("_s").alias("t"))
    rounds = hops.bit_length()
    for i in range(rounds):
        opens = opens.join(jump, ["path", "_s", "t"], "left").select(
            "path", "_s", F.explode(F.array_compact(F.array("t", "nxt"))).alias("t"))
        if i + 1 < rounds:
            onward = jump.select("path", "_s", F.col("t").alias("nxt"), F.col("nxt").alias("_onward"))
            jump = materialize(jump.join(onward, ["path", "_s", "nxt"]).select("path", "_s", "t", F.col("_onward").alias("nxt")))
    return opens.join(nexts, ["path", "_s", "t"], "left").join(runs, ["path", "_s"]).select(
        "path", "_s", F.col("t").alias("_o"), F.coalesce("nxt", F.unix_micros("_e")).alias("_e"))


def log_sessions(metrics: DataFrame, gap: str = SESSION_GAP, limit_s: int = SESSION_LIMIT_S) -> DataFrame:
    """L4 + L7: per log file, sessions of records less than ``gap`` apart, with totals.

    A session also ends ``limit_s`` seconds after its first record; the next
    record opens another.  Those cuts depend on the times alone and are found by
    pointer doubling over the distinct times, so a file without a pause is spread
    like any other.  One small job asks for the longest run first; without a run
    of ``limit_s`` there is nothing to cut.
    """
    totals = [f"total_{name}" for name, _ in METRICS]
    sums = [F.sum(F.coalesce(F.col(name), F.lit(0))).alias(f"total_{name}") for name, _ in METRICS]
    heads = metrics.filter(F.col("ts").isNotNull())
    limit_us = limit_s * 1_000_000
    lasts = F.unix_micros(F.col("end") - F.expr(f"INTERVAL {gap}")) + 1 - F.unix_micros("start")
    runs = materialize(_gap_sessions(heads, gap).select(
        "path", F.col("start").alias("_s"), F.col("end").alias("_e"), lasts.alias("_lasts")))
    # Totals per file and time: one row per distinct time, however many records.
    per_time = heads.groupBy("path", F.unix_micros("ts").alias("t")).agg(*sums, F.count(F.lit(1)).alias("records"))
    # Times meet the runs of their hour: a long log file is spread over its hours.
    spans = runs.select("path", "_s", "_e", "_lasts",
                        F.explode(F.sequence(_hour(F.unix_micros("_s")), _hour(F.unix_micros("_e")))).alias("_h"))
    tagged = per_time.withColumn("_h", _hour(F.col("t"))).join(spans, ["path", "_h"]).filter(
        (F.col("t") >= F.unix_micros("_s")) & (F.col("t") < F.unix_micros("_e"))).drop("_h", "_e")
    hops = (runs.agg(F.max("_lasts")).first()[0] or 0) // limit_us
    found = tagged.withColumn("_o", F.unix_micros("_s"))
    if hops:
        tagged = materialize(tagged)
        long_runs = runs.filter(F.col("_lasts") >= limit_us).select("path", "_s", "_e")
        times = tagged.filter(F.col("_lasts") >= limit_us)
        opened = _openings(long_runs, times.select("path", "_s", "t"), gap, limit_s, hops)
        # A session is shorter than limit and gap, so it lies in a few buckets of one limit each.
        bucket = lambda c: F.floor(c / F.lit(limit_us))
        opened = opened.withColumn("_b", F.explode(F.sequence(bucket(F.col("_o")), bucket(F.col("_e") - 1))))
        cuts = times.withColumn("_b", bucket(F.col("t"))).join(opened, ["path", "_s", "_b"]).filter(
            (F.col("t") >= F.col("_o")) & (F.col("t") < F.col("_e")))
        columns = ["path", "_o", "t", *totals, "records"]
        found = tagged.filter(F.col("_lasts") < limit_us).withColumn("_o", F.unix_micros("_s")).select(*columns).unionByName(
            cuts.select(*columns))
    out = found.groupBy("path", "_o").agg(*[F.sum(t).alias(t) for t in totals], F.sum("records").alias("records"),
                                          F.max("t").alias("_last"))
    return out.select("path", F.timestamp_micros("_o").alias("session_start"),
                      (F.timestamp_micros("_last") + F.expr(f"INTERVAL {gap}")).alias("session_end"), *totals, "records")


def log_pipeline(lines: DataFrame) -> DataFrame:
    """L2-L7 on batch lines: record heads -> fields -> metrics -> normalized -> session totals."""
    return log_sessions(log_normalize(log_metrics(log_fields(record_heads(lines)))))


def with_day_and_id(sessions: DataFrame) -> DataFrame:
    """L8 keys: ``day`` partition and document id ``path-time``."""
    return sessions.withColumns({
        "day": F.date_format("session_start", "yyyy.MM.dd"),
        "doc_id": F.concat(F.col("path"), F.lit("-"),
                           F.date_format("session_start", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")),
    })


def daily_sink(out_dir: str):
    """A ``foreachBatch`` writer, one folder per day, upserted by document id.

    The days of the batch are read back, rows with the same ``doc_id`` are
    replaced, the others kept, and only those days are written again (dynamic
    partition overwrite).  A retried batch, a second log folder or another
    stream therefore never erases other sessions.  The rows are staged as files
    beside the days before these are replaced, so that a lost executor reads them
    again from there.  One writer at a time: :func:`commit_sink` takes several.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with released():
            new = materialize(with_day_and_id(batch).dropDuplicates(["doc_id"]))
            days = [r.day for r in new.select("day").distinct().collect()]  # a few days per batch
            if not days:
                return
            rows = new
            try:
                old = spark.read.schema(new.schema).parquet(out_dir).filter(F.col("day").isin(days))
                rows = new.unionByName(old.join(new.select("doc_id"), "doc_id", "left_anti").select(*new.columns))
            except AnalysisException as e:
                if e.getCondition() != "PATH_NOT_FOUND":
                    raise
            staged = f"{out_dir.rstrip('/')}/_staged-{uuid.uuid4().hex}"
            rows.write.parquet(staged)
        (spark.read.schema(new.schema).parquet(staged).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("day").parquet(out_dir))
        delete_paths(spark, [staged])
    return write


def commit_sink(out_dir: str):
    """L8 for several writers at once: a ``foreachBatch`` writer of commits that nobody replaces.

    Each batch becomes a folder ``commit=<id>/day=<day>`` of its own, valid from
    the moment its ``_SUCCESS`` file appears; :func:`read_daily` takes the newest
    row of each document.  Writers never touch each other's files, a batch that
    is written twice changes nothing, and a batch that broke off is never read.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = with_day_and_id(batch).dropDuplicates(["doc_id"]).withColumn("version", F.lit(time.time_ns()))
        rows.write.partitionBy("day").parquet(f"{out_dir.rstrip('/')}/commit={uuid.uuid4().hex}")
    return write


def _commits(spark: SparkSession, out_dir: str) -> list[str]:
    """Folders of the finished commits: names only, a folder per batch since the last compaction."""
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    done = fs_path(f"{out_dir.rstrip('/')}/commit=*/_SUCCESS")
    found = done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(done)
    return sorted(f.getPath().getParent().toString() for f in found or [])


def _newest(spark: SparkSession, out_dir: str, commits: list[str]) -> DataFrame:
    rows = spark.read.option("basePath", out_dir).schema(COMMIT_SCHEMA).parquet(*commits)
    rest = [c for c in rows.columns if c not in ("day", "doc_id", "version", "commit")]
    newest = rows.groupBy("day", "doc_id").agg(F.max(F.struct("version", "commit", *rest)).alias("_r"))
    return newest.select(*[F.col(f"_r.{c}").alias(c) for c in rest], "day", "doc_id", F.col("_r.version").alias("version"))


def read_daily(spark: SparkSession, out_dir: str) -> DataFrame:
    """The sessions under ``out_dir`` as :func:`commit_sink` left them: the newest row of each
    document among the finished commits.  A filter on ``day`` reads that day's folders only."""
    commits = _commits(spark, out_dir)
    if not commits:
        return spark.createDataFrame([], COMMIT_SCHEMA).drop("version", "commit")
    return _newest(spark, out_dir, commits).drop("version")


def compact_daily(spark: SparkSession, out_dir: str) -> int:
    """Merge the finished commits into one and delete them; returns how many there were.

    Rows keep their versions, so writers may go on meanwhile, and a compaction that
    breaks off leaves rows twice at worst, which the reader merges.  A reader that
    planned before the deletion has to read again.
    """
    commits = _commits(spark, out_dir)
    if len(commits) > 1:
        merged = _newest(spark, out_dir, commits)
        merged.write.partitionBy("day").parquet(f"{out_dir.rstrip('/')}/commit={uuid.uuid4().hex}")
        delete_paths(spark, commits)
    return len(commits)


def stream_lines(spark: SparkSession, path: str, max_files_per_trigger: int | None = None
                 ) -> DataFrame:
    """Lines of newly arrived log files, with file and split (no order id).

    A file source reads each file once, whole, in one micro-batch: move closed
    files into the folder.  Lines appended to a file after it was read are not seen.
    """
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").alias("line"))


def sessions_sink(out_dir: str, sink=daily_sink):
    """L4 + L8 on a stream: a ``foreachBatch`` writer of the sessions of the batch's files.

    Sessions never cross files and a micro-batch holds its files whole, so the
    batch form applies: no watermark that drops older files, no session left
    open at the end, and the same totals as the batch job.
    """
    upsert = sink(out_dir)

    def write(batch: DataFrame, batch_id: int) -> None:
        with released():
            upsert(log_pipeline(batch), batch_id)
    return write


def records_sink(records_dir: str):
    """L1 on a stream: a ``foreachBatch`` writer of the lines with their records.

    Output goes to ``batch=<id>`` with dynamic overwrite, so a retried batch
    replaces its own records.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        lines = batch.withColumn("line_id", F.monotonically_increasing_id())
        (log_record_lines(lines).withColumn("batch", F.lit(batch_id))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch").parquet(records_dir))
    return write
