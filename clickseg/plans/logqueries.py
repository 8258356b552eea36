"""Registered log queries (L1-L7) on log lines rendered from the ``events`` table.

Every event becomes one record (two lines where its id divides by 6) of the log
file of its user's group; times run 60 times faster than the events, so that
sessions of all lengths occur.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickseg.streaming import logs as LG

T0 = "2024-01-01 00:00:00"
LEVELS = ["INFO", "info", "SEVERE", "WARNING", "nonsense", "ALERT", "Error"]

# Times in milliseconds since T0 and the message, in SQL text that both engines read.
MESSAGE = """CASE event_id % 5
  WHEN 0 THEN concat(CAST(event_id % 97 AS {s}), ' fichiers Parquet valides détectés')
  WHEN 1 THEN concat('Nombre initial d''enregistrements : ', CAST(event_id % 89 AS {s}))
  WHEN 2 THEN concat('Doublons supprimés : ', CAST(event_id % 83 AS {s}))
  WHEN 3 THEN concat('Nombre final d''enregistrements : ', CAST(event_id % 79 AS {s}))
  ELSE concat('autre   ', event_type) END"""


def rendered(spark: SparkSession, sf: str) -> DataFrame:
    """``path, block, line_id, line`` as :func:`clickseg.streaming.logs.log_lines` gives them."""
    e = spark.read.parquet(f"{sf}/events.parquet")
    ms = F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ '{T0}', ts) DIV 60000")
    e = e.withColumn("ms", ms).withColumn("at", F.expr(
        f"TIMESTAMP_NTZ '{T0}' + make_dt_interval(0, 0, 0, CAST(ms AS DECIMAL(18,6)) / 1000)"))
    level = F.element_at(F.array(*[F.lit(x) for x in LEVELS]), (F.col("event_id") % len(LEVELS) + 1).cast("int"))
    head = F.concat(F.date_format("at", "yyyy-MM-dd HH:mm:ss,SSS"), F.lit(" - src.m"), (F.col("event_id") % 3).cast("string"),
                    F.lit(" - "), level, F.lit(" - "), F.expr(MESSAGE.format(s="STRING")))
    tail = F.when(F.col("event_id") % 6 == 0, F.array(head, F.lit("continued"))).otherwise(F.array(head))
    return e.select(F.concat(F.lit("job-"), (F.col("user_id") % 16).cast("string")).alias("path"),
                    (F.col("event_id") % 4).alias("block"), (F.col("event_id") * 2).alias("first"),
                    F.posexplode(tail).alias("i", "line")).select(
        "path", "block", (F.col("first") + F.col("i")).alias("line_id"), "line")


def log_records(spark: SparkSession, sf: str) -> DataFrame:
    """L1: records with their number of lines and joined text."""
    return LG.log_records(rendered(spark, sf)).select(
        "path", "record_id", (F.length("message") - F.length(F.replace("message", F.lit("\n"), F.lit(""))) + 1)
        .cast("int").alias("n_lines"), "message")


def log_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Time, source, level, normalized message and the four metrics."""
    heads = LG.record_heads(rendered(spark, sf))
    f = LG.log_metrics(LG.log_fields(heads)).withColumn("record", F.col("record_id"))
    return LG.log_normalize(f).select(
        "path", F.col("record").alias("record_id"), F.unix_millis("ts").alias("ts_ms"), "source", "log_level", "log_message",
        *[name for name, _ in LG.METRICS])


def log_sessions(spark: SparkSession, sf: str) -> DataFrame:
    """Session totals per file."""
    return LG.log_pipeline(rendered(spark, sf)).select(
        "path", F.unix_millis("session_start").alias("start_ms"),
        *[F.col(f"total_{name}").cast("long").alias(f"total_{name}") for name, _ in LG.METRICS], "records")


_BASE = f"""
WITH e AS (
  SELECT event_id, event_type, concat('job-', CAST(user_id % 16 AS VARCHAR)) AS path,
         date_diff('microsecond', TIMESTAMP '{T0}', ts) // 60000 AS ms,
         concat('src.m', CAST(event_id % 3 AS VARCHAR)) AS source,
         ([{', '.join(f"'{x}'" for x in LEVELS)}])[event_id % {len(LEVELS)} + 1] AS level,
         {MESSAGE.format(s='VARCHAR')} AS message
  FROM events),
t AS (SELECT *, TIMESTAMP '{T0}' + to_milliseconds(ms) AS tm, epoch_ms(TIMESTAMP '{T0}') + ms AS ts_ms,
             level <> 'nonsense' AS known FROM e),
m AS (SELECT *,
  CASE WHEN known AND event_id % 5 = 0 THEN CAST(event_id % 97 AS INTEGER) END AS valid_parquet_files,
  CASE WHEN known AND event_id % 5 = 1 THEN CAST(event_id % 89 AS INTEGER) END AS initial_records,
  CASE WHEN known AND event_id % 5 = 2 THEN CAST(event_id % 83 AS INTEGER) END AS duplicates_removed,
  CASE WHEN known AND event_id % 5 = 3 THEN CAST(event_id % 79 AS INTEGER) END AS final_records FROM t)
"""
_NAMES = [name for name, _ in LG.METRICS]

SQL = {
    "log_records": _BASE + """
SELECT path, event_id * 2 AS record_id, CAST(CASE WHEN event_id % 6 = 0 THEN 2 ELSE 1 END AS INTEGER) AS n_lines,
       concat(strftime(tm, '%Y-%m-%d %H:%M:%S'), ',', lpad(CAST(ms % 1000 AS VARCHAR), 3, '0'), ' - ', source, ' - ', level,
              ' - ', message, CASE WHEN event_id % 6 = 0 THEN concat(chr(10), 'continued') ELSE '' END) AS message
FROM t""",
    "log_fields": _BASE + f"""
SELECT path, event_id * 2 AS record_id, CASE WHEN known THEN ts_ms END AS ts_ms, CASE WHEN known THEN source END AS source,
       CASE WHEN known THEN level END AS log_level,
       CASE WHEN known THEN regexp_replace(message, '\\s+', ' ', 'g') END AS log_message, {', '.join(_NAMES)}
FROM m""",
    # The k-th session of a file opens at the first record 60 s after the one before it or
    # 120 s after the session's own first record: followed record by record.
    "log_sessions": _BASE.replace("WITH e AS", "WITH RECURSIVE e AS") + f""",
p AS (SELECT path, ts_ms, {', '.join(f'coalesce(sum({n}), 0) AS {n}' for n in _NAMES)}, count(*) AS records
      FROM m WHERE known GROUP BY path, ts_ms),
r AS (SELECT *, row_number() OVER (PARTITION BY path ORDER BY ts_ms) AS i FROM p),
w AS (SELECT path, i, ts_ms, ts_ms AS start_ms FROM r WHERE i = 1
      UNION ALL
      SELECT r.path, r.i, r.ts_ms,
             CASE WHEN r.ts_ms - w.ts_ms >= 60000 OR r.ts_ms - w.start_ms >= 120000 THEN r.ts_ms ELSE w.start_ms END
      FROM w JOIN r ON r.path = w.path AND r.i = w.i + 1)
SELECT r.path, w.start_ms, {', '.join(f'CAST(sum({n}) AS BIGINT) AS total_{n}' for n in _NAMES)},
       CAST(sum(records) AS BIGINT) AS records
FROM r JOIN w ON r.path = w.path AND r.i = w.i GROUP BY r.path, w.start_ms""",
}


def log_queries() -> dict:
    return {"log_records": log_records, "log_fields": log_fields, "log_sessions": log_sessions}
