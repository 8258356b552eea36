"""Hot-key check: one user holds a third of all events.

usage: python tools/skew_check.py [sf_dir]

Derives a skewed copy of the driver's events (every third event re-assigned to
user 0), runs the cleaning chain and the buyer features on it with Spark's
event log in a scratch folder, and prints, per stage, the largest shuffle
read of any task next to the total.  With map-side combining the task that
owns the hot user reads a handful of rows.  The features are also compared
with DuckDB on the same skewed rows.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from clickseg.operators import features as FE  # noqa: E402
from clickseg.plans import catalog, oracle  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    scratch = tempfile.mkdtemp(prefix="skew-", dir="/tmp")
    os.makedirs(f"{scratch}/events")
    spark = (SparkSession.builder.master("local[8]").appName("skew")
             .config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "16")
             # per-task reads should show the hash layout, not AQE merging small partitions
             .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.eventLog.enabled", "true")
             .config("spark.eventLog.dir", f"{scratch}/events")
             .config("spark.eventLog.compress", "false")
             .config("spark.checkpoint.dir", f"{scratch}/ckpt")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")

    # Skewed inputs derived from the driver tables: user 0 owns every third event.
    events = spark.read.parquet(f"{sf}/events.parquet")
    hot = events.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0))
                            .otherwise(F.col("user_id")))
    os.makedirs(f"{scratch}/tables", exist_ok=True)
    hot.write.parquet(f"{scratch}/tables/events.parquet")
    spark.read.parquet(f"{sf}/part.parquet").write.parquet(f"{scratch}/tables/part.parquet")
    tables = f"{scratch}/tables"

    spark.sparkContext.setJobGroup("features", "features")
    feats = FE.features(catalog.cleaned(spark, tables))
    rows = feats.collect()
    spark.stop()

    # Per stage: the largest shuffle read of one task, and the stage total.
    stages: dict[int, list[int]] = {}
    for log in sorted(glob.glob(f"{scratch}/events/**/*", recursive=True)):
        if os.path.isdir(log) or "appstatus" in os.path.basename(log):
            continue
        with open(log) as f:
            for line in f:
                e = json.loads(line)
                if e.get("Event") == "SparkListenerTaskEnd" and e.get("Task Metrics"):
                    r = e["Task Metrics"].get("Shuffle Read Metrics", {})
                    n = r.get("Total Records Read", 0)
                    if n:
                        stages.setdefault(e["Stage ID"], []).append(n)
    print("stage  tasks  max_records_one_task  total_records")
    for sid in sorted(stages):
        recs = stages[sid]
        print(f"{sid:5d}  {len(recs):5d}  {max(recs):20d}  {sum(recs):13d}")

    con = duckdb.connect()
    for t in ("events", "part"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tables}/{t}.parquet')")
    sql = oracle.features_sql()["features"]
    want = sorted(tuple(r) for r in con.sql(sql).fetchall())
    got = sorted(tuple(r) for r in rows)
    hot_user = max(got, key=lambda r: r[5] + r[6] + r[7])
    hot_events = hot_user[5] + hot_user[6] + hot_user[7]
    print(f"buyers {len(got)}; hot buyer events {hot_events}+; "
          f"features equal to DuckDB: {got == want}")
    print(json.dumps({"equal": got == want, "hot_events": hot_events,
                      "max_task_reads": {str(k): max(v) for k, v in stages.items()}}))


if __name__ == "__main__":
    main()
