"""Benchmark: the headline jobs at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: total seconds, seconds per query and Spark jobs per
query.  Every query runs over the whole tables; results are consumed by the
``noop`` sink (full execution, nothing collected).
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from clickseg.operators import clustering as CU  # noqa: E402
from clickseg.operators import quality as QU  # noqa: E402
from clickseg.plans import catalog, jobs  # noqa: E402
from clickseg.session import build_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def _sf(path: str) -> float | str:
    m = re.search(r"sf([0-9.]+)", path)
    return float(m.group(1)) if m else path


def main() -> None:
    scratch = tempfile.mkdtemp(prefix="bench-", dir="/tmp")
    spark = build_session(master=f"local[{CPUS}]", shuffle_partitions=int(CPUS) * 2,
                          checkpoint_dir=f"{scratch}/ckpt")
    sc = spark.sparkContext

    def consume(df):
        df.write.format("noop").mode("overwrite").save()

    model = {}

    def segmentation(s, sf):
        res = jobs.segmentation(catalog.cleaned(s, sf))
        consume(res["profiles"])
        model.update({k: (round(v, 4) if isinstance(v, float) else v)
                      for k, v in res["metrics"].items()})

    work = {
        "clean_events": lambda s, sf: consume(catalog.cleaned(s, sf)),
        "features": lambda s, sf: consume(catalog.buyer_features(s, sf)),
        "quality_comparison": lambda s, sf: consume(QU.quality_comparison(
            catalog.file_frame(s, sf), catalog.clean_frame(s, sf))),
        "row_counts": lambda s, sf: consume(QU.row_counts(catalog.raw(s, sf))),
        "k_search": lambda s, sf: consume(CU.k_search(catalog.buyer_features(s, sf))),
        "segmentation": segmentation,
    }
    # Warm-up (JIT, class loading) on the smallest tables; not timed.
    for fn in work.values():
        fn(spark, "/root/testdata/sf0.001")
    spark.catalog.clearCache()

    times, job_counts = {}, {}
    for name, fn in work.items():
        sc.setJobGroup(name, name)
        t0 = time.perf_counter()
        fn(spark, SF_DIR)
        times[name] = round(time.perf_counter() - t0, 3)
        job_counts[name] = len(sc.statusTracker().getJobIdsForGroup(name))
        spark.catalog.clearCache()
    spark.stop()
    print(json.dumps({"metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "jobs": job_counts, "model": model, "sf": _sf(SF_DIR),
                      "cpus": int(CPUS)}))


if __name__ == "__main__":
    main()
