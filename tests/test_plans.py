"""Plan shape: the scale properties the design relies on, checked on the physical plans."""

import re

from clickseg.operators import cleaning as CL
from clickseg.operators import features as FE
from clickseg.operators import quality as QU
from clickseg.plans import catalog
from clickseg.streaming import logs as L
from conftest import SF


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _exchanges(plan: str) -> list[str]:
    return [l for l in plan.splitlines() if "Exchange hashpartitioning" in l]


def test_cleaning_chain_has_one_shuffle_and_broadcast_joins(spark):
    plan = _plan(CL.clean_events(catalog.raw(spark, SF), salt="x"))
    assert len(_exchanges(plan)) == 1  # deduplication only
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 2
    assert "partial_min" in plan  # duplicates collapse before the shuffle


def test_features_combine_map_side_at_both_levels(spark):
    clean = catalog.cleaned(spark, SF)
    plan = _plan(FE._per_user(clean))
    exchanges = _exchanges(plan)
    assert any("user_id" in e and "product_id" in e for e in exchanges)
    assert any(re.search(r"hashpartitioning\(user_id#\d+L?, \d+\)", e) for e in exchanges)
    assert plan.count("partial_count") >= 1 and plan.count("partial_sum") >= 2
    assert "Expand" not in plan  # no distinct-aggregate rewrite


def test_quality_report_reads_each_frame_once(spark):
    plan = _plan(QU.quality_metrics(catalog.file_frame(spark, SF)))
    assert plan.count("InMemoryTableScan") >= 2  # both reports read the one grouped aggregate
    assert "CartesianProduct" not in plan


def test_log_sessions_pre_merge_per_split(spark, tmp):
    with open(f"{tmp}/a.log", "w") as f:
        f.write("2025-06-26 12:00:00,001 - s - INFO - Doublons supprimés : 1\n")
    plan = _plan(L.log_pipeline(L.log_lines(spark, tmp)))
    ex = _exchanges(plan)
    assert any("block" in e for e in ex)  # level 1: per file split
    # Beyond sessions of splits, only times (or their hours) are dealt out, never a whole file's records.
    assert "record_id" not in " ".join(ex) and "SinglePartition" not in " ".join(ex)
