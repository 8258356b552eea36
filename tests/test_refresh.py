"""Model refresh in a running score stream, names without a join, and no cached frame after a job."""

import datetime as dt
import os
import shutil
import time

import pytest
from pyspark.sql import functions as F

from clickseg.operators import clustering as CU
from clickseg.operators import scoring as SC
from clickseg.plans import catalog, jobs
from clickseg.schemas import CLICKS_RAW
from clickseg.sources import files as IO
from clickseg.sources.fixtures import clicks_from_tables

SF = "/root/testdata/sf0.001"


def test_a_model_saved_meanwhile_scores_the_next_batch(spark, tmp):
    feats = CU.prepare(catalog.buyer_features(spark, SF))
    models = [CU.fit_kmeans(feats, k) for k in (2, 4)]
    typed = feats.select("user_id", *[feats[c].cast("double").alias(c) for c in feats.columns[1:]])
    root, t0 = f"{tmp}/models", dt.datetime(2025, 6, 26)
    IO.save_model(models[0], root, t0)
    os.makedirs(f"{tmp}/in")

    def arrive(name):  # whole files only
        typed.coalesce(1).write.parquet(f"{tmp}/staged-{name}")
        part = next(f for f in os.listdir(f"{tmp}/staged-{name}") if f.startswith("part-"))
        shutil.copy(f"{tmp}/staged-{name}/{part}", f"{tmp}/in/.{name}.parquet")
        os.rename(f"{tmp}/in/.{name}.parquet", f"{tmp}/in/{name}.parquet")

    def scored(model):
        try:
            return spark.read.parquet(f"{tmp}/out").filter(F.col("model") == model)
        except Exception:  # nothing written yet
            return spark.createDataFrame([], "user_id string, prediction int, model string")

    query = jobs.start_refreshing_score_stream(spark, root, f"{tmp}/in", f"{tmp}/out", f"{tmp}/ck",
                                               trigger={"processingTime": "1 second"})
    try:
        for i, model in enumerate(models):
            if i:
                path = IO.save_model(model, root, t0 + dt.timedelta(hours=1))
                # A third one is being saved: its last file is not there yet.
                shutil.copytree(path, f"{root}/model_20250627_000000", ignore=shutil.ignore_patterns("saved", "stages"))
            arrive(f"batch{i}")
            name, end = f"model_20250626_0{i}0000", time.monotonic() + 60
            while scored(name).count() < typed.count() and time.monotonic() < end:
                assert query.exception() is None, query.exception()
                time.sleep(0.5)
            want = SC.score_profiles(model, typed).select("user_id", "prediction")
            got = scored(name).select("user_id", "prediction")
            assert got.count() == want.count() and got.exceptAll(want).count() == 0
    finally:
        query.stop()
    assert IO.list_models(spark, root).count() == 3 and IO.list_models(spark, root, "saved").count() == 2


def test_names_by_rules_equal_the_join(spark):
    prof = catalog.frozen_profiles(spark, SF)
    named = SC.named_segments(prof)
    joined = SC.named_segments(prof, CU.name_segments(prof))
    assert sorted(named.collect()) == sorted(joined.select(*named.columns).collect())
    assert "Join" not in named._jdf.queryExecution().optimizedPlan().toString()
    a, b = SC.cluster_comparison(named), SC.cluster_comparison(prof, CU.name_segments(prof))
    assert sorted(a.collect()) == sorted(b.select(*a.columns).collect())


@pytest.fixture()
def no_checkpoint(spark, monkeypatch):
    monkeypatch.setattr("clickseg.session.checkpoint_dir", lambda _: None)


def test_no_frame_stays_cached_after_jobs(spark, tmp, no_checkpoint):
    clicks_from_tables(spark, SF).select(*CLICKS_RAW.fieldNames(), "source_file").write.partitionBy(
        "source_file").parquet(f"{tmp}/in")
    kept = len(spark.sparkContext._jsc.getPersistentRDDs())
    jobs.clean_job(spark, f"{tmp}/in", f"{tmp}/clean", "salt", f"{tmp}/reports")
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == kept
    jobs.train_job(spark, f"{tmp}/clean", f"{tmp}/models", f"{tmp}/results", max_k=3)
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == kept
