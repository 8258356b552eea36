"""End to end through the command line: CSV derived from the driver tables -> convert ->
clean -> train -> score, with the reference's option names."""

import pytest

from clickseg import cli
from clickseg.plans import catalog
from clickseg.sources.files import CSV_TIMESTAMP_FORMAT
from conftest import SF


def test_cli_all_then_score(spark, tmp, monkeypatch):
    raw = catalog.raw(spark, SF)
    # one CSV folder per month, as the monthly input files
    for f in ("2024-01-a", "2024-01-b"):
        (raw.filter(raw.source_file == f).drop("source_file", "event_id").coalesce(1).write
         .option("header", True).option("timestampFormat", CSV_TIMESTAMP_FORMAT)
         .csv(f"{tmp}/csvparts/{f}"))
    import glob
    import shutil
    import os
    os.makedirs(f"{tmp}/csv")
    for f in ("2024-01-a", "2024-01-b"):
        part = glob.glob(f"{tmp}/csvparts/{f}/part-*.csv")[0]
        shutil.copy(part, f"{tmp}/csv/{f}.csv")

    with pytest.raises(SystemExit):
        cli.run(["clean", "--input_parquet", f"{tmp}/pq", "--output_s3", f"{tmp}/clean"], spark)
    monkeypatch.setenv("PSEUDONYM_SALT", "salt")
    out = cli.run(["all", "--input_csv", f"{tmp}/csv", "--input_parquet", f"{tmp}/pq",
                   "--output_s3", f"{tmp}/clean", "--output_s3_model", f"{tmp}/models",
                   "--output_s3_img", f"{tmp}/charts", "--output_data", f"{tmp}/reports",
                   "--max-k", "3", "--exact-quartiles"], spark)
    assert len(out["converted"]) == 2
    expect = raw.filter(raw.source_file.isin("2024-01-a", "2024-01-b")).count()
    assert out["row_counts"]["initial"] == expect
    assert spark.read.parquet(f"{tmp}/charts/k_search").count() == 2
    m = spark.read.parquet(f"{tmp}/charts/model_metrics").first()
    assert m.optimal_clusters in (2, 3) and -1 <= m.silhouette_final <= 1
    assert m.customers == spark.read.parquet(f"{tmp}/charts/predictions").count()
    cli.run(["train", "--output_s3", f"{tmp}/clean", "--output_s3_model", f"{tmp}/models2", "--output_s3_img",
             f"{tmp}/charts2", "--max-k", "3", "--feature-state", f"{tmp}/state"], spark)
    again = spark.read.parquet(f"{tmp}/charts2/model_metrics").first()
    assert (again.optimal_clusters, again.customers) == (m.optimal_clusters, m.customers)
    assert spark.read.parquet(f"{tmp}/reports/quality_comparison").count() > 0
    feats = catalog.buyer_features(spark, SF).drop("user_id")
    feats.write.parquet(f"{tmp}/profiles")
    cli.run(["score", "--output_s3_model", f"{tmp}/models", "--profiles", f"{tmp}/profiles",
             "--scores", f"{tmp}/scores"], spark)
    assert spark.read.parquet(f"{tmp}/scores").count() == feats.count()
