"""Driver contract, and every SQL-checkable query against DuckDB on sf0.001."""

import re

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF

TABLES = ["events", "part"]


#: The other queries are tested in tests/llm.
OWN = {k for k in E.queries() if not re.match(r"op\d+_|pipeline$", k)}


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[0] == "user_id" and df.count() == 15


# (P10 ``clean_pipeline`` is registered as ``clean_events``).
SURVEY_NAMES = """parquet_scan drop_invalid_rows clean_event_types clean_prices clean_brands
split_categories fill_unknown remove_outliers pseudonymize purchase_filter clean_events features
metric_compare named_segments segment_recommendations rfm reference_date rfm_no_purchases behavior
row_counts completeness event_distribution describe_numeric quality_metrics quality_comparison
price_quartiles price_quartile_sketches cluster_stats cluster_profiles cluster_sizes drop_duplicates distinct_users
union_by_name event_type_ranking best_k prediction_sample assemble scale_nocenter scale_center
kmeans_fit silhouette wss k_search assign_clusters name_segments score_profiles radar_profile
cluster_comparison segmentation log_records log_fields log_sessions""".split()
# What does not depend on the layout of the rows in operators that fit a model, against SQL.
FACTS = """assembled_columns k_search_facts best_k_of_table kmeans_facts segmentation_facts
prediction_sample_facts score_known_model""".split()
ROWS_ONLY = {"assemble", "kmeans_fit", "k_search", "best_k", "score_profiles", "prediction_sample",
             "segmentation"}


def test_every_query_has_a_callable():
    assert OWN == set(SURVEY_NAMES) | set(FACTS)
    assert OWN & set(E.oracle_sql()) == (set(SURVEY_NAMES) - ROWS_ONLY) | set(FACTS)


def _norm(v):
    if isinstance(v, float):
        return repr(v)
    return "NULL" if v is None else str(v)


@pytest.mark.parametrize("name", sorted(OWN & set(E.oracle_sql())))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    sdf = E.queries()[name](spark, SF)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(sdf.columns) == sorted(rel.columns)
    order = sorted(range(len(sdf.columns)), key=lambda i: sdf.columns[i])
    dorder = sorted(range(len(rel.columns)), key=lambda i: rel.columns[i])
    srows = sorted("|".join(_norm(r[i]) for i in order) for r in sdf.collect())
    drows = sorted("|".join(_norm(r[i]) for i in dorder) for r in rel.fetchall())
    assert srows == drows


@pytest.mark.parametrize("name,rows", [("assemble", 15), ("kmeans_fit", 2), ("k_search", 9),
                                       ("best_k", 1), ("score_profiles", 15),
                                       ("prediction_sample", 5), ("segmentation", None)])
def test_rows_only_queries(spark, name, rows):
    df = E.queries()[name](spark, SF)
    n = df.count()
    if rows is None:  # one row per cluster of the chosen k
        assert 2 <= n <= 10 and df.select("cluster").distinct().count() == n
    else:
        assert n == rows
