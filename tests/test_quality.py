"""Quality reports: shapes, empty input, comparison rules."""

from clickseg.operators import quality as QU
from clickseg.plans import catalog
from conftest import SF


def test_completeness_empty(spark):
    df = spark.createDataFrame([], "a int, b string")
    rows = {r.column_name: r.completeness_pct for r in QU.completeness(df).collect()}
    assert rows == {"a": 0.0, "b": 0.0}


def test_comparison_relative_null_when_before_zero(spark):
    before = spark.createDataFrame([("x", 0.0), ("y", 50.0)], "metric string, value double")
    after = spark.createDataFrame([("x", 10.0), ("y", 75.0), ("z", 1.0)], "metric string, value double")
    got = {r.metric: (r.before, r.after) for r in QU.metric_compare(after, before).collect()}
    assert got == {"x": (0.0, 10.0), "y": (50.0, 75.0), "z": (0.0, 1.0)}


def test_row_counts_match_chain(spark):
    rows = {r.step: r.n_rows for r in QU.row_counts(catalog.raw(spark, SF), exact=True).collect()}
    assert rows == {"initial": 1020, "drop_invalid_rows": rows["drop_invalid_rows"],
                    "clean_event_types": 786, "remove_outliers": 765, "drop_duplicates": 753,
                    "final": 753}


def test_observed_counts(spark):
    clean, obs = QU.observed_clean_events(catalog.raw(spark, SF), "salt", exact=True,
                                          tie_breaker=["event_id"])
    assert clean.count() == 753
    got = {k: o.get["rows"] for k, o in obs.items()}
    assert got["initial"] == 1020 and got["clean_event_types"] == 786
    assert got["remove_outliers"] == 765 and got["drop_duplicates"] == 753


def test_ranking_limit(spark):
    df = spark.createDataFrame([(t,) for t in "aabbbcd"], "event_type string")
    got = [tuple(r)[:2] for r in QU.event_type_ranking(df, 2).collect()]
    assert got == [("b", 3), ("a", 2)]
