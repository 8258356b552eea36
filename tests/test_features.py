"""Feature table: the one-aggregate form equals the reference's join form."""

import datetime as dt

from pyspark.sql import functions as F

from clickseg.operators import features as FE
from clickseg.plans import catalog
from clickseg.schemas import FEATURES
from conftest import SF


def test_features_equal_join_form(spark):
    clean = catalog.cleaned(spark, SF)
    a = FE.features(clean)
    b = FE.features_by_join(clean)
    assert a.columns == b.columns == FEATURES.fieldNames()
    assert [f.dataType for f in a.schema.fields] == [f.dataType for f in FEATURES.fields]
    assert a.count() == 15
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    # frequency is the purchase count
    assert a.filter(F.col("frequency") != F.col("purchases")).count() == 0


def test_no_purchases_fallback(spark):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("u1", "view", t, 1, 1.0), ("u2", "cart", t, 2, 2.0),
                                ("u1", "view", t, 3, 3.0)],
                               "user_id string, event_type string, event_time timestamp, "
                               "product_id int, price double")
    rows = sorted(tuple(r) for r in FE.rfm(df).collect())
    assert rows == [("u1", None, 0, 0.0, 0), ("u2", None, 0, 0.0, 0)]
    assert FE.features(df).count() == 0


def test_rfm_values(spark):
    d = dt.datetime
    df = spark.createDataFrame([
        ("a", "purchase", d(2024, 1, 10), 1, 10.0), ("a", "purchase", d(2024, 1, 5), 1, 5.25),
        ("a", "view", d(2024, 1, 11), 2, 1.0), ("b", "purchase", d(2024, 1, 1), 3, 2.5),
        ("b", "purchase", d(2024, 1, 2), 4, 2.5), ("c", "cart", d(2024, 1, 3), 5, 1.0)],
        "user_id string, event_type string, event_time timestamp, product_id int, price double")
    got = {r.user_id: tuple(r)[1:] for r in FE.features(df).collect()}
    assert got == {"a": (0, 2, 15.25, 1, 1, 0, 2, 2 / 3), "b": (8, 2, 5.0, 2, 0, 0, 2, 1.0)}
    fixed = {r.user_id: r.recency for r in FE.rfm(df, reference_date=dt.date(2024, 1, 20)).collect()}
    assert fixed == {"a": 10, "b": 18}


def test_union_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "id int, brand string")
    b = spark.createDataFrame([(2,)], "id int")
    out = FE.union_by_name([a, b]).orderBy("id").collect()
    assert [tuple(r) for r in out] == [(1, "x"), (2, None)]
    assert FE.schema_drift([a, b]) == [(1, ["brand"], [])]
    try:
        FE.union_by_name([])
    except ValueError:
        return
    raise AssertionError("empty list accepted")
