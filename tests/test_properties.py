"""Property tests: row-local cleaning steps against plain-Python definitions."""

from hypothesis import given, settings
from hypothesis import strategies as st

from clickseg.operators import cleaning as CL
from clickseg.schemas import VALID_EVENT_TYPES

text = st.one_of(st.none(), st.text(alphabet=" .abcABC_rtvwiepuhsmofVIEWPURCHASE", max_size=12))
price = st.one_of(st.none(), st.floats(min_value=-1e6, max_value=1e6, allow_nan=False))
rows = st.lists(st.tuples(st.integers(0, 10**6), text, text, text, price), min_size=1, max_size=40)


def _event_type(x):
    v = "" if x is None else x.strip(" ").lower()
    return v if v in VALID_EVENT_TYPES else None


def _brand(x):
    return "unknown" if x is None else x.lower().strip(" ")


def _levels(code):
    parts = code.split(".") if code is not None else []
    return tuple(parts[i] if i < len(parts) else "unknown" for i in range(3))


@settings(max_examples=12, deadline=None)
@given(rows)
def test_row_local_steps(spark, data):
    df = spark.createDataFrame(data, "id long, event_type string, brand string, "
                                     "category_code string, price double")
    out = CL.fill_unknown(CL.split_categories(CL.clean_brands(CL.clean_prices(
        CL.clean_event_types(df)))))
    got = {r.id: r for r in out.collect()}
    expect = {i: (e, b, c, p) for i, e, b, c, p in data if _event_type(e) is not None}
    assert set(got) == set(expect)
    for i, (e, b, c, p) in expect.items():
        r = got[i]
        assert r.event_type == _event_type(e)
        assert r.brand == _brand(b)
        assert (r.category_level_1, r.category_level_2, r.category_level_3) == _levels(c)
        assert r.category_code == ("unknown" if c is None else c)
        assert r.price == (0.0 if p is None or p <= 0 else p)


@settings(max_examples=8, deadline=None)
@given(rows)
def test_cleaning_is_idempotent(spark, data):
    df = spark.createDataFrame(data, "id long, event_type string, brand string, "
                                     "category_code string, price double")

    def steps(d):
        return CL.fill_unknown(CL.split_categories(CL.clean_brands(CL.clean_prices(
            CL.clean_event_types(d)))))

    once = steps(df)
    twice = steps(once.drop("category_level_1", "category_level_2", "category_level_3"))
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.select(*once.columns).collect()))
