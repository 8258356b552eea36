"""Operator 12 against numpy's eigensolver and exact integers."""
import math

import numpy as np
import pytest

from clickseg.llm import whitening

SF = "/root/testdata/sf0.01"


def rows_of(case):
    rng = np.random.default_rng(12)
    if case == "spread":
        return rng.normal(size=(120, 24)) * 9
    if case == "flat":  # few directions, many equal eigenvalues
        return rng.normal(size=(90, 3)) @ rng.normal(size=(3, 20)) * 10
    if case == "copies":
        return np.repeat(rng.normal(size=(7, 16)) * 10, 15, axis=0)
    if case == "groups":
        return (rng.normal(size=(3, 12)) * 500)[rng.integers(0, 3, 150)] + rng.normal(size=(150, 12))
    return np.full((30, 6), 5.0)


@pytest.mark.parametrize("case", ["spread", "flat", "copies", "groups", "constant"])
def test_rank_one_updates_and_merging(case):
    x = np.floor(rows_of(case)).astype(np.int64) + whitening.SHIFT
    parts = [whitening.Spectrum(x.shape[1]) for _ in range(3)]
    for p, rows in zip(parts, np.array_split(x, 3)):
        p.add(rows)
    parts[0].merge(whitening.Spectrum.of(parts[1].row(1)))
    parts[0].merge(parts[2])
    s, c = parts[0], x - x.mean(axis=0)
    top = max(np.linalg.eigvalsh(c.T @ c)[-1], 1.0)
    assert s.n == len(x) and (s.sums == x.sum(axis=0)).all() and np.allclose(s.mean + whitening.SHIFT, x.mean(axis=0))
    assert np.abs(s.values - np.linalg.eigvalsh(c.T @ c)).max() < 1e-12 * top
    assert np.abs(s.vectors.T @ s.vectors - np.eye(x.shape[1])).max() < 1e-12
    assert np.abs(s.vectors * s.values @ s.vectors.T - c.T @ c).max() < 1e-12 * top


def test_secular_roots():
    rng = np.random.default_rng(3)
    for d in (np.arange(1.0, 9.0), np.cumsum(10.0 ** rng.uniform(-9, 3, 40)), np.array([2.0]), np.array([0.0, 1e-14, 1.0])):
        z = rng.normal(size=len(d))
        roots, gap = whitening.secular(d, z * z, 0.7)
        want = np.linalg.eigvalsh(np.diag(d) + 0.7 * np.outer(z, z))
        assert np.allclose(roots, want, rtol=1e-12, atol=1e-13 * want[-1])
        assert (roots > d).all() and (roots[:-1] < d[1:]).all() and np.allclose(gap, d[:, None] - roots)


def check(rows, given, components=32):
    """The digest against numpy: ``given`` are the (id, vector) that take part."""
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for _, v in given], dtype=object)
    n, s = len(x), x.sum(axis=0)
    centred = ((n * x - s) / n).astype(float)
    e, v = np.linalg.eigh(centred.T @ centred / n)
    e, v = e[::-1], v[:, ::-1]
    k = min(components, x.shape[1])
    dev = {}
    for (i, _), d in zip(given, ((n * x - s) ** 2).sum(axis=1)):
        dev.setdefault(i, []).append(int(d))
    assert len(rows) == n * k
    w = {}
    for r in rows:
        assert r.n == n and r.deviation in dev[r.vec_id]
        assert abs(r.explained - e[r.component - 1] / e.sum()) <= 1e-9
        assert 0 <= r.identity_error <= 1e-9
        w.setdefault(r.vec_id, [None] * k)[r.component - 1] = r.whitened
    for (i, _), c in zip(given, centred):
        if len(dev[i]) == 1:
            want = np.abs(c @ v[:, :k]) / np.sqrt(e[:k])
            assert np.allclose(np.abs(w[i]), want, rtol=1e-6, atol=1e-7)
    full = np.array([x for i, x in w.items() if len(dev[i]) == 1])
    if len(full) == n:
        assert np.abs(full.T @ full / n - np.eye(k)).max() <= 1e-9


def test_query_equals_numpy(spark):
    given = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    check(whitening.op12_whiten(spark, SF).collect(), given)


def test_odd_rows_and_partitions(spark):
    rng = np.random.default_rng(5)
    good = [(i, [float(c) for c in rng.normal(size=5)]) for i in range(200)] + [(7, [9.0, 8.0, 7.0, -6.0, 5.5]), (None, [0.0] * 5)]
    bad = [(900, None), (901, []), (902, [1.0, None, 2.0, 3.0, 4.0]), (903, [float("nan")] * 5), (904, [float("inf")] * 5),
           (905, [1e300] * 5), (906, [1.0] * 4), (907, [1.0] * 9)]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in good + bad], "vec_id long, embedding array<double>, component int, n string")
    for parts in (1, 40):  # 40: the tree of summaries has more than one level
        check(whitening.whiten(df.repartition(parts)).collect(), good)
    assert whitening.whiten(df.limit(0)).count() == 0
    assert whitening.whiten(df.filter("vec_id >= 900 AND vec_id < 906")).count() == 0


def test_directions_without_variance(spark):
    df = spark.createDataFrame([(i, [float(i), 2.0 * i, 3.0]) for i in range(50)], "vec_id long, embedding array<double>")
    rows = whitening.whiten(df).collect()
    assert {r.component: r.whitened is None for r in rows} == {1: False, 2: True, 3: True}
    assert all(r.identity_error < 1e-9 for r in rows)
    one = whitening.whiten(df.limit(1)).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 0, None, None, None)] * 3
