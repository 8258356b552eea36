"""Operator 11 against brute force; the tree's eliminations against all distances."""
import math
import random

import numpy as np
import pytest

from clickseg.llm import negatives

SF = "/root/testdata/sf0.01"


def brute(rows, every=100):
    """``rows`` of (id, vector, label) that take part."""
    v = [(i, y if i is None or i % 7 else (y + 1) % 10, [math.floor(256 * float(c)) for c in x]) for i, x, y in rows]
    x = np.array([r[2] for r in v], dtype=np.int64)
    key = lambda j: -(1 << 63) if v[j][0] is None else v[j][0]
    out = []
    for a, (i, y, q) in enumerate(v):
        if i is None or i % every:
            continue
        s = x @ np.array(q)
        order = sorted(range(len(v)), key=lambda j: (-s[j], key(j)))
        for p in [j for j in order if j != a and v[j][1] == y][:5]:
            fits = [j for j in order if v[j][1] != y and 30 * s[p] <= 100 * s[j] <= 90 * s[p]]
            out += [(i, v[p][0], k + 1, v[j][0], int(s[p]), int(s[j])) for k, j in enumerate(fits[:10])]
    return out


def same(got, want):
    key = lambda r: tuple((x is not None, x) for x in r)
    return sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    want = brute(rows)
    assert len(want) > 100 and same(negatives.op11_hard_negatives(spark, SF).collect(), want)


def grouped(n, seed, width=12):
    """Vectors in groups of copies and near copies, one of a third of all; two rare labels."""
    rng = np.random.default_rng(seed)
    center = rng.normal(size=(9, width))
    out = []
    for i in range(n):
        c = center[0] if i % 3 == 0 else center[rng.integers(1, 9)]
        x = c * rng.uniform(0.5, 2) + rng.normal(size=width) * (0 if i % 6 == 0 else 0.4)
        out.append((i, [float(a) for a in x], 9 if i % 211 == 0 else int(rng.integers(0, 4))))
    return out


@pytest.mark.parametrize("sample,leaf_rows,tile", [(20_000, 16, 4096), (60, 8, 16), (3, 512, 4096)])
def test_exact_whatever_the_sample(spark, monkeypatch, sample, leaf_rows, tile):
    monkeypatch.setattr(negatives, "TILE", tile)
    monkeypatch.setattr(negatives, "QUERIES", 2 if tile == 16 else 4096)
    rows = grouped(900, 1)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(5)
    assert same(negatives.hard_negatives(df, every=25, sample=sample, leaf_rows=leaf_rows).collect(), brute(rows, 25))


def test_odd_rows(spark):
    rng = random.Random(4)
    good = [(i, [rng.uniform(-2, 2) for _ in range(6)], rng.randrange(3)) for i in range(-40, 260)]
    good += [(100, [1.0] * 6, 1), (100, [1.0] * 6, 1), (None, [2.0] * 6, 0), (None, [2.0] * 6, 1), (57, [0.0] * 6, 2)]
    bad = [(300, None, 1), (301, [], 1), (302, [1.0, None, 1, 1, 1, 1], 1), (303, [math.nan] * 6, 0), (304, [math.inf] * 6, 0),
           (305, [1e30] * 6, 0), (306, [1.0] * 5, 0), (400, [1.0] * 6, None)]
    df = spark.createDataFrame([(i, x and [c if c is None else float(c) for c in x], y, "a", 1) for i, x, y in good + bad],
                               "vec_id long, embedding array<double>, label int, r string, leaf int")
    assert same(negatives.hard_negatives(df, every=20, leaf_rows=8).collect(), brute(good, 20))
    assert negatives.hard_negatives(df.limit(0)).count() == 0
    assert negatives.hard_negatives(df.filter("vec_id >= 300 AND vec_id < 306")).count() == 0
    assert negatives.hard_negatives(df.filter("vec_id = 0")).count() == 0


def test_eliminated_subtrees_hold_no_row_of_the_window():
    rng = np.random.default_rng(2)
    x = np.floor(256 * np.array([r[1] for r in grouped(1500, 3, 6)]))
    tree = negatives.Tree(x[::5], 8)
    tree.widen(x)
    leaf = tree.leaf(x)
    assert len(np.unique(leaf)) > 20 and tree.leaves > leaf.max()
    q = x[rng.integers(0, len(x), 60)]
    s = negatives.scores(q, x)
    top = np.sort(s, axis=1)
    low, high = top[:, [-5, -200]].astype(float), np.stack([np.full(len(q), np.inf), top[:, -150].astype(float)], axis=1)
    a, f = tree.search(q, low, high)
    seen = np.zeros((len(q), tree.leaves), bool)
    seen[a, f] = True
    for k in range(2):
        i, j = np.nonzero((s >= low[:, k, None]) & (s <= high[:, k, None]))
        assert seen[i, leaf[j]].all()
    assert seen[:, np.unique(leaf)].mean() < 0.8  # and many are eliminated


def test_large_components_are_exact():
    x = np.full((2, 3000), float(negatives.LARGEST * 256 - 1))
    assert negatives.scores(x, x)[0, 0] == 3000 * (int(negatives.LARGEST) * 256 - 1) ** 2
