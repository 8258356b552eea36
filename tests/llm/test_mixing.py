import collections
import hashlib
import math
import random
import re

from clickseg.llm import mixing as M

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def water(sizes, weights, share=1.5, epochs=2.0):
    """Targets by repeated resharing, as the rule is written."""
    total, open_, out = share * sum(sizes.values()), dict(weights), {}
    while open_:
        left = total - sum(out.values())
        part = {s: left * w / sum(open_.values()) for s, w in open_.items()}
        over = [s for s in open_ if part[s] > epochs * sizes[s]]
        if not over:
            out.update(part)
            break
        for s in over:
            out[s] = epochs * sizes[s]
            del open_[s]
    return out


def order(sources):
    return sorted(sources, key=lambda s: (s is None, (s or "").encode()))


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    got = M.mixture(df).collect()
    assert len(got) == len(rows)
    size = collections.Counter()
    for _, t, s, _ in rows:
        size[s] += len(WORDS.findall(t or ""))
    goal = water(size, {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(order(size))})
    source = {i: s for i, _, s, _ in rows}
    taken = collections.Counter()
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == size[s] and math.isclose(r.target, goal[s], abs_tol=1e-6)
        assert 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
    for s in size:
        assert abs(taken[s] - goal[s]) <= 1
    return df, got


def test_random_sources(spark):
    rnd = random.Random(5)
    for n in (1, 2, 7, 12):
        names = [None, "a", "B", "é", "", "src10", "src2", *map(str, range(9))][:n]
        rows = [(i, " ".join("w" * rnd.randint(1, 30)) + "\n" * rnd.randint(0, 2), rnd.choice(names), 9)
                for i in range(120)]
        df, got = check(spark, rows)
        copies = M.curriculum(df).groupBy("doc_id").sum("taken").collect()
        assert {r[0]: r[1] for r in copies} == {r.doc_id: r.taken for r in got if r.taken}


def test_nulls_empty_and_repeats(spark):
    rows = [(1, None, "a", 1), (2, "", "a", 1), (3, " \t\n", None, 1), (4, "x y z", None, 1), (5, "x", "a", 1),
            (6, "x " * 5000, "b", 1)]
    check(spark, rows)
    twice = spark.createDataFrame([(None, "a b", "s", 1)] * 3, "doc_id long, text string, source string, size int")
    got = M.mixture(twice).collect()
    assert len(got) == 3 and sum(r.taken for r in got) == 9
    assert M.mixture(twice.limit(0)).count() == 0
    assert M.curriculum(twice.limit(0)).count() == 0


def test_positions_follow_the_schedule(spark):
    rows = [(i, "w " * 10, s, 0) for i, s in enumerate(["a", "b", "c"] * 400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    got = M.training_order(df).collect()
    at = [r.position for r in got]
    assert at == sorted(at) and 0 <= at[0] and at[-1] <= 1
    for s, slope in zip("abc", M.SLOPES):
        mine = [r for r in got if r.source == s]
        early = sum(r.taken for r in mine if r.position < 0.5) / sum(r.taken for r in mine)
        assert abs(early - (0.5 - slope / 4)) < 0.02  # the schedule integrated over the first half


def test_reruns_agree(spark):
    rows = [(i, "w " * (i % 17), f"s{i % 4}", 0) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    a = M.mixture(df.repartition(7)).toPandas().sort_values("doc_id").to_csv(index=False)
    b = M.mixture(df.repartition(3)).toPandas().sort_values("doc_id").to_csv(index=False)
    assert hashlib.md5(a.encode()).digest() == hashlib.md5(b.encode()).digest()


def test_query_is_dealt_from_the_training_order(spark, tmp, monkeypatch):
    rows = [(i if i % 5 else None, "w " * (i % 17), f"s{i % 4}", 0) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    df.write.parquet(f"{tmp}/documents.parquet")
    want = sorted(map(tuple, M.mixture(df).collect()), key=str)
    got = M.dealt(df).collect()
    assert sorted((tuple(r)[:-1] for r in got), key=str) == want
    first = [r.first_position for r in got if r.first_position is not None]
    assert first == sorted(first) and all((r.first_position is None) == (r.taken == 0) for r in got)

    def flat(*a, **b):
        raise AssertionError("closed form")

    monkeypatch.setattr(M, "mixture", flat)
    query = M.op7_mix_sources(spark, tmp)
    assert sorted(map(tuple, query.collect()), key=str) == want
    slopes = M.SLOPES
    assert [r.first_position for r in M.dealt(df, slopes=slopes[::-1]).collect() if r.taken] != first


def test_a_third_of_the_ids_null_or_one(spark):
    """Rows of one id and size are counted before any running sum; offsets stay without gaps and overlaps."""
    rnd = random.Random(11)
    ids = lambda i: None if i % 3 == 0 else 7 if i % 3 == 1 else i
    rows = [(ids(i), "w " * rnd.choice([0, 3, 3, 8]), rnd.choice([None, "a", "b"]), 0) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size int").repartition(6)
    p = M.plan(df).collect()
    assert len(p) == len(rows)
    for s in (None, "a", "b"):
        at = 0
        for r in sorted((r for r in p if r.source == s and r.size), key=lambda r: r["at"]):
            assert r["at"] == at
            at += r.size
        assert at == next(r.source_size for r in p if r.source == s)
    plan = M.plan(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "Cartesian" not in plan and "Cross" not in plan
