"""Operators 1, 2 and 8 against brute force on small, awkward tables."""
import collections
import hashlib
import random
import re

import numpy as np
import pytest

from clickseg.llm import common, linededup, minhash, substrings

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, d string, n int, h int, lang string"


def frame(spark, rows):
    """Rows with columns that clash with names used inside the operators."""
    return spark.createDataFrame([(i, t, "x", 1, 2, None) for i, t in rows], SCHEMA)


def prose(rnd, n, vocabulary=4000):
    return [f"w{rnd.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(11)
    out = []
    base = [prose(rnd, rnd.randint(30, 260)) for _ in range(12)]
    for b in base:
        out.append(" ".join(b))
        for _ in range(rnd.randint(0, 4)):  # near copies, some too far off
            c = list(b)
            for _ in range(rnd.choice([0, 1, 2, 6, 25])):
                c[rnd.randrange(len(c))] = "edit" + str(rnd.randrange(99))
            out.append(rnd.choice([" ", "\n", " \t"]).join(c))
    passage = " ".join(prose(rnd, 60))
    out += [" ".join(prose(rnd, 40)) + "\n" + passage + "\n" + " ".join(prose(rnd, 40)) for _ in range(8)]
    out += ["same " * 50, "same " * 70, "a b c", "a b c", "", "  \n\t ", "word", "\n\n\nx\n\n", None, None, "ü é\u00a0x " * 30]
    line = "a line with more than ten words in it that many documents share"
    out += [line + "\n" + " ".join(prose(rnd, 30)) for _ in range(6)] + ["short line\n" + str(i) for i in range(4)]
    out.append(" ".join(prose(rnd, 20_000)))
    ids = list(range(100, 100 + len(out)))
    rnd.shuffle(ids)
    got = list(zip(ids, out))
    got += got[:4]  # repeated rows
    got += [(None, out[0]), (None, "null id " * 30), (got[5][0], "the same id with another text " * 9)]
    return got


def key(r):
    return (common.NULL_ID if r[0] is None else r[0])


def jp(x, y):
    keys = x.keys() | y.keys()
    return sum(1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in keys) for i in x.keys() & y.keys())


def shingled(text):
    w = WORDS.findall(text or "")
    return collections.Counter(tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))) if w else collections.Counter()


def test_probability_jaccard_and_its_estimate():
    rnd = random.Random(3)
    for _ in range(30):
        a = {rnd.randrange(40): rnd.randint(1, 5) for _ in range(rnd.randint(1, 30))}
        b = {rnd.randrange(40): rnd.randint(1, 5) for _ in range(rnd.randint(1, 30))}
        pack = lambda s: (np.array(sorted(s), np.uint64), np.array([s[k] for k in sorted(s)], float))
        assert abs(minhash.probability_jaccard(pack(a), pack(b)) - jp(a, b)) < 1e-9
    # Registers of two weighted sets agree with probability J_P: many independent copies of one pair.
    copies, a, b = 400, {1: 3, 2: 1, 3: 2, 4: 1}, {1: 1, 2: 1, 3: 2, 5: 2}
    def sig(s):
        row = np.repeat(np.arange(copies), len(s))
        h = common.mix((np.tile(sorted(s), copies) + 1000 * row).astype(np.uint64))
        return minhash.signatures(row, h, np.tile([s[k] for k in sorted(s)], copies), copies)
    assert abs((sig(a) == sig(b)).mean() - jp(a, b)) < 0.01


def test_minhash_classes(spark, rows):
    seen = {}
    for r in rows:
        seen.setdefault((key(r), r[1]), shingled(r[1]))
    order = sorted(seen, key=lambda k: (k[0], common.NULL_ID))
    root = {k: k for k in seen}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, a in enumerate(order):
        for b in order[:i]:
            x, y = seen[a], seen[b]
            if x and y and (WORDS.findall(a[1]) == WORDS.findall(b[1]) or jp(x, y) >= 0.8):
                u, v = find(a), find(b)
                if u != v:
                    lo, hi = sorted((u, v), key=lambda k: k[0])
                    root[hi] = lo
    got = minhash.classes(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    want = collections.Counter((k[0], find(k)[0]) for k in ((key(r), r[1]) for r in rows))
    assert collections.Counter((r.d, r.class_d) for r in got) == want
    assert minhash.classes(frame(spark, rows[:0])).count() == 0


def brute_windows(rows):
    docs = sorted({(key(r), r[1] or "") for r in rows})
    first = {}
    for d, t in docs:
        w = WORDS.findall(t)
        for s in range(len(w) - 19):
            first.setdefault(tuple(w[s:s + 20]), (d, s))
            first[tuple(w[s:s + 20])] = min(first[tuple(w[s:s + 20])], (d, s))
    out = []
    for r in rows:
        w, gone = WORDS.findall(r[1] or ""), set()
        for s in range(len(w) - 19):
            if first[tuple(w[s:s + 20])] < (key(r), s):
                gone.update(range(s, s + 20))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((key(r), len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def test_substrings(spark, rows):
    got = substrings.repeats(frame(spark, rows)).collect()
    assert sorted((r.d, r.n_words, r.n_removed, r.kept_sha256) for r in got) == sorted(brute_windows(rows))
    for r in got:  # the reported repeats are what was removed
        assert sum(s.end - s.start for s in r.spans) == r.n_removed and all(s.end - s.start >= 20 for s in r.spans)


def test_substrings_small_vocabulary(spark):
    rnd = random.Random(2)
    rows = [(i, " ".join(rnd.choice("ab") for _ in range(rnd.randint(0, 90)))) for i in range(60)]
    rows += [(200 + i, " ".join("abcde"[(j // 7 + i) % 5] for j in range(200))) for i in range(6)]
    got = substrings.repeats(frame(spark, rows)).collect()
    assert sorted((r.d, r.n_words, r.n_removed, r.kept_sha256) for r in got) == sorted(brute_windows(rows))
    assert substrings.repeats(frame(spark, [])).count() == 0


def brute_lines(rows):
    docs = sorted({(key(r), r[1]) for r in rows if r[1] is not None}, key=lambda k: (k[0], 0))
    filled = lambda t: [(j, x) for j, x in enumerate(t.split("\n")) if WORDS.search(x)]
    first = {}
    for d, t in docs:
        f = filled(t)
        for i in range(len(f)):
            for k in (1, 2):
                if i + k <= len(f):
                    run = tuple(x for _, x in f[i:i + k])
                    first[run] = min(first.get(run, (d, i)), (d, i))
    out = []
    for r in rows:
        if r[1] is None:
            out.append((r[0], None, 0))
            continue
        f, gone = filled(r[1]), set()
        for i in range(len(f)):
            one, two = (f[i][1],), tuple(x for _, x in f[i:i + 2])
            if first[one] < (key(r), i) and len(WORDS.findall(f[i][1])) >= 10:
                gone.add(f[i][0])
            if len(two) == 2 and first[two] < (key(r), i):
                gone.update((f[i][0], f[i + 1][0]))
        out.append((r[0], "\n".join(x for j, x in enumerate(r[1].split("\n")) if j not in gone), len(gone)))
    return out


def test_line_runs(spark, rows):
    rnd = random.Random(4)
    lines = ["one two three", "x", "", "a b c d e f g h i j k l", "  ", "y", "another line of ten words or a few more than that"]
    more = [(5000 + i, "\n".join(rnd.choice(lines) for _ in range(rnd.randint(0, 12)))) for i in range(40)]
    more += [(6000 + i, "\n".join(f"line {j} of a long document" for j in range(300))) for i in range(3)]
    # Texts that share an id have no order that brute force knows: leave one of them out here.
    table = [r for r in rows if r[1] is None or not r[1].startswith("the same id")] + more
    table = [r for r in table if r[0] is not None or r[1] != rows[0][1]]
    got = linededup.drop_repeated_lines(frame(spark, table)).collect()
    assert sorted((str(r.doc_id), str(r.text), r["__n_removed"]) for r in got) == sorted(
        (str(a), str(b), c) for a, b, c in brute_lines(table))
    assert got[0].d == "x" and got[0].lang is None  # further columns are kept
    assert linededup.drop_repeated_lines(frame(spark, [])).count() == 0


def test_line_dedup_is_native(spark, rows):
    plan = linededup.drop_repeated_lines(frame(spark, rows[:5]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|MapIn", plan)
