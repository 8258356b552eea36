import collections
import itertools
import random
import re

from clickseg.llm import decontaminate as D


def covered(n, misses):
    """Whether some mask, at some place in a window of n tokens, avoids every placement of the misses."""
    for bad in itertools.combinations(range(n), misses):
        if not any(all(p + i not in bad for i, b in enumerate(m) if b == "1")
                   for m in D.MASKS for p in range(n - len(m) + 1)):
            return False
    return True


def test_masks_meet_every_window():
    assert covered(D.WINDOW, D.MISSES)
    assert all(covered(n, D.SHORT_MISSES) for n in range(D.SHORTEST, D.WINDOW))


def brute(docs, items):
    """``{doc: {(start, end, item, agree)}}`` of all windows that pass."""
    tok = lambda t: [x.lower() for x in re.findall(r"[A-Za-z0-9]+", t or "")]
    out = collections.defaultdict(set)
    for d, t in docs:
        w = tok(t)
        at = collections.defaultdict(list)
        for i, x in enumerate(w):
            at[x].append(i)
        for item, x in items:
            b = tok(x)
            if len(b) < D.SHORTEST:
                continue
            k = min(len(b), D.WINDOW)
            miss = D.MISSES if len(b) >= D.WINDOW else D.SHORT_MISSES
            for shift in {i - j for j, y in enumerate(b) for i in at[y]}:  # alignments with a common token
                for j in range(len(b) - k + 1):
                    i = j + shift
                    if 0 <= i <= len(w) - k:
                        agree = sum(p == q for p, q in zip(w[i:i + k], b[j:j + k]))
                        if agree >= k - miss:
                            out[d].add((i, i + k, item, agree))
    return out


def merged(windows):
    """``{(item, first, last, windows)}``."""
    out = set()
    for item in {w[2] for w in windows}:
        group = []
        for a, b in sorted({w[:2] for w in windows if w[2] == item}):
            if group and a > max(y for _, y in group):
                out.add((item, group[0][0], max(y for _, y in group), len(group)))
                group = []
            group.append((a, b))
        out.add((item, group[0][0], max(y for _, y in group), len(group)))
    return out


def summary(windows):
    ids = [w[2] for w in windows if w[2] is not None]
    return (len({w[:2] for w in windows}), min(w[0] for w in windows), max(w[1] for w in windows), max(w[3] for w in windows),
            min(ids) if ids else None)


def same_as_brute(df, bench, docs, items):
    real = lambda d: None if d == D.real_id.__globals__["NULL_ID"] else d
    want = brute(docs, items)
    got = D.contaminated(df, bench).collect()
    assert len(got) == len(want)  # one row per document
    assert {real(r.d): (r.n_windows, r.first_token, r.last_token, r.best_agreement, r.item_id) for r in got} == \
        {d: summary(w) for d, w in want.items()}
    spans = collections.defaultdict(set)
    for r in D.passages(df, bench).collect():
        spans[real(r.d)].add((r.item, r.first_token, r.last_token, r.n_windows))
    assert spans == {d: merged(w) for d, w in want.items()}


def test_several_items_and_exact_passages(spark):
    words = [f"t{i}" for i in range(400)]
    one, two = words[:30], words[40:70]
    items = [(1, " ".join(one)), (2, " ".join(two)), (3, " ".join(words[100:120])), (4, " ".join(words[105:125])), (5, " ".join(words[200:209]))]
    docs = [(1, " ".join(words[300:303] + one + words[303:306] + two + words[306:308])), (2, " ".join(words[105:120])),
            (3, " ".join(words[200:209])), (4, " ".join(one + one)), (5, " ".join(words[310:390] + one + words[311:390] + one))]
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {r.d: (r.n_windows, r.first_token, r.last_token, r.item_id) for r in D.contaminated(df, bench).collect()}
    assert got[1][0] >= 36 and got[1][3] == 1 and got[1][2] >= 66
    assert {r.item for r in D.passages(df, bench).filter("d = 2").collect()} == {3, 4}
    same_as_brute(df, bench, docs, items)


def test_against_brute_force(spark):
    rnd = random.Random(8)
    word = lambda: "w%d" % rnd.randrange(900)
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([5, 7, 8, 9, 12, 13, 14, 30, 45, 60])]
    items += [(None, "Null id item, with quite a few words: one two three four five six."), (3, None), (77, ""), items[7]]
    docs = []
    for d in range(160):
        w = [word() for _ in range(rnd.randint(0, 60))]
        if d % 2:
            b = (rnd.choice(items[:11])[1] or "").split()
            for _ in range(rnd.choice([0, 0, 1, 2, 3, 5, 9])):  # substitutions
                if b:
                    b[rnd.randrange(len(b))] = "other"
            a = rnd.randrange(len(b) + 1) if rnd.random() < 0.3 else 0
            at = rnd.randrange(len(w) + 1)
            w[at:at] = [x.upper() if rnd.random() < 0.2 else x + rnd.choice(["", ",", "."]) for x in b[a:]]
        docs.append((d, " ".join(w)))
    docs += [(500, None), (501, ""), (502, items[8][1]), (502, items[8][1]), (None, items[9][1]),
             (503, " ".join(word() for _ in range(30_000)) + " " + items[6][1])]
    df = spark.createDataFrame([(a, b, "x", 0) for a, b in docs], "doc_id long, text string, hash string, pos int")
    bench = spark.createDataFrame([(a, b, 0) for a, b in items], "item_id long, text string, d int")
    same_as_brute(df, bench, docs, items)
    assert D.contaminated(df, bench.limit(0)).count() == 0
    assert D.contaminated(df.limit(0), bench).count() == 0
