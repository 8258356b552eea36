"""Operator 13 against plain Python loops."""
import collections
import random
import re

import duckdb
import pytest

from clickseg.llm import linerules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(rows, min_docs, share):
    """``rows`` of (doc_id, host, text) -> expected digest rows."""
    def norm(line):
        return " ".join(re.sub("[0-9]", "0", re.sub("[A-Z]", lambda m: m[0].lower(), w)) for w in WORD.findall(line))
    held, docs = collections.defaultdict(set), collections.defaultdict(set)
    for _, h, t in rows:
        docs[h].add(t)
        for line in (t or "").split("\n"):
            if norm(line):
                held[h, norm(line)].add(t)
    out = []
    for i, h, t in rows:
        s = t or ""
        w = WORD.findall(s)
        lines = [x for x in s.split("\n") if WORD.search(x)]
        windows = collections.defaultdict(list)
        for k in range(len(w) - 2):
            windows[tuple(w[k: k + 3])].append(k)
        rep = {k + j for at in windows.values() if len(at) > 1 for k in at for j in range(3)}
        lost = sum(len(WORD.findall(x)) for x in lines
                   if len(held[h, norm(x)]) >= min_docs and len(held[h, norm(x)]) >= share * len(docs[h]))
        failed = len(w) < 50 or 100 * len(rep) > 50 * len(w)
        left = len(w) - lost
        out.append((i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", s)), len(lines) - len(set(lines)), len(rep),
                    failed, not failed and left >= 50 and left >= 0.3 * len(w), lost))
    return collections.Counter(out)


def fixture():
    rng = random.Random(13)
    word = lambda: rng.choice(["a", "Bä", "c#", "<d>", "e9", "ééé", "日本", "x y", "zz", "K1"]) + str(rng.randrange(300))
    nav = "Home 12 | About\tUS"
    rows = [(1, "h", None), (2, "h", ""), (3, None, "\n\n \t\n"), (4, "", "one"), (None, None, "x " * 60),
            (5, "h", "\n".join(["same line here"] * 40)), (6, "h", " ".join(word() for _ in range(30_000)))]
    for i in range(60):
        lines = [" ".join(word() for _ in range(rng.randrange(1, 25))) for _ in range(rng.randrange(1, 7))]
        lines.insert(rng.randrange(len(lines)), nav if i % 2 else nav.lower().replace("1", "7").replace("\t", "   "))
        rows.append((100 + i, ["h", "g", None][i % 3], "\n".join(lines) + "\n" * (i % 2)))
    rows += [(7, "copies", "copy line one\n" + " ".join(f"w{i}" for i in range(70)))] * 40  # copies make no line frequent
    shared = "\n".join(" ".join(f"s{j}x{i}" for i in range(20)) for j in range(4))
    rows += [(200 + i, "near", shared + f"\nown {i}") for i in range(30)]  # nothing of their own is left
    return rows


COLS = ["doc_id", *linerules.STATS, "base_failed", "kept", "n_boilerplate_words"]


@pytest.mark.parametrize("min_docs,share", [(10, 0.001), (3, 0.5)])
def test_rows_against_plain_loops(spark, min_docs, share):
    rows = fixture()
    df = spark.createDataFrame([(i, h, t, "x", 1) for i, h, t in rows],
                               "doc_id long, source string, text string, lines string, n_words int").repartition(7)
    got = collections.Counter(map(tuple, linerules.line_rules(df, min_docs=min_docs, share=share).select(*COLS).collect()))
    assert got == plain(rows, min_docs, share)


def test_texts_that_stay_and_empty_tables(spark):
    rows = fixture()
    df = spark.createDataFrame([(i, h, t, "x") for i, h, t in rows], "doc_id long, source string, text string, host string")
    got = collections.Counter((r.doc_id, r.text) for r in linerules.filter_documents(df).collect())
    want, digest = collections.Counter(), plain(rows, 10, 0.001)
    kept = collections.Counter()
    for r, n in digest.items():
        if r[7]:
            kept[r[0]] += n
    for i, h, t in rows:
        if kept[i]:
            gone = {"home 00 | about us"}
            want[i, "".join(x for x in re.findall(r"[^\n]*\n|[^\n]+$", t)
                            if " ".join(re.sub("[0-9]", "0", x.lower()).split()) not in gone)] += 1
    assert got == want and all(r not in got for r in [(200, None)])
    assert linerules.line_rules(df.limit(0)).count() == 0 == linerules.filter_documents(df.limit(0)).count()
    assert linerules.filter_documents(df).columns == df.columns


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS FROM read_parquet('{sf}/documents.parquet')")
    rel = con.sql(linerules.OP13_SQL)
    got = linerules.op13_line_rules(spark, sf)
    assert got.columns == rel.columns
    assert collections.Counter(map(tuple, got.collect())) == collections.Counter(rel.fetchall())
