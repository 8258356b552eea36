"""The pipeline stage by stage: each works on what its predecessor kept, and decides what it must."""
import collections
import re

import corpus_pipeline as P
from clickseg.llm import catalog, common, decontaminate, minhash, mixing, toxicity

SF = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def test_stages(spark):
    docs = common.table(spark, SF, "documents")
    columns, kept = docs.columns, [{r.doc_id: r.text for r in docs.collect()}]
    frames = [docs]
    for _, stage in P.STAGES[:-1]:
        docs = common.cut(stage(spark, docs, SF))
        assert docs.columns == columns
        frames.append(docs)
        kept.append({r.doc_id: r.text for r in docs.collect()})
        assert len(kept[-1]) == docs.count() and kept[-1].keys() <= kept[-2].keys() and kept[-1]
    # toxicity: exactly what the score rejects, by the model of this input
    score = toxicity.score(frames[0], toxicity.fit(frames[0], common.table(spark, SF, "labels")))
    assert {r.doc_id for r in score.filter("score < 0.3").collect()} == kept[1].keys()
    assert all(kept[1][i] == kept[0][i] for i in kept[1])
    # line dedup: every line left was there, and a repeated pair of lines is left once
    pairs = collections.Counter()
    for i, t in kept[2].items():
        old = collections.Counter(kept[1][i].split("\n"))
        assert not collections.Counter(t.split("\n")) - old and (t == kept[1][i] or WORDS.search(t))
        f = [x for x in t.split("\n") if WORDS.search(x)]
        pairs.update({p for p in zip(f, f[1:]) if sum(a == p for a in zip(f, f[1:])) == 1 and t == kept[1][i]})
    assert all(n == 1 for n in pairs.values())
    lengths = {r.doc_id: (r.n_chars, r.text) for r in frames[2].collect()}
    assert all(n == len(t) for i, (n, t) in lengths.items() if t != kept[1][i])
    # near-duplicates: one document of each class of this input
    classes = {r.class_d for r in minhash.classes(frames[2]).collect()}
    assert kept[3].keys() == classes
    # decontamination: exactly the documents without an overlap
    bad = {r.d for r in decontaminate.contaminated(frames[3], common.table(spark, SF, "benchmark")).collect()}
    assert kept[4].keys() == kept[3].keys() - bad
    # mix: the words taken per source are those of the mixture
    out = P.mix_sources(spark, frames[4], SF).collect()
    want = {r.doc_id: r.taken for r in mixing.mixture(frames[4]).collect() if r.taken}
    got = collections.Counter()
    for r in out:
        got[r.doc_id] += r.taken
    assert got == want and [r.position for r in out] == sorted(r.position for r in out)


def test_empty_table_and_awkward_rows(spark):
    rows = [(None, None, None, None, None), (1, None, "en", "a", 0), (2, "", "en", None, 0), (3, "one two three", "en", "a", 13),
            (3, "one two three", "en", "a", 13), (4, "line of text\n" * 400, "de", "b", 1), (5, "a " * 20_000, "en", "b", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for frame in (docs, docs.limit(0)):
        for _, stage in P.STAGES:
            frame = common.cut(stage(spark, frame, SF))
            assert frame.count() <= docs.count() * 2
    extra = docs.selectExpr("*", "1 AS d", "2 AS score", "'x' AS t", "3 AS n_removed", "4 AS toxic")
    for _, stage in P.STAGES[:-1]:
        extra = common.cut(stage(spark, extra, SF))
        assert extra.columns == [*docs.columns, "d", "score", "t", "n_removed", "toxic"]
    assert common.drop_scratch(spark) > 0


def test_only_the_last_table_stays(spark, tmp):
    common.drop_scratch(spark)
    first = common.cut(spark.range(3))
    with common.only_last_table(spark):
        common.cut_bucketed(common.cut(spark.range(5)), "id")
        last = common.cut(spark.range(7))
    assert first.count() == 3 and last.count() == 7
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("clickseg_") and "state" not in t.name]
    assert common.drop_scratch(spark) == 2


def test_queries_are_registered():
    names = list(catalog.all_queries())
    assert [int(re.match(r"op(\d+)_", n)[1]) for n in names] == list(range(1, 14))
    assert set(catalog.all_sql()) <= set(names)
