import os
import random

import pytest

import corpus_pipeline
from homesense.llm.simhash import fingerprint
from tests.llm.cases import empty, frame, sentence, texts
from tests.llm.test_exchanges import brute_contamination, brute_cut
from tests.llm.test_simhash import brute


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    items = [(k, sentence(rng, 20)) for k in range(5)]
    docs = texts(3)
    shared = sentence(rng, 25)
    docs += [(300 + k, sentence(rng, 60) + " " + shared) for k in range(3)]
    docs += [(310 + k, items[k][1] + " " + sentence(rng, 40 * (k + 1) ** 2)) for k in range(5)]
    docs += [(320, docs[-1][1]), (321, docs[-1][1] + " end")]
    return docs, items


def kept_rows(rows):
    """One row per SimHash component: the smallest id, null ids last; repeats of a row once."""
    fps = [fingerprint(None if t is None else t.encode()) for _, t in rows]
    numbered = [(k, t) for k, (_, t) in enumerate(rows)]
    best = {}
    for (k, _), c in zip(numbered, brute(numbered, fps, 4)):
        best.setdefault(c, []).append(rows[k])
    return best.values()


def test_stages_against_brute_force(spark, rows, scratch):
    docs, items = rows
    spark.createDataFrame(items, "item_id long, text string").write.parquet(os.path.join(scratch, "benchmark.parquet"))
    lang = {i: "en" for i, _ in docs}
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["language_id", "simhash_neardup", "substring_dedup", "decontamination", "packing"]

    df = frame(spark, docs, lang)
    out = steps["language_id"](spark, df, scratch)
    assert out.dtypes == df.dtypes
    docs = [(i, t) for i, t in docs if t and any(c.isalpha() for c in t)]
    got = [(r.doc_id, r.text) for r in out.collect()]
    key = lambda x: (x[0] is not None, x[0] or 0, x[1])
    assert sorted(got, key=key) == sorted(docs, key=key)

    df = frame(spark, docs, lang)
    out = steps["simhash_neardup"](spark, df, scratch)
    assert out.dtypes == df.dtypes
    got = [(r.doc_id, r.text) for r in out.collect()]
    groups = list(kept_rows(docs))
    assert len(got) == len(groups)
    for group in groups:
        ids = [i for i, _ in group if i is not None]
        here = [x for x in got if x in group]
        assert len(here) == 1 and (not ids or here[0][0] == min(ids))

    docs = got
    df = frame(spark, docs, lang)
    out = steps["substring_dedup"](spark, df, scratch)
    assert out.dtypes == df.dtypes
    want = [(i, kept if gone else t, len(kept) if gone else len(t)) for (i, t), (_, _, gone, kept) in zip(docs, brute_cut(docs))]
    got = [(r.doc_id, r.text, r.n_chars) for r in out.collect()]
    assert sorted(got, key=key) == sorted(want, key=key)
    assert any(a != b[1] for (_, a), b in zip(docs, want))

    docs = [(i, t) for i, t, _ in want]
    df = frame(spark, docs, lang)
    out = steps["decontamination"](spark, df, scratch)
    assert out.dtypes == df.dtypes
    bad = [x[-1] for x in brute_contamination(docs, items)]
    assert sum(bad) >= 2
    want = [d for d, b in zip(docs, bad) if not b]
    assert sorted([(r.doc_id, r.text) for r in out.collect()], key=key) == sorted(want, key=key)

    pieces = steps["packing"](spark, frame(spark, want, lang), scratch).collect()
    assert {p.doc_id for p in pieces} == {i for i, _ in want}


def test_run_over_tables(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    fill = {r.sequence_id: r.n for r in out.groupBy("sequence_id").agg({"length": "sum"}).toDF("sequence_id", "n").collect()}
    assert fill and max(fill.values()) <= 1024


def test_nothing_to_learn_and_empty_tables(spark, rows, scratch):
    docs, items = rows
    steps = dict(corpus_pipeline.STAGES)
    out = steps["language_id"](spark, frame(spark, docs), scratch)      # no row has a language
    assert out.count() == sum(1 for _, t in docs if t and any(c.isalpha() for c in t))
    spark.createDataFrame([], "item_id long, text string").write.parquet(os.path.join(scratch, "benchmark.parquet"))
    for name, step in steps.items():
        out = step(spark, empty(spark), scratch)
        assert out.count() == 0 and (name == "packing" or out.dtypes == empty(spark).dtypes)
