"""Bounds, clashes and both branches of joins: what no size of input may change."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from homesense.llm import common, decontaminate, language, packing, simhash, toxicity
from tests.llm.cases import frame, sentence, texts
from tests.llm.test_exchanges import brute_contamination
from tests.llm.test_models import toxic_rows, toy


def test_gram_index_equals_a_dictionary():
    rng = np.random.default_rng(1)
    for n in (0, 1, 7, 5000):
        grams = np.unique(rng.integers(0, 1 << 24, n, dtype=np.uint32))
        index, place = language.GramIndex(grams), {int(g): k for k, g in enumerate(grams)}
        probe = np.concatenate([grams, rng.integers(0, 1 << 24, 3000, dtype=np.uint32), np.zeros(3, np.uint32)])
        assert index[probe].tolist() == [place.get(int(g), -1) for g in probe]


def test_kernel_ridge_against_a_dense_solve():
    rng = random.Random(6)
    raws = [toy(rng, k, 40).encode() for k in ("xx", "yy") for _ in range(12)]
    labels = ["xx"] * 12 + ["yy"] * 12
    model = language.fit(raws, labels, landmarks=24, ridge=0.5)      # all texts are landmarks: exact kernel ridge regression
    sets = []
    for raw in raws:
        clean = language._clean(raw) + b"   "
        sets.append({clean[i:i + n] for i in range(len(clean) - 3) for n in (1, 2, 3)})
    kernel = np.array([[len(a & b) / np.sqrt(len(a) * len(b)) for b in sets] for a in sets])
    y = np.array([[1.0 if x == name else -1.0 for name in ("xx", "yy")] for x in labels])
    want = kernel @ np.linalg.solve(kernel + 0.5 * np.eye(24), y)
    got = language.score([language._clean(r) for r in raws], model, model.table())
    assert np.allclose(got, want, atol=1e-4)


def test_labels_whose_texts_are_all_long(spark):
    rng = random.Random(2)
    rows = [(k, toy(rng, "xx", 300)) for k in range(15)] + [(100 + k, toy(rng, "yy", 20)) for k in range(15)]
    lang = {i: "xx" if i < 100 else "yy" for i, _ in rows}
    model = language.train(frame(spark, rows, lang), sample_chars=400)
    assert model.labels == ["xx", "yy"]
    got = {r.doc_id: r.lang_pred for r in language.identify(frame(spark, rows), model).collect()}
    assert got == lang
    marked, labels = toxic_rows(rng, 160)
    long = [(i, t if not labels[i] else t + " " + toy(rng, "yy", 400)) for i, t in marked]
    y = spark.createDataFrame([(i, t) for i, t in labels.items()], "doc_id long, toxic int")
    field = toxicity.train(frame(spark, long), y, sample_chars=1000)
    got = {r.doc_id: r.score >= 0.7 for r in toxicity.tag(frame(spark, long), field).collect()}
    assert sum(got[i] == bool(labels[i]) for i in got) >= 150


def test_clashing_names_in_training(spark):
    rng = random.Random(3)
    rows, labels = toxic_rows(rng, 60)
    y = spark.createDataFrame([(i, t) for i, t in labels.items()], "doc_id long, toxic int")
    odd = ("toxic", "lang_pred", "h", "draw", "u", "n", "of", "most", "known", "h64")
    docs = frame(spark, rows, {i: "a" if i % 2 else "b" for i, _ in rows})
    more = docs.select("*", *[F.lit("x").alias(c) for c in odd])
    assert [tuple(r) for r in toxicity.tag(more, toxicity.train(more, y)).select("doc_id", "score").orderBy("doc_id").collect()] == \
        [tuple(r) for r in toxicity.tag(docs, toxicity.train(docs, y)).select("doc_id", "score").orderBy("doc_id").collect()]
    assert language.train(more).labels == ["a", "b"]


def test_gaps_of_any_length():
    field = toxicity.Field(weights={b"wbad": 4.0}, rest=-3.0, step=np.array([[0.4, -0.3], [-0.2, 0.6]]))
    for gap in (0, 3, 256, 257, 1000, 70_001):
        a = np.exp(field.step) * np.array([1.0, np.exp(field.rest)])[None, :]
        p = np.eye(2)
        for _ in range(gap):
            p = p @ a
            p /= p.sum()
        assert np.allclose(field.run(gap), p.ravel() / p.sum(), rtol=1e-9)
    near, far = (field.marginals([b"bad"] + [b"ok"] * n + [b"bad"]) for n in (2, 5000))
    assert len(near) == len(far) == 2 and near[0][1] != far[0][1]


@pytest.mark.parametrize("shingle", [1, 4])
def test_fingerprints_in_pieces(monkeypatch, shingle):
    rng = random.Random(5)
    raws = [(t or "").encode() for _, t in texts()] + [sentence(rng, 500).encode(), b" a  b\n" * 40, b"x" * 90]
    whole = [simhash.fingerprint(r, shingle) for r in raws]
    monkeypatch.setattr(simhash, "CHUNK", 11)
    assert [simhash.fingerprint(r, shingle) for r in raws] == whole


def test_broadcasts_are_bounded_in_bytes(spark, monkeypatch):
    wide = spark.createDataFrame([(k, ["x" * 100] * 50, "y" * 50) for k in range(100)], "k long, a array<string>, s string")
    monkeypatch.setattr(common, "BROADCAST_BYTES", 400_000)
    assert "broadcast" not in common.small(wide)._jdf.queryExecution().toString().lower().split("== optimized")[0]
    assert "broadcast" in common.small(wide.select("k"))._jdf.queryExecution().toString().lower().split("== optimized")[0]


def items_and_docs():
    rng = random.Random(8)
    items = [(k, sentence(rng, n)) for k, n in enumerate((20, 13, 12, 7, 3, 3, 1, 30))] + [(90, None), (91, "...")]
    docs = texts(4) + [(400 + k, sentence(rng, 5) + " " + t + " " + sentence(rng, 9)) for k, t in items if t]
    return items, docs + [(500, items[3][1]), (501, items[4][1] + " " + items[4][1])]


@pytest.mark.parametrize("limit", [0, 10 ** 9])
def test_contamination_with_and_without_broadcasts(spark, monkeypatch, limit):
    monkeypatch.setattr(common, "BROADCAST_BYTES", limit)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        items, docs = items_and_docs()
        out = decontaminate.contamination(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    got = [(r.doc_id, r.n_words, r.n_hit, r.n_items, hashlib.sha256(",".join(r.item_ids).encode()).hexdigest(), r.contaminated)
           for r in out]
    assert sorted(map(str, got)) == sorted(map(str, brute_contamination(docs, items)))


def test_short_items_take_one_pass(spark):
    rows = spark.createDataFrame([(1, ["a", "b"] * 20), (2, []), (3, ["c"])], "row_id long, ws array<string>")
    one = decontaminate.fingerprints(rows, [1, 3, 12])
    assert one._jdf.queryExecution().executedPlan().toString().count("Scan") == 1
    want = decontaminate.winnowed(rows)
    for n in (1, 3, 12):
        want = want.union(decontaminate._all_grams(rows, n))
    key = lambda df: sorted(tuple(r) for r in df.select("row_id", "h", "pos", "size").collect())
    assert key(one) == key(want)


def test_language_stage_rejects_what_it_has_not_learned(spark, scratch):
    rng = random.Random(9)
    good = [(k, toy(rng, "xx", 30)) for k in range(40)]
    odd = [(900, "Съешь же ещё этих мягких французских булок"), (901, "好" * 50), (902, None), (903, "123 !!")]
    out = corpus_pipeline.language_stage(spark, frame(spark, good + odd, {i: "xx" for i, _ in good}), scratch)
    assert {r.doc_id for r in out.collect()} == {i for i, _ in good}


def test_pieces_are_placed_without_a_join(spark):
    plan = packing.pack_documents(frame(spark), length=64, group_docs=7)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
