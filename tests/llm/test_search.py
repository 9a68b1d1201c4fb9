import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from homesense.llm import search as s
from tests.llm.cases import empty, frame, texts

ITEMS = [(1, "abc Abc deé"), (2, None), (3, ""), (3, "na na x"), (None, "TWICE one, two!"), (5, "aß bß cé dd ee"), (6, "...")]


def words(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+", low)


def brute(docs, items, top):
    split = [(i, words(t)) for i, t in docs]
    n, total = sum(1 for _, w in split if w), sum(len(w) for _, w in split)
    df = Counter(t for _, w in split for t in set(w))
    out = []
    for item, text in items:
        found = []
        for i, w in split:
            tf = Counter(w)
            m = 50 + (50 * len(w) * n) // max(total, 1)
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10 ** 9 * tf[t]) // (1000 * tf[t] + 20 * m))
                        for t in set(words(text)) if tf[t])
            if score > 0:
                found.append((-score, i is None, i))
        for rank, (score, _, i) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:top], 1):
            out.append((item, rank, i, -score))
    return sorted(out, key=str)


def items(spark, rows=ITEMS):
    return spark.createDataFrame([(*r, "x") for r in rows], "item_id int, text string, score string")


@pytest.mark.parametrize("top,item_bytes,block", [(50, 4_000_000, 8192), (3, 8, 7), (1, 4_000_000, 2)])
def test_equals_brute_force(spark, monkeypatch, top, item_bytes, block):
    monkeypatch.setattr(s, "BLOCK_DOCS", block)
    docs = texts() + [(1000 + k, "twice one two") for k in range(40)]       # equal scores rank by id
    got = s.search(frame(spark, docs), items(spark), top=top, item_bytes=item_bytes)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute(docs, ITEMS, top)


def test_empty_tables(spark):
    assert s.search(empty(spark), items(spark)).count() == 0
    none = s.search(frame(spark), items(spark, []))
    assert none.count() == 0 and none.columns == ["item_id", "rank", "doc_id", "score"]


def test_text_ids(spark):
    docs = spark.createDataFrame([("b", "x y"), ("a", "x y"), (None, "x y"), ("c", "z")], "doc_id string, text string")
    got = s.search(docs, items(spark, [(1, "x")])).collect()
    assert [(r["rank"], r.doc_id) for r in sorted(got, key=lambda r: r["rank"])] == [(1, "a"), (2, "b"), (3, None)]


def test_many_terms_need_long_masks(spark):
    rng = random.Random(2)
    docs = [(k, " ".join(f"w{rng.randint(0, 400)}" for _ in range(rng.randint(1, 120)))) for k in range(300)]
    asked = [(1, " ".join(f"w{k}" for k in range(0, 400, 2))), (2, "w1 w2 w3")]
    got = s.search(frame(spark, docs), items(spark, asked), top=10)
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute(docs, asked, 10)


def test_masks_below_the_bound_are_left_off(monkeypatch):
    """Only documents whose mask can still enter the best are evaluated."""
    monkeypatch.setattr(s, "STEP", 4)
    n = 1000
    term = np.concatenate([np.zeros(10, np.int64), np.ones(n, np.int64)])
    order = np.argsort(np.concatenate([np.arange(10), np.arange(n)]), kind="stable")
    held = np.ones(n, np.int64)
    held[:10] = 2
    block = s.Postings(list(range(n)), np.full(n, 5, np.int64), held, term[order], np.ones(len(term), np.int64),
                       np.array([900, 10], np.int64), n, 5 * n)
    best = block.improve([], np.array([0, 1]), 4)
    assert [d for _, d in best] == [0, 1, 2, 3]
    evaluated = []
    block.ids = type("Ids", (list,), {"__getitem__": lambda ids, i: evaluated.append(i) or i})(block.ids)
    kept = [(int(block.gain.max()), -1)] * 4                # as good as the best single term
    assert block.improve(kept, np.array([1]), 4) == kept and not evaluated
    assert block.improve(kept, np.array([0, 1]), 4)[0][1] == 0 and len(evaluated) <= 12
