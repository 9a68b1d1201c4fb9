import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from homesense.llm import quality as q
from homesense.llm.batches import mix, mix2
from tests.llm.cases import empty, frame, sentence, texts


def labels(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, quality int, trusted string")


def brute_base(text):
    t = text or ""
    w = re.findall("[^\\x20\\x09-\\x0D]+", t)
    grams = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    hit = {i + k for i in range(len(w) - 4) if grams[tuple(w[i:i + 5])] > 1 for k in range(5)}
    lines = [x for x in t.split("\n") if re.search("[^\\x20\\x09-\\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit)


def brute_buckets(text, n):
    """Bytes of the tokens -> polynomial hash modulo 2**64, neighbours paired, both reduced to buckets."""
    one = lambda x: np.array([x & (2 ** 64 - 1)], np.uint64)
    h = [mix(one(sum((c + 1) * pow(q._BASE, k, 1 << 64) for k, c in enumerate(t))))
         for t in re.findall(rb"[0-9A-Za-z\x80-\xff]+|[!-/:-@\[-`{-~]", (text or "").encode())]
    return [(int(x[0]) >> 20) % n for x in [*h, *[mix2(a, b) for a, b in zip(h, h[1:])]]]


def test_equals_brute_force(spark):
    rng = random.Random(3)
    junk = [(100 + k, " ".join(w + "***" for w in sentence(rng, 60).split())) for k in range(12)]
    docs = texts() + junk + [(200, "a b c d e " * 3 + "\n" + "a b c d e\na b c d e\n \n \n| <x>"), (201, "é" * 9 + "  ")]
    good = [(i, 1) for i in range(20, 45)] + [(0, 1), (0, 0), (None, 1), (1, None), (9999, 1)]
    ratios = q.learn(frame(spark, docs), labels(spark, good), n_buckets=512)
    trusted = set(range(20, 45))
    raw_n, trusted_n = Counter(), Counter()
    for i, t in docs:
        b = brute_buckets(t, 512)
        raw_n.update(b)
        trusted_n.update(b if i in trusted else [])
    want = [math.log((trusted_n[b] + 1) / (sum(trusted_n.values()) + 512)) - math.log((raw_n[b] + 1) / (sum(raw_n.values()) + 512))
            for b in range(512)]
    assert ratios == pytest.approx(want)
    out = q.judge(frame(spark, docs), ratios, threshold=-0.2).collect()
    expected = []
    for i, t in docs:
        base = brute_base(t)
        b = brute_buckets(t, 512)
        llr = sum(want[x] for x in b) / (len(b) + q.PRIOR) if b else 0.0
        failed = base[0] < 10 or 100 * base[4] > 20 * base[0]
        expected.append((i, *base, round(llr, 9), failed, not failed and llr >= -0.2))
    key = lambda r: (str(r[0]), *r[1:])
    got = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, round(r.llr, 9), r.base_failed, r.kept)
           for r in out]
    assert sorted(got, key=key) == sorted(expected, key=key)
    assert not any(r.kept for r in out if r.doc_id is not None and 100 <= r.doc_id < 112)
    assert all(r.kept for r in out if r.doc_id in trusted and not r.base_failed)


def test_without_labels_only_the_base_rules_reject(spark):
    ratios = q.learn(frame(spark), labels(spark, []))
    assert not ratios.any()
    assert all(r.kept != r.base_failed for r in q.judge(frame(spark), ratios).collect())
    assert q.judge(empty(spark), q.learn(empty(spark), labels(spark, [(1, 1)]))).count() == 0


def test_the_trusted_side_is_bounded(spark):
    docs = frame(spark, [(k, f"word{k} and more") for k in range(30)])
    few = q.learn(docs, labels(spark, [(k, 1) for k in range(30)]), n_buckets=64, most=1)
    one = [q.learn(docs, labels(spark, [(k, 1)]), n_buckets=64) for k in range(30)]
    assert sum(np.array_equal(few, x) for x in one) == 1


def test_ngrams_across_pieces(monkeypatch):
    texts = [sentence(random.Random(8), 400).encode(), None, b"", b"a,b*", sentence(random.Random(9), 90).encode()]

    def found():
        out = {}
        for group, last in q.hashed(iter(texts)):
            for b, t in zip(*group.ngrams(last, 4096)):
                out.setdefault(int(t), []).append(int(b))
        return {t: sorted(b) for t, b in out.items()}

    whole = found()
    assert whole == {k: sorted(brute_buckets(t.decode(), 4096)) for k, t in enumerate(texts) if t}
    monkeypatch.setattr(q, "CHUNK", 40)
    assert found() == whole


def test_long_texts_and_words(spark, monkeypatch):
    monkeypatch.setattr(q, "CHUNK", 64)
    long = "aa bb cc dd ee ff " * 30 + "x" * 300 + "\n"
    out = q.judge(frame(spark, [(1, long), (2, "short one")]).coalesce(1), np.zeros(512)).orderBy("doc_id").collect()
    assert [(r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in out] == [brute_base(long), brute_base("short one")]


def test_repeats_with_many_distinct_words():
    words = [b"w%d" % k for k in range(9000)]       # too many for five words in one number
    assert q.repeated_words(words + words[100:107]) == 14
    assert q.repeated_words(words) == 0 == q.repeated_words([b"a"] * 5) == q.repeated_words([])
    assert q.repeated_words([b"a"] * 6) == 6
