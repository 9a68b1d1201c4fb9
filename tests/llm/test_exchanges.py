import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from homesense.llm import batches, substring
from homesense.llm.decontaminate import contamination
from homesense.llm.ngram_lm import context_bucket, lm_scores, mixture
from homesense.llm.substring import Spans, cut_repeats, recompress
from tests.llm.cases import empty, frame, sentence, texts


def key(x):
    return tuple((v is not None, v) for v in x)


def split(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]


def brute_cut(rows, n=13):
    low = {}
    for i, t in rows:
        w = split(t)
        for k in range(len(w) - n + 1):
            low[tuple(w[k:k + n])] = min(low.get(tuple(w[k:k + n]), math.inf), math.inf if i is None else i)
    out = []
    for i, t in rows:
        w = split(t)
        gone = set()
        for k in range(len(w) - n + 1):
            if low[tuple(w[k:k + n])] < (math.inf if i is None else i):
                gone.update(range(k, k + n))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


@pytest.mark.parametrize("batch", [300, 8_000_000])
def test_cut_repeats_against_brute_force(spark, monkeypatch, batch):
    rng = random.Random(7)
    monkeypatch.setattr(substring, "BATCH_BYTES", batch)
    monkeypatch.setattr(batches.bucket_count, "__defaults__", (batch,))
    parts = [sentence(rng, rng.randint(5, 40)) for _ in range(12)] + ["ab " * 30, "ab cd " * 20]
    rows = texts() + [(200 + k, " ".join(rng.choice(parts) for _ in range(rng.randint(1, 5)))) for k in range(60)]
    rng.shuffle(rows)
    docs = frame(spark, rows)
    cut = cut_repeats(docs)
    assert cut.columns[:len(docs.columns)] == docs.columns
    got = cut.select("doc_id", "__n_words", "__n_removed", "__kept", "text", "words", "row_id").collect()
    assert sorted((tuple(r[:4]) for r in got), key=key) == sorted(brute_cut(rows), key=key)
    assert Counter((r[0], r[4]) for r in got) == Counter(rows) and all(r[5] == ["w"] and r[6] == "r" for r in got)
    assert cut_repeats(empty(spark)).count() == 0


def test_words_of_a_batch_without_a_step_per_word(monkeypatch):
    rng, calls = random.Random(3), []
    digest = substring.xxhash.xxh64_intdigest
    monkeypatch.setattr(substring.xxhash, "xxh64_intdigest", lambda x: calls.append(x) or digest(x))
    some = ["a", "b", "a\0", "\0", "\0\0", "é\x1c", "\x85\xa0", "x" * 8, "x" * 9, "x" * 16, "x" * 17, "x" * 63, "x" * 64,
            "x" * 65, "x" * 65 + "y", "好" * 40, "\u2028x"]
    raws = [None, b"", b" \t\n", b"a"] + [
        "".join(rng.choice(some) + rng.choice([" ", "  ", "\n", "\t\x0b\x0c\r "]) for _ in range(rng.randint(0, 30))).encode()
        for _ in range(40)] + [b"  last word"]
    t, want = substring.Words(raws), [(x or b"").split() for x in raws]
    flat = [w for ws in want for w in ws]
    assert t.lens.tolist() == [len(ws) for ws in want] and t.doc.tolist() == [k for k, ws in enumerate(want) for _ in ws]
    assert [t.buffer[a:b] for a, b in zip(t.first, t.end)] == flat
    for odd in (substring._BASE, substring._SECOND):
        names = t.names(odd, substring.xxhash.xxh64_intdigest).tolist()
        assert len(set(zip(flat, names))) == len(set(flat)) == len(set(names))
    assert calls and min(map(len, calls)) == 65
    left = np.array([rng.random() < 0.6 for _ in flat])
    at = iter(left.tolist())
    assert t.joined(left).to_pylist() == [b" ".join([w for w in ws if next(at)]).decode() for ws in want]
    for raws in ([], [None], [b"", b" "]):
        t = substring.Words(raws)
        assert not len(t.names(1, digest)) and t.joined(np.zeros(0, bool)).to_pylist() == [""] * len(raws)


def test_symbols_agree_inside_a_repeat():
    rng = np.random.default_rng(1)
    inner = rng.integers(0, 4, 60).astype(np.uint64)
    seen = []
    for side in range(20):
        left, right = (rng.integers(0, 4, rng.integers(1, 30)).astype(np.uint64) for _ in range(2))
        names = np.concatenate([left, inner, right])
        at, doc = np.arange(len(names)), np.zeros(len(names), np.int64)
        x = (names, doc, at, at)
        for r in range(3):
            x = recompress(*x, r)
        off = len(left)
        ok = (x[2] >= off) & (x[3] < off + len(inner))
        seen.append({(int(n), int(lo) - off, int(hi) - off) for n, lo, hi in zip(x[0][ok], x[2][ok], x[3][ok])})
    assert seen[0] and all(s == seen[0] for s in seen)


def test_span_hashes_depend_on_content_alone():
    names = np.array([5, 6, 7, 1, 5, 6, 7, 6, 5], np.uint64)
    h = Spans(names)
    a, b, c = (h(np.array([i]), np.array([i + 2]))[0] for i in (0, 4, 6))
    assert a == b != c


def test_lm_against_brute_force(spark):
    rows = texts()
    doc = F.coalesce(F.col("doc_id"), F.lit(1))
    train, fold = doc % 4 != 2, doc % 4 == 3
    got = lm_scores(frame(spark, rows), train, fold).collect()

    def tokens(t):
        return [w.encode() for w in split("".join(c.lower() if c.isascii() else c for c in t or ""))] + [None]
    learn = [(1 if i is None else i) % 4 != 2 for i, _ in rows]
    uni, bi = Counter(), Counter()
    for (_, t), yes in zip(rows, learn):
        if yes:
            uni.update(tokens(t))
            bi.update(zip([0, *tokens(t)], tokens(t)))
    n, v = sum(uni.values()), len(uni)
    uni[0] = uni[None]
    want = sorted((-1 if i is None else i, len(tokens(t)), sum(uni[w] > 0 for w in tokens(t)), n,
                   round(sum(math.log10((uni[w] + 1) / (n + v + 1)) for w in tokens(t)), 6)) for i, t in rows)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
                  for r in got) == want
    assert all(math.isfinite(r.score) and r.score <= 0 for r in got)
    # the mixture is a distribution: its value lies between its parts
    seen = [r for r in got if r.train and r.n_tokens > 50]
    assert all(r.score > r.base_score for r in seen)
    assert lm_scores(empty(spark), F.lit(True), F.lit(False)).count() == 0


def brute_mixture(rows, train, fold, order):
    """Scores of all rows by dictionaries: counts, cells of the fold's distinct texts without their copies, mixture."""
    def tokens(t):
        return [w.encode() for w in split("".join(c.lower() if c.isascii() else c for c in t or ""))] + ["end"]

    def grams(t):
        w = ["start"] * (order - 1) + tokens(t)
        at = range(order - 1, len(w))
        return [[tuple(w[i - k:i + 1]) for k in range(order)] for i in at], [[tuple(w[i - k:i]) for k in range(order)] for i in at]
    counts, contexts = Counter(), Counter()
    for (i, t), yes in zip(rows, train):
        if yes:
            g, h = grams(t)
            counts.update(x for xs in g for x in xs)
            contexts.update(x for xs in h for x in xs[1:])
    v = sum(len(k) == 1 and c > 0 for k, c in counts.items())
    n = sum(c for k, c in counts.items() if len(k) == 1)
    levels = max(1, 8 // order)

    def estimates(g, h, own, own_h, copies, n):
        ps, bucket = [(counts[g[0]] - copies * own[g[0]]) / max(n, 1)], 0
        for k in range(1, order):
            c = contexts[h[k]] - copies * own_h[h[k]]
            ps.append(min(counts[g[k]] - copies * own[g[k]], c) / c if c > 0 else 0.0)
            bucket = (k - 1) * 48 + min(47, 1 + int(math.log2(c))) if c > 0 else bucket
        return ps, bucket
    cells, done = Counter(), set()
    for (i, t), yes in zip(rows, fold):
        if not yes or (t or "") in done:
            continue
        done.add(t or "")
        copies = sum(y and (u or "") == (t or "") for (_, u), y in zip(rows, train))
        g, h = grams(t)
        own, own_h = Counter(x for xs in g for x in xs), Counter(x for xs in h for x in xs[1:])
        for x, y in zip(g, h):
            ps, b = estimates(x, y, own, own_h, copies, n - copies * len(g))
            cells[(b, *[1 + round(-levels * math.log2(p)) if p > 0 else 0 for p in reversed(ps)])] += 1
    lam = mixture(np.array([(*k, c) for k, c in sorted(cells.items())], np.int64).reshape(-1, order + 2), 1 / (v + 1), levels)
    out = []
    for i, t in rows:
        total, none = 0.0, Counter()
        for x, y in zip(*grams(t)):
            ps, b = estimates(x, y, none, none, 0, n)
            total += math.log10(sum(a * p for a, p in zip(lam[b], reversed(ps))) + lam[b][-1] / (v + 1))
        out.append((-1 if i is None else i, round(total, 6)))
    return sorted(out)


@pytest.mark.parametrize("order, batch", [(1, 5_000_000), (2, 300), (2, 5_000_000), (3, 2_000)])
def test_lm_scores_against_dictionaries(spark, monkeypatch, order, batch):
    monkeypatch.setattr(batches.batched, "__defaults__", (batch,))
    monkeypatch.setattr(batches.bucket_count, "__defaults__", (batch,))
    rows = texts() + [(100 + k, "copies of one text in all folds") for k in range(9)]
    ids = [1 if i is None else i for i, _ in rows]
    doc = F.coalesce(F.col("doc_id"), F.lit(1))
    got = lm_scores(frame(spark, rows), doc % 4 != 2, doc % 4 == 3, order=order).collect()
    want = brute_mixture(rows, [i % 4 != 2 for i in ids], [i % 4 == 3 for i in ids], order)
    have = sorted((-1 if r.doc_id is None else r.doc_id, round(r.score, 6)) for r in got)
    assert [x[0] for x in have] == [x[0] for x in want]
    assert np.allclose([x[1] for x in have], [x[1] for x in want], atol=1e-5)


def test_exchange_rows_follow_the_keys():
    """Buckets beyond the number of keys add no rows."""
    keys = batches.mix(np.arange(100, dtype=np.uint64))
    for n in (1, 7, 1000, 10 ** 8):
        order, parts = batches.by_bucket(keys, n)
        assert len(parts) <= min(n, 100) and all(lo < hi for _, lo, hi in parts)
        assert sorted(order.tolist()) == list(range(100)) and parts[0][1] == 0 and parts[-1][2] == 100
    assert batches.by_bucket(keys[:0], 5)[1] == []


def test_windows_with_one_equal_hash_stay_apart():
    a, b, of = substring._distinct(np.array([7, 7, 7, 3], np.uint64), np.array([1, 2, 1, 1], np.uint64))
    assert a.tolist() == [3, 7, 7] and b.tolist() == [1, 1, 2] and of.tolist() == [1, 2, 1, 0]


def test_lm_without_training_rows(spark):
    got = lm_scores(frame(spark), F.lit(False), F.lit(False)).collect()
    assert len(got) == len(texts()) and all(r.base_score == 0 and r.train_tokens == 0 for r in got)


def test_mixture_finds_planted_weights():
    rng = np.random.default_rng(2)
    rows = []
    for _ in range(4000):     # a word drawn from the pair estimate with 0.7, else from the single one
        l2, l1 = int(rng.integers(1, 20)), int(rng.integers(20, 60))
        p2, p1 = 2 ** (-(l2 - 1) / 4), 2 ** (-(l1 - 1) / 4)
        rows.append((3, l2 if rng.random() < 0.7 * p2 / (0.7 * p2 + 0.3 * p1) else 0, l1, 1))
    lam = mixture(np.array(rows), 1e-9)
    assert np.allclose(lam.sum(axis=1), 1) and lam[3, 0] > 0.5 and lam[0, 0] == 0
    assert context_bucket(np.array([0, 1, 2, 3, 4])).tolist() == [0, 1, 2, 2, 3]


def brute_contamination(rows, items, n=13):
    def words(t):
        low = "".join(c.lower() if c.isascii() else c for c in t or "")
        return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)
    windows = {}
    for i, t in items:
        w = words(t)
        k = min(n, len(w))
        for s in range(len(w) - k + 1 if w else 0):
            windows.setdefault(tuple(w[s:s + k]), set()).add(i)
    sizes = {len(w) for w in windows}
    out = []
    for i, t in rows:
        w = words(t)
        hit, ids = set(), set()
        for k in sizes:
            for s in range(len(w) - k + 1):
                if tuple(w[s:s + k]) in windows:
                    hit.update(range(s, s + k))
                    ids |= windows[tuple(w[s:s + k])]
        ids = sorted(str(x) for x in ids if x is not None)
        out.append((i, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(),
                    bool(hit) and 20 * len(hit) >= len(w)))
    return out


def test_contamination_against_brute_force(spark):
    rng = random.Random(8)
    items = [(k, sentence(rng, rng.randint(13, 40))) for k in range(12)]
    items += [(20, "short item here"), (21, "a"), (22, None), (23, "..."), (24, items[0][1]), (None, sentence(rng, 15)),
              (25, "na " * 14), (26, items[1][1] + " " + items[2][1]), (27, "Seven word item is exactly this long")]
    rows = texts()
    for k in range(40):
        w = rng.choice(items)[1] or ""
        w = w.split()
        lo = rng.randint(0, max(0, len(w) // 2))
        rows.append((300 + k, sentence(rng, rng.randint(0, 60)) + " " + ", ".join(w[lo:]).upper() + "! " + sentence(rng, rng.randint(0, 300))))
    rows.append((400, " ".join(sentence(rng, 40) + " " + t for _, t in items[:6])))
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, h string")
    got = contamination(frame(spark, rows), bench).select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "item_ids"), 256).alias("h"), "contaminated")
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(brute_contamination(rows, items), key=key)
    assert contamination(empty(spark), bench).count() == 0
    none = contamination(frame(spark, rows), bench.limit(0)).collect()
    assert len(none) == len(rows) and not any(r.contaminated or r.n_hit for r in none)
