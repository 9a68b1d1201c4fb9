import random

import numpy as np
from pyspark.sql import functions as F

from homesense.llm import language, toxicity
from homesense.llm.licenses import MIN_DICE, Scanner, bigrams, scan_licenses, words_of
from homesense.llm.license_texts import TEMPLATES
from tests.llm.cases import empty, frame, texts

STEMS = {"xx": ["kra", "kro", "kri", "aka"], "yy": ["lume", "lomi", "ulo", "mul"]}


def toy(rng, lang, n):
    return " ".join("".join(rng.choice(STEMS[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def test_language_separates_and_rejects(spark):
    rng = random.Random(2)
    rows = [(i, toy(rng, "xx" if i % 2 else "yy", 30)) for i in range(80)]
    lang = {i: "xx" if i % 2 else "yy" for i, _ in rows}
    model = language.train(frame(spark, rows, lang))
    assert model.labels == ["xx", "yy"]
    probe = texts() + [(200, toy(rng, "xx", 5)), (201, toy(rng, "yy", 20000))]
    got = language.identify(frame(spark, probe), model).collect()
    assert len(got) == len(probe) and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r.lang_pred for r in got}
    assert by[200] == "xx" and by[201] == "yy"
    assert by[3] == by[4] == by[5] == by[16] == "und" and by[6] in ("xx", "yy")
    assert language.identify(empty(spark), model).count() == 0


def test_language_learned_from_nothing(spark):
    model = language.train(empty(spark))
    assert {r.lang_pred for r in language.identify(frame(spark), model).collect()} == {"und"}


def copies_that_sort_first(spark, seed):
    """600 rows, a third of them copies of the text with the lowest draw; the even distinct ones are of kind 0."""
    rng = random.Random(seed)
    pool = [(i, toy(rng, "yy", 12)) for i in range(400)]
    h = F.pmod(F.xxhash64("text", F.lit(seed)), F.lit(1 << 30))
    first = frame(spark, pool).orderBy(h, "doc_id").first()
    return pool + [(1000 + 2 * k + first.doc_id % 2, first.text) for k in range(200)]


def test_language_sample_holds_a_text_once(spark, monkeypatch):
    rows = copies_that_sort_first(spark, 7)
    monkeypatch.setattr(language, "fit", lambda texts, labels: (texts, labels))
    drawn, labels = language.train(frame(spark, rows, {i: ("xx", "yy")[i % 2] for i, _ in rows}), sample=100)
    assert len(set(drawn)) == len(drawn) == 100 and 30 <= labels.count("xx") <= 70


def test_toxicity_sample_holds_a_text_once(spark, monkeypatch):
    rows = copies_that_sort_first(spark, 11)
    monkeypatch.setattr(toxicity, "fit", lambda raws, labels, *_: (raws, labels))
    y = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    drawn, labels = toxicity.train(frame(spark, rows), y, sample=100)
    assert len(set(drawn)) == len(drawn) == 100 and 30 <= sum(labels) <= 70


def test_long_text_in_pieces_equals_whole(monkeypatch):
    rng = random.Random(3)
    raws = [toy(rng, k, 300).encode() for k in ("xx", "yy")]
    model = language.fit(raws, ["xx", "yy"])
    at, clean = model.table(), [language._clean(t) for t in raws]
    whole = language.score(clean, model, at)
    monkeypatch.setattr(language, "PIECE", 37)
    assert np.allclose(whole, language.score(clean, model, at))


def test_presence_kernel_against_sets():
    raws = [b"abca", "é-X1".encode()]
    model = language.fit(raws, ["a", "b"], ridge=0.1)
    x = language._presence([language._clean(t) for t in raws], model.table(), len(model.grams))
    for row, raw in zip(x, raws):
        clean = language._clean(raw) + b"   "
        grams = {int.from_bytes(clean[i:i + n], "big") for i in range(len(clean) - 3) for n in (1, 2, 3)}
        assert set(model.grams[row > 0].tolist()) == grams


def toxic_rows(rng, n):
    bad = ["grumbo" + s for s in ("ix", "at", "el", "um", "ot")]
    rows, labels = [], {}
    for i in range(n):
        words = [toy(rng, "yy", 1) for _ in range(rng.randint(10, 60))]
        labels[i] = int(i % 4 == 0)
        if labels[i]:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((i, " ".join(words)))
    return rows, labels


def test_toxicity_held_out_and_spans(spark):
    rng = random.Random(4)
    rows, labels = toxic_rows(rng, 400)
    y = spark.createDataFrame([(i, 1, t) for i, t in labels.items()] + [(9999, 1, 1), (1, 1, None)],
                              "doc_id long, quality int, toxic int")
    model = toxicity.train(frame(spark, rows[:300]), y)
    probe = rows[300:] + [(500, "Fine " * 20 + "Grumbozz, éé GRUMBOix " + "mul " * 20)] + [(600 + k, t) for k, (_, t) in enumerate(texts())]
    got = {r.doc_id: r for r in toxicity.tag(frame(spark, probe), model).collect()}
    assert all(0 <= r.score <= 1 for r in got.values()) and len(got) == len(probe)
    right = sum((got[i].score >= 0.7) == bool(labels[i]) for i, _ in rows[300:])
    assert right >= 0.97 * 100
    text = dict(probe)[500]
    assert got[500].score >= 0.7 and {text[s.start:s.stop] for s in got[500].spans} == {"Grumbozz", "GRUMBOix"}
    assert got[603].spans == [] and got[603].score < 0.5      # null text
    assert toxicity.tag(empty(spark), model).count() == 0


def test_toxicity_learns_from_texts_that_sort_last():
    rng = random.Random(8)
    early, late = ["grumbo" + s for s in ("ix", "at", "el")], ["ягрум" + s for s in ("ба", "во", "ги")]
    raws, labels = [], []
    for i in range(900):
        words = [toy(rng, "yy", 1) for _ in range(40)]
        bad = None if i % 3 == 0 else late if i % 18 == 1 else early
        for _ in range(0 if bad is None else 3 if bad is late else 8):
            words.insert(rng.randrange(1, len(words)), rng.choice(bad))
        raws.append((("я " if bad is late else "a ") + " ".join(words)).encode())
        labels.append(int(bad is not None))
    model = toxicity.fit(raws, labels)
    assert all(b"w" + w.encode() in model.weights for w in early + late)
    text = toxicity.words_of(" ".join(["mul"] * 20 + late + ["mul"] * 20).encode())
    found = model.marginals(text)
    assert {k for k, p in found if p >= toxicity.SPAN_MARGINAL} == {20, 21, 22} and model.document_score(found) >= 0.7


def test_every_mark_has_windows_beyond_the_bound():
    texts = [np.array([1] * 30 + [2 + i]) for i in range(9)]
    own = {k: [b"w%d" % k] for k in range(1, 11)}
    places = toxicity._places(texts, [np.ones(31, bool)] * 9, own, 3)
    assert {int(texts[i][k]) for i, k in places} == set(own)
    spread = toxicity._places(texts, [np.ones(31, bool)] * 9, own, 31)
    assert len(spread) == 31 and {i for i, _ in spread[13:]} == set(range(9))


def test_toxicity_without_labels(spark):
    model = toxicity.train(empty(spark), spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r.score < 0.5 for r in toxicity.tag(frame(spark), model).collect()} == {True}


def test_marginals_against_all_paths():
    model = toxicity.Field({b"wab": 2.0, b"wcd": -1.0}, -1.5, np.array([[0.3, -0.4], [0.1, 0.9]]))
    words = [b"x", b"ab", b"x", b"x", b"cd", b"ab", b"x"]
    state = [0.0 if w == b"x" else model.weights[b"w" + w] for w in words]
    total, on = 0.0, np.zeros(len(words))
    for path in range(2 ** len(words)):
        s = [path >> k & 1 for k in range(len(words))]
        e = np.exp(sum((state[k] - 1.5) * s[k] for k in range(len(words)))
                   + sum(model.step[a, b] for a, b in zip(s, s[1:])))
        total, on = total + e, on + e * np.array(s)
    for k, p in model.marginals(words):
        assert abs(p - on[k] / total) < 1e-9


def test_license_scan_against_brute_force(spark):
    rng = random.Random(5)
    rows = texts()
    for k, (_, _, text) in enumerate(TEMPLATES):
        words = text.split()
        if len(words) > 30:
            words[rng.randrange(len(words))] = "changed"
        rows.append((1000 + k, "Intro line\n\n" + " ".join(words) + "\n\nsome code here"))
        rows.append((2000 + k, "\n".join(["first", text.replace("\n", " "), "last"])))
    rows.append((3000, "© é\n" + TEMPLATES[1][2]))

    def dice(a, b):
        a, b = bigrams(words_of(a)), bigrams(words_of(b))
        n = sum(a.values()) + sum(b.values())
        return 2 * sum((a & b).values()) / n if a and b else 0
    got = scan_licenses(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        text = [t for i, t in rows if i == r.doc_id]
        for m in r.matches:
            unit = next(t for t in text if t and len(t) >= m.stop)[m.start:m.stop]
            all_ = [(-dice(unit.encode(), t.encode()), n, k) for n, k, t in TEMPLATES]
            best = min(all_)
            assert (m.license, m.kind) == best[1:] and abs(m.dice + best[0]) < 1e-12 and m.dice >= MIN_DICE
        if r.doc_id is not None and 1000 <= r.doc_id <= 3000:
            assert len(r.matches) == 1
        else:
            assert not r.matches
    assert scan_licenses(empty(spark)).count() == 0


def test_licenses_in_their_usual_layout_inside_longer_texts():
    scanner, by = Scanner(), {(n, k): t for n, k, t in TEMPLATES}
    breaks = {"MIT": ["The above", "THE SOFTWARE"], "BSD-2-Clause": ["1. Redis", "2. Redis", "THIS SOFTWARE"],
              "BSD-3-Clause": ["1. Redis", "2. Redis", "3. Neither", "THIS SOFTWARE"],
              "ISC": ["THE SOFTWARE"], "Zlib": ["Permission", "1. The", "2. Altered", "3. This"],
              "Unlicense": ["Anyone", "In jurisdictions"]}
    for name, starts in breaks.items():
        text = " ".join(by[name, "text"].split())
        for s in starts:
            text = text.replace(s, "\n\n" + s, 1)
        raw = "# Toolé\n\nHow to build the thing.\n\n" + text + "\n\n## Usage\n\nCall the software with care."
        got = scanner.scan(raw.encode())
        assert [(m["license"], m["kind"], m["dice"]) for m in got] == [(name, "text", 1.0)]
        assert raw[got[0]["start"]:got[0]["stop"]] == text.rstrip(".")
    notice = by["Apache-2.0", "notice"].replace(" Unless", "\n\n Unless").replace(" See", "\n\n See").replace("\n", "\n# ")
    for name, raw in [("Apache-2.0", "import x\n# " + notice + "\nimport y\n"),
                      ("Apache-2.0", 'x\nLicensed under the Apache License, Version 2.0 (the "License");\ny'),
                      ("MIT", "The tool is free. It is released\nunder the MIT\nLicense. It has no other terms at all."),
                      ("CC-BY-4.0", "All pictures here, old and new, are licensed under CC BY 4.0, as said above.")]:
        assert [m["license"] for m in scanner.scan(raw.encode())] == [name]
    both = (by["MIT", "text"] + "\n\n" + by["ISC", "text"] + " and " + by["MIT", "text"]).encode()
    assert [m["license"] for m in scanner.scan(both)] == ["MIT", "ISC", "MIT"]


def test_runs_against_all_runs():
    rng, scanner = random.Random(9), Scanner(0.7, [("A", "x", "a b c d a b"), ("B", "x", "c d e f g h a b c")])
    for _ in range(150):
        words = [rng.choice("abcdefgh").encode() for _ in range(25)]
        any_ = any(scanner.best(words[i:j]) for i in range(25) for j in range(i + 2, 26))
        got = scanner.scan(b" ".join(words))
        assert bool(got) == any_
        for m in got:
            assert scanner.best(words_of(b" ".join(words)[m["start"]:m["stop"]])) == (m["dice"], m["license"], m["kind"])


def test_size_bounds_prune_nothing_that_matches():
    rng = random.Random(6)
    scanner = Scanner(0.6)
    for name, kind, text in TEMPLATES:
        words = words_of(text.encode())
        cut = words[rng.randrange(max(1, len(words) // 4)):]
        all_ = [(2 * sum((bigrams(cut) & g).values()) / (len(cut) - 1 + n), -k) for k, (n, _, _, g) in enumerate(scanner.templates)] \
            if len(cut) > 1 else []
        best = max((d for d, _ in all_), default=0)
        hit = scanner.best(cut)
        assert (hit is None) == (best < 0.6) and (hit is None or abs(hit[0] - best) < 1e-12)
