"""Toxic spans by a linear-chain conditional random field.

Two states, O and T, run along the words of a text. A word's state score is the sum of the weights of its
features (the word and its prefixes of 4 to 6 characters); a 2x2 table scores neighbouring states. Training
tokens get their labels from document labels: a feature whose distinct contexts (previous word, word, next
word) lie almost only in toxic documents marks its words in toxic documents as T; a prefix must do so without its most frequent word, too. Contexts rather than
documents are counted, so copies of one toxic document don't turn its harmless words into signs. The field is
trained by gradient ascent on the conditional likelihood of windows around marked words and of clean windows.
Distinct texts give windows in the order of a hash: every marked feature from ``EACH`` texts first, then one
more word of each text in turn up to the bound, so no feature and no text is left out by the way it sorts.

Scoring runs forward-backward over the whole text. Words without known features share one score, so a run of
them is a power of one matrix, taken from a table. Marginals of T give offending offsets, and their sum and
maximum give the document score through logistic regression. Fitting uses a sample bounded by ``SAMPLE``
labelled texts of at most ``SAMPLE_CHARS`` characters, half of each label in expectation.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homesense.llm.batches import mix2
from homesense.llm.common import row_key, stage, text_bytes
from homesense.llm.language import drawable

SAMPLE = 4000
SAMPLE_CHARS = 20_000
MIN_CONTEXTS = 12
MIN_PURITY = 0.95     # at equal numbers of clean and toxic contexts
MIN_SHARE = 0.8       # as counted
WINDOW = 10
MAX_WINDOWS = 6000    # half of them around marked words
EACH = 4
STEPS = 250
CACHE = 100_000
RUN = 256             # tabled powers of the step matrix
SPAN_MARGINAL = 0.5

_WORD = re.compile(rb"[a-z\x80-\xff]+")


def words_of(raw: bytes | None) -> list[bytes]:
    return _WORD.findall(raw.lower()) if raw else []


def features(word: bytes) -> list[bytes]:
    """The word and its prefixes of 4 to 6 characters."""
    text = word.decode("utf-8", "replace")
    return [b"w" + word, *[b"p" + text[:k].encode() for k in range(4, 7) if len(text) >= k]]


@dataclass
class Field:
    """``weights``: feature -> score of T over O; ``rest``: score of a word without known features;
    ``step``: log scores of (state, next state); ``doc``: logistic weights of the document score."""
    weights: dict[bytes, float] = field(default_factory=dict)
    rest: float = -6.0
    step: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    doc: tuple[float, float, float] = (-2.0, 0.0, 0.0)
    _score: dict[bytes, float] = field(default_factory=dict)
    _runs: list | None = None

    def word_score(self, word: bytes) -> float | None:
        known = [self.weights[f] for f in features(word) if f in self.weights]
        return self.rest + sum(known) if known else None

    def run(self, gap: int) -> tuple[float, float, float, float]:
        """The scaled ``gap``-th power of the step matrix over words without known features: tabled up to ``RUN``, beyond
        that put together from its squares."""
        runs = self.runs()
        if gap <= RUN:
            return runs[gap]
        out, square, gap = runs[gap % RUN], runs[RUN], gap // RUN
        while gap:
            if gap & 1:
                out = _product(out, square)
            square, gap = _product(square, square), gap >> 1
        return out

    def runs(self) -> list[tuple[float, float, float, float]]:
        """Scaled powers of the step matrix over words without known features."""
        if self._runs is None:
            a = np.exp(self.step) * np.array([1.0, math.exp(self.rest)])[None, :]
            p, self._runs = np.eye(2), []
            for _ in range(RUN + 1):
                self._runs.append(tuple((p / p.sum()).ravel().tolist()))
                p = (p @ a)
                p /= p.sum()
        return self._runs

    def marginals(self, words: list[bytes]) -> list[tuple[int, float]]:
        """(word number, marginal of T) of every word that has a known feature."""
        cache, hits = self._score, []
        if len(cache) > CACHE:
            cache.clear()
        for k, w in enumerate(words):
            s = cache.get(w, 0)
            if s == 0:
                s = cache[w] = self.word_score(w)
            if s is not None:
                hits.append((k, math.exp(min(50.0, s))))
        if not hits:
            return []
        aa, ab, ba, bb = np.exp(self.step).ravel().tolist()
        # state of the first word before its own score counts; then it is a step like the others
        forward, o, t, last = [], 1.0, math.exp(self.rest), 0
        for k, e in hits:
            if not k:
                t = 1.0
            else:
                m = self.run(max(0, k - last - 1))
                o, t = o * m[0] + t * m[2], o * m[1] + t * m[3]
                o, t = o * aa + t * ba, o * ab + t * bb
            t *= e
            o, t = o / (o + t), t / (o + t)
            forward.append((o, t))
            last = k
        out, o, t, nxt = [], 0.5, 0.5, len(words)
        for (k, _), (fo, ft), later in zip(reversed(hits), reversed(forward), [None, *[e for _, e in reversed(hits)][:-1]]):
            gap = nxt - k - 1
            if later is not None:
                t *= later
                o, t = o * aa + t * ab, o * ba + t * bb
            m = self.run(gap)
            o, t = o * m[0] + t * m[1], o * m[2] + t * m[3]
            o, t = o / (o + t), t / (o + t)
            out.append((k, ft * t / (fo * o + ft * t)))
            nxt = k
        return out[::-1]

    def document_score(self, marginals: list[tuple[int, float]]) -> float:
        x = _summary(marginals)
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, self.doc[0] + self.doc[1] * x[0] + self.doc[2] * x[1]))))


def _product(p: tuple, q: tuple) -> tuple[float, float, float, float]:
    """The product of two 2 x 2 matrices, scaled to sum 1."""
    out = (p[0] * q[0] + p[1] * q[2], p[0] * q[1] + p[1] * q[3], p[2] * q[0] + p[3] * q[2], p[2] * q[1] + p[3] * q[3])
    total = sum(out)
    return tuple(x / total for x in out)


def _summary(marginals: list[tuple[int, float]]) -> tuple[float, float]:
    return (math.log1p(sum(p for _, p in marginals)), max((p for _, p in marginals), default=0.0))


def _context_counts(texts: list[np.ndarray], n_words: int) -> np.ndarray:
    """For each word number: its distinct contexts (word before, word, word after) in the texts."""
    if not texts:
        return np.zeros(n_words, np.int64)
    padded = [np.concatenate([[0], t + 1, [0]]).astype(np.uint64) for t in texts]
    key = np.concatenate([mix2(mix2(p[:-2], p[1:-1]), p[2:]) for p in padded])
    _, first = np.unique(key, return_index=True)
    return np.bincount(np.concatenate(texts)[first], minlength=n_words)


def _marks(names: list[bytes], toxic: np.ndarray, clean: np.ndarray) -> set[bytes]:
    """Features whose distinct contexts lie almost only in toxic texts, from the context counts of all words."""
    counts, top = Counter(), {}
    for k in np.flatnonzero(toxic).tolist():
        for f in features(names[k]):
            counts[f] += int(toxic[k])
            if f not in top or toxic[k] > toxic[top[f]]:
                top[f] = k
    counts = {f: n for f, n in counts.items() if n >= MIN_CONTEXTS}
    others = Counter()
    for k in np.flatnonzero(clean).tolist():
        for f in features(names[k]):
            if f in counts:
                others[f] += int(clean[k])
    rate = max(1, int(clean.sum())) / max(1, int(toxic.sum()))

    def telling(n: int, m: int) -> bool:
        even = m / rate
        return (n >= MIN_CONTEXTS and n >= MIN_PURITY * (n + even) and n >= MIN_SHARE * (n + m)
                and n * math.log((n + 0.5) / (even + 0.5)) > 20)
    return {f for f, n in counts.items() if telling(n, others[f])
            and (f[:1] == b"w" or telling(n - int(toxic[top[f]]), others[f] - int(clean[top[f]])))}


def _places(texts: list[np.ndarray], tags: list[np.ndarray], own: dict[int, list[bytes]], most: int) -> list[tuple[int, int]]:
    """(text, word) of the windows around tagged words. Every feature in ``own`` (word number -> marked features)
    gets ``EACH`` texts that hold it (or all), even beyond ``most``; then each text gives one more word in turn."""
    out, left, given = [], [], Counter()
    rng = np.random.default_rng(0)
    for i, (t, tag) in enumerate(zip(texts, tags)):
        here, rest = set(), []
        for k in rng.permutation(np.flatnonzero(tag)).tolist():
            new = [f for f in own[int(t[k])] if f not in here and given[f] < EACH]
            if new:
                here.update(new)
                given.update(new)
                out.append((i, k))
            else:
                rest.append(k)
        left.append(rest)
    turn = 0
    while len(out) < most and any(left):
        more = [(i, rest[turn]) for i, rest in enumerate(left) if turn < len(rest)]
        if not more:
            break
        out += more[:most - len(out)]
        turn += 1
    return out


def fit(raws: list[bytes], toxic: list[int], max_windows: int = MAX_WINDOWS) -> Field:
    """Marks words, trains the field on windows of words and calibrates the document score. At most half of
    ``max_windows`` are clean, and as many lie around marked words unless the marked features need more."""
    model = Field()
    if not 0 < sum(toxic) < len(toxic):
        if toxic and sum(toxic):
            model.doc = (2.0, 0.0, 0.0)
        return model
    drawn = sorted(set(zip(raws, toxic)), key=lambda x: (hashlib.blake2b(x[0], digest_size=8).digest(), x))
    number: dict[bytes, int] = {}
    texts = [np.array([number.setdefault(w, len(number)) for w in words_of(raw)], np.int64) for raw, _ in drawn]
    labels, names = [y for _, y in drawn], list(number)
    by_label = [_context_counts([t for t, y in zip(texts, labels) if y == side], len(names)) for side in (0, 1)]
    marks = _marks(names, by_label[1], by_label[0])
    own_marks = {k: found for k in np.flatnonzero(by_label[1]).tolist()
                 if (found := [f for f in features(names[k]) if f in marks])}
    marked = np.zeros(len(names), bool)
    marked[list(own_marks)] = True
    tags = [marked[t] & bool(y) for t, y in zip(texts, labels)]
    places = _places(texts, tags, own_marks, max_windows // 2)
    places += [(i, len(t) // 2) for i, (t, tag) in enumerate(zip(texts, tags)) if len(t) and not tag.any()][:max_windows // 2]
    windows = []
    for i, k in places:
        lo = max(0, k - WINDOW)
        windows.append(([names[j] for j in texts[i][lo:k + WINDOW + 1].tolist()], tags[i][lo:k + WINDOW + 1].astype(int)))
    if not windows:
        return model
    own = {w: features(w) for ws, _ in windows for w in ws}
    telling = sorted(marks | {f for ws, tags in windows for w, tag in zip(ws, tags) if tag for f in own[w]})
    model.weights, model.rest, model.step = _trained(windows, telling, own)
    points = np.array([_summary(model.marginals([names[i] for i in t.tolist()])) for t in texts])
    model.doc = _logistic(points, np.array(labels, float))
    return model


def _trained(windows, names, own) -> tuple[dict[bytes, float], float, np.ndarray]:
    """Gradient ascent (Adam) on the penalised conditional log-likelihood."""
    number = {f: k + 1 for k, f in enumerate(names)}
    n, length, most = len(windows), max(len(w) for w, _ in windows), 6
    x = np.zeros((n, length, most), np.int64)      # feature numbers, 0: none
    y, real = np.zeros((n, length), np.int64), np.zeros((n, length), bool)
    for i, (ws, tags) in enumerate(windows):
        real[i, :len(ws)], y[i, :len(ws)] = True, tags
        for k, w in enumerate(ws):
            ids = [number[f] for f in own[w] if f in number][:most]
            x[i, k, :len(ids)] = ids
    weight, rest, step = np.zeros(len(names) + 1), -2.0, np.zeros((2, 2))
    theta = np.concatenate([weight[1:], [rest], step.ravel()])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    lens = real.sum(axis=1)
    pairs = real[:, 1:]
    for it in range(1, STEPS + 1):
        weight[1:], rest, step = theta[:-5], theta[-5], theta[-4:].reshape(2, 2)
        u = np.zeros((n, length, 2))
        u[:, :, 1] = weight[x].sum(axis=2) + rest
        u[~real] = 0
        alpha, beta = np.zeros((n, length, 2)), np.zeros((n, length, 2))
        alpha[:, 0] = u[:, 0]
        for k in range(1, length):
            a = np.logaddexp(alpha[:, k - 1, 0, None] + step[0], alpha[:, k - 1, 1, None] + step[1]) + u[:, k]
            alpha[:, k] = np.where(real[:, k, None], a, alpha[:, k - 1])
        total = np.logaddexp(*alpha[np.arange(n), lens - 1].T)
        for k in range(length - 2, -1, -1):
            c = u[:, k + 1] + beta[:, k + 1]
            b = np.logaddexp(step[:, 0] + c[:, 0, None], step[:, 1] + c[:, 1, None])
            beta[:, k] = np.where(real[:, k + 1, None], b, 0)
        p = np.exp(alpha[:, :, 1] + beta[:, :, 1] - total[:, None]) * real
        diff = (y - p) * real
        g_step = np.zeros((2, 2))
        for s in (0, 1):
            for t in (0, 1):
                both = np.exp(alpha[:, :-1, s] + step[s, t] + u[:, 1:, t] + beta[:, 1:, t] - total[:, None]) * pairs
                g_step[s, t] = (((y[:, :-1] == s) & (y[:, 1:] == t) & pairs) - both).sum()
        g_weight = np.bincount(x.ravel(), weights=np.repeat(diff.ravel(), most), minlength=len(weight))[1:]
        grad = np.concatenate([g_weight, [diff.sum()], g_step.ravel()]) - 0.05 * theta
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        theta = theta + 0.15 * (m / (1 - 0.9 ** it)) / (np.sqrt(v / (1 - 0.999 ** it)) + 1e-8)
    return (dict(zip(names, theta[:-5].tolist())), float(theta[-5]), theta[-4:].reshape(2, 2).copy())


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression by Newton steps with a small ridge; both labels weigh the same."""
    a = np.column_stack([np.ones(len(x)), x])
    w = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    theta = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ theta, -30, 30)))
        grad = a.T @ (w * (y - p)) - 0.1 * theta
        theta += np.linalg.solve((a * (w * p * (1 - p))[:, None]).T @ a + 0.1 * np.eye(3), grad)
    return tuple(theta.tolist())


def _scored(model: Field):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            score, spans = [], []
            for raw in b.column("raw"):
                raw = raw.as_py()
                found = model.marginals(words_of(raw))
                score.append(model.document_score(found))
                hits = {k: p for k, p in found if p >= SPAN_MARGINAL}
                spans.append(_spans(raw, hits) if hits else [])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("row_id"), pa.array(score, pa.float64()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()),
                                                     ("marginal", pa.float64())])))],
                names=["doc_id", "row_id", "score", "spans"])
    return run


def _spans(raw: bytes, hits: dict[int, float]) -> list[dict]:
    """Character offsets of the marked words; neighbouring marked words make one span."""
    out, low, done, chars, before = [], raw.lower(), 0, 0, -2
    for k, m in enumerate(_WORD.finditer(low)):
        if k in hits:
            chars += len(raw[done:m.start()].decode("utf-8", "replace"))
            start = chars
            chars += len(m.group().decode("utf-8", "replace"))
            done = m.end()
            if before == k - 1:
                out[-1]["stop"], out[-1]["marginal"] = chars, max(out[-1]["marginal"], hits[k])
            else:
                out.append({"start": start, "stop": chars, "marginal": hits[k]})
            before = k
    return out


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, sample_chars: int = SAMPLE_CHARS,
          max_windows: int = MAX_WINDOWS) -> Field:
    """Fits on documents that have a label ``toxic`` 0 or 1. Texts beyond ``sample_chars`` characters are not
    drawn, but for the shortest of a label that has no shorter one; copies of a text with one label count once. A hash of the text decides, so the sample does not depend on
    partitioning. ``max_windows`` bounds the
    training windows (see ``fit``)."""
    y = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter("toxic in (0, 1)").distinct()
    u = F.pmod(F.col("h"), F.lit(1 << 30)) + 1
    docs = docs.select("doc_id", "text").filter(F.col("text").isNotNull())
    rows = stage(docs.select("doc_id", row_key().alias("row_id"), F.xxhash64("text", F.lit(11)).alias("h"), F.length("text").alias("n"))
                 .join(y, "doc_id").groupBy("toxic", "h").agg(F.min("row_id").alias("row_id"), F.min("n").alias("n"))
                 .select("row_id", "toxic", u.alias("u"), "n"), "toxicity-rows")
    drawn = (drawable(rows, "toxic", sample, sample_chars)
             .orderBy(F.col("u") * F.col("of"), "toxic", "row_id").limit(sample).select("row_id", "toxic"))
    drawn = stage(drawn.distinct(), "toxicity-drawn")   # at most ``sample`` rows: only their texts are gathered
    drawn = (docs.select(row_key().alias("row_id"), text_bytes().alias("raw")).join(F.broadcast(drawn), "row_id")
             .dropDuplicates(["row_id", "toxic"]).collect())
    return fit([r.raw for r in drawn], [r.toxic for r in drawn], max_windows)


def tag(docs: DataFrame, model: Field) -> DataFrame:
    """doc_id, row_id, score, spans for every row of ``docs``, from its whole text alone.

    ``spans`` holds character offsets [start, stop) of runs of words whose marginal of T is at least one half,
    with the largest marginal. A null or empty text, or one without known words, has no spans and the score of
    no evidence. Repeated rows give repeated results; an empty table gives an empty one.
    """
    return docs.select("doc_id", row_key().alias("row_id"), text_bytes().alias("raw")).mapInArrow(
        _scored(model), "doc_id long, row_id long, score double, "
                        "spans array<struct<start:bigint,stop:bigint,marginal:double>>")
