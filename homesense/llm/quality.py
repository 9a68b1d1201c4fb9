"""Quality rules: text statistics, and a hashed n-gram likelihood ratio of trusted against raw text.

Tokens (runs of letters and digits, and every other visible character for itself) and pairs of neighbouring tokens
are hashed into ``BUCKETS`` counts, once over the trusted documents and once over the whole corpus: two multinomials
with add-one smoothing. The trusted side is fitted on at most ``TRUSTED`` labelled documents, whose ids are broadcast;
the raw side counts every document. A document's score is the sum of log(trusted / raw) over its n-grams, divided by their number
plus ``PRIOR`` (so a short text, which says little, stays near 0). Every document with a score below a fixed threshold
is rejected; no draw decides. Texts are counted and scored in whole where they lie; only one count per bucket and task is
shuffled, and one per bucket reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from homesense.llm.batches import mix, mix2
from homesense.llm.common import text_bytes

BUCKETS = 1 << 16
PRIOR = 20
THRESHOLD = -0.5
TRUSTED = 200_000
REPEAT = 5                  # words of a window that is looked for again
CHUNK = 1 << 18             # bytes of text that are hashed at a time

_SYMBOLS = b"#*$%&|<>"
_BLANKS = b" \t\n\x0b\x0c\r"
_NOT_COUNTED = _BLANKS + bytes(range(0x80, 0xC0))    # blanks and bytes that continue a code point
_BLANK, _LETTER, _MARK, _CONTROL = range(4)
_KIND = np.array([_BLANK if c in _BLANKS else _LETTER if c >= 128 or chr(c).isalnum() else _MARK if 32 < c < 127 else _CONTROL
                  for c in range(256)], np.uint8)
_BASE = 0x9E3779B97F4A7C15                           # odd, so it has an inverse modulo 2**64


def _powers(x: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(CHUNK, x, np.uint64)]), dtype=np.uint64)


_UP, _DOWN = _powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))


class Hashed:
    """The 64-bit hashes of the tokens and words of some texts, with the text (a number) of each."""

    def __init__(self, texts: list[tuple[int, bytes]]):
        data = np.frombuffer(b" ".join(t for _, t in texts), np.uint8)
        ends = np.cumsum([len(t) + 1 for _, t in texts])
        number = np.array([k for k, _ in texts])
        kind = _KIND[data]
        before, after = np.concatenate([[0], kind[:-1]]), np.concatenate([kind[1:], [0]])
        sums = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _UP[:len(data)])])

        def runs(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            lo, hi = np.flatnonzero(first), np.flatnonzero(last) + 1
            h = (sums[hi] - sums[lo]) * _DOWN[lo]            # the same bytes have the same hash wherever they stand
            return mix(h), number[np.searchsorted(ends, lo, side="right")]

        letter, mark, word = kind == _LETTER, kind == _MARK, kind != _BLANK
        self.tokens, self.token_text = runs(mark | letter & (before != _LETTER), mark | letter & (after != _LETTER))
        self.words, self.word_text = runs(word & (before == _BLANK), word & (after == _BLANK))

    def ngrams(self, last: tuple[int, np.uint64] | None, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """Bucket and text of every token and of every pair of neighbours; ``last`` is the text and hash of the
        token before the first."""
        h, text = self.tokens, self.token_text
        if last is not None:
            h, text = np.concatenate([[last[1]], h]), np.concatenate([[last[0]], text])
        same = text[:-1] == text[1:]
        pairs = mix2(h[:-1][same], h[1:][same])
        return ((np.concatenate([self.tokens, pairs]) >> np.uint64(20)) % np.uint64(n_buckets)).astype(np.int64), \
            np.concatenate([self.token_text, text[1:][same]])

    def with_repeats(self, width: int) -> set[int]:
        """Texts that may hold a window of ``width`` words twice (all that do, and hardly another)."""
        n = len(self.words) - width + 1
        if n < 2:
            return set()
        h = np.zeros(n, np.uint64)
        for k in range(width):
            h = mix2(h, self.words[k:k + n])
        inside = self.word_text[:n] == self.word_text[width - 1:]
        text = self.word_text[:n][inside]
        h = mix2(h[inside], text.astype(np.uint64))
        order = np.argsort(h)
        again = h[order][1:] == h[order][:-1]
        return set(text[order][1:][again].tolist())


def _pieces(raw: bytes) -> Iterator[bytes]:
    """A text in pieces of at most ``CHUNK`` bytes, cut after a blank where there is one; the cuts depend on the text
    alone."""
    at = 0
    while at < len(raw):
        end = at + CHUNK
        if end < len(raw):
            end = max(raw.rfind(b" ", at, end), raw.rfind(b"\n", at, end)) + 1 or end
        yield raw[at:end]
        at = end


def hashed(texts: Iterator[bytes | None]) -> Iterator[tuple[Hashed, tuple[int, np.uint64] | None]]:
    """``Hashed`` groups of texts of bounded size, each with the last token before it."""
    held, size, last = [], 0, None
    for k, raw in enumerate(texts):
        for piece in _pieces(raw or b""):
            if held and size + len(piece) + 1 > CHUNK:
                group = Hashed(held)
                yield group, last
                last = (int(group.token_text[-1]), group.tokens[-1]) if len(group.tokens) else None
                held, size = [], 0
            held.append((k, piece))
            size += len(piece) + 1
    if held:
        yield Hashed(held), last


def _counts(n_buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((2, n_buckets), np.int64)
        for b in batches:
            trusted = np.array(b.column("trusted").to_pylist(), bool)
            for group, last in hashed(x.as_py() for x in b.column("raw")):
                bucket, text = group.ngrams(last, n_buckets)
                n[0] += np.bincount(bucket, minlength=n_buckets)
                n[1] += np.bincount(bucket[trusted[text]], minlength=n_buckets)
        at = np.flatnonzero(n[0])
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[0][at]), pa.array(n[1][at])],
                                         names=["bucket", "raw_n", "trusted_n"])
    return run


def log_ratios(raw_n: np.ndarray, trusted_n: np.ndarray) -> np.ndarray:
    """log(trusted / raw) of every bucket under add-one smoothing; all 0 without a trusted n-gram."""
    if not trusted_n.sum():
        return np.zeros(len(raw_n))
    return (np.log((trusted_n + 1) / (trusted_n.sum() + len(trusted_n)))
            - np.log((raw_n + 1) / (raw_n.sum() + len(raw_n))))


def repeated_words(words: list[bytes], width: int = REPEAT) -> int:
    """Words inside windows of ``width`` words that occur twice or more in the text."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    a = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    names, size = a, len(number)
    for k in range(1, width):
        names = names[:n + width - 1 - k] * len(number) + a[k:]
        size *= len(number)
        if size * len(number) >= 1 << 62:      # number the windows so far afresh, so that names stay exact
            found, names = np.unique(names, return_inverse=True)
            size = len(found)
    _, where, count = np.unique(names, return_inverse=True, return_counts=True)
    again = count[where] > 1
    covered = np.zeros(len(a), bool)
    for k in range(width):
        covered[k:k + n] |= again
    return int(covered.sum())


def repeated_lines(raw: bytes) -> int:
    seen: set[bytes] = set()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return len(lines) - len(seen.union(lines))


def _scored(ratios: np.ndarray, prior: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            total, n, words, repeats = (np.zeros(b.num_rows, kind) for kind in (np.float64, np.int64, np.int64, np.int64))
            dup_lines, chars, symbols = (np.zeros(b.num_rows, np.int64) for _ in range(3))
            doubtful = set()
            for group, last in hashed(x.as_py() for x in b.column("raw")):
                bucket, text = group.ngrams(last, len(ratios))
                total += np.bincount(text, ratios[bucket], minlength=b.num_rows)
                n += np.bincount(text, minlength=b.num_rows)
                words += np.bincount(group.word_text, minlength=b.num_rows)
                doubtful |= group.with_repeats(REPEAT)
            for k, x in enumerate(b.column("raw")):
                if raw := x.as_py():
                    chars[k] = len(raw.translate(None, _NOT_COUNTED))
                    symbols[k] = len(raw) - len(raw.translate(None, _SYMBOLS))
                    dup_lines[k] = repeated_lines(raw)
                    if len(raw) > CHUNK or k in doubtful:
                        own = raw.split()
                        words[k], repeats[k] = len(own), repeated_words(own)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *[pa.array(c) for c in (words, chars, symbols, dup_lines, repeats, total / (n + prior))]],
                names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "llr"])
    return run


def learn(docs: DataFrame, labels: DataFrame, n_buckets: int = BUCKETS, most: int = TRUSTED) -> np.ndarray:
    """The log ratio of every bucket: trusted are the documents of which every label says quality 1 (beyond ``most``
    ids those with the smallest hashes), raw are all. Labels with a null id or quality say nothing."""
    trusted = (labels.select("doc_id", "quality").filter("doc_id IS NOT NULL AND quality IS NOT NULL")
               .groupBy("doc_id").agg((F.min("quality") == 1).alias("trusted")).filter("trusted")
               .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))
    rows = docs.select("doc_id", text_bytes().alias("raw")).join(F.broadcast(trusted), "doc_id", "left").select(
        "raw", F.coalesce("trusted", F.lit(False)).alias("trusted"))
    n = np.zeros((2, n_buckets), np.int64)
    for r in (rows.mapInArrow(_counts(n_buckets), "bucket long, raw_n long, trusted_n long").groupBy("bucket")
              .agg(F.sum("raw_n").alias("raw_n"), F.sum("trusted_n").alias("trusted_n")).collect()):   # n_buckets rows
        n[:, r.bucket] = r.raw_n, r.trusted_n
    return log_ratios(*n)


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def judge(docs: DataFrame, ratios: np.ndarray, threshold: float = THRESHOLD, prior: float = PRIOR) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, llr, base_failed, kept for every row.

    A null or empty text has no word: it fails the base rules (as does any text below 10 words or with more than a
    fifth of its words in repeated windows) and has ``llr`` 0. Repeated rows give repeated results, ids of any type
    pass through, an empty table gives an empty result.
    """
    out = T.StructType([docs.schema["doc_id"], *[T.StructField(c, T.LongType()) for c in
                        ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
                        T.StructField("llr", T.DoubleType())])
    scored = docs.select("doc_id", text_bytes().alias("raw")).mapInArrow(_scored(ratios, prior), out)
    return (scored.withColumn("base_failed", base_failed())
            .withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= threshold)))
