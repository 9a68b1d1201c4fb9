"""Exact substring deduplication by recompression.

Every document is a string of word names. A round of recompression first replaces each maximal run of one
symbol by a new symbol, then every pair of neighbours whose left symbol falls in the left half of the alphabet
and whose right one in the right half; the halves are drawn by a hash, and a new symbol's name is a hash of
what it stands for. Names are therefore global without a dictionary: equal substrings get equal symbols in
every document and task, except near their ends, where the neighbours outside have a say. Each symbol carries
the span of words that its existence depends on; if that span lies inside a window of ``WINDOW`` words, the
symbol stands at the same place in every occurrence of the window.

So each window chooses its *anchor* by its content alone: of the symbols it determines, one of the highest
level, the smallest by hash of the words it depends on (single words are the lowest level, so there always
is one). Neighbouring windows mostly choose the same symbol. Three rounds over the corpus follow, each a
packed exchange (see ``batches``): anchors that occur in two or more documents reveal the places where long
repeats can be; windows there are verified by two independent hashes of all their words (128 bits together)
against the smallest document that holds them; and the words covered by windows of a smaller document are removed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from homesense.llm.batches import batched, bucket_count, by_bucket, mix, mix2, pack, unpack, unpacked
from homesense.llm.common import stage, text_bytes

WINDOW = 13
BATCH_BYTES = 2_000_000
ROUNDS = 2
LAST = np.iinfo(np.int64).max        # stands for a null id: never smaller than any other
FAR = 1 << 30                        # a dependency beyond the document
_BASE = 0x9E3779B97F4A7C15           # odd, so it has an inverse modulo 2**64
_SECOND = 0xD1342543DE82EF95         # base of the second hash
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
LONG_WORD = 64                       # bytes; longer words are hashed one by one, there are few of them
_SPACE = np.isin(np.arange(256), [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)     # masks of the first k bytes


class Words:
    """The words of a batch: ``lens`` and ``starts`` by document, ``doc`` of each word, names by hash.

    Nothing is done word by word: the texts stand in one buffer, each followed by a space, and a word is the
    stretch from ``first`` to the white space at ``end``.
    """

    def __init__(self, raws: list[bytes | None]):
        self.buffer = b" ".join([*(x or b"" for x in raws), bytes(8)])     # eight bytes may be read at every word
        self.bytes = np.frombuffer(self.buffer, np.uint8)[:-8]
        gap = np.concatenate([[True], _SPACE[self.bytes]])
        edges = np.flatnonzero(gap[1:] != gap[:-1])
        self.first, self.end = edges[::2], edges[1::2]
        sizes = np.fromiter((len(x) + 1 if x else 1 for x in raws), np.int64, len(raws))
        self.starts = np.searchsorted(self.first, np.cumsum(sizes) - sizes)
        self.lens = np.diff(np.append(self.starts, len(self.first)))
        self.doc = np.repeat(np.arange(len(raws)), self.lens)

    def names(self, odd: int, long_word: Callable[[bytes], int]) -> np.ndarray:
        """64-bit names: a mixed hash of eight bytes at a time (``odd`` selects it), ``long_word`` for long ones."""
        size, odd = self.end - self.first, np.uint64(odd)
        at = np.ndarray(max(0, len(self.buffer) - 7), "<u8", self.buffer, strides=(1,))
        out = mix(size.astype(np.uint64) * odd)
        todo = np.flatnonzero(size <= LONG_WORD)
        for k in range(0, LONG_WORD, 8):
            todo = todo[size[todo] > k]
            if not len(todo):
                break
            piece = at[self.first[todo] + k] & _BYTES[np.minimum(size[todo] - k, 8)]
            out[todo] = mix(out[todo] ^ (piece * odd))
        for i in np.flatnonzero(size > LONG_WORD).tolist():
            out[i] = long_word(self.buffer[self.first[i]:self.end[i]])
        return out

    def joined(self, left: np.ndarray) -> pa.Array:
        """The texts of the words chosen by ``left``, joined by one space."""
        left = np.flatnonzero(left)
        first, end, doc = self.first[left], self.end[left], self.doc[left]
        inner = np.zeros(len(left), bool)          # another word of the document follows
        inner[:-1] = doc[1:] == doc[:-1]
        edge = np.zeros(len(self.bytes) + 1, np.int8)
        edge[first] += 1
        edge[end + inner] -= 1
        out = self.bytes.copy()
        out[end] = 0x20
        out = out[np.cumsum(edge[:-1], dtype=np.int8).astype(bool)]
        upto = np.concatenate([[0], np.cumsum(end - first + inner)])
        ends = upto[np.cumsum(np.bincount(doc, minlength=len(self.lens)))]
        return pa.Array.from_buffers(pa.large_string(), len(self.lens), [
            None, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int64)), pa.py_buffer(out)])


class Spans:
    """Hashes of arbitrary spans of words: a polynomial over mixed word names modulo 2**64, then mixed."""

    def __init__(self, names: np.ndarray, base: int = _BASE):
        n = len(names)
        power = np.full(n + 1, base, np.uint64)
        inverse = np.full(n + 1, pow(base, -1, 1 << 64), np.uint64)
        power[0] = inverse[0] = 1
        power, self.inverse = np.cumprod(power, dtype=np.uint64), np.cumprod(inverse, dtype=np.uint64)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(names) * power[:n], dtype=np.uint64)])

    def __call__(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        return mix((self.sums[last + 1] - self.sums[first]) * self.inverse[first] + (last - first).astype(np.uint64))


def recompress(name: np.ndarray, doc: np.ndarray, low: np.ndarray, high: np.ndarray, round_: int
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One round over symbols in order: their names, documents and the spans [low, high] they depend on."""
    n = len(name)
    if not n:
        return name, doc, low, high
    # runs: a symbol is known to end its run only by its neighbours
    new = np.ones(n, bool)
    new[1:] = (name[1:] != name[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], n) - 1
    size = last - first + 1
    inside_left = np.zeros(len(first), bool)
    inside_left[1:] = doc[first[1:]] == doc[last[:-1]]
    inside_right = np.append(inside_left[1:], False)
    lo = np.where(inside_left, low[np.maximum(first - 1, 0)], -FAR)
    hi = np.where(inside_right, high[np.minimum(last + 1, n - 1)], FAR)
    lo, hi = np.minimum(lo, low[first]), np.maximum(hi, high[last])
    run = size > 1
    name = np.where(run, mix2(name[first], size.astype(np.uint64)), name[first])
    doc = doc[first]
    # pairs: left symbols look right, right symbols look left
    right = (mix(name + np.uint64(round_ * 2 + 1)) >> np.uint64(63)).astype(bool)
    same = np.zeros(len(name), bool)
    same[:-1] = doc[1:] == doc[:-1]
    pair = same.copy()
    pair[:-1] &= ~right[:-1] & right[1:]
    second = np.zeros(len(name), bool)
    second[1:] = pair[:-1]
    nxt, prv = np.minimum(np.arange(len(name)) + 1, len(name) - 1), np.maximum(np.arange(len(name)) - 1, 0)
    has_left = np.zeros(len(name), bool)
    has_left[1:] = same[:-1]
    alone = ~pair & ~second
    out_lo, out_hi = lo.copy(), hi.copy()
    out_lo[pair], out_hi[pair] = np.minimum(lo, lo[nxt])[pair], np.maximum(hi, hi[nxt])[pair]
    look = alone & ~right
    out_hi[look] = np.where(same, np.maximum(hi, hi[nxt]), FAR)[look]
    look = alone & right
    out_lo[look] = np.where(has_left, np.minimum(lo, lo[prv]), -FAR)[look]
    name = np.where(pair, mix2(name, name[nxt]), name)
    keep = ~second
    return name[keep], doc[keep], out_lo[keep], out_hi[keep]


def anchors(names: np.ndarray, doc: np.ndarray, spans: Spans, starts: np.ndarray, width: int = WINDOW,
            rounds: int = ROUNDS) -> np.ndarray:
    """The anchor of the window at each word (``starts`` tells where one fits); ``_NONE`` elsewhere."""
    n = len(names)
    at = np.arange(n, dtype=np.int32)       # positions fit: a batch is far below FAR words
    levels = [(at, at)]
    name, d, lo, hi = names, doc.astype(np.int32), at, at
    for r in range(rounds):
        name, d, lo, hi = recompress(name, d, lo, hi, r)
        fits = (lo >= 0) & (hi < FAR) & (hi - lo < width)
        levels.append((lo[fits], hi[fits]))
    best, open_ = np.full(n, _NONE), starts.copy()
    for level in range(rounds, -1, -1):
        if not open_.any():
            break
        lo, hi = levels[level]
        left = np.maximum(hi - width + 1, 0)
        upto = np.concatenate([[0], np.cumsum(open_)])
        use = upto[lo + 1] > upto[left]
        lo, hi, left = lo[use], hi[use], left[use]
        key = mix(spans(lo, hi) + np.uint64(level))
        key = np.where(key == _NONE, np.uint64(0), key)
        found = np.full(n, _NONE)
        for off in range(width):
            ok = lo - off >= left
            if not ok.any():
                break
            np.minimum.at(found, lo[ok] - off, key[ok])
        got = open_ & (found != _NONE)
        best[got] = found[got]
        open_ &= ~got
    return best


class _Batch:
    """Windows and anchors of a batch, and the keys it sends in each exchange."""

    def __init__(self, payload: bytes, width: int):
        self.table, self.width = unpack(payload), width
        self.words = t = Words(self.table.column("__raw").to_pylist())
        ids = self.table.column("__id").to_pylist()
        self.id = np.array([LAST if x is None else x for x in ids], np.int64)
        if len(t.doc) >= FAR:
            raise ValueError("a single text has too many words")
        names = t.names(_BASE, xxhash.xxh64_intdigest)
        at = np.arange(len(names))
        self.starts = at + width <= (t.starts + t.lens)[t.doc]
        self.spans = Spans(names)
        self.anchor = anchors(names, t.doc, self.spans, self.starts, width)
        # an anchor per stretch of windows, then per batch
        begin = self.starts.copy()
        begin[1:] &= (self.anchor[1:] != self.anchor[:-1]) | (t.doc[1:] != t.doc[:-1])
        self.stretch = np.cumsum(begin) - 1
        self.anchor_keys, self.anchor_of, self.anchor_many = _by_key(self.anchor[begin], t.doc[begin])

    def windows(self, shared: np.ndarray) -> None:
        """Distinct windows whose anchor is shared, with the smallest document id among the batch's own."""
        at = np.flatnonzero(self.starts)
        self.at = at = at[shared[self.anchor_of][self.stretch[at]]]
        again = Spans(self.words.names(_SECOND, xxhash.xxh3_64_intdigest), _SECOND)
        self.keys, self.more, self.of = _distinct(self.spans(at, at + self.width - 1), again(at, at + self.width - 1))
        self.least = np.full(len(self.keys), LAST)
        np.minimum.at(self.least, self.of, self.id[self.words.doc[at]])

    def removed(self, smaller: np.ndarray) -> np.ndarray:
        """Words covered by a window that also starts in a smaller document."""
        t = self.words
        gone = smaller[self.of] | (self.least[self.of] < self.id[t.doc[self.at]])
        edge = np.zeros(len(t.doc) + 1, np.int64)
        np.add.at(edge, self.at[gone], 1)
        np.add.at(edge, self.at[gone] + self.width, -1)
        return np.cumsum(edge[:-1]) > 0


def _distinct(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs, and the number of each row's pair."""
    order = np.argsort(a)
    if np.any((a[order[1:]] == a[order[:-1]]) & (b[order[1:]] != b[order[:-1]])):     # hardly ever
        order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    of = np.empty(len(a), np.int64)
    of[order] = np.cumsum(new) - 1
    return a[new], b[new], of


def _by_key(key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys, the number of each row's key, and which keys occur in several documents."""
    distinct, of = np.unique(key, return_inverse=True)
    least, most = np.full(len(distinct), LAST), np.full(len(distinct), -1)
    np.minimum.at(least, of, doc)
    np.maximum.at(most, of, doc)
    return distinct, of, least != most


def _rows(bid: int, keys: np.ndarray, more: np.ndarray, values: np.ndarray, n_buckets: int) -> pa.RecordBatch:
    """Rows of a batch; ``more`` (if not empty) holds the keys' second halves."""
    order, parts = by_bucket(keys, n_buckets)
    return pa.RecordBatch.from_arrays(
        [pa.array([b for b, _, _ in parts], pa.int64()), pa.array([bid] * len(parts), pa.int64()),
         pa.array([keys[order[lo:hi]].astype("<u8").tobytes() for _, lo, hi in parts], pa.binary()),
         pa.array([more[order[lo:hi]].astype("<u8").tobytes() if len(more) else b"" for _, lo, hi in parts], pa.binary()),
         pa.array([pack(values[order[lo:hi]]) for _, lo, hi in parts], pa.binary())],
        names=["bucket", "bid", "keys", "more", "vals"])


_SENT = "bucket long, bid long, keys binary, more binary, vals binary"
_ANSWER = "bid long, bucket long, bits binary"


def _answers(group: pa.Table, bits: list[np.ndarray]) -> pa.Table:
    return pa.table({"bid": group.column("bid"), "bucket": group.column("bucket"),
                     "bits": pa.array([np.packbits(b).tobytes() for b in bits], pa.binary())})


def _answered(keys: np.ndarray, answers: pa.Table, n_buckets: int) -> np.ndarray:
    by = dict(zip(answers.column("bucket").to_pylist(), answers.column("bits").to_pylist()))
    order, parts = by_bucket(keys, n_buckets)
    out = np.zeros(len(keys), bool)
    for b, lo, hi in parts:
        out[order[lo:hi]] = np.unpackbits(np.frombuffer(by[b], np.uint8), count=hi - lo).astype(bool)
    return out


def _in_bucket(group: pa.Table, dtype: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[slice]]:
    keys = [np.frombuffer(x, "<u8") for x in group.column("keys").to_pylist()]
    vals = [unpacked(x, len(k), dtype) for x, k in zip(group.column("vals").to_pylist(), keys)]
    ends = np.cumsum([len(k) for k in keys]).tolist()
    more = np.concatenate([np.frombuffer(x, "<u8") for x in group.column("more").to_pylist()])
    return np.concatenate(keys), more, np.concatenate(vals), [slice(e - len(k), e) for e, k in zip(ends, keys)]


def _shared(group: pa.Table) -> pa.Table:
    """Which anchors occur in two or more documents."""
    keys, _, many, parts = _in_bucket(group, "|u1")
    distinct, of, n = np.unique(keys, return_inverse=True, return_counts=True)
    yes = (n > 1) | (np.bincount(of, weights=many, minlength=len(distinct)) > 0)
    return _answers(group, [yes[of[p]] for p in parts])


def _smaller(group: pa.Table) -> pa.Table:
    """Which windows another batch holds in a smaller document."""
    keys, more, least, parts = _in_bucket(group, "<i8")
    distinct, _, of = _distinct(keys, more)
    low = np.full(len(distinct), LAST)
    np.minimum.at(low, of, least)
    return _answers(group, [low[of[p]] < least[p] for p in parts])


def _send_anchors(n_buckets: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for bid, payload in zip(b.column("bid").to_pylist(), b.column("payload")):
                x = _Batch(payload.as_py(), width)
                yield _rows(bid, x.anchor_keys, x.anchor_keys[:0], x.anchor_many.astype("|u1"), n_buckets)
    return run


def _send_windows(n_buckets: int, width: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for bid, payload in zip(left.column("bid").to_pylist(), left.column("payload").to_pylist()):
            x = _Batch(payload, width)
            x.windows(_answered(x.anchor_keys, right, n_buckets))
            out.append(_rows(bid, x.keys, x.more, x.least.astype("<i8"), n_buckets))
        return pa.Table.from_batches(out)
    return run


def _cut(n_buckets: int, width: int, schema: pa.Schema):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        kind = right.column("kind").to_numpy()
        first, second = right.filter(pa.array(kind == 1)), right.filter(pa.array(kind == 2))
        for payload in left.column("payload").to_pylist():
            x = _Batch(payload, width)
            x.windows(_answered(x.anchor_keys, first, n_buckets))
            t = x.words
            gone = x.removed(_answered(x.keys, second, n_buckets))
            n_gone = np.bincount(t.doc[gone], minlength=len(t.lens)).astype(np.int64)
            found = {"__n_words": pa.array(t.lens), "__n_removed": pa.array(n_gone), "__kept": t.joined(~gone)}
            text = x.table.column("__raw").cast(pa.string())
            out.append(pa.table([found[f.name] if f.name in found else text if f.name == "text" else x.table.column(f.name)
                                 for f in schema], names=schema.names))
        return pa.concat_tables(out).cast(schema) if out else schema.empty_table()
    return run


def cut_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with ``__n_words``, ``__n_removed`` and ``__kept`` (kept words joined by one space) for every row.

    Words are runs of bytes other than 0x20 and 0x09-0x0D, unchanged. A word is removed if it lies in a window
    of ``window`` words of its document whose word sequence also starts in a document with a smaller doc_id,
    judged on the input. Repeats within one document, or between rows of equal doc_id, remove nothing; a null
    doc_id is larger than any other and never causes a removal in another null row. A null or empty text has no
    words. A text of fewer than ``window`` words keeps all of them. All columns of ``docs`` are carried along,
    whatever their names. An empty table gives an empty result. Windows are equal if two
    64-bit hashes of their words, over two independent hashes of each word, agree.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    fields = [T.StructField(f.name, f.dataType, True) for f in docs.schema.fields]
    schema = T.StructType([*fields, T.StructField("__n_words", T.LongType()), T.StructField("__n_removed", T.LongType()),
                           T.StructField("__kept", T.StringType())])
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]     # the text travels once, as bytes
    rows = docs.select(*others, F.col("doc_id").cast("long").alias("__id"), text_bytes().alias("__raw"))
    staged = batched(rows, "__raw", "substring-batches", BATCH_BYTES)
    n_buckets = bucket_count(staged)
    payloads = staged.select("bid", "payload")
    shared = stage(payloads.mapInArrow(_send_anchors(n_buckets, window), _SENT).groupBy("bucket")
                   .applyInArrow(_shared, _ANSWER), "substring-shared")
    sent = payloads.groupBy("bid").cogroup(shared.groupBy("bid")).applyInArrow(_send_windows(n_buckets, window), _SENT)
    smaller = stage(sent.groupBy("bucket").applyInArrow(_smaller, _ANSWER), "substring-smaller")
    both = shared.withColumn("kind", F.lit(1)).union(smaller.withColumn("kind", F.lit(2)))
    return payloads.groupBy("bid").cogroup(both.groupBy("bid")).applyInArrow(
        _cut(n_buckets, window, to_arrow_schema(schema)), schema)
