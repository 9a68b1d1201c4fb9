"""Language-model scores by deleted interpolation.

The model mixes maximum-likelihood estimates of a word given the ``order - 1`` words before it, given one word less,
and so on, of the word alone, and the uniform one; for order 2 ``P(w|h) = l2 c(hw)/c(h) + l1 c(w)/N + l0 /(V+1)``.
The weights depend on the longest context that occurs and on its frequency (powers of two), and are learned by
expectation-maximisation on held-out counts: the distinct texts of one fold of the training set are scored with the
counts of all their copies in the training set deleted from the corpus counts.

Counts of all n-grams are exact and gathered over the whole training set through a packed exchange (see ``batches``);
the mixture is fitted on a table of cells (context, levels of the estimates) that does not grow with the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from homesense.llm.batches import Tokens, batched, bucket_count, by_bucket, mix, mix2, pack, unpack, unpacked
from homesense.llm.common import row_key, stage, text_bytes

ORDER = 2
LEVELS = 4          # levels of an estimate per factor of two, at order 2
BUCKETS = 48
EM_ROUNDS = 60
START = 1           # number of the start symbol in ``Tokens``
_SALT = np.uint64(0x5BD1E995)
_START_KEY = mix(np.array([2], np.uint64) ^ _SALT)[0]
_BITS = 9           # of a level in a cell


def levels_of(order: int) -> int:
    return max(1, 2 * LEVELS // order)


class _Batch:
    """Distinct n-grams of a batch up to ``order`` words, with the training counts among its own documents.

    Every document begins with a start symbol, which precedes itself; ``real`` are the places of the other tokens.
    ``of[k]`` numbers the (k+1)-gram that ends at each place; ``keys`` and ``counts`` hold the grams of all sizes, cut at ``ends``.
    """

    def __init__(self, payload: bytes, order: int):
        self.table = unpack(payload)
        self.tokens = t = Tokens(self.table.column("raw").to_pylist(), lower=True, ends=True)
        docs, v = len(t.lens), len(t.names)
        self.real = np.arange(len(t.ids)) + t.doc + 1
        ids = np.full(len(t.ids) + docs, START, np.int64)
        ids[self.real] = t.ids
        before = np.arange(len(ids)) - 1
        first = t.starts + np.arange(docs)
        before[first] = first
        learn = np.repeat(np.array(self.table.column("train").to_pylist(), bool), t.lens + 1)
        names, self.of = t.names, [ids]
        keys, counts = [mix(names ^ _SALT)], [np.bincount(ids[learn], minlength=v)]
        for _ in range(order - 1):
            gram, of = np.unique(self.of[-1][before] * v + ids, return_inverse=True)
            a, b = np.divmod(gram, v)
            names = mix2(names[a], t.names[b])
            self.of.append(of)
            keys.append(names)
            counts.append(np.bincount(of[learn], minlength=len(gram)))
        self.ends = np.cumsum([len(x) for x in keys])
        self.keys, self.counts = np.concatenate(keys), np.concatenate(counts)


def _sent(n_buckets: int, order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for bid, payload in zip(b.column("bid").to_pylist(), b.column("payload")):
                x = _Batch(payload.as_py(), order)
                at, parts = by_bucket(x.keys, n_buckets)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p for p, _, _ in parts], pa.int64()), pa.array([bid] * len(parts), pa.int64()),
                     pa.array([x.keys[at[lo:hi]].astype("<u8").tobytes() for _, lo, hi in parts], pa.binary()),
                     pa.array([pack(x.counts[at[lo:hi]].astype("<u4")) for _, lo, hi in parts], pa.binary()),
                     pa.array([int((at[lo:hi] < x.ends[0]).sum()) for _, lo, hi in parts], pa.int64())],
                    names=["bucket", "bid", "keys", "counts", "words"])
    return run


def _summed(group: pa.Table) -> pa.Table:
    """Adds up the counts of a bucket's keys and answers every batch; totals of words ride on the first answer."""
    keys = [np.frombuffer(x, "<u8") for x in group.column("keys").to_pylist()]
    counts = [unpacked(x, len(y), "<u4") for x, y in zip(group.column("counts").to_pylist(), keys)]
    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(at, weights=np.concatenate(counts), minlength=len(distinct)).astype(np.int64)
    ends = np.cumsum([len(x) for x in keys]).tolist()
    word = np.zeros(len(distinct), bool)
    for x, hi, n in zip(keys, ends, group.column("words").to_pylist()):     # the words of a part come first
        word[at[hi - len(x):hi - len(x) + n]] = True
    word &= (total > 0) & (distinct != _START_KEY)
    width = 4 if total.max() < 2 ** 32 else 8
    n = group.num_rows
    return pa.table({"bid": group.column("bid"), "bucket": group.column("bucket"),
                     "counts": pa.array([pack(total[at[hi - len(x):hi]].astype(f"<u{width}")) for x, hi in zip(keys, ends)],
                                        pa.binary()),
                     "width": pa.array([width] * n, pa.int32()),
                     "words": pa.array([int(word.sum())] + [0] * (n - 1), pa.int64()),
                     "tokens": pa.array([int(total[word].sum())] + [0] * (n - 1), pa.int64())})


def _looked_up(x: _Batch, answers: pa.Table, n_buckets: int) -> list[np.ndarray]:
    """Corpus counts of the batch's grams of each size."""
    by = {b: k for k, b in enumerate(answers.column("bucket").to_pylist())}
    raws, width = answers.column("counts").to_pylist(), answers.column("width").to_pylist()
    at, parts = by_bucket(x.keys, n_buckets)
    total = np.zeros(len(at), np.int64)
    for b, lo, hi in parts:
        total[at[lo:hi]] = unpacked(raws[by[b]], hi - lo, f"<u{width[by[b]]}")
    return np.split(total, x.ends[:-1])


def context_bucket(c: np.ndarray) -> np.ndarray:
    return np.where(c > 0, np.minimum(BUCKETS - 1, 1 + np.log2(np.maximum(c, 1)).astype(np.int64)), 0)


def _mix_bucket(contexts: list[np.ndarray], n: int) -> np.ndarray:
    """Bucket of the longest context that occurs; ``contexts`` are counts from one word up, 0 stands for none."""
    out = np.zeros(n, np.int64)
    for k, c in enumerate(contexts):
        out = np.where(c > 0, k * BUCKETS + context_bucket(c), out)
    return out


def _level(p: np.ndarray, levels: int) -> np.ndarray:
    """0 for zero, else 1 + the level of the probability below one."""
    x = 1 + np.rint(-levels * np.log2(np.maximum(p, 1e-300))).astype(np.int64)
    return np.where(p > 0, np.minimum(x, (1 << _BITS) - 1), 0)


def _ratio(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return np.where(whole > 0, part / np.maximum(whole, 1), 0.0)


def _cells(n_buckets: int, n: int, order: int):
    levels = levels_of(order)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        chosen = pa.compute.is_valid(right.column("fold"))
        for payload in left.column("payload").to_pylist():
            x = _Batch(payload, order)
            t = x.tokens
            total = _looked_up(x, right.filter(pa.compute.invert(chosen)), n_buckets)
            for rep in (r for rows in right.filter(chosen).column("fold").to_pylist() for r in rows):
                lo, size, copies = int(t.starts[rep["pos"]]), int(t.lens[rep["pos"]]), rep["copies"]
                at = x.real[lo:lo + size]

                def less(k: int, places: np.ndarray) -> np.ndarray:     # without the counts of the text's copies
                    of = x.of[k][places]
                    _, inv, cnt = np.unique(of, return_inverse=True, return_counts=True)
                    return np.maximum(total[k][of] - copies * cnt[inv], 0)
                contexts = [less(k, at - 1) for k in range(order - 1)]
                cell = _mix_bucket(contexts, size)
                for k in range(order - 1, 0, -1):
                    p = _ratio(np.minimum(less(k, at), contexts[k - 1]), contexts[k - 1])
                    cell = cell << _BITS | _level(p, levels)
                found.append(cell << _BITS | _level(less(0, at) / max(n - copies * size, 1), levels))
        cell, count = np.unique(np.concatenate(found) if found else np.zeros(0, np.int64), return_counts=True)
        return pa.table({"cell": pa.array(cell, pa.int64()), "n": pa.array(count, pa.int64())})
    return run


def _opened(cells: np.ndarray, order: int) -> np.ndarray:
    """Rows (bucket, levels from the longest estimate to the word alone, n) of rows (cell, n)."""
    cell = cells[:, 0]
    return np.stack([cell >> (_BITS * order), *[cell >> (_BITS * k) & ((1 << _BITS) - 1) for k in range(order - 1, -1, -1)],
                     cells[:, 1]], axis=1)


def mixture(cells: np.ndarray, uniform: float, levels: int = LEVELS) -> np.ndarray:
    """Weights (longest estimate to the word alone, uniform) per bucket by expectation-maximisation over rows (bucket,
    levels, n). A bucket gives no weight to estimates whose contexts don't occur in it."""
    order = cells.shape[1] - 2
    size = max(1, order - 1) * BUCKETS
    p = np.concatenate([np.where(cells[:, 1:-1] > 0, 2.0 ** (-(cells[:, 1:-1] - 1) / levels), 0),
                        np.full((len(cells), 1), uniform)], axis=1)

    def fit(rows: np.ndarray, lam: np.ndarray, open_: np.ndarray) -> np.ndarray:
        for _ in range(EM_ROUNDS if len(rows) else 0):
            part = p[rows] * lam
            part = part / np.maximum(part.sum(axis=1, keepdims=True), 1e-300)
            lam = (part * cells[rows, -1:]).sum(axis=0) + 1e-3 * open_
            lam /= lam.sum()
        return lam

    prior = np.append(np.full(order, 0.9 / order), 0.1)
    pooled = fit(np.arange(len(cells)), prior, np.ones(order + 1))
    out = np.empty((size, order + 1))
    for b in range(size):
        longest = b // BUCKETS + 1 if b else 0
        open_ = np.array([*(k <= longest for k in range(order - 1, -1, -1)), True])
        lam = np.where(open_, pooled, 0)
        lam[order - 1] += pooled[~open_].sum()
        out[b] = fit(np.flatnonzero(cells[:, 0] == b), lam, open_)
    return out


def _scores(n_buckets: int, n: int, v: int, weights: np.ndarray, order: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for payload in left.column("payload").to_pylist():
            x = _Batch(payload, order)
            t = x.tokens
            total = _looked_up(x, right, n_buckets)
            contexts = [total[k][x.of[k][x.real - 1]] for k in range(order - 1)]
            lam = weights[_mix_bucket(contexts, len(x.real))]
            uni = total[0][t.ids]
            prob = lam[:, order - 1] * uni / max(n, 1) + lam[:, order] / (v + 1)
            for k in range(1, order):
                prob += lam[:, order - 1 - k] * _ratio(total[k][x.of[k][x.real]], contexts[k - 1])
            docs = len(t.lens)

            def per_doc(z: np.ndarray) -> np.ndarray:
                return np.bincount(t.doc, weights=z, minlength=docs)
            out.append(pa.table({
                "doc_id": x.table.column("doc_id"), "row_id": x.table.column("row_id"), "train": x.table.column("train"),
                "n_tokens": pa.array(t.lens), "n_known": pa.array(per_doc(uni > 0).astype(np.int64)),
                "train_tokens": pa.array(np.full(docs, n, np.int64)),
                "base_score": pa.array(per_doc(np.log10((uni + 1) / (n + v + 1)))), "score": pa.array(per_doc(np.log10(prob)))}))
        return pa.concat_tables(out) if out else _NO_SCORES
    return run


_NO_SCORES = pa.table({"doc_id": pa.array([], pa.int64()), "row_id": pa.array([], pa.int64()), "train": pa.array([], pa.bool_()),
                       "n_tokens": pa.array([], pa.int64()), "n_known": pa.array([], pa.int64()),
                       "train_tokens": pa.array([], pa.int64()), "base_score": pa.array([], pa.float64()),
                       "score": pa.array([], pa.float64())})


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for bid, payload in zip(b.column("bid").to_pylist(), b.column("payload")):
            ids = unpack(payload.as_py()).column("text_id").combine_chunks()
            yield pa.RecordBatch.from_arrays([ids, pa.array([bid] * len(ids), pa.int64()),
                                              pa.array(range(len(ids)), pa.int32())], names=["text_id", "bid", "pos"])


def _representatives(rows: DataFrame, fold: DataFrame) -> DataFrame:
    """bid, fold: per batch of the fold, one place of each distinct text with the number of its copies in training rows."""
    at = fold.select("bid", "payload").mapInArrow(_places, "text_id long, bid long, pos int")
    learned = rows.filter("train").select("text_id", F.lit(1).alias("one"), F.lit(None).cast("struct<bid:bigint,pos:int>").alias("at"))
    return (learned.unionByName(at.select("text_id", F.lit(0).alias("one"), F.struct("bid", "pos").alias("at")))
            .groupBy("text_id").agg(F.sum("one").alias("copies"), F.min("at").alias("at")).filter("at is not null")
            .groupBy(F.col("at.bid").alias("bid")).agg(F.collect_list(F.struct(F.col("at.pos"), "copies")).alias("fold")))


def lm_scores(docs: DataFrame, train: Column, held_out_fold: Column, order: int = ORDER) -> DataFrame:
    """doc_id, row_id, train, n_tokens, n_known, train_tokens, base_score, score for every row of ``docs``.

    ``train`` marks the rows to learn from, ``held_out_fold`` those of them whose deleted counts fit the
    mixture; a text that the fold holds repeatedly is used once, and the counts of all its copies (equal texts) in
    training rows are deleted. ``order`` (1 to 5) is the number of words of the longest n-gram. Words are runs of bytes
    other than 0x20 and 0x09-0x0D, A-Z lower-cased; every text ends with one end token, so a null or empty text is that
    token alone. ``base_score`` is the add-one unigram score, ``score`` the mixture's log10 probability of the whole
    text. Without training rows both use the uniform estimate over one unseen word. Repeated rows count as often as they
    occur; an empty table gives an empty result.
    """
    if not 1 <= order <= 5:
        raise ValueError("order lies in 1 to 5")
    rows = docs.select("doc_id", row_key().alias("row_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_id"),
                       text_bytes().alias("raw"), train.alias("train"), (train & held_out_fold).alias("fold"))
    # the fold has batches of its own, so that fitting the mixture moves no other text
    fold = batched(rows.filter("fold"), "raw", "lm-fold")
    rest = batched(rows.filter("fold is null or not fold").drop("text_id"), "raw", "lm-rest").withColumn("bid", -F.col("bid") - 1)
    both = fold.union(rest)
    n_buckets = bucket_count(both)
    sent = both.select("bid", "payload").mapInArrow(
        _sent(n_buckets, order), "bucket long, bid long, keys binary, counts binary, words long")
    answers = stage(sent.groupBy("bucket").applyInArrow(
        _summed, "bid long, bucket long, counts binary, width int, words long, tokens long"), "lm-answers")
    totals = answers.agg(F.sum("tokens").alias("n"), F.sum("words").alias("v")).first()
    n, v = totals.n or 0, totals.v or 0
    asked = answers.select("bid", "bucket", "counts", "width")
    told = asked.filter("bid >= 0").unionByName(_representatives(rows, fold), allowMissingColumns=True)
    cells = (fold.select("bid", "payload").groupBy("bid").cogroup(told.groupBy("bid"))
             .applyInArrow(_cells(n_buckets, n, order), "cell long, n long")
             .groupBy("cell").agg(F.sum("n").alias("n")).toPandas())
    weights = mixture(_opened(cells.to_numpy(np.int64).reshape(-1, 2), order), 1 / (v + 1), levels_of(order))
    return (both.select("bid", "payload").groupBy("bid").cogroup(asked.groupBy("bid"))
            .applyInArrow(_scores(n_buckets, n, v, weights, order),
                          "doc_id long, row_id long, train boolean, n_tokens long, n_known long, train_tokens long, "
                          "base_score double, score double"))
