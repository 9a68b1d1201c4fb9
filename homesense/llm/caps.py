"""Embedding near-duplicates with spherical-cap filters from structured random product codes.

Every unit vector is rotated at random and cut into two halves; each half has its own code book of random
unit vectors, and a filter direction is a pair of code words, one from each book. A vector passes all filters
whose direction it exceeds by the cap height ``alpha``; the product structure lets these be listed without
visiting all pairs of code words. Vectors meet in the lists of the filters they pass, and cosines are verified
in double precision. The cap height and the number of directions follow from the number of vectors, the
dimension and the threshold (``plan``): expected list lengths stay constant while the table grows. Long lists
are compared block against block. A pair is counted only in its lowest shared filter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homesense.llm.common import stage
from homesense.llm.lists import blocked, components, group_ids, groups

MIN_COSINE = 0.9
SHARED = 12.0
LIST_LENGTH = 24
SEED = 20_240


def plan(n: int, dim: int, min_cosine: float = MIN_COSINE, shared: float = SHARED) -> tuple[float, int, int]:
    """Cap height, code words per half and least filters per vector: a pair at the threshold shares ``shared``
    filters in expectation and a list of ``n`` random vectors has about ``LIST_LENGTH`` entries."""
    norm = NormalDist()
    p = min(0.02, LIST_LENGTH / max(1, n))
    z = -norm.inv_cdf(p)
    grid = np.linspace(z, z + 6, 600)
    weight = np.exp(-grid ** 2 / 2)
    rest = math.sqrt(1 - min_cosine ** 2)
    both = np.array([1 - norm.cdf((z - min_cosine * g) / rest) for g in grid])
    meet = float((weight * both).sum() / weight.sum())
    words = math.ceil(math.sqrt(shared / (p * meet)))
    return z / math.sqrt(dim), words, min(words * words, math.ceil(shared / meet))


def code_books(dim: int, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED + dim)
    turn = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    books = []
    for d in (dim - dim // 2, dim // 2):
        c = rng.standard_normal((words, max(1, d)))
        books.append(c / np.linalg.norm(c, axis=1, keepdims=True))
    return turn, books[0], books[1]


def passed(x: np.ndarray, books: tuple, alpha: float, least: int) -> list[np.ndarray]:
    """For each unit row of ``x``: the numbers of all filters it passes, rising.

    A vector in a thin part of the code passes few filters at height ``alpha``; its cap is lowered until
    ``least`` filters are passed (the ``least`` highest), so no region of the sphere is left without recall.
    """
    turn, left, right = books
    y = x @ turn
    half = left.shape[1]
    if y.shape[1] == 1:
        return [np.zeros(1, np.int64) for _ in y]
    s, t = y[:, :half] @ left.T, y[:, half:] @ right.T
    need, out, words = alpha * math.sqrt(2), [], len(right)
    for a, b in zip(s, t):
        order = np.argsort(-b)
        falling = b[order]
        low = need
        while True:
            i = np.flatnonzero(a >= low - falling[0])
            k = np.searchsorted(-falling, a[i] - low, side="right")
            if (total := int(k.sum())) >= least or low < -4:
                break
            low -= 0.06
        i, j = np.repeat(i, k), order[np.arange(total) - np.repeat(np.cumsum(k) - k, k)]
        if low < need and total > least:
            top = np.argpartition(-(a[i] + b[j]), least - 1)[:least]
            i, j = i[top], j[top]
        out.append(np.sort(i * words + j))
    return out


def _unit(raw: bytes, kind: str) -> np.ndarray:
    v = np.frombuffer(raw, dtype=kind).astype(np.float64)
    v = v / np.abs(v).max()
    return v / np.linalg.norm(v)


def _prepared(kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Vectors as bytes; null for vectors that are null, empty, zero or hold null or non-finite parts."""
        for b in batches:
            out = []
            for x in b.column("embedding"):
                x = x.as_py()
                v = np.asarray(x, dtype=kind) if x and None not in x else None
                out.append(v.tobytes() if v is not None and np.isfinite(v).all() and v.any() else None)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(out, pa.binary())], names=["vec_id", "v"])
    return run


class _Decoder:
    """Filters passed by vectors of any dimension of the plan."""

    def __init__(self, plans: dict[int, tuple[float, int, int]]):
        self.plans, self.books = plans, {}

    def __call__(self, vectors: list[np.ndarray]) -> list[np.ndarray]:
        lists: list = [None] * len(vectors)
        for dim in {len(v) for v in vectors}:
            alpha, words, least = self.plans[dim]
            if dim not in self.books:
                self.books[dim] = code_books(dim, words)
            at = [k for k, v in enumerate(vectors) if len(v) == dim]
            for k, f in zip(at, passed(np.stack([vectors[k] for k in at]), self.books[dim], alpha, least)):
                lists[k] = f + dim * 2 ** 40
        return lists


def _filters(plans: dict[int, tuple[float, int, int]], kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = _Decoder(plans)
        for b in batches:
            lists = decode([_unit(x.as_py(), kind) for x in b.column("v")])
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), b.column("v"), pa.array(lists, pa.list_(pa.int64()))], names=["row", "v", "filters"])
    return run


def _verified(min_cosine: float, plans: dict[int, tuple[float, int, int]], kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = _Decoder(plans)
        for b in groups(batches, "filter"):
            gid = group_ids(b, "filter")
            cuts = np.concatenate([np.flatnonzero(np.diff(gid, prepend=-1)), [len(gid)]])
            rows, i, j, own, names = (b.column(c).to_numpy(zero_copy_only=False)
                                      for c in ("row", "i", "j", "own", "filter"))
            flat = b.column("v")
            out: list[tuple] = []
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if hi - lo < 2:
                    continue
                x = np.stack([_unit(flat[k].as_py(), kind) for k in range(lo, hi)])
                linked = np.triu(x @ x.T >= min_cosine, 1)
                if i[lo] != j[lo]:
                    linked &= own[lo:hi, None] != own[None, lo:hi]
                at = np.flatnonzero(linked.any(axis=0) | linked.any(axis=1))
                if not len(at):
                    continue
                earlier = [f[f < names[lo]] for f in decode(list(x[at]))]
                linked = linked[np.ix_(at, at)] & ~_meet(earlier)
                n = linked.sum(axis=0) + linked.sum(axis=1)
                who, keep = rows[lo:hi][at], np.flatnonzero(n)
                out.append((who[keep], who[_forest(linked)[keep]], n[keep]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(z).astype(np.int64)) for z in zip(*out)],
                                                 names=["a", "b", "n"])
    return run


def _meet(lists: list[np.ndarray]) -> np.ndarray:
    """Whether each two of the lists share a number."""
    names, at = np.unique(np.concatenate(lists), return_inverse=True)
    has = np.zeros((len(lists), len(names)), np.float32)
    has[np.repeat(np.arange(len(lists)), [len(x) for x in lists]), at] = 1
    return has @ has.T > 0


def _forest(linked: np.ndarray) -> np.ndarray:
    """The first member of each member's component."""
    near = linked | linked.T
    root, seen = np.arange(len(near)), np.zeros(len(near), bool)
    for k in range(len(near)):
        if not seen[k]:
            reach = np.zeros(len(near), bool)
            reach[k] = True
            edge = reach
            while edge.any():
                edge = near[edge].any(axis=0) & ~reach
                reach |= edge
            root[reach], seen = k, seen | reach
    return root


def near_vectors(vectors: DataFrame, min_cosine: float = MIN_COSINE, shared: float = SHARED) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors`` (columns vec_id, embedding).

    Pairs with cosine of at least ``min_cosine`` are linked; a pair above it is missed only if it shares no
    filter (``shared`` sets the expected number). Null, empty, zero and non-finite vectors and vectors with
    null parts link with nothing, nor do vectors of different lengths. Repeated rows are vectors of their own
    and link as equals. A component is named by its smallest vec_id; null ids name nothing. An empty table
    gives an empty result.
    """
    element = vectors.schema["embedding"].dataType.elementType.typeName()
    kind, part = ("<f4", "float") if element == "float" else ("<f8", "double")
    prepared = stage(vectors.select("vec_id", F.col("embedding").cast(f"array<{part}>").alias("embedding"))
                     .mapInArrow(_prepared(kind), "vec_id long, v binary")
                     .withColumn("row", F.monotonically_increasing_id()), "caps-vectors")
    valid = prepared.filter(F.col("v").isNotNull())
    sizes = valid.groupBy((F.octet_length("v") / int(kind[2])).cast("int").alias("dim")).agg(F.count("*").alias("n"))
    plans = {r.dim: plan(r.n, r.dim, min_cosine, shared) for r in sizes.collect()}
    posted = stage(valid.select("row", "v").mapInArrow(_filters(plans, kind), "row long, v binary, filters array<long>"),
                   "caps-filters")
    entries = posted.select("row", "v", F.explode("filters").alias("filter"))
    found = stage(blocked(entries, "filter", "row").mapInArrow(_verified(min_cosine, plans, kind),
                                                              "a long, b long, n long"), "caps-links")
    links = found.groupBy(F.col("a").alias("row")).agg(F.sum("n").alias("n_links"))
    roots = components(found.select("a", "b")).withColumnRenamed("node", "row")
    named = prepared.select("vec_id", "row").join(roots, "row", "left").withColumn("root", F.coalesce("root", "row"))
    smallest = named.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    return (named.join(smallest, "root").join(links, "row", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), "component_id",
                    F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept")))
