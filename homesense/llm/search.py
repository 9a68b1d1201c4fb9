"""Ranked lexical search by presence-mask grouping.

Documents are kept in blocks: per document its number of terms and the counts of those terms that some item of
the query set holds. For an item, a block's documents are grouped by the mask of the item's terms that they
hold (one bit a term). A mask's score is at most the sum of its terms' highest contributions in the block, so the
masks are evaluated by descending bound and left off once the bound is below the score that a document needs to
enter the item's best. The best of a task's blocks are carried on, so later blocks stop sooner; the tasks' best
are merged by one window over at most ``top`` rows per item and task.

The query set is read in blocks of items bounded by their text; each reads the documents once.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from homesense.llm.common import stage, text_bytes

TOP = 50
ITEM_BYTES = 4_000_000      # text of the items that are searched together
BLOCK_DOCS = 8192
BLOCK_POSTINGS = 1_000_000
STEP = 256                  # documents evaluated between two looks at the bound

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms(raw: bytes | None) -> list[bytes]:
    """Maximal runs of ASCII digits, letters and bytes from 0x80 on, with A-Z lower-cased."""
    return raw.translate(_FOLD).split() if raw else []


def _blocks(number: dict[bytes, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, lens, held, term, tf = [], [], [], [], []

        def block(kind: pa.DataType) -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array([ids], pa.list_(kind)), *[pa.array([np.asarray(x, np.int64).tobytes()], pa.binary())
                                                    for x in (lens, held, term, tf)],
                 pa.array([sum(n > 0 for n in lens)], pa.int64()), pa.array([sum(lens)], pa.int64())],
                names=["ids", "lens", "held", "term", "tf", "n_docs", "n_terms"])
            for x in (ids, lens, held, term, tf):
                x.clear()
            return out

        kind = None
        for b in batches:
            kind = b.column("doc_id").type
            for doc, raw in zip(b.column("doc_id"), b.column("raw")):
                words = terms(raw.as_py())
                known = [(number[w], n) for w, n in Counter(words).items() if w in number]
                ids.append(doc.as_py())
                lens.append(len(words))
                held.append(len(known))
                term.extend(t for t, _ in known)
                tf.extend(n for _, n in known)
                if len(ids) == BLOCK_DOCS or len(term) >= BLOCK_POSTINGS:
                    yield block(kind)
        if ids:
            yield block(kind)
    return run


def _numbers(b: pa.RecordBatch, name: str, row: int) -> np.ndarray:
    return np.frombuffer(b.column(name)[row].as_py(), np.int64)


def _document_counts(n_terms: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(n_terms, np.int64)
        for b in batches:
            for row in range(b.num_rows):
                df += np.bincount(_numbers(b, "term", row), minlength=n_terms)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], names=["term", "df"])
    return run


def _by_rank(entry: tuple) -> tuple:
    score, doc = entry
    return (-score, doc is None, 0 if doc is None else doc)


class Postings:
    """The postings of a block, by term, with the contribution of each to a score."""

    def __init__(self, ids: list, lens: np.ndarray, held: np.ndarray, term: np.ndarray, tf: np.ndarray,
                 weights: np.ndarray, big_n: int, big_l: int):
        m = 50 + (50 * lens * big_n) // max(big_l, 1)
        doc = np.repeat(np.arange(len(lens)), held)
        order = np.argsort(term, kind="stable")
        self.ids, self.doc, term, tf = ids, doc[order], term[order], tf[order]
        self.gain = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[self.doc]))
        self.cuts = np.searchsorted(term, np.arange(len(weights) + 1))
        self.most = np.zeros(len(weights), np.int64)
        np.maximum.at(self.most, term, self.gain)

    def improve(self, best: list[tuple], asked: np.ndarray, top: int) -> list[tuple]:
        """``best`` (ranked (score, id) pairs, at most ``top``) with this block's documents for one item."""
        asked = asked[self.most[asked] > 0]
        if not len(asked):
            return best
        gain = np.zeros((len(asked), len(self.ids)), np.int64)
        for k, t in enumerate(asked.tolist()):
            part = slice(self.cuts[t], self.cuts[t + 1])
            gain[k, self.doc[part]] = self.gain[part]
        bits = gain > 0
        docs = np.flatnonzero(bits.any(axis=0))
        masks = np.packbits(bits[:, docs], axis=0).T
        masks = np.ascontiguousarray(np.pad(masks, ((0, 0), (0, -masks.shape[1] % 8))))
        masks = masks.view(np.uint64)[:, 0] if masks.shape[1] == 8 else masks.view(f"V{masks.shape[1]}")[:, 0]
        _, first, group = np.unique(masks, return_index=True, return_inverse=True)
        bound = self.most[asked] @ bits[:, docs[first]]
        order = np.lexsort((group, -bound[group]))
        docs, bound = docs[order], bound[group[order]]
        at = 0
        while at < len(docs) and (len(best) < top or bound[at] >= best[-1][0]):
            some = docs[at:at + STEP]
            score = gain[:, some].sum(axis=0)
            if len(best) == top:
                enough = score >= best[-1][0]
                some, score = some[enough], score[enough]
            best = sorted([*best, *zip(score.tolist(), [self.ids[i] for i in some.tolist()])], key=_by_rank)[:top]
            at += STEP
        return best


def _ranked(items: list[np.ndarray], weights: np.ndarray, big_n: int, big_l: int, top: int, kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple]] = [[] for _ in items]
        for b in batches:
            for row in range(b.num_rows):
                block = Postings(b.column("ids")[row].as_py(), *[_numbers(b, c, row) for c in ("lens", "held", "term", "tf")],
                                 weights, big_n, big_l)
                for k, asked in enumerate(items):
                    best[k] = block.improve(best[k], asked, top)
        for k, found in enumerate(best):
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k] * len(found), pa.int64()), pa.array([d for _, d in found], kind),
                     pa.array([s for s, _ in found], pa.int64())], names=["item", "doc_id", "score"])
    return run


def term_weight(big_n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * big_n + 2) / (2 * df + 1)))


def _item_blocks(items: DataFrame, most: int) -> Iterator[list]:
    """Items in blocks of at most ``most`` bytes of text (a longer one is a block of its own); only one block is
    on the driver at a time."""
    held, size = [], 0
    for r in items.select("item_id", text_bytes().alias("raw")).toLocalIterator():
        n = len(r.raw or b"")
        if held and size + n > most:
            yield held
            held, size = [], 0
        held.append(r)
        size += n
    if held:
        yield held


def search(docs: DataFrame, items: DataFrame, top: int = TOP, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` best documents of every item with a score above 0.

    The score is integer BM25 (see ``Postings`` and ``term_weight``). Equal scores rank by ascending doc_id, a null
    one last. A null or empty text has no term: such a document is never found, such an item finds nothing. Repeated
    documents are documents of their own; repeated items (or null ids) are ranked one by one. Of ``docs`` only doc_id
    (of any orderable type) and text are read, of ``items`` item_id and text. Empty tables give an empty result.
    """
    spark, id_type = docs.sparkSession, docs.schema["doc_id"].dataType
    source = docs.select("doc_id", text_bytes().alias("raw"))
    fields = T.StructType([T.StructField("item", T.LongType()), T.StructField("doc_id", id_type), T.StructField("score", T.LongType())])
    found = None
    for held in _item_blocks(items, item_bytes):
        asked = [list(dict.fromkeys(terms(r.raw))) for r in held]
        number = {w: k for k, w in enumerate(dict.fromkeys(w for ws in asked for w in ws))}
        blocks = stage(source.mapInArrow(_blocks(number), T.StructType(
            [T.StructField("ids", T.ArrayType(id_type)), *[T.StructField(c, T.BinaryType()) for c in ("lens", "held", "term", "tf")],
             T.StructField("n_docs", T.LongType()), T.StructField("n_terms", T.LongType())])), "search-blocks")
        big_n, big_l = (int(x or 0) for x in blocks.agg(F.sum("n_docs"), F.sum("n_terms")).first())
        weights = np.zeros(len(number), np.int64)
        for r in (blocks.mapInArrow(_document_counts(len(number)), "term long, df long")
                  .groupBy("term").agg(F.sum("df").alias("df")).collect()):    # one row per term of the items
            weights[r.term] = term_weight(big_n, r.df)
        numbered = [np.array([number[w] for w in ws], np.int64) for ws in asked]
        best = blocks.mapInArrow(_ranked(numbered, weights, big_n, big_l, top, _arrow_type(id_type)), fields)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
        best = best.filter("score > 0").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
        names = spark.createDataFrame([(k, r.item_id) for k, r in enumerate(held)],
                                      T.StructType([T.StructField("item", T.LongType()), items.schema["item_id"]]))
        best = best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        found = best if found is None else found.unionByName(best)
    if found is None:
        return spark.createDataFrame([], T.StructType([items.schema["item_id"], T.StructField("rank", T.IntegerType()),
                                                       *fields.fields[1:]]))
    return found


def _arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(kind)
