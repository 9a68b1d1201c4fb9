"""Inverted lists of any length, compared in bounded blocks, and connected components of the links found.

A list (all entries under one key) may hold a third of all rows. ``blocked`` cuts long lists into blocks of
bounded expected size by a hash of the entry and sends every pair of blocks to its own group, so no task ever
holds a whole long list; short lists, nearly all of them, stay one group. ``groups`` walks the sorted groups
of a partition. Neither emits pairs: what leaves a group is up to the caller (a spanning forest, counts).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homesense.llm.common import stage

BLOCK = 1024
BROADCAST_KEYS = 100_000


def blocked(entries: DataFrame, key: str, entry: str, block: int = BLOCK) -> DataFrame:
    """``entries`` with ``own``, ``i`` and ``j``: the row's block and the group's pair of blocks (i <= j), one row
    per pair. Partitioned by (key, i, j) and sorted, ready for ``groups``. Only the keys are counted beforehand,
    so that the entries with all their columns are shuffled once."""
    long = stage(entries.groupBy(key).agg(F.count("*").alias("n")).filter(F.col("n") > block), "long-lists")
    if long.count() <= BROADCAST_KEYS:
        long = F.broadcast(long)
    sized = entries.join(long, key, "left").withColumn(
        "blocks", F.coalesce(F.ceil(F.col("n") / block), F.lit(1)).cast("int")).withColumn(
        "own", F.pmod(F.xxhash64(entry), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    return (sized.select(*entries.columns, "own", other)
            .withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")).drop("other")
            .repartition(key, "i", "j").sortWithinPartitions(key, "i", "j", entry))


def groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """Batches that hold whole groups: rows equal in (key, i, j) are never cut apart."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        ids = np.stack([b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (key, "i", "j")])
        new = np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(axis=0)) + 1
        if held:
            last = held[-1]
            same = all(last.column(c)[-1].as_py() == b.column(c)[0].as_py() for c in (key, "i", "j"))
            starts = new if same else np.concatenate([[0], new])
        else:
            starts = new
        if len(starts):
            cut = int(starts[-1])
            held.append(b.slice(0, cut))
            yield _joined(held)
            held = [b.slice(cut)]
        else:
            held.append(b)
    if held:
        yield _joined(held)


def _joined(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    if len(held) == 1:
        return held[0]
    t = pa.Table.from_batches(held).combine_chunks()
    return pa.RecordBatch.from_arrays([c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in t.columns],
                                      names=t.schema.names)


def group_ids(b: pa.RecordBatch, key: str) -> np.ndarray:
    """Number of each row's group within the batch, rising from 0."""
    ids = np.stack([b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (key, "i", "j")])
    return np.concatenate([[0], np.cumsum((ids[:, 1:] != ids[:, :-1]).any(axis=0))]) if b.num_rows else ids[0]


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the undirected links (a, b): node, root (the smallest node of its component).

    Each round points every node at its smallest neighbour, follows the pointers to their ends, renames the
    links by the ends and drops inner ones; the number of nodes with links at least halves. Tables between
    rounds are written to the shared folder. Nodes without links are absent.
    """
    links = stage(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                  .filter("a < b").distinct(), "links")
    labels = None
    while not links.isEmpty():
        p = stage(links.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root")), "pointers")
        while True:
            q = p.select(F.col("node").alias("root"), F.col("root").alias("next"))
            p = stage(p.join(q, "root", "left").select("node", F.coalesce("next", "root").alias("root"),
                                                       F.col("next").isNotNull().alias("moved")), "pointers")
            if p.filter("moved").isEmpty():
                break
            p = p.select("node", "root")
        p = p.select("node", "root")
        to = p.select(F.col("node").alias("old"), F.col("root").alias("new"))
        if labels is None:
            labels = p
        else:
            labels = labels.join(to, labels.root == to.old, "left").select(
                "node", F.coalesce("new", "root").alias("root")).union(p)
        at_a = links.join(to, links.a == to.old, "left").select(F.coalesce("new", "a").alias("a"), "b")
        both = at_a.join(to, at_a.b == to.old, "left").select("a", F.coalesce("new", "b").alias("b"))
        links = stage(both.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                      .distinct(), "links")
    return labels if labels is not None else links.select(F.col("a").alias("node"), F.col("b").alias("root"))
