"""Sharding by longest-processing-time scheduling.

Rows with equal texts form a group that must stay in one shard. Sorted by size, each schedulable item goes to
the least-loaded shard, taken from a heap. An item is either one large group or a *bundle* of small groups
(all groups whose key hashes to the same bundle number). A group is large when it holds at least
``1 / (n_shards * fine)`` of all bytes, so there are at most ``n_shards * fine`` large groups and as many
bundles, however many rows the table has: that bounded list is what the driver schedules, while grouping,
assignment and numbering run on Spark.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from homesense.llm.common import stage

N_SHARDS = 24
FINE = 1024


def lpt(items: Iterable[tuple], n_shards: int) -> list[tuple]:
    """``(size, *key)`` items -> ``(*key, shard)``: by falling size, each to the least-loaded shard (ties: lowest)."""
    heap = [(0, s) for s in range(n_shards)]
    out = []
    for size, *key in sorted(items, key=lambda x: (-x[0], x[1:])):
        load, shard = heapq.heappop(heap)
        out.append((*key, shard))
        heapq.heappush(heap, (load + size, shard))
    return out


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the partition number and a running number per shard within the partition."""
    part = TaskContext.get().partitionId()
    seen: dict[int, int] = {}
    for b in batches:
        shard = b.column("shard").to_numpy(zero_copy_only=False)
        slot = np.empty(len(shard), np.int64)
        for s in np.unique(shard).tolist():
            at = np.flatnonzero(shard == s)
            slot[at] = seen.get(s, 0) + np.arange(len(at))
            seen[s] = seen.get(s, 0) + len(at)
        yield pa.RecordBatch.from_arrays(
            [*b.columns, pa.array(np.full(len(shard), part, np.int32)), pa.array(slot)],
            names=[*b.schema.names, "part", "local"])


def shard_documents(docs: DataFrame, n_shards: int = N_SHARDS, fine: int = FINE, whole: bool = False) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot for every row of ``docs`` (law ``bytes``: sizes near equal).

    size is the UTF-8 byte count plus 8. A null text counts as empty: it groups with empty texts, has size 8
    and crc32 0. Equal texts share a shard, repeated rows included; a single group above a shard's fair share
    makes that shard larger, as it must stay whole. Ties in load go to the lowest shard number. ``slot`` runs
    gapless from 0 within each shard. With ``whole``, the column ``document`` carries the whole row of ``docs``, so
    rows with null or repeated ids keep their own. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.xxhash64(text).alias("h"), F.crc32(text.cast("binary")).alias("text_crc32"),
                       (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
                       *[F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document")] * whole)
    carried = ["document"] * whole
    key = ["h", "text_crc32", "size"]
    groups = stage(rows.groupBy(*key).agg(F.count("*").alias("n")), "shard-groups")
    total = groups.agg(F.sum(F.col("size") * F.col("n"))).first()[0] or 0
    n_items = n_shards * fine
    weight, large = F.col("size") * F.col("n"), F.col("size") * F.col("n") * n_items >= total
    bundle = F.pmod(F.col("h"), F.lit(n_items)).cast("int")
    # at most n_items rows each: bounded by the definition of "large" and by the number of bundles
    heavy = [(r.w, "group", (r.h, r.text_crc32, r.size)) for r in
             groups.filter(large).select(*key, weight.alias("w")).collect()]
    light = [(r.w, "rest", (r.bundle,)) for r in
             groups.filter(~large).groupBy(bundle.alias("bundle")).agg(F.sum(weight).alias("w")).collect()]
    placed = lpt(heavy + light, n_shards)
    by_group = spark.createDataFrame(pa.Table.from_pylist(
        [dict(zip(key, k), group_shard=s) for kind, k, s in placed if kind == "group"],
        pa.schema([(c, pa.int64()) for c in key] + [("group_shard", pa.int32())])))
    by_bundle = spark.createDataFrame(pa.Table.from_pylist(
        [{"bundle": k[0], "bundle_shard": s} for kind, k, s in placed if kind == "rest"],
        pa.schema([("bundle", pa.int32()), ("bundle_shard", pa.int32())])))
    assigned = (rows.join(F.broadcast(by_group), key, "left")
                .withColumn("bundle", bundle).join(F.broadcast(by_bundle), "bundle", "left")
                .select("doc_id", "size", "text_crc32",
                        F.coalesce("group_shard", "bundle_shard").alias("shard"), *carried))
    schema = T.StructType([*assigned.schema, T.StructField("part", T.IntegerType()), T.StructField("local", T.LongType())])
    numbered = stage(assigned.mapInArrow(_number, schema), "shard-rows")
    counts = numbered.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return numbered.join(starts, ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("local")).alias("slot"), *carried)


def write_shards(docs: DataFrame, path: str, n_shards: int = N_SHARDS, fine: int = FINE) -> None:
    """Shards ``docs`` and writes every row once, one folder per shard, rows of a shard ordered by slot. A column of
    ``docs`` that is named shard or slot is written as ``document_shard`` or ``document_slot``."""
    columns = [F.col(f"document.`{c}`").alias(f"document_{c}" if c.lower() in ("shard", "slot") else c)
               for c in docs.columns]
    (shard_documents(docs, n_shards, fine, whole=True).select(*columns, "shard", "slot")
     .repartition(F.col("shard"), F.pmod(F.col("slot"), F.lit(8)))
     .sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path))
