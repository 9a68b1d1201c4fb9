"""Prefix trie of conversations by time-forward processing.

A node is a distinct sequence of first turns. Its name chains 128-bit hashes: a turn's (role and text) onto the name
of the node before. Members are counted by one aggregate per node. Subtree totals then go upwards:

* Nodes with more than R / ``top_nodes`` members (R: turns of all conversations) form the top of the trie. Each level
  has every turn once at most, so these are fewer than ``top_nodes``, whatever the input. What hangs below is cut into
  shards, one per child of the top: however many children a top node has, no shard has more members than that.
* Within a shard, nodes come in reverse level order from Spark's external sort. A node takes the messages of its
  children from a priority queue that is ordered like the nodes, and sends its own totals to its parent through it. The
  queue spills sorted runs, so its memory is bounded.
* The totals of the shard roots are added per parent by an aggregate, and the top is run the same way.

The turns of a conversation are read as a stream, in order; texts stay behind once hashed.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from homesense.llm.common import stage

TOP_NODES = 200_000
QUEUE = 100_000             # messages that a queue holds in memory
RUNS = 32                   # runs that are read at the same time
ROWS = 10_000
ROOT = bytes(16)


def turn_rows(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, turn_id, len: every turn with a conv_id. ``turn_id`` hashes role and text (null: empty)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.unhex(F.md5(F.concat(F.md5(F.coalesce(F.col("role"), F.lit(""))), text))).alias("turn_id"),
        F.length(text).cast("long").alias("len"))


def turn_texts(conversations: DataFrame) -> DataFrame:
    """turn_id, role, text of every distinct turn: joined on ``turn_id``, they give nodes their texts."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    return conversations.select(F.unhex(F.md5(F.concat(F.md5(role), text))).alias("turn_id"), role.alias("role"),
                                text.alias("text")).dropDuplicates(["turn_id"])


def shared_heads(turns: DataFrame, group: int = 100, sizes: int = 6) -> DataFrame:
    """conv_id, skip, head: what conversation c starts with, the first ``skip`` turns of conversation c - c % group in
    place of its own first ``skip``; ``skip`` is crc32(c as text) % sizes. ``head`` is shorter if there are fewer."""
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "turn_id")
    firsts = (turns.filter(F.col("conv_id") % group == 0).withColumn("n", F.row_number().over(order))
              .filter(F.col("n") < sizes).groupBy(F.col("conv_id").alias("base"))
              .agg(F.sort_array(F.collect_list(F.struct("n", "turn_id", "len"))).alias("head")))     # below ``sizes`` turns
    skip = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % sizes).cast("int")
    head = F.transform(F.slice("head", 1, F.col("skip")), lambda t: F.struct(t["turn_id"].alias("turn_id"), t["len"].alias("len")))
    return (turns.select("conv_id").distinct().withColumn("skip", skip)
            .withColumn("base", F.col("conv_id") - F.col("conv_id") % group).join(firsts, "base", "left")
            .select("conv_id", "skip", head.alias("head")))


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of conversation and turn (a conversation's row without a turn first) -> the nodes it passes."""
    held: list[list] = []
    conv = node = None
    depth = seen = skip = 0

    def step(turn_id: bytes, size: int) -> None:
        nonlocal node, depth
        parent, node, depth = node, xxhash.xxh3_128_digest(node + turn_id), depth + 1
        held[-1][-1] = False
        held.append([conv, depth, node, parent, turn_id, size, True])

    def flush(keep: int) -> pa.RecordBatch:
        out = held[:len(held) - keep]
        del held[:len(held) - keep]
        cols = list(zip(*out))
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.bool_()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                          names=["conv_id", "depth", "node", "parent", "turn_id", "len", "last"])

    for b in batches:
        for row in b.to_pylist():
            if row["skip"] is not None:
                conv, node, depth, seen, skip = row["conv_id"], ROOT, 0, 0, row["skip"]
                held.append([conv, 0, ROOT, None, None, 0, True])
                for t in row["head"] or []:
                    step(t["turn_id"], t["len"])
            else:
                seen += 1
                if seen > skip:
                    step(row["turn_id"], row["len"])
            if len(held) > ROWS:
                yield flush(1)      # the last row of a conversation may still turn out not to be its end
    if held:
        yield flush(0)


def paths(turns: DataFrame, heads: DataFrame) -> DataFrame:
    """conv_id, depth, node, parent, turn_id, len, last: every node that every conversation passes, the root too."""
    first = heads.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast(turns.schema["turn"].dataType).alias("turn"),
                         F.lit(None).cast("binary").alias("turn_id"), F.lit(None).cast("long").alias("len"), "skip", "head")
    own = turns.select("conv_id", F.lit(1).alias("kind"), "turn", "turn_id", "len", F.lit(None).cast("int").alias("skip"),
                       F.lit(None).cast(heads.schema["head"].dataType).alias("head"))
    rows = first.unionByName(own).repartition("conv_id").sortWithinPartitions(
        "conv_id", "kind", F.col("turn").asc_nulls_first(), "turn_id")
    return rows.select("conv_id", "turn_id", "len", "skip", "head").mapInArrow(
        _paths, "conv_id long, depth long, node binary, parent binary, turn_id binary, len long, last boolean")


class SpillingQueue:
    """Priority queue of (key, message) pairs, smallest key first. At most ``room`` of them are in memory; the rest
    lies in sorted runs, unnamed files of the task that vanish with it (as Spark's own spills do)."""

    def __init__(self, room: int = QUEUE):
        self.room, self.count, self.heap, self.runs = room, 0, [], []

    def push(self, key: tuple, message: tuple) -> None:
        if len(self.heap) >= self.room:
            self._spill()
        self.count += 1
        heapq.heappush(self.heap, (key, self.count, message))

    def _spill(self) -> None:
        self.heap.sort()
        keep = self.room // 4
        self._run(iter(self.heap[keep:]))
        self.heap = self.heap[:keep]
        if len(self.runs) > RUNS:
            runs, self.runs = self.runs, []
            self._run(heapq.merge(*[self._rest(first, f) for first, _, f in runs]))

    def _run(self, entries: Iterator[tuple]) -> None:
        f = tempfile.TemporaryFile()
        for e in entries:
            pickle.dump(e, f)
        f.seek(0)
        self._open(f)

    def _open(self, f) -> None:
        try:
            heapq.heappush(self.runs, (pickle.load(f), id(f), f))
        except EOFError:
            f.close()

    @staticmethod
    def _rest(first: tuple, f) -> Iterator[tuple]:
        yield first
        with f:
            while True:
                try:
                    yield pickle.load(f)
                except EOFError:
                    return

    def take(self, key: tuple) -> Iterator[tuple]:
        """Removes and yields the messages with this key; all smaller keys must have been taken."""
        while True:
            from_run = bool(self.runs) and (not self.heap or self.runs[0][0] < self.heap[0])
            first = self.runs[0][0] if from_run else self.heap[0] if self.heap else None
            if first is None or first[0] != key:
                return
            if from_run:
                _, _, f = heapq.heappop(self.runs)
                self._open(f)
            else:
                heapq.heappop(self.heap)
            yield first[2]


_NODE = ["node", "parent", "turn_id", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
_KINDS = [pa.binary()] * 3 + [pa.int64()] * 7
_SCHEMA = "node binary, parent binary, turn_id binary, " + ", ".join(f"{c} long" for c in _NODE[3:])


def _time_forward(room: int):
    """Nodes in reverse level order (``top``: the totals leave the shard here) -> nodes with their subtree's totals."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue, done = SpillingQueue(room), []

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), _KINDS)], names=_NODE)
            done.clear()
            return out

        for b in batches:
            for r in b.to_pylist():
                children, leaves, saved = r["in_children"], r["in_leaves"], r["in_saved"]
                for child in queue.take((-r["depth"], r["node"])):
                    children, leaves, saved = children + 1, leaves + child[8], saved + child[9]
                    done.append((*child[:5], r["conv_id"], *child[6:]))
                row = (r["node"], r["parent"], r["turn_id"], r["conv_id"], r["depth"], None, r["n_convs"], children,
                       leaves or 1, saved + (r["n_convs"] - 1) * r["len"])
                if r["top"]:
                    done.append(row)
                else:
                    queue.push((1 - r["depth"], r["parent"]), row)
                if len(done) > ROWS:
                    yield flush()
        if done:
            yield flush()
    return run


def _reverse_levels(df: DataFrame) -> DataFrame:
    return df.sortWithinPartitions(F.desc("depth"), "node").select(
        "node", "parent", "turn_id", "conv_id", "depth", "n_convs", "len", "in_children", "in_leaves", "in_saved", "top")


def prefix_trie(conversations: DataFrame, heads=None, top_nodes: int = TOP_NODES, queue: int = QUEUE) -> tuple[DataFrame, DataFrame]:
    """Nodes and ends of the trie of all conversations.

    Nodes: node, parent (names), turn_id (of the last turn, see ``turn_texts``), conv_id (smallest member), depth,
    parent_conv_id, n_convs (members), n_children, n_leaves (childless nodes in the subtree) and saved_tokens (over
    the subtree, members less one times the code points of the last text). Ends: node, conv_id of every
    conversation, at the node where it ends.

    Turns are ordered by ``turn``, null first, equal ones by the hash of role and text; null role or text is empty. Rows
    without conv_id belong to no conversation and are left out. ``heads`` maps the turn rows to (conv_id, skip, head), as
    ``shared_heads`` does; without it, conversations are taken as they are. Repeated rows are turns of their own.
    An empty table gives no node, not even the root. Extra columns are ignored.
    """
    turns = turn_rows(conversations)
    none = F.array().cast("array<struct<turn_id:binary,len:bigint>>")
    starts = heads(turns) if heads else turns.select("conv_id").distinct().select("conv_id", F.lit(0).alias("skip"), none.alias("head"))
    passed = stage(paths(turns, starts), "trie-paths")
    nodes = stage(passed.groupBy("node", "parent", "turn_id", "depth", "len").agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")), "trie-nodes")
    total = nodes.filter("depth > 0").agg(F.sum("n_convs")).first()[0] or 0
    light = F.col("n_convs") <= max(1, -(-total // top_nodes))
    zero = [F.lit(0).cast("long").alias(c) for c in ("in_children", "in_leaves", "in_saved")]
    top = nodes.filter(~light | (F.col("depth") == 0))                       # fewer than ``top_nodes``, and the root
    names = F.broadcast(top.select("node", F.col("conv_id").alias("above")))
    # a conversation's first node below the top is the root of the shard that holds its further nodes
    roots = (passed.join(names, "node", "left_anti").groupBy("conv_id")
             .agg(F.min(F.struct("depth", "node"))["node"].alias("shard")))
    below = nodes.filter(light & (F.col("depth") > 0)).join(roots, "conv_id").select(
        "*", *zero, (F.col("node") == F.col("shard")).alias("top"))
    below = stage(_reverse_levels(below.repartition("shard")).mapInArrow(_time_forward(queue), _SCHEMA), "trie-below")
    sent = (below.filter("parent_conv_id IS NULL").groupBy(F.col("parent").alias("to"))
            .agg(F.count("*").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")))
    upper = top.join(sent, F.col("node") == F.col("to"), "left").select(
        *top.columns, *[F.coalesce(c, F.lit(0).cast("long")).alias(f"in_{c}") for c in ("children", "leaves", "saved")],
        (F.col("depth") == 0).alias("top"))
    upper = stage(_reverse_levels(upper.coalesce(1)).mapInArrow(_time_forward(queue), _SCHEMA), "trie-top")
    below = below.join(names.withColumnRenamed("node", "parent"), "parent", "left").withColumn(
        "parent_conv_id", F.coalesce("parent_conv_id", "above"))
    return upper.select(*_NODE).unionByName(below.select(*_NODE)), passed.filter("last").select("node", "conv_id")


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ends -> (node, first id, ids comma-joined) for every node and run of at most ``ROWS`` of its ids."""
    out: list[tuple[bytes, int, list[int]]] = []

    def flush(keep: int) -> pa.RecordBatch:
        rows = out[:len(out) - keep]
        del out[:len(out) - keep]
        return pa.RecordBatch.from_arrays([pa.array([n for n, _, _ in rows], pa.binary()), pa.array([c for _, c, _ in rows], pa.int64()),
                                           pa.array([",".join(map(str, ids)) for _, _, ids in rows], pa.string())],
                                          names=["node", "first", "ids"])

    size = 0
    for b in batches:
        for node, conv in zip(b.column("node").to_pylist(), b.column("conv_id").to_pylist()):
            if out and out[-1][0] == node and len(out[-1][2]) < ROWS:
                out[-1][2].append(conv)
            else:
                out.append((node, conv, [conv]))
            size += 1
            if size >= 10 * ROWS:
                if len(out) > 1:
                    yield flush(1)
                size = len(out[-1][2])
    if out:
        yield flush(0)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    node, sha, out = None, None, []

    def flush() -> pa.RecordBatch:
        rows = pa.RecordBatch.from_arrays([pa.array([n for n, _ in out], pa.binary()), pa.array([d for _, d in out], pa.string())],
                                          names=["node", "ends_sha256"])
        out.clear()
        return rows

    for b in batches:
        for at, ids in zip(b.column("node").to_pylist(), b.column("ids").to_pylist()):
            if at != node:
                if sha:
                    out.append((node, sha.hexdigest()))
                node, sha = at, hashlib.sha256(ids.encode())
            else:
                sha.update(b"," + ids.encode())
        if len(out) > ROWS:
            yield flush()
    if sha:
        out.append((node, sha.hexdigest()))
        yield flush()


def ends_digest(ends: DataFrame) -> DataFrame:
    """node, ends_sha256: SHA-256 of the ids of the conversations that end at a node, ascending and comma-joined.

    Ids are sorted in ranges, so those of a node where many conversations end are spread over tasks, which join them to
    runs of up to ``ROWS``; the runs of a node pass through its hash as a stream."""
    runs = ends.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id").mapInArrow(
        _packed, "node binary, first long, ids string")
    return runs.repartition("node").sortWithinPartitions("node", "first").select("node", "ids").mapInArrow(
        _digests, "node binary, ends_sha256 string")
