"""Packing token sequences by first-fit decreasing with a tournament tree.

Every document is tokenised once. Its whole multiples of the sequence length become full sequences; the
remaining tail of each document is placed by first-fit decreasing. Tails are dealt into randomised groups of
bounded expected size (a hash of a row number decides), each group is packed alone in one task, and a
tournament tree over the bins' free space finds the first bin that fits in logarithmic time. Full sequences are
numbered where they are cut, and tails travel once, with their ids, to the task that packs them: no piece is
joined with its place.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homesense.llm.common import row_key, stage, text_bytes

LENGTH = 1024
GROUP_DOCS = 4_000
END_ID = 0
TEXT_CHARS = 1_000_000
GAP = re.compile(r"(?<=\S) (?=\S)")
BATCH_IDS = 4_000_000     # bytes of ids in a batch
FULL = 1 << 61            # numbers of full sequences begin here


class Encoder:
    """Token ids of a text, equal to ``tokenizers`` with ``add_special_tokens=False``.

    A text is encoded in one call. The vocabulary's pre-tokenisation never joins characters across a single space
    between two non-spaces, so texts longer than ``TEXT_CHARS`` are cut at such spaces to bound memory. Texts that
    hold a special token's string go to ``tokenizers`` itself.
    """

    def __init__(self, json_path: str, ranks_path: str, pattern: str):
        import tiktoken
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("public", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.json_path, self.full, self.specials = json_path, None, _specials(json_path)

    def __call__(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if any(s in text for s in self.specials):
            if self.full is None:
                from tokenizers import Tokenizer
                self.full = Tokenizer.from_file(self.json_path)
            return np.asarray(self.full.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        return b"".join(np.asarray(self.fast.encode_ordinary(x), dtype="<u4").tobytes() for x in _cut(text))


def _cut(text: str) -> Iterator[str]:
    """``text`` in parts of about ``TEXT_CHARS`` characters, each but the first beginning with a single space."""
    at = 0
    while len(text) - at > TEXT_CHARS and (gap := GAP.search(text, at + TEXT_CHARS)):
        yield text[at:gap.start()]
        at = gap.start()
    yield text[at:] if at else text


def _specials(json_path: str) -> list[str]:
    import json
    with open(json_path, encoding="utf-8") as f:
        return [t["content"] for t in json.load(f).get("added_tokens", [])]


def default_tokenizer() -> tuple[str, str, str]:
    import public_tokenizers
    return (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
            public_tokenizers.PATTERN)


_PIECE = "doc_id long, row_id long, row long, doc_tokens long, start long, length long, ids binary, sequence_id long"
_ENCODERS: dict[tuple, Encoder] = {}


def _tokenised(paths: tuple[str, str, str] | None, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = paths or default_tokenizer()
        if key not in _ENCODERS:
            _ENCODERS[key] = Encoder(*key)
        encode, end = _ENCODERS[key], np.asarray([END_ID], dtype="<u4").tobytes()
        step, number = 4 * length, FULL + (TaskContext.get().partitionId() << 36)
        for b in batches:
            kept, held, size = [c for c in b.schema.names if c != "raw"], [], 0
            for k, raw in enumerate(b.column("raw")):
                text = raw.as_py()
                ids = (encode(text.decode("utf-8", "replace")) if text else b"") + end
                for i in range(0, len(ids), step):
                    part = ids[i:i + step]
                    held.append((k, len(ids) // 4, i // 4, part, number if len(part) == step else None))
                    number += len(part) == step
                    size += len(part)
                    if size >= BATCH_IDS:
                        yield _pieces(b, kept, held)
                        held, size = [], 0
            if held:
                yield _pieces(b, kept, held)
    return run


def _pieces(b: pa.RecordBatch, kept: list[str], held: list[tuple]) -> pa.RecordBatch:
    at, total, start, ids, number = zip(*held)
    at = pa.array(at, pa.int64())
    return pa.RecordBatch.from_arrays(
        [*[b.column(c).take(at) for c in kept], pa.array(total, pa.int64()), pa.array(start, pa.int64()),
         pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()), pa.array(number, pa.int64())],
        names=[*kept, "doc_tokens", "start", "length", "ids", "sequence_id"])


class FreeSpace:
    """Tournament tree: each inner node holds the larger free space of its two children."""

    def __init__(self, n_bins: int, capacity: int):
        self.size = 1 << max(0, (n_bins - 1).bit_length())
        self.tree = [capacity] * (2 * self.size)

    def place(self, need: int) -> tuple[int, int]:
        """The lowest bin with room for ``need`` and the free space it had; the room is taken."""
        tree, node = self.tree, 1
        while node < self.size:
            node *= 2
            if tree[node] < need:
                node += 1
        free = tree[node]
        tree[node] = free - need
        bin_, node = node - self.size, node >> 1
        while node:
            best = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == best:
                break
            tree[node] = best
            node >>= 1
        return bin_, free


def first_fit_decreasing(sizes: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset of every item; items fall in size, ties keep their order."""
    space = FreeSpace(len(sizes), capacity)
    bins, offsets = [0] * len(sizes), [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        bins[i], free = space.place(sizes[i])
        offsets[i] = capacity - free
    return bins, offsets


def _pack_group(length: int):
    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks().sort_by("row")
        bins, offsets = first_fit_decreasing(group["length"].to_pylist(), length)
        base = group["bucket"][0].as_py() << 32
        group = group.set_column(group.schema.get_field_index("sequence_id"), "sequence_id", pa.array([base + x for x in bins], pa.int64()))
        return group.drop_columns(["bucket"]).append_column("offset", pa.array(offsets, pa.int64()))
    return run


def pack_documents(docs: DataFrame, length: int = LENGTH, group_docs: int = GROUP_DOCS,
                   tokenizer: tuple[str, str, str] | None = None) -> DataFrame:
    """Pieces of all documents: doc_id, row_id, row, start, length, ids, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its token ids followed by one end id; a null or empty text is the end id alone. Every id is
    in exactly one piece; offsets in a sequence run gapless from 0. ``ids`` holds the piece's ids as little-endian
    unsigned 32-bit integers, so a sequence is the ``ids`` of its pieces joined by offset. ``row`` numbers the rows
    of ``docs``: it keeps repeated rows and null ids apart (each row is packed once), but differs between runs;
    ``row_id`` is the key by id and text. A very long text gives many full sequences and at most one tail. ``tokenizer`` is
    (json file, rank file, pattern), by default the public byte-level BPE. An empty table gives an empty result.
    """
    pieces = stage(
        docs.select("doc_id", row_key().alias("row_id"), F.monotonically_increasing_id().alias("row"),
                    text_bytes().alias("raw")).mapInArrow(_tokenised(tokenizer, length), _PIECE), "pack-pieces")
    tails = pieces.filter("sequence_id IS NULL")
    n_groups = max(1, -(-tails.count() // group_docs))
    packed = tails.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(n_groups))).groupBy("bucket").applyInArrow(
        _pack_group(length), _PIECE + ", offset long")
    full = pieces.filter("sequence_id IS NOT NULL").withColumn("offset", F.lit(0).cast("long"))
    return full.unionByName(packed).select("doc_id", "row_id", "row", "start", "length", "ids", F.crc32("ids").alias("ids_crc32"),
                                           "doc_tokens", "sequence_id", "offset")


def digests(pieces: DataFrame) -> DataFrame:
    """The columns of the queries: pieces without their ids, named by a checksum."""
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
