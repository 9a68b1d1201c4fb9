"""SimHash near-duplicates through a byte-position inverted index with count filtering.

A fingerprint is 8 bytes. Two fingerprints that differ in at most ``d <= 4`` bits differ in at most d bytes,
so they share at least ``8 - d >= 4`` positional bytes: the guaranteed minimum. The index files a fingerprint
under combinations of three positions with their bytes, chosen so that any four positions contain one of
them; a pair above the minimum therefore meets in at least one list, and lists are 65,536 times shorter than
those of single bytes. Wherever two fingerprints meet, their shared positional bytes are tallied, pairs below
the minimum are dropped, and the bit distance of the rest is verified. Equal fingerprints are one entry, long
lists are compared in blocks, and only spanning forests of links leave a task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from homesense.llm.common import row_key, stage, text_bytes
from homesense.llm.lists import blocked, components, group_ids, groups

SHINGLE = 4
MAX_BITS = 4
SEED = 42
CHUNK = 200_000

_BLANK = re.compile(rb"[\x20\x09-\x0D]")


def fingerprint(raw: bytes | None, shingle: int = SHINGLE) -> int:
    """SimHash of a text: a bit is set if it is set in over half of the shingles' hashes; 0 without words."""
    digest, ones, n, words = xxhash.xxh64_intdigest, np.zeros(64, np.int64), 0, []
    for piece in _pieces(raw.lower()) if raw else ():
        words = words[1 - shingle:] if shingle > 1 else []      # shingles that begin in the piece before
        words = words + piece.split()
        if len(words) < shingle:
            continue
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate([[0], ends[:-1]])[:len(words) - shingle + 1].tolist()
        stops = (ends[shingle - 1:] - 1).tolist()
        h = np.fromiter((digest(joined[s:e], SEED) for s, e in zip(starts, stops)), np.uint64, len(starts))
        ones += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64)
        n += len(starts)
    if not n:
        return digest(b" ".join(words), SEED) if words else 0
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _pieces(raw: bytes) -> Iterator[bytes]:
    """A text in pieces of about ``CHUNK`` bytes, cut before a blank."""
    at = 0
    while at < len(raw):
        blank = _BLANK.search(raw, at + CHUNK)
        end = blank.start() if blank else len(raw)
        yield raw[at:end]
        at = end


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(x.as_py(), shingle) for x in b.column("raw")), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("row_id"), pa.array(fps.view(np.int64))],
                                             names=["doc_id", "row_id", "fp"])
    return run


def blocks_of_positions() -> list[tuple[int, int, int]]:
    """Twenty triples of the 8 positions such that every four positions contain one: three near-equal parts in
    a ring, triples inside a part, and two positions of a part with one of the next."""
    parts = [range(0, 3), range(3, 6), range(6, 8)]
    out = [t for p in parts for t in combinations(p, 3)]
    for k, p in enumerate(parts):
        out += [(*pair, x) for pair in combinations(p, 2) for x in parts[(k + 1) % 3]]
    return out


def _posting_keys() -> Column:
    def byte(i: int) -> Column:
        return F.shiftrightunsigned("fp", 8 * i).bitwiseAND(F.lit(255))
    return F.array(*[(F.lit(k << 24) + byte(a) * 65536 + byte(b) * 256 + byte(c)).cast("long")
                     for k, (a, b, c) in enumerate(blocks_of_positions())])


def _links(max_bits: int):
    least = 8 - max_bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in groups(batches, "posting"):
            f = b.column("fp").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            gid, root, off = group_ids(b, "posting"), np.arange(len(f)), 1
            at = np.arange(len(f))
            while len(at := at[at + off < len(f)]) and len(at := at[gid[at] == gid[at + off]]):
                pair = at[root[at] != root[at + off]]
                x = f[pair] ^ f[pair + off]
                tally = (x.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
                pair, x = pair[tally >= least], x[tally >= least]
                pair = pair[np.bitwise_count(x) <= max_bits]
                if len(pair):
                    for i in pair.tolist():
                        r, s = _find(root, i), _find(root, i + off)
                        if r != s:
                            root[max(r, s)] = min(r, s)
                    while (root[root] != root).any():
                        root = root[root]
                off += 1
            own = np.flatnonzero(root != np.arange(len(f)))
            yield pa.RecordBatch.from_arrays([pa.array(f[own].view(np.int64)), pa.array(f[root[own]].view(np.int64))],
                                             names=["a", "b"])
    return run


def _find(root: np.ndarray, i: int) -> int:
    while root[i] != i:
        i = int(root[i])
    return i


def simhash_components(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, row_id, fp, root, component_id for every row of ``docs``.

    Words are runs of bytes other than 0x20 and 0x09-0x0D, A-Z lower-cased. A text with fewer words than a
    shingle has one shingle, its whole word sequence; a null, empty or blank text has fingerprint 0 and is
    linked like any other. ``component_id`` is the smallest doc_id reachable over links of at most
    ``max_bits`` differing bits; null ids link but never name a component (null if there is no other).
    ``root`` names the component by a fingerprint, ``row_id`` is the row key of (doc_id, text). An empty table gives an empty result.
    """
    if not 0 <= max_bits <= 4:
        raise ValueError("the index guarantees meetings up to 4 differing bits")
    rows = stage(docs.select("doc_id", row_key().alias("row_id"), text_bytes().alias("raw"))
                 .mapInArrow(_fingerprints(shingle), "doc_id long, row_id long, fp long"), "simhash-rows")
    prints = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-prints")
    postings = prints.select("fp", F.explode(_posting_keys()).alias("posting"))
    roots = components(blocked(postings, "posting", "fp").mapInArrow(_links(max_bits), "a long, b long"))
    named = prints.join(roots, prints.fp == roots.node, "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    smallest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rows.join(named.join(smallest, "root").select("fp", "root", "component_id"), "fp").select(
        "doc_id", "row_id", "fp", "root", "component_id")


def hex16(fp: str = "fp") -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
