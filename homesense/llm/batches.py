"""Documents in batches, and exchanges of packed keys between batches and buckets.

Operators that must look up every n-gram or window of the corpus would shuffle one row per token. Instead a
task works on a batch of whole documents (one row, texts compressed), reduces its keys to distinct ones, and
sends each *bucket* (a range of key hashes) one row with its keys packed. A bucket answers every batch with one
row, packed in the same order. So a key travels at most once per batch, however often it occurs there: a
frequent key costs no more than a rare one, and no bucket grows hot. Batches have a bounded size in bytes (a
longer single text is a batch of its own) and the number of buckets grows with the input, so both sides of
the exchange fit a task at every size. A batch sends nothing to a bucket for which it has no key: there are never
more rows than distinct keys per batch, so the exchange grows with the corpus also where buckets outnumber the
keys of a batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homesense.llm.common import stage

BATCH_BYTES = 5_000_000

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_R = np.uint64(33)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (the finaliser of MurmurHash3)."""
    x = x ^ (x >> _R)
    x = x * _M1
    x = x ^ (x >> _R)
    x = x * _M2
    return x ^ (x >> _R)


def mix2(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One 64-bit name for an ordered pair of names."""
    return mix(mix(a + _GOLD) * np.uint64(31) + b)


def batched(docs: DataFrame, text: str, name: str, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Staged table with one row per batch: bid, bytes, payload (all columns of ``docs``, Arrow IPC, zstd).
    ``text`` names the binary column whose size counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, n = TaskContext.get().partitionId() << 32, 0
        held, size = [], 0

        def row() -> pa.RecordBatch:
            t = pa.Table.from_batches(held)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, t.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                w.write_table(t)
            return pa.RecordBatch.from_arrays(
                [pa.array([first + n], pa.int64()), pa.array([size], pa.int64()),
                 pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["bid", "bytes", "payload"])

        for b in batches:
            lens = pa.compute.fill_null(pa.compute.binary_length(b.column(text)), 0).to_numpy(zero_copy_only=False)
            at = 0
            for k, x in enumerate(lens.tolist()):
                if size and size + x > batch_bytes:
                    held.append(b.slice(at, k - at))
                    if at < k or sum(h.num_rows for h in held):
                        yield row()
                    n, held, size, at = n + 1, [], 0, k
                size += x + 16
            held.append(b.slice(at))
        if sum(h.num_rows for h in held):
            yield row()
    return stage(docs.mapInArrow(run, "bid long, bytes long, payload binary"), name)


def bucket_count(staged: DataFrame, batch_bytes: int = BATCH_BYTES) -> int:
    return max(1, -(-(staged.agg(F.sum("bytes")).first()[0] or 0) // batch_bytes))


def unpack(payload: bytes) -> pa.Table:
    return pa.ipc.open_stream(payload).read_all()


class Tokens:
    """The words of a batch: ``ids`` number them within the batch, ``names`` are the words' 64-bit hashes.

    ``ends`` adds an end token (number 0) to each document; number 1 is kept free for its start.
    """

    def __init__(self, raws: list[bytes | None], lower: bool, ends: bool):
        number: dict[bytes, int] = {}
        flat = []
        for raw in raws:
            ws = (raw.lower() if lower else raw).split() if raw else []
            for w in dict.fromkeys(ws):
                number.setdefault(w, len(number) + 2)
            ids = np.fromiter(map(number.__getitem__, ws), np.int64, len(ws))
            flat.append(np.append(ids, 0) if ends else ids)
        self.ids = np.concatenate(flat) if flat else np.zeros(0, np.int64)
        self.lens = np.fromiter(map(len, flat), np.int64, len(flat))
        self.starts = np.cumsum(self.lens) - self.lens
        self.doc = np.repeat(np.arange(len(flat)), self.lens)
        self.names = np.fromiter((xxhash.xxh64_intdigest(w) for w in number), np.uint64, len(number))
        self.names = np.concatenate([np.array([1, 2], np.uint64), self.names])


def by_bucket(keys: np.ndarray, n_buckets: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Stable order that puts keys of a bucket together, and (bucket, low, high) of each part of it that is not empty."""
    bucket = ((keys >> np.uint64(32)) * np.uint64(n_buckets)) >> np.uint64(32)
    order = np.argsort(bucket, kind="stable")
    found, low = np.unique(bucket[order], return_index=True)
    return order, list(zip(found.tolist(), low.tolist(), [*low[1:].tolist(), len(order)]))


def pack(x: np.ndarray) -> bytes:
    return pa.compress(x.tobytes(), codec="zstd", asbytes=True) if len(x) else b""


def unpacked(raw: bytes, n: int, dtype: str) -> np.ndarray:
    size = n * np.dtype(dtype).itemsize
    return np.frombuffer(pa.decompress(raw, decompressed_size=size, codec="zstd", asbytes=True), dtype) if n else np.zeros(0, dtype)
