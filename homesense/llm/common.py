"""Helpers shared by the training-data operators.

Conventions of the subpackage:

* A *row key* (``row_key``) names a row by its id and text, so repeated ids with different texts stay apart
  and null ids do not meet. Operators read only the columns they need; extra columns never reach a plan.
* Intermediate tables are written to the shared folder in ``spark.checkpoint.dir`` (``stage``), never to a
  machine-local one and never as a local checkpoint, so a lost executor costs a task retry and not the job.
* Words are bytes: ``bytes.split()`` cuts at exactly the bytes 0x20 and 0x09-0x0D, ``bytes.lower()`` changes
  exactly A-Z, which is what the contracts of the queries ask for.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ARROW_BYTES = 4_000_000
BROADCAST_BYTES = 32_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; only a local session without one gets a scratch folder."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    found = tempfile.mkdtemp(prefix="llm-stage-")
    spark.sparkContext.setCheckpointDir(found)
    return spark.sparkContext.getCheckpointDir()


@contextmanager
def small_batches(spark: SparkSession, size: int = ARROW_BYTES) -> Iterator[None]:
    """Arrow batches of at most ``size`` bytes for what is run inside, so that a batch of long texts stays small."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(size))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: computed once, lineage cut."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    with small_batches(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, limit: int | None = None) -> DataFrame:
    """``df`` (a staged table) marked for broadcasting if its rows are counted to take at most ``limit`` bytes; beyond that it
    is left to a shuffled join, with the same result."""
    size = df.agg(F.sum(sum((_bytes(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields), F.lit(16)))).first()[0]
    return F.broadcast(df) if (size or 0) <= (BROADCAST_BYTES if limit is None else limit) else df


def _bytes(x: Column, kind: T.DataType) -> Column:
    """Bytes that a value takes."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        n = F.octet_length(x) + 16
    elif isinstance(kind, T.ArrayType):
        flat = not isinstance(kind.elementType, (T.StringType, T.BinaryType, T.ArrayType, T.StructType))
        n = 16 + (8 * F.size(x) if flat else F.aggregate(x, F.lit(0).cast("long"), lambda a, e: a + _bytes(e, kind.elementType)))
    elif isinstance(kind, T.StructType):
        n = sum((_bytes(x[f.name], f.dataType) for f in kind.fields), F.lit(16))
    else:
        return F.lit(8).cast("long")
    return F.coalesce(n, F.lit(0)).cast("long")


def row_key(*cols: str) -> Column:
    """64-bit name of a row from the given columns (``doc_id`` and ``text`` if none are given)."""
    cols = cols or ("doc_id", "text")
    return F.xxhash64(*[F.struct(F.col(c).isNull(), F.col(c)) for c in cols])


def text_bytes(col: str = "text") -> Column:
    return F.col(col).cast("binary")


def id_crc(col: str = "doc_id") -> Column:
    """crc32 of the id as text; a null id counts as empty text (0)."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary"))
