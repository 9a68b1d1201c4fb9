"""Skew-safe ordered primitives: lead/lag, running sums and the last value so far per entity.

A plain ``Window.partitionBy(patient)`` sends every row of one patient to one task; one patient holding a
third of all rows would then sort a third of the data in one task. Here each entity's sequence is cut into
time chunks (a column monotone in time, default one day) and every plan is a single stream: the input is
consumed once, so chained operators keep a linear plan (no self-join or self-union whose upstream would be
recomputed per branch).

* shifts (lead/lag by up to K rows): window over ``(keys, chunk)``; only the first and last K rows of a
  chunk can need a neighbour from another chunk. A second window is partitioned by ``(keys, part)`` where
  part is the chunk for interior rows and -1 for border rows, so the border rows of all chunks of a key
  meet in one partition (2K rows per chunk: bounded by the time span, not by the row count) and take their
  cross-chunk neighbours there. Two exchanges.
* running sums: local running sum and chunk total per ``(keys, chunk)``; the last row of every chunk also
  emits a summary row; summaries of a key meet in partition ``(keys, -1)`` and get the exclusive prefix
  of chunk totals; a third window over ``(keys, chunk)`` hands that offset to the chunk's rows. Three
  exchanges, one row per chunk in the per-key partition.
* last non-null value so far: the same scan with "the later non-null one" in place of the sum: the local last value,
  and for rows without one the last value of the nearest earlier chunk that has any.

``chunk_seconds=None`` gives the single-window form (one exchange, hot keys stay whole); both forms return
identical rows (tested).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from homesense.functions.time import c, epoch_micros

DAY = 86_400
AUTO = "auto"
CHUNK_CONF = "spark.homesense.sequence.chunkSeconds"

_CHUNK, _RN, _CNT, _PART = "__chunk", "__rn", "__cnt", "__part"


def _order(ts: str, tiebreak: str | Sequence[str] | None) -> list[Column]:
    tb = [tiebreak] if isinstance(tiebreak, str) else list(tiebreak or [])
    return [F.col(ts).asc_nulls_first()] + [F.col(t).asc_nulls_first() for t in tb]


def require_keys(keys: Sequence[str]) -> list[str]:
    keys = [keys] if isinstance(keys, str) else list(keys)
    if not keys:
        raise ValueError("sequence operators need at least one partition key (no unpartitioned windows)")
    return keys


def chunk_of(ts, chunk_seconds: int) -> Column:
    return F.floor(epoch_micros(ts) / F.lit(chunk_seconds * 1_000_000)).cast("long")


def resolve_chunk(df: DataFrame, chunk_seconds) -> int | None:
    """``"auto"`` reads ``spark.homesense.sequence.chunkSeconds`` from the session (default one day;
    0 or a negative value selects the single-window form)."""
    if chunk_seconds != AUTO:
        return chunk_seconds
    v = int(df.sparkSession.conf.get(CHUNK_CONF, str(DAY)))
    return v if v > 0 else None


def _shift(v, k: int) -> Column:
    return F.lead(c(v), k) if k > 0 else F.lag(c(v), -k)


def with_shifts(df: DataFrame, keys: Sequence[str], ts: str, tiebreak, shifts: Mapping[str, tuple],
                chunk_seconds: int | None | str = AUTO) -> DataFrame:
    """Add ``name = value taken k rows later (k > 0) or earlier (k < 0)`` per key, ordered by (ts, tiebreak).

    ``shifts`` maps output name -> (column or name, k).
    """
    keys = require_keys(keys)
    order = _order(ts, tiebreak)
    chunk_seconds = resolve_chunk(df, chunk_seconds)
    if not shifts:
        return df
    if chunk_seconds is None:
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.select("*", *[_shift(v, k).over(w).alias(n) for n, (v, k) in shifts.items()])

    base_cols = df.columns
    big_k = max(abs(k) for _, k in shifts.values())
    d = df.withColumn(_CHUNK, chunk_of(ts, chunk_seconds))
    wc = Window.partitionBy(*keys, _CHUNK).orderBy(*order)
    wall = wc.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    d = d.select("*", F.row_number().over(wc).alias(_RN), F.count(F.lit(1)).over(wall).alias(_CNT),
                 *[_shift(v, k).over(wc).alias(f"__l_{i}") for i, (v, k) in enumerate(shifts.values())])
    rn, cnt = F.col(_RN), F.col(_CNT)
    d = d.withColumn(_PART, F.when((rn <= big_k) | (rn > cnt - big_k), F.lit(-1)).otherwise(F.col(_CHUNK)))
    wp = Window.partitionBy(*keys, _PART).orderBy(*order)
    out = []
    for i, (n, (v, k)) in enumerate(shifts.items()):
        in_chunk = (rn + k <= cnt) if k > 0 else (rn + k >= 1)
        out.append(F.when(in_chunk, F.col(f"__l_{i}")).otherwise(_shift(v, k).over(wp)).alias(n))
    return d.select(*base_cols, *out)


def _scan(df: DataFrame, keys: list[str], ts: str, tiebreak, value, chunk_seconds: int, fold, join, out: str) -> DataFrame:
    """A segmented scan: ``fold`` over a chunk's values up to a row, joined with ``fold`` over the earlier chunks' totals."""
    base_cols, order = df.columns, _order(ts, tiebreak)
    d = df.withColumn(_CHUNK, chunk_of(ts, chunk_seconds)).withColumn("__v", c(value))
    wc = Window.partitionBy(*keys, _CHUNK).orderBy(*order)
    whole = wc.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    d = d.select("*", fold(F.col("__v")).over(wc.rowsBetween(Window.unboundedPreceding, 0)).alias("__local"),
                 fold(F.col("__v")).over(whole).alias("__tot"),
                 F.row_number().over(wc).alias(_RN), F.count(F.lit(1)).over(whole).alias(_CNT))
    # kind 0 = data row, kind 1 = the chunk's summary row (emitted once, from its last row)
    d = d.withColumn("__kind", F.explode(F.when(F.col(_RN) == F.col(_CNT), F.array(F.lit(0), F.lit(1)))
                                         .otherwise(F.array(F.lit(0)))))
    is_sum = F.col("__kind") == 1
    d = d.withColumn(_PART, F.when(is_sum, F.lit(-1)).otherwise(F.col(_CHUNK)))
    w2 = Window.partitionBy(*keys, _PART).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("__off", F.when(is_sum, fold(F.when(is_sum, F.col("__tot"))).over(w2)))
    w3 = Window.partitionBy(*keys, _CHUNK)      # only the summary row has an offset
    d = d.withColumn("__off", F.first("__off", ignorenulls=True).over(w3))
    return d.where(F.col("__kind") == 0).select(*base_cols, join(F.col("__local"), F.col("__off")).alias(out))


def with_last(df: DataFrame, keys: Sequence[str], ts: str, tiebreak, value, out: str,
              chunk_seconds: int | None | str = AUTO) -> DataFrame:
    """Add ``out`` = last non-null ``value`` up to the current row per key in (ts, tiebreak) order."""
    keys = require_keys(keys)
    chunk_seconds = resolve_chunk(df, chunk_seconds)

    def last(x: Column) -> Column:
        return F.last(x, ignorenulls=True)

    if chunk_seconds is None:
        w = Window.partitionBy(*keys).orderBy(*_order(ts, tiebreak)).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(out, last(c(value)).over(w))
    return _scan(df, keys, ts, tiebreak, value, chunk_seconds, last, F.coalesce, out)


def with_running_sum(df: DataFrame, keys: Sequence[str], ts: str, tiebreak, value, out: str,
                     chunk_seconds: int | None | str = AUTO) -> DataFrame:
    """Add ``out`` = running sum of ``value`` (inclusive of the current row) per key in (ts, tiebreak) order."""
    keys = require_keys(keys)
    order = _order(ts, tiebreak)
    chunk_seconds = resolve_chunk(df, chunk_seconds)
    if chunk_seconds is None:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(out, F.sum(c(value)).over(w))
    base_cols = df.columns
    d = df.withColumn(_CHUNK, chunk_of(ts, chunk_seconds)).withColumn("__v", c(value))
    wc = Window.partitionBy(*keys, _CHUNK).orderBy(*order)
    d = d.select("*", F.sum("__v").over(wc.rowsBetween(Window.unboundedPreceding, 0)).alias("__local"),
                 F.sum("__v").over(wc.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("__tot"),
                 F.row_number().over(wc).alias(_RN),
                 F.count(F.lit(1)).over(wc.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias(_CNT))
    # kind 0 = data row, kind 1 = the chunk's summary row (emitted once, from its last row)
    d = d.withColumn("__kind", F.explode(F.when(F.col(_RN) == F.col(_CNT), F.array(F.lit(0), F.lit(1)))
                                         .otherwise(F.array(F.lit(0)))))
    is_sum = F.col("__kind") == 1
    d = d.withColumn(_PART, F.when(is_sum, F.lit(-1)).otherwise(F.col(_CHUNK)))
    w2 = Window.partitionBy(*keys, _PART).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("__off", F.when(is_sum, F.coalesce(F.sum(F.when(is_sum, F.col("__tot"))).over(w2),
                                                        F.lit(0).cast(d.schema["__tot"].dataType))))
    w3 = Window.partitionBy(*keys, _CHUNK)
    d = d.withColumn("__off", F.max("__off").over(w3))
    return d.where(F.col("__kind") == 0).select(*base_cols, (F.col("__local") + F.col("__off")).alias(out))
