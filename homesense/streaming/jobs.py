"""Structured Streaming twins of the incremental jobs.

The reference refreshes datasets by re-reading slices (SRC8, SRC13). Here the same work runs as streams
over a landing directory with checkpoints in the shared checkpoint folder:

* T1 ``ingest_landing``: declared schema, ``source`` tag from the file name, exactly-once file sink.
* T2 ``binned_aggregates``: noon-day / 15-min / minute aggregates with a watermark; append mode emits a
  bin once the watermark has passed its end (late rows inside the delay still count).
* T3 ``stream_transitions``: transitions that span micro-batch borders; events are held back until late ones
  are in, and the last event of every key is carried over (``foreachBatch`` with the batch operator).
* T4 ``presence_sessions``: gap sessions with a per-row session gap (``session_window``).
* T5 ``dedupe_redelivered``: ``dropDuplicatesWithinWatermark`` for re-delivered rows.

Event time in the stored tables is wall-clock ``TIMESTAMP_NTZ``; watermarks need ``TIMESTAMP``, so the
microseconds are reinterpreted as an instant (no session-zone dependence) and window bounds are turned
back into NTZ on output.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from homesense.functions.time import epoch_micros, from_epoch_micros
from homesense.operators.sequences import transitions


def event_time(ts) -> Column:
    """NTZ wall time -> TIMESTAMP with the same microseconds (for watermarks and windows)."""
    return F.timestamp_micros(epoch_micros(ts))


def wall_time(instant) -> Column:
    """Inverse of :func:`event_time`."""
    return from_epoch_micros(F.unix_micros(instant))


# ---------------------------------------------------------------- T1


def read_landing(spark: SparkSession, landing: str, schema: T.StructType, fmt: str = "parquet",
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of a landing directory with a declared schema; ``source`` = file name stem."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "csv":
        r = r.option("header", True)
    d = r.load(landing)
    return d.withColumn("source", F.regexp_extract(F.input_file_name(), r"([^/]+?)(\.[a-z0-9.]+)?$", 1))


def ingest_landing(spark: SparkSession, landing: str, schema: T.StructType, out: str, checkpoint: str,
                   fmt: str = "parquet", available_now: bool = True,
                   max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Landing files -> parquet table, exactly once (file sink + checkpoint)."""
    d = read_landing(spark, landing, schema, fmt, max_files_per_trigger)
    w = d.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


# ---------------------------------------------------------------- T2


def binned_aggregates(stream: DataFrame, keys: Sequence[str], ts: str, every: str, aggs: Mapping[str, Column],
                      delay: str = "1 hour", offset: str | None = None) -> DataFrame:
    """Per key and time bin aggregates with a watermark (append mode emits closed bins).

    ``every`` / ``offset`` are interval strings ('1 day' and '12 hours' give noon-day bins).
    """
    d = stream.withColumn("__et", event_time(ts)).withWatermark("__et", delay)
    win = F.window("__et", every, every, offset) if offset else F.window("__et", every)
    g = d.groupBy(*keys, win.alias("__w")).agg(*[c.alias(n) for n, c in aggs.items()])
    return g.select(*keys, wall_time(F.col("__w.start")).alias("start_date"), *aggs.keys())


# ---------------------------------------------------------------- T3


def stream_transitions(stream: DataFrame, keys: Sequence[str], ts: str, value: str, tiebreak: str, out: str,
                       state: str, checkpoint: str, delay: str = "1 hour", available_now: bool = True) -> StreamingQuery:
    """Transitions (as WN1) over a stream, in event order even if events arrive late.

    Each micro-batch joins the events held back so far, moves the bound (newest event time less ``delay``)
    and pairs all events up to the bound with the batch operator; the last one of every key is carried over.
    Pairs go to ``out/batch=<id>``, what is carried to ``state/batch=<id>``; both are rewritten when a batch is
    repeated, so every pair is written once. Events older than the bound when they arrive can't be placed
    any more; they are kept in ``state/late`` and not lost silently. ``pending_transitions`` pairs what is
    still held back.
    """
    keys = list(keys)
    spark = stream.sparkSession
    cols = stream.select(*keys, F.col(ts).alias("__ts"), F.col(tiebreak).cast("long").alias("__tb"),
                         F.col(value).cast("string").alias("__v"))

    def step(batch: DataFrame, batch_id: int) -> None:
        held = _held(spark, state, batch_id, cols.schema)
        bound = held.agg(F.max("__bound")).first()[0]
        new = batch.where(F.col("__ts").isNotNull()).withColumn("__last", F.lit(False))
        if bound is not None:
            new.where(F.col("__ts") <= F.lit(bound)).drop("__last") \
                .write.mode("overwrite").parquet(f"{state}/late/batch={batch_id}")
            new = new.where(F.col("__ts") > F.lit(bound))
        newest = new.agg(F.max(F.col("__ts") - F.expr(f"INTERVAL {delay}"))).first()[0]
        bound = max((b for b in (bound, newest) if b is not None), default=None)
        rows = held.drop("__bound").unionByName(new)
        ready = F.col("__last") | (F.col("__ts") <= F.lit(bound).cast("timestamp_ntz"))
        _paired(rows.where(ready), keys).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        others = ["__ts", "__tb", "__v"]
        last = rows.where(ready).groupBy(*keys).agg(F.max_by(F.struct(*others), F.struct("__ts", "__tb")).alias("__r")) \
            .select(*keys, *[F.col(f"__r.{c}").alias(c) for c in others], F.lit(True).alias("__last"))
        last.unionByName(rows.where(~F.coalesce(ready, F.lit(False)))) \
            .withColumn("__bound", F.lit(bound).cast("timestamp_ntz")) \
            .write.mode("overwrite").parquet(f"{state}/batch={batch_id}")

    w = cols.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w).start()


def _held(spark: SparkSession, state: str, batch_id: int, schema: T.StructType) -> DataFrame:
    """What the batch before carried over."""
    full = T.StructType([*schema.fields, T.StructField("__last", T.BooleanType()), T.StructField("__bound", T.TimestampNTZType())])
    if batch_id == 0:
        return spark.createDataFrame([], full)
    return spark.read.schema(full).parquet(f"{state}/batch={batch_id - 1}")


def _paired(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return transitions(rows.select(*keys, "__ts", "__tb", "__v"), list(keys), "__ts", "__v", tiebreak="__tb")


def pending_transitions(spark: SparkSession, state: str, batch_id: int, keys: Sequence[str]) -> DataFrame:
    """The transitions among the events that the given micro-batch still held back."""
    return _paired(spark.read.parquet(f"{state}/batch={batch_id}"), keys)


class _Pairing(StatefulProcessor):
    """Events of a key are held until the watermark has passed them, then paired in event order; an event-time timer for
    each held time wakes the key, another removes its last event after ``lifetime``."""

    def __init__(self, lifetime_ms: int):
        self.lifetime_ms = lifetime_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", "us long, tb long, v string")
        self.last = handle.getValueState("last", "us long, tb long, v string")

    def handleInputRows(self, key, rows, timerValues):
        bound = timerValues.getCurrentWatermarkInMs() * 1000
        late, times = [], set()
        for pdf in rows:        # the columns come without names
            for us, tb, v in zip(pdf.iloc[:, -3], pdf.iloc[:, -2], pdf.iloc[:, -1]):
                us, tb, v = int(us), None if pd.isna(tb) else int(tb), None if pd.isna(v) else v
                if us < bound:
                    late.append((us, v))
                else:
                    self.held.appendValue((us, tb, v))
                    times.add(us // 1000 + 1)
        for ms in times:
            self.handle.registerTimer(ms)
        yield _events(key, [(us, None, v, None) for us, v in late], "late")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        bound = timerValues.getCurrentWatermarkInMs() * 1000
        held = [tuple(r) for r in self.held.get()]
        ready = sorted((r for r in held if r[0] < bound), key=lambda r: (r[0], r[1] is not None, r[1] or 0))
        last = tuple(self.last.get()) if self.last.exists() else None
        pairs = []
        for r in ready:
            if last:
                pairs.append((last[0], r[0], last[2], r[2]))
            last = r
        if ready:
            rest = [r for r in held if r[0] >= bound]
            self.held.put(rest) if rest else self.held.clear()
            self.last.update(last)
            self.handle.registerTimer(last[0] // 1000 + 1 + self.lifetime_ms)
        elif last and not held and bound >= last[0] + self.lifetime_ms * 1000:
            self.last.clear()
        yield _events(key, pairs, "pair")

    def close(self) -> None:
        pass


def _events(key, rows: list[tuple], kind: str) -> pd.DataFrame:
    text = {f"k{i}": [str(x)] * len(rows) for i, x in enumerate(key)}
    out = pd.DataFrame({n: pd.Series(x, dtype=object) for n, x in text.items()})
    for n, c in enumerate(("us", "next_us", "v", "next_v")):
        out[c] = pd.Series([r[n] for r in rows], dtype="Int64" if c.endswith("us") else object)
    out["kind"] = pd.Series([kind] * len(rows), dtype=object)
    return out


def keyed_transitions(stream: DataFrame, keys: Sequence[str], ts: str, value: str, tiebreak: str, delay: str = "1 hour",
                      lifetime_seconds: int = 30 * 86_400) -> DataFrame:
    """T3 with keyed state: transitions (as WN1) of a stream, in event order, as a streaming DataFrame.

    Held events and the last event of every key live in the state store (``spark.sql.streaming.stateStore.providerClass`` must be
    the RocksDB one), so a micro-batch is read once and nothing but the store's own files is kept. An event is paired
    when the watermark (newest event time less ``delay``) has passed it; ``kind`` is ``pair``, or ``late`` for an event
    that arrived behind the watermark and can't be placed any more (only start_date and source are set). A key's last
    event is forgotten ``lifetime_seconds`` of event time after it. Rows with a null key or time are left out.
    """
    keys = list(keys)
    d = stream.where(F.col(ts).isNotNull())
    for k in keys:
        d = d.where(F.col(k).isNotNull())
    d = d.select(*keys, event_time(ts).alias("__et"), F.col(tiebreak).cast("long").alias("__tb"), F.col(value).cast("string").alias("__v"))
    # the copy of the time carries no watermark: the store's operator must see late events, not drop them
    d = d.withWatermark("__et", delay).select(*[F.col(k).cast("string").alias(k) for k in keys], F.unix_micros("__et").alias("__us"), "__tb", "__v")
    names = [f"k{i}" for i in range(len(keys))]
    schema = ", ".join(f"{n} string" for n in names) + ", us long, next_us long, v string, next_v string, kind string"
    out = d.groupBy(*keys).transformWithStateInPandas(_Pairing(lifetime_seconds * 1000), schema, "Append", "EventTime")
    source, sink = (F.coalesce(c, F.lit("nan")) for c in ("v", "next_v"))
    pair = F.col("kind") == "pair"
    return out.select(*[F.col(n).cast(stream.schema[k].dataType).alias(k) for n, k in zip(names, keys)],
                      from_epoch_micros(F.col("us")).alias("start_date"), from_epoch_micros(F.col("next_us")).alias("end_date"),
                      source.alias("source"), F.when(pair, sink).alias("sink"),
                      F.when(pair, F.concat(source, F.lit(">"), sink)).alias("transition"),
                      ((F.col("next_us") - F.col("us")) / 1e6).alias("dur"), "kind")


# ---------------------------------------------------------------- T4 / T5


def presence_sessions(stream: DataFrame, keys: Sequence[str], start: str, end: str, gap_seconds: float = 3600,
                      delay: str = "2 hours") -> DataFrame:
    """T4: sessions of intervals whose next start is less than ``gap`` after the session's end so far.

    Each row opens a session window [start, end + gap); overlapping windows merge. Equal to WN5 on
    non-overlapping intervals (bed stays) except when a gap equals ``gap`` exactly (WN5 keeps it in the
    same session, the stream splits).
    """
    d = stream.withColumn("__s", event_time(start)).withColumn("__e", event_time(end)).withWatermark("__s", delay)
    # per-row gap = the interval's own length + ``gap``, so the window ends ``gap_seconds`` after the interval ends
    secs = ((F.unix_micros("__e") - F.unix_micros("__s")) / 1e6 + F.lit(float(gap_seconds))).cast("decimal(18,6)")
    row_gap = F.make_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(0), F.lit(0), F.lit(0), secs)
    g = d.groupBy(*keys, F.session_window("__s", row_gap).alias("__w"))
    g = g.agg(F.count(F.lit(1)).alias("n"), F.min("__s").alias("__first"), F.max("__e").alias("__last"))
    return g.select(*keys, wall_time("__first").alias("start_date"), wall_time("__last").alias("end_date"), "n")


def dedupe_redelivered(stream: DataFrame, ts: str, subset: Sequence[str], delay: str = "1 hour") -> DataFrame:
    """T5: drop rows re-delivered within the watermark delay (same ``subset`` values)."""
    d = stream.withColumn("__et", event_time(ts)).withWatermark("__et", delay)
    return d.dropDuplicatesWithinWatermark(list(subset)).drop("__et")
