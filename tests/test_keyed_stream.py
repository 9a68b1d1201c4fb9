"""Transitions of a stream with keyed state."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from homesense.operators import sequences as seq
from homesense.streaming import jobs

EVENTS = "/root/testdata/sf0.001/events.parquet"
COLS = ["user_id", "start_date", "end_date", "source", "sink", "transition", "dur"]
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@pytest.fixture()
def rocks(spark):
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    spark.conf.set("spark.sql.shuffle.partitions", 2)
    yield
    spark.conf.set(PROVIDER, before)
    spark.conf.set("spark.sql.shuffle.partitions", 8)


def landed(spark, folder, batches, schema):
    """One file per micro-batch, in order; a last one far ahead moves the watermark past all others."""
    for k, rows in enumerate(batches):
        part = os.path.join(folder, f"b{k}")
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(part)
        name = next(f for f in os.listdir(part) if f.endswith(".parquet"))
        os.makedirs(os.path.join(folder, "in"), exist_ok=True)
        os.link(os.path.join(part, name), os.path.join(folder, "in", f"{k}.parquet"))
        os.utime(os.path.join(folder, "in", f"{k}.parquet"), (time.time() - 1000 + 10 * k,) * 2)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(folder, "in"))


def run(spark, stream, folder):
    out = os.path.join(folder, "out")
    q = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", os.path.join(folder, "ck")) \
        .outputMode("append").trigger(availableNow=True).start()
    assert q.awaitTermination(150) and q.exception() is None
    return spark.read.parquet(out)


def test_late_events_are_placed_and_too_late_ones_told(spark, scratch, rocks):
    schema = "event_id long, user_id long, ts timestamp_ntz, event_type string"
    hours = [[(1, 10, "a"), (3, 12, "c")], [(2, 11, "b"), (4, 13, None)], [(6, 20, "f")], [(5, 12, "e"), (7, 21, "g")], [(9, 500, "z")], [(10, 501, "z")]]
    batches = [[(i, 1, dt.datetime(2024, 1, 1) + dt.timedelta(hours=h), v) for i, h, v in b] for b in hours]
    batches[0] += [(100, None, dt.datetime(2024, 1, 1), "x"), (101, 2, None, "y")]
    s = landed(spark, scratch, batches, schema)
    got = run(spark, jobs.keyed_transitions(s, ["user_id"], "ts", "event_type", "event_id", "3 hours"), scratch).collect()
    pairs = sorted((r.start_date, r.transition, r.dur) for r in got if r.kind == "pair")
    assert [p[1] for p in pairs][:5] == ["a>b", "b>c", "c>nan", "nan>f", "f>g"] and pairs[0][2] == 3600.0
    late = [r for r in got if r.kind == "late"]
    assert [(r.source, r.start_date.hour, r.sink) for r in late] == [("e", 12, None)]
    assert set(os.listdir(scratch)) <= {"in", "out", "ck", *(f"b{k}" for k in range(6))}      # no folder of held rows


def test_keyed_transitions_equal_batch(spark, scratch, rocks):
    ev = spark.read.parquet(EVENTS).select("event_id", "user_id", "ts", "event_type")
    rows = [tuple(r) for r in ev.orderBy("ts", "event_id").collect()]
    cut = len(rows) // 3
    end = [(10 ** 9 + k, None, dt.datetime(2035, 1, 1) + dt.timedelta(days=k), "end") for k in range(2)]
    batches = [rows[:cut], rows[cut:2 * cut], rows[2 * cut:] + [(0, 10 ** 6, end[0][2], "end")], [(1, 10 ** 6, end[1][2], "end")]]
    s = landed(spark, scratch, batches, ev.schema)
    got = run(spark, jobs.keyed_transitions(s, ["user_id"], "ts", "event_type", "event_id", "1 hour", 10 ** 9), scratch)
    assert got.where("kind = 'late'").count() == 0
    want = seq.transitions(ev, ["user_id"], "ts", "event_type", tiebreak="event_id").select(*COLS)
    key = lambda df: sorted(tuple(r) for r in df.select(*COLS).collect())
    assert key(got.where(F.col("user_id") != 10 ** 6)) == key(want)
