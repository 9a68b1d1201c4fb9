"""Streaming twins equal their batch counterparts (landing files replayed one per micro-batch)."""

import os

import pytest
from pyspark.sql import functions as F

from homesense.operators import sequences as seq
from homesense.operators import segments as sg
from homesense.operators import resample as rs
from homesense.streaming import jobs

EVENTS = "/root/testdata/sf0.001/events.parquet"


@pytest.fixture(scope="module")
def landing(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("landing"))
    ev = spark.read.parquet(EVENTS)
    days = [("2024-01-01", "2024-01-06"), ("2024-01-06", "2024-01-11"), ("2024-01-11", "2024-01-16"),
            ("2024-01-16", "2024-01-21"), ("2024-01-21", "2024-01-26"), ("2024-01-26", "2024-02-01")]
    for i, (a, b) in enumerate(days):
        part = ev.where((F.col("ts") >= F.lit(a).cast("timestamp_ntz")) & (F.col("ts") < F.lit(b).cast("timestamp_ntz")))
        part.coalesce(1).write.parquet(os.path.join(root, f"batch{i}"))
        # move the single file up so the landing folder holds plain files in time order
        d = os.path.join(root, f"batch{i}")
        f = [x for x in os.listdir(d) if x.endswith(".parquet")][0]
        os.link(os.path.join(d, f), os.path.join(root, f"events_{i:02d}.parquet"))
    return root, ev.schema


def _run(df, name, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.table(name)


def _stream(spark, landing):
    root, schema = landing
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("pathGlobFilter", "*.parquet") \
        .parquet(root)


def test_ingest_exactly_once(spark, landing, scratch):
    root, schema = landing
    q = jobs.ingest_landing(spark, root, schema, os.path.join(scratch, "out"), os.path.join(scratch, "ck"),
                            max_files_per_trigger=2)
    q.awaitTermination()
    q = jobs.ingest_landing(spark, root, schema, os.path.join(scratch, "out"), os.path.join(scratch, "ck"))
    q.awaitTermination()  # second run: nothing new, nothing duplicated
    out = spark.read.parquet(os.path.join(scratch, "out"))
    assert out.count() == spark.read.parquet(EVENTS).count()
    assert out.select("source").distinct().count() == 6


def _transitions_job(spark, stream, scratch, delay):
    out, state, ck = (os.path.join(scratch, x) for x in ("t3-out", "t3-state", "t3-ck"))
    q = jobs.stream_transitions(stream, ["user_id"], "ts", "event_type", "event_id", out, state, ck, delay)
    q.awaitTermination(300)
    assert q.exception() is None
    last = max(int(d.split("=")[1]) for d in os.listdir(state) if d.startswith("batch="))
    cols = ["user_id", "start_date", "end_date", "source", "sink", "transition", "dur"]
    got = spark.read.parquet(out).select(*cols).union(jobs.pending_transitions(spark, state, last, ["user_id"]).select(*cols))
    late = os.path.join(state, "late")
    n_late = spark.read.parquet(late).count() if os.path.isdir(late) else 0
    return sorted(tuple(r) for r in got.collect()), n_late


def test_stream_transitions_equal_batch(spark, landing, scratch):
    got, late = _transitions_job(spark, _stream(spark, landing), scratch, "1 hour")
    want = seq.transitions(spark.read.parquet(EVENTS), ["user_id"], "ts", "event_type", tiebreak="event_id")
    assert late == 0
    assert got == sorted(tuple(r) for r in want.select("user_id", "start_date", "end_date", "source", "sink", "transition",
                                                       "dur").collect())


def test_stream_transitions_place_late_events(spark, scratch):
    import datetime as dt
    p = os.path.join(scratch, "late-landing")
    rows = [[(1, 10, "a"), (3, 12, "c")], [(2, 11, "b"), (4, 13, "d")], [(6, 20, "f")], [(5, 12, "e"), (7, 21, "g")]]
    schema = "event_id long, user_id long, ts timestamp_ntz, event_type string"
    for k, batch in enumerate(rows):
        spark.createDataFrame([(i, 1, dt.datetime(2024, 1, 1, h), v) for i, h, v in batch], schema) \
            .coalesce(1).write.mode("append").parquet(p)
    import time
    files = sorted(os.path.join(p, f) for f in os.listdir(p) if f.endswith(".parquet"))
    order = {spark.read.parquet(f).agg({"event_id": "min"}).first()[0]: f for f in files}
    for k, i in enumerate((1, 2, 6, 5)):
        os.utime(order[i], (time.time() - 1000 + 10 * k,) * 2)
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(p)
    got, late = _transitions_job(spark, s, scratch, "3 hours")
    assert [r[5] for r in got] == ["a>b", "b>c", "c>d", "d>f", "f>g"] and late == 1   # 12:00 came after the bound 17:00


def test_binned_counts_closed_windows(spark, landing):
    s = _stream(spark, landing)
    got = _run(jobs.binned_aggregates(s, ["user_id"], "ts", "1 day", {"n": F.count(F.lit(1))}, "1 hour",
                                      "12 hours"), "t2")
    want = rs.resample(spark.read.parquet(EVENTS), ["user_id"], "ts", 86400, {"n": F.count(F.lit(1))}, 12 * 3600,
                       dense=False)
    g = {(r.user_id, r.start_date): r.n for r in got.collect()}
    w = {(r.user_id, r.start_date): r.n for r in want.collect()}
    assert g and all(w[k] == v for k, v in g.items())  # every emitted (closed) bin is final and correct
    newest = max(k[1] for k in w)
    assert all(k in g for k in w if k[1] < newest.replace(hour=12) - __import__("datetime").timedelta(days=1))


def test_presence_sessions_match_gap_sessions(spark, landing, scratch):
    ev = spark.read.parquet(EVENTS)
    iv = ev.select("user_id", "event_id", F.col("ts").alias("start_date"),
                   (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(20))).alias("end_date"))
    p = os.path.join(scratch, "iv")
    iv.orderBy("start_date").coalesce(1).write.parquet(p)
    s = spark.readStream.schema(iv.schema).parquet(p)
    got = _run(jobs.presence_sessions(s, ["user_id"], "start_date", "end_date", 3 * 3600, "1 day"), "t4")
    batch = sg.gap_sessions(iv, ["user_id"], gap_seconds=3 * 3600, tiebreak="event_id")
    want = batch.groupBy("user_id", "period_segments").agg(F.min("start_date").alias("start_date"),
                                                          F.max("end_date").alias("end_date"),
                                                          F.count(F.lit(1)).alias("n"))
    g = sorted(tuple(r) for r in got.select("user_id", "start_date", "end_date", "n").collect())
    w = sorted(tuple(r) for r in want.select("user_id", "start_date", "end_date", "n").collect())
    # append mode emits a session once the watermark (newest start - delay) passes its end + gap
    import datetime as dt
    newest = max(r[1] for r in w)
    closed = {r for r in w if r[2] + dt.timedelta(hours=3) < newest - dt.timedelta(days=1)}
    assert g and set(g) <= set(w) and closed <= set(g)


def test_dedupe_redelivered(spark, landing, scratch):
    root, schema = landing
    p = os.path.join(scratch, "redelivered")
    ev = spark.read.parquet(EVENTS)
    ev.unionByName(ev.where(F.col("event_id") < 300)).orderBy("ts").coalesce(1).write.parquet(p)
    s = spark.readStream.schema(schema).parquet(p)
    got = _run(jobs.dedupe_redelivered(s, "ts", ["event_id"], "1 hour"), "t5")
    assert got.count() == ev.count()
