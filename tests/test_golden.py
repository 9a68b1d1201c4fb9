"""Golden cases (FIXTURES section 3) for single operators."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from homesense.functions import scalars as sc
from homesense.functions import time as tf
from homesense.operators import resample as rs
from homesense.operators import segments as sg
from homesense.operators import sequences as seq
from homesense.operators import stats as st

D = dt.datetime


def _ts_frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_date_iso(spark):
    df = spark.createDataFrame([("2021-06-09",), ("2021-06-09 08:10",)], "t string")
    got = [r[0] for r in df.select(tf.iso_from_text("t")).collect()]
    assert got == ["2021-06-09T00:00:00.000000Z", "2021-06-09T08:10:00.000000Z"]


def test_round_quarter(spark):
    df = spark.createDataFrame([(x,) for x in [1.3, 2.6, 3.0, 4.1, 0.125, 0.375]], "x double")
    got = [r[0] for r in df.select(sc.round_quarter("x")).collect()]
    assert got == [1.25, 2.5, 3.0, 4.0, 0.0, 0.5]


def test_round_half_and_np_round(spark):
    df = spark.createDataFrame([(0.25,), (0.75,), (36.855,)], "x double")
    got = df.select(sc.round_half("x").alias("h"), sc.np_round("x", 2).alias("r")).collect()
    assert [r.h for r in got] == [0.0, 1.0, 37.0]
    assert [r.r for r in got] == [round(0.25, 2), round(0.75, 2), 36.85]  # NumPy / Python agree here


def _seq_frame(spark, values):
    base = D(2024, 1, 1, 10, 0)
    rows = [(1, base + dt.timedelta(minutes=i), str(v), i) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "p long, t timestamp_ntz, v string, tb long")


def test_ngrams(spark):
    df = _seq_frame(spark, [1, 2, 3, 4, 5])
    for chunk in (None, 86400, 60):
        got = [r.ngram for r in seq.ngrams(df, ["p"], "t", "v", 3, "tb", chunk).orderBy("start_date").collect()]
        assert got == ["1>2>3", "2>3>4", "3>4>5"]


def test_lag_matrix_naming(spark):
    df = _seq_frame(spark, [0, 1, 2, 3, 4]).withColumn("x", F.col("v").cast("int"))
    for chunk in (None, 60):
        rows = seq.lag_matrix(df, ["p"], "t", "x", 3, "tb", chunk).orderBy("t").collect()
        assert [r["t(-2)"] for r in rows] == [2, 3, 4]
        assert [r["t(-1)"] for r in rows] == [1, 2, 3]
        assert [r["t(-0)"] for r in rows] == [0, 1, 2]


def test_transitions_golden(spark):
    rows = [("p1", D(2024, 1, 1, 10, 0), "A"), ("p1", D(2024, 1, 1, 10, 5), "B"), ("p1", D(2024, 1, 1, 10, 6), "A"),
            ("p2", D(2024, 1, 1, 10, 0), "A"), (None, D(2024, 1, 1, 10, 0), "A"), (None, D(2024, 1, 1, 11, 0), "B")]
    df = spark.createDataFrame(rows, "p string, t timestamp_ntz, v string")
    for chunk in (None, 86400, 240):
        out = seq.transitions(df, ["p"], "t", "v", chunk_seconds=chunk).orderBy("start_date").collect()
        assert [(r.transition, r.dur) for r in out] == [("A>B", 300.0), ("B>A", 60.0)]


def test_between_time(spark):
    times = ["12:00:00", "12:00:01", "17:59:59", "18:00:00", "00:00:00"]
    df = spark.createDataFrame([(D.fromisoformat(f"2024-01-01 {t}"),) for t in times], "t timestamp_ntz")
    got = [r.t.strftime("%H:%M:%S") for r in df.where(tf.between_time("t", "18:00", "12:00")).collect()]
    assert sorted(got) == sorted(["12:00:00", "18:00:00", "00:00:00"])


def test_iqr_labels(spark):
    df = spark.createDataFrame([(float(x),) for x in [0, 1, 2, 3, 4, 5, 6, 30]], "x double")
    out = st.iqr_labels(df, "x").orderBy("x").collect()
    assert [r.outcome_full for r in out] == ["OOB", "Low TIB", "Normal TIB", "Normal TIB", "Normal TIB",
                                             "Normal TIB", "High TIB", "Extremely high"]
    assert out[-1].global_outcome is None


def test_localize_london(spark):
    texts = ["2021-10-31 00:30", "2021-10-31 01:30", "2021-10-31 02:30", "2021-03-28 00:30", "2021-03-28 01:30",
             "2021-07-01 00:00"]
    want = ["01:30", "02:30", "02:30", "00:30", "02:30", "01:00"]
    df = spark.createDataFrame([(i, D.fromisoformat(t)) for i, t in enumerate(texts)], "i int, t timestamp_ntz")
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        got = [r.l.strftime("%H:%M") for r in df.select("i", tf.localize("t").alias("l")).orderBy("i").collect()]
        assert got == want
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_noon_and_week_bins(spark):
    df = spark.createDataFrame([(D(2024, 1, 1, 11, 59),), (D(2024, 1, 1, 12, 0),)], "t timestamp_ntz")
    assert [r[0] for r in df.select(tf.noon_day_bin("t")).collect()] == [D(2023, 12, 31, 12), D(2024, 1, 1, 12)]
    df = spark.createDataFrame([(D(2024, 1, 1),), (D(2024, 1, 7, 12),), (D(2024, 1, 8),)], "t timestamp_ntz")
    assert [r[0] for r in df.select(tf.week_label("t")).collect()] == [D(2024, 1, 7), D(2024, 1, 7), D(2024, 1, 14)]


def test_presence_edges_golden(spark):
    base = D(2024, 1, 1, 22, 0)
    df = spark.createDataFrame([(1, base + dt.timedelta(minutes=m)) for m in (0, 1, 2, 5)], "p long, t timestamp_ntz")
    out = sg.presence_edges(df, ["p"], "t").orderBy("start_date").collect()
    assert [((r.start_date - base).seconds // 60, r.location_name) for r in out] == \
        [(0, "Bed_in"), (3, "Bed_out"), (5, "Bed_in")]


def test_gap_sessions(spark):
    rows = [(1, D(2024, 1, 1, 22), D(2024, 1, 1, 23)), (1, D(2024, 1, 1, 23, 30), D(2024, 1, 2, 1)),
            (1, D(2024, 1, 2, 3), D(2024, 1, 2, 4))]
    df = spark.createDataFrame(rows, "p long, start_date timestamp_ntz, end_date timestamp_ntz")
    for chunk in (None, 3600):
        out = sg.gap_sessions(df, ["p"], chunk_seconds=chunk).orderBy("start_date").collect()
        assert [r.period_segments for r in out] == [0, 0, 1]


def test_angles(spark):
    df = spark.createDataFrame([(D(2024, 1, 1, 0, 0),), (D(2024, 1, 1, 6, 0),), (D(2024, 1, 1, 18, 30),)],
                               "t timestamp_ntz")
    assert [r[0] for r in df.select(tf.time_angle("t")).collect()] == [0.0, 90.0, 277.5]
    a = spark.createDataFrame([(277.5,), (None,)], "a double").select(tf.angle_to_hms_text("a")).collect()
    assert [r[0] for r in a] == ["18:30:00", None]


def test_circular_moments(spark):
    df = spark.createDataFrame([(1, 350.0), (1, 10.0), (2, 90.0), (2, 90.0)], "g int, a double")
    out = {r.g: r for r in df.groupBy("g").agg(st.circular_mean("a").alias("m"), st.circular_std("a").alias("s")).collect()}
    assert min(abs(out[1].m), abs(out[1].m - 360)) < 1e-9
    assert abs(out[2].s) < 1e-6


def test_map_replace_vs_strict(spark):
    df = spark.createDataFrame([("a",), ("b",), ("z",)], "x string")
    got = df.select(sc.map_replace("x", {"a": "A", "b": None}).alias("r"),
                    sc.map_strict("x", {"a": "A", "b": "B"}).alias("s")).collect()
    assert [(r.r, r.s) for r in got] == [("A", "A"), (None, "B"), ("z", None)]


def test_last_sunday(spark):
    df = spark.createDataFrame([(2021, 10), (2021, 3), (2022, 7)], "y int, m int")
    assert [r[0].day for r in df.select(tf.last_sunday("y", "m")).collect()] == [31, 28, 31]


def test_not_in_keeps_null(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",)], "x string")
    assert df.where(sc.not_in_keep_null("x", ["a"])).count() == 2


def test_densify_counts_and_means(spark):
    rows = [(1, D(2024, 1, 1, 13), 2.0), (1, D(2024, 1, 4, 13), 4.0)]
    df = spark.createDataFrame(rows, "p long, t timestamp_ntz, v double")
    out = rs.resample(df, ["p"], "t", 86400, {"n": F.count(F.lit(1)), "m": F.avg("v")}, 12 * 3600,
                      zero_fill=["n"]).orderBy("start_date").collect()
    assert [r.n for r in out] == [1, 0, 0, 1]
    assert [r.m for r in out] == [2.0, None, None, 4.0]


def test_segment_summary_shift(spark):
    seg = spark.createDataFrame([(1, 1, 180.0, 3), (1, 1, 180.25, 1), (1, 2, 0.0, 4)],
                                "k int, labels long, bin double, freq long")
    out = {r.labels: r for r in st.segment_summary(seg, ["k"]).collect()}
    assert out[1].start == "00:00:00" and out[1].end == "00:01:00" and out[1].freq_sum == 4
    assert out[2].start == "12:00:00" and abs(out[2].proportion - 0.5) < 1e-12


def test_circular_kinds(spark):
    import datetime as dt
    from homesense.operators import stats as st
    d = spark.createDataFrame([(350.0,), (10.0,), (30.0,)], "a double")
    r = d.agg(*[f("a", k).alias(f"{n}_{k}") for n, f in (("m", st.circular_mean), ("s", st.circular_std)) for k in st.KINDS]).first()
    assert abs(r.m_angles - 10.0) < 1e-9 and r.m_time in ("00:39:59", "00:40:00")     # cut to whole seconds
    assert r.m_time == str(r.m_datetime.time()) and abs(r.m_timedelta.total_seconds() - 2400) < 1e-3
    assert r.s_time == str(r.s_datetime.time()) and abs(r.s_timedelta.total_seconds() - r.s_angles * 240) < 1e-3


def test_localize_zone_list(spark):
    import datetime as dt
    import pytest
    from homesense.functions.time import localize_zones
    t = dt.datetime(2021, 7, 1, 12)
    d = spark.createDataFrame([(1, t, "Europe/London"), (2, t, "America/New_York"), (3, t, "Asia/Tokyo")],
                              "k int, t timestamp_ntz, timezone string")
    got = {r.k: r.t.hour for r in localize_zones(d, ["t"], ["Europe/London", "America/New_York"]).collect()}
    assert got == {1: 13, 2: 8}
    assert {r.timezone for r in localize_zones(d, ["t"]).collect()} == {"Europe/London"}
    with pytest.raises(ValueError):
        localize_zones(d, ["t"], ["Mars/Base"])


def test_iqr_label_ranks(spark):
    from homesense.operators import stats as st
    d = spark.createDataFrame([(float(x),) for x in [0, 5, 6, 7, 8, 9, 30]], "x double")
    got = {r.x: (r.outcome_full, r.rank) for r in st.iqr_labels(d, "x", rank_out="rank").collect()}
    assert got[0.0] == ("OOB", 0) and got[30.0] == ("Extremely high", 5)
    assert [got[x][1] for x in (5.0, 7.0, 9.0)] == sorted(got[x][1] for x in (5.0, 7.0, 9.0))


def test_pin_rows_order(spark):
    from homesense.operators.lookups import pin_rows
    d = spark.createDataFrame([("b", 2), ("a", 1), ("x", 9), ("c", 3)], "k string, n int")
    assert [r.k for r in pin_rows(d, "k", "x", ["n"]).collect()] == ["x", "a", "b", "c"]
    assert [r.k for r in pin_rows(d, "k", "a", ["n"], top=False).collect()] == ["b", "c", "x", "a"]
