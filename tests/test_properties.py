"""Property tests: chunked and single-window forms agree; sparse presence edges equal the dense
resample + diff; results do not depend on the input partitioning."""

import datetime as dt
import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from homesense.operators import ordered
from homesense.operators import segments as sg
from homesense.operators import sequences as seq


def _random_events(spark, n=3000, seed=7, hot=True):
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        p = 0 if (hot and rnd.random() < 0.4) else rnd.randint(1, 12)  # one hot key with ~40% of rows
        t = base + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 6))  # minute grain: ties happen
        rows.append((p, t, rnd.choice("ABCD"), i, rnd.random()))
    return spark.createDataFrame(rows, "p long, t timestamp_ntz, v string, tb long, x double")


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_shifts_chunked_equal_single_window(spark):
    df = _random_events(spark)
    shifts = {"n1": ("v", 1), "n3": ("v", 3), "p1": ("t", -1), "p2": ("x", -2)}
    a = ordered.with_shifts(df, ["p"], "t", "tb", shifts, None)
    for chunk in (3600, 86400, 7 * 86400):
        b = ordered.with_shifts(df, ["p"], "t", "tb", shifts, chunk)
        assert _rows(a) == _rows(b)


def test_running_sum_chunked_equal_single_window(spark):
    df = _random_events(spark).withColumn("one", F.lit(1))
    a = ordered.with_running_sum(df, ["p"], "t", "tb", "one", "rs", None)
    for chunk in (3600, 86400):
        b = ordered.with_running_sum(df, ["p"], "t", "tb", "one", "rs", chunk)
        assert _rows(a) == _rows(b)


def test_session_conf_switch(spark):
    df = _random_events(spark, 500)
    spark.conf.set(ordered.CHUNK_CONF, "0")
    try:
        a = seq.transitions(df, ["p"], "t", "v", tiebreak="tb")
        assert "__chunk" not in a._jdf.queryExecution().analyzed().toString()
    finally:
        spark.conf.unset(ordered.CHUNK_CONF)
    b = seq.transitions(df, ["p"], "t", "v", tiebreak="tb")
    assert _rows(a) == _rows(b)


def test_transition_count_is_rows_minus_groups(spark):
    df = _random_events(spark)
    n, g = df.count(), df.select("p").distinct().count()
    assert seq.transitions(df, ["p"], "t", "v", tiebreak="tb").count() == n - g


def _dense_edges(pdf):
    out = []
    for p, g in pdf.groupby("p"):
        m = g["t"].dt.floor("min").value_counts().sort_index()
        grid = pd.date_range(m.index.min(), m.index.max(), freq="1min")
        c = m.reindex(grid, fill_value=0)
        d = c.diff().fillna(1)
        for t, v in d.items():
            if v == 1:
                out.append((p, t.to_pydatetime(), "Bed_in"))
            elif v == -1:
                out.append((p, t.to_pydatetime(), "Bed_out"))
    return sorted(out)


def test_presence_edges_sparse_equals_dense(spark):
    rnd = random.Random(3)
    base = dt.datetime(2024, 1, 1, 21)
    rows = [(rnd.randint(1, 3), base + dt.timedelta(minutes=rnd.randint(0, 600), seconds=rnd.randint(0, 59)))
            for _ in range(900)]
    df = spark.createDataFrame(rows, "p long, t timestamp_ntz")
    want = _dense_edges(pd.DataFrame(rows, columns=["p", "t"]))
    for chunk in (None, 3600):
        got = sorted(tuple(r) for r in sg.presence_edges(df, ["p"], "t", chunk).collect())
        assert got == want


def test_partitioning_invariance(spark):
    df = _random_events(spark)
    a = seq.mine_transition(df.select("p", "t", "v", "tb"), ["p"], "v", "t", 2, "tb")
    b = seq.mine_transition(df.select("p", "t", "v", "tb").repartition(13, "v"), ["p"], "v", "t", 2, "tb")
    assert _rows(a) == _rows(b)


def test_rolling_zscore_matches_pandas(spark):
    from homesense.operators.stats import rolling_zscore
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=40)
    x[[3, 10, 11]] = np.nan
    days = pd.date_range("2024-01-01", periods=40, freq="D")
    pdf = pd.DataFrame({"p": 1, "d": days, "x": x})
    df = spark.createDataFrame(pdf)
    got = rolling_zscore(df, ["p"], "d", "x", 14).orderBy("d").toPandas()["x_z"].to_numpy(dtype=float)
    s = pdf.dropna(subset="x")["x"]
    want = ((s - s.rolling(14, min_periods=1).mean()) / s.rolling(14, min_periods=1).std()).reindex(pdf.index)
    np.testing.assert_allclose(got, want.to_numpy(dtype=float), rtol=1e-9, atol=1e-12, equal_nan=True)


def test_presence_edges_one_row_per_minute_flag(spark):
    from homesense.plans.recipes.sleep import process_sleep
    rnd = random.Random(5)
    base = dt.datetime(2024, 1, 1, 21)
    rows = [("h", str(rnd.randint(1, 3)), base + dt.timedelta(minutes=rnd.randint(0, 400)), "DEEP", 60.0, 14.0, "false")
            for _ in range(700)]
    mat = spark.createDataFrame(rows, "home_id string, patient_id string, start_date timestamp_ntz, state string, "
                                      "heart_rate double, respiratory_rate double, snoring string")
    sleep = process_sleep(mat)
    a = sg.presence_edges(sleep, ["patient_id"], "start_date")
    b = sg.presence_edges(sleep, ["patient_id"], "start_date", one_row_per_minute=True)
    assert _rows(a) == _rows(b)


def _minute_rows(spark, seed, keys=4, nights=6):
    """Stays of random length with random gaps, some across midnight; states, nulls and a hot key; a key with one stay."""
    rnd = random.Random(seed)
    rows = []
    for k in range(keys):
        t = dt.datetime(2024, 1, 1, 20)
        for _ in range(nights * (10 if k == 0 else 4)):
            for _ in range(rnd.randint(1, 90)):
                rows.append((k, t, rnd.choice(["AWAKE", "DEEP", "REM", "LIGHT", None]), rnd.choice([55.0, 61.5, None]),
                             rnd.choice([12.0, 15.25]), rnd.random() < 0.2))
                t += dt.timedelta(minutes=1)
            t += dt.timedelta(minutes=rnd.choice([1, 2, 30, 59, 60, 61, 200, 700]))
    rows += [(90, dt.datetime(2024, 1, 1, 23, 50) + dt.timedelta(minutes=i), "DEEP", 60.0, 14.0, False) for i in range(30)]
    rows += [(None, dt.datetime(2024, 1, 1), "DEEP", 60.0, 14.0, False), (1, None, "DEEP", 60.0, 14.0, False)]
    rnd.shuffle(rows)
    return spark.createDataFrame(rows, "p long, start_date timestamp_ntz, state string, heart_rate double, "
                                       "respiratory_rate double, snoring boolean")


def test_minute_periods_equal_the_operators_one_by_one(spark):
    for seed, gap in ((1, 3600), (2, 0)):
        sleep = _minute_rows(spark, seed)
        edges = sg.presence_edges(sleep, ["p"], "start_date", one_row_per_minute=True)
        tr = seq.mine_transition(edges.select("p", "start_date", "location_name"), ["p"], "location_name", "start_date", 1)
        bed_in = sg.gap_sessions(tr.where(F.col("transition") == "Bed_in>Bed_out"), ["p"], gap_seconds=gap)
        marked = sg.mark_periods(sleep, sg.bed_habits(bed_in, ["p"]), ["p"], carry=sg.HABIT_COLS)
        periods = sg.sleep_periods(marked, None, ["p"])
        want = _rows(periods)
        assert len(want) > 5 and want[0]
        for chunk in (None, 3600):
            got = sg.minute_periods(sleep, ["p"], gap_seconds=gap, chunk_seconds=chunk)
            assert got.columns == periods.columns and _rows(got) == want
    plain, fused = (sg.sleep_dailies(sleep, e, ["p"], gap) for e in (edges, None))
    assert plain.columns == fused.columns and _rows(plain) == _rows(fused)
    assert sg.minute_periods(sleep.limit(0), ["p"]).count() == 0


def test_sleep_dailies_plan_is_short(spark):
    from homesense.plans import q_segments
    plan = q_segments.sleep_dailies(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert sum("Exchange" in line for line in plan.splitlines()) <= 6
