"""segment_freq has no SQL oracle: check it against a brute-force NumPy version on a small fixture."""

import random

import numpy as np
from pyspark.sql import functions as F

from homesense.operators import stats as st


def _savgol_order1(y, window):
    """Least-squares line per window; centre value inside, edge fits at both ends ('interp')."""
    n, h = len(y), window // 2
    out = np.empty(n)
    idx = np.arange(n)
    for i in range(h, n - h):
        out[i] = y[i - h:i + h + 1].mean()
    a = np.polyfit(idx[:window], y[:window], 1)
    b = np.polyfit(idx[n - window:], y[n - window:], 1)
    out[:h] = np.polyval(a, idx[:h])
    out[n - h:] = np.polyval(b, idx[n - h:])
    return out


def _labels(x, r):
    n = len(x)
    lab = [0] * n
    nxt = 1
    order = sorted(range(n), key=lambda i: (-x[i], i))
    for i in order:
        near = [lab[min(max(i + d, 0), n - 1)] for d in range(-r, r)]
        near = [v for v in near if v > 0]
        if not near:
            lab[i] = nxt
            nxt += 1
        else:
            counts = {}
            for v in near:
                counts[v] = counts.get(v, 0) + 1
            best = max(counts.values())
            lab[i] = min(v for v, c in counts.items() if c == best)
    return lab


def test_segment_freq_brute_force(spark):
    rnd = random.Random(11)
    vals = [(k, round(rnd.gauss(mu, 25) * 4) / 4 % 360) for k, mu in ((1, 90.0), (2, 270.0)) for _ in range(400)]
    vals += [(1, 12.3), (2, 359.9)]  # off-grid values do not count
    df = spark.createDataFrame(vals, "k int, v double")
    got = st.segment_freq(df, ["k"], "v").orderBy("k", "i").toPandas()
    for k in (1, 2):
        g = got[got.k == k]
        hist = np.zeros(1440)
        for kk, v in vals:
            p = v / 0.25
            if kk == k and p == int(p) and 0 <= p < 1440:
                hist[int(p)] += 1
        np.testing.assert_array_equal(g.freq.to_numpy(), hist)
        sm = _savgol_order1(hist, 59)
        np.testing.assert_allclose(g.freq_smooth.to_numpy(), sm, atol=1e-9)
        np.testing.assert_allclose(g.freq_cumsum.to_numpy(), np.cumsum(sm), atol=1e-6)
        assert g.labels.tolist() == _labels(sm.tolist(), 10)


def test_time_cdf_endpoints(spark):
    import datetime as dt
    rows = [(1, dt.datetime(2024, 1, 1, 12, 0)), (1, dt.datetime(2024, 1, 1, 23, 0)),
            (1, dt.datetime(2024, 1, 2, 3, 0, 30))]
    df = spark.createDataFrame(rows, "k int, t timestamp_ntz")
    out = st.time_cdf(df, ["k"], "t").orderBy("step").collect()
    assert len(out) == 1441
    assert out[0].time == "12:00:00" and out[-1].time == "12:00:00"
    assert abs(out[0].cdf - 1 / 3) < 1e-12
    assert abs(out[-1].cdf - (2 / 3 + 1 / 3)) < 1e-12  # 12:00 counted at both ends, off-minute row never
