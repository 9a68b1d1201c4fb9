"""Last value so far over chunks, exact quantiles by selection, ordered levels in the schema."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from homesense.functions import levels as lv
from homesense.operators import ordered
from homesense.operators import resample as rs
from homesense.operators import stats as st

START = dt.datetime(2024, 1, 1)


def series(spark, seed=1):
    rng = random.Random(seed)
    rows = []
    for k in range(600):        # a third of all rows under one key, with long runs of nulls
        key = "hot" if k % 3 == 0 else f"p{k % 40}"
        v = None if rng.random() < 0.8 else float(rng.randint(0, 9))
        rows.append((key, START + dt.timedelta(minutes=rng.randint(0, 60 * 24 * 20)), k, v))
    rows += [("hot", START + dt.timedelta(days=30 + d), 1000 + d, None) for d in range(9)]
    return spark.createDataFrame(rows, "k string, t timestamp_ntz, id int, v double").repartition(4)


def test_last_value_over_chunks_equals_one_window(spark):
    df = series(spark)
    for value in (F.col("v").cast("string"),):
        want = {tuple(r) for r in ordered.with_last(df, ["k"], "t", "id", value, "last", None).collect()}
        for width in (7200, 10 ** 9):
            got = [tuple(r) for r in ordered.with_last(df, ["k"], "t", "id", value, "last", width).collect()]
            assert len(got) == df.count() and set(got) == want


def test_forward_fill_over_chunks(spark, monkeypatch):
    df = series(spark, 2)
    want = {tuple(r) for r in rs.resample_mean_ffill(df, ["k"], "t", "v", 900, chunk_seconds=None).collect()}
    for bins in (50, 8192):
        monkeypatch.setattr(rs, "FILL_BINS", bins)
        got = [tuple(r) for r in rs.resample_mean_ffill(df, ["k"], "t", "v", 900).collect()]
        assert len(got) == len(want) and set(got) == want


@pytest.mark.parametrize("leaf", [30, 10_000])
def test_quantiles_equal_percentile(spark, leaf):
    rng = random.Random(leaf)
    probs = (0.0, 0.25, 0.5, 0.75, 0.999, 1.0)
    for values in ([rng.gauss(0, 1) for _ in range(3000)], [float(rng.randint(0, 3)) for _ in range(1000)], [2.5], [7.0] * 50,
                   [0.0] * 900 + [rng.random() for _ in range(100)] + [None] * 10):
        df = spark.createDataFrame([(x,) for x in values], "x double").repartition(5)
        want = df.agg(F.percentile("x", F.array(*[F.lit(p) for p in probs]))).first()[0]
        assert st.exact_quantiles(df, "x", probs, leaf) == want
    few = spark.createDataFrame([(float(k * k),) for k in range(12)], "x double")
    assert st.exact_quantiles(few, "x", (0.25, 0.75), 1) == few.agg(F.percentile("x", F.array(F.lit(0.25), F.lit(0.75)))).first()[0]
    assert st.exact_quantiles(spark.createDataFrame([(None,)], "x double"), "x", probs) is None


def test_labels_by_selection_equal_those_by_counts(spark):
    rng = random.Random(5)
    df = spark.createDataFrame([(k, rng.choice([0.0, rng.gauss(8, 2), 30.0, None])) for k in range(500)], "k int, x double")
    key = lambda d: {tuple(r) for r in d.collect()}
    assert key(st.iqr_labels(df, "x", rank_out="r")) == key(st.iqr_labels(df, "x", rank_out="r", discrete=True))
    none = st.iqr_labels(spark.createDataFrame([(1, None)], "k int, x double"), "x").first()
    assert none.global_outcome is None and none.outcome_full is None


def test_levels_are_written_read_and_sorted(spark, scratch):
    df = spark.createDataFrame([(k, x) for k, x in enumerate((0.0, 40.0, 7.0, 8.0, 8.5, 9.0, 8.2, -30.0, None))], "k int, x double")
    path = scratch + "/labels"
    st.iqr_labels(df, "x", rank_out="r").write.parquet(path)
    back = spark.read.parquet(path)
    order = [st.OUT_OF_BED, st.EXTREMELY_LOW, *st.OCCUPANCY_LABELS, st.EXTREMELY_HIGH]
    assert lv.levels_of(back, "outcome_full") == order
    assert lv.levels_of(back, "global_outcome") == [st.OUT_OF_BED, *st.OCCUPANCY_LABELS]
    got = [r.outcome_full for r in lv.order_by_level(back.filter("k > 0"), "outcome_full").collect()]
    ranked = [x for x in got if x is not None]
    assert ranked == sorted(ranked, key=order.index) and got[len(ranked):] == [None] * (len(got) - len(ranked))
    assert [r.outcome_full for r in lv.order_by_level(back, "outcome_full", descending=True).collect()][0] == order[-1]
    assert back.where(lv.level_rank(back, "outcome_full") != F.col("r")).count() == 0
    high = back.where(lv.at_least(back, "outcome_full", st.OCCUPANCY_LABELS[2]))
    assert {r.outcome_full for r in high.collect()} <= {st.OCCUPANCY_LABELS[2], st.EXTREMELY_HIGH} and high.count() >= 1
    with pytest.raises(ValueError):
        lv.levels_of(back, "k")
