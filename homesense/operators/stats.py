"""Statistics: cohort quartile labels, circular moments, rolling z-score, value shares, time-of-day CDF,
histogram smoothing and frequency segmentation (AG13, AG15-AG17, AG20, WN8-WN10, WN14).

Global statistics (quartiles, totals) are computed as one-row scalar subqueries (``DataFrame.scalar()``)
and used as literals: no cross join and no window without partition.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from homesense.functions.levels import with_levels
from homesense.functions.time import angle_to_hms_text, c, micros_of_day
from homesense.operators.ordered import require_keys

# Fixed label values of the occupancy outcome (must equal the reference's text).
OCCUPANCY_LABELS = ("Low TIB", "Normal TIB", "High TIB")
OUT_OF_BED, EXTREMELY_LOW, EXTREMELY_HIGH = "OOB", "Extremely low", "Extremely high"


# ---------------------------------------------------------------- AG13 quartile labels


LEAF = 10_000           # values that are sorted at last
NARROW = 1_000          # accuracy of the splitters


def exact_quantiles(df: DataFrame, x: str, probs: Sequence[float], leaf: int = LEAF) -> list[float] | None:
    """Exact linear quantiles of a column, as ``percentile`` gives them, without gathering its values; None if it has none.

    Order statistics are selected by narrowing: an approximate percentile sketch proposes three values around each rank,
    one aggregate counts the values below and between them exactly, and only the part that holds the rank is
    looked at again, until at most ``leaf`` values are left to sort (or all are equal). Each round passes over the
    input and keeps a few thousandths of it.
    """
    v = F.col(x).cast("double")
    base = df.where(v.isNotNull()).select(v.alias("v"))
    n, lo, hi = base.agg(F.count("*"), F.min("v"), F.max("v")).first()
    if not n:
        return None
    places = [p * (n - 1) for p in probs]
    # rank -> (lowest and highest value that it can have, number of values below the lowest, number from lowest to highest)
    spans = {r: (lo, hi, 0, n) for p in places for r in (math.floor(p), math.ceil(p))}
    while open_ := {r: s for r, s in spans.items() if s[3] > leaf and s[0] < s[1]}:
        shares = {r: (r - s[2] + 0.5) / s[3] for r, s in open_.items()}
        near = base.agg(*[F.percentile_approx(F.when(F.col("v").between(s[0], s[1]), F.col("v")),
                                              [max(0.0, shares[r] - 3 / NARROW), shares[r], min(1.0, shares[r] + 3 / NARROW)], NARROW)
                          for r, s in open_.items()]).first()
        counts = base.agg(*[f for s, (a, m, b) in zip(open_.values(), near) for f in _zones(F.col("v"), *s[:2], a, m, b)]).first()
        for k, ((r, s), (a, m, b)) in enumerate(zip(open_.items(), near)):
            cuts, ends = counts[8 * k:8 * k + 4], counts[8 * k + 4:8 * k + 8]
            # below a, from a to below m, m itself, beyond m up to b, beyond b: m is a value, so every part is smaller
            zones = [(s[0], ends[0]), (a, ends[1]), (m, m), (ends[2], b), (ends[3], s[1])]
            bounds = [s[2], *cuts, s[2] + s[3]]
            z = next(z for z in range(5) if bounds[z] <= r < bounds[z + 1])
            spans[r] = (*zones[z], bounds[z], bounds[z + 1] - bounds[z])
    left = sorted({(s[0], s[1]) for s in spans.values() if s[0] < s[1]})
    rows = {s: [] for s in left}
    for a, b in left:       # at most ``leaf`` values each
        rows[(a, b)] = [r.v for r in base.where(F.col("v").between(a, b)).orderBy("v").collect()]
    at = {r: s[0] if s[0] == s[1] else rows[(s[0], s[1])][r - s[2]] for r, s in spans.items()}
    out = []
    for p in places:
        low, high = math.floor(p), math.ceil(p)
        out.append(at[low] if low == high or at[low] == at[high] else (high - p) * at[low] + (p - low) * at[high])
    return out


def _zones(v: Column, lo: float, hi: float, a: float, m: float, b: float) -> list[Column]:
    """How many values lie below ``a``, below ``m``, up to ``m`` and up to ``b``, and the values next to these borders within
    [lo, hi]."""
    return [F.count_if(v < a), F.count_if(v < m), F.count_if(v <= m), F.count_if(v <= b),
            F.max(F.when((v >= lo) & (v < a), v)), F.max(F.when((v >= a) & (v < m), v)),
            F.min(F.when((v > m) & (v <= b), v)), F.min(F.when((v > b) & (v <= hi), v))]


def iqr_labels(df: DataFrame, x: str, labels: Sequence[str] = OCCUPANCY_LABELS, out: str = "global_outcome",
               full_out: str | None = "outcome_full", approx_accuracy: int | None = None,
               rank_out: str | None = None, discrete: bool = False) -> DataFrame:
    """Label each value against the cohort quartiles and 1.5 IQR fences.

    0 -> OOB; > q3 + 1.5 IQR -> Extremely high; < q1 - 1.5 IQR -> Extremely low; (lo, q1] / (q1, q3] /
    (q3, hi] -> labels; exactly lo -> null. ``out`` keeps only OOB and the three labels (the others
    become null), ``full_out`` keeps all six, ``rank_out`` is the full label's place in the order from out of
    bed to extremely high; both label columns hold that order in their schema (``functions.levels``).

    Quartiles are exact and linear. They are found by selection (``exact_quantiles``: a few passes when this is
    called, no task sees all values); with ``discrete``, for a measure of few distinct values (hours in bed: at
    most 1441), they are taken lazily from a (value, count) table whose distinct values meet in one task;
    ``approx_accuracy`` takes ``percentile_approx``.
    """
    probs = F.array(F.lit(0.25), F.lit(0.75))
    if approx_accuracy is not None:
        quartiles = df.select(F.percentile_approx(F.col(x).cast("double"), probs, approx_accuracy).cast("array<double>")).scalar()
    elif discrete:
        counts = df.where(F.col(x).isNotNull()).groupBy(F.col(x).alias("__x")).agg(F.count("*").alias("__n"))
        quartiles = counts.select(F.percentile("__x", probs, F.col("__n"))).scalar()
    else:
        found = exact_quantiles(df, x, (0.25, 0.75))
        quartiles = F.array(*[F.lit(q) for q in found or (None, None)]).cast("array<double>")
    d = df.withColumn("__q", quartiles)
    q1, q3 = F.col("__q")[0], F.col("__q")[1]
    iqr = q3 - q1
    lo, hi = q1 - iqr * 1.5, q3 + iqr * 1.5
    v = F.col(x)
    full = (F.when(v == 0, F.lit(OUT_OF_BED)).when(v > hi, F.lit(EXTREMELY_HIGH)).when(v < lo, F.lit(EXTREMELY_LOW))
            .when((v > lo) & (v <= q1), F.lit(labels[0])).when((v > q1) & (v <= q3), F.lit(labels[1]))
            .when((v > q3) & (v <= hi), F.lit(labels[2])))
    d = d.withColumn("__full", full)
    keep = [OUT_OF_BED, *labels]
    d = d.withColumn(out, F.when(F.col("__full").isin(keep), F.col("__full")))
    order = [OUT_OF_BED, EXTREMELY_LOW, *labels, EXTREMELY_HIGH]
    d = with_levels(with_levels(d, out, keep), "__full", order)
    if rank_out:
        place = F.array_position(F.array(*[F.lit(x) for x in order]), F.col("__full")) - 1
        d = d.withColumn(rank_out, place.cast("int"))
    if full_out:
        d = d.withColumnRenamed("__full", full_out)
    return d.drop("__q", "__full")


# ---------------------------------------------------------------- AG16/AG17 circular moments


KINDS = ("angles", "time", "datetime", "timedelta")


def _as_kind(angle: Column, kind: str) -> Column:
    """An angle of the day as degrees, 'HH:MM:SS' text, a time on 2021-01-01 or a day-time interval."""
    if kind not in KINDS:
        raise ValueError(f"kind is one of {KINDS}")
    if kind == "angles":
        return angle
    if kind == "time":
        return angle_to_hms_text(angle)
    if kind == "datetime":  # whole seconds, on the fixed day of the reference
        return F.timestamp_add("SECOND", F.floor(angle * 240.0).cast("long"), F.lit("2021-01-01").cast("timestamp_ntz"))
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (angle * 240.0).cast("decimal(18,6)"))


def circular_mean(angle, kind: str = "angles") -> Column:
    """Aggregate: circular mean of angles in degrees, in [0, 360), as one of ``KINDS`` (AG16)."""
    r = F.radians(c(angle))
    return _as_kind(F.pmod(F.degrees(F.atan2(F.sum(F.sin(r)), F.sum(F.cos(r)))), F.lit(360.0)), kind)


def circular_std(angle, kind: str = "angles") -> Column:
    """Aggregate: circular standard deviation in degrees, sqrt(-2 ln R) with R capped at 1, as one of ``KINDS``
    (AG17). Without any direction (R = 0) it is infinite as an angle and null as a time."""
    r = F.radians(c(angle))
    rr = F.least(F.lit(1.0), F.hypot(F.avg(F.sin(r)), F.avg(F.cos(r))))
    spread = F.when(rr > 0, F.degrees(F.sqrt(F.lit(-2.0) * F.ln(rr))))
    if kind == "angles":
        return spread.when(rr == 0, F.lit(float("inf")))
    return _as_kind(spread, kind)


# ---------------------------------------------------------------- WN8 rolling z-score


def rolling_zscore(df: DataFrame, keys: Sequence[str], order: str, x: str, window: int = 14,
                   out: str | None = None) -> DataFrame:
    """(x - rolling mean) / rolling sample std over the last ``window`` non-null rows of each key.

    Rows whose x is null are skipped and get null; one-row windows give null (sample std undefined).
    The window runs over per-key daily rows (bounded by the number of days).
    """
    keys = require_keys(keys)
    out = out or f"{x}_z"
    v = F.when(~F.isnan(F.col(x)), F.col(x))  # NaN counts as missing, as in pandas
    w = Window.partitionBy(*keys, v.isNull()).orderBy(order).rowsBetween(-(window - 1), 0)
    z = F.try_divide(v - F.avg(v).over(w), F.stddev_samp(v).over(w))
    return df.withColumn(out, F.when(v.isNotNull(), z))


# ---------------------------------------------------------------- AG15 value counts


def value_counts(df: DataFrame, cols: Sequence[str] | str, normalize: bool = False, out: str | None = None
                 ) -> DataFrame:
    """Counts per distinct value (null values dropped as in pandas); ``normalize`` divides by the
    number of counted rows (a scalar subquery)."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    d = df
    for x in cols:
        d = d.where(F.col(x).isNotNull())
    counts = d.groupBy(*cols).agg(F.count(F.lit(1)).alias("count"))
    if not normalize:
        return counts
    total = d.select(F.count(F.lit(1))).scalar()
    return counts.select(*cols, (F.col("count") / total).alias(out or "proportion"))


# ---------------------------------------------------------------- WN9 time-of-day CDF


def time_cdf(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Empirical CDF of time of day on a 1-minute grid 12:00 -> 12:00 (1441 points, 12:00 at both ends).

    Only times on whole minutes meet the grid; shares are over all rows of the key.
    """
    keys = require_keys(keys)
    t = F.col(ts)
    on_minute = micros_of_day(t) % F.lit(60_000_000) == 0
    d = df.where(F.col(ts).isNotNull())
    for k in keys:
        d = d.where(F.col(k).isNotNull())
    d = d.select(*keys, F.when(on_minute, F.hour(t) * 60 + F.minute(t)).alias("__m"))
    counts = d.groupBy(*keys, "__m").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(*keys)
    shares = counts.withColumn("__share", F.col("__n") / F.sum("__n").over(w)).where(F.col("__m").isNotNull())
    grid = (counts.select(*keys).distinct()
            .select(*keys, F.explode(F.sequence(F.lit(0), F.lit(1440))).alias("step"))
            .withColumn("__m", (F.col("step") + 720) % 1440))
    g = grid.join(shares.select(*keys, "__m", "__share"), on=[*keys, "__m"], how="left")
    wc = Window.partitionBy(*keys).orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    return g.select(*keys, "step",
                    F.format_string("%02d:%02d:00", (F.col("__m") / 60).cast("int"), F.col("__m") % 60).alias("time"),
                    F.sum(F.coalesce(F.col("__share"), F.lit(0.0))).over(wc).alias("cdf"))


# ---------------------------------------------------------------- WN10 / WN14 / AG20 histogram segmentation


def histogram_grid(df: DataFrame, keys: Sequence[str], v: str, lb: float = 0.0, ub: float = 360.0,
                   step: float = 0.25) -> DataFrame:
    """Counts of exact grid values lb, lb+step, .. < ub per key; absent grid values count 0 [Q-05].

    Output: keys, i (grid position), bin (grid value), freq.
    """
    keys = require_keys(keys)
    n = int(math.ceil((ub - lb) / step))
    pos = (F.col(v) - F.lit(lb)) / F.lit(step)
    d = df.where(F.col(v).isNotNull())
    for k in keys:
        d = d.where(F.col(k).isNotNull())
    at = F.when((pos == F.floor(pos)) & (pos >= 0) & (pos < n), pos.cast("int"))
    counts = d.groupBy(*keys, at.alias("__i")).agg(F.count(F.lit(1)).alias("__n"))
    # at most n occupied bins per key: one small map, read once, instead of a grid joined to the counts
    taken = F.collect_list(F.when(F.col("__i").isNotNull(), F.struct("__i", "__n")))
    keyed = counts.groupBy(*keys).agg(F.map_from_entries(taken).alias("__bins"))
    grid = keyed.select(*keys, "__bins", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("i"))
    return grid.select(*keys, "i", (F.lit(lb) + F.col("i") * F.lit(step)).alias("bin"),
                       F.coalesce(F.try_element_at("__bins", F.col("i")), F.lit(0)).alias("freq"))


def smooth_histogram(hist: DataFrame, keys: Sequence[str], window_length: int = 59) -> DataFrame:
    """Savitzky-Golay smoothing of order 1 (``interp`` mode) and its running sum, per key (WN10).

    Interior points: centred moving mean of ``window_length`` bins. The first / last half-window take
    the least-squares line through the first / last ``window_length`` bins. Input from
    :func:`histogram_grid` (positions 0..n-1, n >= window_length).
    """
    keys = require_keys(keys)
    h = window_length // 2
    wk = Window.partitionBy(*keys)
    w = Window.partitionBy(*keys).orderBy("i")
    d = hist.withColumn("__n", F.max("i").over(wk) + 1)

    def line(part: Column, names: tuple[str, str]) -> DataFrame:
        y, x = F.when(part, F.col("freq")), F.when(part, F.col("i"))
        return d.withColumn(names[0], F.regr_slope(y, x).over(wk)).withColumn(names[1], F.regr_intercept(y, x).over(wk))
    d = line(F.col("i") < window_length, ("__hs", "__hi"))
    d = line(F.col("i") >= F.col("__n") - window_length, ("__ts", "__ti"))
    mov = F.avg("freq").over(w.rowsBetween(-h, h))
    i = F.col("i").cast("double")
    smooth = (F.when(F.col("i") < h, F.col("__hi") + F.col("__hs") * i)
              .when(F.col("i") >= F.col("__n") - h, F.col("__ti") + F.col("__ts") * i)
              .otherwise(mov))
    d = d.withColumn("freq_smooth", smooth)
    return (d.withColumn("freq_cumsum", F.sum("freq_smooth").over(w.rowsBetween(Window.unboundedPreceding, 0)))
            .drop("__n", "__hs", "__hi", "__ts", "__ti"))


def _votes(i: int, n: int, r: int) -> np.ndarray:
    """How often bin ``i`` stands among the neighbours of every bin: bin j looks at j-r .. j+r-1, and places
    beyond an end stand for the end bin."""
    j = np.arange(n)
    votes = ((j > i - r) & (j <= i + r)).astype(np.int64)
    if i == 0:
        votes = np.maximum(0, r + 1 - j)
    if i == n - 1:
        votes = votes + np.maximum(0, r - 1 - (n - 1 - j)) if n > 1 else np.full(n, 2 * r)
    return votes


def _label_bins(x: np.ndarray, r: int) -> np.ndarray:
    """Segment labels of a smoothed histogram.

    Bins are taken by falling count (rounded to six decimals; ties: lower bin first). A table holds, for each
    label and bin, how many of the bin's neighbours carry the label; the taken bin gets the label with most
    votes (ties: the older label), or a new label if it has no vote, and casts its own votes.
    """
    n = x.shape[0]
    labels = np.zeros(n, dtype=np.int64)
    table = np.zeros((0, n), dtype=np.int64)
    for i in np.lexsort((np.arange(n), -np.round(x, 6))):
        best = int(table[:, i].argmax()) if len(table) else 0
        if not len(table) or table[best, i] == 0:
            best = len(table)
            table = np.vstack([table, np.zeros((1, n), dtype=np.int64)])
        labels[i] = best + 1
        table[best] += _votes(int(i), n, r)
    return labels


def segment_freq(df: DataFrame, keys: Sequence[str], v: str, window_length: int = 59, r: int = 10,
                 lb: float = 0.0, ub: float = 360.0, step: float = 0.25) -> DataFrame:
    """Histogram -> smoothing -> greedy segment labels per key (``segment_freq``, WN14).

    Counting, the grid and the smoothing are Spark aggregates and windows; only the ordered labelling
    runs in ``applyInPandas``, on groups of exactly ceil((ub-lb)/step) rows per key (bounded by
    construction, not by the data).
    """
    keys = require_keys(keys)
    sm = smooth_histogram(histogram_grid(df, keys, v, lb, ub, step), keys, window_length)
    schema = T.StructType(sm.schema.fields + [T.StructField("labels", T.LongType())])

    def label(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("i").reset_index(drop=True)
        pdf["labels"] = _label_bins(pdf["freq_smooth"].to_numpy(dtype=float), r)
        return pdf

    return sm.groupBy(*keys).applyInPandas(label, schema)


def segment_summary(seg: DataFrame, keys: Sequence[str], shift: float = 180.0) -> DataFrame:
    """Per label: first and last bin shifted by ``-shift`` mod 360 shown as 'HH:MM:SS', the summed
    count and its share of the key's total (AG20; [Q-06], [Q-08])."""
    keys = require_keys(keys)
    g = seg.groupBy(*keys, "labels").agg(F.min("bin").alias("__s"), F.max("bin").alias("__e"),
                                         F.sum("freq").alias("freq_sum"))
    w = Window.partitionBy(*keys)
    return g.select(*keys, "labels",
                    angle_to_hms_text(F.pmod(F.col("__s") - shift, F.lit(360.0))).alias("start"),
                    angle_to_hms_text(F.pmod(F.col("__e") - shift, F.lit(360.0))).alias("end"),
                    F.col("freq_sum").cast("long").alias("freq_sum"),
                    F.try_divide(F.col("freq_sum"), F.sum("freq_sum").over(w)).alias("proportion"))
