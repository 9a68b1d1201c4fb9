"""Time-bin aggregation and dense resampling (AG2-AG9, AG4, WN12, WN15).

pandas ``groupby(keys).resample(rule)`` is dense: every bin between a group's first and last bin appears,
empty bins give 0 for count/sum and null for mean/min/max. Here aggregation runs first on
``(keys, bin)`` (map-side partial aggregation, skew spread over bins), and the empty bins are generated
from the aggregated rows alone: per key, ``lead(bin)`` tells how many bins are missing before the next
occupied one and ``step_bins`` emits them in short runs. No grid table and no join; the only windowed
frame is the aggregated one (at most one row per key and bin).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from homesense.functions.scalars import row_total
from homesense.functions.time import bin_start, week_label
from homesense.operators.ordered import AUTO, require_keys, with_last, with_shifts

BETWEEN_NIGHT = ("18:00", "12:00")


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """pandas ``groupby`` drops rows whose key is missing."""
    cond = None
    for k in keys:
        cond = F.col(k).isNotNull() if cond is None else cond & F.col(k).isNotNull()
    return df.where(cond)

_B = "__bin"


RUN = 1024


def step_bins(d: DataFrame, start: str, stop: Column, size: int, unit: str, out: str) -> DataFrame:
    """One row per bin ``start, start + size, .. stop`` (``size`` in ``unit`` SECOND or DAY) of every row, as
    ``out``. Bins are made in runs of at most ``RUN``, so a long gap is many short arrays and never one long one."""
    n = F.floor(F.timestamp_diff(unit, F.col(start), stop) / size).cast("long")
    runs = d.withColumn("__n", n).withColumn("__run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("__n") / RUN))))
    first = F.col("__run") * RUN
    k = F.explode(F.sequence(first, F.least(F.col("__n"), first + (RUN - 1))))
    kind = d.schema[start].dataType
    return (runs.withColumn("__k", k)
            .withColumn(out, F.timestamp_add(unit, F.col("__k") * size, F.col(start)).cast(kind)).drop("__n", "__run", "__k"))


def densify(agg: DataFrame, keys: Sequence[str], bin_col: str, step_seconds: int | None = None,
            fill: Mapping[str, object] | None = None, step_days: int | None = None,
            chunk_seconds: int | None | str = None) -> DataFrame:
    """Insert the missing bins of every key between its first and last bin (AG4).

    ``agg`` holds at most one row per (keys, bin). Columns named in ``fill`` get that value in inserted
    bins (e.g. 0 for counts); every other column is null there. ``step_days`` steps by calendar days
    (used for weekly labels). ``chunk_seconds`` finds the next bin in time chunks, for keys with more bins
    than a task should sort.
    """
    keys = require_keys(keys)
    fill = dict(fill or {})
    unit, size = ("DAY", step_days) if step_days else ("SECOND", step_seconds)
    if chunk_seconds is None:
        w = Window.partitionBy(*keys).orderBy(bin_col)
        d = agg.withColumn("__next", F.lead(F.col(bin_col)).over(w))
    else:
        d = with_shifts(agg, keys, bin_col, None, {"__next": (bin_col, 1)}, chunk_seconds)
    kind = agg.schema[bin_col].dataType
    before = F.timestamp_add(unit, F.lit(-size), F.col("__next")).cast(kind)
    stop = F.when(F.col("__next").isNull(), F.col(bin_col)).otherwise(before)
    d = step_bins(d, bin_col, stop, size, unit, _B)
    keep = [*keys, bin_col]
    cols = []
    for f in agg.columns:
        if f in keep:
            continue
        real = F.col(_B) == F.col(bin_col)
        filler = F.lit(fill[f]) if f in fill and fill[f] is not None else F.lit(None)
        cols.append(F.when(real, F.col(f)).otherwise(filler.cast(agg.schema[f].dataType)).alias(f))
    return d.select(*keys, F.col(_B).alias(bin_col), *cols)


def resample(df: DataFrame, keys: Sequence[str], ts: str, every_seconds: int,
             aggs: Mapping[str, Column], offset_seconds: int = 0, dense: bool = True,
             zero_fill: Sequence[str] = (), out: str = "start_date") -> DataFrame:
    """``groupby(keys).resample(every, offset).agg(...)``: one row per key and bin.

    ``aggs`` maps output name -> aggregate Column. ``zero_fill`` names the outputs that are 0 in empty
    bins (count, sum); others are null there. ``dense=False`` keeps only occupied bins.
    """
    keys = require_keys(keys)
    a = (drop_null_keys(df, keys).withColumn(out, bin_start(ts, every_seconds, offset_seconds))
         .groupBy(*keys, out).agg(*[col.alias(name) for name, col in aggs.items()]))
    if not dense:
        return a
    return densify(a, keys, out, every_seconds, {z: 0 for z in zero_fill})


def pivot_counts(dense: DataFrame, keys: Sequence[str], bin_col: str, pivot_col: str, values: Sequence[str],
                 measure: str, total: str | None = "Total", keep_positive_total: bool = True) -> DataFrame:
    """Wide table: one column per pivot value (null where the value had no bin), plus a row total
    skipping nulls; rows with total <= 0 dropped (AG3 / FIL15)."""
    wide = dense.groupBy(*keys, bin_col).pivot(pivot_col, list(values)).agg(F.first(measure))
    if total:
        wide = wide.withColumn(total, row_total(values).cast("long"))
        if keep_positive_total:
            wide = wide.where(F.col(total) > 0)
    return wide


def activity_dailies(motion: DataFrame, keys: Sequence[str], ts: str, location: str, locations: Sequence[str],
                     drop: Sequence[str] = ("bed_in", "Back door", "Front door"),
                     every_seconds: int = 86_400, offset_seconds: int = 12 * 3600) -> DataFrame:
    """Events per key, location and noon-day, dense per (key, location), pivoted wide with ``Total``
    (``process_activity_dailies``, AG3). ``drop`` keeps null locations (pandas ``not in``)."""
    keys = require_keys(keys)
    m = motion.where(~F.coalesce(F.col(location).isin(list(drop)), F.lit(False))) if drop else motion
    counts = resample(m, [*keys, location], ts, every_seconds, {"n": F.count(F.lit(1))}, offset_seconds,
                      zero_fill=["n"])
    values = [v for v in locations if v not in set(drop)]
    return pivot_counts(counts, keys, "start_date", location, values, "n")


def period_stats(df: DataFrame, keys: Sequence[str], ts: str, measures: Sequence[str],
                 period: str = "week", dense: bool = True) -> DataFrame:
    """Mean and sample std of every measure per key and week (``resample('1W')``, AG6).

    Output columns ``<measure>_mean``, ``<measure>_std``; empty weeks inside a key's range are null.
    """
    keys = require_keys(keys)
    if period != "week":
        raise ValueError("only weekly periods are defined")
    a = (drop_null_keys(df, keys).withColumn("__w", week_label(ts)).groupBy(*keys, "__w")
         .agg(*[F.avg(m).alias(f"{m}_mean") for m in measures], *[F.stddev_samp(m).alias(f"{m}_std") for m in measures]))
    if dense:
        a = densify(a, keys, "__w", step_days=7)
    return a.withColumnRenamed("__w", "start_date")


FILL_BINS = 8192        # bins in a chunk of the forward fill


def resample_mean_ffill(df: DataFrame, keys: Sequence[str], ts: str, value: str, every_seconds: int = 900,
                        chunk_seconds: int | None | str = "bins") -> DataFrame:
    """Mean per key and clock bin, dense, forward-filled within the key (``process_light``, AG8).

    The fill is computed on the occupied bins first (last non-null mean so far) and copied into the
    inserted empty bins. It is a scan over chunks of ``FILL_BINS`` bins, so no window holds more rows of a key however
    long its series is; ``chunk_seconds`` None gives one window per key.
    """
    keys = require_keys(keys)
    width = FILL_BINS * every_seconds if chunk_seconds == "bins" else chunk_seconds
    a = (drop_null_keys(df, keys).withColumn("start_date", bin_start(ts, every_seconds))
         .groupBy(*keys, "start_date").agg(F.avg(value).alias("__mean")))
    a = with_last(a, keys, "start_date", None, "__mean", value, width).drop("__mean")
    a = with_shifts(a, keys, "start_date", None, {"__next": ("start_date", 1)}, width)
    stop = F.when(F.col("__next").isNull(), F.col("start_date")).otherwise(
        F.timestamp_add("SECOND", F.lit(-every_seconds), F.col("__next")))
    return step_bins(a, "start_date", stop, every_seconds, "SECOND", "__b").select(
        *keys, F.col("__b").alias("start_date"), value)


def reindex_grid(df: DataFrame, keys: Sequence[str], ts: str, value: str, every_seconds: int) -> DataFrame:
    """Re-index a series on the regular grid min..max of each key (``reindex_ts``, WN15).

    Grid points are ``min + k * step`` up to the max; a row lands on the grid only when its time is
    exactly a grid point (off-grid rows are lost, as with ``reindex``); several rows on one grid time all
    appear; grid points without a row give one row with a null value. The per-key (min, max) table is
    joined back with a plain equi-join, which AQE turns into a broadcast when it is small at run time.
    """
    keys = require_keys(keys)
    step = every_seconds * 1_000_000
    span = df.groupBy(*keys).agg(F.min(ts).alias("__lo"), F.max(ts).alias("__hi"))
    d = df.select(*keys, ts, value).join(span, on=keys, how="inner")
    off = F.timestamp_diff("MICROSECOND", F.col("__lo"), F.col(ts))
    on_grid = d.where(off % F.lit(step) == 0).select(*keys, ts, value)
    last = F.timestamp_add("MICROSECOND",
                           F.floor(F.timestamp_diff("MICROSECOND", "__lo", "__hi") / F.lit(step)).cast("long")
                           * F.lit(step), F.col("__lo"))
    taken = on_grid.select(*keys, ts, F.lit(True).alias("__row")).unionByName(
        span.select(*keys, last.alias(ts), F.lit(False).alias("__row")))
    points = taken.groupBy(*keys, ts).agg(F.max("__row").alias("__row"))
    empty = densify(points, keys, ts, every_seconds, {"__row": False}, chunk_seconds=AUTO).where(~F.col("__row"))
    return on_grid.unionByName(empty.select(*keys, ts, F.lit(None).cast(df.schema[value].dataType).alias(value)))


def occupancy_daily(df: DataFrame, keys: Sequence[str], ts: str, start: str = "18:00", end: str = "12:00"
                    ) -> DataFrame:
    """Hours in bed per key and noon-day: occupied minutes between ``start`` and ``end`` (wrapping
    midnight), zero-filled over each key's range, divided by 60 (``process_occupancy``, AG5)."""
    from homesense.functions.time import between_time
    n = resample(df.where(between_time(ts, start, end)), keys, ts, 86_400, {"n": F.count(F.lit(1))},
                 12 * 3600, zero_fill=["n"])
    return n.select(*keys, "start_date", (F.col("n") / 60.0).alias("Time_in_bed"), F.lit("hour").alias("unit"))


def daily_counts_between(df: DataFrame, keys: Sequence[str], ts: str, start: str = "08:00", end: str = "20:00"
                         ) -> DataFrame:
    """Rows per key and calendar day inside a time-of-day window; ``nap_ibp = obs / 60`` (AG2)."""
    from homesense.functions.time import between_time, day_start
    return (drop_null_keys(df, keys).where(between_time(ts, start, end))
            .groupBy(*keys, day_start(ts).alias("date")).agg(F.count(F.lit(1)).alias("obs"))
            .withColumn("nap_ibp", F.col("obs") / 60.0))
