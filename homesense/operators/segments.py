"""Presence edges, gap sessions and sleep periods (WN5-WN7, JN8, FIL16, AG1, AG10-AG12).

Minute-level bed presence is never densified: edges come from the occupied minutes and their
neighbours (cost grows with events, not with the minutes of the study). Every per-entity ordered step
uses the chunked primitives of :mod:`homesense.operators.ordered`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from homesense.functions.scalars import np_round
from homesense.functions.time import (bin_start, c, day_start, duration_hours, micros_of_day,
                                      noon_day_bin, parse_time_of_day, time_angle)
from homesense.operators.ordered import AUTO, chunk_of, require_keys, resolve_chunk, with_running_sum, with_shifts
from homesense.operators.sequences import _no_null_keys

# Edge labels and sleep states as written by the reference recipes.
BED_IN, BED_OUT = "Bed_in", "Bed_out"
SLEEP_STATES = ("AWAKE", "DEEP", "REM", "LIGHT")
DIURNAL, NOCTURNAL = "Diurnal", "Nocturnal"
NIGHT_SUMS = ("period_obs", "time_in_bed", "minutes_snoring", "AWAKE", "DEEP", "REM", "LIGHT")
NIGHT_MEANS = ("heart_rate", "respiratory_rate")


def _minute() -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(1))


def presence_edges(df: DataFrame, keys: Sequence[str], ts: str, chunk_seconds: int | None | str = AUTO,
                   label_col: str = "location_name", one_row_per_minute: bool = False) -> DataFrame:
    """Bed_in / Bed_out edges from per-minute presence counts (``mine_bed_occupancy``, WN7).

    With c = rows in an occupied minute m and prev = c of minute m-1 (0 when that minute is empty):
    Bed_in at m when c - prev = 1 or m is the key's first minute; Bed_out at m when c - prev = -1; and
    Bed_out at m+1 when the next occupied minute is later than m+1 and c = 1. Nothing after the last
    minute. Equal to the dense 1-minute resample + diff, without building the grid.
    ``one_row_per_minute=True`` promises at most one row per key and minute and skips the count.
    """
    keys = require_keys(keys)
    d = _no_null_keys(df, keys).where(F.col(ts).isNotNull())
    if one_row_per_minute:  # e.g. the de-duplicated minute table: every occupied minute counts 1, no shuffle
        m = d.select(*keys, bin_start(ts, 60).alias("__m"), F.lit(1).cast("long").alias("__c"))
    else:
        m = d.groupBy(*keys, bin_start(ts, 60).alias("__m")).agg(F.count(F.lit(1)).alias("__c"))
    s = with_shifts(m, keys, "__m", None, {"__pm": ("__m", -1), "__pc": ("__c", -1), "__nm": ("__m", 1)},
                    chunk_seconds)
    one = _minute()
    prev = F.when(F.col("__pm") == F.col("__m") - one, F.col("__pc")).otherwise(F.lit(0))
    d = F.when(F.col("__pm").isNull(), F.lit(1)).otherwise(F.col("__c") - prev)
    edge_here = F.when(d == 1, F.lit(BED_IN)).when(d == -1, F.lit(BED_OUT))
    out_after = (F.col("__nm").isNotNull()) & (F.col("__nm") > F.col("__m") + one) & (F.col("__c") == 1)
    ev = F.array(
        F.when(edge_here.isNotNull(), F.struct(F.col("__m").alias("t"), edge_here.alias("e"))),
        F.when(out_after, F.struct((F.col("__m") + one).alias("t"), F.lit(BED_OUT).alias("e"))))
    return (s.select(*keys, F.explode(F.filter(ev, lambda x: x.isNotNull())).alias("__x"))
            .select(*keys, F.col("__x.t").alias("start_date"), F.col("__x.e").alias(label_col)))


def gap_sessions(df: DataFrame, keys: Sequence[str], start: str = "start_date", end: str = "end_date",
                 gap_seconds: float = 3600, out: str = "period_segments", tiebreak=None,
                 chunk_seconds: int | None | str = AUTO) -> DataFrame:
    """Segment id per key: a new segment starts when start - previous end > gap (``segment_periods``,
    WN5). Ids run from 0 within each key, in (start, tiebreak) order."""
    keys = require_keys(keys)
    s = with_shifts(df, keys, start, tiebreak, {"__pe": (end, -1)}, chunk_seconds)
    flag = F.when(F.timestamp_diff("MICROSECOND", F.col("__pe"), F.col(start)) > F.lit(int(gap_seconds * 1e6)), 1
                  ).otherwise(0)
    s = s.withColumn("__f", flag)
    return with_running_sum(s, keys, start, tiebreak, "__f", out, chunk_seconds).drop("__pe", "__f")


def period_type(start, end, day_start_time: str = "08:00", day_end_time: str = "20:00") -> Column:
    """Diurnal iff start time >= 08:00, end time < 20:00 and both on the same date; else Nocturnal (FIL16)."""
    a, b = parse_time_of_day(day_start_time), parse_time_of_day(day_end_time)
    diurnal = ((micros_of_day(start) >= a) & (micros_of_day(end) < b)
               & (F.to_date(c(start)) == F.to_date(c(end))))
    return F.when(c(start).isNull() | c(end).isNull(), F.lit(None).cast("string")) \
        .when(diurnal, F.lit(DIURNAL)).otherwise(F.lit(NOCTURNAL))


def bed_habits(bed_in: DataFrame, keys: Sequence[str], seg: str = "period_segments") -> DataFrame:
    """Per period: first in, last out, awake events (count - 1), hours in bed (sum dur / 3600), period
    length, time out of bed, period type; end moved back one minute to the last occupied minute (AG12)."""
    keys = require_keys(keys)
    h = bed_in.groupBy(*keys, seg).agg(
        F.min("start_date").alias("start_date"), F.max("end_date").alias("end_date"),
        (F.count("transition") - 1).alias("awake_events"), (F.sum("dur") / 3600.0).alias("time_in_bed"))
    h = (h.withColumn("bed_time_period", duration_hours("start_date", "end_date"))
         .withColumn("time_out_of_bed", F.col("bed_time_period") - F.col("time_in_bed"))
         .withColumn("period_type", period_type("start_date", "end_date")))
    return h.na.drop().withColumn("end_date", F.col("end_date") - _minute())


HABIT_COLS = ("end_date", "awake_events", "time_in_bed", "bed_time_period", "time_out_of_bed", "period_type")


def mark_periods(sleep: DataFrame, habits: DataFrame, keys: Sequence[str], ts: str = "start_date",
                 out: str = "period_segments", chunk_seconds: int | None | str = AUTO,
                 carry: Sequence[str] = ()) -> DataFrame:
    """Carry a period id forward over the minute rows: a row whose (key, time) is a habit start opens a
    new period; id = running count of opened periods per key, 0 before the first one (JN8 + WN6). ``sleep``
    holds at most one row per key and minute, as ``process_sleep`` gives it: each row of an opening minute opens
    a period.

    ``carry`` habit columns are attached (as ``__h_<name>``) to the opening row only, so the period
    aggregate can pick them up without joining the habits a second time.
    """
    keys = require_keys(keys)
    starts = habits.select(*keys, F.col("start_date").alias(ts), F.lit(1).alias("__mark"),
                           *[F.col(x).alias(f"__h_{x}") for x in carry])  # one habit per start: unique
    d = sleep.join(starts, on=[*keys, ts], how="left").withColumn("__mark", F.coalesce("__mark", F.lit(0)))
    return with_running_sum(d, keys, ts, None, "__mark", out, chunk_seconds).drop("__mark")


def sleep_states(sleep: DataFrame, keys: Sequence[str], seg: str = "period_segments",
                 states: Sequence[str] = SLEEP_STATES) -> DataFrame:
    """Hours per sleep state and period, plus the period's first and last minute; periods missing any
    state are dropped (AG11)."""
    keys = require_keys(keys)
    agg = [F.min("start_date").alias("start_date"), F.max("start_date").alias("end_date")]
    agg += [(F.sum(F.when(F.col("state") == s, 1).otherwise(0)) / 60.0).alias(s) for s in states]
    present = [F.max(F.when(F.col("state") == s, 1)).alias(f"__has_{s}") for s in states]
    g = sleep.groupBy(*keys, seg).agg(*agg, *present)
    for s in states:
        g = g.where(F.col(f"__has_{s}").isNotNull())
    return g.drop(*[f"__has_{s}" for s in states])


def vitals_by_period(sleep: DataFrame, keys: Sequence[str], seg: str = "period_segments") -> DataFrame:
    """Per period: first/last minute, snoring minutes, mean/min/max heart and breathing rate and the
    number of breathing readings; incomplete periods dropped (AG1)."""
    keys = require_keys(keys)
    return sleep.groupBy(*keys, seg).agg(
        F.min("start_date").alias("start_date"), F.max("start_date").alias("end_date"),
        F.sum(F.col("snoring").cast("long")).alias("minutes_snoring"),
        F.avg("heart_rate").alias("heart_rate"), F.min("heart_rate").alias("hr_min"),
        F.max("heart_rate").alias("hr_max"), F.avg("respiratory_rate").alias("respiratory_rate"),
        F.min("respiratory_rate").alias("rr_min"), F.max("respiratory_rate").alias("rr_max"),
        F.count("respiratory_rate").alias("period_obs")).na.drop()


def period_features(marked: DataFrame, keys: Sequence[str], seg: str = "period_segments",
                    carried: Sequence[str] = (), states: Sequence[str] = SLEEP_STATES) -> DataFrame:
    """Vitals (AG1) and state hours (AG11) of every period in one aggregation (JN6: no join of two
    aggregates of the same rows). State columns are null when the period lacks any state."""
    keys = require_keys(keys)
    st_hours = [(F.sum(F.when(F.col("state") == s, 1).otherwise(0)) / 60.0).alias(f"__st_{s}") for s in states]
    present = [F.max(F.when(F.col("state") == s, 1)).alias(f"__has_{s}") for s in states]
    g = marked.groupBy(*keys, seg).agg(
        F.min("start_date").alias("start_date"), F.max("start_date").alias("end_date"),
        F.sum(F.col("snoring").cast("long")).alias("minutes_snoring"),
        F.avg("heart_rate").alias("heart_rate"), F.min("heart_rate").alias("hr_min"),
        F.max("heart_rate").alias("hr_max"), F.avg("respiratory_rate").alias("respiratory_rate"),
        F.min("respiratory_rate").alias("rr_min"), F.max("respiratory_rate").alias("rr_max"),
        F.count("respiratory_rate").alias("period_obs"), *st_hours, *present,
        *[F.max(x).alias(x) for x in carried])
    vit = ["start_date", "end_date", "minutes_snoring", "heart_rate", "hr_min", "hr_max", "respiratory_rate",
           "rr_min", "rr_max", "period_obs"]
    g = g.na.drop(subset=vit)
    complete = None
    for s in states:
        complete = F.col(f"__has_{s}").isNotNull() if complete is None else complete & F.col(f"__has_{s}").isNotNull()
    return g.select(*keys, seg, *vit, *[F.when(complete, F.col(f"__st_{s}")).alias(s) for s in states], *carried)


def sleep_periods(marked: DataFrame, habits: DataFrame | None, keys: Sequence[str],
                  seg: str = "period_segments", digits: int = 2) -> DataFrame:
    """Period vitals and states left-joined with the bed habits on (keys, start, end) (JN4), doubles
    rounded as NumPy does to ``digits`` (SC7), rows without time_in_bed / DEEP / hr_max dropped.

    With ``habits=None`` the habit columns come from the opening row of each period (see
    :func:`mark_periods` ``carry``); a period keeps them only when the habit's end equals the period's
    last minute, which is exactly the join condition (habit starts are unique per key).
    """
    keys = require_keys(keys)
    on = [*keys, "start_date", "end_date"]
    if habits is not None:
        j = period_features(marked, keys, seg).drop(seg).join(habits.drop(seg), on=on, how="left")
    else:
        carried = [f"__h_{x}" for x in HABIT_COLS]
        f = period_features(marked, keys, seg, carried)
        hit = F.col("__h_end_date") == F.col("end_date")
        j = f.select(*[x for x in f.columns if x not in carried and x != seg],
                     *[F.when(hit, F.col(f"__h_{x}")).alias(x) for x in HABIT_COLS if x != "end_date"])
    dbl = [f.name for f in j.schema.fields if f.dataType.typeName() == "double"]
    j = j.select(*[np_round(F.col(x), digits).alias(x) if x in dbl else F.col(x) for x in j.columns])
    return j.na.drop(subset=["time_in_bed", "DEEP", "hr_max"])


def minute_periods(sleep: DataFrame, keys: Sequence[str], ts: str = "start_date", gap_seconds: float = 3600,
                   digits: int = 2, chunk_seconds: int | None | str = AUTO,
                   states: Sequence[str] = SLEEP_STATES) -> DataFrame:
    """Sleep periods straight from a minute table with at most one row per key and minute: the rows that
    ``presence_edges``, ``mine_transition``, ``gap_sessions``, ``bed_habits``, ``mark_periods`` and ``sleep_periods`` give
    one after the other, by two exchanges.

    A stay is a run of consecutive minutes, a period a run of stays with gaps of at most ``gap_seconds``. Minutes are
    ordered inside a time chunk only and each chunk's part of a period (a piece) is aggregated there. Pieces of a key meet
    in one task: their number is bounded by the time span over chunk and gap, not by the rows. The key's last stay has
    no Bed_out, so it neither opens a period nor completes one: the period that its minutes fall to is dropped. Rows
    with a null key or time belong to no period.
    """
    keys = require_keys(keys)
    if gap_seconds < 0:
        raise ValueError("gap_seconds must not be negative")
    size = resolve_chunk(sleep, chunk_seconds)
    micros = F.lit(int(gap_seconds * 1e6))

    def far(prev: str, here: str) -> Column:
        return F.timestamp_diff("MICROSECOND", F.col(prev) + _minute(), F.col(here)) > micros

    d = _no_null_keys(sleep, keys).where(F.col(ts).isNotNull()).select(
        *keys, F.col(ts).alias("__t"), F.col("snoring").cast("long").alias("__snore"), "heart_rate", "respiratory_rate",
        "state").withColumn("__chunk", F.lit(0).cast("long") if size is None else chunk_of("__t", size))
    wc = Window.partitionBy(*keys, "__chunk").orderBy("__t")
    d = d.withColumn("__p", F.lag("__t").over(wc))
    d = d.withColumn("__in", F.col("__p").isNull() | (F.col("__p") + _minute() != F.col("__t")))
    d = d.withColumn("__part", F.sum(F.when(far("__p", "__t"), 1).otherwise(0)).over(
        wc.rowsBetween(Window.unboundedPreceding, 0)))
    # a sum of pieces must round as one sum does: whole 65,536ths are added exactly, only the small rests as doubles
    def whole(x: str) -> Column:
        return F.when(F.abs(F.col(x)) < 2.0 ** 20, F.floor(F.col(x) * 65536.0)).otherwise(F.lit(0).cast("long"))

    def rest(x: str) -> Column:
        return F.col(x) - whole(x) / F.lit(65536.0)

    hours = [F.count(F.when(F.col("state") == s, 1)).alias(f"__n_{s}") for s in states]
    pieces = d.groupBy(*keys, "__chunk", "__part").agg(
        F.min("__t").alias("__a"), F.max("__t").alias("__b"), F.count(F.lit(1)).alias("__n"),
        F.count(F.when(F.col("__in"), 1)).alias("__stays"), F.max(F.when(F.col("__in"), F.col("__t"))).alias("__last"),
        F.sum("__snore").alias("__snore"), *hours,
        *[f.alias(f"__{n}_{x}") for x in NIGHT_MEANS
          for n, f in (("whole", F.sum(whole(x))), ("rest", F.sum(rest(x))), ("obs", F.count(x)), ("min", F.min(x)), ("max", F.max(x)))])

    wk = Window.partitionBy(*keys).orderBy("__a")
    every = wk.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    q = pieces.withColumn("__p", F.lag("__b").over(wk))
    joined = F.coalesce(F.col("__p") + _minute() == F.col("__a"), F.lit(False))   # a stay cut by the chunk's border
    q = q.withColumn("__stays", F.col("__stays") - F.when(joined, 1).otherwise(0))
    q = q.withColumn("__last", F.max(F.when(~(joined & (F.col("__last") == F.col("__a"))), F.col("__last"))).over(every))
    opens = (F.col("__p").isNull() | far("__p", "__a")) & (F.col("__a") != F.col("__last"))
    q = q.withColumn("__seg", F.sum(F.when(opens, 1).otherwise(0)).over(wk.rowsBetween(Window.unboundedPreceding, 0)))

    def mean(x: str) -> Column:
        n = F.sum(f"__obs_{x}")
        return F.when(n > 0, (F.sum(f"__whole_{x}") / F.lit(65536.0) + F.sum(f"__rest_{x}")) / n)

    g = q.groupBy(*keys, "__seg").agg(
        F.min("__a").alias("start_date"), F.max("__b").alias("end_date"), F.max("__last").alias("__last"),
        F.sum("__snore").alias("minutes_snoring"), mean("heart_rate").alias("heart_rate"),
        F.min("__min_heart_rate").alias("hr_min"), F.max("__max_heart_rate").alias("hr_max"),
        mean("respiratory_rate").alias("respiratory_rate"), F.min("__min_respiratory_rate").alias("rr_min"),
        F.max("__max_respiratory_rate").alias("rr_max"), F.sum("__obs_respiratory_rate").alias("period_obs"),
        *[(F.sum(f"__n_{s}") / 60.0).alias(s) for s in states],
        (F.sum("__stays") - 1).alias("awake_events"), (F.sum("__n") * 60 / 3600.0).alias("time_in_bed"))
    g = g.where(F.col("end_date") < F.col("__last"))
    for s in states:
        g = g.where(F.col(s) > 0)
    g = (g.withColumn("__out", F.col("end_date") + _minute())
         .withColumn("bed_time_period", duration_hours("start_date", "__out"))
         .withColumn("time_out_of_bed", F.col("bed_time_period") - F.col("time_in_bed"))
         .withColumn("period_type", period_type("start_date", "__out"))).drop("__seg", "__last", "__out").na.drop()
    dbl = [f.name for f in g.schema.fields if f.dataType.typeName() == "double" and f.name not in keys]
    return g.select(*[np_round(F.col(x), digits).alias(x) if x in dbl else F.col(x) for x in g.columns])


def nightly_metrics(periods: DataFrame, keys: Sequence[str], kind: str = NOCTURNAL) -> DataFrame:
    """Per key and noon-day (of the period start): sums, means, mins and maxs of the periods of one type,
    awakenings = max(0, periods + awake events - 1), period length and time out of bed (AG10)."""
    keys = require_keys(keys)
    p = periods.where(F.col("period_type") == kind).withColumn("__day", noon_day_bin("start_date"))
    g = p.groupBy(*keys, "__day").agg(
        *[F.sum(x).alias(x) for x in NIGHT_SUMS], *[F.avg(x).alias(x) for x in NIGHT_MEANS],
        F.min("hr_min").alias("hr_min"), F.min("rr_min").alias("rr_min"), F.min("start_date").alias("start_time"),
        F.max("hr_max").alias("hr_max"), F.max("rr_max").alias("rr_max"), F.max("end_date").alias("end_time"),
        F.greatest(F.count("awake_events") + F.sum("awake_events") - 1, F.lit(0)).alias("nb_awakenings"))
    g = g.na.drop()
    return (g.withColumnRenamed("__day", "start_date")
            .withColumn("bed_time_period", duration_hours("start_time", "end_time"))
            .withColumn("time_out_of_bed", F.col("bed_time_period") - F.col("time_in_bed")))


def sleep_dailies(sleep: DataFrame, edges: DataFrame | None, keys: Sequence[str], gap_seconds: float = 3600,
                  nap_window: tuple[str, str] = ("08:00", "20:00"), chunk_seconds: int | None | str = AUTO) -> DataFrame:
    """Nightly sleep features from minute rows and bed edges (``process_sleep_dailies``, D12). ``edges=None`` means
    the edges of the minute rows themselves, at most one per key and minute (:func:`minute_periods`)."""
    from homesense.operators.resample import daily_counts_between
    from homesense.operators.sequences import mine_transition

    keys = require_keys(keys)
    if edges is None:
        periods = minute_periods(sleep, keys, "start_date", gap_seconds, chunk_seconds=chunk_seconds)
    else:
        # presence edges hold at most one row per key and minute, so the distinct step is skipped
        tr = mine_transition(edges.select(*keys, "start_date", "location_name"), keys, "location_name",
                             "start_date", 1, None, chunk_seconds, dedupe=False)
        bed_in = tr.where(F.col("transition") == f"{BED_IN}>{BED_OUT}")
        bed_in = gap_sessions(bed_in, keys, "start_date", "end_date", gap_seconds, chunk_seconds=chunk_seconds)
        habits = bed_habits(bed_in, keys)
        # habit attributes ride on each period's opening row: habits are consumed once
        marked = mark_periods(sleep, habits, keys, "start_date", chunk_seconds=chunk_seconds, carry=HABIT_COLS)
        periods = sleep_periods(marked, None, keys)
    night = nightly_metrics(periods, keys)
    naps = daily_counts_between(sleep, keys, "start_date", *nap_window).select(*keys, "date", "nap_ibp")
    night = (night.withColumn("date", day_start("start_date"))
             .withColumn("time_to_bed", F.pmod(time_angle("start_time") + 180.0, F.lit(360.0)))
             .withColumn("wake_up_time", time_angle("end_time")))
    return (night.join(naps, on=[*keys, "date"], how="left")
            .withColumn("nap_ibp", F.coalesce(F.col("nap_ibp"), F.lit(0.0))))
