"""Driver-table queries for presence edges, gap sessions and the sleep-period chain (WN5-WN7, AG1,
AG10-AG12, FIL16, JN4, JN8, D5, D6, D12).

The sleep-mat view of ``events`` has about two readings per user and day, so the period gap is an
argument set to 6 h here (the recipe default is 1 h) to give multi-reading periods.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from homesense.operators import segments as sg
from homesense.operators.sequences import mine_transition
from homesense.plans.driver_tables import SLEEP_SQL, sleep_mat
from homesense.plans.recipes.sleep import process_bed_occupancy, process_sleep
from homesense.plans.registry import register, round_doubles, table
from homesense.session import staged

GAP_HOURS = 6
K = ["patient_id"]


def base_sleep(spark, sf):
    """The minute table as a stored dataset: edges, marks and naps read it, the readings are read once."""
    return staged(process_sleep(sleep_mat(spark, sf), K, tiebreak="event_id"), "base-sleep")


def _dense_edges_sql(src: str, key: str, ts: str) -> str:
    """Dense 1-minute occupancy + diff, the reference's formulation, as DuckDB CTEs ending in ``edges``."""
    return f"""
occ AS (SELECT {key} AS k, time_bucket(INTERVAL 1 minute, {ts}) AS m, count(*) AS c FROM {src}
        WHERE {key} IS NOT NULL AND {ts} IS NOT NULL GROUP BY ALL),
grid AS (SELECT k, unnest(generate_series(lo, hi, INTERVAL 1 minute)) AS m
         FROM (SELECT k, min(m) lo, max(m) hi FROM occ GROUP BY k)),
dense AS (SELECT g.k, g.m, coalesce(o.c, 0) AS c FROM grid g LEFT JOIN occ o USING (k, m)),
diffs AS (SELECT k, m, coalesce(c - lag(c) OVER (PARTITION BY k ORDER BY m), 1) AS d FROM dense),
edges AS (SELECT k AS {key}, m AS start_date, CASE WHEN d = 1 THEN 'Bed_in' ELSE 'Bed_out' END AS location_name
          FROM diffs WHERE d IN (1, -1))"""


@register("presence_edges", f"""
WITH {_dense_edges_sql("events", "user_id", "ts")}
SELECT * FROM edges
""", "WN7")
def q_presence_edges(spark, sf):
    return sg.presence_edges(table(spark, sf, "events"), ["user_id"], "ts")


@register("gap_sessions", """
WITH iv AS (SELECT user_id, event_id, ts AS start_date, ts + to_minutes(CAST(floor(value) AS BIGINT)) AS end_date
            FROM events WHERE user_id IS NOT NULL),
f AS (SELECT *, CASE WHEN epoch_us(start_date) - epoch_us(lag(end_date) OVER w) > 3600000000 THEN 1 ELSE 0 END AS flag
      FROM iv WINDOW w AS (PARTITION BY user_id ORDER BY start_date, event_id))
SELECT user_id, event_id, start_date, end_date,
       CAST(sum(flag) OVER (PARTITION BY user_id ORDER BY start_date, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT)
         AS period_segments
FROM f
""", "WN5")
def q_gap_sessions(spark, sf):
    ev = table(spark, sf, "events").where(F.col("user_id").isNotNull())
    iv = ev.select("user_id", "event_id", F.col("ts").alias("start_date"),
                   (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.floor("value").cast("int"))).alias("end_date"))
    return sg.gap_sessions(iv, ["user_id"], "start_date", "end_date", 3600, tiebreak="event_id") \
        .withColumn("period_segments", F.col("period_segments").cast("long"))


@register("period_type", """
SELECT event_id, ts AS start_date, ts + to_minutes(CAST(floor(value * 10) AS BIGINT)) AS end_date,
       CASE WHEN CAST(ts AS TIME) >= TIME '08:00:00'
             AND CAST(ts + to_minutes(CAST(floor(value * 10) AS BIGINT)) AS TIME) < TIME '20:00:00'
             AND CAST(ts AS DATE) = CAST(ts + to_minutes(CAST(floor(value * 10) AS BIGINT)) AS DATE)
            THEN 'Diurnal' ELSE 'Nocturnal' END AS period_type
FROM events
""", "FIL16")
def q_period_type(spark, sf):
    ev = table(spark, sf, "events")
    d = ev.select("event_id", F.col("ts").alias("start_date"),
                  (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.floor(F.col("value") * 10).cast("int")))
                  .alias("end_date"))
    return d.withColumn("period_type", sg.period_type("start_date", "end_date"))


# ---------------------------------------------------------------- the sleep chain (D12) in DuckDB

SLEEP_CHAIN_SQL = f"""
sleep AS ({SLEEP_SQL}),
{_dense_edges_sql("sleep", "patient_id", "start_date")},
tr AS (SELECT patient_id, start_date, lead(start_date) OVER w AS end_date, location_name AS source,
              lead(location_name) OVER w AS sink
       FROM (SELECT DISTINCT patient_id, start_date, location_name FROM edges)
       WINDOW w AS (PARTITION BY patient_id ORDER BY start_date)),
bed_in AS (SELECT *, source || '>' || sink AS transition, (epoch_us(end_date) - epoch_us(start_date)) / 1e6 AS dur
           FROM tr WHERE end_date IS NOT NULL AND source = 'Bed_in' AND sink = 'Bed_out'),
flags AS (SELECT *, CASE WHEN epoch_us(start_date) - epoch_us(lag(end_date) OVER w) > {GAP_HOURS * 3600}000000
                         THEN 1 ELSE 0 END AS f
          FROM bed_in WINDOW w AS (PARTITION BY patient_id ORDER BY start_date)),
segs AS (SELECT *, sum(f) OVER (PARTITION BY patient_id ORDER BY start_date ROWS UNBOUNDED PRECEDING) AS seg
         FROM flags),
h0 AS (SELECT patient_id, seg, min(start_date) AS start_date, max(end_date) AS end_date,
              count(transition) - 1 AS awake_events, sum(dur) / 3600.0 AS time_in_bed
       FROM segs GROUP BY ALL),
habits AS (SELECT patient_id, seg, start_date, end_date - INTERVAL 1 minute AS end_date, awake_events, time_in_bed,
                  (epoch_us(end_date) - epoch_us(start_date)) / 3.6e9 AS bed_time_period,
                  (epoch_us(end_date) - epoch_us(start_date)) / 3.6e9 - time_in_bed AS time_out_of_bed,
                  CASE WHEN CAST(start_date AS TIME) >= TIME '08:00:00' AND CAST(end_date AS TIME) < TIME '20:00:00'
                        AND CAST(start_date AS DATE) = CAST(end_date AS DATE) THEN 'Diurnal' ELSE 'Nocturnal' END
                    AS period_type
           FROM h0),
marked AS (SELECT s.*, sum(CASE WHEN h.mark IS NULL THEN 0 ELSE 1 END)
                        OVER (PARTITION BY s.patient_id ORDER BY s.start_date ROWS UNBOUNDED PRECEDING) AS seg
           FROM sleep s LEFT JOIN (SELECT DISTINCT patient_id, start_date, 1 AS mark FROM habits) h
             ON s.patient_id = h.patient_id AND s.start_date = h.start_date),
vitals AS (SELECT patient_id, seg, min(start_date) AS start_date, max(start_date) AS end_date,
                  CAST(sum(CAST(snoring AS INTEGER)) AS BIGINT) AS minutes_snoring,
                  avg(heart_rate) AS heart_rate, min(heart_rate) AS hr_min, max(heart_rate) AS hr_max,
                  avg(respiratory_rate) AS respiratory_rate, min(respiratory_rate) AS rr_min,
                  max(respiratory_rate) AS rr_max, count(respiratory_rate) AS period_obs
           FROM marked GROUP BY ALL),
states AS (SELECT patient_id, seg, min(start_date) AS start_date, max(start_date) AS end_date,
                  sum(CASE WHEN state = 'AWAKE' THEN 1 ELSE 0 END) / 60.0 AS AWAKE,
                  sum(CASE WHEN state = 'DEEP' THEN 1 ELSE 0 END) / 60.0 AS DEEP,
                  sum(CASE WHEN state = 'REM' THEN 1 ELSE 0 END) / 60.0 AS REM,
                  sum(CASE WHEN state = 'LIGHT' THEN 1 ELSE 0 END) / 60.0 AS LIGHT
           FROM marked GROUP BY ALL
           HAVING bool_or(state = 'AWAKE') AND bool_or(state = 'DEEP') AND bool_or(state = 'REM')
              AND bool_or(state = 'LIGHT')),
periods AS (SELECT v.patient_id, v.start_date, v.end_date, v.minutes_snoring,
                   round_even(v.heart_rate, 2) AS heart_rate, round_even(v.hr_min, 2) AS hr_min,
                   round_even(v.hr_max, 2) AS hr_max, round_even(v.respiratory_rate, 2) AS respiratory_rate,
                   round_even(v.rr_min, 2) AS rr_min, round_even(v.rr_max, 2) AS rr_max, v.period_obs,
                   h.awake_events, round_even(h.time_in_bed, 2) AS time_in_bed,
                   round_even(h.bed_time_period, 2) AS bed_time_period,
                   round_even(h.time_out_of_bed, 2) AS time_out_of_bed, h.period_type,
                   round_even(s.AWAKE, 2) AS AWAKE, round_even(s.DEEP, 2) AS DEEP, round_even(s.REM, 2) AS REM,
                   round_even(s.LIGHT, 2) AS LIGHT
            FROM vitals v
            LEFT JOIN habits h ON v.patient_id = h.patient_id AND v.start_date = h.start_date AND v.end_date = h.end_date
            LEFT JOIN states s ON v.patient_id = s.patient_id AND v.start_date = s.start_date AND v.end_date = s.end_date
            WHERE v.heart_rate IS NOT NULL AND v.hr_min IS NOT NULL AND v.hr_max IS NOT NULL
              AND v.respiratory_rate IS NOT NULL AND v.rr_min IS NOT NULL AND v.rr_max IS NOT NULL
              AND v.minutes_snoring IS NOT NULL),
periods_kept AS (SELECT * FROM periods WHERE time_in_bed IS NOT NULL AND DEEP IS NOT NULL AND hr_max IS NOT NULL),
night0 AS (SELECT patient_id, time_bucket(INTERVAL 1 day, start_date, INTERVAL 12 hours) AS start_date,
                  sum(period_obs) AS period_obs, sum(time_in_bed) AS time_in_bed,
                  sum(minutes_snoring) AS minutes_snoring, sum(AWAKE) AS AWAKE, sum(DEEP) AS DEEP, sum(REM) AS REM,
                  sum(LIGHT) AS LIGHT, avg(heart_rate) AS heart_rate, avg(respiratory_rate) AS respiratory_rate,
                  min(hr_min) AS hr_min, min(rr_min) AS rr_min, min(start_date) AS start_time,
                  max(hr_max) AS hr_max, max(rr_max) AS rr_max, max(end_date) AS end_time,
                  greatest(count(awake_events) + sum(awake_events) - 1, 0) AS nb_awakenings
           FROM periods_kept WHERE period_type = 'Nocturnal' GROUP BY ALL),
night AS (SELECT *, (epoch_us(end_time) - epoch_us(start_time)) / 3.6e9 AS bed_time_period,
                 (epoch_us(end_time) - epoch_us(start_time)) / 3.6e9 - time_in_bed AS time_out_of_bed
          FROM night0
          WHERE heart_rate IS NOT NULL AND respiratory_rate IS NOT NULL AND hr_min IS NOT NULL
            AND rr_min IS NOT NULL AND hr_max IS NOT NULL AND rr_max IS NOT NULL AND time_in_bed IS NOT NULL
            AND AWAKE IS NOT NULL AND DEEP IS NOT NULL AND REM IS NOT NULL AND LIGHT IS NOT NULL
            AND nb_awakenings IS NOT NULL),
naps AS (SELECT patient_id, CAST(CAST(start_date AS DATE) AS TIMESTAMP) AS date, count(*) / 60.0 AS nap_ibp
         FROM sleep WHERE CAST(start_date AS TIME) BETWEEN TIME '08:00:00' AND TIME '20:00:00' GROUP BY ALL),
dailies AS (SELECT n.*, CAST(CAST(n.start_date AS DATE) AS TIMESTAMP) AS date,
                   (hour(start_time) * 3600 + minute(start_time) * 60 + second(start_time)) / 240.0 + 180.0
                     - 360.0 * floor(((hour(start_time) * 3600 + minute(start_time) * 60 + second(start_time)) / 240.0 + 180.0) / 360.0)
                     AS time_to_bed,
                   (hour(end_time) * 3600 + minute(end_time) * 60 + second(end_time)) / 240.0 AS wake_up_time,
                   coalesce(p.nap_ibp, 0.0) AS nap_ibp
            FROM night n LEFT JOIN naps p
              ON n.patient_id = p.patient_id AND CAST(CAST(n.start_date AS DATE) AS TIMESTAMP) = p.date)"""


def _round_sql(cols_dbl, cols_other, src):
    return "SELECT " + ", ".join([f"round({c}, 6) AS {c}" for c in cols_dbl] + list(cols_other)) + f" FROM {src}"


def _chain(spark, sf):
    sleep = base_sleep(spark, sf)
    edges = process_bed_occupancy(sleep, K, one_row_per_minute=True)
    tr = mine_transition(edges.select(*K, "start_date", "location_name"), K, "location_name", "start_date", 1,
                         dedupe=False)   # edges hold one row per minute
    bed_in = sg.gap_sessions(tr.where(F.col("transition") == "Bed_in>Bed_out"), K, "start_date", "end_date",
                             GAP_HOURS * 3600)
    habits = sg.bed_habits(bed_in, K)
    marked = sg.mark_periods(sleep, habits, K, "start_date", carry=sg.HABIT_COLS)
    return sleep, edges, habits, marked


_HABIT_DBL = ["time_in_bed", "bed_time_period", "time_out_of_bed"]


@register("bed_habits", f"""
WITH {SLEEP_CHAIN_SQL}
{_round_sql(_HABIT_DBL, ["patient_id", "start_date", "end_date", "awake_events", "period_type"], "habits")}
""", "AG12", "WN5", "WN2", "D12")
def q_bed_habits(spark, sf):
    return round_doubles(_chain(spark, sf)[2].drop("period_segments"))


_VIT_DBL = ["heart_rate", "hr_min", "hr_max", "respiratory_rate", "rr_min", "rr_max"]


@register("vitals_by_period", f"""
WITH {SLEEP_CHAIN_SQL}
{_round_sql(_VIT_DBL, ["patient_id", "start_date", "end_date", "minutes_snoring", "period_obs"],
            "(SELECT * FROM vitals WHERE heart_rate IS NOT NULL AND rr_min IS NOT NULL)")}
""", "AG1", "JN8", "WN6")
def q_vitals(spark, sf):
    return round_doubles(sg.vitals_by_period(_chain(spark, sf)[3], K).drop("period_segments"))


@register("sleep_states", f"""
WITH {SLEEP_CHAIN_SQL}
{_round_sql(["AWAKE", "DEEP", "REM", "LIGHT"], ["patient_id", "start_date", "end_date"], "states")}
""", "AG11")
def q_sleep_states(spark, sf):
    return round_doubles(sg.sleep_states(_chain(spark, sf)[3], K).drop("period_segments"))


_PERIOD_DBL = [*_VIT_DBL, "time_in_bed", "bed_time_period", "time_out_of_bed", "AWAKE", "DEEP", "REM", "LIGHT"]


def periods(spark, sf):
    return sg.sleep_periods(_chain(spark, sf)[3], None, K)     # habits ride on the opening rows


@register("sleep_periods", f"""
WITH {SLEEP_CHAIN_SQL}
{_round_sql(_PERIOD_DBL, ["patient_id", "start_date", "end_date", "minutes_snoring", "period_obs", "awake_events",
                          "period_type"], "periods_kept")}
""", "JN4", "SC7", "FIL5")
def q_sleep_periods(spark, sf):
    return round_doubles(periods(spark, sf))


_NIGHT_DBL = ["time_in_bed", "AWAKE", "DEEP", "REM", "LIGHT", "heart_rate", "respiratory_rate", "hr_min", "rr_min",
              "hr_max", "rr_max", "bed_time_period", "time_out_of_bed"]
_NIGHT_OTHER = ["patient_id", "start_date", "CAST(period_obs AS BIGINT) AS period_obs",
                "CAST(minutes_snoring AS BIGINT) AS minutes_snoring", "start_time", "end_time",
                "CAST(nb_awakenings AS BIGINT) AS nb_awakenings"]


@register("nightly_metrics", f"""
WITH {SLEEP_CHAIN_SQL}
{_round_sql(_NIGHT_DBL, _NIGHT_OTHER, "night")}
""", "AG10")
def q_nightly(spark, sf):
    p = sg.minute_periods(base_sleep(spark, sf), K, gap_seconds=GAP_HOURS * 3600)
    return round_doubles(sg.nightly_metrics(p, K))


def sleep_dailies(spark, sf):
    return sg.sleep_dailies(base_sleep(spark, sf), None, K, GAP_HOURS * 3600)


@register("sleep_dailies", f"""
WITH {SLEEP_CHAIN_SQL}
{_round_sql([*_NIGHT_DBL, "time_to_bed", "wake_up_time", "nap_ibp"], [*_NIGHT_OTHER, "date"], "dailies")}
""", "D12", "AG2", "SC1", "JN5")
def q_sleep_dailies(spark, sf):
    return round_doubles(sleep_dailies(spark, sf))
