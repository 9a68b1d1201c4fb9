"""Driver-table queries for binning and dense resampling (AG2-AG8, AG13, WN15)."""

from __future__ import annotations

from pyspark.sql import functions as F

from homesense.functions.time import bin_start, day_start, time_angle
from homesense.operators import resample as rs
from homesense.operators import stats as st
from homesense.plans.recipes.profile import habitat_profile
from homesense.plans.registry import register, round_doubles, table

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
NOON = "time_bucket(INTERVAL 1 day, ts, INTERVAL 12 hours)"
NIGHT_SQL = "(CAST(ts AS TIME) >= TIME '18:00:00' OR CAST(ts AS TIME) <= TIME '12:00:00')"


@register("densify", f"""
WITH c AS (SELECT user_id, {NOON} AS start_date, count(*) AS n FROM events
           WHERE user_id IS NOT NULL GROUP BY ALL),
g AS (SELECT user_id, unnest(generate_series(lo, hi, INTERVAL 1 day)) AS start_date
      FROM (SELECT user_id, min(start_date) lo, max(start_date) hi FROM c GROUP BY user_id))
SELECT g.user_id, g.start_date, coalesce(c.n, 0) AS n FROM g LEFT JOIN c USING (user_id, start_date)
""", "AG4")
def q_densify(spark, sf):
    ev = table(spark, sf, "events")
    return rs.resample(ev, ["user_id"], "ts", 86_400, {"n": F.count(F.lit(1))}, 12 * 3600, zero_fill=["n"])


_ACT_COLS = ["click", "purchase", "signup", "view"]
ACTIVITY_DAILIES_SQL = f"""
WITH c AS (SELECT user_id, event_type, {NOON} AS start_date, count(*) AS n FROM events
           WHERE user_id IS NOT NULL AND event_type IS NOT NULL AND event_type NOT IN ('error') GROUP BY ALL),
g AS (SELECT user_id, event_type, unnest(generate_series(lo, hi, INTERVAL 1 day)) AS start_date
      FROM (SELECT user_id, event_type, min(start_date) lo, max(start_date) hi FROM c GROUP BY ALL)),
d AS (SELECT g.*, coalesce(c.n, 0) AS n FROM g LEFT JOIN c USING (user_id, event_type, start_date)),
p AS (SELECT user_id, start_date, {", ".join(f"CAST(max(n) FILTER (WHERE event_type = '{v}') AS DOUBLE) AS {v}" for v in _ACT_COLS)}
      FROM d GROUP BY user_id, start_date)
SELECT *, CAST({" + ".join(f"coalesce({v}, 0)" for v in _ACT_COLS)} AS BIGINT) AS Total FROM p
WHERE {" + ".join(f"coalesce({v}, 0)" for v in _ACT_COLS)} > 0
"""


def activity_dailies(spark, sf):
    ev = table(spark, sf, "events")
    wide = rs.activity_dailies(ev, ["user_id"], "ts", "event_type", EVENT_TYPES, drop=["error"])
    # location columns are null outside a location's own range: carried as double like the reference
    return wide.select(*[F.col(x).cast("double").alias(x) if x in _ACT_COLS else F.col(x) for x in wide.columns])


register("activity_dailies", ACTIVITY_DAILIES_SQL, "AG3", "D11")(activity_dailies)

_WK_MEASURES = [*_ACT_COLS, "Total"]


@register("activity_weeklies", f"""
WITH a AS ({ACTIVITY_DAILIES_SQL}),
w AS (SELECT user_id, date_trunc('week', start_date) + INTERVAL 6 days AS start_date,
             {", ".join(f"avg({m}) AS {m}_mean, stddev_samp({m}) AS {m}_std" for m in _WK_MEASURES)}
      FROM a GROUP BY ALL),
g AS (SELECT user_id, unnest(generate_series(lo, hi, INTERVAL 7 days)) AS start_date
      FROM (SELECT user_id, min(start_date) lo, max(start_date) hi FROM w GROUP BY user_id))
SELECT g.user_id, g.start_date,
       {", ".join(f"round({m}_mean, 6) AS {m}_mean, round({m}_std, 6) AS {m}_std" for m in _WK_MEASURES)}
FROM g LEFT JOIN w USING (user_id, start_date)
""", "AG6", "D11")
def q_activity_weeklies(spark, sf):
    return round_doubles(rs.period_stats(activity_dailies(spark, sf), ["user_id"], "start_date", _WK_MEASURES))


OCCUPANCY_SQL = f"""
WITH c AS (SELECT user_id, {NOON} AS start_date, count(*) AS n FROM events
           WHERE user_id IS NOT NULL AND {NIGHT_SQL} GROUP BY ALL),
g AS (SELECT user_id, unnest(generate_series(lo, hi, INTERVAL 1 day)) AS start_date
      FROM (SELECT user_id, min(start_date) lo, max(start_date) hi FROM c GROUP BY user_id))
SELECT g.user_id, g.start_date, coalesce(c.n, 0) / 60.0 AS Time_in_bed, 'hour' AS unit
FROM g LEFT JOIN c USING (user_id, start_date)
"""


def occupancy(spark, sf):
    return rs.occupancy_daily(table(spark, sf, "events"), ["user_id"], "ts")


@register("occupancy_daily", f"""
SELECT user_id, start_date, round(Time_in_bed, 6) AS Time_in_bed, unit FROM ({OCCUPANCY_SQL})
""", "AG5", "FIL4")
def q_occupancy(spark, sf):
    return round_doubles(occupancy(spark, sf))


@register("iqr_labels", f"""
WITH o AS ({OCCUPANCY_SQL}),
q AS (SELECT quantile_cont(Time_in_bed, 0.25) AS q1, quantile_cont(Time_in_bed, 0.75) AS q3 FROM o),
l AS (SELECT o.*, CASE WHEN Time_in_bed = 0 THEN 'OOB'
                       WHEN Time_in_bed > q3 + (q3 - q1) * 1.5 THEN 'Extremely high'
                       WHEN Time_in_bed < q1 - (q3 - q1) * 1.5 THEN 'Extremely low'
                       WHEN Time_in_bed > q1 - (q3 - q1) * 1.5 AND Time_in_bed <= q1 THEN 'Low TIB'
                       WHEN Time_in_bed > q1 AND Time_in_bed <= q3 THEN 'Normal TIB'
                       WHEN Time_in_bed > q3 AND Time_in_bed <= q3 + (q3 - q1) * 1.5 THEN 'High TIB' END AS outcome_full
      FROM o, q)
SELECT user_id, start_date, round(Time_in_bed, 6) AS Time_in_bed, unit, outcome_full,
       CASE WHEN outcome_full IN ('OOB', 'Low TIB', 'Normal TIB', 'High TIB') THEN outcome_full END AS global_outcome
FROM l
""", "AG13", "SCH6", "D16")
def q_iqr_labels(spark, sf):
    return round_doubles(st.iqr_labels(occupancy(spark, sf), "Time_in_bed", discrete=True))


@register("daily_naps", """
SELECT user_id, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS date, count(*) AS obs, count(*) / 60.0 AS nap_ibp
FROM events WHERE user_id IS NOT NULL AND CAST(ts AS TIME) BETWEEN TIME '08:00:00' AND TIME '20:00:00'
GROUP BY ALL
""", "AG2")
def q_daily_naps(spark, sf):
    return round_doubles(rs.daily_counts_between(table(spark, sf, "events"), ["user_id"], "ts", "08:00", "20:00"))


@register("resample_minute", """
SELECT user_id, time_bucket(INTERVAL 1 minute, ts) AS start_date,
       CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS snoring,
       round(avg(value), 6) AS heart_rate, round(avg(value / 4.0), 6) AS respiratory_rate
FROM events WHERE user_id IS NOT NULL GROUP BY ALL
HAVING avg(value) IS NOT NULL AND avg(value / 4.0) IS NOT NULL
""", "AG7")
def q_resample_minute(spark, sf):
    ev = table(spark, sf, "events")
    r = rs.resample(ev, ["user_id"], "ts", 60,
                    {"snoring": F.sum(F.when(F.col("event_type") == "error", 1).otherwise(0)).cast("long"),
                     "heart_rate": F.avg("value"), "respiratory_rate": F.avg(F.col("value") / 4.0)},
                    dense=False)
    return round_doubles(r.na.drop(subset=["heart_rate", "respiratory_rate"]))


@register("resample_15min_ffill", """
WITH a AS (SELECT user_id, event_type, time_bucket(INTERVAL 6 hours, ts) AS start_date, avg(value) AS value
           FROM events WHERE user_id IS NOT NULL AND event_type IS NOT NULL GROUP BY ALL),
g AS (SELECT user_id, event_type, unnest(generate_series(lo, hi, INTERVAL 6 hours)) AS start_date
      FROM (SELECT user_id, event_type, min(start_date) lo, max(start_date) hi FROM a GROUP BY ALL)),
d AS (SELECT g.*, a.value FROM g LEFT JOIN a USING (user_id, event_type, start_date))
SELECT user_id, event_type, start_date, CAST(CAST(start_date AS DATE) AS TIMESTAMP) AS date,
       round((hour(start_date) * 3600 + minute(start_date) * 60 + second(start_date)) / 240.0, 6) AS time,
       round(last_value(value IGNORE NULLS) OVER (PARTITION BY user_id, event_type ORDER BY start_date
                                                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS value
FROM d
""", "AG8", "WN12", "D15")
def q_resample_ffill(spark, sf):
    ev = table(spark, sf, "events")
    r = rs.resample_mean_ffill(ev, ["user_id", "event_type"], "ts", "value", every_seconds=6 * 3600)
    return round_doubles(r.withColumn("date", day_start("start_date")).withColumn("time", time_angle("start_date")))


@register("habitat_profile", """
WITH e AS (SELECT event_type AS patient_id, ts, value,
             CASE user_id % 4 WHEN 0 THEN 'Kitchen' WHEN 1 THEN 'Lounge' WHEN 2 THEN 'Bathroom' END AS location_name
           FROM events WHERE event_type IS NOT NULL),
a AS (SELECT patient_id, location_name, time_bucket(INTERVAL 15 minutes, ts) AS start_date, avg(value) AS value
      FROM e WHERE location_name IS NOT NULL GROUP BY ALL),
g AS (SELECT patient_id, location_name, unnest(generate_series(lo, hi, INTERVAL 15 minutes)) AS start_date
      FROM (SELECT patient_id, location_name, min(start_date) lo, max(start_date) hi FROM a GROUP BY ALL)),
d AS (SELECT g.*, a.value FROM g LEFT JOIN a USING (patient_id, location_name, start_date))
SELECT patient_id, location_name, start_date, CAST(CAST(start_date AS DATE) AS TIMESTAMP) AS date,
       round((hour(start_date) * 3600 + minute(start_date) * 60 + second(start_date)) / 240.0, 6) AS time,
       round(last_value(value IGNORE NULLS) OVER (PARTITION BY patient_id, location_name ORDER BY start_date
                                                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS value
FROM d
""", "AG8", "D15")
def q_habitat_profile(spark, sf):
    """Event values as room readings: rooms by user, one of four with a name that the room map lacks."""
    ev = table(spark, sf, "events")
    u = F.col("user_id") % 4
    room = F.when(u == 0, "kitchen").when(u == 1, "study").when(u == 2, "WC1").when(u == 3, "garage")
    env = ev.select(F.col("event_type").alias("patient_id"), F.col("ts").alias("start_date"), "value",
                    room.alias("location_name"))
    return round_doubles(habitat_profile(env))


@register("reindex_grid", """
WITH e AS (SELECT user_id, time_bucket(INTERVAL 1 hour, ts) AS t, value FROM events WHERE user_id IS NOT NULL),
g AS (SELECT user_id, unnest(generate_series(lo, hi, INTERVAL 3 hours)) AS t
      FROM (SELECT user_id, min(t) lo, max(t) hi FROM e GROUP BY user_id))
SELECT g.user_id, g.t AS ts, round(e.value, 6) AS value FROM g LEFT JOIN e ON e.user_id = g.user_id AND e.t = g.t
""", "WN15")
def q_reindex_grid(spark, sf):
    ev = table(spark, sf, "events").where(F.col("user_id").isNotNull())
    hourly = ev.select("user_id", bin_start("ts", 3600).alias("ts"), "value")
    return round_doubles(rs.reindex_grid(hourly, ["user_id"], "ts", "value", 3 * 3600))
