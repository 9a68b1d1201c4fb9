"""Driver-table queries for column functions and filters (SC1-SC17, FIL1-FIL15, SCH3).

Time-zone queries move the January events into the months of the clock changes (``+ 70 days`` reaches
the last Sunday of March, ``+ 9 months`` the last Sunday of October) so the skipped and repeated hours
are exercised.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from homesense.functions import scalars as sc
from homesense.functions import time as tf
from homesense.plans.registry import register, round_doubles, table

TOD = "(hour(ts) * 3600 + minute(ts) * 60 + second(ts))"


def _events(spark, sf):
    return table(spark, sf, "events")


@register("time_angle", f"SELECT event_id, round({TOD} / 240.0, 6) AS angle FROM events", "SC1")
def q_time_angle(spark, sf):
    return round_doubles(_events(spark, sf).select("event_id", tf.time_angle("ts").alias("angle")))


@register("angle_time", """
SELECT event_id, CASE WHEN value IS NULL THEN NULL ELSE
  printf('%02d:%02d:%02d', CAST(floor(s / 3600) AS INTEGER), CAST(floor((s % 3600) / 60) AS INTEGER),
         CAST(s % 60 AS INTEGER)) END AS hms
FROM (SELECT event_id, value, CAST(floor((value * 3.6) * 240.0) AS BIGINT) AS s FROM events)
""", "SC2")
def q_angle_time(spark, sf):
    return _events(spark, sf).select("event_id", tf.angle_to_hms_text(F.col("value") * 3.6).alias("hms"))


@register("parse_time", """
SELECT event_id, strftime(ts, '%H:%M:%S') AS t,
       CAST(split_part(strftime(ts, '%H:%M:%S'), ':', 1) AS INTEGER) * 3600
       + CAST(split_part(strftime(ts, '%H:%M:%S'), ':', 2) AS INTEGER) * 60
       + CAST(split_part(strftime(ts, '%H:%M:%S'), ':', 3) AS INTEGER) AS seconds
FROM events
""", "SC3")
def q_parse_time(spark, sf):
    d = _events(spark, sf).select("event_id", tf.time_text("ts").alias("t"))
    return d.withColumn("seconds", tf.hms_text_to_seconds("t"))


@register("center_angle", """
SELECT event_id, round(x - 2 * pi() * floor(x / (2 * pi())) - pi(), 6) AS centered
FROM (SELECT event_id, radians(value * 3.6) + pi() AS x FROM events)
""", "SC4")
def q_center_angle(spark, sf):
    return round_doubles(_events(spark, sf).select("event_id", sc.center_angle(F.col("value") * 3.6).alias("centered")))


@register("round_quarter", "SELECT event_id, round(round_even((value / 7.0) * 4, 0) / 4, 6) AS q FROM events", "SC5")
def q_round_quarter(spark, sf):
    return round_doubles(_events(spark, sf).select("event_id", sc.round_quarter(F.col("value") / 7.0).alias("q")))


@register("round_half", "SELECT event_id, round(round_even((value / 7.0) * 2, 0) / 2, 6) AS h FROM events", "SC6")
def q_round_half(spark, sf):
    return round_doubles(_events(spark, sf).select("event_id", sc.round_half(F.col("value") / 7.0).alias("h")))


# UTC wall time u of a local wall time t (earlier offset when t is repeated, offset before the gap when
# t is skipped), and the local wall time of a UTC wall time.
def _local_of_utc(x: str) -> str:
    return f"timezone('Europe/London', timezone('UTC', {x}))"


_U0 = "timezone('UTC', timezone('Europe/London', t))"
_U = f"(CASE WHEN {_local_of_utc(f'{_U0} - INTERVAL 1 hour')} = t THEN {_U0} - INTERVAL 1 hour ELSE {_U0} END)"
_SHIFTED = """(SELECT event_id, ts + INTERVAL 9 month AS t FROM events
               UNION ALL SELECT event_id + 1000000000, ts + INTERVAL 70 day FROM events)"""


def _shifted(spark, sf):
    ev = _events(spark, sf)
    a = ev.select("event_id", (F.col("ts") + F.make_ym_interval(F.lit(0), F.lit(9))).alias("t"))
    b = ev.select((F.col("event_id") + 1_000_000_000).alias("event_id"),
                  (F.col("ts") + F.make_dt_interval(F.lit(70))).alias("t"))
    return a.unionByName(b)


@register("localize", f"""
SELECT event_id, t, t + ({_local_of_utc("u")} - u) AS local_time
FROM (SELECT event_id, t, {_U} AS u FROM {_SHIFTED})
""", "SC8")
def q_localize(spark, sf):
    return _shifted(spark, sf).withColumn("local_time", tf.localize("t", "Europe/London"))


@register("utc_to_local", f"""
SELECT event_id, t, t + (t - u) - INTERVAL 2 hour AS local_time
FROM (SELECT event_id, t, {_U} AS u FROM {_SHIFTED})
""", "SC9")
def q_utc_to_local(spark, sf):
    return _shifted(spark, sf).withColumn("local_time", tf.utc_to_local("t", "Europe/London", -2))


@register("epoch_to_local", f"""
SELECT event_id, e, t + (t - u) AS local_time
FROM (SELECT event_id, e, t, {_U} AS u
      FROM (SELECT event_id, epoch_us(t) // 1000000 AS e,
                   make_timestamp(epoch_us(t) // 1000000 * 1000000) AS t FROM {_SHIFTED}))
""", "SC10")
def q_epoch_to_local(spark, sf):
    d = _shifted(spark, sf).select("event_id", F.floor(tf.epoch_micros("t") / 1_000_000).cast("long").alias("e"))
    return d.withColumn("local_time", tf.epoch_to_local("e", "Europe/London", 0))


_DST_YEARS = [2023, 2024, 2025]


@register("dst_shift", """
SELECT event_id, ts + to_hours(CAST(h AS BIGINT)) AS start_date
FROM (SELECT event_id, ts, CASE
  WHEN ts >= TIMESTAMP '2023-03-25 12:00:00' AND ts < TIMESTAMP '2023-10-28 12:00:00' THEN 0
  WHEN ts >= TIMESTAMP '2023-10-28 12:00:00' AND ts < TIMESTAMP '2024-03-30 12:00:00' THEN -1
  WHEN ts >= TIMESTAMP '2024-03-30 12:00:00' AND ts < TIMESTAMP '2024-10-26 12:00:00' THEN 0
  WHEN ts >= TIMESTAMP '2024-10-26 12:00:00' AND ts < TIMESTAMP '2025-03-29 12:00:00' THEN -1
  WHEN ts >= TIMESTAMP '2025-03-29 12:00:00' AND ts < TIMESTAMP '2025-10-25 12:00:00' THEN 0 END AS h FROM events) WHERE h IS NOT NULL
""", "SC11")
def q_dst_shift(spark, sf):
    d = _events(spark, sf).select("event_id", "ts", tf.dst_shift_hours("ts", _DST_YEARS).alias("h"))
    return d.where(F.col("h").isNotNull()).select(
        "event_id", (F.col("ts") + F.make_dt_interval(F.lit(0), F.col("h"))).alias("start_date"))


@register("last_sunday", """
SELECT event_id, CAST(last_day(CAST(t AS DATE)) - CAST((dayofweek(last_day(CAST(t AS DATE))) + 7) % 7 AS INTEGER)
                      AS TIMESTAMP) AS last_sunday
FROM (SELECT event_id, ts + to_months(CAST(floor(value / 10) AS INTEGER)) AS t FROM events)
""", "SC12")
def q_last_sunday(spark, sf):
    ev = _events(spark, sf)
    t = F.col("ts") + F.make_ym_interval(F.lit(0), F.floor(F.col("value") / 10).cast("int"))
    d = ev.select("event_id", t.alias("t"))
    return d.select("event_id", tf.last_sunday(F.year("t"), F.month("t")).cast("timestamp_ntz").alias("last_sunday"))


@register("date_iso", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS iso FROM events", "SC13")
def q_date_iso(spark, sf):
    return _events(spark, sf).select("event_id", tf.iso_text("ts").alias("iso"))


@register("string_clean", r"""
SELECT event_id, replace(regexp_replace(props, '"|\[|\]', '', 'g'), ' ', '_') AS props_clean,
       lower(event_type) AS lower_type, upper(event_type) AS upper_type,
       replace(event_type, 'view', 'page view') AS replaced
FROM events
""", "SC15", "JN1")
def q_string_clean(spark, sf):
    ev = _events(spark, sf)
    return ev.select("event_id", sc.device_type_text("props").alias("props_clean"),
                     F.lower("event_type").alias("lower_type"), F.upper("event_type").alias("upper_type"),
                     F.replace("event_type", F.lit("view"), F.lit("page view")).alias("replaced"))


@register("date_parts", """
SELECT event_id, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS date, strftime(ts, '%H:%M:%S') AS time_of_day,
       date_trunc('minute', ts) AS minute, date_trunc('hour', ts) AS hour
FROM events
""", "SC16")
def q_date_parts(spark, sf):
    ev = _events(spark, sf)
    return ev.select("event_id", tf.day_start("ts").alias("date"), tf.time_text("ts").alias("time_of_day"),
                     tf.minute_bin("ts").alias("minute"), tf.bin_start("ts", 3600).alias("hour"))


@register("durations", """
SELECT l_orderkey, l_linenumber, round((epoch_us(e) - epoch_us(l_shipdate)) / 1e6, 6) AS dur_s,
       round((epoch_us(e) - epoch_us(l_shipdate)) / 3.6e9, 6) AS dur_h,
       e - INTERVAL 1 minute AS end_minus_minute, e - INTERVAL 1 hour AS end_minus_hour
FROM (SELECT l_orderkey, l_linenumber, l_shipdate,
             l_shipdate + to_days(CAST(l_quantity AS INTEGER)) + to_minutes(CAST(l_linenumber * 7 AS BIGINT)) AS e
      FROM lineitem)
""", "SC17")
def q_durations(spark, sf):
    li = table(spark, sf, "lineitem")
    e = (F.col("l_shipdate") + F.make_dt_interval(F.col("l_quantity").cast("int"))
         + F.make_dt_interval(F.lit(0), F.lit(0), F.col("l_linenumber") * 7))
    d = li.select("l_orderkey", "l_linenumber", "l_shipdate", e.alias("e"))
    return round_doubles(d.select("l_orderkey", "l_linenumber", tf.duration_seconds("l_shipdate", "e").alias("dur_s"),
                                  tf.duration_hours("l_shipdate", "e").alias("dur_h"),
                                  (F.col("e") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(1))).alias("end_minus_minute"),
                                  (F.col("e") - F.make_dt_interval(F.lit(0), F.lit(1))).alias("end_minus_hour")))


# ---------------------------------------------------------------- filters

@register("rename_project", """
SELECT user_id AS patient_id, ts AS start_date, event_type AS location_name FROM events
""", "FIL1")
def q_rename_project(spark, sf):
    ev = _events(spark, sf).select("user_id", "ts", "event_type")
    return ev.toDF("patient_id", "start_date", "location_name")


_SPARSE_SQL = "CASE WHEN value > 50 THEN event_type END"


def _sparse(ev):
    return F.when(F.col("value") > 50, F.col("event_type"))


@register("not_in_keep_null", f"""
SELECT event_id, t FROM (SELECT event_id, {_SPARSE_SQL} AS t FROM events)
WHERE t IS NULL OR t NOT IN ('click', 'view')
""", "FIL2")
def q_not_in(spark, sf):
    ev = _events(spark, sf)
    d = ev.select("event_id", _sparse(ev).alias("t"))
    return d.where(sc.not_in_keep_null("t", ["click", "view"]))


@register("eq_and", f"""
SELECT event_id, user_id, t FROM (SELECT event_id, user_id, event_type, value, {_SPARSE_SQL} AS t FROM events)
WHERE event_type = 'purchase' AND value > 10 AND (t IS NULL OR t <> '')
""", "FIL3")
def q_eq_and(spark, sf):
    ev = _events(spark, sf)
    d = ev.select("event_id", "user_id", "event_type", "value", _sparse(ev).alias("t"))
    return d.where((F.col("event_type") == "purchase") & (F.col("value") > 10) & sc.not_blank_keep_null("t")) \
        .select("event_id", "user_id", "t")


@register("between_time", """
SELECT event_id, ts FROM events WHERE CAST(ts AS TIME) >= TIME '08:00:00' AND CAST(ts AS TIME) <= TIME '20:00:00'
""", "FIL4")
def q_between_time(spark, sf):
    return _events(spark, sf).where(tf.between_time("ts", "08:00", "20:00")).select("event_id", "ts")


@register("between_time_wrap", """
SELECT event_id, ts FROM events WHERE CAST(ts AS TIME) >= TIME '18:00:00' OR CAST(ts AS TIME) <= TIME '12:00:00'
""", "FIL4")
def q_between_time_wrap(spark, sf):
    return _events(spark, sf).where(tf.between_time("ts", "18:00", "12:00")).select("event_id", "ts")


@register("dropna_subset", f"""
SELECT event_id, t, round(value, 6) AS value FROM (SELECT event_id, {_SPARSE_SQL} AS t, value FROM events)
WHERE t IS NOT NULL AND value IS NOT NULL
""", "FIL5")
def q_dropna(spark, sf):
    ev = _events(spark, sf)
    return round_doubles(ev.select("event_id", _sparse(ev).alias("t"), "value").na.drop(subset=["t", "value"]))


@register("range_query", """
SELECT event_id, user_id, ts, event_type FROM events
WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-12 00:00:00'
  AND user_id = (SELECT min(user_id) FROM events)
""", "FIL8")
def q_range_query(spark, sf):
    ev = _events(spark, sf)
    first_user = ev.select(F.min("user_id")).scalar()
    return ev.where((F.col("ts") >= F.lit("2024-01-05 00:00:00").cast("timestamp_ntz"))
                    & (F.col("ts") < F.lit("2024-01-12 00:00:00").cast("timestamp_ntz"))
                    & (F.col("user_id") == first_user)).select("event_id", "user_id", "ts", "event_type")


# Replacement map in the style of the appliance map (matched values may map to null).
EVENT_REPLACE = {"click": "tap", "signup": "register", "error": None}
EVENT_STRICT = {"click": "Click", "view": "View", "purchase": "Purchase"}


@register("map_replace", """
SELECT event_id, CASE event_type WHEN 'click' THEN 'tap' WHEN 'signup' THEN 'register' WHEN 'error' THEN NULL
                                 ELSE event_type END AS mapped FROM events
""", "FIL10", "FIL12")
def q_map_replace(spark, sf):
    return _events(spark, sf).select("event_id", sc.map_replace("event_type", EVENT_REPLACE).alias("mapped"))


@register("map_strict", """
SELECT event_id, CASE event_type WHEN 'click' THEN 'Click' WHEN 'view' THEN 'View' WHEN 'purchase' THEN 'Purchase'
                 END AS mapped FROM events
""", "FIL11")
def q_map_strict(spark, sf):
    return _events(spark, sf).select("event_id", sc.map_strict("event_type", EVENT_STRICT).alias("mapped"))


@register("clip", f"""
SELECT event_id, round(CASE WHEN v IS NULL THEN NULL ELSE greatest(10.0, least(60.0, v)) END, 6) AS clipped
FROM (SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS v FROM events)
""", "FIL13")
def q_clip(spark, sf):
    ev = _events(spark, sf)
    v = F.when(F.col("event_type") != "error", F.col("value"))
    return round_doubles(ev.select("event_id", sc.clip(v, 10.0, 60.0).alias("clipped")))


@register("bool_words", """
SELECT event_id, CASE WHEN event_type = 'click' THEN 1.0 WHEN event_type = 'view' THEN 0.0
                      WHEN event_type = 'purchase' THEN CAST(user_id AS DOUBLE) END AS flag
FROM events
""", "SCH3")
def q_bool_words(spark, sf):
    ev = _events(spark, sf)
    words = (F.when(F.col("event_type") == "click", "TRUE").when(F.col("event_type") == "view", "false")
             .when(F.col("event_type") == "purchase", F.col("user_id").cast("string"))
             .otherwise(F.col("event_type")))
    return ev.select("event_id", sc.bool_words(words).alias("flag"))
