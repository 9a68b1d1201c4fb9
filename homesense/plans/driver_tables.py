"""Sensor-shaped views of the driver tables, derived by Spark from the given parquet.

* motion / activity: ``events`` as (patient_id = user_id, start_date = ts, location_name = event_type).
* sleep mat: one reading per event at its minute; state, heart rate, breathing rate and the snoring
  word are derived from the event's type and value with the fixed maps below.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from homesense.functions.scalars import map_strict
from homesense.functions.time import minute_bin
from homesense.plans.registry import table

# Fixed mapping of event types onto sleep states for the sleep-mat view of ``events``.
STATE_OF_EVENT = {"view": "AWAKE", "click": "LIGHT", "purchase": "DEEP", "signup": "REM", "error": "AWAKE"}
STATE_SQL = ("CASE event_type WHEN 'view' THEN 'AWAKE' WHEN 'click' THEN 'LIGHT' WHEN 'purchase' THEN 'DEEP' "
             "WHEN 'signup' THEN 'REM' WHEN 'error' THEN 'AWAKE' END")


def sleep_mat(spark: SparkSession, sf: str) -> DataFrame:
    """Raw sleep-mat rows: patient_id, start_date (minute), state, heart_rate, respiratory_rate, snoring
    ('true'/'false' text), event_id."""
    ev = table(spark, sf, "events")
    return ev.select(F.col("user_id").alias("patient_id"), minute_bin("ts").alias("start_date"),
                     map_strict("event_type", STATE_OF_EVENT).alias("state"),
                     F.col("value").alias("heart_rate"), (F.col("value") / 4.0).alias("respiratory_rate"),
                     F.when(F.col("event_type") == "error", "true").otherwise("false").alias("snoring"),
                     "event_id")


# DuckDB form of base.sleep derived from sleep_mat (one row per patient and minute, state of the last
# event in the minute, snoring = any snoring reading).
SLEEP_SQL = f"""
SELECT user_id AS patient_id, time_bucket(INTERVAL 1 minute, ts) AS start_date,
       sum(CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END) > 0 AS snoring,
       avg(value) AS heart_rate, avg(value / 4.0) AS respiratory_rate,
       arg_max({STATE_SQL}, event_id) AS state
FROM events WHERE user_id IS NOT NULL GROUP BY ALL
HAVING avg(value) IS NOT NULL AND avg(value / 4.0) IS NOT NULL
"""


# ---------------------------------------------------------------- house-sensor views of ``events``
# Fixed mappings for the driver data: door by the props number, rooms and appliances by event type.
ROOM_OF_EVENT = {"view": "living room", "click": "kitchen", "purchase": "bedroom1", "signup": "bathroom1",
                 "error": "office"}


def _k():
    return F.regexp_extract(F.col("props"), r"(\d+)", 1).cast("int")


K_SQL = r"CAST(regexp_extract(props, '(\d+)', 1) AS INTEGER)"
DOOR_SQL = f"""
SELECT 'h' AS home_id, user_id AS patient_id, ts AS start_date,
       CASE WHEN {K_SQL} < 25 THEN 'front door' WHEN {K_SQL} < 50 THEN 'back door'
            WHEN {K_SQL} < 75 THEN 'main door' ELSE 'fridge door' END AS location_name,
       CAST({K_SQL} AS VARCHAR) AS location_id, CASE WHEN event_type = 'view' THEN 'opened' ELSE 'closed' END AS value,
       event_id
FROM events WHERE event_type IN ('view', 'click')"""
ACTIVITY_SQL = ("SELECT 'h' AS home_id, user_id AS patient_id, ts AS start_date, CASE event_type "
                + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ROOM_OF_EVENT.items())
                + " END AS location_name, CAST(event_id AS VARCHAR) AS location_id FROM events")
APPLIANCES_SQL = f"""
SELECT user_id AS patient_id, ts AS start_date, CAST({K_SQL} AS VARCHAR) AS device_type,
       CASE WHEN {K_SQL} < 30 THEN 'microwave-use' WHEN {K_SQL} < 60 THEN 'iron-use' ELSE 'kettle-use' END AS value
FROM events WHERE event_type = 'purchase'"""
DEVICE_TYPES_SQL = "SELECT CAST(p_partkey AS VARCHAR) AS id, p_type AS type FROM part"


def door_view(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events").where(F.col("event_type").isin("view", "click"))
    k = _k()
    loc = (F.when(k < 25, "front door").when(k < 50, "back door").when(k < 75, "main door").otherwise("fridge door"))
    return ev.select(F.lit("h").alias("home_id"), F.col("user_id").alias("patient_id"), F.col("ts").alias("start_date"),
                     loc.alias("location_name"), k.cast("string").alias("location_id"),
                     F.when(F.col("event_type") == "view", "opened").otherwise("closed").alias("value"), "event_id")


def activity_view(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events")
    return ev.select(F.lit("h").alias("home_id"), F.col("user_id").alias("patient_id"), F.col("ts").alias("start_date"),
                     map_strict("event_type", ROOM_OF_EVENT).alias("location_name"),
                     F.col("event_id").cast("string").alias("location_id"))


def appliances_view(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events").where(F.col("event_type") == "purchase")
    k = _k()
    return ev.select(F.col("user_id").alias("patient_id"), F.col("ts").alias("start_date"),
                     k.cast("string").alias("device_type"),
                     F.when(k < 30, "microwave-use").when(k < 60, "iron-use").otherwise("kettle-use").alias("value"))


def device_types_view(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("id"), F.col("p_type").alias("type"))


def environment_view(spark: SparkSession, sf: str) -> DataFrame:
    """Light-style readings: room from the event type ('' for errors: a blank room), value, device by props."""
    ev = table(spark, sf, "events")
    room = F.when(F.col("event_type") == "error", F.lit("")).otherwise(map_strict("event_type", ROOM_OF_EVENT))
    return ev.select(F.lit("h").alias("home_id"), F.col("user_id").alias("patient_id"), F.col("ts").alias("start_date"),
                     room.alias("location_name"), F.col("event_id").cast("string").alias("location_id"),
                     F.col("value"), F.lit("lux").alias("unit"), _k().cast("string").alias("device_type"),
                     F.lit("raw_light").alias("source"))


ENVIRONMENT_SQL = ("SELECT 'h' AS home_id, user_id AS patient_id, ts AS start_date, CASE event_type "
                   + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ROOM_OF_EVENT.items() if k != "error")
                   + " WHEN 'error' THEN '' END AS location_name, CAST(event_id AS VARCHAR) AS location_id, value, "
                   + f"'lux' AS unit, CAST({K_SQL} AS VARCHAR) AS device_type, 'raw_light' AS source FROM events")
