"""Driver-table queries for the legacy recipes (D18-D20, D23) over an observation-export view of ``events``
(subject, location, datetimeObserved text, type code, valueState, valueQuantity text, valueUnit)."""

from __future__ import annotations

from pyspark.sql import functions as F

from homesense.functions.scalars import map_strict
from homesense.plans import driver_tables as dt
from homesense.plans.recipes import legacy as lg
from homesense.plans.registry import register, round_doubles, table

# Fixed mapping of event types onto the legacy observation type codes for the driver view.
CODE_OF_EVENT = {"view": lg.MOTION_CODE, "click": lg.DOOR_CODE, "purchase": lg.TEMPERATURE_CODE,
                 "signup": "29463-7", "error": "8867-4"}
# Fixed observation-type dictionary used with that view.
OBSERVATION_TYPES = [("29463-7", "Body weight"), ("8310-5", "Body temperature"), (lg.MOTION_CODE, "Movement"),
                     (lg.DOOR_CODE, "Door")]
#: With one more code, for appliance use.
APPLIANCE_TYPES = [*OBSERVATION_TYPES, ("8867-4", "Does turn on domestic appliance")]


def observation_view(spark, sf):
    ev = table(spark, sf, "events")
    k = dt._k()
    door = F.when(k < 25, "Front Door").when(k < 50, "Back Door").when(k < 75, "Main Door").otherwise("Fridge Door")
    loc = F.when(F.col("event_type") == "click", door).otherwise(map_strict("event_type", dt.ROOM_OF_EVENT))
    return ev.select(F.concat(F.lit("s"), F.col("user_id").cast("string")).alias("subject"), loc.alias("location"),
                     F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("datetimeObserved"),
                     map_strict("event_type", CODE_OF_EVENT).alias("type"),
                     F.when(k < 50, "Open").otherwise("Close").alias("valueState"),
                     F.col("value").cast("string").alias("valueQuantity"), F.lit("u").alias("valueUnit"))


OBS_SQL = f"""
SELECT 's' || CAST(user_id AS VARCHAR) AS subject,
       CASE WHEN event_type = 'click' THEN
              CASE WHEN {dt.K_SQL} < 25 THEN 'Front Door' WHEN {dt.K_SQL} < 50 THEN 'Back Door'
                   WHEN {dt.K_SQL} < 75 THEN 'Main Door' ELSE 'Fridge Door' END
            ELSE CASE event_type {" ".join(f"WHEN '{a}' THEN '{b}'" for a, b in dt.ROOM_OF_EVENT.items())} END
       END AS location,
       ts, CASE event_type {" ".join(f"WHEN '{a}' THEN '{b}'" for a, b in CODE_OF_EVENT.items())} END AS type,
       CASE WHEN {dt.K_SQL} < 50 THEN 'Open' ELSE 'Close' END AS valueState, value, 'u' AS valueUnit, event_id
FROM events"""


def _types(spark):
    return spark.createDataFrame(OBSERVATION_TYPES, "code string, display string")


@register("legacy_motion", f"""
SELECT DISTINCT subject AS patient_id, location AS location_name, ts AS start_date, 'Europe/London' AS timezone
FROM ({OBS_SQL}) WHERE type = '{lg.MOTION_CODE}' AND location IS NOT NULL
""", "D18", "FIL1", "FIL3", "FIL5", "AG14")
def q_legacy_motion(spark, sf):
    return lg.legacy_motion(observation_view(spark, sf))


@register("legacy_doors", f"""
SELECT patient_id, lower(location_name) AS location_name, start_date, end_date, source, sink,
       source || '>' || sink AS transition, round((epoch_us(end_date) - epoch_us(start_date)) / 1e6, 6) AS dur
FROM (SELECT subject AS patient_id, location AS location_name, ts AS start_date,
             lead(ts) OVER w AS end_date,
             CASE valueState WHEN 'Close' THEN 'closed' WHEN 'Open' THEN 'opened' ELSE valueState END AS source,
             lead(CASE valueState WHEN 'Close' THEN 'closed' WHEN 'Open' THEN 'opened' ELSE valueState END) OVER w
               AS sink
      FROM ({OBS_SQL}) WHERE type = '{lg.DOOR_CODE}' AND location IS NOT NULL
      WINDOW w AS (PARTITION BY subject, location ORDER BY ts, valueState))
WHERE end_date IS NOT NULL
""", "D19", "FIL10", "WN1", "SC15")
def q_legacy_doors(spark, sf):
    return round_doubles(lg.legacy_doors(observation_view(spark, sf)))


@register("legacy_temperature", f"""
SELECT ts AS start_date, type AS device_type, subject AS patient_id, location AS location_name,
       round(value, 6) AS value, valueUnit AS unit, 'raw_ambient_temperature' AS source, 'Europe/London' AS timezone
FROM ({OBS_SQL}) WHERE type = '{lg.TEMPERATURE_CODE}'
""", "D20", "FIL14")
def q_legacy_temperature(spark, sf):
    return round_doubles(lg.legacy_environment(observation_view(spark, sf), lg.TEMPERATURE_CODE,
                                               "raw_ambient_temperature"))


@register("legacy_physiology", f"""
WITH dim AS (SELECT code, arg_min(display, p) AS display FROM (
               SELECT * FROM (VALUES {", ".join(f"('{a}', '{b}', 1)" for a, b in OBSERVATION_TYPES)},
                                     ('8867-4', 'raw_heart_rate', 0)) t(code, display, p)) GROUP BY code)
SELECT ts AS start_date, type AS device_type, subject AS patient_id, round(value, 6) AS value, valueUnit AS unit,
       CASE coalesce(dim.display, type) {" ".join(f"WHEN '{a}' THEN '{b}'" for a, b in lg.PHYSIOLOGY_NAMES.items())}
            ELSE coalesce(dim.display, type) END AS source,
       'Europe/London' AS timezone
FROM ({OBS_SQL}) o LEFT JOIN dim ON o.type = dim.code
WHERE type IN ({", ".join(f"'{c}'" for c in lg.PHYSIOLOGY_CODES)})
""", "D23", "JN9", "FIL10", "FIL2")
def q_legacy_physiology(spark, sf):
    return round_doubles(lg.legacy_physiology(observation_view(spark, sf), _types(spark)))


_ACT_LOCATIONS = ["Front Door", "Back Door", "Main Door", "Fridge Door", "living room", "Oven"]


@register("parse_activity", f"""
WITH o AS ({OBS_SQL}),
c AS (SELECT o.*, d.display FROM o LEFT JOIN (VALUES {", ".join(f"('{a}', '{b}')" for a, b in APPLIANCE_TYPES)})
        d(code, display) ON o.type = d.code
      WHERE coalesce(valueState, CAST(value AS VARCHAR)) IS NOT NULL AND year(ts) > 2014
        AND (type IS NULL OR type <> '{lg.STATUS_CODE}')),
dr AS (SELECT subject, location, ts, lag(ts) OVER w AS pts,
              CASE WHEN valueState IN ('True', 'Open') THEN 'Open' WHEN valueState IN ('False', 'Close') THEN 'Close' END
                AS st,
              lag(CASE WHEN valueState IN ('True', 'Open') THEN 'Open'
                       WHEN valueState IN ('False', 'Close') THEN 'Close' END) OVER w AS pst
       FROM c WHERE display = 'Door' AND subject IS NOT NULL AND location IS NOT NULL
       WINDOW w AS (PARTITION BY subject, location ORDER BY ts)),
ep AS (SELECT 'legacy' AS project, subject, pts AS datetimeObserved, location FROM dr
       WHERE st = 'Close' AND pst = 'Open' AND (epoch_us(ts) - epoch_us(pts)) / 1e6 < 900
         AND location NOT IN ({", ".join(f"'{x}'" for x in lg.EXAMPLE_DOOR_DROP)})),
mv AS (SELECT 'legacy' AS project, subject, ts AS datetimeObserved, location FROM c
       WHERE display = 'Movement' AND location NOT IN ({", ".join(f"'{x}'" for x in lg.EXAMPLE_MOVEMENT_DROP)})),
ap AS (SELECT 'legacy' AS project, subject, ts AS datetimeObserved, 'Oven' AS location FROM c
       WHERE type = '8867-4' AND (valueState = 'Open' OR value <= 50)),
act AS (SELECT * FROM ep UNION ALL SELECT * FROM mv UNION ALL SELECT * FROM ap)
SELECT project, subject, datetimeObserved,
       {", ".join(f'CASE WHEN location = {chr(39)}{x}{chr(39)} THEN 1 ELSE 0 END AS "{x}"' for x in _ACT_LOCATIONS)}
FROM act
""", "D24", "FIL9", "WN13", "AG22")
def q_parse_activity(spark, sf):
    """Errors stand for appliance use here: microwaves, toasters and one device that the example drops."""
    o = observation_view(spark, sf)
    device = F.when(F.col("valueState") == "Open", "Microwave").when(F.col("valueQuantity").cast("double") > 50, "A") \
        .otherwise("Toaster")
    o = o.withColumn("location", F.when(F.col("type") == "8867-4", device).otherwise(F.col("location")))
    return lg.parse_activity(o, spark.createDataFrame(APPLIANCE_TYPES, "code string, display string"), _ACT_LOCATIONS)


@register("clean_observations", f"""
WITH o AS ({OBS_SQL})
SELECT type, subject, location, ts AS datetimeObserved, valueState, round(value, 6) AS value, valueUnit, display,
       1 AS activity, subject AS project_id, display AS device_name, 'legacy' AS project
FROM o LEFT JOIN (VALUES {", ".join(f"('{a}', '{b}')" for a, b in OBSERVATION_TYPES)}) d(code, display) ON o.type = d.code
WHERE coalesce(valueState, CAST(value AS VARCHAR)) IS NOT NULL AND year(ts) > 2014
  AND (type IS NULL OR type <> '{lg.STATUS_CODE}')
""", "FIL9", "FIL14")
def q_clean_observations(spark, sf):
    d = lg.clean_observations(observation_view(spark, sf), _types(spark))
    return round_doubles(d.withColumn("value", F.col("valueQuantity").cast("double")).drop("valueQuantity"))


# Fixed flag-type dictionary for the flags view (codes not listed stay as their code).
FLAG_TYPES = [("0", "Other"), ("5", "Fall")]


@register("legacy_flags", f"""
WITH f AS (SELECT doc_id AS flagId, quality + 1 AS category, toxic * 8 AS type FROM labels),
v AS (SELECT doc_id AS flag, lang AS valid, source FROM documents),
dim AS (SELECT code, arg_min(display, p) AS display FROM (
          SELECT * FROM (VALUES {", ".join(f"('{a}', '{b}', 1)" for a, b in FLAG_TYPES)},
                                {", ".join(f"('{a}', '{b}', 0)" for a, b in lg.FLAG_TYPE_OVERRIDES.items())})
          t(code, display, p)) GROUP BY code),
j AS (SELECT f.flagId, f.category, f.type, v.flag, v.valid, v.source FROM f FULL OUTER JOIN v ON f.flagId = v.flag)
SELECT flagId, CASE CAST(category AS VARCHAR) {" ".join(f"WHEN '{a}' THEN '{b}'" for a, b in lg.FLAG_CATEGORIES.items())}
                    ELSE CAST(category AS VARCHAR) END AS category,
       coalesce(dim.display, CAST(j.type AS VARCHAR)) AS type, flag, valid, source, 'driver' AS project_id
FROM j LEFT JOIN dim ON CAST(j.type AS VARCHAR) = dim.code
""", "D21", "JN3", "JN9", "FIL10")
def q_legacy_flags(spark, sf):
    lab = table(spark, sf, "labels")
    flags = lab.select(F.col("doc_id").alias("flagId"), (F.col("quality") + 1).alias("category"),
                       (F.col("toxic") * 8).alias("type"))
    val = table(spark, sf, "documents").select(F.col("doc_id").alias("flag"), F.col("lang").alias("valid"), "source")
    ftype = spark.createDataFrame(FLAG_TYPES, "code string, display string")
    return lg.legacy_flags({"driver": (flags, ftype, val)})


@register("legacy_wellbeing", """
WITH q AS (SELECT DISTINCT conv_id AS subject, TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(turn // 2 AS BIGINT))
                    AS datetimeAnswered, role AS question, text AS answer FROM conversations)
SELECT subject, datetimeAnswered, max(answer) FILTER (WHERE question = 'user') AS "user",
       max(answer) FILTER (WHERE question = 'assistant') AS assistant,
       max(answer) FILTER (WHERE question = 'system') AS system, 'driver' AS project
FROM q GROUP BY subject, datetimeAnswered
""", "D22", "AG23", "AG14")
def q_legacy_wellbeing(spark, sf):
    conv = table(spark, sf, "conversations")
    q = conv.select(F.lit("w").alias("questionnaire"), F.lit("").alias("datetimeReceived"),
                    F.col("conv_id").alias("subject"),
                    F.date_format(F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
                                  + F.make_dt_interval(F.lit(0), F.floor(F.col("turn") / 2).cast("int")),
                                  "yyyy-MM-dd HH:mm:ss").alias("datetimeAnswered"),
                    F.col("role").alias("question"), F.col("text").alias("answer"))
    return lg.legacy_wellbeing({"driver": q}, ["user", "assistant", "system"])
