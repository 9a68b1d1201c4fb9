"""Driver-table queries for the composite base recipes (D1-D4, D7, D9, D10) over the house-sensor views
of the driver tables (:mod:`homesense.plans.driver_tables`). Events are January readings (London offset 0);
the blood-pressure view from ``lineitem`` spans summers, so the physiology oracle applies the local-time
rule too."""

from __future__ import annotations

from pyspark.sql import functions as F

from homesense.plans import driver_tables as dt
from homesense.plans import q_scalars, q_segments, q_stats
from homesense.plans.recipes import base
from homesense.plans.recipes.sleep import process_bed_occupancy
from homesense.plans.registry import register, round_doubles, table

_TR = """SELECT {keys}, start_date, end_date, source, sink, source || '>' || sink AS transition,
       round((epoch_us(end_date) - epoch_us(start_date)) / 1e6, 6) AS dur
FROM (SELECT {keys}, start_date, lead(start_date) OVER w AS end_date, coalesce({v}, 'nan') AS source,
             lead(coalesce({v}, 'nan')) OVER w AS sink {cov}
      FROM {src} WINDOW w AS (PARTITION BY {keys} ORDER BY start_date, {tb}))
WHERE end_date IS NOT NULL"""

DOORS_SQL = _TR.format(keys="patient_id, location_name", v="value", cov="", tb="event_id",
                       src=f"({dt.DOOR_SQL})")
ENTRYWAY_SQL = f"""SELECT patient_id, replace(location_name, 'main door', 'front door') AS location_name, start_date,
       end_date, source, sink, transition, dur
FROM ({DOORS_SQL}) WHERE location_name IN ('front door', 'back door', 'main door') AND transition = 'opened>closed'"""


def doors(spark, sf):
    return base.process_doors(dt.door_view(spark, sf), tiebreak="event_id")


@register("doors", DOORS_SQL, "D1", "SC8", "WN1")
def q_doors(spark, sf):
    return round_doubles(doors(spark, sf))


def entryway(spark, sf):
    return base.process_entryway(doors(spark, sf))


@register("entryway", ENTRYWAY_SQL, "D2", "FIL2", "FIL3", "SC15")
def q_entryway(spark, sf):
    return round_doubles(entryway(spark, sf))


_DIM_SQL = (r"SELECT id, replace(regexp_replace(max(type), '\"|\[|\]', '', 'g'), ' ', '_') AS t "
            f"FROM ({dt.DEVICE_TYPES_SQL}) WHERE id IS NOT NULL GROUP BY id").replace('\\"', '"')


@register("kitchen", f"""
WITH dr AS (SELECT patient_id, start_date, 'door' AS device_type, location_name AS activity FROM ({DOORS_SQL})
            WHERE location_name = 'fridge door' AND transition = 'opened>closed'),
act AS (SELECT patient_id, start_date, 'pir' AS device_type, location_name AS activity FROM ({dt.ACTIVITY_SQL})
        WHERE location_name IN ('kitchen', 'dining room')),
dim AS ({_DIM_SQL}),
app AS (SELECT a.patient_id, a.start_date, coalesce(dim.t, a.device_type) AS device_type,
               CASE a.value WHEN 'microwave-use' THEN 'oven-use' WHEN 'toaster-use' THEN 'oven-use'
                            WHEN 'iron-use' THEN NULL WHEN 'multi-use socket-use' THEN NULL ELSE a.value END AS activity
        FROM ({dt.APPLIANCES_SQL}) a LEFT JOIN dim ON a.device_type = dim.id),
k AS (SELECT * FROM dr UNION ALL SELECT * FROM act
      UNION ALL SELECT * FROM app WHERE patient_id IS NOT NULL AND start_date IS NOT NULL AND device_type IS NOT NULL
                                    AND activity IS NOT NULL)
SELECT patient_id, start_date, end_date, source, sink, device_type, source || '>' || sink AS transition,
       round((epoch_us(end_date) - epoch_us(start_date)) / 1e6, 6) AS dur
FROM (SELECT patient_id, start_date, lead(start_date) OVER w AS end_date, coalesce(activity, 'nan') AS source,
             lead(coalesce(activity, 'nan')) OVER w AS sink, device_type
      FROM k WHERE patient_id IS NOT NULL WINDOW w AS (PARTITION BY patient_id ORDER BY start_date, activity))
WHERE end_date IS NOT NULL AND device_type IS NOT NULL
""", "D4", "JN1", "FIL10", "ST1")
def q_kitchen(spark, sf):
    k = base.process_kitchen(dt.appliances_view(spark, sf), doors(spark, sf), dt.activity_view(spark, sf),
                             dt.device_types_view(spark, sf))
    return round_doubles(k)


_ROOM_CASE = ("CASE location_name " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in base.MOTION_ROOMS.items())
              + " ELSE location_name END")


_MOTION_SQL = f"""
WITH {q_segments.SLEEP_CHAIN_SQL},
m AS (SELECT patient_id, location_name, start_date FROM ({dt.ACTIVITY_SQL})
      UNION ALL SELECT patient_id, location_name, start_date FROM ({ENTRYWAY_SQL})
      UNION ALL SELECT patient_id, location_name, start_date FROM edges),
r AS (SELECT patient_id, {_ROOM_CASE} AS location_name, start_date FROM m)
SELECT * FROM r WHERE location_name IS NULL OR location_name NOT IN ('office', 'conservatory', 'study', 'cellar')
"""


@register("motion", _MOTION_SQL, "D7", "FIL10", "FIL2", "ST1")
def q_motion(spark, sf):
    bed = process_bed_occupancy(q_segments.base_sleep(spark, sf), ["patient_id"], one_row_per_minute=True)
    return base.process_motion(dt.activity_view(spark, sf), entryway(spark, sf), bed)


@register("room_transitions", f"""
SELECT patient_id, start_date, end_date, source, sink, source || '>' || sink AS transition, round(dur, 6) AS dur
FROM (SELECT patient_id, start_date, lead(start_date) OVER w AS end_date, coalesce(location_name, 'nan') AS source,
             lead(coalesce(location_name, 'nan')) OVER w AS sink,
             (epoch_us(lead(start_date) OVER w) - epoch_us(start_date)) / 1e6 AS dur
      FROM ({_MOTION_SQL}) WHERE patient_id IS NOT NULL
      WINDOW w AS (PARTITION BY patient_id ORDER BY start_date, location_name NULLS FIRST))
WHERE end_date IS NOT NULL
""", "D8")
def q_room_transitions(spark, sf):
    return round_doubles(base.process_transitions(q_motion(spark, sf)))


_LOCAL = (f"(SELECT *, t + ({q_scalars._local_of_utc('u')} - u) AS start_date "
          f"FROM (SELECT *, {q_scalars._U} AS u FROM ({{src}})))")
_VITALS_SQL = (f"SELECT 'h' AS home_id, user_id AS patient_id, ts AS t, value, 'u' AS unit, "
               f"CAST({dt.K_SQL} AS VARCHAR) AS device_type, {q_stats._SRC_CASE} AS source FROM events")
_BP_SQL = """SELECT 'h' AS home_id, l_suppkey AS patient_id, l_shipdate AS t, l_extendedprice / 100 AS systolic_value,
       l_quantity AS diastolic_value, 'mmHg' AS unit, CAST(l_partkey AS VARCHAR) AS device_type FROM lineitem"""


def _vitals(spark, sf):
    ev = table(spark, sf, "events")
    return ev.select(F.lit("h").alias("home_id"), F.col("user_id").alias("patient_id"), F.col("ts").alias("start_date"),
                     "value", F.lit("u").alias("unit"), dt._k().cast("string").alias("device_type"),
                     dt.map_strict("event_type", q_stats.SOURCE_OF_EVENT).alias("source"))


def _blood_pressure(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(F.lit("h").alias("home_id"), F.col("l_suppkey").alias("patient_id"),
                     F.col("l_shipdate").alias("start_date"), (F.col("l_extendedprice") / 100).alias("systolic_value"),
                     F.col("l_quantity").alias("diastolic_value"), F.lit("mmHg").alias("unit"),
                     F.col("l_partkey").cast("string").alias("device_type"), F.lit("raw_blood_pressure").alias("source"))


@register("physiology", f"""
WITH dim AS ({_DIM_SQL}),
v AS (SELECT v.home_id, v.patient_id, v.t, v.value, v.unit, coalesce(dim.t, v.device_type) AS device_type, v.source
      FROM ({_VITALS_SQL}) v LEFT JOIN dim ON v.device_type = dim.id),
b AS (SELECT b.home_id, b.patient_id, b.t, b.systolic_value, b.diastolic_value, b.unit,
             coalesce(dim.t, b.device_type) AS device_type FROM ({_BP_SQL}) b LEFT JOIN dim ON b.device_type = dim.id),
u AS (SELECT home_id, patient_id, t, value, unit, device_type, source FROM v
      UNION ALL SELECT home_id, patient_id, t, systolic_value, unit, device_type, 'systolic_bp' FROM b
      UNION ALL SELECT home_id, patient_id, t, diastolic_value, unit, device_type, 'diastolic_bp' FROM b)
SELECT home_id, patient_id, start_date, round(value, 6) AS value, unit, device_type, source,
       'Europe/London' AS timezone
FROM {_LOCAL.format(src="SELECT * FROM u")}
""", "D9", "AG24", "JN1", "SC8")
def q_physiology(spark, sf):
    return round_doubles(base.process_physiology(_vitals(spark, sf), _blood_pressure(spark, sf),
                                                 dt.device_types_view(spark, sf)))


_ENV_COLS = "home_id, patient_id, start_date, location_name, location_id, value, unit, device_type, source"
_ENV_MAPPED = f"""SELECT e.home_id, e.patient_id, e.start_date, e.location_name, e.location_id, e.value, e.unit,
       coalesce(dim.t, e.device_type) AS device_type, e.source
FROM ({{src}}) e LEFT JOIN dim ON e.device_type = dim.id
WHERE e.location_name IS NULL OR e.location_name <> ''"""


@register("light_base", f"""
WITH dim AS ({_DIM_SQL}), m AS ({_ENV_MAPPED.format(src=dt.ENVIRONMENT_SQL)})
SELECT home_id, patient_id, start_date, location_name, location_id, round(value, 6) AS value, unit, device_type,
       source, 'Europe/London' AS timezone FROM m
""", "D3", "JN1", "FIL3", "SCH1")
def q_light_base(spark, sf):
    return round_doubles(base.process_environment(dt.environment_view(spark, sf), dt.device_types_view(spark, sf)))


@register("habitat", f"""
WITH dim AS ({_DIM_SQL}),
a AS ({_ENV_MAPPED.format(src=dt.ENVIRONMENT_SQL)}),
b AS ({_ENV_MAPPED.format(src=f"SELECT {_ENV_COLS.replace('value', 'value / 4.0 AS value').replace('source', chr(39) + 'raw_ambient_temperature' + chr(39) + ' AS source')} FROM ({dt.ENVIRONMENT_SQL})")})
SELECT home_id, patient_id, start_date, location_name, location_id, round(value, 6) AS value, unit, device_type, source
FROM (SELECT * FROM a UNION ALL SELECT * FROM b)
""", "D10", "ST1")
def q_habitat(spark, sf):
    light = dt.environment_view(spark, sf)
    temp = light.withColumn("value", F.col("value") / 4.0).withColumn("source", F.lit("raw_ambient_temperature"))
    return round_doubles(base.process_habitat(light, temp, dt.device_types_view(spark, sf)))
