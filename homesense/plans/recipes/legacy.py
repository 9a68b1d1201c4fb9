"""Legacy-domain recipes (D17-D24): zipped CSV exports of an earlier study, turned into the same tables
as the live sources. Archives are read with :func:`homesense.sources.readers.read_zip_csv`."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from homesense.functions.scalars import map_replace
from homesense.functions.time import localize
from homesense.operators.lookups import (full_outer_suffixed, lookup_override, one_hot, pivot_answers,
                                         union_all)
from homesense.operators.sequences import door_episodes, transitions
from homesense.plans.recipes.base import process_entryway
from homesense.sources.readers import read_zip_csv

# Observation type codes and lookups of the legacy export.
MOTION_CODE, DOOR_CODE = "272149007-2", "224751004"
TEMPERATURE_CODE, LIGHT_CODE, STATUS_CODE = "60832-3", "56242006", "724061007"
DOOR_WORDS = {"Close": "closed", "Open": "opened"}
FLAG_CATEGORIES = {"1": "Clinical", "2": "Null", "3": "Technical"}
FLAG_TYPE_OVERRIDES = {"8": "Blood Oxygen Saturation", "24": "Shingles"}
PHYSIOLOGY_CODES = ("8310-5", "150456", "55284-4", "29463-7", "251837008", "163636005", "8462-4", "8480-6",
                    "8867-4")
PHYSIOLOGY_CODE_OVERRIDES = {"8867-4": "raw_heart_rate"}
PHYSIOLOGY_NAMES = {"Body temperature": "raw_body_temperature", "Total body water": "raw_total_body_water",
                    "Systolic blood pressure": "systolic_bp", "Diastolic blood pressure": "diastolic_bp",
                    "MDC_PULS_OXIM_SAT_O2": "raw_oxygen_saturation", "O/E - muscle mass": "raw_body_muscle_mass",
                    "Body weight": "raw_body_weight"}
VALUE_COLUMNS = ("valueBoolean", "valueState", "valueQuantity", "valueDatetimeStart", "valueDatetimeEnd")
EXAMPLE_DOOR_DROP = ("B", "Bathroom", "C", "Dining Room")
EXAMPLE_APPLIANCE_DROP = ("A", "B")
EXAMPLE_MOVEMENT_DROP = ("D", "Study", "Living Room", "Front Door", "Dining Room")
EXAMPLE_OVEN = {"Microwave": "Oven", "Toaster": "Oven"}
LONDON = "Europe/London"


def _ts(col: str):
    return F.to_timestamp_ntz(F.col(col).cast("string"))


def process_observation(spark: SparkSession, archives: Sequence[str]) -> DataFrame:
    """The Observations.csv member of every archive, unioned by column name (columns as text); an archive
    without a column gives null there."""
    return read_zip_csv(spark, list(archives), "Observations.csv", infer=False)


def process_device_type(spark: SparkSession, archive: str) -> DataFrame:
    """Code -> display lookup of observation types."""
    return read_zip_csv(spark, archive, "Observation-type.csv", infer=False).select("code", "display")


def legacy_motion(observation: DataFrame, tz: str = LONDON) -> DataFrame:
    """PIR observations as (patient_id, location_name, start_date), localised, de-duplicated."""
    d = observation.where((F.col("type") == MOTION_CODE) & F.col("location").isNotNull())
    d = d.select(F.col("subject").alias("patient_id"), F.col("location").alias("location_name"),
                 _ts("datetimeObserved").alias("start_date"))
    return d.withColumn("start_date", localize("start_date", tz)).withColumn("timezone", F.lit(tz)).dropDuplicates()


def legacy_doors(observation: DataFrame, tz: str = LONDON) -> DataFrame:
    """Door open/close transitions per patient and door; door names lower-cased, rows of one time ordered
    by state."""
    d = observation.where((F.col("type") == DOOR_CODE) & F.col("location").isNotNull())
    d = d.select(F.col("subject").alias("patient_id"), F.col("location").alias("location_name"),
                 localize(_ts("datetimeObserved"), tz).alias("start_date"),
                 map_replace("valueState", DOOR_WORDS).alias("value"))
    t = transitions(d, ["patient_id", "location_name"], "start_date", "value", tiebreak="value")
    return t.withColumn("location_name", F.lower("location_name"))


def legacy_entryway(doors: DataFrame) -> DataFrame:
    """Entrance door closings of the legacy doors."""
    return process_entryway(doors)


def legacy_environment(observation: DataFrame, code: str, source: str, tz: str = LONDON) -> DataFrame:
    """Temperature ('60832-3' -> raw_ambient_temperature) or light ('56242006' -> raw_light)."""
    d = observation.where(F.col("type") == code).select(
        localize(_ts("datetimeObserved"), tz).alias("start_date"), F.col("type").alias("device_type"),
        F.col("subject").alias("patient_id"), F.col("location").alias("location_name"),
        F.col("valueQuantity").try_cast("double").alias("value"), F.col("valueUnit").alias("unit"))
    return d.withColumn("source", F.lit(source)).withColumn("timezone", F.lit(tz))


def legacy_flags(projects: Mapping[str, tuple[DataFrame, DataFrame, DataFrame]]) -> DataFrame:
    """Per project, flags full-outer-joined with their validations (shared names suffixed), category
    codes named, type codes shown through the flag-type dictionary with overrides; projects unioned."""
    out = []
    for project, (flags, flag_type, validations) in projects.items():
        j = full_outer_suffixed(flags, validations, "flagId", "flag", ("df", "_val"))
        cat_col = "category" if "category" in j.columns else "categorydf"  # suffixed when validations share it
        if cat_col in j.columns:
            j = j.withColumn(cat_col, map_replace(F.col(cat_col).cast("string"), FLAG_CATEGORIES))
        over = flags.sparkSession.createDataFrame(list(FLAG_TYPE_OVERRIDES.items()), "code string, display string")
        dim = lookup_override(flag_type.select(F.col("code").cast("string").alias("code"),
                                               F.col("display").cast("string").alias("display")), over,
                              "code", "display")
        j = j.withColumn("__code", F.col("type").cast("string")).join(
            dim.withColumnRenamed("code", "__code"), "__code", "left")
        j = j.withColumn("type", F.coalesce(F.col("display"), F.col("type").cast("string"))).drop("__code", "display")
        out.append(j.withColumn("project_id", F.lit(project)))
    return union_all(out)


def legacy_wellbeing(projects: Mapping[str, DataFrame], questions: Sequence[str]) -> DataFrame:
    """Questionnaire answers pivoted to one column per question per (subject, answered time)."""
    out = []
    for project, df in projects.items():
        answer = [c for c in df.columns if c not in ("questionnaire", "datetimeReceived", "subject",
                                                      "datetimeAnswered", "question")][0]
        d = df.select("subject", _ts("datetimeAnswered").alias("datetimeAnswered"), "question", answer)
        w = pivot_answers(d, ["subject", "datetimeAnswered"], "question", answer, questions)
        out.append(w.withColumn("project", F.lit(project)))
    return union_all(out)


def legacy_physiology(observation: DataFrame, device_type: DataFrame, tz: str = LONDON) -> DataFrame:
    """Vital-sign observations with the source named through the type dictionary (with the
    heart-rate override [Q-16]) and mapped to the live source names."""
    over = observation.sparkSession.createDataFrame(list(PHYSIOLOGY_CODE_OVERRIDES.items()), "code string, display string")
    dim = lookup_override(device_type, over, "code", "display")
    d = observation.where(F.col("type").isin(list(PHYSIOLOGY_CODES)))
    d = d.join(dim.withColumnRenamed("code", "type"), "type", "left")
    src = map_replace(F.coalesce(F.col("display"), F.col("type")), PHYSIOLOGY_NAMES)
    return d.select(localize(_ts("datetimeObserved"), tz).alias("start_date"), F.col("type").alias("device_type"),
                    F.col("subject").alias("patient_id"), F.col("valueQuantity").try_cast("double").alias("value"),
                    F.col("valueUnit").alias("unit"), src.alias("source")).withColumn("timezone", F.lit(tz))


def clean_observations(df: DataFrame, device_type: DataFrame) -> DataFrame:
    """FIL9: drop rows without any value, keep years after 2014, drop device-status rows, add the activity
    flag, project columns and the type display (strict lookup: unknown codes -> null)."""
    d = df.where(F.coalesce(*[F.col(c) for c in VALUE_COLUMNS if c in df.columns]).isNotNull())
    d = d.withColumn("datetimeObserved", _ts("datetimeObserved"))
    d = d.where((F.year("datetimeObserved") > 2014) & ~F.coalesce(F.col("type") == STATUS_CODE, F.lit(False)))
    dim = device_type.groupBy("code").agg(F.max("display").alias("display"))
    d = d.join(dim.withColumnRenamed("code", "type"), "type", "left")
    return (d.withColumn("activity", F.lit(1)).withColumn("project_id", F.col("subject"))
            .withColumn("device_name", F.col("display")).withColumn("project", F.lit("legacy")))


def parse_activity(observation: DataFrame, device_type: DataFrame, locations: Sequence[str]) -> DataFrame:
    """Door episodes (< 15 min), appliance use (microwave / toaster as oven) and movement, with
    the example's room exclusions, one-hot encoded over ``locations``."""
    df = clean_observations(observation, device_type)
    # door states come as 'True'/'False' in one export and 'Open'/'Close' in the other
    st = F.col("valueState")
    doors = df.where(F.col("display") == "Door").withColumn(
        "__state", F.when(st.isin("True", "Open"), "Open").when(st.isin("False", "Close"), "Close"))
    ep = door_episodes(doors, ["subject", "location", "project"], "datetimeObserved", "__state", max_seconds=900)
    ep = ep.where(~F.col("location").isin(list(EXAMPLE_DOOR_DROP))).select(
        "project", "subject", F.col("start_date").alias("datetimeObserved"), "location")
    app = df.where(F.col("display") == "Does turn on domestic appliance").where(
        ~F.col("location").isin(list(EXAMPLE_APPLIANCE_DROP)))
    app = app.select("project", "subject", "datetimeObserved", map_replace("location", EXAMPLE_OVEN).alias("location"))
    mov = df.where(F.col("display") == "Movement").where(~F.col("location").isin(list(EXAMPLE_MOVEMENT_DROP)))
    mov = mov.select("project", "subject", "datetimeObserved", "location")
    act = union_all([ep, mov, app])
    return one_hot(act, "location", list(locations)).drop("location")


__all__ = ["process_observation", "process_device_type", "legacy_motion", "legacy_doors", "legacy_entryway",
           "legacy_environment", "legacy_flags", "legacy_wellbeing", "legacy_physiology", "clean_observations",
           "parse_activity"]
