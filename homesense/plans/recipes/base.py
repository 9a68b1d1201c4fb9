"""Base-domain recipes (D1-D4, D7-D10): functions of parent DataFrames returning lazy DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homesense.functions.scalars import map_replace, not_blank_keep_null, not_in_keep_null
from homesense.functions.time import localize_zones
from homesense.operators.lookups import lookup_replace, union_all, unpivot_pairs
from homesense.operators.sequences import transitions

# Fixed values of the base recipes.
ENTRY_DOORS = ("front door", "back door", "main door")
MAIN_DOOR, FRONT_DOOR = "main door", "front door"
DOOR_CLOSING = "opened>closed"
KITCHEN_ROOMS = ("kitchen", "dining room")
FRIDGE_DOOR = "fridge door"
APPLIANCE_MAP = {"microwave-use": "oven-use", "toaster-use": "oven-use", "iron-use": None,
                 "multi-use socket-use": None}
MOTION_ROOMS = {"bathroom1": "Bathroom", "WC1": "Bathroom", "kitchen": "Kitchen", "hallway": "Hallway",
                "corridor1": "Hallway", "dining room": "Lounge", "living room": "Lounge", "lounge": "Lounge",
                "bedroom1": "Bedroom", "front door": "Front door", "back door": "Back door"}
MOTION_DROPPED = ("office", "conservatory", "study", "cellar")
BP_SOURCES = {"systolic_value": "systolic_bp", "diastolic_value": "diastolic_bp"}
LONDON = "Europe/London"


def _localized(df: DataFrame, tz: str | None = LONDON, col: str = "start_date") -> DataFrame:
    """``localize_zones`` without a zone list: every row in London time, plus a ``timezone`` column."""
    return df if tz is None else localize_zones(df, [col], None, tz)


def _map_devices(df: DataFrame, device_types: DataFrame) -> DataFrame:
    return lookup_replace(df, "device_type", device_types, "id", "type")


def process_doors(door: DataFrame, tz: str | None = LONDON, tiebreak: str | None = None) -> DataFrame:
    """Door open/close transitions per patient and door."""
    d = _localized(door, tz)
    return transitions(d, ["patient_id", "location_name"], "start_date", "value", tiebreak=tiebreak)


def process_entryway(doors: DataFrame) -> DataFrame:
    """Closings of the entrance doors; 'main door' is the front door."""
    d = doors.where(F.col("location_name").isin(list(ENTRY_DOORS)))
    d = d.withColumn("location_name", F.replace(F.col("location_name"), F.lit(MAIN_DOOR), F.lit(FRONT_DOOR)))
    return d.where(F.col("transition") == DOOR_CLOSING)


def process_environment(readings: DataFrame, device_types: DataFrame, tz: str | None = LONDON) -> DataFrame:
    """D3: light / temperature readings with device types, blank rooms dropped, localised."""
    d = _map_devices(readings, device_types).where(not_blank_keep_null("location_name"))
    return _localized(d.withColumn("value", F.col("value").cast("double")), tz)


def process_kitchen(appliances: DataFrame, doors: DataFrame, activity: DataFrame, device_types: DataFrame,
                    tz: str | None = LONDON, tiebreak: str | None = "activity") -> DataFrame:
    """Kitchen activity stream (fridge-door closings, PIR in kitchen / dining room, appliance use
    with microwave / toaster as oven and iron / socket dropped) as transitions per patient, with the
    device type of the source event. All three branches are localised [Q-11]."""
    act = _localized(activity, tz).where(F.col("location_name").isin(list(KITCHEN_ROOMS)))
    act = act.select("patient_id", "start_date", F.lit("pir").alias("device_type"),
                     F.col("location_name").alias("activity"))
    dr = doors.where((F.col("location_name") == FRIDGE_DOOR) & (F.col("transition") == DOOR_CLOSING))
    dr = dr.select("patient_id", "start_date", F.lit("door").alias("device_type"),
                   F.col("location_name").alias("activity"))
    app = _localized(_map_devices(appliances, device_types), tz)
    app = app.select("patient_id", "start_date", "device_type",
                     map_replace(F.col("value").cast("string"), APPLIANCE_MAP).alias("activity")).na.drop()
    k = union_all([dr, act, app]).where(not_blank_keep_null("patient_id") & F.col("patient_id").isNotNull())
    return transitions(k, ["patient_id"], "start_date", "activity", covariates=["device_type"], tiebreak=tiebreak)


def process_motion(activity: DataFrame, entryway: DataFrame, bed_occupancy: DataFrame,
                   tz: str | None = LONDON) -> DataFrame:
    """Room presence stream: PIR activity, entrance door closings and bed edges; rooms renamed,
    four rooms dropped (null rooms kept)."""
    fact = ["patient_id", "location_name", "start_date"]
    m = union_all([_localized(activity, tz).select(*fact), entryway.select(*fact), bed_occupancy.select(*fact)])
    m = m.withColumn("location_name", map_replace("location_name", MOTION_ROOMS))
    return m.where(not_in_keep_null("location_name", MOTION_DROPPED))


def process_transitions(motion: DataFrame) -> DataFrame:
    """Room-to-room transitions per patient; rows of one time are ordered by room."""
    return transitions(motion, ["patient_id"], "start_date", "location_name", tiebreak="location_name")


def process_physiology(vital_signs: DataFrame, blood_pressure: DataFrame, device_types: DataFrame,
                       tz: str | None = LONDON) -> DataFrame:
    """Vital signs plus blood pressure unpivoted into systolic_bp / diastolic_bp rows."""
    vit = _map_devices(vital_signs, device_types)
    bp = _map_devices(blood_pressure, device_types)
    ids = ["home_id", "patient_id", "start_date", "unit", "device_type"]
    bp = unpivot_pairs(bp.select(*ids, *BP_SOURCES), ids, BP_SOURCES)
    cols = ["home_id", "patient_id", "start_date", "value", "unit", "device_type", "source"]
    u = union_all([vit.select(*cols), bp.select(*cols)]).withColumn("value", F.col("value").cast("double"))
    return _localized(u, tz)


def process_habitat(light: DataFrame, temperature: DataFrame, device_types: DataFrame) -> DataFrame:
    """Light and temperature readings in one table (registered here, unlike the reference [Q-22])."""
    a = _map_devices(light, device_types).where(not_blank_keep_null("location_name"))
    b = _map_devices(temperature, device_types).where(not_blank_keep_null("location_name"))
    return union_all([a, b]).withColumn("value", F.col("value").cast("double"))
