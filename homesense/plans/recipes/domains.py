"""The base, profile, bed-habits and legacy domains as registered datasets: each recipe with its parents, on a catalogue
whose ``raw`` and ``lookup`` sources the caller has registered (the legacy domain brings its own). Base and profile recipes
derive a patient's rows from that patient's (and the lookups), so with sources keyed alike an update derives only the
touched patients anew. The bed-habits labels compare a patient with the cohort, so they are rebuilt whole."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import functions as F

from homesense.operators import resample as rs
from homesense.plans.recipes import base, bed_habits, legacy, profile, sleep
from homesense.sources.catalog import Catalog
from homesense.sources.readers import read_zip_csv

KEYS = ("patient_id",)
# Rooms of the daily activity table, in output order.
ACTIVITY_ROOMS = ("Bathroom", "Bedroom", "Hallway", "Kitchen", "Lounge")


def register_base(c: Catalog, tz: str | None = base.LONDON, sleep_tiebreak: str | None = None,
                  door_tiebreak: str | None = None) -> None:
    """Doors, entryway, temperature, light, kitchen, sleep, bed occupancy, motion, physiology, habitat, transitions."""
    raw = {n: (n, "raw") for n in ("door", "activity", "appliances", "ambient_temperature", "light", "vital_signs",
                                   "blood_pressure", "sleep_mat")}
    devices = ("device_types", "lookup")
    c.recipe("base", "doors", [raw["door"]], keys=KEYS)(lambda door: base.process_doors(door, tz, door_tiebreak))
    c.recipe("base", "entryway", [("doors", "base")], keys=KEYS)(base.process_entryway)
    c.recipe("base", "temperature", [raw["ambient_temperature"], devices], keys=KEYS)(
        lambda ambient_temperature, device_types: base.process_environment(ambient_temperature, device_types, tz))
    c.recipe("base", "light", [raw["light"], devices], keys=KEYS)(
        lambda light, device_types: base.process_environment(light, device_types, tz))
    c.recipe("base", "kitchen", [raw["appliances"], ("doors", "base"), raw["activity"], devices], keys=KEYS)(
        lambda appliances, doors, activity, device_types: base.process_kitchen(appliances, doors, activity, device_types, tz))
    c.recipe("base", "sleep", [raw["sleep_mat"]], keys=KEYS)(
        lambda sleep_mat: sleep.process_sleep(sleep_mat, tiebreak=sleep_tiebreak, tz=tz))
    c.recipe("base", "bed_occupancy", [("sleep", "base")], keys=KEYS)(
        lambda sleep: _edges(sleep))
    c.recipe("base", "motion", [raw["activity"], ("entryway", "base"), ("bed_occupancy", "base")], keys=KEYS)(
        lambda activity, entryway, bed_occupancy: base.process_motion(activity, entryway, bed_occupancy, tz))
    c.recipe("base", "physiology", [raw["vital_signs"], raw["blood_pressure"], devices], keys=KEYS)(
        lambda vital_signs, blood_pressure, device_types: base.process_physiology(vital_signs, blood_pressure, device_types, tz))
    c.recipe("base", "habitat", [raw["light"], raw["ambient_temperature"], devices], keys=KEYS)(
        lambda light, ambient_temperature, device_types: base.process_habitat(light, ambient_temperature, device_types))
    c.recipe("base", "transitions", [("motion", "base")], keys=KEYS)(base.process_transitions)


def _edges(minutes):
    # localised minutes repeat in the hour that autumn repeats, so they are counted
    return sleep.process_bed_occupancy(minutes)


def register_profile(c: Catalog, gap_hours: float = 1.0, rooms=ACTIVITY_ROOMS) -> None:
    """Daily and weekly activity, nightly sleep and its model, daily physiology, light and temperature profiles."""
    key = ["patient_id"]
    c.recipe("profile", "activity_dailies", [("motion", "base")], keys=KEYS)(
        lambda motion: rs.activity_dailies(motion, key, "start_date", "location_name", rooms))
    c.recipe("profile", "activity_weeklies", [("activity_dailies", "profile")], keys=KEYS)(
        lambda activity_dailies: profile.weeklies(activity_dailies))
    c.recipe("profile", "sleep_dailies", [("sleep", "base"), ("bed_occupancy", "base")], keys=KEYS)(
        lambda sleep, bed_occupancy: _dailies(sleep, bed_occupancy, gap_hours))
    c.recipe("profile", "physiology_dailies", [("physiology", "base"), ("sleep_dailies", "profile")], keys=KEYS)(
        lambda physiology, sleep_dailies: profile.physiology_dailies(physiology, sleep_dailies))
    c.recipe("profile", "sleep_model", [("sleep_dailies", "profile")], keys=KEYS)(
        lambda sleep_dailies: profile.sleep_model(sleep_dailies))
    c.recipe("profile", "light", [("light", "base")], keys=KEYS)(lambda light: profile.habitat_profile(light))
    c.recipe("profile", "temperature", [("temperature", "base")], keys=KEYS)(lambda temperature: profile.habitat_profile(temperature))


def _dailies(minutes, edges, gap_hours: float):
    return sleep.process_sleep_dailies(minutes, edges, gap_hours=gap_hours)


def register_bed_habits(c: Catalog) -> None:
    """Hours in bed per night with their labels against the cohort's quartiles."""
    c.recipe("bed_habits", "bed_occupancy", [("sleep", "base")])(lambda sleep: bed_habits.process_outcome(sleep))


def register_legacy(c: Catalog, archives: Mapping[str, str], tz: str = legacy.LONDON, types_of: str | None = None,
                    flags_of: Sequence[str] | None = None, wellbeing_of: Sequence[str] | None = None) -> None:
    """Observations, device types, flags and questionnaire answers read from the zip ``archives`` (project -> path),
    and the motion, doors, entryway, temperature, light and physiology tables derived from them.

    ``types_of`` names the project whose archive holds the type dictionary (default: the first), ``flags_of`` and
    ``wellbeing_of`` those with flags and questionnaires (default: all). Questions become columns in text order;
    a project without a question gives null there.
    """
    if not archives:
        raise ValueError("register_legacy needs at least one archive")
    archives = dict(archives)
    types_of = types_of or next(iter(archives))
    flags_of, wellbeing_of = (list(archives) if x is None else list(x) for x in (flags_of, wellbeing_of))
    unknown = {types_of, *flags_of, *wellbeing_of} - set(archives)
    if unknown:
        raise ValueError(f"no archive of the projects {', '.join(sorted(unknown))}")

    def member(spark, project: str, name: str):
        return read_zip_csv(spark, archives[project], name, infer=False)

    def wellbeing(spark):
        answers = {p: member(spark, p, "QuestionnaireResponses.csv") for p in wellbeing_of}
        asked = [df.select(F.col("question").cast("string").alias("question")).where("question IS NOT NULL").distinct()
                 for df in answers.values()]
        questions = sorted({r.question for q in asked for r in q.collect()})       # columns of the result
        return legacy.legacy_wellbeing(answers, questions)

    def flags(spark):
        return legacy.legacy_flags({p: tuple(member(spark, p, f"{n}.csv") for n in ("Flags", "Flag-type", "FlagValidations"))
                                    for p in flags_of})

    c.source("legacy", "observation")(lambda spark: legacy.process_observation(spark, list(archives.values())))
    c.source("legacy", "device_type")(lambda spark: legacy.process_device_type(spark, archives[types_of]))
    if flags_of:
        c.source("legacy", "flags")(flags)
    if wellbeing_of:
        c.source("legacy", "wellbeing")(wellbeing)

    seen, types = ("observation", "legacy"), ("device_type", "legacy")
    c.recipe("legacy", "motion", [seen])(lambda observation: legacy.legacy_motion(observation, tz))
    c.recipe("legacy", "doors", [seen])(lambda observation: legacy.legacy_doors(observation, tz))
    c.recipe("legacy", "entryway", [("doors", "legacy")])(lambda doors: legacy.legacy_entryway(doors))
    for name, code in (("temperature", legacy.TEMPERATURE_CODE), ("light", legacy.LIGHT_CODE)):
        source = {"temperature": "raw_ambient_temperature", "light": "raw_light"}[name]
        c.recipe("legacy", name, [seen])(
            lambda observation, code=code, source=source: legacy.legacy_environment(observation, code, source, tz))
    c.recipe("legacy", "physiology", [seen, types])(
        lambda observation, device_type: legacy.legacy_physiology(observation, device_type, tz))
