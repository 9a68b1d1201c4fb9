"""Domain recipes on small hand-made frames (FIXTURES section 3 style)."""

import datetime as dt
import os
import zipfile

import pytest

from pyspark.sql import functions as F

from homesense.plans.recipes import base, bed_habits, legacy, profile
from homesense.plans.recipes.sleep import process_bed_occupancy, process_sleep, process_sleep_dailies

D = dt.datetime


def _door(spark):
    rows = [("h", "p1", D(2024, 1, 1, 8, 0), "main door", "l1", "opened"),
            ("h", "p1", D(2024, 1, 1, 8, 1), "main door", "l1", "closed"),
            ("h", "p1", D(2024, 1, 1, 9, 0), "fridge door", "l2", "opened"),
            ("h", "p1", D(2024, 1, 1, 9, 2), "fridge door", "l2", "closed"),
            ("h", "p1", D(2024, 7, 1, 9, 0), "back door", "l3", "opened"),
            ("h", "p1", D(2024, 7, 1, 9, 5), "back door", "l3", "closed")]
    return spark.createDataFrame(rows, "home_id string, patient_id string, start_date timestamp_ntz, "
                                       "location_name string, location_id string, value string")


def _devices(spark):
    return spark.createDataFrame([("d1", '["smart plug"]'), ("d2", "[thermo meter]")], "id string, type string")


def test_doors_entryway_kitchen_motion(spark):
    doors = base.process_doors(_door(spark))
    assert doors.count() == 3
    entry = base.process_entryway(doors).orderBy("start_date").collect()
    assert [(r.location_name, r.dur) for r in entry] == [("front door", 60.0), ("back door", 300.0)]
    assert entry[1].start_date == D(2024, 7, 1, 10, 0)  # summer time in London
    act = spark.createDataFrame(
        [("p1", D(2024, 1, 1, 9, 10), "kitchen"), ("p1", D(2024, 1, 1, 9, 20), "office"),
         ("p1", D(2024, 1, 1, 9, 30), "WC1"), ("p1", D(2024, 1, 1, 9, 40), None)],
        "patient_id string, start_date timestamp_ntz, location_name string")
    app = spark.createDataFrame(
        [("p1", D(2024, 1, 1, 9, 15), "d1", "microwave-use"), ("p1", D(2024, 1, 1, 9, 16), "d1", "iron-use")],
        "patient_id string, start_date timestamp_ntz, device_type string, value string")
    k = base.process_kitchen(app, doors, act, _devices(spark)).orderBy("start_date").collect()
    assert [r.transition for r in k] == ["fridge door>kitchen", "kitchen>oven-use"]
    assert [r.device_type for r in k] == ["door", "pir"]
    bed = spark.createDataFrame([("p1", D(2024, 1, 1, 22, 0), "Bed_in")],
                                "patient_id string, start_date timestamp_ntz, location_name string")
    motion = base.process_motion(act, entry.__class__ and base.process_entryway(doors), bed)
    rooms = sorted((r.location_name or "") for r in motion.collect())
    assert rooms == ["", "Back door", "Bathroom", "Bed_in", "Front door", "Kitchen"]
    tr = base.process_transitions(motion)
    assert tr.count() == motion.count() - 1


def test_physiology_and_habitat(spark):
    vit = spark.createDataFrame([("h", "p1", D(2024, 1, 1, 8), 70.0, "bpm", "d1", "raw_heart_rate")],
                                "home_id string, patient_id string, start_date timestamp_ntz, value double, "
                                "unit string, device_type string, source string")
    bp = spark.createDataFrame([("h", "p1", D(2024, 1, 1, 8), 120.0, 80.0, "mmHg", "d9", "raw_blood_pressure")],
                               "home_id string, patient_id string, start_date timestamp_ntz, systolic_value double, "
                               "diastolic_value double, unit string, device_type string, source string")
    out = {r.source: (r.value, r.device_type) for r in base.process_physiology(vit, bp, _devices(spark)).collect()}
    assert out == {"raw_heart_rate": (70.0, "smart_plug"), "systolic_bp": (120.0, "d9"), "diastolic_bp": (80.0, "d9")}
    light = spark.createDataFrame([("p1", D(2024, 1, 1, 8), "kitchen", 3.0, "d2"), ("p1", D(2024, 1, 1, 9), "", 1.0, "d2")],
                                  "patient_id string, start_date timestamp_ntz, location_name string, value double, "
                                  "device_type string")
    hab = base.process_habitat(light, light, _devices(spark)).collect()
    assert len(hab) == 2 and all(r.device_type == "thermo_meter" for r in hab)
    env = base.process_environment(light, _devices(spark)).collect()
    assert len(env) == 1 and env[0].timezone == "Europe/London"


def _sleep_mat(spark):
    rows = []
    base_t = D(2024, 1, 1, 22, 0)
    states = ["AWAKE", "LIGHT", "DEEP", "REM"]
    for night in range(3):
        for m in range(0, 400):
            if 150 <= m < 170:  # out of bed for 20 minutes
                continue
            t = base_t + dt.timedelta(days=night, minutes=m)
            rows.append(("h", "p1", t, states[(m // 7) % 4], 60.0 + m % 5 + night, 14.0 + m % 3 + night, "true" if m % 11 == 0 else "false"))
    return spark.createDataFrame(rows, "home_id string, patient_id string, start_date timestamp_ntz, state string, "
                                       "heart_rate double, respiratory_rate double, snoring string")


def test_sleep_chain_and_model(spark):
    sleep = process_sleep(_sleep_mat(spark))
    edges = process_bed_occupancy(sleep)
    assert edges.count() == 11  # in, out, in, out per night; no Bed_out after the last minute
    daily = process_sleep_dailies(sleep, edges).orderBy("start_date").collect()
    assert len(daily) == 2  # the last stay never ends (no Bed_out), so the third night has no habit
    n = daily[0]
    assert n.nb_awakenings == 1 and abs(n.time_in_bed - 380 / 60) < 0.01
    assert n.AWAKE > 0 and n.DEEP > 0 and n.start_time == D(2024, 1, 1, 22, 0)
    model = profile.sleep_model(process_sleep_dailies(sleep, edges)).orderBy("start_date").collect()
    assert model[0].hr_local_norm is None and model[1].hr_local_norm is not None
    assert 0 <= model[0].mean_obp <= 10 and model[0].obp <= 600
    out = bed_habits.process_outcome(sleep).collect()
    # three equal nights: IQR 0, every value sits exactly on the lower fence -> no label
    assert {r.unit for r in out} == {"hour"} and len(out) == 3
    assert all(r.outcome_full is None and r.global_outcome is None for r in out)
    simple = profile.sleep_dailies_simple(sleep).collect()
    assert len(simple) == 3  # the simple table needs no bed edges
    weekly = profile.sleep_weeklies(profile.sleep_dailies_simple(sleep)).collect()
    assert len(weekly) == 1 and weekly[0]["Time to bed_mean"] is not None


def _zip(path, members):
    with zipfile.ZipFile(path, "w") as z:
        for name, text in members.items():
            z.writestr(name, text)


def test_legacy_recipes(spark, scratch):
    obs = ("subject,location,datetimeObserved,type,valueState,valueQuantity,valueUnit,valueBoolean,"
           "valueDatetimeStart,valueDatetimeEnd\n"
           "s1,Hall,2016-01-01 10:00:00,272149007-2,,,,True,,\n"
           "s1,Hall,2016-01-01 10:00:00,272149007-2,,,,True,,\n"
           "s1,Main Door,2016-01-01 10:01:00,224751004,Open,,,,,\n"
           "s1,Main Door,2016-01-01 10:02:00,224751004,Close,,,,,\n"
           "s1,Lounge,2016-01-01 10:03:00,60832-3,,21.5,C,,,\n"
           "s1,,2016-01-01 10:04:00,8867-4,,72,bpm,,,\n"
           "s1,,2016-01-01 10:05:00,29463-7,,80.5,kg,,,\n"
           "s1,,2013-01-01 10:05:00,29463-7,,80.5,kg,,,\n")
    types = "code,display\n29463-7,Body weight\n272149007-2,Movement\n224751004,Door\n"
    a1, a2 = os.path.join(scratch, "a.zip"), os.path.join(scratch, "b.zip")
    _zip(a1, {"Observations.csv": obs, "Observation-type.csv": types})
    _zip(a2, {"Observations.csv": obs.splitlines()[0] + "\n" + "s2,Hall,2017-01-01 10:00:00,272149007-2,,,,True,,\n"})
    o = legacy.process_observation(spark, [a1, a2])
    dt_ = legacy.process_device_type(spark, a1)
    assert legacy.legacy_motion(o).count() == 2
    doors = legacy.legacy_doors(o)
    assert [r.transition for r in doors.collect()] == ["opened>closed"]
    assert legacy.legacy_entryway(doors).collect()[0].location_name == "main door".replace("main", "front")
    assert legacy.legacy_environment(o, legacy.TEMPERATURE_CODE, "raw_ambient_temperature").collect()[0].value == 21.5
    phys = {r.source for r in legacy.legacy_physiology(o, dt_).collect()}
    assert phys == {"raw_heart_rate", "raw_body_weight"}
    clean = legacy.clean_observations(o, dt_)
    assert clean.where(F.year("datetimeObserved") <= 2014).count() == 0


def test_legacy_flags_and_wellbeing(spark):
    flags = spark.createDataFrame([(1, 1, 8), (2, 3, 5)], "flagId int, category int, type int")
    ftype = spark.createDataFrame([(5, "Fall"), (8, "Oxygen")], "code int, display string")
    val = spark.createDataFrame([(1, "yes", 9)], "flag int, valid string, category int")
    out = {r.flagId: r for r in legacy.legacy_flags({"p": (flags, ftype, val)}).collect()}
    assert out[1].type == "Blood Oxygen Saturation" and out[2].type == "Fall"
    assert out[1].categorydf == "Clinical" and out[1].category_val == 9
    q = spark.createDataFrame([("x", "2020-01-01", "s1", "2020-01-01 10:00:00", "mood", "3"),
                               ("x", "2020-01-01", "s1", "2020-01-01 10:00:00", "mood", "3"),
                               ("x", "2020-01-01", "s1", "2020-01-01 10:00:00", "sleep", "2")],
                              "questionnaire string, datetimeReceived string, subject string, datetimeAnswered string, "
                              "question string, answer string")
    w = legacy.legacy_wellbeing({"p": q}, ["mood", "sleep"]).collect()
    assert len(w) == 1 and w[0].mood == "3" and w[0].sleep == "2" and w[0].project == "p"


def test_parse_activity(spark):
    rows = [("s1", "Front Door", "2016-01-01 10:00:00", "224751004", "True"),
            ("s1", "Front Door", "2016-01-01 10:05:00", "224751004", "False"),
            ("s1", "Kitchen", "2016-01-01 10:06:00", "272149007-2", "True"),
            ("s1", "Microwave", "2016-01-01 10:07:00", "999", "True")]
    o = spark.createDataFrame(rows, "subject string, location string, datetimeObserved string, type string, "
                                    "valueState string")
    dt_ = spark.createDataFrame([("224751004", "Door"), ("272149007-2", "Movement"),
                                 ("999", "Does turn on domestic appliance")], "code string, display string")
    act = legacy.parse_activity(o, dt_, ["Front Door", "Kitchen", "Oven"]).collect()
    assert sorted((r["Front Door"], r.Kitchen, r.Oven) for r in act) == [(0, 0, 1), (0, 1, 0), (1, 0, 0)]


def test_base_and_profile_domains_load(spark, scratch):
    from homesense.plans import driver_tables as views
    from homesense.plans import q_recipes, q_stats
    from homesense.plans.compare import rows_of
    from homesense.plans.recipes.domains import register_base, register_profile
    from homesense.plans.registry import round_doubles
    from homesense.sources.catalog import Catalog
    sf = "/root/testdata/sf0.001"
    c = Catalog(spark, os.path.join(scratch, "domains"))
    sources = {"door": views.door_view, "activity": views.activity_view, "appliances": views.appliances_view,
               "light": views.environment_view, "ambient_temperature": views.environment_view,
               "sleep_mat": views.sleep_mat, "vital_signs": q_recipes._vitals, "blood_pressure": q_recipes._blood_pressure}
    for name, view in sources.items():
        c.source("raw", name)(lambda s, view=view: view(s, sf))
    c.source("lookup", "device_types")(lambda s: views.device_types_view(s, sf))
    register_base(c, sleep_tiebreak="event_id", door_tiebreak="event_id")
    register_profile(c, gap_hours=6)
    got = round_doubles(c.load("sleep_model", "profile")).toPandas()
    assert rows_of(got) == rows_of(q_stats.q_sleep_model(spark, sf).toPandas())
    assert rows_of(c.load("Transitions", "base").toPandas().round(6)) == rows_of(q_recipes.q_room_transitions(spark, sf).toPandas())
    for name in ("activity_weeklies", "physiology_dailies", "light"):
        assert c.load(name, "profile").count() > 0
    assert {r.dataset for r in c.manifest().collect()} >= {"sleep_mat", "sleep", "bed_occupancy", "sleep_dailies", "motion"}


def test_bed_habits_and_legacy_domains_load(spark, scratch):
    from homesense.plans.recipes.domains import register_base, register_bed_habits, register_legacy
    from homesense.sources.catalog import Catalog
    obs = ("subject,location,datetimeObserved,type,valueState,valueQuantity,valueUnit\n"
           "s1,Hall,2016-01-01 10:00:00,272149007-2,,,\n"
           "s1,Main Door,2016-01-01 10:01:00,224751004,Open,,\n"
           "s1,Main Door,2016-01-01 10:02:00,224751004,Close,,\n"
           "s1,Lounge,2016-01-01 10:03:00,60832-3,,21.5,C\n"
           "s1,Lounge,2016-01-01 10:03:00,56242006,,7,lx\n"
           "s1,,2016-01-01 10:04:00,8867-4,,72,bpm\n")
    head = "questionnaire,datetimeReceived,subject,datetimeAnswered,question,answer\n"
    paths = {p: os.path.join(scratch, f"legacy-{p}.zip") for p in ("one", "two")}
    _zip(paths["one"], {"Observations.csv": obs, "Observation-type.csv": "code,display\n29463-7,Body weight\n",
                        "Flags.csv": "flagId,category,type\n1,1,8\n2,3,5\n", "Flag-type.csv": "code,display\n5,Fall\n8,Oxygen\n",
                        "FlagValidations.csv": "flag,valid,category\n1,yes,9\n",
                        "QuestionnaireResponses.csv": head + "x,2020-01-01,s1,2020-01-01 10:00:00,mood,3\n"})
    _zip(paths["two"], {"Observations.csv": obs.splitlines()[0] + "\ns2,Hall,2017-01-01 10:00:00,272149007-2,,,\n",
                        "QuestionnaireResponses.csv": head + "x,2020-01-02,s2,2020-01-02 10:00:00,sleep,2\n"})
    c = Catalog(spark, os.path.join(scratch, "legacy-catalogue"))
    register_legacy(c, paths, flags_of=["one"])
    c.source("raw", "sleep_mat")(lambda s: _sleep_mat(s))
    register_base(c)
    register_bed_habits(c)

    assert sorted(r.patient_id for r in c.load("motion", "legacy").collect()) == ["s1", "s2"]
    assert [r.transition for r in c.load("doors", "legacy").collect()] == ["opened>closed"]
    assert [r.location_name for r in c.load("entryway", "legacy").collect()] == ["front door"]
    assert [r.value for r in c.load("temperature", "legacy").collect()] == [21.5]
    assert [r.source for r in c.load("light", "legacy").collect()] == ["raw_light"]
    assert [r.source for r in c.load("physiology", "legacy").collect()] == ["raw_heart_rate"]
    assert {(r.flagId, r.type, r.categorydf) for r in c.load("flags", "legacy").collect()} == {
        ("1", "Blood Oxygen Saturation", "Clinical"), ("2", "Fall", "Technical")}
    assert sorted((r.project, r.subject, r.mood, r.sleep) for r in c.load("wellbeing", "legacy").collect()) == [
        ("one", "s1", "3", None), ("two", "s2", None, "2")]
    nights = c.load("bed_occupancy", "bed_habits").collect()
    assert len(nights) == 3 and {r.unit for r in nights} == {"hour"}
    with pytest.raises(ValueError):
        register_legacy(c, paths, types_of="three")
    with pytest.raises(ValueError):
        register_legacy(c, {})
