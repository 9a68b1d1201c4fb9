"""Profile-domain recipes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homesense.functions.scalars import clip, map_strict, np_round, safe_ratio
from homesense.functions.time import between_time, day_start, duration_hours, noon_day_bin, time_angle
from homesense.operators import resample as rs
from homesense.operators.stats import circular_mean, circular_std, rolling_zscore

# Renames of the sleep model.
SLEEP_MODEL_RENAMES = {"time_in_bed": "ibp", "minutes_snoring": "snoring_time", "heart_rate": "hr_average",
                       "respiratory_rate": "rr_average", "time_out_of_bed": "obp", "time_to_bed": "To_bed",
                       "wake_up_time": "Arise"}
# Physiology sources in output order and their column names.
PHYSIOLOGY_SOURCES = {"raw_heart_rate": "Heart_rate", "raw_body_weight": "Weight", "raw_body_mass_index": "BMI",
                      "raw_oxygen_saturation": "Oxygen_Saturation", "raw_body_temperature": "Temperature",
                      "systolic_bp": "Systolic_BP", "diastolic_bp": "Diastolic_BP", "raw_total_body_fat": "Body_Fat"}
REST_RENAMES = {"respiratory_rate": "RR_rest", "heart_rate": "HR_rest"}
# Room names of the habitat profile; unmatched rooms become null.
HABITAT_ROOMS = {"bathroom1": "Bathroom", "WC1": "Bathroom", "kitchen": "Kitchen", "hallway": "Hallway",
                 "corridor1": "Hallway", "dining room": "Lounge", "living room": "Lounge", "lounge": "Lounge",
                 "study": "Lounge", "office": "Lounge", "conservatory": "Lounge", "bedroom1": "Bedroom",
                 "main door": "Front door", "front door": "Front door", "back door": "Back door"}
STATES = ("AWAKE", "DEEP", "REM", "LIGHT")


def sleep_model(dailies: DataFrame, keys: Sequence[str] = ("patient_id",), window: int = 14) -> DataFrame:
    """Model features from the nightly profile (``process_sleep_model``, D13, SC18, WN8, FIL13)."""
    keys = list(keys)
    d = dailies
    for a, b in SLEEP_MODEL_RENAMES.items():
        d = d.withColumnRenamed(a, b)
    total = F.col("AWAKE") + F.col("DEEP") + F.col("REM") + F.col("LIGHT")
    d = d.select("*", *[safe_ratio(F.col(s), total).alias(f"{s.lower()}_ratio") for s in ("DEEP", "AWAKE", "REM", "LIGHT")],
                 safe_ratio(F.col("nb_awakenings"), F.col("ibp") + F.col("obp")).alias("exit_ratio"),
                 clip(np_round(safe_ratio(F.col("obp") * 60, F.col("nb_awakenings")), 0), 0, 10).alias("mean_obp"),
                 safe_ratio(F.col("obp"), F.col("ibp") + F.col("obp")).alias("obp_rate"),
                 day_start("start_date").alias("night"))
    d = rolling_zscore(d, keys, "start_date", "hr_average", window, "hr_local_norm")
    d = rolling_zscore(d, keys, "start_date", "rr_average", window, "rr_local_norm")
    return d.withColumn("obp", clip(F.col("obp") * 60, 0, 600))


def physiology_dailies(physiology: DataFrame, sleep_daily: DataFrame | None, keys: Sequence[str] = ("patient_id",),
                       sources: Mapping[str, str] = PHYSIOLOGY_SOURCES) -> DataFrame:
    """Noon-day mean per source (dense per key and source), one column per source in the given order,
    plus the rest heart and breathing rate of the night table (``process_physiology_dailies``, AG9, JN5)."""
    keys = list(keys)
    p = physiology.where(F.col("source").isin(list(sources)))
    m = rs.resample(p, [*keys, "source"], "start_date", 86_400, {"value": F.avg("value")}, 12 * 3600)
    wide = m.groupBy(*keys, "start_date").pivot("source", list(sources)).agg(F.first("value"))
    wide = wide.select(*keys, "start_date", *[F.col(s).alias(n) for s, n in sources.items()])
    if sleep_daily is None:
        return wide
    rest = rs.resample(sleep_daily, keys, "start_date", 86_400,
                       {v: F.avg(k) for k, v in REST_RENAMES.items()}, 12 * 3600)
    return wide.join(rest, on=[*keys, "start_date"], how="left")


def weeklies(daily: DataFrame, keys: Sequence[str] = ("patient_id",), measures: Sequence[str] | None = None
             ) -> DataFrame:
    """Weekly mean / sample std of every measure (``process_*_weeklies``, AG6)."""
    keys = list(keys)
    measures = list(measures or [c for c in daily.columns if c not in (*keys, "start_date")])
    return rs.period_stats(daily, keys, "start_date", measures)


def habitat_profile(df: DataFrame, keys: Sequence[str] = ("patient_id",), every_seconds: int = 900,
                    rooms: Mapping[str, str] = HABITAT_ROOMS) -> DataFrame:
    """Room names mapped (unmatched -> dropped), 15-min mean per key and room, dense and forward-filled,
    with the date and the time-of-day angle (profile ``process_light`` / ``process_temperature``, D15)."""
    keys = list(keys)
    d = df.withColumn("location_name", map_strict("location_name", rooms)).where(F.col("location_name").isNotNull())
    r = rs.resample_mean_ffill(d, [*keys, "location_name"], "start_date", "value", every_seconds)
    return r.withColumn("date", day_start("start_date")).withColumn("time", time_angle("start_date"))


# Output names of the simple sleep tables.
SIMPLE_NAMES = ("Heart rate", "Breathing rate", "Snoring", "Time to bed", "Wake up time", "Time in bed",
                "Time out of bed")


def sleep_dailies_simple(sleep: DataFrame, keys: Sequence[str] = ("patient_id",), start: str = "17:00",
                         end: str = "11:00") -> DataFrame:
    """Per key and noon-day of the minutes between 17:00 and 11:00: mean heart / breathing rate, snoring
    minutes, first and last minute as angles, hours in bed and out of bed (AG19, D25)."""
    keys = list(keys)
    s = sleep.where(between_time("start_date", start, end))
    g = s.groupBy(*keys, noon_day_bin("start_date").alias("start_date")).agg(
        F.avg("heart_rate").alias("hr"), F.avg("respiratory_rate").alias("br"),
        F.sum(F.col("snoring").cast("double")).alias("snr"), F.min("start_date").alias("ttb"),
        F.max("start_date").alias("wup"), (F.count(F.lit(1)) / 60.0).alias("tib"))
    g = g.na.drop(subset=["hr", "br", "ttb", "wup"])
    n = dict(zip(("hr", "br", "snr", "ttb", "wup", "tib", "tob"), SIMPLE_NAMES))
    return g.select(*keys, "start_date", F.col("hr").alias(n["hr"]), F.col("br").alias(n["br"]),
                    F.col("snr").alias(n["snr"]), time_angle("ttb").alias(n["ttb"]), time_angle("wup").alias(n["wup"]),
                    F.col("tib").alias(n["tib"]), (duration_hours("ttb", "wup") - F.col("tib")).alias(n["tob"]))


def sleep_weeklies(dailies: DataFrame, keys: Sequence[str] = ("patient_id",)) -> DataFrame:
    """Weekly mean / std of the simple sleep table; circular mean / std for the two angle columns (AG18)."""
    from homesense.functions.time import week_label
    keys = list(keys)
    linear = [SIMPLE_NAMES[i] for i in (0, 1, 2, 5, 6)]
    angles = [SIMPLE_NAMES[3], SIMPLE_NAMES[4]]
    aggs = []
    for m in SIMPLE_NAMES:
        if m in angles:
            aggs += [circular_mean(F.col(f"`{m}`")).alias(f"{m}_mean"), circular_std(F.col(f"`{m}`")).alias(f"{m}_std")]
        elif m in linear:
            aggs += [F.avg(F.col(f"`{m}`")).alias(f"{m}_mean"), F.stddev_samp(F.col(f"`{m}`")).alias(f"{m}_std")]
    a = rs.drop_null_keys(dailies, keys).groupBy(*keys, week_label("start_date").alias("__w")).agg(*aggs)
    return rs.densify(a, keys, "__w", step_days=7).withColumnRenamed("__w", "start_date")
