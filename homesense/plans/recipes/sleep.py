"""Sleep recipes shared by the base and profile domains."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homesense.functions.scalars import bool_words
from homesense.functions.time import localize, minute_bin
from homesense.operators.ordered import AUTO
from homesense.operators.segments import presence_edges, sleep_dailies


def process_sleep(sleep_mat: DataFrame, keys: Sequence[str] = ("patient_id",), tiebreak: str | None = None,
                  dedupe_state: bool = True, tz: str | None = "Europe/London") -> DataFrame:
    """Minute table of the sleep mat (D5): snoring minutes (any snoring reading), mean heart and
    breathing rate, incomplete minutes dropped, state brought back, wall clock localised.

    ``dedupe_state=True`` keeps one row per minute with the state of the last reading (``max_by`` on
    ``tiebreak``, else on the state text) [Q-23]; ``False`` joins every raw state back as the reference
    does (several readings in one minute then multiply the minute).
    """
    keys = list(keys)
    snoring = F.when(bool_words("snoring") != 0, 1).otherwise(0)
    m = sleep_mat
    for k in keys:
        m = m.where(F.col(k).isNotNull())
    m = m.withColumn("__minute", minute_bin("start_date"))
    aggs = [F.sum(snoring).alias("__snore"), F.avg("heart_rate").alias("heart_rate"),
            F.avg("respiratory_rate").alias("respiratory_rate")]
    if dedupe_state:
        order = F.struct(F.col(tiebreak), F.col("state")) if tiebreak else F.col("state")
        aggs.append(F.max_by("state", order).alias("state"))
    r = (m.groupBy(*keys, F.col("__minute").alias("start_date")).agg(*aggs)
         .na.drop(subset=["heart_rate", "respiratory_rate"]))
    if not dedupe_state:
        raw = sleep_mat.select(*keys, "start_date", "state")
        r = r.join(raw, on=[*keys, "start_date"], how="left")
    r = r.withColumn("snoring", F.col("__snore") > 0).drop("__snore")
    if tz:
        r = r.withColumn("start_date", localize("start_date", tz)).withColumn("timezone", F.lit(tz))
    return r


def process_bed_occupancy(sleep: DataFrame, keys: Sequence[str] = ("patient_id",),
                          chunk_seconds: int | None | str = AUTO, one_row_per_minute: bool = False) -> DataFrame:
    """Bed_in / Bed_out edges from the minute table (D6). Pass ``one_row_per_minute=True`` for the
    de-duplicated minute table of :func:`process_sleep` (``dedupe_state=True``)."""
    return presence_edges(sleep, list(keys), "start_date", chunk_seconds, one_row_per_minute=one_row_per_minute)


def process_sleep_dailies(sleep: DataFrame, bed_occupancy: DataFrame | None, keys: Sequence[str] = ("patient_id",),
                          gap_hours: float = 1.0, chunk_seconds: int | None | str = AUTO) -> DataFrame:
    """Nightly sleep profile (D12). ``bed_occupancy=None`` takes the edges of the minute table itself, which must then
    hold at most one row per key and minute (a localised one holds more in the hour that autumn repeats)."""
    return sleep_dailies(sleep, bed_occupancy, list(keys), gap_hours * 3600, chunk_seconds=chunk_seconds)
