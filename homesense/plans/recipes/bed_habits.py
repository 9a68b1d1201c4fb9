"""Bed-habits domain (D16): nightly hours in bed and cohort outcome labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from homesense.operators.resample import occupancy_daily
from homesense.operators.stats import iqr_labels


def process_outcome(sleep: DataFrame, keys: Sequence[str] = ("patient_id",), approx_accuracy: int | None = None
                    ) -> DataFrame:
    """Hours in bed per noon-day (18:00-12:00 minutes, zero-filled) labelled against the cohort's
    quartiles: ``global_outcome`` keeps OOB / Low / Normal / High TIB, ``outcome_full`` all six labels."""
    return iqr_labels(occupancy_daily(sleep, list(keys), "start_date"), "Time_in_bed",
                      approx_accuracy=approx_accuracy, discrete=True)
