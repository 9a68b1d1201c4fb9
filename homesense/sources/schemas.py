"""Declared schemas of the source datasets (column names and types are fixed values of the data model).

Timestamps of raw readings are instants (``timestamp``); localised derived tables use ``timestamp_ntz``.
Every source read also carries ``source string`` (the upstream table name).
"""

from __future__ import annotations

from pyspark.sql import types as T

S, D, TS = T.StringType(), T.DoubleType(), T.TimestampType()


def _schema(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols] + [T.StructField("source", S, True)])


# Source dataset columns by domain.
RAW = {
    "wearable_walking": _schema(("home_id", S), ("patient_id", S), ("start_date", TS), ("end_date", TS),
                                ("steps", D), ("elevation", D), ("elevation_unit", S), ("distance", D),
                                ("distance_unit", S), ("calories", D), ("calories_unit", S)),
    "vital_signs": _schema(("home_id", S), ("patient_id", S), ("start_date", TS), ("value", D), ("unit", S),
                           ("device_type", S)),
    "blood_pressure": _schema(("home_id", S), ("patient_id", S), ("start_date", TS), ("systolic_value", D),
                              ("diastolic_value", D), ("unit", S), ("device_type", S)),
    "ambient_temperature": _schema(("home_id", S), ("patient_id", S), ("start_date", TS), ("location_name", S),
                                   ("location_id", S), ("value", D), ("unit", S), ("device_type", S)),
    "light": _schema(("home_id", S), ("patient_id", S), ("start_date", TS), ("location_name", S),
                     ("location_id", S), ("value", D), ("unit", S), ("device_type", S)),
    "activity": _schema(("home_id", S), ("patient_id", S), ("start_date", TS), ("location_name", S),
                        ("location_id", S)),
    "door": _schema(("home_id", S), ("patient_id", S), ("start_date", TS), ("location_name", S),
                    ("location_id", S), ("value", S)),
    "sleep_event": _schema(("home_id", S), ("patient_id", S), ("start_date", TS), ("value", S)),
    "sleep_mat": _schema(("home_id", S), ("patient_id", S), ("start_date", TS), ("state", S), ("heart_rate", D),
                         ("respiratory_rate", D), ("snoring", S)),
    "behavioural": _schema(("home_id", S), ("patient_id", S), ("start_date", TS), ("type", S), ("sub_types", S),
                           ("notes", S)),
    "appliances": _schema(("home_id", S), ("patient_id", S), ("start_date", TS), ("end_date", TS),
                          ("device_type", S), ("location_name", S), ("location_id", S), ("value", S)),
}
LOOKUP = {
    "device_types": _schema(("id", S), ("manufacturer", S), ("name", S), ("model_number", S), ("type", S),
                            ("online_information", S)),
    "patients": _schema(("id", S), ("birth_date", D), ("gender", S), ("organization", S)),
    "homes": _schema(("home_id", S), ("patient_id", S), ("n_known_occupants", S)),
}
CARE = {
    "encounter": _schema(("home_id", S), ("patient_id", S), ("start_date", TS), ("end_date", S), ("type", S),
                         ("reason", S)),
    "questionnaire": _schema(("response_id", S), ("patient_id", S), ("questionnaire", S), ("question", S),
                             ("answer", S), ("authored", TS)),
    "procedure": _schema(("id", S), ("start_date", TS), ("type", S), ("patient_id", S), ("home_id", S),
                         ("outcome", S), ("follow_up", S), ("notes", S)),
    "observation_notes": _schema(("id", S), ("date", TS), ("dataset", S), ("subject_id", S), ("patient_id", S),
                                 ("home_id", S), ("text", S)),
    "issue": _schema(("id", S), ("authored_on", TS), ("start_date", TS), ("type", S), ("patient_id", S),
                     ("home_id", S), ("priority", S), ("status", S), ("title", S), ("description", S)),
}
SOURCES = {"raw": RAW, "lookup": LOOKUP, "care": CARE}


def schema_of(domain: str, dataset: str) -> T.StructType:
    return SOURCES[domain][dataset]
