"""Registry of named queries over the driver tables, each with its DuckDB oracle SQL.

A query is a callable ``(spark, sf_dir) -> DataFrame`` that reads the parquet tables under ``sf_dir``
and applies library operators. ``sql`` is an equivalent DuckDB statement over views with the same
table names (or ``None`` for operators SQL cannot express, which get a row-count check only).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    fn: QueryFn
    sql: str | None
    survey_ids: tuple[str, ...]


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None, *survey_ids: str):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, survey_ids)
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column for a stable value hash against the oracle."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f"`{f.name}`"), digits).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)
