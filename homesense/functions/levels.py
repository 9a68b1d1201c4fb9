"""Ordered levels of a text column, kept in its schema (SCH6).

The order is column metadata, so it is written with a Parquet file and read back with it; nothing is stored per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEVELS = "levels"


def with_levels(df: DataFrame, col: str, levels: Sequence[str]) -> DataFrame:
    """``df`` with the levels of a column, lowest first, in its schema."""
    if len(set(levels)) != len(levels):
        raise ValueError("levels must differ")
    return df.withMetadata(col, {**df.schema[col].metadata, LEVELS: list(levels)})


def levels_of(df: DataFrame, col: str) -> list[str]:
    found = df.schema[col].metadata.get(LEVELS)
    if found is None:
        raise ValueError(f"{col} has no ordered levels")
    return list(found)


def level_rank(df: DataFrame, col: str) -> Column:
    """Place of a value among the column's levels, from 0; null for null and for values that are no level."""
    place = F.array_position(F.array(*[F.lit(x) for x in levels_of(df, col)]), F.col(f"`{col}`"))
    return F.when(place > 0, (place - 1).cast("int"))


def order_by_level(df: DataFrame, *cols: str, descending: bool = False) -> DataFrame:
    """Rows by the levels of the columns, rows without a level last."""
    return df.orderBy(*[(level_rank(df, x).desc_nulls_last() if descending else level_rank(df, x).asc_nulls_last()) for x in cols])


def at_least(df: DataFrame, col: str, level: str) -> Column:
    """Whether a value's level is ``level`` or a higher one; null without a level."""
    return level_rank(df, col) >= levels_of(df, col).index(level)
