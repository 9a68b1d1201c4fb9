"""Lookups, joins and reshaping (JN1-JN11, AG14, AG22-AG24, SO2-SO3, ST1-ST2).

Dimension joins are plain equi-joins: Spark broadcasts a side when its measured size is under
``spark.sql.autoBroadcastJoinThreshold`` (plan time, file statistics) or when AQE sees a small side at run
time; otherwise it shuffles. No unconditional broadcast hints on tables whose size is not bounded.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homesense.functions.scalars import device_type_text


def unique_dim(dim: DataFrame, key: str, value: str, pick: str = "max") -> DataFrame:
    """One value per key (the reference's dict keeps the last duplicate; here the pick is deterministic)."""
    agg = F.max(value) if pick == "max" else F.min(value)
    return dim.where(F.col(key).isNotNull()).groupBy(key).agg(agg.alias(value))


def lookup_replace(df: DataFrame, col: str, dim: DataFrame, dim_key: str, dim_value: str,
                   clean=device_type_text) -> DataFrame:
    """Replace ids in ``col`` by the (cleaned) dimension value; unmatched ids stay (``map_devices``, JN1)."""
    d = unique_dim(dim, dim_key, dim_value)
    d = d.select(F.col(dim_key).cast(df.schema[col].dataType).alias("__k"),
                 (clean(F.col(dim_value)) if clean else F.col(dim_value)).alias("__v"), F.lit(True).alias("__hit"))
    j = df.join(d, df[col] == d["__k"], "left")
    return j.withColumn(col, F.when(F.col("__hit"), F.col("__v")).otherwise(F.col(col).cast("string"))) \
            .drop("__k", "__v", "__hit")


def lookup_override(dim: DataFrame, overrides: DataFrame, key: str, value: str) -> DataFrame:
    """Code -> display dictionary where override rows win over the base rows (JN9)."""
    o = overrides.select(key, value, F.lit(0).alias("__p"))
    b = dim.select(key, value, F.lit(1).alias("__p"))
    u = o.unionByName(b).where(F.col(key).isNotNull())
    return u.groupBy(key).agg(F.min_by(value, F.struct("__p", value)).alias(value))


def left_fill0(left: DataFrame, right: DataFrame, on: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Left join and fill the right-hand measures with 0 where missing (JN5)."""
    j = left.join(right.select(*on, *cols), on=list(on), how="left")
    for x in cols:
        j = j.withColumn(x, F.coalesce(F.col(x), F.lit(0).cast(right.schema[x].dataType)))
    return j


def full_outer_suffixed(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                        suffixes: tuple[str, str] = ("", "_val")) -> DataFrame:
    """Full outer join on differently named keys; shared column names get suffixes (JN3)."""
    shared = (set(left.columns) & set(right.columns)) - {left_key, right_key}
    lcols = [F.col(f"l.`{x}`").alias(x + suffixes[0] if x in shared else x) for x in left.columns]
    rcols = [F.col(f"r.`{x}`").alias(x + suffixes[1] if x in shared else x) for x in right.columns]
    return left.alias("l").join(right.alias("r"), F.col(f"l.{left_key}") == F.col(f"r.{right_key}"), "full_outer") \
        .select(*lcols, *rcols)


def semi_by_list(df: DataFrame, key: str, ids: DataFrame, ids_key: str | None = None) -> DataFrame:
    """Rows whose key is in a list table (JN11, SRC10)."""
    ids_key = ids_key or key
    return df.join(ids.select(F.col(ids_key).alias(key)).distinct(), on=key, how="left_semi")


def anti_by(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` without a match in ``other`` (JN10, SRC18, SRC19)."""
    return df.join(other.select(*keys).distinct(), on=list(keys), how="left_anti")


def unpivot_pairs(df: DataFrame, ids: Sequence[str], columns: Mapping[str, str], value: str = "value",
                  source: str = "source") -> DataFrame:
    """Wide measure columns to rows: ``columns`` maps column -> source label (AG24)."""
    u = df.unpivot(list(ids), list(columns), source, value)
    expr = None
    for k, v in columns.items():
        expr = F.when(F.col(source) == k, F.lit(v)) if expr is None else expr.when(F.col(source) == k, F.lit(v))
    return u.withColumn(source, expr)


def pivot_answers(df: DataFrame, keys: Sequence[str], question: str, answer: str, questions: Sequence[str]
                  ) -> DataFrame:
    """(subject, time) x question -> answer; duplicates removed first, a cell with several answers takes
    the largest (AG23: the reference's unstack fails on duplicate cells)."""
    return (df.select(*keys, question, answer).dropDuplicates()
            .groupBy(*keys).pivot(question, list(questions)).agg(F.max(answer)))


def one_hot(df: DataFrame, col: str, values: Sequence[str], prefix: str = "") -> DataFrame:
    """0/1 indicator column per listed value (AG22)."""
    return df.select("*", *[F.when(F.col(col) == v, 1).otherwise(0).alias(f"{prefix}{v}") for v in values])


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row of each group in ``order`` (SO3) as an aggregate (``min_by`` of the row): partial
    aggregation runs map-side, so a hot group never lands whole in one task."""
    others = [x for x in df.columns if x not in keys]
    best = F.min_by(F.struct(*[F.col(x) for x in others]), F.struct(*[F.col(o) for o in order]))
    return df.groupBy(*keys).agg(best.alias("__r")).select(*keys, *[F.col(f"__r.{x}").alias(x) for x in others])


def pin_rows(df: DataFrame, col: str, value, order: Sequence[str], top: bool = True) -> DataFrame:
    """Sort with the rows whose ``col == value`` first (or last), then by ``order`` (SO2)."""
    flag = F.when(F.col(col) == F.lit(value), 0 if top else 1).otherwise(1 if top else 0)
    return df.withColumn("pinned", F.when(F.col(col) == F.lit(value), True).otherwise(False)) \
             .orderBy(flag, *order)


def union_all(frames: Sequence[DataFrame], columns: Sequence[str] | None = None) -> DataFrame:
    """UNION ALL by name (ST1): the given columns, or all columns of all frames, null where a frame lacks one."""
    out = frames[0].select(*columns) if columns else frames[0]
    for f in frames[1:]:
        out = out.unionByName(f.select(*columns) if columns else f, allowMissingColumns=True)
    return out


def union_distinct(frames: Sequence[DataFrame], columns: Sequence[str] | None = None) -> DataFrame:
    """UNION + full-row distinct (ST2)."""
    return union_all(frames, columns).dropDuplicates()

