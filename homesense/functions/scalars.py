"""Scalar column builders: rounding, angles, clipping, dictionary maps, text cleaning, guarded ratios."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from homesense.functions.time import c


def np_round(x, digits: int = 0) -> Column:
    """NumPy ``round``: scale, round half to even, scale back (SC7). Spark's ``bround(x, d)`` rounds the
    decimal text of x instead and differs on values such as 36.855."""
    f = 10.0 ** digits
    return F.bround(c(x) * f, 0) / f


def round_quarter(x) -> Column:
    """Round to the nearest 0.25, ties to even (SC5)."""
    return F.bround(c(x) * 4, 0) / 4


def round_half(x) -> Column:
    """Round to the nearest 0.5, ties to even (SC6)."""
    return F.bround(c(x) * 2, 0) / 2


def center_angle(deg) -> Column:
    """Degrees -> radians centred on 0: ((rad + pi) floor-mod 2 pi) - pi (SC4)."""
    return F.pmod(F.radians(c(deg)) + F.lit(math.pi), F.lit(2 * math.pi)) - F.lit(math.pi)


def clip(x, lo=None, hi=None) -> Column:
    """Clip to [lo, hi]; null stays null (FIL13)."""
    out = c(x)
    if hi is not None:
        out = F.least(out, F.lit(hi))
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    return F.when(c(x).isNotNull(), out)


def safe_ratio(num, den) -> Column:
    """num / den with NumPy float semantics: x/0 -> +/-inf, 0/0 -> null (NaN)."""
    n, d = c(num), c(den)
    return (F.when(n.isNull() | d.isNull(), F.lit(None).cast("double"))
            .when(d != 0, n / d)
            .when(n > 0, F.lit(float("inf")))
            .when(n < 0, F.lit(float("-inf")))
            .otherwise(F.lit(None).cast("double")))


def map_replace(x, mapping: Mapping) -> Column:
    """Dictionary replace: matched values take the mapped value (which may be None), others unchanged (FIL10)."""
    expr = None
    for k, v in mapping.items():
        val = F.lit(v) if v is not None else F.lit(None).cast("string")
        expr = F.when(c(x) == F.lit(k), val) if expr is None else expr.when(c(x) == F.lit(k), val)
    return c(x) if expr is None else expr.otherwise(c(x))


def map_strict(x, mapping: Mapping) -> Column:
    """Dictionary map: unmatched values become null (FIL11)."""
    expr = None
    for k, v in mapping.items():
        expr = F.when(c(x) == F.lit(k), F.lit(v)) if expr is None else expr.when(c(x) == F.lit(k), F.lit(v))
    return F.lit(None).cast("string") if expr is None else expr


def not_in_keep_null(x, values: Sequence) -> Column:
    """pandas ``~isin``: rows with a null value are kept (FIL2)."""
    return ~F.coalesce(c(x).isin(list(values)), F.lit(False))


def not_blank_keep_null(x) -> Column:
    """pandas ``col != ''``: null rows are kept (FIL3)."""
    return c(x).isNull() | (c(x).cast("string") != "")


def bool_words(x) -> Column:
    """'true'/'false' text -> 1.0 / 0.0; numbers kept; other text -> null (SCH3)."""
    s = F.lower(F.trim(c(x).cast("string")))
    return F.when(s == "true", F.lit(1.0)).when(s == "false", F.lit(0.0)).otherwise(s.try_cast("double"))


def device_type_text(x) -> Column:
    """Clean a device-type label: drop '"', '[' and ']', spaces -> '_' (JN1)."""
    return F.regexp_replace(F.regexp_replace(c(x), r'"|\[|\]', ""), " ", "_")


def array_text(x, sep: str = " ") -> Column:
    """Array cell -> one text value (SCH4)."""
    return F.concat_ws(sep, F.transform(c(x), lambda e: e.cast("string")))


def row_total(cols: Sequence[str]) -> Column:
    """Row sum skipping nulls (pandas ``sum(axis=1)``): 0 when every cell is null."""
    out = F.lit(0)
    for name in cols:
        out = out + F.coalesce(F.col(name), F.lit(0))
    return out
