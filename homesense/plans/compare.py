"""Order-insensitive comparison of a Spark result with a DuckDB oracle result (used by tests and tools)."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

import numpy as np
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, (float, np.floating)):
        if math.isnan(v):
            return None
        if math.isinf(v):
            return str(v)
        r = round(float(v), 5)
        return 0.0 if r == 0 else r
    if isinstance(v, (bool, np.bool_)):
        return bool(v)
    if isinstance(v, np.integer):
        return int(v)
    if isinstance(v, (pd.Timestamp, dt.datetime)):
        return pd.Timestamp(v).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(norm(x) for x in v)
    return v


def rows_of(pdf: pd.DataFrame):
    cols = sorted(pdf.columns)
    out = Counter()
    for rec in pdf[cols].itertuples(index=False, name=None):
        out[tuple(norm(x) for x in rec)] += 1
    return cols, out


def duckdb_with_views(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark_pdf: pd.DataFrame, oracle_pdf: pd.DataFrame) -> tuple[bool, str]:
    c1, r1 = rows_of(spark_pdf)
    c2, r2 = rows_of(oracle_pdf)
    if c1 != c2:
        return False, f"columns differ: {c1} vs {c2}"
    for name in c1:     # pandas turns integers with nulls into floats, so only columns without nulls tell
        a, b = spark_pdf[name], oracle_pdf[name]
        kinds = {x.dtype.kind.replace("u", "i") for x in (a, b)}
        if len(kinds) > 1 and kinds <= set("ifbM") and not a.isna().any() and not b.isna().any():
            return False, f"types of {name} differ: {a.dtype} vs {b.dtype}"
    if r1 != r2:
        return False, f"only spark {list((r1 - r2).items())[:2]} only oracle {list((r2 - r1).items())[:2]}"
    return True, ""
