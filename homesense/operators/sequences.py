"""Sequence operators over per-entity event streams (WN1-WN4, WN11, WN13, WN16/JN7).

All of them partition by explicit keys and order by (time, tie-break); border handling across time chunks
is in :mod:`homesense.operators.ordered`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homesense.functions.time import duration_seconds, epoch_micros
from homesense.operators.ordered import AUTO, require_keys, with_shifts


def _no_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    cond = None
    for k in keys:
        cond = F.col(k).isNotNull() if cond is None else cond & F.col(k).isNotNull()
    return df.where(cond)


def _text(v) -> F.Column:
    """Values rendered as text the way ``astype(str)`` does for missing cells."""
    return F.coalesce(F.col(v).cast("string"), F.lit("nan"))


def transitions(df: DataFrame, keys: Sequence[str], ts: str, value: str,
                covariates: Sequence[str] | None = None, tiebreak=None,
                chunk_seconds: int | None | str = AUTO) -> DataFrame:
    """Pair each event with the next one of the same key (``process_transition``, WN1).

    Output: keys, start_date, end_date, source, sink, [covariates of the source row], transition 'a>b',
    dur (seconds). The last event of every key has no successor and no row; rows with a null covariate
    are dropped as are rows with a null key.
    """
    keys = require_keys(keys)
    covariates = [x for x in (covariates or []) if x not in keys]  # a key used as covariate is already there
    base = _no_null_keys(df, keys).select(*keys, *covariates, F.col(ts).alias("__ts"),
                                          _text(value).alias("source"),
                                          *([F.col(tiebreak).alias("__tb")] if tiebreak else []))
    s = with_shifts(base, keys, "__ts", "__tb" if tiebreak else None,
                    {"end_date": ("__ts", 1), "sink": ("source", 1)}, chunk_seconds)
    out = s.where(F.col("end_date").isNotNull()).select(
        *keys, F.col("__ts").alias("start_date"), "end_date", "source", "sink",
        *covariates,
        F.concat_ws(">", "source", "sink").alias("transition"),
        duration_seconds("__ts", "end_date").alias("dur"))
    return out.na.drop(how="any")


def mine_transition(df: DataFrame, keys: Sequence[str], value: str, ts: str = "start_date",
                    window: int = 1, tiebreak=None, chunk_seconds: int | None | str = AUTO,
                    dedupe: bool = True) -> DataFrame:
    """Look-ahead transitions of ``window`` steps after a full-row dedupe (``mine_transition``, WN2).

    transition = the ``window + 1`` values joined by '>', sink = value ``window`` rows ahead,
    dur = seconds to the row ``window`` ahead. Only rows without a successor that far are dropped.
    ``dedupe=False`` skips the full-row distinct (one shuffle) for inputs unique by construction.
    """
    keys = require_keys(keys)
    if window < 1:
        raise ValueError("window must be >= 1")
    d = _no_null_keys(df.dropDuplicates() if dedupe else df, keys)
    shifts = {f"__v{j}": (value, j) for j in range(1, window + 1)}
    shifts["end_date"] = (ts, window)
    s = with_shifts(d, keys, ts, tiebreak, shifts, chunk_seconds)
    return s.where(F.col("end_date").isNotNull()).select(
        *keys, F.col(ts).alias("start_date"), "end_date",
        F.col(value).alias("source"), F.col(f"__v{window}").alias("sink"),
        F.concat_ws(">", *[F.col(value).cast("string")] + [F.col(f"__v{j}").cast("string")
                                                            for j in range(1, window + 1)]).alias("transition"),
        duration_seconds(ts, "end_date").alias("dur"))


def ngrams(df: DataFrame, keys: Sequence[str], ts: str, value: str, window: int, tiebreak=None,
           chunk_seconds: int | None | str = AUTO) -> DataFrame:
    """Complete sliding n-grams of a value sequence, joined by '>' (``rolling_window``, WN3)."""
    keys = require_keys(keys)
    d = _no_null_keys(df, keys).select(*keys, ts, *([tiebreak] if tiebreak else []),
                                       F.col(value).cast("string").alias("__v"), F.lit(1).alias("__one"))
    shifts = {f"__v{j}": ("__v", j) for j in range(1, window)}
    shifts["__last"] = ("__one", window - 1)
    s = with_shifts(d, keys, ts, tiebreak, shifts, chunk_seconds) if window > 1 else d.withColumn("__last", F.lit(1))
    return s.where(F.col("__last").isNotNull()).select(
        *keys, F.col(ts).alias("start_date"),
        F.concat_ws(">", "__v", *[f"__v{j}" for j in range(1, window)]).alias("ngram"))


def lag_matrix(df: DataFrame, keys: Sequence[str], ts: str, factor: str, lags: int = 7, tiebreak=None,
               chunk_seconds: int | None | str = AUTO) -> DataFrame:
    """Lag matrix with columns ``t(-(L-1))`` .. ``t(-0)``; lag k is named ``t(-(L-k-1))`` (WN4).

    Incomplete rows (not enough history) are dropped.
    """
    keys = require_keys(keys)
    d = _no_null_keys(df, keys).select(*keys, ts, *([tiebreak] if tiebreak else []), factor)
    shifts = {f"t(-{lags - k - 1})": (factor, -k) for k in range(1, lags)}
    s = with_shifts(d, keys, ts, tiebreak, shifts, chunk_seconds) if lags > 1 else d
    s = s.withColumn(f"t(-{lags - 1})", F.col(factor))
    cols = [f"t(-{lags - k - 1})" for k in range(lags)]
    return s.select(*keys, ts, *cols).na.drop(subset=cols)


def count_gaps(df: DataFrame, keys: Sequence[str], ts: str, gap_seconds: float = 60, tiebreak=None,
               chunk_seconds: int | None | str = AUTO) -> DataFrame:
    """Number of consecutive-time differences larger than ``gap_seconds`` per key (WN11)."""
    keys = require_keys(keys)
    d = _no_null_keys(df, keys).select(*keys, ts, *([tiebreak] if tiebreak else []))
    s = with_shifts(d, keys, ts, tiebreak, {"__prev": (ts, -1)}, chunk_seconds)
    gap = duration_seconds("__prev", ts) > gap_seconds
    return s.groupBy(*keys).agg(F.sum(F.when(gap, 1).otherwise(0)).cast("long").alias("n_gaps"))


def door_episodes(df: DataFrame, keys: Sequence[str], ts: str, state: str, open_word: str = "Open",
                  close_word: str = "Close", max_seconds: float = 900, tiebreak=None,
                  chunk_seconds: int | None | str = AUTO) -> DataFrame:
    """Close events paired with the immediately preceding Open of the same key, kept when shorter
    than ``max_seconds`` (WN13). Output: keys, start_date (open), end_date (close), dur."""
    keys = require_keys(keys)
    d = _no_null_keys(df, keys).select(*keys, ts, state, *([tiebreak] if tiebreak else []))
    s = with_shifts(d, keys, ts, tiebreak, {"__pstate": (state, -1), "__pts": (ts, -1)}, chunk_seconds)
    dur = duration_seconds("__pts", ts)
    return (s.where((F.col(state) == close_word) & (F.col("__pstate") == open_word))
            .select(*keys, F.col("__pts").alias("start_date"), F.col(ts).alias("end_date"), dur.alias("dur"))
            .where(F.col("dur") < max_seconds))


def pathways(df: DataFrame, keys: Sequence[str], ts: str, value: str, source: str, sink: str,
             min_dur: float = 180, max_dur: float = 900, tiebreak=None,
             chunk_seconds: int | None | str = AUTO) -> DataFrame:
    """Episodes ``source -> sink`` with min_dur < dur < max_dur and the '>'-joined path of every event
    of the key with start <= t <= end, in time order (``mine_pathway``, WN16 + interval join JN7).

    The interval join is an equi-join on (keys, time bucket) plus the range residual. The bucket width
    is ``max_dur`` so an episode touches at most two buckets; each event meets only the episodes of its
    own bucket, which keeps a hot key spread over many tasks.
    """
    keys = require_keys(keys)
    ends = df.where(F.col(value).isin(source, sink)).select(*keys, ts, value, *([tiebreak] if tiebreak else []))
    ep = (mine_transition(ends, keys, value, ts, 1, tiebreak, chunk_seconds)
          .where((F.col("transition") == f"{source}>{sink}")
                 & (F.col("dur") > min_dur) & (F.col("dur") < max_dur)))
    width = max(int(max_dur), 1) * 1_000_000
    ep = ep.withColumn("__b", F.explode(F.sequence(F.floor(epoch_micros("start_date") / width).cast("long"),
                                                   F.floor(epoch_micros("end_date") / width).cast("long"))))
    ev = _no_null_keys(df, keys).select(*keys, F.col(ts).alias("__t"), F.col(value).cast("string").alias("__v"),
                                        *([F.col(tiebreak).alias("__tb")] if tiebreak else [F.lit(0).alias("__tb")]),
                                        F.floor(epoch_micros(ts) / width).cast("long").alias("__b"))
    hit = ep.join(ev, on=[*keys, "__b"], how="inner").where(
        (F.col("__t") >= F.col("start_date")) & (F.col("__t") <= F.col("end_date")))
    ep_cols = [*keys, "start_date", "end_date", "source", "sink", "transition", "dur"]
    path = hit.groupBy(*ep_cols).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__t", "__tb", "__v"))),
                                 lambda s: s["__v"]), ">").alias("pathway"))
    return path
