"""Column builders for wall-clock time, bins, angles and time zones.

Every builder takes and returns ``Column`` objects (strings are read as column names) so they stay inside
whole-stage codegen. Localised timestamps are ``TIMESTAMP_NTZ`` end to end; nothing here depends on the
session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_SECOND = 1_000_000
SECONDS_PER_DAY = 86_400


def epoch_ntz() -> Column:
    """1970-01-01 00:00 as TIMESTAMP_NTZ (built lazily: Column literals need an active session)."""
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def c(x) -> Column:
    """Column from a name or a Column."""
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------- parts of a timestamp


def day_start(ts) -> Column:
    """Midnight of the timestamp's date, as TIMESTAMP_NTZ (SC16: date as timestamp)."""
    return F.to_date(c(ts)).cast("timestamp_ntz")


def micros_of_day(ts) -> Column:
    """Microseconds since local midnight."""
    return F.timestamp_diff("MICROSECOND", day_start(ts), c(ts))


def second_of_day(ts) -> Column:
    """Whole seconds since midnight (sub-second part dropped)."""
    t = c(ts)
    return F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)


def epoch_micros(ts) -> Column:
    """Microseconds since 1970-01-01 00:00 of a wall-clock (NTZ) timestamp."""
    return F.timestamp_diff("MICROSECOND", epoch_ntz(), c(ts))


def from_epoch_micros(us) -> Column:
    return F.timestamp_add("MICROSECOND", c(us), epoch_ntz())


def duration_seconds(start, end) -> Column:
    """(end - start) in seconds as double (SC17). Exact on NTZ, no DST effect."""
    return F.timestamp_diff("MICROSECOND", c(start), c(end)) / 1e6


def duration_hours(start, end) -> Column:
    return F.timestamp_diff("MICROSECOND", c(start), c(end)) / 3.6e9


def time_text(ts) -> Column:
    """Time of day as 'HH:mm:ss' text (the Spark stand-in for ``datetime.time``)."""
    return F.date_format(c(ts), "HH:mm:ss")


# ---------------------------------------------------------------- time-of-day filters (FIL4)


def parse_time_of_day(text: str) -> int:
    """'HH:MM[:SS[.ffffff]]' -> microseconds since midnight (driver-side literal)."""
    parts = text.split(":")
    h, m = int(parts[0]), int(parts[1])
    s = float(parts[2]) if len(parts) > 2 else 0.0
    return int(round((h * 3600 + m * 60 + s) * MICROS_PER_SECOND))


def between_time(ts, start: str, end: str) -> Column:
    """True when the time of day lies in [start, end], both ends inclusive; wraps midnight when start > end."""
    tod = micros_of_day(ts)
    a, b = parse_time_of_day(start), parse_time_of_day(end)
    if a <= b:
        return (tod >= a) & (tod <= b)
    return (tod >= a) | (tod <= b)


# ---------------------------------------------------------------- bins


def bin_start(ts, every_seconds: int, offset_seconds: int = 0) -> Column:
    """Start of the clock-aligned bin of ``every_seconds`` containing ``ts`` (bins start at ``offset``).

    Equal to pandas ``resample(rule, offset=...)`` with the default ``start_day`` origin whenever the
    rule divides a day, which holds for every rule used here (1 min, 15 min, 1 h, 1 day).
    """
    step = every_seconds * MICROS_PER_SECOND
    off = offset_seconds * MICROS_PER_SECOND
    us = epoch_micros(ts) - F.lit(off)
    return from_epoch_micros(F.floor(us / F.lit(step)).cast("long") * F.lit(step) + F.lit(off))


def minute_bin(ts) -> Column:
    return bin_start(ts, 60)


def quarter_hour_bin(ts) -> Column:
    return bin_start(ts, 900)


def noon_day_bin(ts) -> Column:
    """24 h bin running 12:00 -> 12:00, labelled by its start (``resample('1D', offset='12h')``)."""
    return bin_start(ts, SECONDS_PER_DAY, 12 * 3600)


def week_label(ts) -> Column:
    """Weekly bin Mon 00:00 .. Sun 24:00 labelled with the Sunday 00:00 (``resample('1W')``)."""
    return F.next_day(F.date_sub(F.to_date(c(ts)), 1), "Sun").cast("timestamp_ntz")


# ---------------------------------------------------------------- angles (SC1-SC3)


def time_angle(ts) -> Column:
    """Time of day on a 24 h circle in degrees: 360 * second_of_day / 86400, sub-second dropped."""
    return second_of_day(ts) / 240.0


def angle_to_hms_text(angle) -> Column:
    """Angle in degrees -> 'HH:MM:SS' (components truncated); null stays null."""
    s = F.floor(c(angle) * 240.0).cast("long")
    return F.when(
        c(angle).isNotNull(),
        F.format_string("%02d:%02d:%02d", F.floor(s / 3600).cast("int"),
                        F.floor((s % 3600) / 60).cast("int"), (s % 60).cast("int")),
    )


def hms_text_to_seconds(text) -> Column:
    """'HH:MM:SS' -> second of day (SC3)."""
    parts = F.split(c(text), ":")
    return (F.try_element_at(parts, F.lit(1)).cast("int") * 3600
            + F.try_element_at(parts, F.lit(2)).cast("int") * 60
            + F.coalesce(F.try_element_at(parts, F.lit(3)).cast("int"), F.lit(0)))


# ---------------------------------------------------------------- time zones (SC8-SC11)


def _as_instant(ts) -> Column:
    """Reinterpret a wall-clock NTZ value as an instant with the same microseconds (no zone involved)."""
    return F.timestamp_micros(epoch_micros(ts))


def _tz(tz) -> Column:
    return F.lit(tz) if isinstance(tz, str) else c(tz)


def _utc_micros_of_local(ts, tz) -> Column:
    """Read ``ts`` as wall time in ``tz``; microseconds of the UTC wall time of that instant.

    ``to_utc_timestamp`` resolves a skipped wall time with the offset before the gap and a repeated one
    with the earlier (summer) offset, like ``java.time``.
    """
    return F.unix_micros(F.to_utc_timestamp(_as_instant(ts), _tz(tz)))


def localize(ts, tz="Europe/London") -> Column:
    """UTC reading -> local wall clock, offset looked up by treating the UTC reading as if local (SC8).

    Repeated hour -> summer offset, skipped hour -> the offset after the gap. ``tz`` is a zone name or
    a column of zone names. Independent of the session time zone.
    """
    u = _utc_micros_of_local(ts, tz)
    local_of_u = F.unix_micros(F.from_utc_timestamp(F.timestamp_micros(u), _tz(tz)))
    return F.timestamp_add("MICROSECOND", local_of_u - u, c(ts))


def localize_zones(df, columns: list[str], zones: list[str] | None = None, default: str = "Europe/London",
                   zone_col: str = "timezone"):
    """UTC readings to local wall clocks for several columns (SC8). Without ``zones`` every row gets the default
    zone. With ``zones`` each row is read in its own ``zone_col``, and rows of other zones are dropped; a name
    that is no zone is an error."""
    import zoneinfo
    unknown = sorted(z for z in [*(zones or [default])] if z not in zoneinfo.available_timezones())
    if unknown:
        raise ValueError(f"unknown time zones: {', '.join(unknown)}")
    if zones is None:
        df = df.withColumn(zone_col, F.lit(default))
        tz = default
    else:
        df, tz = df.where(F.col(zone_col).isin(zones)), F.col(zone_col)
    for name in columns:
        df = df.withColumn(name, localize(name, tz))
    return df


def utc_to_local(ts, tz="Europe/London", shift_hours: int = -2) -> Column:
    """UTC -> local with an hour shift; repeated hour -> summer offset, skipped hour -> offset before (SC9)."""
    off = epoch_micros(ts) - _utc_micros_of_local(ts, tz)
    return F.timestamp_add("MICROSECOND", off + F.lit(shift_hours * 3_600_000_000), c(ts))


def epoch_to_local(seconds, tz="Europe/London", shift_hours: int = 0) -> Column:
    """Epoch seconds -> UTC wall time -> local (as ``utc_to_local``, SC10)."""
    utc = from_epoch_micros((c(seconds) * MICROS_PER_SECOND).cast("long"))
    return utc_to_local(utc, tz, shift_hours)


def last_sunday(year, month) -> Column:
    """Date of the last Sunday of a month (SC12)."""
    first = F.make_date(c(year), c(month), F.lit(1))
    return F.next_day(F.date_sub(F.last_day(first), 7), "Sun")


def dst_shift_hours(ts, years: list[int], shift_time_hours: int = 12,
                    summer_shift: int = 0, winter_shift: int = -1) -> Column:
    """Hour shift of the clock-change window that holds ``ts`` (SC11).

    A change takes effect ``shift_time_hours`` before midnight of the last Sunday of March or October. From
    the March change of a listed year to its October change the summer shift holds, else the winter shift;
    null before the first listed March change and from the last listed October change on.
    """
    day = (c(ts) + F.make_dt_interval(F.lit(0), F.lit(shift_time_hours))).cast("date")
    year = F.year(day)
    summer = year.isin(sorted(years)) & (day >= last_sunday(year, F.lit(3))) & (day < last_sunday(year, F.lit(10)))
    inside = (day >= last_sunday(F.lit(min(years)), F.lit(3))) & (day < last_sunday(F.lit(max(years)), F.lit(10)))
    return F.when(inside, F.when(summer, F.lit(summer_shift)).otherwise(F.lit(winter_shift)))


def iso_text(ts) -> Column:
    """Timestamp -> ISO text with microseconds and a 'Z' suffix (SC13)."""
    return F.date_format(c(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def iso_from_text(text) -> Column:
    """Date text ('2021-06-09' or '2021-06-09 08:10') -> ISO text (SC13)."""
    return iso_text(F.to_timestamp_ntz(c(text)))


def is_instant(df, col: str) -> bool:
    """SC14: whether a column holds instants (``TIMESTAMP``, zone-aware) rather than wall-clock time
    (``TIMESTAMP_NTZ``). Decided from the schema on the driver, no pass over the data."""
    from pyspark.sql import types as T
    return isinstance(df.schema[col].dataType, T.TimestampType)
