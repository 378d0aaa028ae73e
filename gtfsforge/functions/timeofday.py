"""Time-of-day column functions (O-T1, O-T8, O-T9, O-T11, O-T12).

Timetable times are text ``HH:MM[:SS]`` whose hours may pass 24 ("32-hour
time").  They stay strings at the boundary and integer seconds inside; never
timestamps.  Everything here is a built-in column expression (codegen, no UDF).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_seconds(t) -> Column:
    """``H:M[:S]`` -> seconds (O-T9).  Missing seconds count as 0; NULL stays NULL."""
    t = F.trim(_c(t))
    parts = F.split(t, ":")
    h = F.get(parts, 0).cast("int")
    m = F.get(parts, 1).cast("int")
    s = F.coalesce(F.nullif(F.get(parts, 2), F.lit("")).cast("int"), F.lit(0))
    at = lambda i, n: F.substring(t, i, n)
    # HH:MM:SS needs no list of its parts
    whole = (F.length(t) == 8) & (at(3, 1) == ":") & (at(6, 1) == ":")
    return F.when(whole, at(1, 2).cast("int") * 3600 + at(4, 2).cast("int") * 60 + at(7, 2).cast("int")).otherwise(h * 3600 + m * 60 + s)


def timediff(low, high) -> Column:
    """Seconds from ``low`` to ``high`` (O-T1); accepts HH:MM and HH:MM:SS."""
    return to_seconds(high) - to_seconds(low)


def seconds_to_time(secs) -> Column:
    """Seconds -> ``HH:MM:SS`` with hours allowed past 24."""
    s = _c(secs)
    two = lambda x: F.when(x.between(0, 9), F.concat(F.lit("0"), x.cast("string"))).otherwise(x.cast("string"))
    txt = F.concat(two(F.floor(s / 3600).cast("int")), F.lit(":"), two((F.floor(s / 60) % 60).cast("int")), F.lit(":"), two((s % 60).cast("int")))
    return F.when(s.isNotNull(), txt)


def add32time(t, secs) -> Column:
    """Time text plus seconds -> time text, hours may pass 24 (O-T8)."""
    return seconds_to_time(to_seconds(t) + _c(secs))


def hhmm(c) -> Column:
    """``HHMM`` -> ``HH:MM:00`` (O-T11); blank -> NULL."""
    v = F.trim(_c(c))
    return F.when(F.length(v) == 4, F.concat(F.substring(v, 1, 2), F.lit(":"), F.substring(v, 3, 2), F.lit(":00")))


def ddmmyyyy(c) -> Column:
    """``DDMMYYYY`` -> date (O-T11)."""
    return F.to_date(F.trim(_c(c)), "ddMMyyyy")


def fix_seconds(c, by=None) -> Column:
    """Append ``:00`` to a time when `by` (default: the time itself) has only ``HH:MM`` (O-T12).

    A row's two times are both mended by the length of the arrival.
    """
    v, by = _c(c), _c(c if by is None else by)
    return F.when(F.length(by) == 5, F.concat(v, F.lit(":00"))).otherwise(v)


def yyyymmdd(d) -> Column:
    """date -> ``YYYYMMDD`` text (O-F6)."""
    return F.date_format(_c(d), "yyyyMMdd")
