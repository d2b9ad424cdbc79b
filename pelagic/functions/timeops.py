"""Date / time helpers (F-01..F-06, F-12..F-17, F-19, F-23, F-24).

All arithmetic is on built-in expressions; timestamps read from parquet may be
TIMESTAMP_NTZ, which is treated as wall-clock time in the zone the data was
recorded in (sessions run in UTC).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from pelagic.functions.nulls import _c


def ymd_parts(ts: str | Column) -> dict[str, Column]:
    """F-01 + F-02: Year, Month, Day and the ``HH:mm:ss`` time of day."""
    t = _c(ts)
    return {
        "Year": F.year(t),
        "Month": F.month(t),
        "Day": F.dayofmonth(t),
        "Time_24hr": F.date_format(t, "HH:mm:ss"),
    }


def local_to_utc(ts: str | Column, tz: str | Column, ambiguous: str = "post") -> Column:
    """F-03: wall-clock local time in zone ``tz`` (per row) -> UTC wall clock.

    A local time inside a spring-forward gap rolls forward (N-19).  A local
    time repeated at the autumn change resolves to the later instant
    (``ambiguous="post"``, standard time) or the earlier one (``"pre"``).
    """
    z = tz if isinstance(tz, Column) else F.lit(tz)
    local = _c(ts).cast("timestamp")
    u1 = F.to_utc_timestamp(local, z)  # earlier instant on an overlap
    if ambiguous == "post":
        def offset_us(u: Column) -> Column:
            return F.unix_micros(F.from_utc_timestamp(u, z)) - F.unix_micros(u)
        # offset drop right after u1 (positive only around the end of DST)
        delta = offset_us(u1) - offset_us(F.timestamp_add("HOUR", F.lit(3), u1))
        u2 = F.timestamp_micros(F.unix_micros(u1) + delta)
        repeated = (delta > 0) & (F.from_utc_timestamp(u2, z) == local)
        u1 = F.when(repeated, u2).otherwise(u1)
    return u1.cast("timestamp_ntz")


def utc_to_local(ts: str | Column, tz: str | Column) -> Column:
    """F-04: UTC wall clock -> local wall clock in ``tz``."""
    z = tz if isinstance(tz, Column) else F.lit(tz)
    return F.from_utc_timestamp(_c(ts).cast("timestamp"), z).cast("timestamp_ntz")


def trip_code(site: str | Column, ts: str | Column, with_time: Column | bool = False) -> Column:
    """F-06: ``<site><yyyyMMdd>``, optionally ``_HH:mm`` appended (per-row boolean allowed)."""
    t = _c(ts)
    base = F.concat(_c(site), F.date_format(t, "yyyyMMdd"))
    timed = F.concat(base, F.lit("_"), F.date_format(t, "HH:mm"))
    if isinstance(with_time, Column):
        return F.when(with_time, timed).otherwise(base)
    return timed if with_time else base


def epoch_micros(ts: str | Column) -> Column:
    """Microseconds since 1970 for TIMESTAMP or TIMESTAMP_NTZ (NTZ read as UTC)."""
    return F.unix_micros(_c(ts).cast("timestamp"))


def hours_between(a: str | Column, b: str | Column) -> Column:
    """F-23: absolute difference in true hours (D-06)."""
    return F.abs(epoch_micros(a) - epoch_micros(b)) / F.lit(3.6e9)


def days_since(ts: str | Column, epoch: str) -> Column:
    """F-16: fractional days since ``epoch`` (e.g. '1950-01-01')."""
    e = F.unix_micros(F.lit(epoch).cast("timestamp"))
    return (epoch_micros(ts) - e) / F.lit(86400e6)


def from_days_since(days: str | Column, epoch: str) -> Column:
    """F-16 inverse: numeric days since ``epoch`` -> TIMESTAMP_NTZ (microsecond precision)."""
    e = F.unix_micros(F.lit(epoch).cast("timestamp"))
    return F.timestamp_micros(e + F.round(_c(days) * F.lit(86400e6)).cast("long")).cast("timestamp_ntz")


def decimal_year(ts: str | Column) -> Column:
    """F-17: year + elapsed share of that year (leap years have 366 days)."""
    t = _c(ts)
    start = F.make_timestamp_ntz(F.year(t), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    nxt = F.make_timestamp_ntz(F.year(t) + 1, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    return F.year(t) + (epoch_micros(t) - epoch_micros(start)) / (epoch_micros(nxt) - epoch_micros(start))


def eight_day_composite(ts: str | Column) -> dict[str, Column]:
    """F-12: 8-day composite window of a date.

    day-of-year capped at 361; end = round_half_even(day/8)*8 with 0 -> 8;
    start = end - 7 (regular composites, D-10).  A null date has no composite.
    """
    doy = F.dayofyear(_c(ts))
    d = F.when(doy.isNotNull(), F.least(doy, F.lit(361)))
    end = (F.bround(d / F.lit(8.0), 0) * 8).cast("int")
    end = F.when(end == 0, F.lit(8)).otherwise(end)
    return {"comp_start_doy": end - 7, "comp_end_doy": end}


def month_composite(ts: str | Column) -> dict[str, Column]:
    """F-13: first and last day-of-year of the date's month (D-11: true month end)."""
    t = _c(ts)
    first = F.trunc(t.cast("date"), "month")
    return {"month_start_doy": F.dayofyear(first), "month_end_doy": F.dayofyear(F.last_day(t.cast("date")))}


def month_sequence(start: str | Column, end: str | Column) -> Column:
    """F-15: array of month starts from start's month to end's month inclusive."""
    s = F.trunc(_c(start).cast("date"), "month")
    e = F.trunc(_c(end).cast("date"), "month")
    return F.sequence(s, e, F.expr("INTERVAL 1 MONTH"))


def whole_months_between(start: str | Column, end: str | Column) -> Column:
    """F-15: whole-month count between two dates (month granularity, end month included)."""
    s, e = _c(start), _c(end)
    return (F.year(e) - F.year(s)) * 12 + (F.month(e) - F.month(s)) + 1


def harmonic(doy: str | Column, mean: str | Column, an_cos: str | Column, an_sin: str | Column,
             sa_cos: str | Column, sa_sin: str | Column) -> Column:
    """F-19: mean + ac cos t + as sin t + sc cos 2t + ss sin 2t with t = 2 pi DOY / 366."""
    t = _c(doy) * F.lit(2 * math.pi / 366.0)
    return (_c(mean) + _c(an_cos) * F.cos(t) + _c(an_sin) * F.sin(t)
            + _c(sa_cos) * F.cos(2 * t) + _c(sa_sin) * F.sin(2 * t))


def parse_ts(text: str | Column, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """F-24: text -> timestamp; bad text gives null instead of an error (N-14)."""
    return F.try_to_timestamp(_c(text), F.lit(fmt)).cast("timestamp_ntz")


def kelvin_to_celsius(c: str | Column) -> Column:
    """F-20."""
    return _c(c) - F.lit(273.15)
