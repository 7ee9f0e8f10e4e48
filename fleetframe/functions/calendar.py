"""Calendar columns derived from the fractional ``DayNum`` encoding.

``DayNum``: the integer part counts days with day 1 = 2017-11-01; the
fraction is the time of day.  All arithmetic is time-zone free.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from fleetframe.functions.numeric import _c

# Fixed value: day 0 of the DayNum encoding (day 1 is the next day).
DAYNUM_EPOCH = "2017-10-31"
# Rush-hour windows, inclusive hours.
RUSH_HOURS = ((7, 9), (17, 19))
# Dayofweek codes counted as weekend (1 = Sunday, 7 = Saturday).
WEEKEND_DAYS = (1, 7)
# 2*pi/24 as a double (a SQL literal would be a decimal).
HOUR_ANGLE = 2 * math.pi / 24


def daynum_date(daynum="DayNum") -> Column:
    return F.date_add(F.lit(DAYNUM_EPOCH).cast("date"), F.floor(_c(daynum)).cast("int"))


def day_fraction(daynum="DayNum") -> Column:
    d = _c(daynum)
    return d - F.floor(d)


def daynum_hour(daynum="DayNum") -> Column:
    return F.floor(day_fraction(daynum) * 24).cast("int")


def daynum_minute(daynum="DayNum") -> Column:
    hours = day_fraction(daynum) * 24
    return F.floor((hours - F.floor(hours)) * 60).cast("int")


def _two(x: Column) -> Column:
    return F.lpad(x.cast("string"), 2, "0")


def clock_text(date: Column, seconds_of_day: Column) -> Column:
    """'yyyy-MM-dd HH:mm:ss' for a date plus a (possibly > 1 day) second offset."""
    secs = seconds_of_day.cast("long")
    days = F.floor(secs / 86400).cast("int")
    rem = secs - days.cast("long") * 86400
    hh = F.floor(rem / 3600).cast("int")
    mm = F.floor((rem - hh * 3600) / 60).cast("int")
    ss = (rem - hh * 3600 - mm * 60).cast("int")
    return F.concat(F.date_add(date, days).cast("string"), F.lit(" "),
                    _two(hh), F.lit(":"), _two(mm), F.lit(":"), _two(ss))


def start_datetime_text(daynum="DayNum") -> Column:
    """Trip start as text at minute precision ('yyyy-MM-dd HH:mm:00')."""
    return F.concat(daynum_date(daynum).cast("string"), F.lit(" "),
                    _two(daynum_hour(daynum)), F.lit(":"), _two(daynum_minute(daynum)), F.lit(":00"))


def end_datetime_text(daynum="DayNum", duration_seconds="duration_seconds") -> Column:
    """Trip end as text: the start instant plus the whole seconds of the trip."""
    start_secs = daynum_hour(daynum) * 3600 + daynum_minute(daynum) * 60
    return clock_text(daynum_date(daynum), start_secs + F.floor(_c(duration_seconds)))


def is_rush_hour(hour="trip_hour") -> Column:
    h = _c(hour)
    cond = None
    for lo, hi in RUSH_HOURS:
        part = (h >= lo) & (h <= hi)
        cond = part if cond is None else (cond | part)
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def is_weekend(dayofweek="trip_dayofweek") -> Column:
    return F.when(_c(dayofweek).isin(*WEEKEND_DAYS), F.lit(1)).otherwise(F.lit(0))


def hour_sin(hour="trip_hour", scale: int = 4) -> Column:
    return F.round(F.sin(_c(hour) * F.lit(HOUR_ANGLE)), scale)


def hour_cos(hour="trip_hour", scale: int = 4) -> Column:
    return F.round(F.cos(_c(hour) * F.lit(HOUR_ANGLE)), scale)
