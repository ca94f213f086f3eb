"""Dates, timestamps, fixed zone offsets and signed time-of-day durations.

All timestamp casts here assume the session zone is UTC (``session.configure`` sets it);
zone shifts are explicit fixed offsets.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from exactsync.errors import SyncError

# The farthest zone offset and the largest TIME, 838:59:59, in seconds.
MAX_OFFSET_SECONDS = 14 * 3600
MAX_TIME_SECONDS = 838 * 3600 + 59 * 60 + 59
MICROS = 1_000_000

# Fixed value: sign, hours, minutes, seconds and up to six fraction digits.
TIME_TEXT = r"^([+-]?)([0-9]{1,4}):([0-5][0-9]):([0-5][0-9])(?:[.]([0-9]{1,6}))?\z"


def offset_seconds(zone: str) -> int:
    """Seconds of a fixed offset ``+HH:MM`` / ``-HH:MM``; zone names are refused."""
    match = re.fullmatch(r"([+-])([0-9]{2}):([0-5][0-9])", zone, flags=re.ASCII)
    if match is None:
        raise SyncError.config(f"time zone must be a fixed offset like +08:00, got {zone!r}")
    seconds = int(match[2]) * 3600 + int(match[3]) * 60
    if seconds > MAX_OFFSET_SECONDS:
        raise SyncError.config(f"time zone offset out of range: {zone}")
    return -seconds if match[1] == "-" else seconds


def _plus_seconds(ts: Column, seconds: int) -> Column:
    # A day-time interval adds exact microseconds; out-of-range sums fail the task.
    if seconds == 0:
        return ts
    return ts + F.expr(f"make_dt_interval(0, 0, 0, cast({seconds} as decimal(18, 6)))")


def shift_instant_to_wall(ts: Column, offset: int) -> Column:
    """Wall-clock time that a clock at ``offset`` shows at an instant."""
    return _plus_seconds(ts.cast("timestamp_ntz"), offset)


def shift_wall_to_instant(ts: Column, offset: int) -> Column:
    """Instant at which a clock at ``offset`` shows a wall-clock time."""
    return _plus_seconds(ts.cast("timestamp"), -offset)


def micros_of(ts: Column) -> Column:
    """Microseconds since 1970 of either timestamp type."""
    return F.unix_micros(ts.cast("timestamp"))


def has_precision(ts: Column, digits: int) -> Column:
    """The value needs no more than ``digits`` fractional-second digits."""
    if digits >= 6:
        return F.lit(True)
    return micros_of(ts) % F.lit(10 ** (6 - digits)) == 0


def precise_to(ts: Column, dst) -> Column:
    return has_precision(ts, dst.second_digits)


def nanos_to_instant(nanos: Column) -> Column:
    """Instant of nanoseconds since 1970 (as nanosecond files are read); NULL below a microsecond."""
    whole = F.when(nanos % 1000 == 0, nanos)
    return F.timestamp_micros(_div(whole, 1000))


def bindable_year(value: Column) -> Column:
    """The calendar year fits a database date, 0 to 9999."""
    return F.year(value).between(0, 9999)


def parse_date(text: Column) -> Column:
    """Date of ``YYYY-MM-DD`` text; NULL for zero and impossible dates."""
    shape = text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z") & ~text.startswith("0000")
    return F.when(shape, text.try_cast("date"))


def time_to_micros(text: Column) -> Column:
    """Signed microseconds of ``[-]H:MM:SS[.ffffff]``, hours may exceed a day; NULL if malformed."""
    number = lambda group: F.regexp_extract(text, TIME_TEXT, group).try_cast("bigint")
    fraction = F.rpad(F.regexp_extract(text, TIME_TEXT, 5), 6, "0").try_cast("bigint")
    whole = (number(2) * 3600 + number(3) * 60 + number(4)) * MICROS + fraction
    return F.when(text.rlike(TIME_TEXT), F.when(text.startswith("-"), -whole).otherwise(whole))


def interval_micros(value: Column) -> Column:
    """Signed microseconds of a day-time interval; NULL beyond what a bigint holds."""
    part = lambda field: F.extract(F.lit(field), value).cast("decimal(38,6)")
    seconds = part("DAY") * 86400 + part("HOUR") * 3600 + part("MINUTE") * 60 + part("SECOND")
    return (seconds * MICROS).try_cast("bigint")


def time_in_range(micros: Column) -> Column:
    return F.floor(F.abs(micros) / MICROS) <= MAX_TIME_SECONDS


def micros_to_time(micros: Column) -> Column:
    """Text of a signed duration, ``-25:00:00.000001``; NULL beyond 838:59:59."""
    size = F.abs(micros)
    seconds = _div(size, MICROS)
    pad = lambda c, n: F.lpad(c.cast("string"), n, "0")
    hours = _div(seconds, 3600).cast("string")
    text = F.concat(
        F.when(micros < 0, "-").otherwise(""),
        F.when(F.length(hours) < 2, F.lpad(hours, 2, "0")).otherwise(hours),
        F.lit(":"),
        pad(_div(seconds, 60) % 60, 2),
        F.lit(":"),
        pad(seconds % 60, 2),
        F.lit("."),
        pad(size % MICROS, 6),
    )
    return F.when(seconds <= MAX_TIME_SECONDS, text)


def time_parts(micros: Column) -> Column:
    """Struct of sign, days, hours, minutes, seconds and microseconds; NULL beyond 838:59:59."""
    size = F.abs(micros)
    seconds = _div(size, MICROS)
    parts = F.struct(
        (micros < 0).alias("negative"),
        _div(seconds, 86400).alias("days"),
        (_div(seconds, 3600) % 24).alias("hours"),
        (_div(seconds, 60) % 60).alias("minutes"),
        (seconds % 60).alias("seconds"),
        (size % MICROS).alias("micros"),
    )
    return F.when(seconds <= MAX_TIME_SECONDS, parts)


def micros_to_interval(micros: Column) -> Column:
    """Day-time interval of signed microseconds, as staged files hold them."""
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (micros.cast("decimal(20,0)") / MICROS).cast("decimal(18,6)"))


def _div(a: Column, n: int) -> Column:
    """Whole-number quotient of a non-negative bigint, without going through doubles."""
    return F.call_function("div", a, F.lit(n))
