"""Lossless conversion between column types as JVM-side expressions (no Python per row).

``exact_cast`` gives NULL where the target type cannot hold the value exactly; nothing is
rounded, truncated or saturated. The mapping turns such a NULL into an error and ``lost``
reports it, so the same expression serves the copy and the violation report.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from exactsync.errors import SyncError
from exactsync.functions import decimals
from exactsync.functions.times import (
    bindable_year,
    interval_micros,
    precise_to,
    shift_instant_to_wall,
    shift_wall_to_instant,
    time_in_range,
)
from exactsync.types import ColumnType, compatible, exact_decimal, without_limits

_TWO_63 = float(2**63)
_WIDEST = 38


def exact_cast(value: Column, src: ColumnType, dst: ColumnType, offset: int = 0) -> Column:
    """``value`` as ``dst``; NULL where that would change it. ``offset`` is the zone in seconds."""
    if not compatible(src, dst):
        raise SyncError.type(f"Incompatible {src.describe()} -> {dst.describe()}; convert explicitly")
    if src.kind == "null":
        return F.lit(None).cast(dst.spark)
    if dst.covers(src):
        return value
    converted = _convert(value, src, dst, offset)
    known = src.range
    narrow = dst.length is not None or dst.sql_range
    if not narrow and dst.bounds is not None and known is not None and dst.bounds[0] <= known[0] and known[1] <= dst.bounds[1]:
        return converted
    return _limited(converted, dst)


def lost(value: Column, converted: Column) -> Column:
    """True where a present value has no exact counterpart."""
    return value.isNotNull() & converted.isNull()


def _limited(converted: Column, dst: ColumnType) -> Column:
    if dst.bounds is not None:
        low, high = dst.bounds
        if dst.kind == "digits":
            width = dst.digits[0]
            return decimals.once(converted, lambda t: F.when(decimals.within_digits(t, low, high, width), t))
        if dst.kind == "decimal":
            inside = converted.between(F.lit(Decimal(low)), F.lit(Decimal(high)))
        else:
            inside = converted.between(F.lit(low), F.lit(high))
        converted = F.when(inside, converted)
    if dst.second_digits is not None and dst.second_digits < 6:
        converted = F.when(precise_to(converted, dst), converted)
    if dst.length is not None:
        size = F.octet_length(converted) if dst.kind == "binary" else F.char_length(converted)
        converted = F.when(size <= dst.length, converted)
    if dst.sql_range:
        inside = time_in_range(interval_micros(converted)) if dst.kind == "duration" else bindable_year(converted)
        converted = F.when(inside, converted)
    return converted


def _convert(value: Column, src: ColumnType, dst: ColumnType, offset: int) -> Column:
    a, b = src.kind, dst.kind
    if a == b and src.spark == dst.spark and src.digits == dst.digits:
        return value
    if a in ("instant", "wall"):
        if a == b:
            return value
        return shift_instant_to_wall(value, offset) if b == "wall" else shift_wall_to_instant(value, offset)
    if a == b and not src.numeric:
        # Two spellings of one kind, such as varchar and string or interval units.
        other = value.cast(dst.spark)
        return F.when(other.cast(src.spark) == value, other)
    if a == "boolean":
        return exact_cast(value.cast("int"), ColumnType(T.IntegerType()), dst)
    if b == "boolean":
        return _to_boolean(value, src)
    return _NUMERIC[a, b](value, src, dst)


def _to_boolean(value: Column, src: ColumnType) -> Column:
    if src.kind == "digits":
        plain = decimals.parse_decimal(value, 1, 0)
        return F.when(plain == "0", F.lit(False)).when(plain == "1", F.lit(True))
    zero = value == 0
    if src.kind == "float":
        zero = zero & ~decimals.negative_zero(value)
    return F.when(zero, F.lit(False)).when(value == 1, F.lit(True))


# Range checks come before casts: a cast that overflows is answered by an exception inside Spark,
# which costs a hundred times the cast.


def _between(value: Column, low: int, high: int, kind: str) -> Column:
    wrap = (lambda n: F.lit(Decimal(n))) if kind == "decimal" else F.lit
    return value.between(wrap(low), wrap(high))


def _whole(value: Column, src: ColumnType, dst: ColumnType) -> Column:
    """Cast to an integer type where it fits, fractions cut off."""
    low, high = without_limits(dst).range
    known = src.range
    if known is not None and low <= known[0] and known[1] <= high:
        return value.cast(dst.spark)
    if src.kind == "decimal":
        room = 10 ** (src.spark.precision - src.spark.scale)
        if room <= high:
            return value.cast(dst.spark)
    return F.when(_between(value, low, high, src.kind), value.cast(dst.spark))


def _integer_to_integer(value: Column, src: ColumnType, dst: ColumnType) -> Column:
    return _whole(value, src, dst)


def _integer_to_float(value: Column, src: ColumnType, dst: ColumnType) -> Column:
    as_float = value.cast(dst.spark)
    exact = 2**24 if isinstance(dst.spark, T.FloatType) else 2**53
    low, high = src.range
    if -exact <= low and high <= exact:
        return as_float
    # The largest bigint rounds up to 2**63, and casting that back saturates to the input.
    back = F.when(as_float < F.lit(_TWO_63), as_float.cast("bigint"))
    return F.when(back == value.cast("bigint"), as_float)


def _integer_to_decimal(value: Column, src: ColumnType, dst: ColumnType) -> Column:
    room = 10 ** (dst.spark.precision - dst.spark.scale)
    low, high = src.range
    if -room < low and high < room:
        return value.cast(dst.spark)
    return F.when(_between(value, max(low, 1 - room), min(high, room - 1), "integer"), value.cast(dst.spark))


def _integer_to_digits(value: Column, src: ColumnType, dst: ColumnType) -> Column:
    precision, scale = dst.digits
    text = value.cast("string")
    if precision - scale >= 19:
        return F.concat(text, F.lit("." + "0" * scale)) if scale else text
    return decimals.parse_decimal(text, precision, scale)


def _float_to_integer(value: Column, src: ColumnType, dst: ColumnType) -> Column:
    low, high = without_limits(dst).range
    inside = (value >= F.lit(float(low))) & (value < F.lit(float(high + 1)))
    whole = F.when(inside, value.cast("bigint"))
    return F.when((whole.cast(src.spark) == value) & ~decimals.negative_zero(value), whole.cast(dst.spark))


def _float_to_float(value: Column, src: ColumnType, dst: ColumnType) -> Column:
    if isinstance(dst.spark, T.DoubleType):
        return value.cast(dst.spark)
    other = value.cast(dst.spark)
    return F.when(other.cast(src.spark) == value, other)


def _float_to_decimal(value: Column, src: ColumnType, dst: ColumnType) -> Column:
    t = dst.spark
    if isinstance(src.spark, T.FloatType):
        # The decimal prints the float, not the double it widens to; from 2**53 on it is the stored number.
        wide = value.cast("double")
        stored = decimals.double_to_decimal(wide, t.precision, t.scale)
        number = F.when(F.abs(wide) >= F.lit(2.0**53), stored).otherwise(wide.try_cast(t))
        return F.when((number.cast(src.spark) == value) & ~decimals.negative_zero(value), number)
    return F.when(~decimals.negative_zero(value), decimals.double_to_decimal(value, t.precision, t.scale))


def _float_to_digits(value: Column, src: ColumnType, dst: ColumnType) -> Column:
    precision, scale = dst.digits
    near = min(scale, 17)
    number = _float_to_decimal(value, src, exact_decimal(_WIDEST, near))
    short = decimals.parse_decimal(decimals.print_decimal(number, near), precision, scale)
    # What no Spark decimal holds: numbers of 1e38 and more, and fractions of more digits.
    far = F.when(value.isNotNull(), decimals.double_to_digits(value, precision, scale))
    return F.coalesce(short, far) if precision - scale > _WIDEST - near or scale > near else short


def _decimal_to_integer(value: Column, src: ColumnType, dst: ColumnType) -> Column:
    whole = _whole(value, src, dst)
    if src.spark.scale == 0:
        return whole
    return F.when(whole.cast(src.spark) == value, whole)


def _decimal_to_float(value: Column, src: ColumnType, dst: ColumnType) -> Column:
    t = src.spark
    as_float = value.cast(dst.spark)
    # So many digits survive the way to binary and back, whatever they are.
    safe = 6 if isinstance(dst.spark, T.FloatType) else 15
    if t.precision <= safe:
        return as_float
    back = decimals.double_to_decimal(as_float.cast("double"), t.precision, t.scale)
    checked = F.when(back == value, as_float)
    if safe < t.scale:
        return checked
    return F.when(F.abs(value) < F.lit(Decimal(10) ** (safe - t.scale)), as_float).otherwise(checked)


def _decimal_to_decimal(value: Column, src: ColumnType, dst: ColumnType) -> Column:
    a, b = src.spark, dst.spark
    if b.scale >= a.scale and b.precision - b.scale >= a.precision - a.scale:
        return value.cast(b)
    # Comparing in the source type: a wider common type could itself drop fraction digits.
    other = value.try_cast(b)
    if b.precision - b.scale < a.precision - a.scale:
        room = F.lit(Decimal(10) ** (b.precision - b.scale))
        other = F.when(F.abs(value) < room, other)
    return F.when(other.try_cast(a) == value, other)


def _decimal_to_digits(value: Column, src: ColumnType, dst: ColumnType) -> Column:
    precision, scale = dst.digits
    a = src.spark
    text = decimals.print_decimal(value, a.scale)
    if scale >= a.scale and precision - scale >= a.precision - a.scale:
        missing = "0" * (scale - a.scale)
        fill = missing if a.scale or not scale else "." + missing
        return F.concat(text, F.lit(fill)) if fill else text
    return decimals.parse_decimal(text, precision, scale)


def _digits_to_decimal(value: Column, src: ColumnType, dst: ColumnType) -> Column:
    t, scale = dst.spark, src.digits[1]
    if t.precision - t.scale > _WIDEST - scale:
        return decimals.parse_decimal(value, t.precision, t.scale).cast(t)
    # All whole digits the target has room for fit next to the source's fraction digits, so
    # Spark can read the text; its own rules are too lax (it takes '1e3'), hence the pattern. It also keeps out
    # texts with more whole digits, which Spark answers by an exception.
    wide = exact_decimal(_WIDEST, scale)
    read = F.when(value.rlike(decimals.plain_pattern(scale, _WIDEST - scale)), value.try_cast(wide.spark))
    return read if wide.spark == t else decimals.once(read, lambda d: _decimal_to_decimal(d, wide, dst))


def _digits_to_integer(value: Column, src: ColumnType, dst: ColumnType) -> Column:
    return decimals.parse_decimal(value, _WIDEST, 0).try_cast(dst.spark)


def _digits_to_float(value: Column, src: ColumnType, dst: ColumnType) -> Column:
    wide = exact_decimal(_WIDEST, min(src.digits[1], _WIDEST))
    number = _digits_to_decimal(value, src, wide)
    short = decimals.once(number, lambda d: _decimal_to_float(d, wide, dst))
    return F.coalesce(short, F.when(value.isNotNull(), decimals.digits_to_double(value, src.digits[1], dst.spark)))


def _digits_to_digits(value: Column, src: ColumnType, dst: ColumnType) -> Column:
    return decimals.parse_decimal(value, *dst.digits)


_NUMERIC = {
    ("integer", "integer"): _integer_to_integer,
    ("integer", "float"): _integer_to_float,
    ("integer", "decimal"): _integer_to_decimal,
    ("integer", "digits"): _integer_to_digits,
    ("float", "integer"): _float_to_integer,
    ("float", "float"): _float_to_float,
    ("float", "decimal"): _float_to_decimal,
    ("float", "digits"): _float_to_digits,
    ("decimal", "integer"): _decimal_to_integer,
    ("decimal", "float"): _decimal_to_float,
    ("decimal", "decimal"): _decimal_to_decimal,
    ("decimal", "digits"): _decimal_to_digits,
    ("digits", "decimal"): _digits_to_decimal,
    ("digits", "integer"): _digits_to_integer,
    ("digits", "float"): _digits_to_float,
    ("digits", "digits"): _digits_to_digits,
}
