"""Column types of the engine: a Spark type plus the limits Spark has no type for.

Spark has no unsigned integers, no decimals over 38 digits and no fractional-second
precision, so a :class:`ColumnType` carries them next to the Spark type and keeps them in
``StructField.metadata`` when a schema is stored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, replace

from pyspark.sql import types as T

from exactsync.errors import SyncError

# Inclusive ranges of the integer types that need a wider Spark type.
UNSIGNED_RANGES = {
    8: (0, 255),
    16: (0, 65535),
    32: (0, 4294967295),
    64: (0, 18446744073709551615),
}
INT128_RANGE = (-(2**127), 2**127 - 1)

_SIGNED = {8: T.ByteType(), 16: T.ShortType(), 32: T.IntegerType(), 64: T.LongType()}
_UNSIGNED = {8: T.ShortType(), 16: T.IntegerType(), 32: T.LongType(), 64: T.DecimalType(20, 0)}
_NATURAL_RANGE = {
    T.ByteType(): (-(2**7), 2**7 - 1),
    T.ShortType(): (-(2**15), 2**15 - 1),
    T.IntegerType(): (-(2**31), 2**31 - 1),
    T.LongType(): (-(2**63), 2**63 - 1),
}
MAX_TEXT_DIGITS = 76


@dataclass(frozen=True)
class ColumnType:
    """``digits`` marks exact-decimal text ``(precision, scale)``; ``bounds`` limits an integer;
    ``second_digits`` limits fractional seconds of a timestamp; ``length`` limits the characters of a text or the
    bytes of a binary; ``sql_range`` holds a duration to 838:59:59 and a date or timestamp to the years 0 to 9999."""

    spark: T.DataType
    digits: tuple[int, int] | None = None
    bounds: tuple[int, int] | None = None
    second_digits: int | None = None
    length: int | None = None
    sql_range: bool = False

    @property
    def kind(self) -> str:
        t = self.spark
        if self.digits is not None:
            return "digits"
        if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            return "integer"
        if isinstance(t, (T.FloatType, T.DoubleType)):
            return "float"
        if isinstance(t, T.DecimalType):
            return "decimal"
        if isinstance(t, T.BooleanType):
            return "boolean"
        if isinstance(t, T.TimestampType):
            return "instant"
        if isinstance(t, T.TimestampNTZType):
            return "wall"
        if isinstance(t, T.DateType):
            return "date"
        if isinstance(t, T.DayTimeIntervalType):
            return "duration"
        if isinstance(t, (T.StringType, T.CharType, T.VarcharType)):
            return "string"
        if isinstance(t, T.BinaryType):
            return "binary"
        if isinstance(t, T.NullType):
            return "null"
        raise SyncError.type(f"{t.simpleString()} is no scalar; select one from it")

    @property
    def numeric(self) -> bool:
        return self.kind in ("integer", "float", "decimal", "digits")

    @property
    def range(self) -> tuple[int, int] | None:
        """Inclusive integer range of the values, None where not limited to integers."""
        return self.bounds or _NATURAL_RANGE.get(self.spark)

    def covers(self, other: "ColumnType") -> bool:
        """Every value of ``other`` is already a value of this type, bit for bit."""
        if self.spark != other.spark or self.digits != other.digits:
            return False
        if self.bounds is not None:
            theirs = other.range
            if theirs is None or theirs[0] < self.bounds[0] or theirs[1] > self.bounds[1]:
                return False
        if self.length is not None and (other.length is None or other.length > self.length):
            return False
        if self.sql_range and not other.sql_range:
            return False
        mine, their = _precision(self), _precision(other)
        return mine >= their

    def metadata(self) -> dict:
        out: dict = {}
        if self.digits is not None:
            out["exact_decimal"] = list(self.digits)
        if self.bounds is not None:
            out["bounds"] = [str(self.bounds[0]), str(self.bounds[1])]
        if self.second_digits is not None:
            out["datetime_precision"] = self.second_digits
        if self.length is not None:
            out["max_length"] = self.length
        if self.sql_range:
            out["sql_range"] = True
        return out

    def field(self, name: str, nullable: bool = True, extra: dict | None = None) -> T.StructField:
        return T.StructField(name, self.spark, nullable, {**self.metadata(), **(extra or {})})

    def describe(self) -> str:
        if self.digits is not None:
            return f"exact_decimal({self.digits[0]},{self.digits[1]})"
        text = self.spark.simpleString()
        if self.second_digits is not None:
            text += f"({self.second_digits})"
        if self.bounds is not None:
            text += f"[{self.bounds[0]}..{self.bounds[1]}]"
        if self.length is not None:
            text += f"({self.length})"
        return text


def _precision(t: ColumnType) -> int:
    return 6 if t.second_digits is None else t.second_digits


def of_field(field: T.StructField) -> ColumnType:
    """Type of a schema field, limits taken from its metadata."""
    meta = field.metadata or {}
    digits = meta.get("exact_decimal")
    bounds = meta.get("bounds")
    return ColumnType(
        field.dataType,
        tuple(digits) if digits else None,
        (int(bounds[0]), int(bounds[1])) if bounds else None,
        meta.get("datetime_precision"),
        meta.get("max_length"),
        bool(meta.get("sql_range", False)),
    )


def of_spark(t: T.DataType) -> ColumnType:
    return ColumnType(t)


def exact_decimal(precision: int, scale: int) -> ColumnType:
    """A decimal: Spark's own up to 38 digits, canonical text beyond."""
    if scale < 0 or precision < 1 or precision > MAX_TEXT_DIGITS or scale > precision:
        raise SyncError.type(f"Unsupported decimal({precision},{scale})")
    if precision <= 38:
        return ColumnType(T.DecimalType(precision, scale))
    return ColumnType(T.StringType(), digits=(precision, scale))


def integer(bits: int, unsigned: bool = False) -> ColumnType:
    if unsigned:
        return ColumnType(_UNSIGNED[bits], bounds=UNSIGNED_RANGES[bits])
    return ColumnType(_SIGNED[bits])


def _timestamp(spark_type: T.DataType, precision: int | None) -> ColumnType:
    if precision is None or precision >= 6:
        return ColumnType(spark_type, sql_range=True)
    return ColumnType(spark_type, second_digits=precision, sql_range=True)


# SQL type names that share one representation.
_INTEGER_NAMES = {"tinyint": 8, "smallint": 16, "mediumint": 32, "int": 32, "integer": 32, "bigint": 64}
_DECIMAL_NAMES = {"decimal", "decimalv2", "decimalv3"}
_TEXT_NAMES = {"varchar", "char", "text", "tinytext", "mediumtext", "longtext", "string", "json", "enum", "set"}
_BINARY_NAMES = {"binary", "varbinary", "blob", "tinyblob", "mediumblob", "longblob", "bit"}
# Of these the number in parentheses is a length.
_SIZED_NAMES = {"varchar", "char", "binary", "varbinary"}


def of_sql(
    sql: str,
    precision: int | None = None,
    scale: int | None = None,
    datetime_precision: int | None = None,
) -> ColumnType:
    """Type of a declared SQL column, e.g. ``bigint(20) unsigned`` or ``decimal(65,5)``.

    Numeric arguments come from the catalog when given, else from the text itself.
    """
    lowered = sql.strip().lower()
    base = re.split(r"[ (]", lowered, maxsplit=1)[0]
    args = re.search(r"\(([0-9, ]+)\)", lowered)
    inner = [int(a) for a in args.group(1).split(",")] if args else []
    if base in ("boolean", "bool"):
        return ColumnType(T.BooleanType())
    if base in _INTEGER_NAMES:
        return integer(_INTEGER_NAMES[base], "unsigned" in lowered)
    if base == "largeint":
        return ColumnType(T.StringType(), digits=(39, 0), bounds=INT128_RANGE)
    if base == "year":
        return integer(16, unsigned=True)
    if base == "float":
        return ColumnType(T.FloatType())
    if base in ("double", "real"):
        return ColumnType(T.DoubleType())
    if base in _DECIMAL_NAMES:
        p = precision if precision is not None else (inner[0] if inner else 38)
        s = scale if scale is not None else (inner[1] if len(inner) > 1 else 0)
        return exact_decimal(p, s)
    if base in ("date", "datev2"):
        return ColumnType(T.DateType(), sql_range=True)
    fraction = datetime_precision if datetime_precision is not None else (inner[0] if inner else None)
    if base in ("datetime", "datetimev2"):
        return _timestamp(T.TimestampNTZType(), fraction)
    if base in ("timestamp", "timestamptz"):
        return _timestamp(T.TimestampType(), fraction)
    if base == "time":
        return ColumnType(T.DayTimeIntervalType(), sql_range=True)
    if base in _TEXT_NAMES:
        return ColumnType(T.StringType(), length=inner[0] if inner and base in _SIZED_NAMES else None)
    if base in _BINARY_NAMES:
        return ColumnType(T.BinaryType(), length=inner[0] if inner and base in _SIZED_NAMES else None)
    raise SyncError.type(f"no column type stands for {sql}; select a converted value")


def compatible(src: ColumnType, dst: ColumnType) -> bool:
    """May a source column feed a target column at all (values are checked later)?"""
    a, b = src.kind, dst.kind
    if a == "null":
        return True
    if src.numeric or a == "boolean":
        return dst.numeric or b == "boolean"
    if a in ("instant", "wall"):
        return b in ("instant", "wall")
    return a == b


def without_limits(t: ColumnType) -> ColumnType:
    return replace(t, bounds=None, second_digits=None, length=None, sql_range=False)
