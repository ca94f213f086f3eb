import pytest
from pyspark.sql import types as T

from exactsync.errors import SyncError, prevailing
from exactsync.types import ColumnType, compatible, exact_decimal, integer, of_field, of_spark, of_sql


@pytest.mark.parametrize(
    "sql, spark_type",
    [
        ("BOOLEAN", T.BooleanType()),
        ("tinyint(1)", T.ByteType()),
        ("tinyint unsigned", T.ShortType()),
        ("smallint", T.ShortType()),
        ("smallint(5) unsigned", T.IntegerType()),
        ("mediumint", T.IntegerType()),
        ("int unsigned", T.LongType()),
        ("bigint", T.LongType()),
        ("bigint(20) unsigned", T.DecimalType(20, 0)),
        ("year", T.IntegerType()),
        ("float", T.FloatType()),
        ("real", T.DoubleType()),
        ("decimal", T.DecimalType(38, 0)),
        ("decimalv3(15,2)", T.DecimalType(15, 2)),
        ("decimal(65,5)", T.StringType()),
        ("largeint", T.StringType()),
        ("datev2", T.DateType()),
        ("datetime(3)", T.TimestampNTZType()),
        ("timestamp", T.TimestampType()),
        ("time(6)", T.DayTimeIntervalType()),
        ("enum('a','b')", T.StringType()),
        ("longtext", T.StringType()),
        ("varbinary(64)", T.BinaryType()),
        ("bit(8)", T.BinaryType()),
    ],
)
def test_sql_types(sql, spark_type):
    assert of_sql(sql).spark == spark_type


@pytest.mark.parametrize("sql", ["array<int>", "map<string,int>", "struct<a:int>", "hll", "bitmap", "variant", "geometry"])
def test_unsupported_sql_types(sql):
    with pytest.raises(SyncError) as e:
        of_sql(sql)
    assert e.value.code == "TYPE"


def test_limits_survive_in_field_metadata():
    for t in (of_sql("largeint"), of_sql("decimal(65,5)"), of_sql("datetime(3)"), of_sql("int unsigned")):
        assert of_field(t.field("x")) == t


def test_catalog_numbers_win_over_text():
    assert of_sql("decimal", 12, 4) == exact_decimal(12, 4)
    assert of_sql("datetime", datetime_precision=0).second_digits == 0


def test_nested_types_are_refused():
    for nested in (T.ArrayType(T.FloatType()), T.MapType(T.StringType(), T.IntegerType()), T.StructType([])):
        with pytest.raises(SyncError):
            _ = of_spark(nested).kind


BOOL, INT, DBL = of_spark(T.BooleanType()), integer(32), of_spark(T.DoubleType())
STR, BIN, DATE = of_spark(T.StringType()), of_spark(T.BinaryType()), of_spark(T.DateType())
TS, NTZ, SPAN = of_spark(T.TimestampType()), of_spark(T.TimestampNTZType()), of_spark(T.DayTimeIntervalType())
WIDE, NULL = exact_decimal(65, 5), of_spark(T.NullType())


@pytest.mark.parametrize(
    "src, dst, allowed",
    [
        (INT, DBL, True),
        (DBL, WIDE, True),
        (WIDE, INT, True),
        (BOOL, INT, True),
        (DBL, BOOL, True),
        (BOOL, BOOL, True),
        (TS, NTZ, True),
        (NTZ, TS, True),
        (NULL, BIN, True),
        (NULL, INT, True),
        (STR, STR, True),
        (STR, INT, False),
        (STR, WIDE, False),
        (WIDE, STR, False),
        (INT, STR, False),
        (DATE, NTZ, False),
        (NTZ, DATE, False),
        (BIN, STR, False),
        (SPAN, INT, False),
        (SPAN, SPAN, True),
        (BOOL, STR, False),
    ],
)
def test_compatibility(src, dst, allowed):
    assert compatible(src, dst) is allowed


def test_covers_looks_at_ranges_and_precision():
    assert not integer(8, unsigned=True).covers(integer(16))
    assert integer(16).covers(integer(8, unsigned=True))
    assert not of_sql("datetime(3)").covers(NTZ)
    assert NTZ.covers(of_sql("datetime(3)"))
    assert ColumnType(T.LongType()).covers(integer(64))


def test_prevailing_error():
    first, cancelled = SyncError("TYPE", "a"), SyncError("CANCELLED", "b")
    unknown = SyncError.unknown("c")
    assert prevailing(None, first) is first
    assert prevailing(first, SyncError("IO", "x")) is first
    assert prevailing(first, unknown) is unknown
    assert prevailing(cancelled, first) is first
    assert SyncError.server(1213, "deadlock").retryable
    assert not SyncError.server(1062, "duplicate").retryable
