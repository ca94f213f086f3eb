import datetime as dt
import math
import re
import time
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from exactsync.errors import SyncError
from exactsync.functions import decimals, sizes, text, times
from exactsync.functions.casts import exact_cast
from exactsync.types import exact_decimal, integer, of_spark, of_sql

D, FL, B = of_spark(T.DoubleType()), of_spark(T.FloatType()), of_spark(T.BooleanType())
LONG, INT = integer(64), integer(32)
few = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))


def run(spark, values, src, dst, offset=0):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], T.StructType([T.StructField("i", T.IntegerType()), T.StructField("x", src.spark)]))
    rows = df.select("i", exact_cast(F.col("x"), src, dst, offset).alias("y")).collect()
    return [r.y for r in sorted(rows)]


def test_double_to_decimal(spark):
    values = [0.1, 1.25, -0.0, 0.0, 1e14, math.nan, math.inf, 123456.78, None]
    assert run(spark, values, D, exact_decimal(15, 2)) == [
        Decimal("0.10"), Decimal("1.25"), None, Decimal(0), None, None, None, Decimal("123456.78"), None,
    ]


def test_big_double_to_decimal_is_the_stored_number(spark):
    values = [2.0**60, -(2.0**100), 1e37, 1e38, 2.0**53 + 2, 0.5]
    assert run(spark, values, D, exact_decimal(38, 0)) == [
        Decimal(2**60), Decimal(-(2**100)), Decimal(int(1e37)), Decimal(int(1e38)), Decimal(2**53 + 2), None,
    ]


def test_integer_and_float(spark):
    assert run(spark, [2**63 - 1, 2**53 + 1, 2**53, -(2**63)], LONG, D) == [None, None, 2.0**53, -(2.0**63)]
    assert run(spark, [2**31 - 1, 2**24, 2**24 + 1], INT, FL) == [None, 2.0**24, None]
    assert run(spark, [2.5, 2.0**63, -(2.0**63), -0.0, math.nan, 300.0], D, LONG) == [
        None, None, -(2**63), None, None, 300,
    ]


def test_unsigned_ranges(spark):
    assert run(spark, [-1, 0, 255, 256], INT, integer(8, True)) == [None, 0, 255, None]
    assert run(spark, [-1, 5], LONG, integer(64, True)) == [None, Decimal(5)]
    top = Decimal(2**64 - 1)
    assert run(spark, [top, Decimal(7)], integer(64, True), LONG) == [None, 7]


def test_decimal_scale(spark):
    assert run(spark, [Decimal("1.001"), Decimal("1.010")], exact_decimal(9, 3), exact_decimal(9, 2)) == [
        None, Decimal("1.01"),
    ]
    assert run(spark, [Decimal("9.9"), Decimal("10.0")], exact_decimal(3, 1), exact_decimal(3, 2)) == [Decimal("9.90"), None]
    big = Decimal(2**60 + 1)
    assert run(spark, [big, Decimal(2**60)], exact_decimal(38, 0), D) == [None, 2.0**60]


def test_booleans(spark):
    assert run(spark, [0, 1, 2, None], INT, B) == [False, True, None, None]
    assert run(spark, [0.0, -0.0, 1.0, 0.5, math.nan], D, B) == [False, None, True, None, None]
    assert run(spark, ["0", "1.0", "2"], exact_decimal(65, 5), B) == [False, True, None]
    assert run(spark, [True, False], B, exact_decimal(5, 2)) == [Decimal("1.00"), Decimal("0.00")]


def test_decimal_text_vectors(spark):
    sixty = "1234567890" * 6
    wide = exact_decimal(65, 5)
    assert run(spark, [sixty + ".12345"], wide, wide) == [sixty + ".12345"]
    values = [sixty + ".12345", "1.001", "-0.0100", "1e3", " 12 ", ".5", "1.", "+5", "-0", "-0.00", "1\n", "--1", "+-1", "1.2.3", "", None]
    assert run(spark, values, exact_decimal(70, 8), exact_decimal(65, 5))[0] == sixty + ".12345"
    assert run(spark, values, exact_decimal(70, 8), exact_decimal(60, 2)) == [
        None, None, "-0.01", None, None, None, "1.00", "5.00", "0.00", "0.00", None, None, None, None, None, None,
    ]
    assert run(spark, ["-0.0100", "1.001", "12.34"], exact_decimal(65, 5), exact_decimal(4, 2)) == [
        Decimal("-0.01"), None, Decimal("12.34"),
    ]


def test_largeint_bounds(spark):
    values = [str(2**127 - 1), str(2**127), str(-(2**127)), str(-(2**127) - 1), "0", "-7"]
    assert run(spark, values, exact_decimal(40, 0), of_sql("largeint")) == [
        values[0], None, values[2], None, "0", "-7",
    ]


def test_digits_and_floats(spark):
    wide = exact_decimal(65, 5)
    assert run(spark, ["1.50000", "0.1", "9" * 40, str(2**60) + ".0"], wide, D) == [1.5, 0.1, None, 2.0**60]
    assert run(spark, [1.5, 2.0**60, 1e38, 0.1, math.nan], D, wide) == [
        "1.50000", f"{2**60}.00000", f"{int(1e38)}.00000", "0.10000", None,
    ]


def stands_for(x, precision, scale):
    """Text of the decimal a double stands for, by whole-number arithmetic."""
    if not math.isfinite(x) or (x == 0 and math.copysign(1, x) < 0):
        return None
    exact = Decimal(int(x)) if abs(x) >= 2.0**53 else Decimal(repr(x))
    sign, digits, power = exact.as_tuple()
    whole = int("".join(map(str, digits))) * 10 ** max(0, power + scale)
    cut = 10 ** max(0, -power - scale)
    if whole % cut or whole // cut >= 10**precision:
        return None
    text = str(whole // cut).rjust(scale + 1, "0")
    return ("-" if sign and whole else "") + (f"{text[:-scale]}.{text[-scale:]}" if scale else text)


HUGE = st.one_of(
    st.floats(),
    st.floats(2.0**-1000, 2.0**220),
    st.floats(1e37, 1e66),
    st.builds(lambda m, e: float(m) * 2.0**e, st.integers(-(2**53), 2**53), st.integers(60, 163)),
    st.builds(lambda m, e: m / 10.0**e, st.integers(-(10**6), 10**6), st.integers(0, 50)),
)


@few
@given(st.lists(HUGE, min_size=40, max_size=80), st.sampled_from([(65, 0), (65, 5), (65, 30), (60, 40), (40, 2)]))
def test_doubles_of_any_size_to_digits_and_back(spark, values, digits):
    there = run(spark, values, D, exact_decimal(*digits))
    wanted = [stands_for(v, *digits) for v in values]
    # Between 2^53 and 1e38 fractions are zero; below it any decimal that gives the double back is right.
    for v, got, text in zip(values, there, wanted, strict=True):
        assert got == text or (abs(v) < 2.0**53 and got is not None and float(got) == v), v
    kept = [t for t in there if t is not None]
    assert run(spark, kept, exact_decimal(*digits), D) == [float(t) for t in kept] if kept else True


def test_long_texts_to_doubles(spark):
    x = 1234567.89 * 2.0**150
    texts = [str(int(x)), str(int(x) + 1), f"-{int(x)}", "9" * 60, "0", str(2**199), str(10**39), str(10**39 + 2**60), "000" + str(2**130)]
    assert run(spark, texts, exact_decimal(65, 0), D) == [x, None, -x, None, 0.0, 2.0**199, None, None, 2.0**130]
    small = ["0." + "0" * 39 + "1", "0." + "0" * 38 + "12", "-0." + "0" * 39 + "1", "0." + "0" * 20 + "1" * 20, "1." + "0" * 40, "1." + "0" * 39 + "1"]
    assert run(spark, small, exact_decimal(65, 40), D) == [1e-40, 1.2e-39, -1e-40, None, 1.0, None]
    assert run(spark, [1e-40, 5e-324, 2.0**-100], D, exact_decimal(65, 40)) == [small[0], None, None]
    assert run(spark, [str(2**120), str(2**120 + 1), str(2**127)], exact_decimal(65, 0), FL) == [2.0**120, None, 2.0**127]
    assert run(spark, [2.0**120, 3.4028234663852886e38, 0.5], FL, exact_decimal(65, 0)) == [str(2**120), str(int(3.4028234663852886e38)), None]
    assert run(spark, [1.1e65, -1.1e65, 9.999e64, math.inf, -0.0], D, exact_decimal(65, 0)) == [None, None, str(int(9.999e64)), None, None]


@few
@given(st.lists(st.integers(-(2**63), 2**63 - 1), min_size=30, max_size=60))
def test_bigint_round_trips(spark, values):
    for dst in (exact_decimal(20, 0), of_sql("largeint")):
        there = run(spark, values, LONG, dst)
        assert [int(v) for v in there] == values
    as_double = run(spark, values, LONG, D)
    assert [v is not None for v in as_double] == [int(float(v)) == v and float(v) < 2.0**63 for v in values]


@few
@given(st.lists(st.decimals(-(10**17), 10**17, allow_nan=False, places=4), min_size=30, max_size=60), st.integers(0, 4))
def test_scale_changes_match_exact_arithmetic(spark, values, scale):
    got = run(spark, values, exact_decimal(22, 4), exact_decimal(22, scale))
    unit = Decimal(1).scaleb(-scale)
    expected = [v.quantize(unit) if v.quantize(unit) == v else None for v in values]
    assert got == expected


@few
@given(st.lists(st.floats(), min_size=40, max_size=80))
def test_double_to_exact_decimal_matches_exact_arithmetic(spark, values):
    got = run(spark, values, D, exact_decimal(38, 0))
    for v, g in zip(values, got):
        whole = math.isfinite(v) and v == int(v) and abs(v) <= 1e38 and not (v == 0 and math.copysign(1, v) < 0)
        assert g == (Decimal(int(v)) if whole else None)


DIGITS = st.text("0123456789", min_size=0, max_size=45)


@few
@given(st.lists(st.tuples(st.sampled_from(["", "-", "+", " "]), DIGITS, st.sampled_from(["", ".", ".."]), DIGITS), min_size=30, max_size=60))
def test_parse_decimal_matches_exact_arithmetic(spark, parts):
    raws = ["".join(p) for p in parts]
    df = spark.createDataFrame(list(enumerate(raws)), "i int, x string")
    rows = df.select("i", decimals.parse_decimal(F.col("x"), 40, 6).alias("y")).orderBy("i").collect()
    for raw, row in zip(raws, rows):
        match = re.fullmatch(r"([+-]?)([0-9]+)(?:[.]([0-9]*))?", raw, flags=re.ASCII)
        expected = None
        if match:
            sign, whole, fraction = match[1], match[2].lstrip("0"), match[3] or ""
            kept = fraction[:6].ljust(6, "0")
            significant = (whole + kept).lstrip("0")
            if not fraction[6:].strip("0") and len(significant) <= 40:
                expected = ("-" if sign == "-" and significant else "") + f"{whole or '0'}.{kept}"
        assert row.y == expected, raw


def test_timestamps_shift(spark):
    df = spark.sql("SELECT timestamp'1970-01-01 00:00:00+00:00' AS t, timestamp_ntz'2024-02-29 23:30:00.123456' AS n")
    t, n = of_spark(T.TimestampType()), of_spark(T.TimestampNTZType())
    row = df.select(
        exact_cast(F.col("t"), t, n, times.offset_seconds("+08:00")).alias("east"),
        F.unix_micros(exact_cast(F.col("n"), n, t, times.offset_seconds("-05:30"))).alias("west"),
        exact_cast(F.col("n"), n, of_sql("datetime(3)")).alias("millis"),
        exact_cast(F.col("t"), t, of_sql("timestamp(0)")).alias("second"),
    ).first()
    assert row.east == dt.datetime(1970, 1, 1, 8)
    expected = dt.datetime(2024, 3, 1, 5, 0, 0, 123456, tzinfo=dt.timezone.utc)
    assert row.west == round(expected.timestamp() * 1_000_000)
    assert row.millis is None and row.second is not None


def test_offsets():
    assert times.offset_seconds("+08:00") == 28800
    assert times.offset_seconds("-14:00") == -50400
    for bad in ("Asia/Shanghai", "+14:01", "+中:1", "+-1:00", "+15:00", "+08:60", "08:00", "+8:00"):
        with pytest.raises(SyncError):
            times.offset_seconds(bad)


def test_times(spark):
    df = spark.createDataFrame([("-25:00:00.000001",), ("838:59:59",), ("839:00:00",), ("1:60:00",), ("0:0:1",)], "x string")
    micros = times.time_to_micros(F.col("x"))
    rows = df.select(micros.alias("m")).collect()
    assert [r.m for r in rows] == [-90000000001, 3020399000000, 3020400000000, None, None]
    out = spark.createDataFrame([(r.m,) for r in rows], "m bigint").select(
        times.micros_to_time(F.col("m")).alias("t"),
        times.time_parts(F.col("m")).alias("p"),
        times.micros_to_interval(F.col("m")).alias("i"),
    ).collect()
    assert [r.t for r in out] == ["-25:00:00.000001", "838:59:59.000000", None, None, None]
    assert tuple(out[0].p) == (True, 1, 1, 0, 0, 1)
    assert out[0].i == dt.timedelta(microseconds=-90000000001)


def test_dates(spark):
    df = spark.createDataFrame([("2026-09-29",), ("0000-00-00",), ("2023-02-29",), ("2024-1-1",)], "x string")
    assert [r.d for r in df.select(times.parse_date(F.col("x")).alias("d")).collect()] == [dt.date(2026, 9, 29), None, None, None]


def test_row_bytes(spark):
    df = spark.createDataFrame([("中文🚀", None, 1), (None, b"ab", None)], "s string, b binary, n int")
    assert [r[0] for r in df.select(sizes.row_bytes(df.schema)).collect()] == [10 + 16 + 16 + 32, 16 + 18 + 32]
    assert [r[0] for r in df.select(sizes.row_bytes(df.schema, "reader")).collect()] == [26 + 32 + 32, 32 + 18 + 32]
    wide = spark.createDataFrame([("1.50000",)], T.StructType([exact_decimal(65, 5).field("d")]))
    assert wide.select(sizes.row_bytes(wide.schema)).first()[0] == 32
    assert sizes.fixed_row_bytes(wide.schema) == 32 and sizes.fixed_row_bytes(df.schema) is None


def test_oversize_guard(spark):
    df = spark.createDataFrame([("x" * 100,)], "s string")
    with pytest.raises(PySparkException, match="ROW_TOO_LARGE"):
        df.select(sizes.guard_row_bytes(sizes.row_bytes(df.schema), 100)).collect()


def test_redaction_and_fingerprint(spark):
    config = '{"a":{"password": "x\\"y","user":"u"},"b":[{"password":{"env":"P"}},{"password":7}],"note":"password"}'
    df = spark.createDataFrame([(config, "a", None), (config, "a", "")], "c string, x string, y string")
    redacted = df.select(text.redact_config(F.col("c"))).first()[0]
    assert redacted.count("[REDACTED]") == 3 and "env" not in redacted and '"note":"password"' in redacted
    prints = [r[0] for r in df.select(text.fingerprint(F.col("x"), F.col("y"))).collect()]
    assert prints[0] != prints[1]


def test_labels_and_identifiers(spark):
    df = spark.createDataFrame([("0f8f-ad5b", 3)], "r string, b bigint")
    assert df.select(text.batch_label("load", F.col("r"), F.col("b"))).first()[0] == "load_0f8fad5b_3"
    assert text.quoted("a`b") == "`a``b`"
    assert text.string_literal("a'b\\") == "'a''b\\\\'"
    for bad in ("", "x" * 41, "a-b"):
        with pytest.raises(SyncError):
            text.check_label_prefix(bad)
    with pytest.raises(SyncError):
        text.quoted("a\0")


def test_nanoseconds_and_spellings(spark):
    df = spark.createDataFrame([(1_000_000_001_000,), (1_001,), (-2_000,)], "n bigint")
    micros = F.unix_micros(times.nanos_to_instant(F.col("n")))
    assert [r[0] for r in df.select(micros).collect()] == [1_000_000_001, None, -2]
    days, full = of_spark(T.DayTimeIntervalType(0, 0)), of_spark(T.DayTimeIntervalType())
    span = spark.sql("SELECT INTERVAL '1 02:00:00' DAY TO SECOND AS a, INTERVAL '3 00:00:00' DAY TO SECOND AS b")
    row = span.select(exact_cast(F.col("a"), full, days).alias("a"), exact_cast(F.col("b"), full, days).alias("b")).first()
    assert row.a is None and row.b == dt.timedelta(days=3)


def test_digits_of_huge_doubles_cost_little_per_row(spark, root):
    rows = spark.range(0, 20_000, 1, 1).select(((F.col("id") + 12345.67) * F.pow(F.lit(2.0), 60 + F.col("id") % 140)).alias("x"))
    rows.write.parquet(root)
    there = exact_cast(F.col("x"), D, exact_decimal(65, 0))
    back = exact_cast(F.col("whole"), exact_decimal(65, 0), D)
    done = spark.read.parquet(root).withColumn("whole", there).withColumn("back", back)
    began = time.monotonic()
    got = done.collect()
    assert time.monotonic() - began < 10  # limbs added in nested loops took 21 s
    assert all((r.whole, r.back) == ((str(int(r.x)), r.x) if abs(r.x) < 1e65 else (None, None)) for r in got)
