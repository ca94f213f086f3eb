"""Scalar conversions: what each lossless cast keeps and what it refuses."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from exactsync.functions import decimals, text, times
from exactsync.functions.casts import exact_cast
from exactsync.functions.sizes import row_bytes
from exactsync.queries.registry import derive, load, query
from exactsync.types import exact_decimal, integer, of_spark, of_sql

_DOUBLE = of_spark(T.DoubleType())
_FLOAT = of_spark(T.FloatType())
_BIGINT = integer(64)
_INT = integer(32)
_BOOLEAN = of_spark(T.BooleanType())
_INSTANT = of_spark(T.TimestampType())
_WALL = of_spark(T.TimestampNTZType())


@query(
    "lossless_cast_double_decimal",
    """
    SELECT o_orderkey,
           CASE WHEN CAST(TRY_CAST(o_totalprice AS DECIMAL(15,1)) AS DOUBLE) = o_totalprice THEN o_totalprice END
               AS one_digit,
           CASE WHEN CAST(TRY_CAST(o_totalprice AS DECIMAL(15,2)) AS DOUBLE) = o_totalprice THEN o_totalprice END
               AS two_digits,
           CASE WHEN o_totalprice < 100000 THEN o_totalprice END AS narrow
    FROM {orders}
    """,
)
def lossless_cast_double_decimal(spark, sf):
    to = lambda p, s: exact_cast(F.col("o_totalprice"), _DOUBLE, exact_decimal(p, s)).cast("double")
    return load(spark, sf, "orders").select(
        "o_orderkey", to(15, 1).alias("one_digit"), to(15, 2).alias("two_digits"), to(7, 2).alias("narrow")
    )


_HUGE = "SELECT o_orderkey, CAST(o_orderkey AS DOUBLE) * 1152921504606846976.0 * (CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE -1 END) AS x FROM {orders}"


@query(
    "lossless_cast_big_double",
    """
    SELECT o_orderkey, CAST(CAST(o_orderkey AS HUGEINT) * 1152921504606846976
                            * (CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE -1 END) AS VARCHAR) AS exact_text
    FROM {orders}
    """,
)
def lossless_cast_big_double(spark, sf):
    # Whole doubles far beyond 2**53: the decimal must be the stored number, not its short text.
    rows = derive(spark, sf, _HUGE.replace("1152921504606846976.0", "1152921504606846976.0D"))
    value = F.when(F.col("x") == 0, F.lit(0.0)).otherwise(F.col("x"))
    exact = exact_cast(value, _DOUBLE, exact_decimal(38, 0))
    return rows.select("o_orderkey", decimals.print_decimal(exact, 0).alias("exact_text"))


_FAR = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       l_extendedprice * power({two}, CAST(l_orderkey % 201 AS DOUBLE)) * (CASE WHEN l_linenumber % 2 = 0 THEN -1 ELSE 1 END) AS x
FROM {lineitem}
"""


@query(
    "lossless_cast_huge_double",
    f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, whole,
           CASE WHEN abs(x) >= 9007199254740992 AND abs(x) < 1e65 THEN x ELSE NULL END AS back,
           CASE WHEN abs(x) >= 9007199254740992 AND abs(x) < 1e65 AND l_linenumber % 3 = 0 THEN CAST(whole AS DOUBLE) END AS altered
    FROM (SELECT *, CASE WHEN abs(x) >= 9007199254740992 AND abs(x) < 1e65 THEN CAST(CAST(x AS BIGNUM) AS VARCHAR) END AS whole
          FROM ({_FAR.replace("{two}", "2.0::DOUBLE")}))
    """,
)
def lossless_cast_huge_double(spark, sf):
    """Doubles up to 2**220: all their digits as text, that text read again, and a text that is one unit off, which is no double."""
    rows = derive(spark, sf, _FAR.replace("{two}", "2.0D"))
    rows = rows.withColumn("far", F.when(F.abs("x") >= 2.0**53, F.col("x")))
    digits = exact_decimal(65, 0)
    rows = rows.withColumn("whole", exact_cast(F.col("far"), _DOUBLE, digits))
    off = F.when(F.col("l_linenumber") % 3 == 0, F.col("whole")).otherwise(F.concat(F.col("whole"), F.lit("1")))
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "whole",
        exact_cast(F.col("whole"), digits, _DOUBLE).alias("back"),
        exact_cast(off, exact_decimal(66, 0), _DOUBLE).alias("altered"),
    )


@query(
    "lossless_cast_double_int",
    """
    SELECT l_orderkey, l_linenumber,
           CAST(CASE WHEN l_quantity = floor(l_quantity) AND l_quantity <= 40 THEN l_quantity END AS BIGINT) AS quantity,
           CAST(CASE WHEN l_extendedprice = floor(l_extendedprice) THEN l_extendedprice END AS BIGINT) AS price,
           CAST(CASE WHEN l_discount = 0 OR l_discount = 1 THEN l_discount END AS BIGINT) AS discount
    FROM {lineitem}
    """,
)
def lossless_cast_double_int(spark, sf):
    narrow = exact_cast(F.col("l_quantity") + 87, _DOUBLE, integer(8)).cast("bigint") - 87
    return load(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        narrow.alias("quantity"),
        exact_cast(F.col("l_extendedprice"), _DOUBLE, _BIGINT).alias("price"),
        exact_cast(F.col("l_discount"), _DOUBLE, _INT).cast("bigint").alias("discount"),
    )


_SPREAD = "SELECT o_orderkey, o_orderkey * 1000003 - 5000000000 AS x, o_orderkey - 7000 AS y FROM {orders}"


@query(
    "lossless_cast_bigint_int",
    f"""
    SELECT o_orderkey, CASE WHEN x BETWEEN -2147483648 AND 2147483647 THEN x END AS as_int,
           CASE WHEN y BETWEEN -128 AND 127 THEN y END AS as_tinyint,
           CASE WHEN y BETWEEN 0 AND 255 THEN y END AS as_unsigned_tinyint,
           CASE WHEN x >= 0 THEN x END AS as_unsigned_bigint
    FROM ({_SPREAD})
    """,
)
def lossless_cast_bigint_int(spark, sf):
    to = lambda c, t: exact_cast(F.col(c), _BIGINT, t).cast("bigint")
    return derive(spark, sf, _SPREAD).select(
        "o_orderkey",
        to("x", _INT).alias("as_int"),
        to("y", integer(8)).alias("as_tinyint"),
        to("y", integer(8, unsigned=True)).alias("as_unsigned_tinyint"),
        to("x", integer(64, unsigned=True)).alias("as_unsigned_bigint"),
    )


_EDGES = """
SELECT o_orderkey, 9007199254735000 + o_orderkey AS around_53_bits, 9223372036854775807 - o_orderkey AS near_top,
       16770000 + o_orderkey AS around_24_bits
FROM {orders}
"""


@query(
    "lossless_cast_bigint_double",
    f"""
    SELECT o_orderkey,
           CASE WHEN around_53_bits <= 9007199254740992 OR around_53_bits % 2 = 0 THEN around_53_bits END AS kept_53,
           CASE WHEN near_top % 1024 = 0 THEN near_top END AS kept_top,
           CASE WHEN around_24_bits <= 16777216 OR around_24_bits % 2 = 0 THEN around_24_bits END AS kept_24
    FROM ({_EDGES})
    """,
)
def lossless_cast_bigint_double(spark, sf):
    to = lambda c, t: exact_cast(F.col(c), _BIGINT, t).cast("bigint")
    return derive(spark, sf, _EDGES).select(
        "o_orderkey",
        to("around_53_bits", _DOUBLE).alias("kept_53"),
        to("near_top", _DOUBLE).alias("kept_top"),
        to("around_24_bits", _FLOAT).alias("kept_24"),
    )


@query(
    "lossless_cast_double_float",
    """
    SELECT event_id, CASE WHEN CAST(CAST(value AS FLOAT) AS DOUBLE) = value THEN value END AS kept,
           CASE WHEN CAST(CAST(value * 1e300 AS DOUBLE) AS DOUBLE) < 3e38 THEN value END AS overflowed
    FROM {events}
    """,
)
def lossless_cast_double_float(spark, sf):
    to = lambda c: exact_cast(c, _DOUBLE, _FLOAT).cast("double")
    return load(spark, sf, "events").select(
        "event_id", to(F.col("value")).alias("kept"), to(F.col("value") * 1e300).alias("overflowed")
    )


_SCALED = """
SELECT o_orderkey, CAST(concat(CAST(o_orderkey AS STRING), '.', CAST(1000 + o_custkey % 9000 AS STRING))
                        AS DECIMAL(18,4)) AS x
FROM {orders}
"""


@query(
    "lossless_cast_decimal_scale",
    f"""
    SELECT o_orderkey, CAST(CASE WHEN CAST(x AS DECIMAL(18,2)) = x THEN CAST(x AS DECIMAL(18,2)) END AS VARCHAR)
               AS two_digits,
           CAST(CAST(x AS DECIMAL(24,10)) AS VARCHAR) AS ten_digits,
           CAST(CASE WHEN x < 1000 AND CAST(x AS DECIMAL(18,1)) = x THEN CAST(x AS DECIMAL(18,1)) END AS VARCHAR)
               AS narrow
    FROM ({_SCALED})
    """,
)
def lossless_cast_decimal_scale(spark, sf):
    src = exact_decimal(18, 4)
    to = lambda p, s: decimals.print_decimal(exact_cast(F.col("x"), src, exact_decimal(p, s)), s)
    return derive(spark, sf, _SCALED).select(
        "o_orderkey", to(18, 2).alias("two_digits"), to(24, 10).alias("ten_digits"), to(4, 1).alias("narrow")
    )


@query(
    "lossless_cast_decimal_double",
    f"""
    SELECT o_orderkey, CASE WHEN around_53_bits <= 9007199254740992 OR around_53_bits % 2 = 0
                            THEN CAST(around_53_bits AS DOUBLE) END AS kept
    FROM ({_EDGES})
    """,
)
def lossless_cast_decimal_double(spark, sf):
    wide = exact_decimal(38, 0)
    number = F.col("around_53_bits").cast("decimal(38,0)")
    return derive(spark, sf, _EDGES).select("o_orderkey", exact_cast(number, wide, _DOUBLE).alias("kept"))


_FLAGS = """
SELECT p_partkey, p_size % 4 AS small, CAST(p_size % 3 AS DOUBLE) AS real_small,
       CAST(p_size % 5 AS DECIMAL(5,1)) AS dec_small, p_size > 25 AS flag
FROM {part}
"""


@query(
    "bool_numeric",
    f"""
    SELECT p_partkey, CASE WHEN small IN (0, 1) THEN small = 1 END AS from_int,
           CASE WHEN real_small IN (0, 1) THEN real_small = 1 END AS from_double,
           CASE WHEN dec_small IN (0, 1) THEN dec_small = 1 END AS from_decimal,
           CAST(flag AS BIGINT) AS to_bigint, CAST(flag AS DOUBLE) AS to_double
    FROM ({_FLAGS})
    """,
)
def bool_numeric(spark, sf):
    return derive(spark, sf, _FLAGS).select(
        "p_partkey",
        exact_cast(F.col("small"), _INT, _BOOLEAN).alias("from_int"),
        exact_cast(F.col("real_small"), _DOUBLE, _BOOLEAN).alias("from_double"),
        exact_cast(F.col("dec_small"), exact_decimal(5, 1), _BOOLEAN).alias("from_decimal"),
        exact_cast(F.col("flag"), _BOOLEAN, _BIGINT).alias("to_bigint"),
        exact_cast(F.col("flag"), _BOOLEAN, _DOUBLE).alias("to_double"),
    )


@query(
    "ts_aware_to_naive",
    """
    SELECT event_id, ts + INTERVAL 8 HOUR AS east, ts - INTERVAL 330 MINUTE AS west,
           CASE WHEN epoch_us(ts) % 1000 = 0 THEN ts END AS millis
    FROM {events}
    """,
)
def ts_aware_to_naive(spark, sf):
    instant = F.col("ts").cast("timestamp")
    to = lambda zone, t=_WALL: exact_cast(instant, _INSTANT, t, times.offset_seconds(zone))
    return load(spark, sf, "events").select(
        "event_id",
        to("+08:00").alias("east"),
        to("-05:30").alias("west"),
        to("+00:00", of_sql("datetime(3)")).alias("millis"),
    )


@query(
    "ts_naive_to_aware",
    """
    SELECT event_id, epoch_us(ts) - 28800000000 AS east_micros, epoch_us(ts) + 19800000000 AS west_micros
    FROM {events}
    """,
)
def ts_naive_to_aware(spark, sf):
    to = lambda zone: F.unix_micros(exact_cast(F.col("ts"), _WALL, _INSTANT, times.offset_seconds(zone)))
    return load(spark, sf, "events").select(
        "event_id", to("+08:00").alias("east_micros"), to("-05:30").alias("west_micros")
    )


_DECIMAL_TEXTS = """
SELECT o_orderkey, CASE o_orderkey % 12
    WHEN 0 THEN concat('-', CAST(o_orderkey AS STRING), '.0100')
    WHEN 1 THEN concat(CAST(o_orderkey AS STRING), 'e3')
    WHEN 2 THEN concat(' ', CAST(o_orderkey AS STRING))
    WHEN 3 THEN concat('+00', CAST(o_orderkey AS STRING), '.')
    WHEN 4 THEN concat('.', CAST(o_orderkey AS STRING))
    WHEN 5 THEN concat('12345678901234567890123456789012345678901234567890', CAST(o_orderkey AS STRING), '.12')
    WHEN 6 THEN concat('12345678901234567890123456789012345678901234567890123456789012345', CAST(o_orderkey AS STRING))
    WHEN 7 THEN concat(CAST(o_orderkey AS STRING), '.1234567')
    WHEN 8 THEN concat(CAST(o_orderkey AS STRING), '.12345000000')
    WHEN 9 THEN '-0.000'
    WHEN 10 THEN concat(CAST(o_orderkey AS STRING), '.1.2')
    ELSE concat('-', CAST(o_custkey AS STRING)) END AS raw
FROM {orders}
"""


def _parse_oracle(source: str, column: str, precision: int, scale: int) -> str:
    """The same parsing rule in DuckDB's words."""
    return f"""
    SELECT o_orderkey, raw, CASE WHEN gate AND rtrim(substr(fraction, {scale + 1}), '0') = ''
               AND length(ltrim(concat(whole, kept), '0')) <= {precision}
          THEN concat(CASE WHEN raw[1] = '-' AND ltrim(concat(whole, kept), '0') <> '' THEN '-' ELSE '' END,
                      CASE WHEN ltrim(whole, '0') = '' THEN '0' ELSE ltrim(whole, '0') END, '.', kept) END AS {column}
    FROM (SELECT *, rpad(substr(fraction, 1, {scale}), {scale}, '0') AS kept
          FROM (SELECT o_orderkey, raw, regexp_full_match(raw, '[+-]?[0-9]+([.][0-9]*)?') AS gate,
                       regexp_extract(raw, '^[+-]?([0-9]*)', 1) AS whole,
                       regexp_extract(raw, '[.]([0-9]*)$', 1) AS fraction
                FROM ({source})))
    """


@query("decimal_parse", _parse_oracle(_DECIMAL_TEXTS, "parsed", 65, 5))
def decimal_parse(spark, sf):
    return derive(spark, sf, _DECIMAL_TEXTS).withColumn("parsed", decimals.parse_decimal(F.col("raw"), 65, 5))


@query("decimal_rescale", _parse_oracle(_DECIMAL_TEXTS, "rescaled", 54, 2))
def decimal_rescale(spark, sf):
    narrowed = exact_cast(F.col("raw"), exact_decimal(70, 8), exact_decimal(54, 2))
    return derive(spark, sf, _DECIMAL_TEXTS).withColumn("rescaled", narrowed)


_PRINTED = """
SELECT o_orderkey, CAST(CAST(o_orderkey - 7000 AS DECIMAL(20,0)) AS DECIMAL(30,10)) AS whole,
       CAST(concat(CASE WHEN o_orderkey % 2 = 0 THEN '-' ELSE '' END, '0.00000000',
                   lpad(CAST(o_orderkey AS STRING), 12, '0')) AS DECIMAL(38,20)) AS tiny
FROM {orders}
"""


@query(
    "decimal_print",
    f"SELECT o_orderkey, CAST(whole AS VARCHAR) AS whole_text, CAST(tiny AS VARCHAR) AS tiny_text FROM ({_PRINTED})",
)
def decimal_print(spark, sf):
    return derive(spark, sf, _PRINTED).select(
        "o_orderkey",
        decimals.print_decimal(F.col("whole"), 10).alias("whole_text"),
        decimals.print_decimal(F.col("tiny"), 20).alias("tiny_text"),
    )


_DATE_TEXTS = """
SELECT event_id, CASE WHEN event_id % 14 = 13 THEN '0000-00-00'
    ELSE concat(CAST(2000 + event_id % 30 AS STRING), '-', lpad(CAST(event_id % 14 AS STRING), 2, '0'), '-',
                lpad(CAST(event_id % 33 AS STRING), 2, '0')) END AS raw
FROM {events}
"""


@query("date_violations", f"SELECT event_id, raw FROM ({_DATE_TEXTS}) WHERE TRY_CAST(raw AS DATE) IS NULL")
def date_violations(spark, sf):
    return derive(spark, sf, _DATE_TEXTS).where(times.parse_date(F.col("raw")).isNull())


_TIMES = """
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN -1 ELSE 1 END AS sign, event_id % 900 AS h, event_id % 61 AS m,
       event_id % 60 AS s, (event_id * 7919) % 1000000 AS us
FROM {events}
"""


@query(
    "time_to_micros",
    f"""
    SELECT event_id, CASE WHEN m < 60 THEN sign * (((h * 60 + m) * 60 + s) * 1000000 + us) END AS micros
    FROM ({_TIMES})
    """,
)
def time_to_micros(spark, sf):
    rows = derive(spark, sf, _TIMES)
    two = lambda c: F.lpad(F.col(c).cast("string"), 2, "0")
    hours = F.when(F.col("h") < 10, two("h")).otherwise(F.col("h").cast("string"))
    sign = F.when(F.col("sign") < 0, "-").otherwise("")
    raw = F.concat(sign, hours, F.lit(":"), two("m"), F.lit(":"), two("s"), F.lit("."), F.lpad(F.col("us").cast("string"), 6, "0"))
    return rows.select("event_id", raw.alias("raw")).select(
        "event_id", times.time_to_micros(F.col("raw")).alias("micros")
    )


_SPAN = "SELECT event_id, (event_id * 604800017 + 12345) * (CASE WHEN event_id % 2 = 0 THEN 1 ELSE -1 END) AS micros FROM {events}"


@query(
    "micros_to_time",
    f"""
    SELECT event_id, micros,
           CASE WHEN abs(micros) // 1000000 <= 3020399 THEN concat(CASE WHEN micros < 0 THEN '-' ELSE '' END,
               CASE WHEN abs(micros) // 3600000000 < 10 THEN '0' ELSE '' END, CAST(abs(micros) // 3600000000 AS VARCHAR),
               ':', lpad(CAST((abs(micros) // 60000000) % 60 AS VARCHAR), 2, '0'),
               ':', lpad(CAST((abs(micros) // 1000000) % 60 AS VARCHAR), 2, '0'),
               '.', lpad(CAST(abs(micros) % 1000000 AS VARCHAR), 6, '0')) END AS time_text,
           CASE WHEN abs(micros) // 1000000 <= 3020399 THEN abs(micros) // 86400000000 END AS days,
           CASE WHEN abs(micros) // 1000000 <= 3020399 THEN (abs(micros) // 3600000000) % 24 END AS hours
    FROM ({_SPAN})
    """,
)
def micros_to_time(spark, sf):
    parts = times.time_parts(F.col("micros"))
    return derive(spark, sf, _SPAN).select(
        "event_id",
        "micros",
        times.micros_to_time(F.col("micros")).alias("time_text"),
        parts["days"].alias("days"),
        parts["hours"].alias("hours"),
    )


@query(
    "row_bytes",
    """
    SELECT doc_id, CAST(64 + octet_length(encode(text)) + octet_length(encode(lang)) + octet_length(encode(source))
                        + 3 * 16 AS BIGINT) AS size_bytes
    FROM {documents}
    """,
)
def row_sizes(spark, sf):
    documents = load(spark, sf, "documents")
    return documents.select("doc_id", row_bytes(documents.schema).alias("size_bytes"))


_SIZED = """
SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_type END AS event_type,
       CAST(event_id AS DECIMAL(12,2)) AS amount
FROM {events}
"""


@query(
    "row_bytes_by_side",
    f"""
    SELECT event_id, CAST(64 + coalesce(octet_length(encode(event_type)), 0) + 16 AS BIGINT) AS writer_bytes,
           CAST(32 + coalesce(octet_length(encode(event_type)) + 16, 32)
                + octet_length(encode(CAST(amount AS VARCHAR))) + 16 AS BIGINT) AS reader_bytes
    FROM ({_SIZED})
    """,
)
def row_bytes_by_side(spark, sf):
    rows = derive(spark, sf, _SIZED)
    return rows.select(
        "event_id",
        row_bytes(rows.schema).alias("writer_bytes"),
        row_bytes(rows.schema, side="reader").alias("reader_bytes"),
    )


_PROJECTED = """
SELECT event_id, if(event_type = 'error', -1, 1) * CAST(extract(HOUR FROM ts) * 3600 + extract(MINUTE FROM ts) * 60 AS BIGINT)
           AS signed_seconds,
       left(event_type, 3) AS short_type, concat(CAST(user_id AS STRING), '/', event_type) AS joined,
       hex({bytes}) AS hex_props, CAST({length} AS BIGINT) AS props_bytes
FROM {events}
"""


@query(
    "explicit_projection",
    _PROJECTED.replace("{bytes}", "encode(props)").replace("{length}", "octet_length(encode(props))"),
)
def explicit_projection(spark, sf):
    text_ = _PROJECTED.replace("{bytes}", "props").replace("{length}", "octet_length(props)")
    return derive(spark, sf, text_)


@query(
    "base64_roundtrip",
    """
    SELECT doc_id, base64(encode(text)) AS encoded, octet_length(encode(text)) AS n_bytes,
           doc_id % 2 = 0 AS malformed
    FROM {documents}
    """,
)
def base64_roundtrip(spark, sf):
    encoded = text.encode_base64(F.col("text").cast("binary"))
    rows = load(spark, sf, "documents").select("doc_id", encoded.alias("encoded"))
    broken = F.when(F.col("doc_id") % 2 == 0, F.concat("encoded", F.lit("*"))).otherwise(F.col("encoded"))
    return rows.select(
        "doc_id",
        "encoded",
        F.octet_length(text.decode_base64(F.col("encoded"))).cast("bigint").alias("n_bytes"),
        text.decode_base64(broken).isNull().alias("malformed"),
    )


_NANOS = "SELECT event_id, event_id * 1000003 * 1000 + (CASE WHEN user_id % 2 = 0 THEN 0 ELSE user_id END) AS nanos FROM {events}"


@query(
    "nanosecond_loss",
    f"""
    SELECT event_id, nanos, CASE WHEN nanos % 1000 = 0 THEN nanos // 1000 END AS micros,
           CASE WHEN nanos % 1000 = 0 THEN year(make_timestamp(nanos // 1000)) BETWEEN 0 AND 9999 END AS year_fits
    FROM ({_NANOS})
    """,
)
def nanosecond_loss(spark, sf):
    instant = times.nanos_to_instant(F.col("nanos"))
    return derive(spark, sf, _NANOS).select(
        "event_id", "nanos", F.unix_micros(instant).alias("micros"), times.bindable_year(instant).alias("year_fits")
    )
