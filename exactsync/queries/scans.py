"""Sources: projection and predicate, queries, bound parameters, range splits, wire integers."""

from __future__ import annotations

import base64

from pyspark.sql import functions as F

from exactsync.functions.casts import exact_cast
from exactsync.functions.sizes import row_bytes
from exactsync.queries.registry import derive, load, query, table_path
from exactsync.queries.writes import fresh_folder
from exactsync.sources.split import BalancedSplit, RangeSplit
from exactsync.sources.table import Parameter, Source
from exactsync.types import exact_decimal, of_sql

_STATUS_AND_PRICE = "o_orderstatus = 'F' OR o_totalprice > 400000"
_KEY_RANGE = "o_orderkey >= 100"


@query(
    "scan_project_filter",
    f"SELECT o_orderkey, o_custkey, o_totalprice FROM {{orders}} WHERE ({_STATUS_AND_PRICE}) AND ({_KEY_RANGE})",
)
def scan_project_filter(spark, sf):
    wanted = ("o_orderkey", "o_custkey", "o_totalprice")
    source = Source(path=table_path(sf, "orders"), columns=wanted, where=_STATUS_AND_PRICE)
    return source.frame(spark).where(F.expr(_KEY_RANGE))


_ALIASED = """
SELECT c.c_custkey AS customer_id, upper(c.c_name) AS customer_name, n.n_name AS nation_name
FROM {customer} c JOIN {nation} n ON c.c_nationkey = n.n_nationkey
WHERE c.c_acctbal > 0
"""


@query("query_scan_alias", _ALIASED)
def query_scan_alias(spark, sf):
    views = {name: load(spark, sf, name) for name in ("customer", "nation")}
    return Source(query=_ALIASED + ";").frame(spark, **views)


@query(
    "bound_params",
    """
    SELECT l_orderkey, l_linenumber, l_quantity, CAST(NULL AS VARCHAR) AS bound_null, 'FF00' AS bound_binary,
           CAST(1 AS BIGINT) AS bound_flag, 18446744073709551615 - l_orderkey > 0 AS below_unsigned
    FROM {lineitem}
    WHERE l_returnflag = 'R' AND l_orderkey >= 17 AND l_quantity >= 12.5 AND l_discount <= 0.07
    """,
)
def bound_params(spark, sf):
    text = """
    SELECT l_orderkey, l_linenumber, l_quantity, CAST(? AS STRING) AS bound_null, hex(?) AS bound_binary,
           CAST(? AS BIGINT) AS bound_flag, ? - l_orderkey > 0 AS below_unsigned
    FROM {lineitem}
    WHERE l_returnflag = ? AND l_orderkey >= ? AND CAST(l_quantity AS DECIMAL(15,2)) >= ? AND l_discount <= ?
    """
    params = (
        Parameter("null"),
        Parameter("binary", base64.b64encode(b"\xff\x00").decode()),
        Parameter("bool", True),
        Parameter("u64", "18446744073709551615"),
        Parameter("string", "R"),
        Parameter("i64", "17"),
        Parameter("decimal", "12.50"),
        Parameter("f64", 0.07),
    )
    return Source(query=text, params=params).frame(spark, lineitem=load(spark, sf, "lineitem"))


_NULLED = """
SELECT o_orderkey, CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE o_orderkey END AS split_key FROM {orders}
"""
SPLIT = RangeSplit("split_key", 1000, 12000, 7)


@query(
    "range_split_counts",
    f"""
    SELECT CAST(CASE WHEN split_key < 2571 OR split_key IS NULL THEN 0 WHEN split_key < 4142 THEN 1
                     WHEN split_key < 5714 THEN 2 WHEN split_key < 7285 THEN 3 WHEN split_key < 8857 THEN 4
                     WHEN split_key < 10428 THEN 5 ELSE 6 END AS BIGINT) AS slice_id,
           count(*) AS n_rows, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key
    FROM ({_NULLED}) GROUP BY 1
    """,
)
def range_split_counts(spark, sf):
    rows = derive(spark, sf, _NULLED).withColumn("slice_id", SPLIT.slice_id().cast("bigint"))
    return rows.groupBy("slice_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("o_orderkey").alias("first_key"),
        F.max("o_orderkey").alias("last_key"),
    )


@query(
    "range_split_union",
    "SELECT o_orderstatus, count(*) AS n_rows, CAST(sum(o_orderkey) AS BIGINT) AS key_sum FROM {orders} GROUP BY 1",
)
def range_split_union(spark, sf):
    source = Source(
        path=table_path(sf, "orders"),
        columns=("o_orderkey", "o_orderstatus"),
        split=RangeSplit("o_orderkey", 1000, 12000, 4),
    )
    first, *others = source.slices(spark)
    for other in others:
        first = first.unionAll(other)
    return first.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("o_orderkey").alias("key_sum")
    )


@query("empty_result", "SELECT o_orderkey, o_totalprice FROM {orders} WHERE o_orderkey < 0")
def empty_result(spark, sf):
    return Source(
        path=table_path(sf, "orders"), columns=("o_orderkey", "o_totalprice"), where="o_orderkey < 0"
    ).frame(spark)


_WIRE = """
SELECT o_orderkey, CASE o_orderkey % 6
    WHEN 0 THEN '170141183460469231731687303715884105727'
    WHEN 1 THEN '-170141183460469231731687303715884105728'
    WHEN 2 THEN concat(CAST(o_orderkey AS STRING), '00000000000000000000000000000000000')
    WHEN 3 THEN '170141183460469231731687303715884105728'
    WHEN 4 THEN concat('x', CAST(o_orderkey AS STRING))
    ELSE concat('-000', CAST(o_orderkey AS STRING)) END AS raw
FROM {orders}
"""


@query(
    "largeint_normalize",
    f"""
    SELECT o_orderkey, raw, CAST(CASE WHEN regexp_full_match(raw, '[+-]?[0-9]+')
                                      THEN TRY_CAST(raw AS HUGEINT) END AS VARCHAR) AS value
    FROM ({_WIRE})
    """,
)
def largeint_normalize(spark, sf):
    value = exact_cast(F.col("raw"), exact_decimal(65, 0), of_sql("largeint"))
    return derive(spark, sf, _WIRE).withColumn("value", value)


@query(
    "oversize_rows",
    """
    SELECT page_id, row_bytes FROM (
        SELECT page_id, CAST(32 + octet_length(encode(url)) + 16 + octet_length(encode(html)) + 16 AS BIGINT)
               AS row_bytes FROM {pages})
    WHERE row_bytes > 4096
    """,
)
def oversize_rows(spark, sf):
    pages = load(spark, sf, "pages")
    return pages.select("page_id", row_bytes(pages.schema).alias("row_bytes")).where("row_bytes > 4096")


_SKEWED = """
SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 10 < 3 THEN 77 ELSE l_partkey * l_partkey END AS skewed
FROM {lineitem}
"""
_BALANCED = 12


@query(
    "range_split_balanced",
    f"SELECT count(*) AS n_rows, count(*) AS n_sliced, true AS alike, true AS even FROM ({_SKEWED})",
)
def range_split_balanced(spark, sf):
    """Slices of equal depth over a key of which one value has a third of all rows and the others crowd at the low end.

    ``alike``: predicates and slice numbers agree; ``even``: no slice but that of the heavy value is over 1.1 times the mean of the others."""
    rows = derive(spark, sf, _SKEWED)
    split = BalancedSplit.over(rows, "skewed", _BALANCED)
    marked = rows.select("skewed", split.slice_id().alias("slice"))
    hits = [F.when(F.expr(p), n) for n, p in enumerate(split.predicates())]
    counted = marked.groupBy("slice").agg(
        F.count("*").alias("n"),
        F.count_if(F.size(F.array_compact(F.array(*hits))) == 1).alias("once"),
        F.count_if(F.coalesce(*hits) == F.col("slice")).alias("alike"),
        F.bool_or(F.col("skewed") == 77).alias("heavy"),
    )
    light, mean = F.max(F.when(~F.col("heavy"), F.col("n"))), F.avg(F.when(~F.col("heavy"), F.col("n")))
    return counted.agg(
        F.sum("n").alias("n_rows"),
        F.sum("once").alias("n_sliced"),
        (F.sum("alike") == F.sum("n")).alias("alike"),
        (light <= 1.1 * mean).alias("even"),
    )


_COPIED_ORDERS = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM {orders}"


@query("snapshot_scan", _COPIED_ORDERS)
def snapshot_scan(spark, sf):
    """All slices of a folder as it was when it was pinned, although a file came and rows are there twice now."""
    folder = fresh_folder(spark)
    orders = derive(spark, sf, _COPIED_ORDERS)
    orders.repartition(4).write.parquet(folder)
    split = RangeSplit.over(orders, "o_orderkey", 3)
    pinned = Source(path=folder, split=split, pin=True).pinned(spark)
    first, *others = pinned.slices(spark)
    orders.write.mode("append").parquet(folder)
    pinned.check_files(spark)
    for other in others:
        first = first.unionByName(other)
    return first


_FINE = "SELECT event_id, ts, CASE WHEN event_id % 4 = 0 THEN ts END AS seen FROM {events}"


def _written_in_nanoseconds(spark, rows, *names: str) -> str:
    """A folder of Parquet files that hold timestamps in nanoseconds; Spark itself writes none, so its tasks do so with Arrow."""
    folder = fresh_folder(spark)
    whole = {n: F.unix_micros(F.col(n).cast("timestamp")) * 1000 for n in names}

    def write(batches):
        import uuid

        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs

        system, path = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
        for batch in batches:
            columns = [c.cast(pa.timestamp("ns")) if n in names else c for n, c in zip(batch.schema.names, batch.columns)]
            table = pa.table(dict(zip(batch.schema.names, columns)))
            pq.write_table(table, f"{path}/part-{uuid.uuid4()}.parquet", filesystem=system, version="2.6")
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    spark._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(
        spark._jvm.org.apache.hadoop.fs.Path(folder)
    )
    rows.withColumns(whole).mapInArrow(write, "n long").agg(F.sum("n")).collect()
    return folder


@query("nanos_source", _FINE)
def nanos_source(spark, sf):
    """Nanosecond files read into exact microseconds."""
    folder = _written_in_nanoseconds(spark, derive(spark, sf, _FINE), "ts", "seen")
    return Source(path=folder, nanos={"ts": "wall", "seen": "wall"}).frame(spark)
