"""Mapping: identity, renames, defaults, guards and their violation reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from exactsync.plans.mapping import TargetColumn, plan_mapping
from exactsync.queries.registry import derive, load, query


def order_columns() -> tuple[TargetColumn, ...]:
    """Target of the flagship copy: narrower keys, exact money, whole-day timestamps."""
    return (
        TargetColumn.sql("id", "int", nullable=False, key=True),
        TargetColumn.sql("customer", "bigint unsigned", nullable=False),
        TargetColumn.sql("status", "varchar(1)"),
        TargetColumn.sql("total", "decimal(15,2)", nullable=False),
        TargetColumn.sql("ordered_at", "datetime(0)"),
        TargetColumn.sql("priority", "varchar(32)"),
    )


ORDER_MAPPING = (
    ("o_orderkey", "id"),
    ("o_custkey", "customer"),
    ("o_orderstatus", "status"),
    ("o_totalprice", "total"),
    ("o_orderdate", "ordered_at"),
    ("o_orderpriority", "priority"),
)


@query(
    "guarded_copy",
    """
    SELECT o_orderkey AS id, o_custkey AS customer, o_orderstatus AS status, o_totalprice AS total,
           o_orderdate AS ordered_at, o_orderpriority AS priority
    FROM {orders}
    """,
)
def guarded_copy(spark, sf):
    orders = load(spark, sf, "orders")
    copied = plan_mapping(orders.schema, order_columns(), ORDER_MAPPING).apply(orders)
    # Plain types for comparing with other engines.
    return copied.select(
        F.col("id").cast("bigint"),
        F.col("customer").cast("bigint"),
        "status",
        F.col("total").cast("double"),
        "ordered_at",
        "priority",
    )


@query("map_identity", "SELECT * FROM {part}")
def map_identity(spark, sf):
    part = load(spark, sf, "part")
    return plan_mapping(part.schema, part.schema).apply(part)


@query(
    "map_rename_reorder",
    """
    SELECT p_type AS kind, p_partkey AS id, p_name AS title, p_partkey AS id_copy, p_retailprice AS price
    FROM {part}
    """,
)
def map_rename_reorder(spark, sf):
    part = load(spark, sf, "part")
    target = (
        TargetColumn.sql("id", "bigint", nullable=False),
        TargetColumn.sql("id_copy", "decimal(20,0)"),
        TargetColumn.sql("title", "string"),
        TargetColumn.sql("kind", "string"),
        TargetColumn.sql("price", "decimal(15,2)"),
    )
    pairs = (
        ("p_type", "kind"),
        ("p_partkey", "id"),
        ("p_name", "title"),
        ("p_partkey", "id_copy"),
        ("p_retailprice", "price"),
    )
    mapped = plan_mapping(part.schema, target, pairs).apply(part)
    return mapped.withColumn("id_copy", F.col("id_copy").cast("bigint")).withColumn(
        "price", F.col("price").cast("double")
    )


@query(
    "map_default_fill",
    """
    SELECT c_custkey AS id, c_name AS name, CAST(0 AS BIGINT) AS visits, CAST(NULL AS VARCHAR) AS note
    FROM {customer}
    """,
)
def map_default_fill(spark, sf):
    customer = load(spark, sf, "customer")
    target = (
        TargetColumn.sql("id", "bigint", nullable=False),
        TargetColumn.sql("name", "varchar(64)"),
        TargetColumn.sql("visits", "bigint", nullable=False, has_default=True, default=0),
        TargetColumn.sql("note", "text"),
        TargetColumn.sql("name_hash", "bigint", generated=True),
    )
    plan = plan_mapping(customer.schema, target, (("c_custkey", "id"), ("c_name", "name")))
    return plan.apply(customer, fill_omitted=True)


@query(
    "notnull_violations",
    """
    SELECT d.doc_id, CASE WHEN l.quality IS NULL AND l.toxic IS NULL THEN 'quality,toxic'
                          WHEN l.quality IS NULL THEN 'quality' ELSE 'toxic' END AS failed
    FROM {documents} d LEFT JOIN {labels} l USING (doc_id)
    WHERE l.quality IS NULL OR l.toxic IS NULL
    """,
)
def notnull_violations(spark, sf):
    documents = load(spark, sf, "documents").select("doc_id")
    joined = documents.join(load(spark, sf, "labels"), "doc_id", "left")
    target = (
        TargetColumn.sql("doc_id", "bigint", nullable=False),
        TargetColumn.sql("quality", "int", nullable=False),
        TargetColumn.sql("toxic", "int", nullable=False),
    )
    bad = plan_mapping(joined.schema, target).violations(joined)
    return bad.select("doc_id", F.array_join("failed_columns", ",").alias("failed"))


@query(
    "ts_precision_violations",
    "SELECT event_id, epoch_us(ts) AS micros FROM {events} WHERE epoch_us(ts) % 1000 <> 0",
)
def ts_precision_violations(spark, sf):
    events = load(spark, sf, "events").select("event_id", "ts")
    target = (TargetColumn.sql("event_id", "bigint"), TargetColumn.sql("ts", "datetime(3)"))
    bad = plan_mapping(events.schema, target).violations(events)
    return bad.select("event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("micros"))


_EVENT_COPY = """
SELECT event_id, ts, user_id, value, CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS event_type
FROM {events}
"""


@query(
    "violation_counts",
    f"""
    SELECT count(*) FILTER (event_id > 2147483647) AS event_id,
           count(*) FILTER (epoch_us(ts) % 1000000 <> 0) AS ts,
           count(*) FILTER (user_id > 127) AS user_id,
           count(*) FILTER (CAST(TRY_CAST(value AS DECIMAL(9,1)) AS DOUBLE) IS DISTINCT FROM value) AS value,
           count(*) FILTER (event_type IS NULL) AS event_type
    FROM ({_EVENT_COPY})
    """,
)
def violation_counts(spark, sf):
    events = derive(spark, sf, _EVENT_COPY)
    target = (
        TargetColumn.sql("event_id", "int"),
        TargetColumn.sql("ts", "datetime(0)"),
        TargetColumn.sql("user_id", "tinyint"),
        TargetColumn.sql("value", "decimal(9,1)"),
        TargetColumn.sql("event_type", "varchar(16)", nullable=False),
    )
    return plan_mapping(events.schema, target).violation_counts(events)


@query(
    "length_violations",
    "SELECT event_id FROM {events} WHERE length(event_type) > 5 OR octet_length(encode(props)) > 12",
)
def length_violations(spark, sf):
    rows = derive(spark, sf, "SELECT event_id, event_type, CAST(props AS BINARY) AS props FROM {events}")
    target = (
        TargetColumn.sql("event_id", "bigint", nullable=False),
        TargetColumn.sql("event_type", "varchar(5)"),
        TargetColumn.sql("props", "varbinary(12)"),
    )
    return plan_mapping(rows.schema, target).violations(rows).select("event_id")


@query(
    "time_range_violations",
    """
    SELECT event_id, user_id % 1000 > 838 AS bad_time, year(ts) + 8005 > 9999 + user_id % 40 AS bad_year
    FROM {events} WHERE user_id % 1000 > 838 OR year(ts) + 8005 > 9999 + user_id % 40
    """,
)
def time_range_violations(spark, sf):
    rows = derive(
        spark,
        sf,
        """
        SELECT event_id, make_dt_interval(0, CAST(user_id % 1000 AS INT), 59, 59) AS spent,
               make_date(CAST(year(ts) + 8005 - user_id % 40 AS INT), 1, 1) AS day
        FROM {events}
        """,
    )
    target = (
        TargetColumn.sql("event_id", "bigint", nullable=False),
        TargetColumn.sql("spent", "time"),
        TargetColumn.sql("day", "date"),
    )
    found = plan_mapping(rows.schema, target).violations(rows)
    return found.select(
        "event_id",
        F.array_contains("failed_columns", "spent").alias("bad_time"),
        F.array_contains("failed_columns", "day").alias("bad_year"),
    )
