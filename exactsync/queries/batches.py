"""Batch cutting over data-defined lanes, numbering and labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from exactsync.functions.sizes import row_bytes
from exactsync.operators.batching import (
    BATCH,
    LANE,
    Limits,
    batch_summary,
    number_batches,
    salted_lane,
    statement_limits,
    with_batches,
)
from exactsync.ledger.states import with_labels
from exactsync.operators.ordered import with_ordered_batches
from exactsync.queries.registry import load, query

SALTS = 4
# Lanes are key ranges of one width, so their number grows with the table and no lane does.
KEY_RANGE = 1500
_ORDER_BYTES = (
    "128 + octet_length(encode(o_orderstatus)) + 16 + octet_length(encode(o_orderpriority)) + 16"
)
_LANED = f"""
    SELECT *, {_ORDER_BYTES} AS size, {SALTS} * (o_orderkey // {KEY_RANGE}) + o_orderkey % {SALTS} AS lane
    FROM {{orders}}"""
_NUMBERED = f"""
    SELECT *, row_number() OVER (PARTITION BY lane ORDER BY o_orderkey) - 1 AS nth FROM ({_LANED})"""


def _order_batches(spark, sf, limits, reader_limits=None):
    orders = load(spark, sf, "orders")
    lane = salted_lane(F.expr(f"o_orderkey DIV {KEY_RANGE}"), F.col("o_orderkey"), SALTS)
    return with_batches(orders, limits, lane=lane, order=[F.col("o_orderkey")], reader_limits=reader_limits), orders


@query(
    "batch_by_rows",
    f"""
    SELECT CAST(lane AS BIGINT) AS lane, CAST(nth // 100 AS BIGINT) AS batch, count(*) AS n_rows,
           CAST(sum(size) AS BIGINT) AS n_bytes, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key
    FROM ({_NUMBERED}) GROUP BY 1, 2
    """,
)
def batch_by_rows(spark, sf):
    cut, orders = _order_batches(spark, sf, Limits(rows=100))
    return cut.groupBy(F.col(LANE).alias("lane"), F.col(BATCH).cast("bigint").alias("batch")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(row_bytes(orders.schema)).alias("n_bytes"),
        F.min("o_orderkey").alias("first_key"),
        F.max("o_orderkey").alias("last_key"),
    )


@query(
    "batch_recut",
    f"""
    SELECT CAST(lane AS BIGINT) AS lane, o_orderkey, CAST((nth // 70) * 2 + (nth % 70) // 50 AS BIGINT) AS batch
    FROM ({_NUMBERED})
    """,
)
def batch_recut(spark, sf):
    # The writer takes 50 rows, the reader hands over 70: batches of 50, 20, 50, 20, ...
    cut, _ = _order_batches(spark, sf, Limits(rows=50), Limits(rows=70))
    return cut.select(F.col(LANE).alias("lane"), "o_orderkey", F.col(BATCH).cast("bigint").alias("batch"))


DOC_LIMITS = Limits(rows=20, bytes=60_000)
DOCS_PER_LANE = 60
_DOC_BYTES = "64 + octet_length(encode(text)) + octet_length(encode(lang)) + octet_length(encode(source)) + 48"


def _documents(spark, sf):
    documents = load(spark, sf, "documents")
    lane = F.expr(f"doc_id DIV {DOCS_PER_LANE}")
    return with_batches(documents, DOC_LIMITS, lane=lane, order=[F.col("doc_id")]), row_bytes(documents.schema)


@query(
    "batch_by_bytes",
    f"""
    WITH RECURSIVE sized AS (
        SELECT doc_id, doc_id // {DOCS_PER_LANE} AS lane, {_DOC_BYTES} AS size,
               row_number() OVER (PARTITION BY doc_id // {DOCS_PER_LANE} ORDER BY doc_id) AS nth
        FROM {{documents}}),
    cut AS (
        SELECT doc_id, lane, nth, CAST(0 AS BIGINT) AS batch, CAST(1 AS BIGINT) AS n, CAST(size AS BIGINT) AS b
        FROM sized WHERE nth = 1
        UNION ALL
        SELECT s.doc_id, s.lane, s.nth,
               c.batch + CASE WHEN c.n < {DOC_LIMITS.rows} AND c.b + s.size <= {DOC_LIMITS.bytes} THEN 0 ELSE 1 END,
               CASE WHEN c.n < {DOC_LIMITS.rows} AND c.b + s.size <= {DOC_LIMITS.bytes} THEN c.n + 1 ELSE 1 END,
               CASE WHEN c.n < {DOC_LIMITS.rows} AND c.b + s.size <= {DOC_LIMITS.bytes} THEN c.b ELSE 0 END + s.size
        FROM cut c JOIN sized s ON s.lane = c.lane AND s.nth = c.nth + 1)
    SELECT doc_id, lane, batch FROM cut
    """,
)
def batch_by_bytes(spark, sf):
    cut, _ = _documents(spark, sf)
    return cut.select("doc_id", F.col(LANE).alias("lane"), F.col(BATCH).cast("bigint").alias("batch"))


@query(
    "batch_invariants",
    f"""
    SELECT count(*) AS n_rows, CAST(sum({_DOC_BYTES}) AS BIGINT) AS n_bytes, CAST(0 AS BIGINT) AS too_many_rows,
           CAST(0 AS BIGINT) AS too_many_bytes, CAST(0 AS BIGINT) AS gaps
    FROM {{documents}}
    """,
)
def batch_invariants(spark, sf):
    cut, size = _documents(spark, sf)
    summary = batch_summary(cut, size)
    lanes = summary.groupBy(LANE).agg(
        F.sum("rows").alias("rows"),
        F.sum("bytes").alias("bytes"),
        F.count_if(F.col("rows") > DOC_LIMITS.rows).alias("too_many_rows"),
        F.count_if((F.col("bytes") > DOC_LIMITS.bytes) & (F.col("rows") > 1)).alias("too_many_bytes"),
        (F.max(BATCH) + 1 - F.count(F.lit(1))).alias("gaps"),
    )
    return lanes.agg(
        F.sum("rows").alias("n_rows"),
        F.sum("bytes").alias("n_bytes"),
        F.sum("too_many_rows").alias("too_many_rows"),
        F.sum("too_many_bytes").alias("too_many_bytes"),
        F.sum("gaps").alias("gaps"),
    )


_BATCH_IDS = f"""
    SELECT lane, batch, n_rows, n_bytes, row_number() OVER (ORDER BY lane, batch) - 1 AS batch_id
    FROM (SELECT lane, nth // 100 AS batch, count(*) AS n_rows, sum(size) AS n_bytes FROM ({_NUMBERED}) GROUP BY 1, 2)"""


def _numbered_batches(spark, sf):
    cut, orders = _order_batches(spark, sf, Limits(rows=100))
    return number_batches(batch_summary(cut, row_bytes(orders.schema)))


@query(
    "batch_numbering",
    f"SELECT batch_id, n_rows, CAST(n_bytes AS BIGINT) AS n_bytes FROM ({_BATCH_IDS})",
)
def batch_numbering(spark, sf):
    return _numbered_batches(spark, sf).select(
        "batch_id", F.col("rows").alias("n_rows"), F.col("bytes").alias("n_bytes")
    )


@query(
    "batch_labels",
    f"SELECT batch_id, concat('load_0f8fad5bd9cb469fa165', lane, '_', batch_id) AS label FROM ({_BATCH_IDS})",
)
def batch_labels(spark, sf):
    batches = _numbered_batches(spark, sf).withColumn("run_id", F.concat(F.lit("0f8fad5b-d9cb-469f-a165-"), LANE))
    return with_labels(batches, "load").select("batch_id", "label")


_STATEMENT_ROWS = 65535 // 11


@query(
    "statement_chunks",
    f"""
    SELECT lane, chunk, count(*) AS n_rows
    FROM (SELECT lane, (row_number() OVER (PARTITION BY lane) - 1) // {_STATEMENT_ROWS} AS chunk
          FROM (SELECT l_suppkey // 25 AS lane FROM {{lineitem}}))
    GROUP BY 1, 2
    """,
)
def statement_chunks(spark, sf):
    lines = load(spark, sf, "lineitem")
    limits = statement_limits(len(lines.columns), 64 * 1024 * 1024)
    cut = with_batches(lines, limits, lane=F.expr("l_suppkey DIV 25"))
    return cut.groupBy(F.col(LANE).alias("lane"), F.col(BATCH).cast("bigint").alias("chunk")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


@query(
    "batch_global_order",
    f"""
    WITH RECURSIVE sized AS (
        SELECT doc_id, {_DOC_BYTES} AS size, row_number() OVER (ORDER BY doc_id) AS nth FROM {{documents}}),
    cut AS (
        SELECT doc_id, nth, CAST(0 AS BIGINT) AS batch, CAST(1 AS BIGINT) AS n, CAST(size AS BIGINT) AS b
        FROM sized WHERE nth = 1
        UNION ALL
        SELECT s.doc_id, s.nth,
               c.batch + CASE WHEN c.n < {DOC_LIMITS.rows} AND c.b + s.size <= {DOC_LIMITS.bytes} THEN 0 ELSE 1 END,
               CASE WHEN c.n < {DOC_LIMITS.rows} AND c.b + s.size <= {DOC_LIMITS.bytes} THEN c.n + 1 ELSE 1 END,
               CASE WHEN c.n < {DOC_LIMITS.rows} AND c.b + s.size <= {DOC_LIMITS.bytes} THEN c.b ELSE 0 END + s.size
        FROM cut c JOIN sized s ON s.nth = c.nth + 1)
    SELECT doc_id, batch FROM cut
    """,
)
def batch_global_order(spark, sf):
    """All documents as one ordered stream: no lanes, and no task that sees them all."""
    cut = with_ordered_batches(load(spark, sf, "documents"), DOC_LIMITS, ["doc_id"], keep=["doc_id"])
    return cut.select("doc_id", F.col(BATCH).alias("batch"))
