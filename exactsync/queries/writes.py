"""Writes: appends, key checks, upserts, affected rows, load accounting."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from exactsync.operators import accounting
from exactsync.operators.upsert import affected, duplicate_keys, insert_conflicts, last_wins, upsert
from exactsync.plans.mapping import TargetColumn
from exactsync.queries.registry import derive, load, query
from exactsync.session import checkpoint_dir
from exactsync.sinks.catalog import overwrite_partitions
from exactsync.sinks.dataset import ParquetTarget
from exactsync.sources.split import KeyLayout

# The table, then the same rows changed: a quarter under new keys, some values altered.
_CHANGED = """
SELECT CASE WHEN o_custkey % 4 = 0 THEN o_orderkey + 100000000 ELSE o_orderkey END AS o_orderkey, o_custkey,
       CASE WHEN o_custkey % 3 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN o_custkey % 5 = 0 THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
       o_orderdate, o_orderpriority
FROM {orders}
"""
_KEY = ["o_orderkey"]


@query("append_rows", f"SELECT * FROM {{orders}} UNION ALL SELECT * FROM ({_CHANGED})")
def append_rows(spark, sf):
    target = _order_target(spark, sf, "append")
    target.write(load(spark, sf, "orders"), "first")
    target.write(derive(spark, sf, _CHANGED), "second")
    target.write(derive(spark, sf, _CHANGED), "second")  # a replayed label adds nothing
    return target.read(spark)


def fresh_folder(spark):
    return f"{checkpoint_dir(spark)}/exactsync-{uuid.uuid4()}"


def _order_target(spark, sf, model):
    root = fresh_folder(spark)
    keyed = tuple(_KEY) if model != "append" else ()
    fields = load(spark, sf, "orders").schema.fields
    columns = tuple(
        TargetColumn(c.name, c.type, c.nullable, key=c.name in keyed) for c in map(TargetColumn.from_field, fields)
    )
    return ParquetTarget(root, columns, model, keyed)


@query("insert_conflicts", f"SELECT i.* FROM ({_CHANGED}) i WHERE i.o_orderkey IN (SELECT o_orderkey FROM {{orders}})")
def insert_conflict_rows(spark, sf):
    return insert_conflicts(derive(spark, sf, _CHANGED), load(spark, sf, "orders"), _KEY)


_MERGED = f"""
SELECT coalesce(i.o_orderkey, t.o_orderkey) AS o_orderkey,
       CASE WHEN i.o_orderkey IS NOT NULL THEN i.o_custkey ELSE t.o_custkey END AS o_custkey,
       CASE WHEN i.o_orderkey IS NOT NULL THEN i.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
       CASE WHEN i.o_orderkey IS NOT NULL THEN i.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
       CASE WHEN i.o_orderkey IS NOT NULL THEN i.o_orderdate ELSE t.o_orderdate END AS o_orderdate,
       CASE WHEN i.o_orderkey IS NOT NULL THEN i.o_orderpriority ELSE t.o_orderpriority END AS o_orderpriority
FROM {{orders}} t FULL OUTER JOIN ({_CHANGED}) i ON t.o_orderkey = i.o_orderkey
"""


@query("upsert_result", _MERGED)
def upsert_result(spark, sf):
    return upsert(load(spark, sf, "orders"), derive(spark, sf, _CHANGED), _KEY)


@query("upsert_committed", _MERGED)
def upsert_committed(spark, sf):
    target = _order_target(spark, sf, "upsert")
    target.write(load(spark, sf, "orders"), "first")
    target.write(derive(spark, sf, _CHANGED), "second")
    return target.read(spark)


@query(
    "upsert_partial_columns",
    f"""
    SELECT coalesce(i.o_orderkey, t.o_orderkey) AS o_orderkey,
           CASE WHEN t.o_orderkey IS NULL THEN i.o_custkey ELSE t.o_custkey END AS o_custkey,
           CASE WHEN t.o_orderkey IS NULL THEN i.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
           CASE WHEN i.o_orderkey IS NOT NULL THEN i.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
           t.o_orderdate, t.o_orderpriority
    FROM {{orders}} t FULL OUTER JOIN ({_CHANGED}) i ON t.o_orderkey = i.o_orderkey
    """,
)
def upsert_partial_columns(spark, sf):
    incoming = derive(spark, sf, _CHANGED).drop("o_orderdate", "o_orderpriority")
    return upsert(load(spark, sf, "orders"), incoming, _KEY, ["o_totalprice"])


@query(
    "upsert_affected",
    f"""
    SELECT count(*) AS incoming_rows, count(*) FILTER (t.o_orderkey IS NULL) AS new_rows,
           count(*) FILTER (t.o_orderkey IS NOT NULL AND (i.o_orderstatus IS DISTINCT FROM t.o_orderstatus
                            OR i.o_totalprice IS DISTINCT FROM t.o_totalprice)) AS changed_rows
    FROM ({_CHANGED}) i LEFT JOIN {{orders}} t ON t.o_orderkey = i.o_orderkey
    """,
)
def upsert_affected(spark, sf):
    per_key = affected(
        derive(spark, sf, _CHANGED),
        load(spark, sf, "orders"),
        _KEY,
        ["o_orderstatus", "o_totalprice"],
        ["o_orderdate"],
    )
    return per_key.agg(
        F.sum("incoming_rows").alias("incoming_rows"),
        F.sum("new_rows").alias("new_rows"),
        F.sum("changed_rows").alias("changed_rows"),
    )


_LINE_ORDER = [
    "l_shipdate",
    "l_partkey",
    "l_suppkey",
    "l_extendedprice",
    "l_quantity",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_orderkey",
    "l_linenumber",
]
_FIRST_LINES = """
SELECT o_orderkey AS l_orderkey, CAST(1 AS INT) AS l_linenumber, CAST(o_custkey % 50 AS DOUBLE) AS l_quantity
FROM {orders}
"""


def _chain_oracle(keys: list[str], target: str) -> str:
    on = " AND ".join(f"t.{k} = i.{k}" for k in keys)
    by = ", ".join(keys)
    prefixed = ", ".join(f"i.{k}" for k in keys)
    return f"""
    SELECT {by}, count(*) AS incoming_rows, CAST(sum(new) AS BIGINT) AS new_rows,
           CAST(sum(changed) AS BIGINT) AS changed_rows, CAST(sum(new + 2 * changed) AS BIGINT) AS affected_rows
    FROM (SELECT {by}, CASE WHEN nth = 1 AND NOT known THEN 1 ELSE 0 END AS new,
                 CASE WHEN nth = 1 AND known AND l_quantity IS DISTINCT FROM old THEN 1
                      WHEN nth > 1 AND l_quantity IS DISTINCT FROM before THEN 1 ELSE 0 END AS changed
          FROM (SELECT {prefixed}, i.l_quantity, t.l_quantity AS old, t.{keys[0]} IS NOT NULL AS known,
                       row_number() OVER w AS nth, lag(i.l_quantity) OVER w AS before
                FROM {{lineitem}} i LEFT JOIN ({target}) t ON {on}
                WINDOW w AS (PARTITION BY {prefixed} ORDER BY {", ".join("i." + c for c in _LINE_ORDER)})))
    GROUP BY {by}
    """


@query("upsert_affected_chain", _chain_oracle(["l_orderkey", "l_linenumber"], _FIRST_LINES))
def upsert_affected_chain(spark, sf):
    keys = ["l_orderkey", "l_linenumber"]
    lines = load(spark, sf, "lineitem")
    return affected(lines, derive(spark, sf, _FIRST_LINES), keys, ["l_quantity"], _LINE_ORDER)


_FLAG_TARGET = """
SELECT CASE WHEN o_orderstatus = 'F' THEN 'R' ELSE o_orderstatus END AS l_returnflag,
       CAST(max(o_custkey) AS DOUBLE) AS l_quantity
FROM {orders} GROUP BY 1
"""


@query("upsert_affected_hot_keys", _chain_oracle(["l_returnflag"], _FLAG_TARGET))
def upsert_affected_hot_keys(spark, sf):
    # Three keys share all rows: each is cut into range slices and chained.
    lines = load(spark, sf, "lineitem")
    return affected(lines, derive(spark, sf, _FLAG_TARGET), ["l_returnflag"], ["l_quantity"], _LINE_ORDER)


@query(
    "dedupe_last_wins",
    f"""
    SELECT * EXCLUDE (nth) FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                     ORDER BY {", ".join(c + " DESC" for c in _LINE_ORDER)}) AS nth
        FROM {{lineitem}})
    WHERE nth = 1
    """,
)
def dedupe_last_wins(spark, sf):
    return last_wins(load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], _LINE_ORDER)


@query(
    "key_uniqueness",
    "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM {lineitem} GROUP BY 1, 2 HAVING count(*) > 1",
)
def key_uniqueness(spark, sf):
    return duplicate_keys(load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


YEARS = (1996, 1997, 1998, 2000)
_REJECTED = "o_orderstatus = 'P' AND o_totalprice > 300000"
_JUDGED = f"""
    SELECT o_orderkey, o_orderpriority, o_orderstatus, CASE WHEN year(o_orderdate) NOT IN (1996, 1997, 1998, 2000) THEN 'unselected'
           WHEN {_REJECTED} THEN 'filtered' ELSE 'loaded' END AS verdict
    FROM {{orders}}"""
_COUNTED = f"""
    SELECT o_orderpriority, o_orderstatus, count(*) AS submitted, count(*) FILTER (verdict = 'loaded') AS loaded,
           count(*) FILTER (verdict = 'filtered') AS filtered, count(*) FILTER (verdict = 'unselected') AS unselected
    FROM ({_JUDGED}) GROUP BY 1, 2"""


def _judged(spark, sf):
    orders = load(spark, sf, "orders")
    return accounting.with_verdict(orders, F.expr(_REJECTED), F.year("o_orderdate"), YEARS)


@query("load_accounting", _COUNTED)
def load_accounting(spark, sf):
    return _counted(spark, sf)


def _counted(spark, sf):
    return _judged(spark, sf).groupBy("o_orderpriority", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("submitted"), *accounting.counters()
    )


@query(
    "filter_ratio",
    f"""
    SELECT o_orderpriority, o_orderstatus, filtered + unselected AS reported_filtered,
           CASE WHEN filtered > 0.45 * (filtered + loaded) THEN 'LOAD_FILTERED' ELSE 'OK' END AS state
    FROM ({_COUNTED})
    """,
)
def filter_ratio(spark, sf):
    checked = accounting.receipts(_counted(spark, sf), 0.45)
    return checked.select("o_orderpriority", "o_orderstatus", "reported_filtered", "state")


@query("partition_list", f"SELECT o_orderkey, verdict FROM ({_JUDGED})")
def partition_list(spark, sf):
    return _judged(spark, sf).select("o_orderkey", F.col(accounting.VERDICT).alias("verdict"))


_PRICED = (
    TargetColumn.sql("id", "bigint", nullable=False, key=True),
    TargetColumn.sql("status", "varchar(2)"),
    TargetColumn.sql("price", "double"),
    TargetColumn.sql("note", "bigint", nullable=False, has_default=True, default=7),
)
# Stored ids are even; every later row is an altered stored one or, with an odd id, a new one next to it.
_PRICES = "SELECT o_orderkey * 2 AS id, o_orderkey, o_orderstatus AS status, o_totalprice AS price FROM {orders}"
_FIRST_PRICES = f"SELECT id, status, price, CAST(1 AS BIGINT) AS note FROM ({_PRICES})"
_LATER_PRICES = f"""
SELECT CASE WHEN o_orderkey % 3 = 0 THEN id + 1 ELSE id END AS id, 'XX' AS status,
       CASE WHEN o_orderkey % 5 = 0 THEN price ELSE price * 2 END AS price
FROM ({_PRICES})"""


def _priced_target(spark, sf):
    """A table in key ranges that follow its size, loaded with all orders."""
    first = derive(spark, sf, _FIRST_PRICES)
    target = ParquetTarget(fresh_folder(spark), _PRICED, "upsert", ("id",), KeyLayout.over(first, "id", 8))
    target.write(first, "first")
    return target


def _priced(taken: str) -> str:
    """The table after an upsert that takes the later rows where ``taken`` holds."""
    later = f"SELECT * FROM ({_LATER_PRICES}) WHERE {taken}"
    return f"""
    SELECT coalesce(i.id, t.id) AS id, CASE WHEN i.id IS NULL THEN t.status ELSE i.status END AS status,
           CASE WHEN i.id IS NULL THEN t.price ELSE i.price END AS price, coalesce(t.note, 7) AS note
    FROM ({_FIRST_PRICES}) t FULL OUTER JOIN ({later}) i ON t.id = i.id
    """


@query("upsert_rejects", _priced("price <= 300000"))
def upsert_rejects(spark, sf):
    target = _priced_target(spark, sf)
    target.write(derive(spark, sf, _LATER_PRICES), "later", reject=F.col("price") > 300000, max_filter_ratio=1.0)
    return target.read(spark)


@query("upsert_partitions", _priced("id % 10 IN (0, 3, 4, 6)"))
def upsert_partitions(spark, sf):
    target = _priced_target(spark, sf)
    target.write(derive(spark, sf, _LATER_PRICES), "later", partition=F.col("id") % 10, partitions=(0, 3, 4, 6))
    return target.read(spark)


@query("upsert_default_fill", _priced("true"))
def upsert_default_fill(spark, sf):
    target = _priced_target(spark, sf)
    target.write(derive(spark, sf, _LATER_PRICES), "later")
    return target.read(spark)


@query(
    "upsert_laid_out",
    f"""
    WITH bound AS (SELECT min(id) + (max(id) - min(id)) // 4 AS quarter FROM ({_FIRST_PRICES}))
    SELECT id, CASE WHEN id < quarter THEN 'YY' ELSE status END AS status, price, note FROM ({_priced("true")}), bound
    """,
)
def upsert_laid_out(spark, sf):
    """Two upserts into key ranges; the second touches and rewrites the first quarter of them."""
    target = _priced_target(spark, sf)
    target.write(derive(spark, sf, _LATER_PRICES), "later")
    low, high = derive(spark, sf, _FIRST_PRICES).agg(F.min("id"), F.max("id")).first()
    known = target.read(spark).where(F.col("id") < low + (high - low) // 4).select("id", F.lit("YY").alias("status"), "price")
    target.write(known, "again", updates=["status"])
    return target.read(spark)


_YEARS = (1993, 1996)
_BY_YEAR = "SELECT o_orderkey AS id, o_totalprice AS price, CAST(year(o_orderdate) AS INT) AS part FROM {orders}"


@query(
    "partition_overwrite",
    f"""
    WITH o AS ({_BY_YEAR}), counts AS (SELECT count(*) FILTER (part IN {_YEARS}) AS loaded, count(*) FILTER (part NOT IN {_YEARS}) AS unselected FROM o)
    SELECT id, CASE WHEN part IN {_YEARS} THEN price * 2 ELSE price END AS price, part, loaded, unselected FROM o, counts
    """,
)
def partition_overwrite(spark, sf):
    """Altered rows of all years over a table by year: only the listed years take them."""
    table = f"by_year_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {table} (id BIGINT, price DOUBLE, part INT) USING parquet PARTITIONED BY (part)")
    rows = derive(spark, sf, _BY_YEAR)
    rows.write.insertInto(table)
    done = overwrite_partitions(rows.withColumn("price", F.col("price") * 2), table, "part", _YEARS)
    return spark.table(table).withColumns({"loaded": F.lit(done.loaded).cast("long"), "unselected": F.lit(done.filtered).cast("long")})
