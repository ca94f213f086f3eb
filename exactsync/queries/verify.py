"""Verification: checksums, exact row difference, round trips and generated rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from exactsync.operators.checktree import range_diff
from exactsync.operators.verify import bench_columns, checksum, compare_checksums, row_diff, same_value
from exactsync.plans.mapping import TargetColumn, plan_mapping
from exactsync.queries.registry import derive, load, query

_COPY = """
SELECT o_orderkey, o_custkey, CASE WHEN o_custkey % 100 = 1 THEN 'XX' ELSE o_orderstatus END AS o_orderstatus, o_totalprice
FROM {orders}
"""
_SAME = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM {orders}"


def _sums():
    return {
        "key_sum": F.col("o_orderkey"),
        "amount_sum": F.col("o_totalprice").cast("decimal(15,2)"),
        "byte_sum": F.octet_length("o_orderstatus"),
        "last_place_sum": F.expr(
            "CAST(o_orderkey AS DECIMAL(20,0)) * 1.000001 + CASE WHEN o_orderstatus = 'XX' THEN 0.000001 ELSE 0.000000 END"
        ).cast("decimal(30,6)"),
    }


_SIDE = """SELECT count(*) AS n, sum(o_orderkey) AS k, sum(CAST(o_totalprice AS DECIMAL(15,2))) AS a,
                  sum(octet_length(encode(o_orderstatus))) AS b,
                  sum(CAST(o_orderkey AS DECIMAL(20,6)) * CAST(1.000001 AS DECIMAL(7,6))
                      + CASE WHEN o_orderstatus = 'XX' THEN 0.000001 ELSE 0 END) AS p FROM"""


@query(
    "checksum_compare",
    f"""
    SELECT unnest(['n_rows', 'key_sum', 'amount_sum', 'byte_sum', 'last_place_sum']) AS measure,
           unnest([CAST(l.n AS DOUBLE), CAST(l.k AS DOUBLE), CAST(l.a AS DOUBLE), CAST(l.b AS DOUBLE), CAST(l.p AS DOUBLE)]) AS left_value,
           unnest([CAST(r.n AS DOUBLE), CAST(r.k AS DOUBLE), CAST(r.a AS DOUBLE), CAST(r.b AS DOUBLE), CAST(r.p AS DOUBLE)]) AS right_value,
           unnest([l.n = r.n, l.k = r.k, l.a = r.a, l.b = r.b, l.p = r.p]) AS same
    FROM ({_SIDE} ({_SAME})) l, ({_SIDE} ({_COPY})) r
    """,
)
def checksum_comparison(spark, sf):
    compared = compare_checksums(derive(spark, sf, _SAME), derive(spark, sf, _COPY), _sums())
    return compared.select(
        "measure",
        F.col("left_value").cast("double").alias("left_value"),
        F.col("right_value").cast("double").alias("right_value"),
        "same",
    )


@query(
    "row_diff",
    f"""
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(sum(d) AS BIGINT) AS surplus
    FROM (SELECT *, 1 AS d FROM ({_SAME}) UNION ALL SELECT *, -1 AS d FROM ({_COPY}))
    GROUP BY 1, 2, 3, 4 HAVING sum(d) <> 0
    """,
)
def row_difference(spark, sf):
    return row_diff(derive(spark, sf, _SAME), derive(spark, sf, _COPY))


@query(
    "range_checksum_diff",
    f"""
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(sum(d) AS BIGINT) AS surplus
    FROM (SELECT *, 1 AS d FROM ({_SAME}) UNION ALL SELECT *, -1 AS d FROM ({_COPY}))
    GROUP BY 1, 2, 3, 4 HAVING sum(d) <> 0
    """,
)
def range_checksum_difference(spark, sf):
    """The rows of ``row_diff``, found by checksums of key ranges."""
    return range_diff(derive(spark, sf, _SAME), derive(spark, sf, _COPY), "o_orderkey")


@query(
    "roundtrip_lossless",
    "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_different FROM {lineitem}",
)
def roundtrip_lossless(spark, sf):
    lines = load(spark, sf, "lineitem")
    narrow = {
        "l_orderkey": "largeint",
        "l_partkey": "decimal(20,0)",
        "l_suppkey": "bigint unsigned",
        "l_linenumber": "tinyint unsigned",
        "l_quantity": "smallint",
        "l_extendedprice": "decimal(65,5)",
        "l_discount": "decimal(9,2)",
        "l_tax": "decimal(38,4)",
        "l_returnflag": "varchar(1)",
        "l_linestatus": "char(1)",
        "l_shipdate": "timestamp(0)",
    }
    there = tuple(TargetColumn.sql(name, sql_type, nullable=False) for name, sql_type in narrow.items())
    zone = "+08:00"
    kept = [F.col(c).alias(f"was_{c}") for c in lines.columns]
    out_plan = plan_mapping(lines.schema, there, time_zone=zone)
    out = out_plan.apply(lines)
    back_plan = plan_mapping(out.schema, lines.schema, time_zone=zone)
    # Both ways and the comparison in one pass: a row is compared with itself, so none moves.
    rows = lines.select(*kept, *out_plan.columns())
    rows = rows.select(*[f"was_{c}" for c in lines.columns], *back_plan.columns())
    same = F.lit(True)
    for f in lines.schema.fields:
        same = same & same_value(F.col(f"was_{f.name}"), F.col(f.name), f.dataType)
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(~same).alias("n_different"))


@query(
    "generated_checksum",
    """
    SELECT count(*) AS n_rows, CAST(sum(o_orderkey) AS DOUBLE) AS id_sum,
           CAST(sum(o_orderkey) AS DOUBLE) / 10000 AS amount_sum,
           CAST(sum(octet_length(encode(concat('row-', CAST(o_orderkey AS VARCHAR))))) AS DOUBLE) AS byte_sum
    FROM {orders}
    """,
)
def generated_checksum(spark, sf):
    rows = load(spark, sf, "orders").select(*bench_columns(F.col("o_orderkey")))
    sums = {"id_sum": F.col("id"), "amount_sum": F.col("amount"), "byte_sum": F.octet_length("payload")}
    out = checksum(rows, sums)
    return out.select("n_rows", *[F.col(c).cast("double").alias(c) for c in sums])
