"""Whole copy jobs: plan, guarded conversion, commit groups, receipts and ledger."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from exactsync.errors import SyncError
from exactsync.ledger.store import Ledger
from exactsync.plans.job import SyncJob
from exactsync.plans.mapping import TargetColumn
from exactsync.queries.registry import load, query, table_path
from exactsync.queries.writes import fresh_folder
from exactsync.sinks.catalog import CatalogTarget
from exactsync.sinks.dataset import ParquetTarget
from exactsync.sources.split import KeyLayout, RangeSplit
from exactsync.sources.table import Source

_COLUMNS = (
    TargetColumn.sql("id", "bigint unsigned", nullable=False, key=True),
    TargetColumn.sql("total", "decimal(65,4)", nullable=False),
    TargetColumn.sql("status", "char(1)"),
    TargetColumn.sql("ordered", "datetime(0)"),
)
_MAPPING = (
    ("o_orderkey", "id"),
    ("o_totalprice", "total"),
    ("o_orderstatus", "status"),
    ("o_orderdate", "ordered"),
)


def _job(spark, sf, model: str, **options) -> tuple[SyncJob, Ledger]:
    keyed = model != "append"
    columns = tuple(c if keyed or not c.key else TargetColumn(c.name, c.type, c.nullable) for c in _COLUMNS)
    keys = load(spark, sf, "orders").select(F.col("o_orderkey").alias("id"))
    layout = KeyLayout.over(keys, "id", 6) if model == "upsert" else None
    target = ParquetTarget(fresh_folder(spark), columns, model, ("id",) if keyed else (), layout)
    source = Source(path=table_path(sf, "orders"), split=options.pop("split", None))
    return SyncJob(source, target, _MAPPING, **options), Ledger(spark, fresh_folder(spark))


_COPIED = """
SELECT CAST(o_orderkey AS DECIMAL(20,0)) AS id, CAST(CAST(o_totalprice AS DECIMAL(20,4)) AS VARCHAR) AS total,
       o_orderstatus AS status, o_orderdate AS ordered
FROM {orders}
"""


@query("job_append_groups", _COPIED)
def job_append_groups(spark, sf):
    """A split source in four commit groups or more, two at a time; a replayed request adds nothing."""
    split = RangeSplit.over(load(spark, sf, "orders"), "o_orderkey", 4)
    job, ledger = _job(spark, sf, "append", split=split, parallel_groups=2, request_id="copy")
    first = job.run(spark, ledger)
    again = job.run(spark, ledger)
    if first["state"] != "SUCCEEDED" or again["run_id"] != first["run_id"]:
        raise SyncError("STATE_STORE", str(first["error"]))
    return job.target.read(spark)


@query("job_upsert", f"SELECT * FROM ({_COPIED}) WHERE status <> 'P'")
def job_upsert(spark, sf):
    """An upsert job in key ranges with a reject rule, run twice under two request ids."""
    job, ledger = _job(
        spark, sf, "upsert", reject=F.col("status") == "P", max_filter_ratio=1.0, retries=0
    )
    for _ in range(2):
        done = job.run(spark, ledger)
        if done["state"] != "SUCCEEDED":
            raise SyncError("STATE_STORE", str(done["error"]))
    return job.target.read(spark)


@query(
    "run_after_reconcile",
    """
    SELECT 'FAILED' AS state, count(*) AS rows_submitted, count(*) AS rows_committed, CAST(1 AS BIGINT) AS batches_committed,
           count(*) AS server_affected_rows, true AS partial_write, false AS commit_unknown FROM {orders}
    """,
)
def run_after_reconcile(spark, sf):
    """A group became visible but its receipt was lost; settling it by its label also settles the run."""
    job, ledger = _job(spark, sf, "append")

    class Forgetful(Ledger):
        def confirmed(self, *_args, **_kwargs):
            raise OSError("the ledger went away")

    failed = job.run(spark, Forgetful(spark, ledger.root))
    ledger.reconcile(job.target.labels(spark))
    return ledger.runs().where(F.col("run_id") == failed["run_id"]).select(
        "state",
        "rows_submitted",
        "rows_committed",
        "batches_committed",
        "server_affected_rows",
        "partial_write",
        "commit_unknown",
    )


@query("job_into_table", f"SELECT * FROM ({_COPIED}) WHERE status <> 'P'")
def job_into_table(spark, sf):
    """Into a catalog table with a partition per commit group; the replayed request changes nothing."""
    table = f"orders_{uuid.uuid4().hex}"
    spark.sql(
        f"CREATE TABLE {table} (id DECIMAL(20,0), total STRING, status STRING, ordered TIMESTAMP_NTZ, _label STRING) "
        "USING parquet PARTITIONED BY (_label)"
    )
    columns = tuple(TargetColumn(c.name, c.type, c.nullable) for c in _COLUMNS)
    source = Source(path=table_path(sf, "orders"), split=RangeSplit.over(load(spark, sf, "orders"), "o_orderkey", 3))
    reject = {"reject": F.col("status") == "P", "max_filter_ratio": 1.0}
    job = SyncJob(source, CatalogTarget(table, columns), _MAPPING, request_id="table", **reject)
    ledger = Ledger(spark, fresh_folder(spark))
    for _ in range(2):
        done = job.run(spark, ledger)
        if done["state"] != "SUCCEEDED":
            raise SyncError("STATE_STORE", str(done["error"]))
    return job.target.read(spark)


_GROUPS = 16


@query(
    "job_single_scan_groups",
    f"""
    WITH bounds AS (SELECT min(o_orderkey) AS low, max(o_orderkey) + 1 - min(o_orderkey) AS width FROM {{orders}}),
    dealt AS (SELECT ((o_orderkey - low + 1) * {_GROUPS} - 1) // width AS batch_id, * FROM {{orders}}, bounds)
    SELECT CAST(batch_id AS INT) AS batch_id, 'CONFIRMED' AS state, CAST(count(*) AS BIGINT) AS submitted,
           count(*) FILTER (o_orderstatus <> 'P') AS loaded, count(*) FILTER (o_orderstatus = 'P') AS filtered,
           CAST(sum(o_orderkey) FILTER (o_orderstatus <> 'P') AS BIGINT) AS key_sum,
           CAST(sum(CAST(CAST(o_totalprice AS DECIMAL(20,4)) * 10000 AS BIGINT)) FILTER (o_orderstatus <> 'P') AS BIGINT) AS total_sum
    FROM dealt GROUP BY batch_id
    """,
)
def job_single_scan_groups(spark, sf):
    """One scan and one write for all commit groups, with rejects; receipts next to what the target holds of each group."""
    split = RangeSplit.over(load(spark, sf, "orders"), "o_orderkey", _GROUPS)
    rules = {"reject": F.col("status") == "P", "max_filter_ratio": 1.0}
    job, ledger = _job(spark, sf, "append", split=split, single_scan=True, request_id="dealt", **rules)
    first, again = job.run(spark, ledger), job.run(spark, ledger)
    if first["state"] != "SUCCEEDED" or again["run_id"] != first["run_id"]:
        raise SyncError("STATE_STORE", str(first["error"]))
    by_id = RangeSplit("id", split.lower, split.upper, split.partitions)
    total = (F.col("total").cast("decimal(30,4)") * 10000).cast("bigint")
    held = job.target.read(spark).groupBy(by_id.slice_id().alias("batch_id")).agg(
        F.sum("id").cast("bigint").alias("key_sum"), F.sum(total).alias("total_sum")
    )
    receipts = ledger.run_batches(first["run_id"])
    return receipts.join(held, "batch_id", "left").select(
        F.col("batch_id").cast("int").alias("batch_id"), "state", F.col("rows").alias("submitted"), "loaded", "filtered", "key_sum", "total_sum"
    )


@query(
    "table_rejects_replayed",
    """
    WITH kinds AS (SELECT o_orderpriority AS part, count(*) AS n, count(*) FILTER (o_orderstatus = 'O' OR o_orderpriority = '5-LOW') AS bad
                   FROM {orders} GROUP BY 1)
    SELECT part, n - bad AS first_loaded, bad AS first_filtered, n - bad AS replayed_loaded, bad AS replayed_filtered,
           'VISIBLE' AS label_state, n - bad AS stored_rows
    FROM kinds
    """,
)
def table_rejects_replayed(spark, sf):
    """Groups with rejects into a catalog table, one of them with nothing else, each written twice: the replay gives the first receipt."""
    table = f"replayed_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {table} (id BIGINT, status STRING, _label STRING) USING parquet PARTITIONED BY (_label)")
    target = CatalogTarget(table, (TargetColumn.sql("id", "bigint"), TargetColumn.sql("status", "varchar(30)")))
    orders = load(spark, sf, "orders")
    parts = [r[0] for r in orders.select("o_orderpriority").distinct().sort("o_orderpriority").collect()]
    receipts = []
    for n, part in enumerate(parts):
        rows = orders.where(F.col("o_orderpriority") == part).select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"))
        reject = (F.col("status") == "O") | F.lit(part == "5-LOW")
        first, second = (target.write(rows, f"g_{n}", reject=reject, max_filter_ratio=1.0) for _ in range(2))
        receipts.append((part, f"g_{n}", first.loaded, first.filtered, second.loaded, second.filtered))
    told = spark.createDataFrame(
        receipts, "part string, label string, first_loaded long, first_filtered long, replayed_loaded long, replayed_filtered long"
    )
    stored = spark.table(table).groupBy(F.col("_label").alias("label")).agg(F.count("*").alias("stored_rows"))
    out = told.join(target.labels(spark).select("label", "label_state"), "label").join(stored, "label", "left")
    return out.drop("label").withColumn("stored_rows", F.coalesce("stored_rows", F.lit(0)))
