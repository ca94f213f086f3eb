"""End-to-end copies with the acceptance fixtures: exact types, splits, hooks, failures, round trips."""

import json
from datetime import datetime, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from exactsync import Parameter, ParquetTarget, RangeSplit, Source, SyncError, SyncJob, TargetColumn
from exactsync.ledger.store import Ledger
from exactsync.operators.verify import row_diff
from exactsync.types import of_sql

ORDER_TYPES = {
    "id": "bigint unsigned",
    "amount": "decimal(30,8)",
    "precise_value": "decimal(65,5)",
    "Name": "varchar(512)",
    "event_time": "datetime(6)",
    "event_instant": "timestamp(6)",
    "enabled": "tinyint",
    "notes": "text",
}


ROWS = 47


def order_rows():
    """Rows at the edges of the types: the largest unsigned key, 65-digit decimals, all planes of text, NULLs."""
    for n in range(ROWS):
        at = datetime(1970 + n, 1 + n % 12, 1 + n % 28, n % 24, n, 59 - n % 60, 999_999 - n)
        yield (
            Decimal(n if n < ROWS - 1 else 2**64 - 1),
            None if n % 5 == 2 else Decimal(10**21 + 7 * n).scaleb(-8) * (-1) ** n,
            f"{'-' if n % 2 else ''}{10**59 + n}.{n:05d}",
            [None, "", f"zürich-{n}", f"日本\t{n}", "\U0001f600'\"\\"][n % 5],
            at,
            at.replace(tzinfo=timezone.utc),
            n - 20,
            "\n".join(["x" * n, r"\N", "NULL"][: n % 4]),
        )


def schema(types, **not_null):
    return T.StructType([of_sql(t).field(n, n not in not_null) for n, t in types.items()])


@pytest.fixture
def orders(spark, root):
    path = f"{root}/source_orders"
    spark.createDataFrame(list(order_rows()), schema(ORDER_TYPES)).repartition(3).write.parquet(path)
    return path


@pytest.fixture
def ledger(spark, root):
    return Ledger(spark, f"{root}/ledger")


def order_target(root, name="target", model="append", zone_types=None, keys=()):
    types = {**ORDER_TYPES, "id": "decimal(20,0)", "amount": "decimal(30,10)", "event_instant": "datetime(6)"}
    columns = tuple(
        TargetColumn.sql(n, t, nullable=n != "id", key=n in keys) for n, t in (zone_types or types).items()
    )
    return ParquetTarget(f"{root}/{name}", columns, model, keys)


def test_exact_types_round_trip(spark, root, orders, ledger):
    out = order_target(root)
    there = SyncJob(Source(path=orders), out, time_zone="+08:00").run(spark, ledger)
    assert (there["state"], there["rows_committed"], there["batches_committed"]) == ("SUCCEEDED", 47, 1)
    returned = order_target(root, "returned", zone_types=ORDER_TYPES)
    views = {"copied": out.read(spark)}
    back = SyncJob(Source(query="SELECT * FROM {copied}"), returned, time_zone="+08:00", views=views)
    assert back.run(spark, ledger)["state"] == "SUCCEEDED"
    assert row_diff(spark.read.schema(schema(ORDER_TYPES)).parquet(orders), returned.read(spark)).isEmpty()
    wall = out.read(spark).where("id = 3").select("event_instant").first()[0]
    assert wall == datetime(1973, 4, 4, 11, 3, 56, 999_996)  # 03:03 in UTC, eight hours on


def test_request_ids(spark, root, orders, ledger):
    job = SyncJob(Source(path=orders), order_target(root), request_id="r1")
    first = job.run(spark, ledger)
    assert job.run(spark, ledger)["run_id"] == first["run_id"]
    assert job.target.read(spark).count() == 47
    other = SyncJob(Source(path=orders), order_target(root, "another"), request_id="r1")
    with pytest.raises(SyncError) as e:
        other.run(spark, ledger)
    assert e.value.code == "CONFLICT"


def test_identical_upsert_affects_nothing(spark, root, orders, ledger):
    target = order_target(root, model="upsert", keys=("id",))
    first = SyncJob(Source(path=orders), target).run(spark, ledger)
    assert (first["rows_committed"], first["server_affected_rows"]) == (47, 47)
    again = SyncJob(Source(path=orders), target).run(spark, ledger)
    assert (again["rows_committed"], again["server_affected_rows"]) == (47, 0)


def test_empty_result_runs_hooks(spark, root, orders, ledger):
    calls = []
    job = SyncJob(
        Source(path=orders, where="id < 0"),
        order_target(root),
        pre_sql=[lambda s: calls.append("pre")],
        post_sql=[lambda s: calls.append("post")],
    )
    run = job.run(spark, ledger)
    assert (run["state"], run["rows_committed"], calls) == ("SUCCEEDED", 0, ["pre", "post"])


def test_rename_and_bound_parameters(spark, root, orders, ledger):
    views = {"source_orders": spark.read.schema(schema(ORDER_TYPES)).parquet(orders)}
    source = Source(
        query="SELECT Name AS old_name, id AS old_id FROM {source_orders} WHERE id >= ? AND id < ?;",
        params=(Parameter("u64", "10"), Parameter("u64", "20")),
    )
    mapping = (("old_id", "id"), ("old_name", "Name"))
    target = order_target(root)
    run = SyncJob(source, target, mapping, views=views).run(spark, ledger)
    assert (run["state"], run["rows_committed"]) == ("SUCCEEDED", 10)
    assert target.read(spark).where("amount IS NOT NULL").isEmpty()


def test_split_groups_cover_all_tails(spark, root, orders, ledger):
    source = Source(path=orders, split=RangeSplit("id", 10, 30, 4))
    run = SyncJob(source, order_target(root)).run(spark, ledger)
    assert (run["rows_committed"], run["batches_committed"], run["rows_read"]) == (47, 4, 47)
    batches = ledger.run_batches(run["run_id"]).collect()
    assert [b["state"] for b in batches] == ["CONFIRMED"] * 4
    assert sum(b["rows"] for b in batches) == 47 and len({b["label"] for b in batches}) == 4


def test_failing_group_keeps_earlier_commits(spark, root, ledger):
    path = f"{root}/s"
    spark.range(100).select("id", (F.col("id") * 10 + F.when(F.col("id") == 80, 0.5).otherwise(0)).alias("x")).write.parquet(path)
    target = ParquetTarget(f"{root}/t", (TargetColumn.sql("id", "bigint"), TargetColumn.sql("x", "int")))
    run = SyncJob(Source(path=path, split=RangeSplit("id", 0, 100, 4)), target).run(spark, ledger)
    assert run["state"] == "FAILED" and json.loads(run["error"])["code"] == "TYPE"
    assert run["rows_committed"] == 75 and run["partial_write"] and not run["commit_unknown"]
    assert target.read(spark).count() == 75
    assert [b["state"] for b in ledger.run_batches(run["run_id"]).collect()] == ["CONFIRMED"] * 3


def test_post_hook_failure_preserves_commits(spark, root, orders, ledger):
    job = SyncJob(Source(path=orders, where="id < 3"), order_target(root), post_sql=("SELECT missing_column",))
    run = job.run(spark, ledger)
    assert (run["state"], run["stage"], run["rows_committed"]) == ("FAILED", "post_sql", 3)
    assert run["partial_write"]


def test_bad_query_is_a_visible_failure(spark, root, orders, ledger):
    job = SyncJob(Source(query="SELECT missing_column FROM {t}"), order_target(root), views={"t": spark.read.parquet(orders)})
    run = job.run(spark, ledger)
    assert run["state"] == "FAILED" and run["rows_committed"] == 0 and not run["commit_unknown"]


def test_cancelled_between_groups(spark, root, orders, ledger):
    job = SyncJob(
        Source(path=orders, split=RangeSplit("id", 10, 30, 4)),
        order_target(root),
        request_id="r1",
        pre_sql=[lambda s: ledger.cancel_request("r1")],
    )
    run = job.run(spark, ledger)
    assert run["state"] == "CANCELLED" and run["rows_committed"] == 0


def test_lost_receipt_is_unknown(spark, root, orders, ledger, monkeypatch):
    def broken(*args, **kwargs):
        raise OSError("disk full")

    monkeypatch.setattr(Ledger, "confirmed", broken)
    target = order_target(root)
    run = SyncJob(Source(path=orders), target).run(spark, ledger)
    assert run["state"] == "FAILED" and run["commit_unknown"] and run["rows_committed"] == 0
    # The rows are visible under their label, so looking there settles the batch.
    monkeypatch.undo()
    assert [d["action"] for d in ledger.reconcile(target.labels(spark))] == ["CONFIRM"]
    assert [b["state"] for b in ledger.run_batches(run["run_id"]).collect()] == ["CONFIRMED"]
    assert target.read(spark).count() == 47


def test_secrets_are_redacted(spark, root, orders, ledger):
    job = SyncJob(Source(path=orders, where="id < 0"), order_target(root), extra_config={"reader": {"password": "s3cret"}})
    run = job.run(spark, ledger)
    assert "s3cret" not in json.dumps(run, default=str) and "[REDACTED]" in ledger.run(run["run_id"])["config"]


def test_unsigned_and_boolean_full_row_upsert(spark, root, ledger):
    source_types = {"id": "bigint unsigned", "enabled": "tinyint"}
    columns = (
        TargetColumn.sql("id", "largeint", nullable=False, key=True),
        TargetColumn.sql("enabled", "boolean", nullable=False),
    )
    target = ParquetTarget(f"{root}/special", columns, "upsert", ("id",))
    for flip in (False, True):
        rows = [(Decimal(0), int(flip)), (Decimal(2**64 - 1), 1 - int(flip))]
        view = spark.createDataFrame(rows, schema(source_types))
        run = SyncJob(Source(query="SELECT * FROM {s}"), target, views={"s": view}).run(spark, ledger)
        assert run["server_affected_rows"] == (4 if flip else 2)
    back = ParquetTarget(f"{root}/back", tuple(TargetColumn.sql(n, t) for n, t in source_types.items()))
    SyncJob(Source(query="SELECT * FROM {s}"), back, views={"s": target.read(spark)}).run(spark, ledger)
    assert row_diff(view, back.read(spark)).isEmpty()


def test_time_and_binary_need_an_explicit_projection(spark, root, ledger):
    rows = [(1, Decimal("-1234567.89"), "-25:00:00.000001", bytearray(b"\xff\x00")), (2, None, None, None)]
    view = spark.createDataFrame(rows, "id bigint, small decimal(9,2), t string, raw binary").selectExpr(
        "id", "small", "CAST(CASE WHEN t IS NOT NULL THEN INTERVAL '-1 01:00:00.000001' DAY TO SECOND END AS INTERVAL DAY TO SECOND) AS duration", "raw"
    )
    columns = (
        TargetColumn.sql("id", "bigint", nullable=False),
        TargetColumn.sql("small", "decimal(9,2)"),
        TargetColumn.sql("duration", "bigint"),
        TargetColumn.sql("raw", "string"),
    )
    target = ParquetTarget(f"{root}/scalar", columns)
    with pytest.raises(SyncError) as e:
        SyncJob(Source(query="SELECT * FROM {s}"), target, views={"s": view}).plan(spark)
    assert e.value.code == "TYPE"
    query = """
        SELECT id, small, CAST(extract(DAY FROM duration) * 86400000000 + extract(HOUR FROM duration) * 3600000000
               + extract(MINUTE FROM duration) * 60000000 + extract(SECOND FROM duration) * 1000000 AS BIGINT) AS duration,
               hex(raw) AS raw FROM {s}
    """
    run = SyncJob(Source(query=query), target, views={"s": view}).run(spark, ledger)
    assert run["state"] == "SUCCEEDED"
    got = {r.id: (r.duration, r.raw) for r in target.read(spark).collect()}
    assert got == {1: (-90000000001, "FF00"), 2: (None, None)}


def test_oversize_row_fails_the_run(spark, root, ledger):
    view = spark.createDataFrame([("a",), ("b" * 5000,)], "s string")
    target = ParquetTarget(f"{root}/t", (TargetColumn.sql("s", "text"),))
    run = SyncJob(Source(query="SELECT * FROM {s}"), target, views={"s": view}, max_row_bytes=4096).run(spark, ledger)
    assert run["state"] == "FAILED" and json.loads(run["error"])["code"] == "ROW_TOO_LARGE"
    assert target.read(spark).isEmpty()


def test_retry_only_what_is_known_uncommitted(spark, root, orders, ledger, monkeypatch):
    attempts = []
    real = ParquetTarget.write

    def flaky(self, df, label, **options):
        attempts.append(label)
        if len(attempts) == 1:
            raise SyncError.server(1213, "deadlock")
        return real(self, df, label, **options)

    monkeypatch.setattr(ParquetTarget, "write", flaky)
    run = SyncJob(Source(path=orders), order_target(root), backoff_ms=1).run(spark, ledger)
    assert run["state"] == "SUCCEEDED" and len(attempts) == 2 and len(set(attempts)) == 1


def test_job_options_are_checked(spark, root, orders):
    for bad in (
        SyncJob(Source(path=orders), order_target(root), retries=17),
        SyncJob(Source(path=orders), order_target(root), label_prefix="a-b"),
        SyncJob(Source(path=orders), order_target(root), time_zone="UTC"),
        SyncJob(Source(path=orders), order_target(root), order=("id",)),
        SyncJob(Source(path=orders), order_target(root, model="upsert", keys=("id",)), updates=("id",)),
    ):
        with pytest.raises(SyncError):
            bad.plan(spark)


def test_groups_run_in_parallel(spark, root, orders, ledger):
    source = Source(path=orders, split=RangeSplit("id", 10, 30, 4))
    target = order_target(root)
    run = SyncJob(source, target, parallel_groups=3, writers=2).run(spark, ledger)
    assert (run["state"], run["rows_committed"], run["batches_committed"]) == ("SUCCEEDED", 47, 4)
    assert target.read(spark).count() == 47
    assert sorted(c["version"] for c in target.commits(spark)) == [0, 1, 2, 3]


def test_full_row_upserts_need_every_column(spark, root, orders):
    columns = order_target(root, model="upsert", keys=("id",)).columns
    target = ParquetTarget(f"{root}/full", columns, "upsert", ("id",), full_row=True)
    SyncJob(Source(path=orders), target).plan(spark)
    with pytest.raises(SyncError):
        SyncJob(Source(path=orders), target, (("id", "id"), ("notes", "notes"))).plan(spark)
    with pytest.raises(SyncError):
        SyncJob(Source(path=orders), target, parallel_groups=2).plan(spark)


def broken_after_publishing(monkeypatch):
    """Markers are published, but the call that does so fails."""
    from exactsync.sinks import files

    real = files.create_json

    def publish(spark, path, content):
        done = real(spark, path, content)
        if "/_commits/" in path:
            raise OSError("connection lost")
        return done

    monkeypatch.setattr(files, "create_json", publish)


def test_a_group_that_became_visible_is_confirmed(spark, root, orders, ledger, monkeypatch):
    target = order_target(root)
    broken_after_publishing(monkeypatch)
    run = SyncJob(Source(path=orders), target).run(spark, ledger)
    assert (run["state"], run["rows_committed"], run["commit_unknown"]) == ("SUCCEEDED", ROWS, False)


def test_a_lookup_that_fails_leaves_the_outcome_open(spark, root, orders, ledger, monkeypatch):
    target = order_target(root)
    broken_after_publishing(monkeypatch)
    with monkeypatch.context() as blind:
        blind.setattr(ParquetTarget, "receipt", lambda *_: (_ for _ in ()).throw(OSError("still lost")))
        run = SyncJob(Source(path=orders), target).run(spark, ledger)
    assert (run["state"], run["rows_committed"], run["commit_unknown"]) == ("FAILED", 0, True)
    monkeypatch.undo()
    assert [d["action"] for d in ledger.reconcile(target.labels(spark))] == ["CONFIRM"]
    after = ledger.run(run["run_id"])
    assert (after["rows_committed"], after["batches_committed"], after["commit_unknown"]) == (ROWS, 1, False)
    assert after["partial_write"] and after["server_affected_rows"] == ROWS


def test_batches_of_a_writer_that_is_gone_are_settled_as_not_committed(spark, root, orders, ledger):
    target = order_target(root)
    run_id, _ = ledger.submit({"job": 1})
    ledger.intent(run_id, 0, "gone_0", 5)
    ledger.finish(run_id, "FAILED", SyncError.unknown("lost"))
    assert ledger.run(run_id)["commit_unknown"]
    assert [d["action"] for d in ledger.reconcile(target.labels(spark, ["gone_0"]))] == ["RETRY"]
    assert [b["state"] for b in ledger.run_batches(run_id).collect()] == ["NOT_COMMITTED"]
    assert not ledger.run(run_id)["commit_unknown"]


def test_every_option_is_part_of_the_request(spark, root, orders):
    from dataclasses import replace
    from functools import partial

    from exactsync.operators.batching import Limits

    def hook(spark, value):
        return value

    job = SyncJob(Source(path=orders), order_target(root), request_id="r")
    changes = [
        {"reject": F.col("id") > 5},
        {"reject": F.col("id") > 6},
        {"partition": F.col("id"), "partitions": (1, 2)},
        {"max_row_bytes": 1000},
        {"label_prefix": "other"},
        {"limits": Limits(10, 1 << 20)},
        {"pre_sql": [lambda s: 1]},
        {"pre_sql": [lambda s: 2]},
        {"pre_sql": [partial(hook, value=1)]},
        {"pre_sql": [partial(hook, value=2)]},
        {"target": replace(job.target, columns=(replace(job.target.columns[0], nullable=True), *job.target.columns[1:]))},
    ]
    prints = [json.dumps(replace(job, **c).config(), sort_keys=True) for c in [{}, *changes]]
    assert len(set(prints)) == len(prints)
    assert json.dumps(replace(job, reject=F.col("id") > 5).config(), sort_keys=True) == prints[1]


def test_declared_limits_hold_on_write(spark, root, ledger):
    columns = (
        TargetColumn.sql("t", "varchar(1)"),
        TargetColumn.sql("d", "date"),
        TargetColumn.sql("h", "time"),
    )
    for n, (t, d, h) in enumerate([("toolong", "2000-01-01", 1), ("é", "+12000-01-01", 1), ("é", "2000-01-01", 900)]):
        path = f"{root}/limits{n}"
        spark.sql(f"SELECT '{t}' AS t, DATE '{d}' AS d, make_dt_interval(0, {h}, 0, 0) AS h").write.parquet(path)
        target = ParquetTarget(f"{root}/limited{n}", columns)
        run = SyncJob(Source(path=path), target).run(spark, ledger)
        assert run["state"] == "FAILED" and json.loads(run["error"])["code"] == "TYPE"
        assert target.read(spark).isEmpty()


def test_parallel_groups_need_an_append_target(spark, root, orders, ledger):
    target = order_target(root, model="insert", keys=("id",))
    source = Source(path=orders, split=RangeSplit("id", 0, 40, 4))
    with pytest.raises(SyncError):
        SyncJob(source, target, parallel_groups=4).plan(spark)
