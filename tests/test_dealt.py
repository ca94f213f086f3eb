"""Many commit groups from one scan, and what catalog tables remember of their groups."""

import json
import re
import uuid

import pytest
from pyspark.sql import functions as F

from exactsync import ParquetTarget, RangeSplit, Source, SyncError, SyncJob, TargetColumn
from exactsync.ledger.store import Ledger
from exactsync.plans import dealt
from exactsync.sinks.catalog import CatalogTarget

COLUMNS = (TargetColumn.sql("id", "bigint"), TargetColumn.sql("x", "int"), TargetColumn.sql("note", "varchar(20)"))
SPLIT = RangeSplit("id", 0, 100, 5)


@pytest.fixture
def ledger(spark, root):
    return Ledger(spark, f"{root}/ledger")


def source(spark, root, broken=(), null_ids=0):
    path = f"{root}/s"
    rows = spark.range(100).select(
        "id", (F.col("id") * 10 + F.when(F.col("id").isin(*broken), 0.5).otherwise(0)).alias("x"), F.lit("n").alias("note")
    )
    if null_ids:
        rows = rows.unionByName(spark.range(null_ids).select(F.lit(None).cast("long").alias("id"), F.lit(1.0).alias("x"), F.lit("n").alias("note")))
    rows.repartition(4).write.parquet(path)
    return Source(path=path, split=SPLIT)


def keyed():
    return (TargetColumn.sql("id", "bigint", nullable=False, key=True), *COLUMNS[1:])


def states(ledger, run):
    return {b["batch_id"]: b["state"] for b in ledger.run_batches(run["run_id"]).collect()}


def table(spark):
    name = f"t_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {name} (id BIGINT, x INT, note STRING, _label STRING) USING parquet PARTITIONED BY (_label)")
    return CatalogTarget(name, tuple(TargetColumn.sql(c, t) for c, t in (("id", "bigint"), ("x", "int"), ("note", "text"))))


@pytest.mark.parametrize("gather", [False, True])
def test_groups_of_one_scan(spark, root, ledger, gather):
    job = SyncJob(source(spark, root, null_ids=3), ParquetTarget(f"{root}/t", COLUMNS), single_scan=True, gather=gather, request_id="r")
    run = job.run(spark, ledger)
    assert (run["state"], run["rows_committed"], run["batches_committed"], run["rows_read"]) == ("SUCCEEDED", 103, 5, 103)
    assert run["bytes_read"] == 103 * (2 * 32 + 16 + 1)
    assert {b["batch_id"]: b["loaded"] for b in ledger.run_batches(run["run_id"]).collect()} == {0: 23, 1: 20, 2: 20, 3: 20, 4: 20}
    assert job.run(spark, ledger)["run_id"] == run["run_id"]
    assert job.target.read(spark).agg(F.count("*"), F.sum("id"), F.sum("x")).first()[:] == (103, 4950, 49503)


def test_the_source_is_scanned_once(spark, root, ledger, monkeypatch):
    plans = []
    deal = dealt.deal
    monkeypatch.setattr("exactsync.plans.job.deal", lambda rows, *a: plans.append(rows._jdf.queryExecution().toString()) or deal(rows, *a))
    monkeypatch.setattr(Source, "slices", lambda *_: pytest.fail("a scan per slice"))
    many = RangeSplit("id", 0, 100, 50)
    job = SyncJob(Source(path=source(spark, root).path, split=many), ParquetTarget(f"{root}/t", COLUMNS), single_scan=True)
    assert job.run(spark, ledger)["batches_committed"] == 50
    physical = plans[0].split("== Physical Plan ==")[1]
    assert len(plans) == 1 and len(re.findall("FileScan", physical)) == 1 and "Exchange" not in physical and "Python" not in physical


@pytest.mark.parametrize("keep_going", [False, True])
def test_a_broken_row_fails_its_group_only(spark, root, ledger, keep_going):
    job = SyncJob(source(spark, root, [25, 30]), ParquetTarget(f"{root}/t", COLUMNS), single_scan=True, keep_going=keep_going)
    run = job.run(spark, ledger)
    error = json.loads(run["error"])
    assert run["state"] == "FAILED" and error["code"] == "TYPE" and "x cannot hold" in error["message"] and "250.5" in error["message"]
    assert states(ledger, run) == ({0: "CONFIRMED", 2: "CONFIRMED", 3: "CONFIRMED", 4: "CONFIRMED"} if keep_going else {0: "CONFIRMED"})
    assert run["partial_write"] and not run["commit_unknown"]
    found = {r.id for r in job.target.read(spark).collect()}
    assert found == (set(range(100)) - set(range(20, 40)) if keep_going else set(range(20)))


def test_a_killed_group_leaves_the_others_confirmed(spark, root, ledger, monkeypatch):
    adopt = ParquetTarget.adopt

    def killed(self, spark, label, path, checked, size, announce=None):
        if label.endswith("_2"):
            announce(checked["loaded"], size)
            raise OSError("the process that wrote this group is gone")
        return adopt(self, spark, label, path, checked, size, announce)

    monkeypatch.setattr(ParquetTarget, "adopt", killed)
    job = SyncJob(source(spark, root), ParquetTarget(f"{root}/t", COLUMNS), single_scan=True, keep_going=True, parallel_groups=2)
    run = job.run(spark, ledger)
    assert run["state"] == "FAILED" and not run["commit_unknown"]
    assert states(ledger, run) == {0: "CONFIRMED", 1: "CONFIRMED", 2: "NOT_COMMITTED", 3: "CONFIRMED", 4: "CONFIRMED"}
    assert job.target.read(spark).count() == run["rows_committed"] == 80


def test_an_oversized_row_fails_its_group_only(spark, root, ledger):
    path = f"{root}/s"
    spark.range(100).select("id", F.col("id").cast("int").alias("x"), F.repeat(F.lit("n"), F.when(F.col("id") == 99, 20).otherwise(1).cast("int")).alias("note")).write.parquet(path)
    job = SyncJob(Source(path=path, split=SPLIT), ParquetTarget(f"{root}/t", COLUMNS), single_scan=True, max_row_bytes=90)
    run = job.run(spark, ledger)
    assert json.loads(run["error"])["code"] == "ROW_TOO_LARGE" and run["rows_committed"] == 80


def test_rejects_and_partitions_are_counted_by_group(spark, root, ledger):
    rules = {"reject": F.col("id") % 10 == 1, "partition": F.col("id") % 2, "partitions": [1], "max_filter_ratio": 0.2}
    job = SyncJob(source(spark, root), ParquetTarget(f"{root}/t", COLUMNS), single_scan=True, **rules)
    run = job.run(spark, ledger)
    assert [(b["loaded"], b["filtered"]) for b in ledger.run_batches(run["run_id"]).collect()] == [(8, 12)] * 5
    assert {r.id for r in job.target.read(spark).collect()} == {n for n in range(100) if n % 2 and n % 10 != 1}
    label = ledger.run_batches(run["run_id"]).first()["label"]
    assert sorted(r.id for r in job.target.rejects(spark, label).collect()) == [1, 11]
    strict = SyncJob(job.source, ParquetTarget(f"{root}/u", COLUMNS), single_scan=True, **{**rules, "max_filter_ratio": 0.1})
    assert json.loads(strict.run(spark, ledger)["error"])["code"] == "LOAD_FILTERED"


@pytest.mark.parametrize("layout", [None, RangeSplit("id", 0, 100, 3)])
def test_insert_and_upsert_by_group(spark, root, ledger, layout):
    inserted = ParquetTarget(f"{root}/i", keyed(), "insert", ("id",), layout)
    job = SyncJob(source(spark, root), inserted, single_scan=True)
    assert job.run(spark, ledger)["rows_committed"] == 100
    again = job.run(spark, ledger)
    assert json.loads(again["error"])["code"] == "DUPLICATE_KEY" and inserted.read(spark).count() == 100
    merged = ParquetTarget(f"{root}/u", keyed(), "upsert", ("id",), layout)
    for affected in (100, 0):
        run = SyncJob(job.source, merged, single_scan=True).run(spark, ledger)
        assert (run["state"], run["rows_committed"], run["server_affected_rows"], run["batches_committed"]) == ("SUCCEEDED", 100, affected, 5)
    assert merged.read(spark).agg(F.count("*"), F.sum("x")).first()[:] == (100, 49500)


def test_an_empty_source_has_no_groups(spark, root, ledger):
    spark.range(0).select("id", F.lit(1).alias("x"), F.lit("n").alias("note")).write.parquet(f"{root}/s")
    job = SyncJob(Source(path=f"{root}/s", split=SPLIT), ParquetTarget(f"{root}/t", COLUMNS), single_scan=True)
    run = job.run(spark, ledger)
    assert (run["state"], run["batches_committed"]) == ("SUCCEEDED", 0) and job.target.read(spark).count() == 0


def test_options(spark, root):
    split, target = source(spark, root), ParquetTarget(f"{root}/t", COLUMNS)
    unsplit = Source(path=split.path)
    for job in (
        SyncJob(unsplit, target, single_scan=True),
        SyncJob(split, target, gather=True),
        SyncJob(split, ParquetTarget(f"{root}/u", keyed(), "upsert", ("id",)), keep_going=True),
    ):
        with pytest.raises(SyncError) as e:
            job.plan(spark)
        assert e.value.code == "INVALID_CONFIG"


# -- catalog tables ------------------------------------------------------------------------


@pytest.mark.parametrize("single_scan", [False, True])
def test_catalog_groups_remember_their_counters(spark, root, ledger, single_scan):
    target = table(spark)
    job = SyncJob(source(spark, root), target, single_scan=single_scan, reject=F.col("id") < 23, max_filter_ratio=1.0)
    run = job.run(spark, ledger)
    batches = ledger.run_batches(run["run_id"]).collect()
    counts = [(b["loaded"], b["filtered"]) for b in batches]
    assert run["state"] == "SUCCEEDED" and counts == [(0, 20), (17, 3), (20, 0), (20, 0), (20, 0)]
    for batch, (loaded, filtered) in zip(batches, counts, strict=True):
        told = target.receipt(spark, batch["label"])
        assert (told.loaded, told.filtered, told.affected, told.replayed) == (loaded, filtered, loaded, True)
        rows = spark.createDataFrame([(1, 1, "n")], "id long, x int, note string")
        assert target.write(rows, batch["label"]) == told
    assert target.read(spark).count() == 77
    found = {r.label: tuple(r)[1:] for r in target.labels(spark, ["gone"]).collect()}
    assert found == {"gone": ("ABORTED", None, None, None)} | {
        b["label"]: ("VISIBLE", n, f, n) for b, (n, f) in zip(batches, counts, strict=True)
    }


@pytest.mark.parametrize("reject, loaded", [("id < 40", 60), ("true", 0)])
def test_a_lost_reply_is_settled_with_the_first_counters(spark, root, ledger, reject, loaded, monkeypatch):
    target = table(spark)
    lost = CatalogTarget.adopt

    def no_answer(self, *args):
        lost(self, *args)
        raise OSError("no answer")

    monkeypatch.setattr(CatalogTarget, "adopt", no_answer)
    job = SyncJob(Source(path=source(spark, root).path), target, reject=F.expr(reject), max_filter_ratio=1.0)
    run = job.run(spark, ledger)
    assert (run["state"], run["rows_committed"], run["rows_filtered"]) == ("SUCCEEDED", loaded, 100 - loaded)


@pytest.mark.parametrize("reject", ["id < 40", "true"])
def test_reconciling_groups_with_rejects(spark, root, ledger, reject, monkeypatch):
    target = table(spark)

    class Forgetful(Ledger):
        def confirmed(self, *_args, **_kwargs):
            raise OSError("the ledger went away")

    job = SyncJob(Source(path=source(spark, root).path), target, reject=F.expr(reject), max_filter_ratio=1.0)
    failed = job.run(spark, Forgetful(spark, ledger.root))
    assert failed["commit_unknown"]
    assert [d["action"] for d in ledger.reconcile(target.labels(spark), 1.0)] == ["CONFIRM"]
    after = ledger.run(failed["run_id"])
    assert after["rows_committed"] + after["rows_filtered"] == 100 and not after["commit_unknown"]


def test_a_group_that_was_promised_but_not_written_is_not_committed(spark, root, ledger, monkeypatch):
    target = table(spark)
    monkeypatch.setattr("exactsync.sinks.catalog.append_to_table", lambda *_: (_ for _ in ()).throw(OSError("gone")))
    job = SyncJob(Source(path=source(spark, root).path), target)
    run = job.run(spark, ledger)
    batch = ledger.run_batches(run["run_id"]).first()
    assert run["state"] == "FAILED" and batch["state"] == "NOT_COMMITTED" and not run["commit_unknown"]
    assert target.receipt(spark, batch["label"]) is None and target.labels(spark).count() == 0
    monkeypatch.undo()
    rows = spark.read.parquet(job.source.path).selectExpr("id", "cast(x as int) x", "note")
    with pytest.raises(SyncError) as e:
        target.write(rows.where("id < 5"), batch["label"])
    assert e.value.code == "CONFLICT"
    assert target.write(rows, batch["label"]).loaded == 100 and target.receipt(spark, batch["label"]).loaded == 100
