from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from exactsync.errors import SyncError
from exactsync.operators.batching import Limits
from exactsync.operators.verify import row_diff
from exactsync.plans.mapping import TargetColumn
from exactsync.sinks import files
from exactsync.sinks.catalog import append_to_table, table_columns
from exactsync.sinks.dataset import ParquetTarget
from exactsync.sinks.hooks import run_hooks
from exactsync.sinks.jdbc import JdbcTarget
from exactsync.sources.split import RangeSplit

COLUMNS = (TargetColumn.sql("k", "bigint", nullable=False), TargetColumn.sql("v", "varchar(20)"))
KEYED = (TargetColumn.sql("k", "bigint", nullable=False, key=True), TargetColumn.sql("v", "varchar(20)"))


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), "k bigint, v string")


def content(target, spark):
    return sorted(tuple(r) for r in target.read(spark).collect())


def test_append_keeps_duplicates_and_replays_nothing(spark, root):
    target = ParquetTarget(root, COLUMNS)
    assert content(target, spark) == []
    df = frame(spark, (1, "a"), (1, "a"))
    first = target.write(df, "l0")
    assert (first.loaded, first.affected, first.replayed) == (2, 2, False)
    assert first.bytes == 2 * (32 + 1 + 16)
    again = target.write(frame(spark, (9, "z")), "l0")
    assert again.replayed and again.loaded == 2
    target.write(df, "l1")
    assert content(target, spark) == [(1, "a")] * 4
    assert [c["label"] for c in target.commits(spark)] == ["l0", "l1"]


def test_uncommitted_files_are_invisible_and_overwritten(spark, root):
    target = ParquetTarget(root, COLUMNS)
    target.write(frame(spark, (1, "a")), "l0")
    frame(spark, (7, "lost"), (8, "lost")).write.parquet(f"{root}/data/_label=l1")
    assert content(target, spark) == [(1, "a")]
    target.write(frame(spark, (2, "b")), "l1")
    assert content(target, spark) == [(1, "a"), (2, "b")]


def test_failing_guard_commits_nothing(spark, root):
    target = ParquetTarget(root, COLUMNS)
    bad = frame(spark, (1, "a")).withColumn("v", F.raise_error(F.lit("TYPE: no")).cast("string"))
    with pytest.raises(PySparkException):
        target.write(bad, "l0")
    assert target.commits(spark) == []


def test_insert_refuses_key_clashes(spark, root):
    target = ParquetTarget(root, KEYED, "insert", ("k",))
    target.write(frame(spark, (1, "a"), (2, "b")), "l0")
    for rows in ([(2, "x")], [(3, "x"), (3, "y")]):
        with pytest.raises(SyncError) as e:
            target.write(frame(spark, *rows), "l1")
        assert e.value.code == "DUPLICATE_KEY"
    target.write(frame(spark, (3, "c")), "l1")
    assert content(target, spark) == [(1, "a"), (2, "b"), (3, "c")]


@pytest.mark.parametrize("layout", [None, RangeSplit("k", 0, 100, 5)])
def test_upsert_merges_and_counts(spark, root, layout):
    target = ParquetTarget(root, KEYED, "upsert", ("k",), layout)
    first = target.write(frame(spark, (1, "a"), (2, "b"), (95, "z")), "l0")
    assert (first.loaded, first.affected) == (3, 3)
    second = target.write(frame(spark, (2, "B"), (3, "c"), (1, "a")), "l1")
    assert (second.loaded, second.affected) == (3, 2 + 1 + 0)
    assert content(target, spark) == [(1, "a"), (2, "B"), (3, "c"), (95, "z")]
    with pytest.raises(SyncError) as e:
        target.write(frame(spark, (5, "x"), (5, "y")), "l2")
    assert e.value.code == "DUPLICATE_KEY"
    ordered = frame(spark, (5, "x"), (5, "y"), (2, "B"))
    third = target.write(ordered, "l3", order=["v"])
    assert (third.loaded, third.affected) == (3, 1 + 2)
    assert content(target, spark) == [(1, "a"), (2, "B"), (3, "c"), (5, "y"), (95, "z")]
    assert not files.exists(spark, f"{root}/_stage/l3")


def test_layout_rewrites_only_touched_slices(spark, root):
    target = ParquetTarget(root, KEYED, "upsert", ("k",), RangeSplit("k", 0, 100, 5))
    target.write(spark.range(100).select(F.col("id").alias("k"), F.lit("old").alias("v")), "l0")
    target.write(frame(spark, (1, "new"), (150, "new")), "l1")
    assert target.commits(spark)[-1]["slices"] == [0, 4]
    rows = content(target, spark)
    assert len(rows) == 101 and [k for k, v in rows if v == "new"] == [1, 150]


def test_concurrent_upsert_is_refused(spark, root, monkeypatch):
    target = ParquetTarget(root, KEYED, "upsert", ("k",))
    target.write(frame(spark, (1, "a")), "l0")
    stale = target.commits(spark)
    target.write(frame(spark, (2, "b")), "l1")
    monkeypatch.setattr(ParquetTarget, "commits", lambda self, spark: stale)
    with pytest.raises(SyncError) as e:
        target.write(frame(spark, (3, "c")), "l2")
    assert e.value.code == "CONFLICT" and e.value.retryable


def test_rejects_ratio_and_partitions(spark, root):
    target = ParquetTarget(root, COLUMNS)
    df = frame(spark, *[(i, "bad" if i == 3 else "ok") for i in range(10)])
    rule = F.col("v") == "bad"
    with pytest.raises(SyncError) as e:
        target.write(df, "l0", reject=rule)
    assert e.value.code == "LOAD_FILTERED" and target.commits(spark) == []
    receipt = target.write(
        df, "l1", reject=rule, partition=F.col("k") % 2, partitions=[1], max_filter_ratio=0.2
    )
    assert (receipt.loaded, receipt.filtered) == (4, 6)
    assert content(target, spark) == [(1, "ok"), (5, "ok"), (7, "ok"), (9, "ok")]
    assert [tuple(r) for r in target.rejects(spark, "l1").collect()] == [(3, "bad")]
    none = target.write(df, "l2", reject=F.lit(True), max_filter_ratio=1.0)
    assert none.loaded == 0 and len(content(target, spark)) == 4


def test_batches_of_a_commit(spark, root):
    target = ParquetTarget(root, COLUMNS)
    df = spark.range(0, 1000, 1, 3).select(F.col("id").alias("k"), F.repeat(F.lit("x"), (F.col("id") % 20).cast("int")).alias("v"))
    target.write(df, "l0", limits=Limits(60, 3000))
    batches = target.batches(spark, "l0").collect()
    assert sorted(b.batch_id for b in batches) == list(range(len(batches)))
    assert sum(b["rows"] for b in batches) == 1000
    assert all(b["rows"] <= 60 and b["bytes"] <= 3000 for b in batches)
    assert row_diff(df, target.read(spark)).isEmpty()


def test_target_rules():
    for args in (
        ("r", COLUMNS, "replace"),
        ("r", COLUMNS, "append", ("k",)),
        ("r", COLUMNS, "upsert", ("k",)),
        ("r", KEYED, "upsert", ()),
        ("r", KEYED, "upsert", ("v",)),
        ("r", KEYED, "upsert", ("k",), RangeSplit("v", 0, 10, 2)),
    ):
        with pytest.raises(SyncError):
            ParquetTarget(*args)


def test_json_files_are_created_once(spark, root):
    path = f"{root}/x/1.json"
    assert files.create_json(spark, path, {"a": "é"})
    assert not files.create_json(spark, path, {"a": 2})
    assert files.read_json(spark, path) == {"a": "é"}


def test_jdbc_statements_need_no_database():
    target = JdbcTarget("jdbc:u", "db.t", "upsert", ("k",), batch_rows=50_000)
    start, note, move, commit = target.move_statements(["k", "v"], "load_1_0")
    assert (start, commit) == ("START TRANSACTION", "COMMIT")
    assert note == "INSERT INTO `_committed_labels` (label) VALUES ('load_1_0')"
    assert move == (
        "INSERT INTO `db`.`t` (`k`,`v`) SELECT MAX(`k`),MAX(`v`) FROM `db`.`t_stage_load_1_0` "
        "GROUP BY `_row_id` ORDER BY `_row_id` ON DUPLICATE KEY UPDATE `v`=VALUES(`v`)"
    )
    assert target.write_options(2)["batchsize"] == "21845"
    for args in (("u", "t", "insert", ("k",)), ("u", "t", "upsert"), ("u", "t", "merge")):
        with pytest.raises(SyncError):
            JdbcTarget(*args)


def test_hooks_run_in_order_and_stop(spark):
    seen = []
    run_hooks(spark, [lambda s: seen.append(1), "SELECT 1", lambda s: seen.append(2)])
    assert seen == [1, 2]

    def lost(s):
        raise ConnectionError("gone")

    with pytest.raises(SyncError) as e:
        run_hooks(spark, [lost, lambda s: seen.append(3)])
    assert e.value.commit_unknown and seen == [1, 2]
    with pytest.raises(SyncError) as e:
        run_hooks(spark, ["SELECT missing_column"])
    assert e.value.code == "HOOK" and not e.value.commit_unknown


def test_exact_decimal_columns_round_trip_through_files(spark, root):
    columns = (TargetColumn.sql("d", "decimal(65,5)"), TargetColumn.sql("u", "bigint unsigned"))
    target = ParquetTarget(root, columns)
    df = spark.createDataFrame([("1" * 60 + ".12345", Decimal(2**64 - 1))], target.schema())
    target.write(df, "l0")
    back = target.read(spark)
    assert [tuple(r) for r in back.collect()] == [("1" * 60 + ".12345", Decimal(2**64 - 1))]
    assert back.schema["d"].metadata["exact_decimal"] == [65, 5]


def test_catalog_appends_are_labelled(spark):
    spark.sql("DROP TABLE IF EXISTS labelled")
    spark.sql("CREATE TABLE labelled (k BIGINT NOT NULL, v STRING, _label STRING) USING parquet PARTITIONED BY (_label)")
    assert [c.name for c in table_columns(spark, "labelled")] == ["k", "v"]
    for label, rows in (("l0", [(1, "a")]), ("l1", [(2, "b")]), ("l1", [(2, "b")])):
        append_to_table(frame(spark, *rows), "labelled", label)
    assert sorted(tuple(r) for r in spark.table("labelled").collect()) == [(1, "a", "l0"), (2, "b", "l1")]
    with pytest.raises(SyncError):
        table_columns(spark, "missing_table")
    spark.sql("DROP TABLE labelled")


@pytest.mark.parametrize("count", [63, 64, 65, 200])
def test_any_number_of_commits_reads_the_same(spark, root, count):
    from exactsync.sinks import files
    from exactsync.sinks.dataset import Receipt

    target = ParquetTarget(root, KEYED, "upsert", ("k",))
    target.write(frame(spark, (1, "a")), "l0")
    path = target.commits(spark)[0]["path"]
    for i in range(1, count):
        target._commit(spark, target.commits(spark), f"l{i}", "replace", path, Receipt(i, 0, i))
    found = target.commits(spark)
    assert [(c["version"], c["label"], c["loaded"]) for c in found] == [(i, f"l{i}", i or 1) for i in range(count)]
    sums = [n for n in files.names(spark, f"{root}/_commits") if n.startswith("upto-")]
    assert len(sums) == count // 64
    assert content(target, spark) == [(1, "a")]


def test_damaged_marker_is_an_error_not_a_missing_commit(spark, root):
    target = ParquetTarget(root, COLUMNS, "append")
    target.write(frame(spark, (1, "a")), "l0")
    target.write(frame(spark, (2, "b")), "l1")
    (marker,) = Path(f"{root}/_commits").glob("*1.json")
    marker.write_text('{"version": 1, "lab')
    with pytest.raises(SyncError, match="damaged"):
        target.read(spark)


def test_a_crash_before_publishing_leaves_nothing_in_the_way(spark, root):
    target = ParquetTarget(root, KEYED, "upsert", ("k",))
    target.write(frame(spark, (1, "a")), "l0")
    Path(f"{root}/_commits/.000000000001.json.draft").write_text("")
    target.write(frame(spark, (2, "b")), "l1")
    assert content(target, spark) == [(1, "a"), (2, "b")]


@pytest.mark.parametrize(
    "other",
    [
        dict(model="append", keys=(), columns="plain"),
        dict(layout=RangeSplit("k", 0, 100, 5)),
        dict(layout=RangeSplit("k", 0, 100, 2)),
        dict(layout=None),
    ],
)
def test_the_stored_contract_holds(spark, root, other):
    first = ParquetTarget(root, KEYED, "upsert", ("k",), RangeSplit("k", 0, 100, 3))
    first.write(frame(spark, (1, "a"), (60, "b")), "l0")
    options = {"columns": KEYED, "model": "upsert", "keys": ("k",), "layout": first.layout, **other}
    if options["columns"] == "plain":
        options["columns"] = COLUMNS
    second = ParquetTarget(root, **options)
    for use in (lambda: second.read(spark), lambda: second.write(frame(spark, (2, "c")), "l1")):
        with pytest.raises(SyncError) as e:
            use()
        assert e.value.code == "SCHEMA"
    assert content(first, spark) == [(1, "a"), (60, "b")]


def test_upserts_account_for_rejects_and_partitions(spark, root):
    target = ParquetTarget(root, KEYED, "upsert", ("k",))
    rows = frame(spark, *[(i, "ab"[i % 2]) for i in range(10)])
    with pytest.raises(SyncError) as e:
        target.write(rows, "none", reject=F.col("v") == "b")
    assert e.value.code == "LOAD_FILTERED" and content(target, spark) == []
    got = target.write(
        rows, "some", reject=F.col("v") == "b", partition=F.col("k"), partitions=range(6), max_filter_ratio=0.5
    )
    assert (got.loaded, got.filtered, got.affected) == (3, 7, 3)
    assert content(target, spark) == [(0, "a"), (2, "a"), (4, "a")]
    assert sorted(r.k for r in target.rejects(spark, "some").collect()) == [1, 3, 5]
    with pytest.raises(SyncError):
        target.write(rows, "x", partitions=(1,))


def test_new_keys_of_an_upsert_take_defaults(spark, root):
    from exactsync.plans.mapping import TargetColumn

    columns = (*KEYED, TargetColumn.sql("d", "bigint", nullable=False, has_default=True, default=7))
    target = ParquetTarget(root, columns, "upsert", ("k",))
    target.write(spark.createDataFrame([(1, "a", 5)], "k bigint, v string, d bigint"), "l0")
    target.write(frame(spark, (1, "b"), (2, "c")), "l1")
    assert sorted(tuple(r) for r in target.read(spark).collect()) == [(1, "b", 5), (2, "c", 7)]
