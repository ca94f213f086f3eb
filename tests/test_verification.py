"""Checksum trees, slices of equal depth and pinned files."""

import glob
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from exactsync import ParquetTarget, RangeSplit, Source, SyncError, SyncJob, TargetColumn
from exactsync.ledger.store import Ledger
from exactsync.operators import checktree
from exactsync.operators.verify import row_diff
from exactsync.sources.split import BalancedSplit

# -- checksum tree -------------------------------------------------------------------------


def table(spark, rows):
    return spark.createDataFrame(rows, "k long, s string, x double").repartition(3)


def base_rows():
    rng = random.Random(1)
    rows = [(n * 3 - 500, rng.choice(["a", "", None]), rng.choice([0.0, 1.5, float("nan"), None])) for n in range(2000)]
    return [*rows, (None, "n", 1.0), (None, "n", 1.0), rows[7], rows[7]]


CHANGES = {
    "none": lambda rows: rows,
    "value": lambda rows: [(k, "changed", x) if k == 1000 else (k, s, x) for k, s, x in rows],
    "zero": lambda rows: [(k, s, -0.0) if k in (-500, 4000) else (k, s, x) for k, s, x in rows],
    "repeat": lambda rows: [*rows, rows[11]],
    "null key": lambda rows: [*rows, (None, "m", None)],
    "empty and null": lambda rows: [(k, {"": None, None: ""}.get(s, s), x) if k == 2500 else (k, s, x) for k, s, x in rows],
    "outside": lambda rows: [*rows, (10**12, "far", 1.0), (-(10**12), "far", 1.0)],
    "all": lambda rows: [(k, "z", x) for k, s, x in rows],
    "nothing": lambda rows: [],
}


@pytest.mark.parametrize("change", CHANGES)
@pytest.mark.parametrize("options", [{}, {"fanout": 4, "leaf_rows": 10, "most": 30}])
def test_ranges_give_the_rows_of_the_difference(spark, change, options):
    left, right = table(spark, base_rows()), table(spark, CHANGES[change](base_rows()))
    got = sorted(map(str, checktree.range_diff(left, right, "k", **options).collect()))
    assert got == sorted(map(str, row_diff(left, right).collect()))
    assert sorted(map(str, checktree.range_diff(right, left, "k", **options).collect())) == sorted(map(str, row_diff(right, left).collect()))


def test_only_differing_ranges_are_read(spark, root):
    rows = spark.range(100_000).select(F.col("id").alias("k"), F.lit("a").alias("s"))
    rows.repartitionByRange(10, "k").write.parquet(f"{root}/a")
    rows.withColumn("s", F.when(F.col("k") == 73_211, "b").otherwise(F.col("s"))).write.parquet(f"{root}/b")
    left, right = (spark.read.parquet(f"{root}/{n}") for n in "ab")
    ranges = checktree.differing_ranges(left, right, "k", leaf_rows=100)
    assert len(ranges) == 1 and ranges[0].low <= 73_211 < ranges[0].high and ranges[0].high - ranges[0].low <= 100
    diff = checktree.range_diff(left, right, "k", leaf_rows=100)
    assert sorted(tuple(r) for r in diff.collect()) == [(73_211, "a", 1), (73_211, "b", -1)]
    plan = diff._jdf.queryExecution().executedPlan().toString()
    assert plan.count(f"GreaterThanOrEqual(k,{ranges[0].low})") == plan.count(f"LessThan(k,{ranges[0].high})") >= 2
    assert plan.count("FileScan") == plan.count("LessThan(k,")


def test_the_tree_needs_one_schema_and_a_whole_key(spark):
    left = table(spark, base_rows()[:5])
    with pytest.raises(SyncError):
        checktree.range_diff(left, left.drop("x"), "k")
    with pytest.raises(SyncError):
        checktree.range_diff(left, left, "s")


# -- equal depth ---------------------------------------------------------------------------


def depths(df, split):
    marked = df.select(split.slice_id().alias("slice"), *[F.expr(p).alias(f"p{n}") for n, p in enumerate(split.predicates())])
    found = {}
    for r in marked.collect():
        assert [n for n in range(split.slices) if r[f"p{n}"]] == [r["slice"]]
        found[r["slice"]] = found.get(r["slice"], 0) + 1
    return [found.get(n, 0) for n in range(split.slices)]


@pytest.mark.parametrize("kind", ["bigint", "int", "decimal(20,0)"])
def test_slices_are_about_equally_deep(spark, kind):
    rng = random.Random(2)
    keys = [int(rng.paretovariate(0.3)) % 2_000_000_000 for _ in range(6000)] + [5_000] * 3000 + [None] * 10
    df = spark.createDataFrame([(k,) for k in keys], "k long").select(F.col("k").cast(kind).alias("k"))
    split = BalancedSplit.over(df, "k", 10)
    found = depths(df, split)
    heavy = [keys.count(k) for k in set(keys)]
    largest = sorted(heavy)[-2]  # light keys
    assert sum(found) == len(keys)
    light = [n for n in found if n < 3000]
    assert max(light) <= max(largest + sum(light) / len(light) * 0.2, 1.2 * sum(light) / len(light))
    assert sum(n >= 3000 for n in found) == 1


def test_even_keys_are_cut_within_a_tenth(spark):
    df = spark.range(50_000).select((F.col("id") * F.col("id")).alias("k"))
    found = depths(df, BalancedSplit.over(df, "k", 16))
    assert len(found) == 16 and max(found) <= 1.1 * 50_000 / 16


def test_few_and_no_values(spark):
    for values in ([], [None], [3], [3, 3, 3], [1, 2], [-(2**63), 2**63 - 1]):
        df = spark.createDataFrame([(v,) for v in values], "k long")
        split = BalancedSplit.over(df, "k", 4)
        assert sum(depths(df, split)) == len(values)
    with pytest.raises(SyncError):
        BalancedSplit("k", 0, 10, 3, (5, 5))


def test_a_job_takes_a_balanced_split(spark, root):
    df = spark.range(1000).select((F.col("id") * F.col("id")).alias("id"))
    df.write.parquet(f"{root}/s")
    split = BalancedSplit.over(df, "id", 5)
    target = ParquetTarget(f"{root}/t", (TargetColumn.sql("id", "bigint"),))
    ledger = Ledger(spark, f"{root}/ledger")
    run = SyncJob(Source(path=f"{root}/s", split=split), target, single_scan=True).run(spark, ledger)
    batches = ledger.run_batches(run["run_id"]).collect()
    assert run["rows_committed"] == 1000 and len(batches) == 5 and max(b["loaded"] for b in batches) <= 220


# -- pinned files --------------------------------------------------------------------------


def folder(spark, root):
    path = f"{root}/s"
    spark.range(100).select("id").repartitionByRange(4, "id").write.parquet(path)
    return path


class Meddling(ParquetTarget):
    """Changes the source folder right after the second group became visible."""

    def _commit(self, spark, commits, label, *rest):
        super()._commit(spark, commits, label, *rest)
        if label.endswith("_1"):
            HOOK[0](spark)


HOOK = [None]


def run(spark, root, path, hook, **options):
    HOOK[0] = hook
    target = Meddling(f"{root}/t", (TargetColumn.sql("id", "bigint"),))
    job = SyncJob(Source(path=path, split=RangeSplit("id", 0, 100, 4), **options), target)
    ledger = Ledger(spark, f"{root}/ledger")
    done = job.run(spark, ledger)
    return done, target, ledger


def test_files_that_come_later_belong_to_no_group(spark, root):
    path = folder(spark, root)
    more = lambda s: s.range(1000).select("id").write.mode("append").parquet(path)
    done, target, _ = run(spark, root, path, more, pin=True)
    assert done["state"] == "SUCCEEDED" and done["rows_committed"] == 100
    assert sorted(r.id for r in target.read(spark).collect()) == list(range(100))


@pytest.mark.parametrize("change", ["replace", "remove"])
def test_no_group_is_committed_from_a_file_that_changed(spark, root, change):
    path = folder(spark, root)

    def meddle(s):
        file = sorted(glob.glob(f"{path}/*.parquet"))[-1]
        s.range(70, 100).select((F.col("id") + 0).alias("id")).coalesce(1).write.parquet(f"{root}/other")
        if change == "replace":
            os.replace(glob.glob(f"{root}/other/*.parquet")[0], file)
        else:
            os.remove(file)
        s.catalog.refreshByPath(path)

    done, target, ledger = run(spark, root, path, meddle, pin=True)
    error = json.loads(done["error"])
    assert done["state"] == "FAILED" and not done["commit_unknown"] and done["rows_committed"] == 50
    assert error["code"] in ("SOURCE_CHANGED", "SPARK")
    assert {b["batch_id"]: b["state"] for b in ledger.run_batches(done["run_id"]).collect()} == {0: "CONFIRMED", 1: "CONFIRMED"}
    assert sorted(r.id for r in target.read(spark).collect()) == list(range(50))


def test_only_paths_are_pinned_and_partitions_stay(spark, root):
    with pytest.raises(SyncError):
        Source(table="t", pin=True).check()
    spark.range(10).select("id", (F.col("id") % 2).alias("part")).write.partitionBy("part").parquet(f"{root}/p")
    pinned = Source(path=f"{root}/p", pin=True, where="part = 1").pinned(spark)
    assert sorted(map(tuple, pinned.frame(spark).collect())) == [(n, 1) for n in range(1, 10, 2)]
    spark.range(0).select("id").write.parquet(f"{root}/e")
    assert Source(path=f"{root}/e", pin=True).pinned(spark).frame(spark).columns == ["id"]


# -- nanoseconds ---------------------------------------------------------------------------


def nanos_file(root, values):
    import pyarrow as pa
    import pyarrow.parquet as pq

    os.makedirs(f"{root}/n")
    pq.write_table(pa.table({"id": list(range(len(values))), "at": pa.array(values, pa.timestamp("ns"))}), f"{root}/n/a.parquet", version="2.6")
    return f"{root}/n"


def test_nanoseconds_become_exact_microseconds(spark, root):
    from datetime import datetime, timedelta

    values = [0, 1_000, -1_000, None, 1_700_000_000_123_456_000]
    path = nanos_file(root, values)
    for pin in (False, True):
        source = Source(path=path, nanos={"at": "wall"}, pin=pin)
        rows = (source.pinned(spark) if pin else source).frame(spark).orderBy("id").collect()
        assert [r["at"] for r in rows] == [None if v is None else datetime(1970, 1, 1) + timedelta(microseconds=v // 1000) for v in values]
    assert Source(path=path, nanos={"at": "instant"}).frame(spark).schema["at"].dataType.simpleString() == "timestamp"


def test_a_part_of_a_microsecond_fails_the_job(spark, root):
    path = nanos_file(root, [1_000, 1_001])
    job = SyncJob(Source(path=path, nanos={"at": "wall"}), ParquetTarget(f"{root}/t", (TargetColumn.sql("id", "bigint"), TargetColumn.sql("at", "datetime(6)"))))
    run = job.run(spark, Ledger(spark, f"{root}/ledger"))
    error = json.loads(run["error"])
    assert error["code"] == "TYPE" and "1001 ns" in error["message"] and run["rows_committed"] == 0
    plain = SyncJob(Source(path=path), job.target)
    assert json.loads(plain.run(spark, Ledger(spark, f"{root}/l2"))["error"])["code"] == "TYPE"
    with pytest.raises(SyncError):
        Source(path=path, nanos={"id": "date"}).check()


# -- partitions of a catalog table ---------------------------------------------------------


def test_only_listed_partitions_are_replaced(spark):
    from exactsync.sinks.catalog import overwrite_partitions

    spark.sql("DROP TABLE IF EXISTS listed")
    spark.sql("CREATE TABLE listed (k BIGINT, v STRING, p STRING) USING parquet PARTITIONED BY (p)")
    spark.createDataFrame([(n, "old", f"p'{n % 4}") for n in range(8)], "k long, v string, p string").write.insertInto("listed")
    rows = spark.createDataFrame([(n, "new", f"p'{n % 3}") for n in range(9)] + [(9, "new", None)], "k long, v string, p string")
    for _ in range(2):
        done = overwrite_partitions(rows, "listed", "p", ["p'1", "p'3"], reject=F.col("k") == 4, max_filter_ratio=0.5)
        assert (done.loaded, done.filtered, done.affected) == (2, 8, 2)
        got = sorted(map(tuple, spark.table("listed").collect()))
        assert got == [(0, "old", "p'0"), (1, "new", "p'1"), (2, "old", "p'2"), (4, "old", "p'0"), (6, "old", "p'2"), (7, "new", "p'1")]
    with pytest.raises(SyncError) as e:
        overwrite_partitions(rows, "listed", "p", ["p'0"], reject=F.lit(True))
    assert e.value.code == "LOAD_FILTERED" and spark.table("listed").count() == 6
    with pytest.raises(SyncError):
        overwrite_partitions(rows, "listed", "p", [])
    spark.sql("DROP TABLE listed")
