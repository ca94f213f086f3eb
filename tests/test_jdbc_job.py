"""Jobs from and to databases. A database file inside the test stands in for a server: it runs the statements the library builds,
with the three words of the dialect that it spells otherwise replaced. Spark's own JDBC connections are never opened."""

import re
import sqlite3
from dataclasses import dataclass

import pytest

from exactsync import ParquetTarget, RangeSplit, Source, SyncError, SyncJob, TargetColumn
from exactsync.ledger.store import Ledger
from exactsync.sinks.jdbc import JdbcTarget
from exactsync.sources.jdbc import JdbcSource

TYPES = {"id": "bigint", "k": "bigint", "v": "string", "n": "int", "part": "bigint", "label": "string"}
LABELS = "CREATE TABLE _committed_labels (label TEXT PRIMARY KEY, loaded INT, filtered INT, affected INT, bytes INT)"
COLUMNS = (TargetColumn.sql("k", "bigint", nullable=False), TargetColumn.sql("v", "varchar(20)"))
KEYED = (TargetColumn.sql("k", "bigint", nullable=False, key=True), TargetColumn.sql("v", "varchar(20)"), TargetColumn.sql("n", "int"))


def rows_of(spark, path, relation):
    with sqlite3.connect(path) as db:
        found = db.execute(f"SELECT * FROM {relation}")
        names = [d[0] for d in found.description]
        schema = ", ".join(f"`{n}` {TYPES.get(n, 'bigint')}" for n in names)
        return spark.createDataFrame(found.fetchall(), schema)


def run_statements(path, statements):
    db = sqlite3.connect(path, isolation_level=None)
    try:
        for text in statements:
            text = text.replace("START TRANSACTION", "BEGIN").replace("ROW_COUNT()", "changes()")
            text = re.sub(r"ON DUPLICATE KEY UPDATE (.*)", lambda m: "ON CONFLICT(k) DO UPDATE SET " + re.sub(r"VALUES\((`\w+`)\)", r"excluded.\1", m[1]), text)
            db.execute(text)
    finally:
        db.close()  # an open transaction is rolled back


@dataclass(frozen=True)
class FileSource(JdbcSource):
    def load(self, spark, relation, predicates=None):
        self.reader_options()
        parts = [rows_of(spark, self.url, relation if p is None else f"{relation} WHERE {p}") for p in predicates or [None]]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out


@dataclass(frozen=True)
class FileTarget(JdbcTarget):
    def load(self, spark, relation):
        return rows_of(spark, self.url, relation)

    def store(self, rows, table):
        with sqlite3.connect(self.url) as db:
            db.execute(f"DROP TABLE IF EXISTS `{table}`")
            db.execute(f"CREATE TABLE `{table}` ({', '.join(f'`{c}`' for c in rows.columns)})")
            marks = ",".join("?" * len(rows.columns))
            # Every row is staged twice, as a task that is run again would do.
            db.executemany(f"INSERT INTO `{table}` VALUES ({marks})", [tuple(r) for r in rows.collect()] * 2)


@pytest.fixture
def database(tmp_path):
    path = str(tmp_path / "file.db")
    with sqlite3.connect(path) as db:
        db.execute(LABELS)
        db.execute("CREATE TABLE plain (k INT, v TEXT)")
        db.execute("CREATE TABLE keyed (k INT PRIMARY KEY, v TEXT, n INT)")
        db.execute("CREATE TABLE orders (id INT, v TEXT, part INT)")
        db.executemany("INSERT INTO orders VALUES (?,?,?)", [(i, f"v{i}", None if i % 7 == 0 else i) for i in range(40)])
    return path


@pytest.fixture
def ledger(spark, tmp_path):
    return Ledger(spark, str(tmp_path / "ledger"))


def stored(path, table):
    with sqlite3.connect(path) as db:
        return sorted(db.execute(f"SELECT * FROM {table}"))


def target(path, **options):
    return FileTarget(path, options.pop("table", "plain"), columns=options.pop("columns", COLUMNS), execute=lambda s: run_statements(path, s), **options)


MAPPING = (("id", "k"), ("v", "v"))


@pytest.mark.parametrize("single", [False, True])
def test_slices_of_a_database_are_groups(spark, root, ledger, database, single):
    columns = ("id", "v", "part") if single else ("id", "v")
    source = FileSource(database, table="orders", columns=columns, where="id >= 3", split=RangeSplit("part", 0, 40, 4))
    mapping = (*MAPPING, ("part", "part")) if single else MAPPING
    kinds = (*COLUMNS, TargetColumn.sql("part", "bigint")) if single else COLUMNS
    files = ParquetTarget(root, kinds)
    done = SyncJob(source, files, mapping, single_scan=single).run(spark, ledger)
    assert (done["state"], done["rows_read"]) == ("SUCCEEDED", 37)
    assert sorted(r.k for r in files.read(spark).collect()) == list(range(3, 40))
    assert len(files.commits(spark)) == 4


def test_slice_statements():
    seen = []

    class Seen(JdbcSource):
        def load(self, spark, relation, predicates=None):
            seen.append((relation, predicates))
            from pyspark.sql import SparkSession

            return SparkSession.getActiveSession().createDataFrame([], "id bigint, part bigint")

    Seen("u", table="t", columns=("id",), where="a OR b", split=RangeSplit("part", 0, 20, 2)).slices(None)
    assert [r for r, _ in seen[1:]] == [
        "(SELECT `id` FROM `t` WHERE ((a OR b) AND (`part` < 10 OR `part` IS NULL))) source_query",
        "(SELECT `id` FROM `t` WHERE ((a OR b) AND (`part` >= 10))) source_query",
    ]
    with pytest.raises(SyncError):
        Seen("u", query="SELECT 1").frame(None, rows=None)
    assert JdbcSource("u", table="t", types={"a b": "decimal(20,0)"}).reader_options()["customSchema"] == "`a b` decimal(20,0)"


@pytest.mark.parametrize("single", [False, True])
def test_insert_groups_into_a_database(spark, tmp_path, ledger, database, single):
    path = str(tmp_path / "in")
    spark.range(100).selectExpr("id", "if(id % 9 = 0, null, concat('v', id)) AS v").write.parquet(path)
    source = Source(path=path, split=RangeSplit("id", 0, 100, 3))
    from pyspark.sql import functions as F

    job = SyncJob(source, target(database), MAPPING, single_scan=single, reject=F.col("k") % 50 == 7, max_filter_ratio=0.1)
    done = job.run(spark, ledger)
    assert done["state"] == "SUCCEEDED", done
    want = [(i, None if i % 9 == 0 else f"v{i}") for i in range(100) if i % 50 != 7]
    assert stored(database, "plain") == want
    labels = stored(database, "_committed_labels")
    assert len(labels) == 3 and sum(r[1] for r in labels) == 98 and sum(r[2] for r in labels) == 2 and sum(r[3] for r in labels) == 98
    # A repeated group changes nothing and gives its first receipt.
    again = target(database).write(spark.createDataFrame([(1, "x")], "k bigint, v string"), labels[0][0])
    assert again.replayed and (again.loaded, again.filtered) == labels[0][1:3] and stored(database, "plain") == want
    states = target(database).labels(spark, ["never_seen"]).collect()
    assert sorted(r.label_state for r in states) == ["ABORTED"] + ["VISIBLE"] * 3


def test_upsert_meets_rows_in_order(spark, tmp_path, ledger, database):
    path = str(tmp_path / "in")
    rows = [(1, "old", 1), (1, "new", 2), (2, "only", 5), (3, "late", 9), (3, "early", 4)]
    spark.createDataFrame(rows, "k int, v string, n int").repartition(3).write.parquet(path)
    run_statements(database, ["INSERT INTO keyed VALUES (2,'was',0),(4,'stays',0)"])
    to = target(database, table="keyed", columns=KEYED, model="upsert", keys=("k",))
    job = SyncJob(Source(path=path), to, (("k", "k"), ("v", "v"), ("n", "n")), order=("n",))
    assert job.run(spark, ledger)["state"] == "SUCCEEDED"
    assert stored(database, "keyed") == [(1, "new", 2), (2, "only", 5), (3, "late", 9), (4, "stays", 0)]


@pytest.mark.parametrize("lost", ["reply", "request", "clash"])
def test_lost_replies_are_settled_by_the_label(spark, tmp_path, ledger, database, lost):
    path = str(tmp_path / "in")
    spark.range(5).selectExpr("id AS k", "'x' AS v", "1 AS n").write.parquet(path)
    if lost == "clash":
        run_statements(database, ["INSERT INTO keyed VALUES (2,'was',0)"])

    def execute(statements):
        if lost != "request":
            run_statements(database, statements)
        if lost != "clash":
            raise ConnectionError("gone")

    to = FileTarget(database, "keyed", columns=KEYED, execute=execute)
    done = SyncJob(Source(path=path), to, (("k", "k"), ("v", "v"), ("n", "n"))).run(spark, ledger)
    assert done["state"] == ("SUCCEEDED" if lost == "reply" else "FAILED")
    assert len(stored(database, "keyed")) == {"reply": 5, "request": 0, "clash": 1}[lost]
    assert len(stored(database, "_committed_labels")) == (lost == "reply")


def test_contract(spark, database):
    with pytest.raises(SyncError):
        JdbcTarget(database, "plain").check_contract(spark)
    with pytest.raises(SyncError):
        target(database, columns=KEYED).check_contract(spark)
    target(database).check_contract(spark)
