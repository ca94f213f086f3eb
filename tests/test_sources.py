from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from exactsync.errors import SyncError
from exactsync.sources.jdbc import JdbcSource
from exactsync.sources.split import RangeSplit, check_split_column
from exactsync.sources.table import Parameter, Source, number_placeholders, run_query


def test_split_predicates():
    assert RangeSplit("n", -7, 23, 3).predicates() == [
        "`n` < 3 OR `n` IS NULL",
        "`n` >= 3 AND `n` < 13",
        "`n` >= 13",
    ]
    assert RangeSplit("id", 0, 1, 1).predicates() == ["1=1"]
    assert RangeSplit("a`b", 0, 2, 2).predicates()[0] == "`a``b` < 1 OR `a``b` IS NULL"


@pytest.mark.parametrize("bounds", [(1, 1, 4), (2, 1, 4), (0, 10, 0), (0, 10, 1025), (-(2**63) - 1, 0, 2), (0, 2**64, 2)])
def test_split_bounds_are_checked(bounds):
    with pytest.raises(SyncError):
        RangeSplit("id", *bounds)


@pytest.mark.parametrize(
    "split",
    [
        RangeSplit("k", 10, 30, 4),
        RangeSplit("k", -1000, 997, 13),
        RangeSplit("k", 0, 3, 8),
        RangeSplit("k", -(2**63), 2**64 - 1, 1024),
        RangeSplit("k", 5, 6, 1),
        RangeSplit("k", 2**62, 2**63 - 1, 1000),
    ],
)
def test_slices_match_their_predicates(spark, split):
    edges = {None, -(2**63), 2**63 - 1, 0, 1}
    for cut in split.cuts()[:40] + split.cuts()[-40:]:
        edges |= {v for v in (cut - 1, cut, cut + 1) if -(2**63) <= v < 2**63}
    df = spark.createDataFrame([(v,) for v in edges], "k bigint")
    numbered = df.withColumn("slice", split.slice_id())
    predicates = split.predicates()
    hits = [F.when(F.coalesce(F.expr(p), F.lit(False)), i) for i, p in enumerate(predicates)]
    step = 200
    found = [F.array_compact(F.array(*hits[i : i + step])) for i in range(0, len(hits), step)]
    rows = numbered.select("k", "slice", F.concat(*found).alias("by_predicate")).collect()
    for r in rows:
        assert list(r.by_predicate) == [r.slice], r


def test_slices_of_unsigned_keys(spark):
    split = RangeSplit("k", 10, 30, 4)
    df = spark.createDataFrame([(Decimal(2**64 - 1),), (Decimal(14),), (Decimal(15),), (None,)], "k decimal(20,0)")
    assert [r[0] for r in df.select(split.slice_id()).collect()] == [3, 0, 1, 0]


def test_split_column_must_be_an_integer(spark):
    schema = T.StructType.fromDDL("a int, b string, c decimal(20,0), d decimal(20,2), e double")
    for good in ("a", "c"):
        check_split_column(schema, RangeSplit(good, 0, 10, 2))
    for bad in ("b", "d", "e", "missing"):
        with pytest.raises(SyncError):
            check_split_column(schema, RangeSplit(bad, 0, 10, 2))


def test_null_split_keys_and_tails_arrive(spark, root):
    rows = [(1, None), (2, -100), (3, 0), (4, 10), (5, 100), (6, 1000)]
    spark.createDataFrame(rows, "id int, part int").write.parquet(root)
    source = Source(path=root, split=RangeSplit("part", 0, 20, 4))
    frames = source.slices(spark)
    assert sorted(r.id for f in frames for r in f.collect()) == [1, 2, 3, 4, 5, 6]
    assert [f.count() for f in frames] == [3, 0, 1, 2]


def test_source_shape_is_checked(spark, root):
    for bad in (
        Source(),
        Source(path="a", query="SELECT 1"),
        Source(query="SELECT 1", columns=("a",)),
        Source(query="SELECT 1", where="a > 1"),
        Source(query="DELETE FROM t"),
        Source(query="SELECT 1", split=RangeSplit("a", 0, 10, 2)),
    ):
        with pytest.raises(SyncError):
            bad.frame(spark)


def test_projection_predicate_and_declared_types(spark, root):
    spark.createDataFrame([(1, "a"), (2, "b")], "id int, s string").write.parquet(root)
    df = Source(path=root, columns=("s",), where="id > 1", declared={"s": "string"}).frame(spark)
    assert [tuple(r) for r in df.collect()] == [("b",)]
    with pytest.raises(SyncError) as e:
        Source(path=root, declared={"id": "bigint"}).frame(spark)
    assert e.value.code == "TYPE"
    with pytest.raises(SyncError) as e:
        Source(path=root, declared={"x": "int"}).frame(spark)
    assert e.value.code == "SCHEMA"


def test_parameters_bind_in_text_order(spark):
    query = "WITH t AS (SELECT ? AS a, '?' AS q) SELECT a, q, ? AS b, /* ? */ hex(?) AS c FROM t WHERE a = ?;"
    params = [Parameter("u64", str(2**64 - 1)), Parameter("null"), Parameter("binary", "/wA="), Parameter("decimal", str(2**64 - 1))]
    assert [tuple(r) for r in run_query(spark, query, params).collect()] == [(Decimal(2**64 - 1), "?", None, "FF00")]
    row = run_query(spark, "SELECT ? AS a, ? AS b, ? AS c, ? AS d", [
        Parameter("bool", True), Parameter("f64", 0.5), Parameter("string", "it's"), Parameter("i64", "-5")]).first()
    assert tuple(row) == (1, 0.5, "it's", -5)


def test_parameter_errors(spark):
    with pytest.raises(SyncError, match="parameters"):
        run_query(spark, "SELECT ? AS a", [])
    for bad in (
        Parameter("i64", str(2**63)),
        Parameter("u64", "-1"),
        Parameter("i64", "1.5"),
        Parameter("decimal", "x"),
        Parameter("f64", "nan"),
        Parameter("binary", "***"),
        Parameter("blob", "x"),
    ):
        with pytest.raises(SyncError):
            bad.bind()


def test_placeholders_skip_quotes_and_comments():
    text, n = number_placeholders("SELECT '?', \"?\", `?`, ? -- ?\n FROM t /* ? */ WHERE x = ?")
    assert n == 2 and text.endswith("x = :p1") and ", :p0 -- ?" in text


def test_jdbc_options_need_no_database():
    source = JdbcSource(
        "jdbc:mysql://host/db",
        table="db.orders",
        columns=("id", "name"),
        where="id > 5",
        split=RangeSplit("part", 0, 20, 2),
        time_zone="+08:00",
        variables={"lock_wait_timeout": "5"},
    )
    assert source.relation() == "(SELECT `id`,`name`,`part` FROM `db`.`orders` WHERE (id > 5)) source_query"
    options = source.reader_options()
    assert options["sessionInitStatement"] == (
        "SET time_zone = '+08:00', lock_wait_timeout = '5', transaction_isolation = 'REPEATABLE-READ', "
        "transaction_read_only = 1"
    )
    assert "isolation" not in JdbcSource("u", table="t", consistency="statement").session_init()
    assert JdbcSource("u", query="SELECT 1 AS a;").relation() == "(SELECT 1 AS a) source_query"
    with pytest.raises(SyncError):
        JdbcSource("u", table="t", variables={"SQL_MODE": ""}).session_init()
    with pytest.raises(SyncError):
        JdbcSource("u", table="t", consistency="eventual").session_init()
    with pytest.raises(SyncError):
        JdbcSource("u", table="t", query="SELECT 1").relation()
