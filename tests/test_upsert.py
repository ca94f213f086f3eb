import random
import re

import pytest
from pyspark.sql import functions as F

from exactsync.errors import SyncError
from exactsync.operators import accounting
from exactsync.operators import upsert as upsert_module
from exactsync.operators.upsert import (
    affected,
    collapse,
    duplicate_keys,
    insert_conflicts,
    last_wins,
    update_columns,
    upsert,
)
from exactsync.operators.verify import compare_checksums, generate_rows, row_diff


def model(target, incoming, updates):
    """Writing the rows one by one: key -> (a, b, c), and what each row did."""
    state = dict(target)
    effects = {}
    for key, _, a, b in incoming:
        row = {"a": a, "b": b}
        if key not in state:
            state[key] = (a, b, None)
            effects.setdefault(key, []).append(1)
            continue
        old = dict(zip("abc", state[key]))
        same = all(old[u] == row[u] for u in updates)
        state[key] = tuple(row[c] if c in updates else old[c] for c in "abc")
        effects.setdefault(key, []).append(0 if same else 2)
    return state, effects


@pytest.fixture
def frames(spark, root):
    rng = random.Random(11)
    value = lambda: rng.choice([None, 1, 2])
    target = {k: (value(), value(), 9) for k in range(0, 60)}
    incoming = [(rng.randrange(40, 90) if rng.random() > 0.3 else 7, i, value(), value()) for i in range(400)]
    t = spark.createDataFrame([(k, *v) for k, v in target.items()], "k int, a int, b int, c int")
    i = spark.createDataFrame(incoming, "k int, seq int, a int, b int").repartition(6)
    # Written tables have a size Spark can plan with.
    for name, df in (("t", t), ("i", i)):
        df.write.parquet(f"{root}/{name}")
    return target, incoming, spark.read.parquet(f"{root}/t"), spark.read.parquet(f"{root}/i")


@pytest.mark.parametrize("updates", [["a", "b"], ["b"]])
def test_upsert_is_like_one_by_one(spark, frames, updates):
    target, incoming, t, i = frames
    once = collapse(i, ["k"], ["seq"], ["k", "a", "b"], updates)
    merged = upsert(t, once, ["k"], updates, effect="e")
    assert merged._jdf.queryExecution().sparkPlan().toString().count("FileScan") == 2
    rows = {r.k: (r.a, r.b, r.c) for r in merged.collect()}
    effects = {r.k: r.e for r in merged.collect()}
    expected, _ = model(target, incoming, updates)
    assert rows == expected
    keys = {k for k, *_ in incoming}
    assert {k for k, e in effects.items() if e is not None} == keys
    assert all(effects[k] == 1 for k in keys if k not in target)


@pytest.mark.parametrize("updates", [["a", "b"], ["b"]])
def test_affected_counts_chain_repeated_keys(frames, updates):
    target, incoming, t, i = frames
    _, effects = model(target, incoming, updates)
    rows = affected(i, t, ["k"], updates, ["seq"]).collect()
    got = {r.k: (r.incoming_rows, r.new_rows, r.changed_rows, r.affected_rows) for r in rows}
    assert got == {k: (len(e), e.count(1), e.count(2), sum(e)) for k, e in effects.items()}


def test_affected_rows_of_a_task_do_not_grow_with_the_table(spark, frames, monkeypatch):
    target, incoming, t, i = frames
    monkeypatch.setattr(upsert_module, "SLICE_ROWS", 20)
    shuffles = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        counted = affected(i, t, ["k"], ["a"], ["seq"])
        got = {r.k: (r.incoming_rows, r.new_rows, r.changed_rows) for r in counted.collect()}
        plan = counted._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", shuffles)
    assert {int(n) for n in re.findall(r"(?:hash|range)partitioning\(k#.*?, (\d+)\), REPARTITION", plan)} == {len(incoming) // 20}
    _, effects = model(target, incoming, ["a"])
    assert got == {k: (len(e), e.count(1), e.count(2)) for k, e in effects.items()}


def test_identical_upsert_affects_nothing(frames):
    _, _, t, _ = frames
    same = t.withColumn("seq", F.lit(0))
    totals = affected(same, t, ["k"], ["a", "b", "c"], ["seq"]).agg(F.sum("affected_rows")).first()
    assert totals[0] == 0


def test_last_wins_limits_rows_before_the_shuffle(spark, frames):
    _, incoming, _, i = frames
    best = {k: s for k, s, *_ in incoming}
    assert {r.k: r.seq for r in last_wins(i, ["k"], ["seq"]).collect()} == best
    plan = last_wins(i, ["k"], ["seq"])._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_key_checks(spark, frames):
    _, incoming, t, i = frames
    counts = {}
    for k, *_ in incoming:
        counts[k] = counts.get(k, 0) + 1
    assert {r.k: r.n_rows for r in duplicate_keys(i, ["k"]).collect()} == {k: n for k, n in counts.items() if n > 1}
    assert insert_conflicts(i, t, ["k"]).count() == sum(k < 60 for k, *_ in incoming)


def test_update_column_rules():
    assert update_columns(["k", "a", "b"], ["k"]) == ["a", "b"]
    assert update_columns(["k", "a", "b"], ["k"], ["b"]) == ["b"]
    for columns, keys, wanted in (
        (["k"], ["k"], []),
        (["k", "a"], [], []),
        (["k", "a"], ["x"], []),
        (["k", "a"], ["k"], ["z"]),
        (["k", "a"], ["k"], ["k"]),
    ):
        with pytest.raises(SyncError):
            update_columns(columns, keys, wanted)


def test_receipt_rules():
    assert accounting.receipt(10, 10, 0, 0) == {"loaded": 10, "filtered": 0, "affected": 10}
    assert accounting.receipt(10, 7, 1, 2, 0.2) == {"loaded": 7, "filtered": 3, "affected": 7}
    with pytest.raises(SyncError) as e:
        accounting.receipt(10, 8, 1, 0, 1.0)
    assert e.value.commit_unknown
    for args in ((10, 9, 1, 0, 0.0), (10, 5, 5, 0, 0.4)):
        with pytest.raises(SyncError) as e:
            accounting.receipt(*args)
        assert not e.value.commit_unknown
    with pytest.raises(SyncError):
        accounting.check_ratio_option(1.5)


def test_row_diff_and_checksums(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "n int, s string")
    b = spark.createDataFrame([(1, "x"), (2, None), (2, None), (3, "中")], "n int, s string")
    assert {tuple(r) for r in row_diff(a, b).collect()} == {(1, "x", 1), (2, None, -1), (3, "中", -1)}
    assert row_diff(a, a).isEmpty()
    sums = {"n_sum": F.col("n"), "byte_sum": F.octet_length("s")}
    same = {r.measure: r.same for r in compare_checksums(a, b, sums).collect()}
    assert same == {"n_rows": False, "n_sum": False, "byte_sum": False}


def test_generated_rows(spark):
    rows = generate_rows(spark, 20_001, tasks=3)
    last = rows.orderBy(F.desc("id")).first()
    assert (last.id, str(last.amount), last.payload) == (20_000, "2.0000", "row-20000")


def test_verification_is_exact(spark):
    a = spark.sql("SELECT CAST(1.00001 AS DECIMAL(10,5)) AS x, 0.0D AS f")
    b = spark.sql("SELECT CAST(1.00002 AS DECIMAL(10,5)) AS x, -0.0D AS f")
    rows = {r.measure: (r.left_value, r.right_value, r.same) for r in compare_checksums(a, b, {"x": F.col("x")}).collect()}
    assert rows == {"n_rows": ("1", "1", True), "x": ("1.00001", "1.00002", False)}
    with pytest.raises(SyncError):
        compare_checksums(a, b, {"f": F.col("f")})
    found = sorted((str(r.f), r.surplus) for r in row_diff(a.select("f"), b.select("f")).collect())
    assert found == [("-0.0", -1), ("0.0", 1)]


def test_redaction_at_any_depth():
    from exactsync.functions.text import redact_json

    text = r'''{"a":[{"pass\u0077ord" : {"x":{"y":["S3CRET"]}}, "b":1}], "password":["S3CRET",{"z":"}"}],"c":"password", "password":"q\"S3CRET"}'''
    out = redact_json(text)
    assert "S3CRET" not in out and out.count("[REDACTED]") == 3 and '"b":1' in out and '"c":"password"' in out
    assert redact_json('{"password": {"open": "S3CRET') == '{"password":"[REDACTED]"'
    assert redact_json(None) is None and redact_json("no json") == "no json"
