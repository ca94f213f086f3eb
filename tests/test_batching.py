import random

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from exactsync.errors import SyncError
from exactsync.functions.sizes import row_bytes
from exactsync.operators.batching import (
    BATCH,
    LANE,
    Limits,
    batch_summary,
    jdbc_batchsize,
    number_batches,
    statement_limits,
    with_batches,
)


def greedy(sizes, limits):
    """Row-by-row model of the cut."""
    out, number, rows, total = [], 0, 0, 0
    for size in sizes:
        if rows and (rows >= limits.rows or total + size > limits.bytes):
            number, rows, total = number + 1, 0, 0
        out.append(number)
        rows, total = rows + 1, total + size
    return out


def regreedy(sizes, reader_sizes, limits, reader):
    handed = greedy(reader_sizes, reader)
    out, number, rows, total, read = [], 0, 0, 0, None
    for size, h in zip(sizes, handed):
        if rows and (h != read or rows >= limits.rows or total + size > limits.bytes):
            number, rows, total = number + 1, 0, 0
        out.append(number)
        rows, total, read = rows + 1, total + size, h
    return out


@pytest.fixture
def texts(spark):
    rng = random.Random(7)
    rows = [(i, "x" * rng.choice([0, 5, 60, 300]), rng.randrange(5)) for i in range(2000)]
    return spark.createDataFrame(rows, "id int, s string, lane int").repartition(5)


@pytest.mark.parametrize("limits", [Limits(7, 10**9), Limits(10**9, 900), Limits(5, 400), Limits(1, 1), Limits(3, 350)])
@pytest.mark.parametrize("chunk", [3, 64, 10_000])
def test_cut_matches_the_model(spark, texts, limits, chunk):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", chunk)
    try:
        cut = with_batches(texts, limits, lane=F.col("lane"), order=[F.col("id")])
        rows = cut.select("id", "lane", F.length("s").alias("n"), BATCH).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for lane in range(5):
        mine = sorted((r.id, r.n, r[BATCH]) for r in rows if r.lane == lane)
        assert [b for *_, b in mine] == greedy([n + 16 + 64 for _, n, _ in mine], limits)


@pytest.mark.parametrize("chunk", [5, 10_000])
def test_recut_never_spans_reader_batches(spark, texts, chunk):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", chunk)
    limits, reader = Limits(5, 700), Limits(7, 1500)
    try:
        cut = with_batches(texts, limits, lane=F.col("lane"), order=[F.col("id")], reader_limits=reader)
        rows = cut.select("id", "lane", F.length("s").alias("n"), BATCH).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for lane in range(5):
        mine = sorted((r.id, r.n, r[BATCH]) for r in rows if r.lane == lane)
        sizes = [n + 80 for _, n, _ in mine]
        assert [b for *_, b in mine] == regreedy(sizes, sizes, limits, reader)


@pytest.mark.parametrize("limits, reader", [(Limits(4), None), (Limits(10**6, 200), None), (Limits(50), Limits(70)), (Limits(1, 1), None)])
def test_even_rows_need_no_python(spark, limits, reader):
    df = spark.range(0, 1000, 1, 3).withColumn("x", F.col("id") * 2)
    cut = with_batches(df, limits, reader_limits=reader)
    assert "Python" not in cut._jdf.queryExecution().executedPlan().toString()
    rows = cut.collect()
    for lane in range(3):
        got = [r[BATCH] for r in rows if r[LANE] == lane]
        sizes = [64] * len(got)
        expected = greedy(sizes, limits) if reader is None else regreedy(sizes, sizes, limits, reader)
        assert got == expected


def test_physical_partitions_are_lanes(spark, texts):
    cut = with_batches(texts, Limits(30, 3000))
    summary = batch_summary(cut, row_bytes(texts.schema)).collect()
    assert sum(r["rows"] for r in summary) == 2000
    assert all(r["rows"] <= 30 and (r["bytes"] <= 3000 or r["rows"] == 1) for r in summary)


def test_numbers_are_unique_and_dense(spark, texts):
    cut = with_batches(texts, Limits(30), lane=F.col("lane"), order=[F.col("id")])
    ids = [r.batch_id for r in number_batches(batch_summary(cut, row_bytes(texts.schema))).collect()]
    assert sorted(ids) == list(range(len(ids)))


def test_oversized_row_fails_or_stands_alone(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b" * 500), (3, "c")], "id int, s string").coalesce(1)
    assert [r[BATCH] for r in with_batches(df, Limits(10, 300), order=[F.col("id")]).collect()] == [0, 1, 2]
    with pytest.raises(PySparkException, match="ROW_TOO_LARGE"):
        with_batches(df, Limits(10, 300), max_row_bytes=400).collect()


def test_statement_limits():
    assert statement_limits(6, 1 << 20) == Limits(10922, (1 << 20) - 2048)
    assert jdbc_batchsize(100, 10_000) == 655
    with pytest.raises(SyncError):
        statement_limits(70_000, 1 << 20)
    with pytest.raises(SyncError):
        Limits(0)


def test_model_and_cutter_on_many_sizes():
    from exactsync.operators.batching import _Cutter

    rng = np.random.default_rng(3)
    for _ in range(50):
        sizes = rng.integers(1, 100, 200)
        limits = Limits(int(rng.integers(1, 20)), int(rng.integers(1, 400)))
        cutter, out, at = _Cutter(limits), np.empty(200, dtype=np.int32), 0
        while at < 200:
            end = min(200, at + int(rng.integers(1, 40)))
            cutter.cut(sizes[at:end], out[at:end])
            at = end
        assert out.tolist() == greedy(sizes.tolist(), limits)
