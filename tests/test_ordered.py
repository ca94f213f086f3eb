"""The parallel cut of one ordered stream against the row-by-row model."""

import random

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from exactsync.functions.sizes import row_bytes
from exactsync.operators import ordered
from exactsync.operators.batching import BATCH, LANE, Limits, batch_summary, with_batches
from tests.test_batching import greedy


def stream(spark, lengths, parts=5):
    rows = [(n, "x" * length, f"k{n % 7}") for n, length in enumerate(lengths)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "id long, s string, k string").repartition(parts)


def sizes_of(lengths):
    return [32 + 16 + length + 16 + 2 for length in lengths]


_DRAWN = random.Random(7)
LENGTHS = [_DRAWN.choice([0, 5, 60, 300, 301]) for _ in range(700)]


@pytest.mark.parametrize("parts", [1, 4, 13])
@pytest.mark.parametrize(
    "limits",
    [Limits(7, 10**9), Limits(10**9, 900), Limits(5, 400), Limits(1, 1), Limits(200, 10**9), Limits(10**6, 60_000), Limits(10**6, 10**9), Limits(3, 366)],
)
def test_cut_is_the_sequential_one(spark, limits, parts):
    cut = ordered.with_ordered_batches(stream(spark, LENGTHS), limits, ["id"], keep=["id"], parts=parts)
    assert cut.columns == ["id", LANE, BATCH]
    got = {r.id: r[BATCH] for r in cut.collect()}
    assert [got[n] for n in range(len(LENGTHS))] == greedy(sizes_of(LENGTHS), limits)


def test_whole_rows_come_back_in_order(spark):
    df = stream(spark, LENGTHS[:50])
    cut = ordered.with_ordered_batches(df, Limits(9, 1000), ["k", "id"])
    assert sorted(map(tuple, cut.select(*df.columns).collect())) == sorted(map(tuple, df.collect()))
    rows = sorted(cut.collect(), key=lambda r: (r.k, r.id))
    assert [r[BATCH] for r in rows] == greedy([32 + 16 + len(r.s) + 16 + 2 for r in rows], Limits(9, 1000))


def test_one_and_no_rows(spark):
    for lengths in ([], [10**4]):
        cut = ordered.with_ordered_batches(stream(spark, lengths), Limits(3, 100), ["id"])
        assert [r[BATCH] for r in cut.collect()] == [0] * len(lengths)


def test_batches_are_cut_again_by_a_writer(spark):
    df = stream(spark, LENGTHS)
    read = ordered.with_ordered_batches(df, Limits(50, 10**9), ["id"]).withColumnRenamed(BATCH, "handed").drop(LANE)
    cut = with_batches(read.select("id", "s", "k", "handed"), Limits(20, 10**9), lane=F.col("handed"), order=[F.col("id")])
    got = {r.id: (r.handed, r[BATCH]) for r in cut.collect()}
    assert [got[n] for n in range(len(LENGTHS))] == [(n // 50, n % 50 // 20) for n in range(len(LENGTHS))]


def test_summaries_and_the_row_guard(spark):
    df = stream(spark, LENGTHS)
    cut = ordered.with_ordered_batches(df, Limits(20, 2000), ["id"])
    model = greedy(sizes_of(LENGTHS), Limits(20, 2000))
    rows = batch_summary(cut, row_bytes(df.schema)).collect()
    assert len(rows) == model[-1] + 1 and sum(r.rows for r in rows) == len(LENGTHS)
    with pytest.raises(PySparkException, match="ROW_TOO_LARGE"):
        ordered.with_ordered_batches(df, Limits(20, 2000), ["id"], max_row_bytes=300).collect()


def test_no_task_sees_the_whole_stream(spark):
    cut = ordered.with_ordered_batches(stream(spark, LENGTHS), Limits(20, 2000), ["id"], parts=8)
    per_task = cut.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(per_task) >= 4 and max(r["count"] for r in per_task) < len(LENGTHS) / 2


def test_jumps_of_a_part():
    rng = np.random.default_rng(4)
    for _ in range(200):
        sizes = rng.integers(1, 50, int(rng.integers(1, 60)))
        limits = Limits(int(rng.integers(1, 12)), int(rng.integers(1, 150)))
        after, sure = ordered.next_starts(ordered._totals(sizes), limits)
        last, starts = ordered.last_starts(after)
        for i in range(len(sizes)):
            model = greedy(sizes[i:].tolist(), limits)
            firsts = [i + model.index(b) for b in range(model[-1] + 1)]
            assert last[i] == firsts[-1] and starts[i] == len(firsts)
            if len(firsts) > 1:
                assert after[i] == firsts[1] and sure[i]
            elif sure[i]:
                assert after[i] == len(sizes)
