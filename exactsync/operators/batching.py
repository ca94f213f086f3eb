"""Greedy batch cutting by rows and bytes, in parallel over lanes.

A lane is what one reader delivers in order: a Spark partition, or the rows that share a lane
column. A batch never crosses lanes. Only row sizes travel to Python (8 bytes a row, Arrow);
the rows themselves stay in the JVM. If every row has the same size the cut is plain
arithmetic and needs no Python at all.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from exactsync.errors import SyncError
from exactsync.functions.sizes import fixed_row_bytes, guard_row_bytes, row_bytes
from exactsync.types import of_field

# Default batch limits, largest row, statement parameters and packet reserve.
DEFAULT_ROWS = 10_000
DEFAULT_BYTES = 16 * 1024 * 1024
DEFAULT_MAX_ROW_BYTES = 24 * 1024 * 1024
MAX_STATEMENT_PARAMETERS = 65_535
PACKET_RESERVE = 1024
BIND_OVERHEAD = 4

LANE, BATCH = "_lane", "_batch"
SIZE, READ_SIZE = "_size", "_read_size"
# Lane numbers to a block of the running total.
_BLOCK = 4096


@dataclass(frozen=True)
class Limits:
    rows: int = DEFAULT_ROWS
    bytes: int = DEFAULT_BYTES

    def __post_init__(self):
        if self.rows < 1 or self.bytes < 1:
            raise SyncError.config("Batch limits must be positive")


class _Cutter:
    """Open batch of one lane, carried from one Arrow batch to the next."""

    def __init__(self, limits: Limits):
        self.limits = limits
        self.rows = self.bytes = self.number = 0

    def restart(self) -> None:
        self.rows = self.bytes = self.number = 0

    def close(self) -> None:
        self.rows = self.bytes = 0
        self.number += 1

    def cut(self, sizes: np.ndarray, out: np.ndarray) -> None:
        """Batch numbers for the next rows of the lane: one search per batch, not per row."""
        total = np.cumsum(sizes)
        at = 0
        while at < len(sizes):
            before = total[at - 1] if at else 0
            by_bytes = int(np.searchsorted(total, before + self.limits.bytes - self.bytes, side="right"))
            end = min(len(sizes), at + self.limits.rows - self.rows, by_bytes)
            if end <= at:
                if self.rows:
                    self.close()
                    continue
                end = at + 1  # larger than a whole batch: stands alone
            out[at:end] = self.number
            self.rows += end - at
            self.bytes += int(total[end - 1] - before)
            at = end
            if at < len(sizes):
                self.close()


def _edges(*keys: np.ndarray) -> np.ndarray:
    """Start positions of runs of equal keys."""
    change = np.zeros(len(keys[0]), dtype=bool)
    change[0] = True
    for key in keys:
        change[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(change)


def _runs(cutter: _Cutter, sizes: np.ndarray, starts: np.ndarray, fresh: bool, keep_number: bool) -> np.ndarray:
    out = np.empty(len(sizes), dtype=np.int32)
    stops = np.append(starts[1:], len(sizes))
    for i, (a, b) in enumerate(zip(starts, stops)):
        if i or fresh:
            cutter.close() if keep_number else cutter.restart()
        cutter.cut(sizes[a:b], out[a:b])
    return out


def greedy_batches(limits: Limits, reader_limits: Limits | None = None):
    """Stateful Arrow UDF ``(lane, writer_size[, reader_size]) -> batch number in the lane``.

    With reader limits the rows are first cut the way the reader hands them over, and the
    writer's batches never span two reader batches.
    """

    def run(chunks) -> Iterator[pd.Series]:
        writer, reader = _Cutter(limits), _Cutter(reader_limits) if reader_limits else None
        lane = read = None
        for chunk in chunks:
            lanes = chunk[0].to_numpy()
            if not len(lanes):
                yield pd.Series([], dtype="int32")
                continue
            starts = _edges(lanes)
            new_lane = lane is None or lanes[0] != lane
            sizes = chunk[1].to_numpy()
            if reader is None:
                out = _runs(writer, sizes, starts, new_lane, keep_number=False)
            else:
                handed = _runs(reader, chunk[2].to_numpy(), starts, new_lane, keep_number=False)
                out = np.empty(len(sizes), dtype=np.int32)
                stops = np.append(starts[1:], len(sizes))
                for i, (a, b) in enumerate(zip(starts, stops)):
                    fresh_lane = bool(i) or new_lane
                    if fresh_lane:
                        writer.restart()
                    fresh_read = not fresh_lane and handed[a] != read
                    out[a:b] = _runs(writer, sizes[a:b], _edges(handed[a:b]), fresh_read, keep_number=True)
                    read = handed[b - 1]
            lane = lanes[-1]
            yield pd.Series(out)

    if reader_limits is None:

        def cut(chunks: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
            return run(chunks)

        hint = Iterator[tuple[pd.Series, pd.Series]]
    else:

        def cut(chunks: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
            return run(chunks)

        hint = Iterator[tuple[pd.Series, pd.Series, pd.Series]]
    cut.__annotations__ = {"chunks": hint, "return": Iterator[pd.Series]}
    return F.pandas_udf(cut, T.IntegerType()).asNondeterministic()


def with_batches(
    df: DataFrame,
    limits: Limits,
    *,
    lane: Column | None = None,
    order: Sequence[Column] = (),
    reader_limits: Limits | None = None,
    max_row_bytes: int | None = None,
) -> DataFrame:
    """Add ``_lane`` and ``_batch`` (0, 1, ... within the lane).

    Without ``lane`` each Spark partition is a lane and nothing is shuffled. A lane column
    costs one shuffle by it and should be fine-grained: see :func:`salted_lane`.
    """
    schema = df.schema
    size = row_bytes(schema)
    if max_row_bytes is not None:
        size = guard_row_bytes(size, max_row_bytes)
    sizes = {SIZE: size}
    if reader_limits is not None:
        sizes[READ_SIZE] = row_bytes(schema, side="reader")
    if lane is None:
        flat = fixed_row_bytes(schema)
        even = reader_limits is None or not any(of_field(f).kind in ("decimal", "digits") for f in schema.fields)
        if flat is not None and even and not order and (max_row_bytes is None or flat <= max_row_bytes):
            return _arithmetic_batches(df, flat, limits, reader_limits)
        laned = df.withColumns({LANE: F.spark_partition_id().cast("bigint"), **sizes})
        if order:
            laned = laned.sortWithinPartitions(*order)
    else:
        # Sizes are taken before the shuffle, so text nobody reads later is not moved.
        laned = df.withColumns({LANE: lane.cast("bigint"), **sizes})
        laned = laned.repartition(LANE).sortWithinPartitions(LANE, *order)
    cut = greedy_batches(limits, reader_limits)(*[F.col(c) for c in (LANE, *sizes)])
    return laned.withColumn(BATCH, cut).drop(*sizes)


def _arithmetic_batches(df: DataFrame, flat: int, limits: Limits, reader_limits: Limits | None) -> DataFrame:
    # The low 33 bits of Spark's row id count the rows of the partition.
    index = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    per_batch = max(1, min(limits.rows, limits.bytes // flat))
    if reader_limits is None:
        number = F.call_function("div", index, F.lit(per_batch).cast("bigint"))
    else:
        handed = max(1, min(reader_limits.rows, reader_limits.bytes // flat))
        pieces = -(-handed // per_batch)
        number = F.call_function("div", index, F.lit(handed).cast("bigint")) * pieces + F.call_function(
            "div", index % handed, F.lit(per_batch).cast("bigint")
        )
    return df.withColumn(LANE, F.spark_partition_id().cast("bigint")).withColumn(BATCH, number.cast("int"))


def salted_lane(slice_id: Column, key: Column, salts: int) -> Column:
    """Lane number that spreads each slice, however full, over ``salts`` lanes by its key."""
    return slice_id.cast("bigint") * salts + F.pmod(key, F.lit(salts))


def batch_summary(batched: DataFrame, size: Column) -> DataFrame:
    """Rows and bytes per batch; partial sums before the shuffle."""
    return batched.groupBy(LANE, BATCH).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(size).cast("bigint").alias("bytes")
    )


def number_batches(summary: DataFrame) -> DataFrame:
    """Add ``batch_id``, unique over the run and counting from 0.

    Works on summaries in two steps: a running total over blocks of lanes, and one inside each block. The
    one unpartitioned window sees a row per block of 4096 lane numbers, never lanes or batches.
    """
    per_lane = summary.groupBy(LANE).agg((F.max(BATCH) + 1).cast("bigint").alias("_n"))
    per_lane = per_lane.withColumn("_block", F.call_function("div", F.col(LANE), F.lit(_BLOCK).cast("bigint")))
    above = lambda w: F.coalesce(F.sum("_n").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    blocks = per_lane.groupBy("_block").agg(F.sum("_n").alias("_n"))
    blocks = blocks.select("_block", above(W.orderBy("_block")).alias("_start"))
    inside = per_lane.withColumn("_inside", above(W.partitionBy("_block").orderBy(LANE)))
    first = inside.join(blocks, "_block").select(LANE, (F.col("_start") + F.col("_inside")).alias("_first"))
    return summary.join(first, LANE).withColumn("batch_id", F.col("_first") + F.col(BATCH)).drop("_first")


def statement_limits(columns: int, packet_bytes: int) -> Limits:
    """How much of a batch one multi-row statement may carry."""
    rows = MAX_STATEMENT_PARAMETERS // columns
    if rows == 0:
        raise SyncError.config("Too many target columns for a prepared statement")
    return Limits(rows, packet_bytes - 2 * PACKET_RESERVE)


def jdbc_batchsize(columns: int, wanted: int) -> int:
    """Rows per JDBC batch that respect the statement parameter limit."""
    return min(wanted, statement_limits(columns, DEFAULT_BYTES).rows)
