"""The greedy cut of one globally ordered stream, in parallel: the batches a single reader would hand over, without a single task.

Where a batch ends depends on where it began, so the cut looks sequential. But a batch that begins at row i always ends at the same
next row, which a binary search on prefix sums finds. The rows are put in order over range partitions ("parts"):

1. Each part composes its jumps by pointer doubling: for the rows at its head that a batch from an earlier part may end at,
   the last batch start inside the part, and how many starts there are. Chains of the greedy cut merge fast, so few lasts are left.
2. The next row after each last lies in another part; the running totals of the parts (a row per part on the driver) say in which,
   and a second binary search there finds it.
3. Jumps from part to part are doubled until those reached from the first row are known: at most one entry per part.
4. Each part cuts its own rows from its entry on.

No part meets another one's rows, whatever the limits; only positions and sizes, 8 bytes each, travel to Python.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from exactsync.functions.sizes import guard_row_bytes, row_bytes
from exactsync.functions.text import column
from exactsync.operators.batching import BATCH, LANE, Limits, _Cutter
from exactsync.session import staged

PART, POS, SIZE = "_part", "_pos", "_size"
_JUMPS = "entry long, last long, starts long, limit long, bound long, part long"
_FOUND = "last long, target long"


class _Parts:
    """Rows and bytes of the non-empty parts in order, with the totals before each."""

    def __init__(self, counted: Sequence[tuple[int, int, int]]):
        self.names = [p for p, _, _ in counted]
        rows = np.array([n for _, n, _ in counted], np.int64)
        size = np.array([b for _, _, b in counted], np.int64)
        self.row_ends, self.byte_ends = np.cumsum(rows), np.cumsum(size)
        self.rows = int(rows.sum())
        self.begin = {p: (int(r), int(b)) for p, r, b in zip(self.names, self.row_ends - rows, self.byte_ends - size, strict=True)}

    def holding(self, row: np.ndarray) -> np.ndarray:
        """Place of the part of each global row; one more than the last beyond the end."""
        return np.searchsorted(self.row_ends, row, side="right")

    def passing(self, bound: np.ndarray) -> np.ndarray:
        """Place of the part in which the running bytes first pass each bound."""
        return np.searchsorted(self.byte_ends, bound, side="right")


def next_starts(total: np.ndarray, limits: Limits) -> tuple[np.ndarray, np.ndarray]:
    """For a batch that begins at each row of a part (``total``: running bytes, 0 first) the row after it inside the part, and
    whether its end is known: not if the part ends before a byte limit is passed and a row limit is reached."""
    n = len(total) - 1
    rows = np.arange(n)
    fits = np.searchsorted(total, total[:-1] + limits.bytes, side="right") - 1
    after = np.maximum(rows + 1, np.minimum(fits, rows + limits.rows))
    return after, (fits < n) | (rows + limits.rows <= n)


def last_starts(after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The last start inside the part of the chain from each row, and the starts up to it; pointer doubling."""
    n = len(after)
    last = np.where(after < n, np.minimum(after, n - 1), np.arange(n))
    starts = (after < n).astype(np.int64)
    while True:
        further = last[last]
        if (further == last).all():
            return last, starts + 1
        starts, last = starts + starts[last], further


def _by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Whole parts of a partition sorted by part."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        parts = batch.column(PART).to_numpy()
        cuts = [0, *(np.flatnonzero(parts[1:] != parts[:-1]) + 1).tolist(), len(parts)] if len(parts) else []
        for a, b in zip(cuts, cuts[1:]):
            if held and held[0].column(PART)[0].as_py() != parts[a]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _totals(sizes: np.ndarray) -> np.ndarray:
    return np.append(0, np.cumsum(sizes, dtype=np.int64))


def _jumps(sizes: DataFrame, known: _Parts, limits: Limits) -> DataFrame:
    """For the rows that may be the first start of a part: the last one there, and where to look for the next.

    ``part`` names the part to search for the byte ``bound``; without one ``limit`` is the next start already."""

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _by_part(batches):
            rows, size = known.begin[table.column(PART)[0].as_py()]
            total = _totals(table.column(SIZE).to_numpy())
            after, sure = next_starts(total, limits)
            last, starts = last_starts(after)
            # A batch from before has one row there at least, and at most the rest of its limits here.
            heads = min(len(after), limits.rows, int(np.searchsorted(total, limits.bytes, side="right"))) if rows else 1
            entry, last, starts = np.arange(heads), last[:heads], starts[:heads]
            bound, limit = size + total[last] + limits.bytes, rows + last + limits.rows
            limit = np.where(sure[last], rows + after[last], np.minimum(limit, known.rows))
            place = known.passing(bound)
            search = ~sure[last] & (place <= known.holding(limit)) & (place < len(known.names))
            part = np.array(known.names)[np.minimum(place, len(known.names) - 1)]
            columns = [rows + entry, rows + last, starts, limit, bound]
            arrays = [pa.array(c, pa.int64()) for c in columns] + [pa.array(part, pa.int64(), mask=~search)]
            yield pa.RecordBatch.from_arrays(arrays, ["entry", "last", "starts", "limit", "bound", "part"])

    return sizes.mapInArrow(compose, _JUMPS)


def _searched(sizes: DataFrame, jumps: DataFrame, known: _Parts, parts: int) -> DataFrame:
    """The next start after each last start whose byte bound lies in another part."""
    asked = jumps.where("part IS NOT NULL").select(
        F.col("part").cast("int").alias(PART), F.lit(0).alias("kind"), F.col("last").alias("row"), "bound", "limit"
    )
    none = F.lit(None).cast("long")
    held = sizes.select(PART, F.lit(1).alias("kind"), F.col(POS).alias("row"), F.col(SIZE).alias("bound"), none.alias("limit"))
    both = held.unionByName(asked.distinct()).repartition(parts, PART).sortWithinPartitions(PART, "kind", "row")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _by_part(batches):
            rows, size = known.begin[table.column(PART)[0].as_py()]
            asked = int((table.column("kind").to_numpy() == 0).sum())
            if not asked:
                continue
            row, bound = table.column("row").to_numpy(), table.column("bound").to_numpy()
            fits = np.searchsorted(_totals(bound[asked:]), bound[:asked] - size, side="right") - 1
            target = np.minimum(rows + fits, table.column("limit").slice(0, asked).to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(row[:asked]), pa.array(target, pa.int64())], ["last", "target"])

    return both.mapInArrow(search, _FOUND)


def _reached(edges: DataFrame) -> DataFrame:
    """The entries on the chain from row 0, by doubling the jumps."""
    spark = edges.sparkSession
    reached = spark.createDataFrame([(0,)], "entry long")
    hops = edges.select("entry", "target")
    while True:
        met = reached.join(hops, "entry").select(F.col("target").alias("entry"))
        reached = staged(reached.unionByName(met).distinct(), "reached")
        ahead = hops.select(F.col("entry").alias("target"), F.col("target").alias("further"))
        hops = staged(hops.join(ahead, "target").select("entry", F.col("further").alias("target")), "hops")
        if hops.isEmpty():
            return reached


def _cut_from(entries: dict[int, tuple[int | None, int]], limits: Limits):
    """Stateful Arrow UDF ``(part, position, size) -> batch``: each part is cut from its entry on."""

    def cut(chunks: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        cutter, part, entry, before = _Cutter(limits), None, None, 0
        for parts, positions, sizes in chunks:
            out = np.empty(len(parts), np.int64)
            names, at, size = parts.to_numpy(), positions.to_numpy(), sizes.to_numpy()
            edges = [0, *(np.flatnonzero(names[1:] != names[:-1]) + 1).tolist(), len(names)] if len(names) else []
            for a, b in zip(edges, edges[1:]):
                if names[a] != part:
                    part = int(names[a])
                    entry, before = entries[part]
                    cutter.restart()
                first = b if entry is None else min(b, max(a, a + entry - int(at[a])))
                out[a:first] = before - 1
                number = np.empty(b - first, np.int32)
                if first < b:
                    cutter.cut(size[first:b], number)
                out[first:b] = before + number
            yield pd.Series(out)

    cut.__annotations__ = {
        "chunks": Iterator[tuple[pd.Series, pd.Series, pd.Series]],
        "return": Iterator[pd.Series],
    }
    return F.pandas_udf(cut, T.LongType()).asNondeterministic()


def with_ordered_batches(
    df: DataFrame,
    limits: Limits,
    order: Sequence[str],
    *,
    keep: Sequence[str] | None = None,
    parts: int | None = None,
    max_row_bytes: int | None = None,
) -> DataFrame:
    """Rows in global ``order`` with ``_batch`` (0, 1, ... over all rows) as one sequential reader would cut them, and ``_lane`` 0.

    Sizes are those of whole rows; ``keep`` names the columns that are wanted afterwards, so others are not moved. Rows that tie
    in ``order`` come in any order. To cut each batch again by a writer's limits, use its number as the lane of ``with_batches``.
    """
    spark = df.sparkSession
    size = row_bytes(df.schema)
    if max_row_bytes is not None:
        size = guard_row_bytes(size, max_row_bytes)
    wanted = list(df.columns if keep is None else keep)
    moved = [*wanted, *(c for c in order if c not in wanted)]
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys: list[Column] = [column(c) for c in order]
    ranged = df.select(*[column(c) for c in moved], size.alias(SIZE)).repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # counts the rows of the partition
    rows = staged(ranged.select("*", F.spark_partition_id().alias(PART), place.alias(POS)), "ordered")

    counted = rows.groupBy(PART).agg(F.count(F.lit(1)).alias("n"), F.sum(SIZE).alias("b")).collect()
    known = _Parts(sorted((r[PART], r["n"], r["b"]) for r in counted))
    entries: dict[int, tuple[int | None, int]] = {}
    if known.rows:
        sizes = rows.select(PART, POS, SIZE).repartition(parts, PART).sortWithinPartitions(PART, POS)
        jumps = staged(_jumps(sizes, known, limits), "jumps")
        found = _searched(rows.select(PART, POS, SIZE), jumps, known, parts)
        targets = F.when(F.col("part").isNull(), F.col("limit")).otherwise(F.col("target"))
        edges = staged(jumps.join(found, "last", "left").select("entry", "starts", targets.alias("target")), "edges")
        met = edges.select(F.col("target").alias("entry")).distinct().unionByName(spark.createDataFrame([(0,)], "entry long"))
        edges = staged(edges.join(met.distinct(), "entry", "left_semi"), "edges")
        reached = edges.join(_reached(edges), "entry").select("entry", "starts").collect()  # at most one per part
        entries = _entries(known, sorted((r["entry"], r["starts"]) for r in reached))
    together = rows.repartition(parts, PART).sortWithinPartitions(PART, POS)
    cut = together.withColumn(BATCH, _cut_from(entries, limits)(PART, POS, SIZE))
    return cut.select(*[column(c) for c in wanted], F.lit(0).cast("bigint").alias(LANE), BATCH)


def _entries(known: _Parts, reached: list[tuple[int, int]]) -> dict[int, tuple[int | None, int]]:
    """Per part the position of its first start, if it has one, and the number of starts before the part."""
    out: dict[int, tuple[int | None, int]] = {}
    before = at = 0
    for name, end in zip(known.names, known.row_ends.tolist(), strict=True):
        entry, starts = None, 0
        if at < len(reached) and reached[at][0] < end:
            entry, starts = reached[at][0] - known.begin[name][0], reached[at][1]
            at += 1
        out[name] = (entry, before)
        before += starts
    return out
