"""Many commit groups out of one scan: one write deals all rows to their groups, and each group is committed from its files.

The source is read once, whatever the number of groups. A row the target cannot take does not end the write: it is stored with its
problem under the verdict ``broken``, so only its own group fails. What a group holds is counted from the files that the
write has committed, so retried and speculative tasks add nothing; a few numbers per group reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from exactsync.errors import SyncError
from exactsync.functions.sizes import fixed_row_bytes, row_bytes
from exactsync.functions.text import column
from exactsync.operators import accounting
from exactsync.plans.mapping import PROBLEM, MappingPlan
from exactsync.sources.split import RangeSplit

GROUP, BYTES = "_group", "_bytes"
BROKEN = "broken"
_TOO_LARGE = "_too_large"


@dataclass(frozen=True)
class DealtGroup:
    """What one group of a dealt write holds: rows by verdict, bytes, files and the first problem."""

    number: int
    folder: str
    rows: dict[str, int]
    bytes: int
    files: int
    problem: str | None

    @property
    def path(self) -> str:
        """Folder of the rows to be loaded."""
        return f"{self.folder}/{accounting.VERDICT}={accounting.LOADED}"

    def receipt(self, max_ratio: float) -> dict:
        """Checked counters of the group; its first problem, if there is one, is its failure."""
        if self.problem is not None:
            code, _, why = self.problem.partition(": ")
            raise SyncError(code, why)
        loaded, filtered, unselected = (
            self.rows.get(v, 0) for v in (accounting.LOADED, accounting.FILTERED, accounting.UNSELECTED)
        )
        return accounting.receipt(sum(self.rows.values()), loaded, filtered, unselected, max_ratio)


def dealt_rows(
    frame: DataFrame,
    plan: MappingPlan,
    split: RangeSplit,
    *,
    fill_omitted: bool = True,
    max_row_bytes: int | None = None,
    reject: Column | None = None,
    partition: Column | None = None,
    partitions=(),
) -> DataFrame:
    """Target columns of a source frame with ``_group``, ``_verdict``, ``_bytes`` and ``_problem``; one narrow projection."""
    carried = [split.slice_id().cast("int").alias(GROUP)]
    flat = fixed_row_bytes(frame.schema)
    guarded = max_row_bytes is not None and (flat is None or flat > max_row_bytes)
    if guarded:
        size = row_bytes(frame.schema)
        why = F.concat(F.lit("ROW_TOO_LARGE: row of "), size.cast("string"), F.lit(f" bytes exceeds {max_row_bytes}"))
        carried.append(F.when(size > max_row_bytes, why).alias(_TOO_LARGE))
    rows = plan.marked(frame, fill_omitted, *carried)
    if guarded:
        rows = rows.withColumn(PROBLEM, F.coalesce(_TOO_LARGE, PROBLEM)).drop(_TOO_LARGE)
    names = [n for n in rows.columns if n not in (GROUP, PROBLEM)]
    rows = accounting.with_verdict(rows, reject, partition, partitions)
    verdict = F.when(F.col(PROBLEM).isNotNull(), BROKEN).otherwise(F.col(accounting.VERDICT))
    rows = rows.withColumn(accounting.VERDICT, verdict)
    size = row_bytes(rows.select(*[column(n) for n in names]).schema)
    rows = rows.withColumn(BYTES, F.when(F.col(accounting.VERDICT) != accounting.UNSELECTED, size).otherwise(0))
    if not partitions:
        return rows
    # Rows outside the listed partitions are only counted: without values they take no room.
    taken = F.col(accounting.VERDICT) != accounting.UNSELECTED
    kept = [F.when(taken, column(n)).alias(n, metadata=rows.schema[n].metadata) for n in names]
    return rows.select(*kept, *[c for c in rows.columns if c not in names])


def deal(rows: DataFrame, folder: str, layout: RangeSplit | None = None, gather: bool = False) -> list[DealtGroup]:
    """Write :func:`dealt_rows` once, a folder per group and verdict (and key range, with a ``layout``), and count what was written.

    ``gather`` brings the rows of a group together first (large groups are split): one shuffle in exchange for fewer files."""
    by = [GROUP, accounting.VERDICT]
    if layout is not None:
        rows = rows.withColumn("_slice", layout.slice_id())
        by.append("_slice")
    if gather:
        rows = rows.hint("rebalance", *by)
    rows.write.mode("overwrite").partitionBy(*by).parquet(folder)
    return counted(rows.sparkSession, folder)


def counted(spark, folder: str) -> list[DealtGroup]:
    """The groups of a dealt write, in order; at most as many as the split has slices."""
    stored = spark.read.schema(f"{BYTES} long, {PROBLEM} string, {GROUP} int, {accounting.VERDICT} string").parquet(folder)
    by_file = stored.groupBy(GROUP, accounting.VERDICT, F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(BYTES).alias("bytes"), F.min(PROBLEM).alias("problem")
    )
    by_verdict = by_file.groupBy(GROUP, accounting.VERDICT).agg(
        F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"), F.min("problem").alias("problem"), F.count("file").alias("files")
    )
    found: dict[int, list] = {}
    for row in by_verdict.collect():
        found.setdefault(row[GROUP], []).append(row)
    return [
        DealtGroup(
            number,
            f"{folder}/{GROUP}={number}",
            {r[accounting.VERDICT]: r["rows"] for r in rows},
            sum(r["bytes"] for r in rows),
            sum(r["files"] for r in rows),
            min((r["problem"] for r in rows if r["problem"] is not None), default=None),
        )
        for number, rows in sorted(found.items())
    ]
