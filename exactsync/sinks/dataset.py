"""A Parquet target whose commits are exactly-once per label.

Each commit writes its own ``_label=...`` folder and becomes visible with one small marker file
that is published whole and only if absent (see ``files.create_json`` for the file systems that can do so). A
repeated task or a repeated run overwrites the same folder; a label that already has its marker is
never written again. An upsert writes merged rows under a new label and its marker retires the older
ones, so nothing is overwritten while it is read. With a ``layout`` the rows are kept in key-range
slices and an upsert reads and rewrites only the slices its input touches.

What a reader must know of the table (columns, model, keys and layout) is stored with the first commit and
compared with every later use; a different declaration is refused.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from exactsync.errors import SyncError
from exactsync.functions.sizes import row_bytes
from exactsync.functions.text import column
from exactsync.operators import accounting
from exactsync.operators.batching import BATCH, LANE, Limits, batch_summary, number_batches, with_batches
from exactsync.operators.upsert import (
    affected,
    collapse,
    duplicate_keys,
    insert_conflicts,
    update_columns,
    upsert,
)
from exactsync.plans.mapping import TargetColumn
from exactsync.sinks import files
from exactsync.sources.split import KeyLayout, RangeSplit

_EFFECT, _SLICE = "_effect", "_slice"
# Every so many commits one file sums up all markers so far, so a reader opens few files.
_SUMMED = 64
_UPTO = "upto-"


@dataclass(frozen=True)
class Receipt:
    loaded: int
    filtered: int
    affected: int
    bytes: int = 0
    replayed: bool = False


@dataclass(frozen=True)
class ParquetTarget:
    """``model`` is "append" (duplicates kept), "insert" (key clashes fail) or "upsert".

    ``full_row`` upserts take no partial rows: every writable column must be mapped.
    """

    root: str
    columns: tuple[TargetColumn, ...]
    model: str = "append"
    keys: tuple[str, ...] = ()
    layout: KeyLayout | RangeSplit | None = None
    full_row: bool = False

    def __post_init__(self):
        if self.model not in ("append", "insert", "upsert"):
            raise SyncError.config(f"Unknown target model {self.model}")
        declared = tuple(c.name for c in self.columns if c.key)
        if self.model == "append" and self.keys:
            raise SyncError.config("keys require insert or upsert")
        if self.model != "append" and (not self.keys or self.keys != declared):
            raise SyncError.schema("keys must exactly match the declared key columns in order")
        if self.layout is not None and self.model != "append" and self.layout.column not in self.keys:
            raise SyncError.config("the layout column must be a key column")

    # -- state ---------------------------------------------------------------------------

    def commits(self, spark: SparkSession) -> list[dict]:
        """Markers in commit order: one per commit group, not per row batch."""
        folder = f"{self.root}/_commits"
        found = [n for n in files.names(spark, folder) if n.endswith(".json") and not n.startswith(".")]
        summaries = [n for n in found if n.startswith(_UPTO)]
        known: list[dict] = []
        if summaries:
            known = files.read_json(spark, f"{folder}/{max(summaries)}")["commits"]
        after = known[-1]["version"] if known else -1
        single = [n for n in found if not n.startswith(_UPTO) and int(n.removesuffix(".json")) > after]
        return known + [files.read_json(spark, f"{folder}/{n}") for n in sorted(single)]

    def receipt(self, spark: SparkSession, label: str) -> Receipt | None:
        """Counters of a committed label, None if it has no marker."""
        for c in self.commits(spark):
            if c["label"] == label:
                return Receipt(c["loaded"], c["filtered"], c["affected"], c["bytes"], True)
        return None

    def labels(self, spark: SparkSession, given_up: Sequence[str] = ()) -> DataFrame:
        """Committed labels as the ledger's reconciliation reads them.

        ``given_up`` names labels whose writer is known to be gone: without a marker they were not committed and
        never will be, so they are reported as aborted.
        """
        rows = [(c["label"], "VISIBLE", c["loaded"], c["filtered"], c["affected"]) for c in self.commits(spark)]
        seen = {r[0] for r in rows}
        rows += [(name, "ABORTED", None, None, None) for name in given_up if name not in seen]
        return spark.createDataFrame(
            rows, "label string, label_state string, loaded bigint, filtered bigint, affected bigint"
        )

    # -- contract ------------------------------------------------------------------------

    def contract(self) -> dict:
        """What is stored with the table and must not change."""
        split = self.layout
        return {
            "columns": [
                [c.name, c.type.describe(), c.nullable, c.generated, c.has_default, repr(c.default)]
                for c in self.columns
            ],
            "model": self.model,
            "keys": list(self.keys),
            "layout": None if split is None else [split.column, str(split.lower), str(split.upper), split.partitions],
        }

    def check_contract(self, spark: SparkSession) -> None:
        """Refuse a declaration that differs from the stored one."""
        path = f"{self.root}/_contract.json"
        if not files.exists(spark, path):
            return
        stored, mine = files.read_json(spark, path), self.contract()
        for part, value in mine.items():
            if stored.get(part) != value:
                raise SyncError.schema(f"The stored table has other {part}: {stored.get(part)}, declared {value}")

    def _store_contract(self, spark: SparkSession) -> None:
        if not files.create_json(spark, f"{self.root}/_contract.json", self.contract()):
            self.check_contract(spark)

    def schema(self) -> T.StructType:
        return T.StructType([c.struct_field() for c in self.columns])

    def read(
        self, spark: SparkSession, commits: list[dict] | None = None, slices: set[int] | None = None
    ) -> DataFrame:
        """Committed rows only; ``slices`` limits a laid-out target to some of its key ranges."""
        if commits is None:
            self.check_contract(spark)
        paths = self._live_paths(self.commits(spark) if commits is None else commits, slices)
        if not paths:
            return spark.createDataFrame([], self.schema())
        return self._scan(spark, *paths)

    def _scan(self, spark: SparkSession, *paths: str) -> DataFrame:
        names = [column(c.name) for c in self.columns]
        return spark.read.schema(self.schema()).parquet(*paths).select(*names)

    def _live_paths(self, commits: list[dict], slices: set[int] | None) -> list[str]:
        """Newest first: a replacing commit retires what came before in the slices it holds."""
        paths: list[str] = []
        retired: set[int] = set()
        for c in reversed(commits):
            if self.layout is None:
                paths.append(c["path"])
                if c["kind"] == "replace":
                    break
                continue
            live = set(c["slices"]) - retired
            if slices is not None:
                live &= slices
            paths += [f"{c['path']}/{_SLICE}={k}" for k in sorted(live)]
            if c["kind"] == "replace":
                retired |= set(c["slices"])
        return paths

    def rejects(self, spark: SparkSession, label: str) -> DataFrame:
        """Rows a commit filtered out."""
        taken = f"/{accounting.VERDICT}={accounting.LOADED}"
        dealt = [c["path"].removesuffix(taken) for c in self.commits(spark) if c["label"] == label and c["path"].endswith(taken)]
        for folder in (*dealt, self._staged_input(label)):
            path = f"{folder}/{accounting.VERDICT}={accounting.FILTERED}"
            if files.exists(spark, path):
                return self._scan(spark, path)
        return spark.createDataFrame([], self.schema())

    def batches(self, spark: SparkSession, label: str) -> DataFrame:
        """Numbered batches of a commit written with limits: id, rows and bytes."""
        schema = self.schema()
        stored = T.StructType(
            [*schema.fields, T.StructField(LANE, T.LongType()), T.StructField(BATCH, T.IntegerType())]
        )
        path = next((c["path"] for c in self.commits(spark) if c["label"] == label), None)
        if path is None:
            raise SyncError("NOT_FOUND", f"No commit {label}")
        rows = spark.read.schema(stored).parquet(path)
        return number_batches(batch_summary(rows, row_bytes(schema))).select("batch_id", "rows", "bytes")

    # -- writes --------------------------------------------------------------------------

    def write(
        self,
        df: DataFrame,
        label: str,
        *,
        order: Sequence[str] = (),
        updates: Sequence[str] = (),
        reject: Column | None = None,
        partition: Column | None = None,
        partitions: Sequence[object] = (),
        max_filter_ratio: float = 0.0,
        limits: Limits | None = None,
        announce: Callable[[int, int], None] | None = None,
    ) -> Receipt:
        """Commit one frame of target columns under ``label``; replaying a label changes nothing.

        ``announce(rows, bytes)`` is called when the rows are staged, right before they become visible.
        """
        spark = df.sparkSession
        accounting.check_ratio_option(max_filter_ratio)
        if partitions and partition is None:
            raise SyncError.config("a list of partitions needs the partition expression")
        if limits is not None and self.model == "upsert":
            raise SyncError.config("batch limits apply to append and insert")
        self._store_contract(spark)
        commits = self.commits(spark)
        for known in commits:
            if known["label"] == label:
                return Receipt(known["loaded"], known["filtered"], known["affected"], known["bytes"], True)
        sorting = (reject, partition, partitions, max_filter_ratio)
        if self.model == "upsert":
            result, kind, path = self._merge(df, label, commits, order, updates, *sorting)
        else:
            result, kind, path = self._append(df, label, commits, *sorting, limits)
        if announce is not None:
            announce(result.loaded + result.filtered, result.bytes)
        self._commit(spark, commits, label, kind, path, result)
        if self.model == "upsert":
            taken = f"/{accounting.VERDICT}={accounting.LOADED}" if result.filtered else ""
            files.discard(spark, self._staged_input(label) + taken)  # filtered rows stay for ``rejects``
        return result

    def staging(self, spark: SparkSession, name: str) -> str:
        """Folder for a write that :meth:`adopt` takes groups from."""
        return f"{self.root}/data/_run={name}"

    def adopt(
        self,
        spark: SparkSession,
        label: str,
        path: str,
        checked: dict,
        size: int,
        announce: Callable[[int, int], None] | None = None,
    ) -> Receipt:
        """Append or insert rows that lie in ``path`` already: a marker makes them visible, nothing is copied."""
        self._store_contract(spark)
        commits = self.commits(spark)
        known = self.receipt(spark, label)
        if known is not None:
            return known
        if self.model == "insert":
            self._check_new_keys(spark, path, commits)
        result = Receipt(checked["loaded"], checked["filtered"], checked["affected"], size)
        if announce is not None:
            announce(result.loaded + result.filtered, result.bytes)
        self._commit(spark, commits, label, "append", path, result)
        return result

    def _folder(self, label: str) -> str:
        return f"{self.root}/data/_label={label}"

    def _store(self, df: DataFrame, folder: str, *by: str) -> None:
        """Write one label folder. With a layout, rows of a slice are brought together first (large slices are split),
        so the number of files follows slices and data, not tasks times slices."""
        if self.layout is not None:
            df = df.withColumn(_SLICE, self.layout.slice_id())
            by = (*by, _SLICE)
            df = df.hint("rebalance", *by)
        writer = df.write.mode("overwrite")
        (writer.partitionBy(*by) if by else writer).parquet(folder)

    def _count_stored(self, df: DataFrame, folder: str, layout: bool, reject, partition, partitions, max_ratio):
        """Write rows with their verdicts and count them: (path of the loaded rows, checked counters, bytes)."""
        sorted_out = reject is not None or bool(partitions)
        seen = Observation()
        metrics = [F.count(F.lit(1)).alias("submitted"), F.sum(row_bytes(df.schema)).alias("bytes")]
        store = self._store if layout else _plain_store
        if sorted_out:
            marked = accounting.with_verdict(df, reject, partition, partitions)
            watched = marked.observe(seen, *metrics, *accounting.counters())
            store(watched.where(F.col(accounting.VERDICT) != accounting.UNSELECTED), folder, accounting.VERDICT)
        else:
            store(df.observe(seen, *metrics), folder)
        got = seen.get
        loaded = got["loaded"] if sorted_out else got["submitted"]
        checked = accounting.receipt(
            got["submitted"], loaded, got.get("filtered", 0), got.get("unselected", 0), max_ratio
        )
        path = f"{folder}/{accounting.VERDICT}={accounting.LOADED}" if sorted_out else folder
        return path, checked, got["bytes"] or 0

    def _append(self, df, label, commits, reject, partition, partitions, max_ratio, limits):
        spark = df.sparkSession
        rows = with_batches(df, limits) if limits is not None else df
        path, checked, size = self._count_stored(
            rows, self._folder(label), True, reject, partition, partitions, max_ratio
        )
        self._check_written(spark, path, checked["loaded"])
        if self.model == "insert":
            self._check_new_keys(spark, path, commits)
        return Receipt(checked["loaded"], checked["filtered"], checked["affected"], size), "append", path

    def _check_new_keys(self, spark: SparkSession, path: str, commits: list[dict]) -> None:
        """Key clashes among the staged rows or with the target; only keys are read."""
        if not files.exists(spark, path):
            return
        staged = self._scan(spark, path)
        clash = not duplicate_keys(staged, self.keys).isEmpty()
        if commits and not clash:
            touched = set(self._stored_slices(spark, path)) if self.layout is not None else None
            clash = not insert_conflicts(staged, self.read(spark, commits, touched), self.keys).isEmpty()
        if clash:
            raise SyncError("DUPLICATE_KEY", "An inserted key exists already")

    def _staged_input(self, label: str) -> str:
        return f"{self.root}/_stage/{label}"

    def _merge(
        self, df, label, commits, order, updates, reject, partition, partitions, max_ratio
    ) -> tuple[Receipt, str, str]:
        spark, folder, keys = df.sparkSession, self._folder(label), list(self.keys)
        changes = update_columns(df.columns, keys, updates)
        # The input is read several times below, so it is fixed first: sources may change, and a
        # written table also survives lost executors and has a size Spark can plan with. Rejected
        # rows are told apart here, so nothing after this sees them.
        path, checked, size = self._count_stored(
            df, self._staged_input(label), False, reject, partition, partitions, max_ratio
        )
        found = files.exists(spark, path)
        staged = spark.read.schema(df.schema).parquet(path) if found else spark.createDataFrame([], df.schema)
        touched = None
        if self.layout is not None:
            # At most as many values as the layout has slices.
            touched = {r[0] for r in staged.select(self.layout.slice_id()).distinct().collect()}
        target = self.read(spark, commits, touched)
        chained = None
        if order:
            chained = affected(staged, target, keys, changes, order).agg(F.sum("affected_rows").alias("affected"))
            incoming = collapse(staged, keys, order, df.columns, changes)
        else:
            # Without an order "last" has no meaning, so repeated keys are refused.
            if not duplicate_keys(staged, keys).isEmpty():
                raise SyncError("DUPLICATE_KEY", "Incoming keys repeat and no order is given")
            incoming = staged
        # The effect of each row is stored with it and summed up from the files: a metric observed
        # before a shuffle would count a lost executor's rows twice.
        fill = {
            c.name: F.lit(c.default).cast(c.type.spark) for c in self.columns if c.has_default and not c.generated
        }
        merged = upsert(target, incoming, keys, changes, effect=_EFFECT, defaults=fill)
        self._store(merged, folder)
        effects = T.StructType([T.StructField(_EFFECT, T.LongType())])
        stored = spark.read.schema(effects).parquet(folder)
        totals = chained if order else stored.agg(F.sum(_EFFECT).alias("affected"))
        effect = totals.first()["affected"] or 0
        return Receipt(checked["loaded"], checked["filtered"], effect, size), "replace", folder

    def _check_written(self, spark: SparkSession, path: str, rows: int) -> None:
        """The files hold the counted rows; Parquet footers answer without reading data."""
        found = self._scan(spark, path).count() if files.exists(spark, path) else 0
        if found != rows:
            raise SyncError.unknown(f"{found} written rows disagree with {rows} counted rows")

    def _commit(self, spark, commits, label, kind, path, receipt: Receipt) -> None:
        if not files.exists(spark, path):
            # All rows were rejected: nothing to read, but the commit still counts.
            spark.createDataFrame([], self.schema()).write.mode("ignore").parquet(path)
        marker = {
            "version": commits[-1]["version"] + 1 if commits else 0,
            "label": label,
            "kind": kind,
            "path": path,
            "slices": self._stored_slices(spark, path),
            "loaded": receipt.loaded,
            "filtered": receipt.filtered,
            "affected": receipt.affected,
            "bytes": receipt.bytes,
        }
        folder = f"{self.root}/_commits"
        while not files.create_json(spark, f"{folder}/{marker['version']:012d}.json", marker):
            if self.model != "append":
                raise SyncError("CONFLICT", "Another commit changed the target meanwhile", retryable=True)
            # Appends do not depend on each other: take the next free place.
            marker["version"] += 1
        if marker["version"] % _SUMMED == _SUMMED - 1:
            summary = {"commits": [c for c in self.commits(spark) if c["version"] <= marker["version"]]}
            files.create_json(spark, f"{folder}/{_UPTO}{marker['version']:012d}.json", summary)

    def _stored_slices(self, spark: SparkSession, path: str) -> list[int]:
        if self.layout is None:
            return []
        mark = f"{_SLICE}="
        return sorted(int(n.removeprefix(mark)) for n in files.names(spark, path) if n.startswith(mark))


def _plain_store(df: DataFrame, folder: str, *by: str) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).parquet(folder)
