"""JDBC targets: stage with Spark, then move the staged rows in one transaction per commit group.

Plain JDBC appends are not safe under task retries: a task whose commit went through but whose
executor was lost is run again. The rows and their ids are therefore fixed in files in the shared
folder first; whatever a repeated task stages again is the same row under the same id, and the final
statement takes every id once.

The target database needs a table ``_committed_labels (label, loaded, filtered, affected, bytes)`` whose key is ``label``. The
transaction that moves a group notes its label and counters there, so the group's receipt becomes visible with its rows, a repeated
group finds it, and the key refuses a second one that races. The staging table of a label can be dropped once it is there.
Statements are run by a callable of the user's, because only the user knows the driver; Spark's reader and writer do the rest.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from typing import ClassVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from exactsync.errors import SyncError
from exactsync.functions.sizes import row_bytes
from exactsync.functions.text import column, quoted, string_literal
from exactsync.operators import accounting
from exactsync.operators.batching import Limits, jdbc_batchsize
from exactsync.operators.upsert import update_columns
from exactsync.plans.mapping import TargetColumn
from exactsync.session import checkpoint_dir
from exactsync.sinks.dataset import Receipt

ROW_ID = "_row_id"
COMMITTED_LABELS = "_committed_labels"
_COUNTERS = ("loaded", "filtered", "affected", "bytes")


@dataclass(frozen=True)
class JdbcTarget:
    """``model`` is "insert" (the table's own keys refuse clashes) or "upsert". A job needs the ``columns`` and ``execute``, which
    runs the statements of a group in order on one connection."""

    layout: ClassVar[None] = None

    url: str
    table: str
    model: str = "insert"
    keys: tuple[str, ...] = ()
    updates: tuple[str, ...] = ()
    batch_rows: int = 10_000
    options: Mapping[str, str] = field(default_factory=dict)
    columns: tuple[TargetColumn, ...] = ()
    execute: Callable[[Sequence[str]], None] | None = None
    full_row: bool = False

    def __post_init__(self):
        if self.model not in ("insert", "upsert"):
            raise SyncError.config("model must be insert or upsert")
        if self.model == "upsert" and not self.keys:
            raise SyncError.config("upsert requires key columns")
        if self.model == "insert" and (self.keys or self.updates):
            raise SyncError.config("key/update columns require upsert")

    @property
    def root(self) -> str:
        return self.table

    def contract(self) -> dict:
        columns = [[c.name, c.type.describe(), c.nullable, c.generated, c.has_default, repr(c.default)] for c in self.columns]
        return {"columns": columns, "model": self.model, "keys": list(self.keys)}

    def check_contract(self, spark: SparkSession) -> None:
        """The database's table must have the declared columns."""
        if not self.columns or self.execute is None:
            raise SyncError.config("a job needs the columns of the table and a way to run its statements")
        found = self.load(spark, f"(SELECT * FROM {_qualified(self.table)} WHERE 1=0) declared").columns
        missing = [c.name for c in self.columns if c.name not in found]
        if missing:
            raise SyncError.schema(f"{self.table} has no column {', '.join(missing)}")

    def stage_table(self, label: str) -> str:
        return f"{self.table}_stage_{label}"

    def move_statements(
        self, columns: Sequence[str], label: str, receipt: Receipt | None = None, updates: Sequence[str] = ()
    ) -> list[str]:
        """One transaction: note the label (its primary key refuses a second time), move the rows, note how many that affected."""
        names = ",".join(quoted(c) for c in columns)
        picked = ",".join(f"MAX({quoted(c)})" for c in columns)
        target, stage = _qualified(self.table), _qualified(self.stage_table(label))
        move = f"INSERT INTO {target} ({names}) SELECT {picked} FROM {stage} GROUP BY {quoted(ROW_ID)}"
        if self.model == "upsert":
            move += f" ORDER BY {quoted(ROW_ID)}"
            updates = update_columns(columns, self.keys, updates or self.updates)
            move += " ON DUPLICATE KEY UPDATE " + ",".join(f"{quoted(u)}=VALUES({quoted(u)})" for u in updates)
        labels, name = _qualified(COMMITTED_LABELS), string_literal(label)
        if receipt is None:
            return ["START TRANSACTION", f"INSERT INTO {labels} (label) VALUES ({name})", move, "COMMIT"]
        counts = ",".join(str(getattr(receipt, c)) for c in _COUNTERS)
        note = f"INSERT INTO {labels} (label,{','.join(_COUNTERS)}) VALUES ({name},{counts})"
        count = f"UPDATE {labels} SET affected=ROW_COUNT() WHERE label={name}"
        return ["START TRANSACTION", note, *([move, count] if receipt.loaded else []), "COMMIT"]

    def write_options(self, columns: int) -> dict[str, str]:
        return {"batchsize": str(jdbc_batchsize(columns + 1, self.batch_rows)), **self.options}

    # -- the two places that open a connection of Spark's --------------------------------

    def load(self, spark: SparkSession, relation: str) -> DataFrame:
        return spark.read.format("jdbc").options(url=self.url, dbtable=relation, **self.options).load()

    def store(self, rows: DataFrame, table: str) -> None:
        options = self.write_options(len(rows.columns) - 1)
        rows.write.format("jdbc").mode("overwrite").options(url=self.url, dbtable=table, **options).save()

    # -- receipts ------------------------------------------------------------------------

    def receipt(self, spark: SparkSession, label: str) -> Receipt | None:
        """Counters of a committed label, None if it is not committed."""
        names = ",".join(_COUNTERS)
        noted = f"(SELECT {names} FROM {_qualified(COMMITTED_LABELS)} WHERE label = {string_literal(label)}) noted"
        row = self.load(spark, noted).first()
        return None if row is None else Receipt(*(int(row[c] or 0) for c in _COUNTERS), replayed=True)

    def labels(self, spark: SparkSession, given_up: Sequence[str] = ()) -> DataFrame:
        """States of the labels for the ledger: visible if noted; aborted if not and its writer is known to be gone."""
        counts = _COUNTERS[:3]
        noted = self.load(spark, _qualified(COMMITTED_LABELS))
        kept = noted.select("label", F.lit("VISIBLE").alias("label_state"), *[F.col(c).cast("bigint").alias(c) for c in counts])
        gone = spark.createDataFrame([(name,) for name in given_up], "label string").join(kept, "label", "left_anti")
        nothing = [F.lit(None).cast("bigint").alias(c) for c in counts]
        return kept.unionByName(gone.select("label", F.lit("ABORTED").alias("label_state"), *nothing))

    # -- writes --------------------------------------------------------------------------

    def staging(self, spark: SparkSession, name: str) -> str:
        """Folder for a write that :meth:`adopt` takes groups from."""
        return f"{checkpoint_dir(spark)}/jdbc-{name}-{uuid.uuid4()}"

    def adopt(
        self,
        spark: SparkSession,
        label: str,
        path: str,
        checked: dict,
        size: int,
        announce: Callable[[int, int], None] | None = None,
        updates: Sequence[str] = (),
    ) -> Receipt:
        """Stage the rows of the files in ``path`` and move them under a label."""
        known = self.receipt(spark, label)
        if known is not None:
            return known
        result = Receipt(checked["loaded"], checked["filtered"], checked["affected"], size)
        names: list[str] = []
        if result.loaded:
            fixed = spark.read.parquet(path)
            if ROW_ID not in fixed.columns:
                fixed = fixed.withColumn(ROW_ID, F.monotonically_increasing_id())  # files that no longer change
            names = [c.name for c in self.columns if c.name in fixed.columns]
            self.store(fixed.select(*[column(n) for n in names], ROW_ID), self.stage_table(label))
        if announce is not None:
            announce(result.loaded + result.filtered, size)
        try:
            self.execute(self.move_statements(names, label, result, updates))
        except (TimeoutError, ConnectionError) as e:
            raise SyncError.unknown("COMMIT response missing; look for the label before rerunning") from e
        return replace(self.receipt(spark, label) or result, replayed=False)

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
        """Fix the rows and their ids in files, count them, then stage and move. Rows are met in ``order``, the last of a key wins."""
        spark = df.sparkSession
        accounting.check_ratio_option(max_filter_ratio)
        if limits is not None:
            raise SyncError.config("a group of a JDBC target is one transaction; split the source instead of setting batch limits")
        known = self.receipt(spark, label)
        if known is not None:
            return known
        folder = self.staging(spark, label)
        sized = df.withColumn("_bytes", row_bytes(df.schema))
        if order:
            sized = sized.orderBy(*[column(o).asc_nulls_first() for o in order])
        marked = accounting.with_verdict(sized.withColumn(ROW_ID, F.monotonically_increasing_id()), reject, partition, partitions)
        marked.write.partitionBy(accounting.VERDICT).parquet(folder)
        staged = spark.read.schema(f"_bytes bigint, {accounting.VERDICT} string").parquet(folder)
        got = staged.agg(F.count(F.lit(1)).alias("submitted"), F.sum("_bytes").alias("bytes"), *accounting.counters()).first()
        counts = (got[c] for c in ("submitted", *(accounting.LOADED, accounting.FILTERED, accounting.UNSELECTED)))
        checked = accounting.receipt(*counts, max_filter_ratio)
        path = f"{folder}/{accounting.VERDICT}={accounting.LOADED}"
        return self.adopt(spark, label, path, checked, got["bytes"] or 0, announce, updates)


def _qualified(name: str) -> str:
    return ".".join(quoted(part) for part in name.split("."))
