"""Catalog tables as targets: their schema, labelled appends, and MERGE where the format has it."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from exactsync.errors import SyncError
from exactsync.functions.sizes import row_bytes
from exactsync.functions.text import column, quoted, string_literal
from exactsync.operators import accounting
from exactsync.operators.batching import Limits
from exactsync.operators.upsert import update_columns
from exactsync.plans.mapping import TargetColumn
from exactsync.session import checkpoint_dir, configure
from exactsync.sinks import files
from exactsync.sinks.dataset import Receipt

LABEL = "_label"


def quoted_table(table: str) -> str:
    return ".".join(quoted(part) for part in table.split("."))


def table_columns(spark: SparkSession, table: str) -> tuple[TargetColumn, ...]:
    """Target columns of a table that must exist; its own types are trusted as they are."""
    if not spark.catalog.tableExists(table):
        raise SyncError.schema(f"the catalog shows no table {table}")
    return tuple(TargetColumn.from_field(f) for f in spark.table(table).schema.fields if f.name != LABEL)


def append_to_table(df: DataFrame, table: str, label: str, unlabelled: bool = False) -> None:
    """Append under a label. In a table partitioned by ``_label`` a repeated label replaces its own
    partition only, so a replay changes nothing. A table without it is appended to only if ``unlabelled``
    says so, because a replay then adds the rows again."""
    spark = df.sparkSession
    known = spark.table(table)
    names = [f.name for f in known.schema.fields]
    if LABEL in names:
        # A static partition: only this label's rows are replaced, whatever the session's overwrite mode.
        picked = ", ".join(quoted(n) for n in names if n != LABEL)
        spark.sql(
            f"INSERT OVERWRITE TABLE {quoted_table(table)} PARTITION ({LABEL} = {string_literal(label)}) "
            f"SELECT {picked} FROM {{rows}}",
            rows=df,
        )
    elif not unlabelled:
        raise SyncError.config(f"{table} has no column {LABEL}, so an append could not be told from its repetition")
    else:
        df.select(*[column(n) for n in names]).write.mode("append").insertInto(table)


def overwrite_partitions(
    df: DataFrame,
    table: str,
    by: str,
    partitions: Sequence[object],
    *,
    reject: Column | None = None,
    max_filter_ratio: float = 0.0,
) -> Receipt:
    """Replace the listed partitions of a table partitioned by one column; all others stay as they are.

    Rows outside the list are counted as not selected and written nowhere; a listed partition without rows becomes empty. Everything is
    staged and counted first, so a row that fails or a ratio that is exceeded changes nothing, and a repetition gives the same table."""
    spark = df.sparkSession
    accounting.check_ratio_option(max_filter_ratio)
    schema = spark.table(table).schema
    names = [f.name for f in schema.fields]
    if not partitions or by not in names or by not in df.columns:
        raise SyncError.config("list the partitions to replace, and name the column of both sides they are values of")
    folder = f"{checkpoint_dir(spark)}/partitions-{uuid.uuid4()}"
    marked = accounting.with_verdict(df.select(*[column(n) for n in names]), reject, column(by), partitions)
    kept = F.col(accounting.VERDICT) == accounting.LOADED
    # Rows that are not loaded are only counted: they are stored without values.
    slim = marked.select(*[F.when(kept, column(n)).cast(schema[n].dataType).alias(n) for n in names], accounting.VERDICT)
    sized = slim.withColumn("_bytes", F.when(kept, row_bytes(schema)).otherwise(0))
    sized.write.partitionBy(accounting.VERDICT).parquet(folder)
    stored = spark.read.schema(T.StructType([*schema.fields, T.StructField("_bytes", T.LongType()), T.StructField(accounting.VERDICT, T.StringType())]))
    rows = stored.parquet(folder)
    got = rows.agg(F.count(F.lit(1)).alias("submitted"), F.sum("_bytes").alias("bytes"), *accounting.counters()).first()
    checked = accounting.receipt(got["submitted"], got["loaded"], got["filtered"], got["unselected"], max_filter_ratio)
    # The overwrite mode is a session setting, so a session of its own has it; staged files are all it reads.
    session = spark.newSession()
    configure(session)
    session.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    session.catalog.setCurrentDatabase(spark.catalog.currentDatabase())
    loaded = session.read.schema(rows.schema).parquet(folder).where(kept).select(*[column(n) for n in names])
    present = {r[0] for r in loaded.select(column(by)).distinct().collect()}  # at most as many as are listed
    loaded.write.mode("overwrite").insertInto(table)
    picked = ", ".join(quoted(n) for n in names if n != by)
    for value in partitions:
        if value not in present:
            literal = string_literal(value) if isinstance(value, str) else str(value)
            session.sql(
                f"INSERT OVERWRITE TABLE {quoted_table(table)} PARTITION ({quoted(by)} = {literal}) SELECT {picked} FROM {{rows}}",
                rows=loaded.where("false"),
            )
    spark.catalog.refreshTable(table)
    return Receipt(checked["loaded"], checked["filtered"], checked["affected"], got["bytes"] or 0)


def merge_into(incoming: DataFrame, table: str, keys: Sequence[str], updates: Sequence[str] = ()) -> None:
    """Upsert into a table whose format supports MERGE; Spark plans and commits it.

    ``incoming`` holds each key once.
    """
    changes = update_columns(incoming.columns, keys, updates)
    condition = F.lit(True)
    for k in keys:
        condition = condition & (F.col(f"{table}.{quoted(k)}") == F.col(f"source.{quoted(k)}"))
    merge = incoming.alias("source").mergeInto(table, condition)
    merge = merge.whenMatched().update({u: F.col(f"source.{quoted(u)}") for u in changes})
    merge.whenNotMatched().insert({c: F.col(f"source.{quoted(c)}") for c in incoming.columns}).merge()


@dataclass(frozen=True)
class CatalogTarget:
    """A catalog table partitioned by ``_label`` as the target of a job: one partition per commit group.

    Rows are staged and counted in the shared folder, announced, and then replace their label's partition in one statement,
    so a repeated group changes nothing. The group's counters are stored next to the partitions before that.
    """

    table: str
    columns: tuple[TargetColumn, ...]
    model: str = "append"
    keys: tuple[str, ...] = ()
    full_row: bool = False

    def __post_init__(self):
        if self.model != "append" or self.keys:
            raise SyncError.config("groups are appended to a catalog table; upserts go through merge_into")

    @classmethod
    def of(cls, spark: SparkSession, table: str) -> "CatalogTarget":
        return cls(table, table_columns(spark, table))

    @property
    def root(self) -> str:
        return self.table

    def contract(self) -> dict:
        return {"columns": [[c.name, c.type.describe(), c.nullable] for c in self.columns], "model": self.model}

    def check_contract(self, spark: SparkSession) -> None:
        """The table must still have the declared columns, and its label partitions."""
        found = table_columns(spark, self.table)
        shape = lambda columns: [(c.name, c.type.spark) for c in columns]
        if shape(found) != shape(self.columns):
            raise SyncError.schema(f"{self.table} has other columns than declared")
        if LABEL not in spark.table(self.table).columns:
            raise SyncError.schema(f"{self.table} is not partitioned by {LABEL}")

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.table).select(*[column(c.name) for c in self.columns])

    # -- receipts ------------------------------------------------------------------------

    def _receipts(self, spark: SparkSession) -> str:
        """Folder next to the table's partitions; names with a leading underscore are no data for Spark."""
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted_table(self.table)}").where("col_name = 'Location'").collect()
        if not rows:
            raise SyncError.config(f"{self.table} has no location, so receipts cannot be kept with it")
        return f"{rows[0]['data_type'].rstrip('/')}/_receipts"

    def _promise(self, spark: SparkSession, label: str, receipt: Receipt) -> None:
        """Store the counters of a group before its rows become visible, once per label and outcome.

        They hold as soon as the label's partition has as many rows; a group without rows is committed by them alone."""
        values = {"label": label, "loaded": receipt.loaded, "filtered": receipt.filtered, "affected": receipt.affected, "bytes": receipt.bytes}
        path = f"{self._receipts(spark)}/{label}.json"
        if not files.create_json(spark, path, values) and files.read_json(spark, path) != values:
            raise SyncError("CONFLICT", f"group {label} was announced with other counters before")

    def receipt(self, spark: SparkSession, label: str) -> Receipt | None:
        """Counters of a committed label, None if it is not committed."""
        rows = spark.table(self.table).where(F.col(LABEL) == label).count()
        path = f"{self._receipts(spark)}/{label}.json"
        if not files.exists(spark, path):
            return Receipt(rows, 0, rows, replayed=True) if rows else None
        told = files.read_json(spark, path)
        if rows not in (0, told["loaded"]):
            raise SyncError.unknown(f"{label} has {rows} rows, {told['loaded']} were announced")
        if rows < told["loaded"]:
            return None
        return Receipt(told["loaded"], told["filtered"], told["affected"], told["bytes"], True)

    def labels(self, spark: SparkSession, given_up: Sequence[str] = ()) -> DataFrame:
        """States of the labels for the ledger: a row per label that has rows or a stored receipt.

        A label is visible if it has as many rows as its receipt says, unknown if it has others, and aborted if it has none."""
        rows = spark.table(self.table).groupBy(F.col(LABEL).alias("label")).agg(F.count(F.lit(1)).alias("rows"))
        folder, schema = self._receipts(spark), "label string, loaded bigint, filtered bigint, affected bigint"
        told = spark.read.schema(schema).json(folder) if files.exists(spark, folder) else spark.createDataFrame([], schema)
        both = rows.join(told, "label", "full")
        has, promised = F.coalesce("rows", F.lit(0)), F.coalesce("loaded", "rows")
        state = F.when(has == promised, "VISIBLE").when(has == 0, "ABORTED").otherwise("UNKNOWN")
        seen = both.select(
            "label",
            state.alias("label_state"),
            promised.alias("loaded"),
            F.coalesce("filtered", F.lit(0).cast("bigint")).alias("filtered"),
            F.coalesce("affected", "rows").alias("affected"),
        )
        none = F.lit(None).cast("bigint")
        nothing = [none.alias(n) for n in ("loaded", "filtered", "affected")]
        # A receipt without rows may belong to a group still under way: only a writer known to be gone makes it aborted.
        gone = spark.createDataFrame([(name,) for name in given_up], "label string")
        kept = seen.where("label_state <> 'ABORTED'")
        return kept.unionByName(
            gone.join(kept, "label", "left_anti").select("label", F.lit("ABORTED").alias("label_state"), *nothing)
        )

    # -- writes --------------------------------------------------------------------------

    layout = None

    def staging(self, spark: SparkSession, name: str) -> str:
        """Folder for a write that :meth:`adopt` takes groups from."""
        return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4()}"

    def adopt(
        self,
        spark: SparkSession,
        label: str,
        path: str,
        checked: dict,
        size: int,
        announce: Callable[[int, int], None] | None = None,
    ) -> Receipt:
        """Append the staged rows of ``path`` as the partition of a label."""
        known = self.receipt(spark, label)
        if known is not None:
            return known
        result = Receipt(checked["loaded"], checked["filtered"], checked["affected"], size)
        if announce is not None:
            announce(result.loaded + result.filtered, size)
        self._promise(spark, label, result)
        if result.loaded:
            names = [column(c.name) for c in self.columns]
            append_to_table(spark.read.parquet(path).select(*names), self.table, label)
        return result

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
        spark = df.sparkSession
        accounting.check_ratio_option(max_filter_ratio)
        if order or updates or limits is not None:
            raise SyncError.config("order, update columns and batch limits have no meaning for a catalog table")
        known = self.receipt(spark, label)
        if known is not None:
            return known
        folder = self.staging(spark, label)
        marked = accounting.with_verdict(df, reject, partition, partitions)
        marked.withColumn("_bytes", row_bytes(df.schema)).write.partitionBy(accounting.VERDICT).parquet(folder)
        kinds = f"_bytes bigint, {accounting.VERDICT} string"
        staged = spark.read.schema(kinds).parquet(folder)
        got = staged.agg(F.count(F.lit(1)).alias("submitted"), F.sum("_bytes").alias("bytes"), *accounting.counters()).first()
        checked = accounting.receipt(
            got["submitted"], got["loaded"], got["filtered"], got["unselected"], max_filter_ratio
        )
        path = f"{folder}/{accounting.VERDICT}={accounting.LOADED}"
        return self.adopt(spark, label, path, checked, got["bytes"] or 0, announce)
