"""JDBC sources as reader options: explicit slice predicates, one read-only snapshot per connection.

A job takes a ``JdbcSource`` like any other source: without ``single_scan`` each slice is a reader with the slice's predicate in its
statement, with it one reader of as many tasks as slices. ``JdbcSource.load`` is the only place that opens a connection."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from typing import ClassVar

from pyspark.sql import DataFrame, SparkSession

from exactsync.errors import SyncError
from exactsync.functions.text import column, quoted, string_literal
from exactsync.functions.times import offset_seconds
from exactsync.sources.split import RangeSplit, check_split_column
from exactsync.sources.table import check_declared, check_query

# Session variables the engine sets itself.
RESERVED_VARIABLES = {
    "time_zone",
    "character_set_results",
    "character_set_client",
    "character_set_connection",
    "autocommit",
    "sql_mode",
}
# One SET statement per connection, since drivers run a single statement at a time.
READ_ONLY = "transaction_read_only = 1"
REPEATABLE = "transaction_isolation = 'REPEATABLE-READ'"


@dataclass(frozen=True)
class JdbcSource:
    """``consistency``: "snapshot" gives each connection its own repeatable-read transaction;
    slices are read over several connections and do not share one point in time. ``types`` overrides what Spark makes of
    columns (``customSchema``), ``declared`` is what the schema read must then be."""

    pin: ClassVar[bool] = False

    url: str
    table: str | None = None
    columns: tuple[str, ...] = ()
    where: str | None = None
    query: str | None = None
    split: RangeSplit | None = None
    consistency: str = "snapshot"
    time_zone: str = "+00:00"
    variables: Mapping[str, str] = field(default_factory=dict)
    fetch_rows: int = 10_000
    options: Mapping[str, str] = field(default_factory=dict)
    types: Mapping[str, str] = field(default_factory=dict)
    declared: Mapping[str, str] = field(default_factory=dict)

    def session_init(self) -> str:
        if self.consistency not in ("snapshot", "statement"):
            raise SyncError.config("consistency must be snapshot or statement")
        for name in self.variables:
            if not name.replace("_", "").isalnum() or name.lower() in RESERVED_VARIABLES:
                raise SyncError.config(f"the reader sets or forbids the session variable {name}")
        offset_seconds(self.time_zone)
        settings = [f"time_zone = {string_literal(self.time_zone)}"]
        settings += [f"{name} = {string_literal(v)}" for name, v in self.variables.items()]
        settings += [REPEATABLE, READ_ONLY] if self.consistency == "snapshot" else [READ_ONLY]
        return f"SET {', '.join(settings)}"

    def relation(self) -> str:
        """Table expression for the reader; projection and predicate stay in the database."""
        if (self.query is None) == (self.table is None):
            raise SyncError.config("give either a query or a table with its columns and predicate")
        if self.query is not None:
            if self.columns or self.where or self.split:
                raise SyncError.config("A query takes no columns, where or split")
            return f"({check_query(self.query)}) source_query"
        table = ".".join(quoted(part) for part in self.table.split("."))
        if not self.columns and not self.where:
            return table
        wanted = list(self.columns)
        if wanted and self.split is not None and self.split.column not in wanted:
            wanted.append(self.split.column)
        names = ",".join(quoted(c) for c in wanted) or "*"
        where = f" WHERE ({self.where})" if self.where else ""
        return f"(SELECT {names} FROM {table}{where}) source_query"

    def reader_options(self) -> dict[str, str]:
        custom = {"customSchema": ", ".join(f"{quoted(n)} {t}" for n, t in self.types.items())} if self.types else {}
        return {
            "url": self.url,
            "fetchsize": str(self.fetch_rows),
            "sessionInitStatement": self.session_init(),
            **custom,
            **self.options,
        }

    def load(self, spark: SparkSession, relation: str, predicates: list[str] | None = None) -> DataFrame:
        """Spark's reader over a table expression; a task per predicate."""
        options = self.reader_options()
        if predicates is None:
            return spark.read.format("jdbc").options(dbtable=relation, **options).load()
        return spark.read.jdbc(options.pop("url"), relation, predicates=predicates, properties=options)

    def frame(self, spark: SparkSession, **views: DataFrame) -> DataFrame:
        """One Spark task per slice predicate; the scan still takes pushed filters."""
        if views:
            raise SyncError.config("a query runs in the database, which knows no views of the job")
        if self.split is None:
            df = self.load(spark, self.relation())
        else:
            df = self.load(spark, self.relation(), self.split.predicates())
            check_split_column(df.schema, self.split)
            df = df.select(*[column(c) for c in self.columns]) if self.columns else df
        check_declared(df.schema, self.declared)
        return df

    def slices(self, spark: SparkSession) -> list[DataFrame]:
        """A reader per slice: its predicate stands in the statement, next to ``where``."""
        if self.split is None:
            return [self.frame(spark)]
        self.frame(spark)  # checks the split column
        both = lambda p: f"({self.where}) AND ({p})" if self.where else p
        return [replace(self, split=None, where=both(p)).frame(spark) for p in self.split.predicates()]

    def check_files(self, spark: SparkSession) -> None:
        """A database keeps its own snapshots; there are no files to look at."""
