"""Sources: a table with projection and predicate, or one SELECT with typed bound parameters."""

from __future__ import annotations

import base64
import binascii
import math
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from decimal import Decimal, InvalidOperation

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from exactsync.errors import SyncError
from exactsync.functions.text import column
from exactsync.functions.times import bindable_year, nanos_to_instant
from exactsync.plans.mapping import check_declared
from exactsync.sources.snapshot import Snapshot
from exactsync.sources.split import RangeSplit, check_split_column


@dataclass(frozen=True)
class Parameter:
    """One bound value. Whole numbers and decimals come as text to keep every digit."""

    type: str
    value: object = None

    def bind(self) -> object:
        try:
            return _BINDERS[self.type](self.value)
        except KeyError:
            raise SyncError.config(f"Unknown parameter type {self.type}") from None
        except (ValueError, InvalidOperation, binascii.Error, TypeError) as e:
            raise SyncError.config(f"Invalid {self.type} parameter: {e}") from e


def _whole(low: int, high: int):
    def bind(value):
        number = int(value)
        if not low <= number <= high:
            raise ValueError("integer out of range")
        return number if number < 2**63 else Decimal(number)

    return bind


def _finite(value):
    number = float(value)
    if not math.isfinite(number):
        raise ValueError("not a finite number")
    return number


_BINDERS = {
    "null": lambda value: None,
    "string": str,
    "i64": _whole(-(2**63), 2**63 - 1),
    "u64": _whole(0, 2**64 - 1),
    "decimal": Decimal,
    "f64": _finite,
    "bool": lambda value: int(bool(value)),
    "binary": lambda value: bytearray(base64.b64decode(value, validate=True)),
}


def check_query(query: str) -> str:
    """The one SELECT/WITH statement of a query source, without its trailing semicolons."""
    text = query.strip().rstrip(";").rstrip()
    if not re.match(r"(select|with)\s", text, flags=re.IGNORECASE):
        raise SyncError.config("only a SELECT, with or without a WITH clause, can be read")
    return text


@dataclass(frozen=True)
class Source:
    """Either ``table``/``path`` with columns and predicate, or ``query`` alone.

    ``nanos`` names timestamp columns that Parquet files hold in nanoseconds and what they are, ``wall`` or ``instant``: they are read
    as whole numbers and come out in microseconds, and a value that has a part of a microsecond fails its row.

    With ``pin`` a job reads the files that ``path`` had when it was planned, see ``sources.snapshot``."""

    path: str | None = None
    table: str | None = None
    columns: Sequence[str] = ()
    where: str | None = None
    query: str | None = None
    params: Sequence[Parameter] = ()
    declared: Mapping[str, str] = field(default_factory=dict)
    split: RangeSplit | None = None
    nanos: Mapping[str, str] = field(default_factory=dict)
    pin: bool = False
    snapshot: Snapshot | None = None

    def pinned(self, spark: SparkSession) -> "Source":
        """The same source, bound to the files it has now."""
        self.check()
        return replace(self, snapshot=Snapshot.take(spark, self.path))

    def check_files(self, spark: SparkSession) -> None:
        """Fail if a pinned file is not what it was."""
        if self.snapshot is not None:
            self.snapshot.check(spark)

    def check(self) -> None:
        named = [x for x in (self.path, self.table, self.query) if x is not None]
        if len(named) != 1 or (self.query is not None and (self.columns or self.where)):
            raise SyncError.config("give either a query or a table with its columns and predicate")
        if (self.pin or self.snapshot is not None) and self.path is None:
            raise SyncError.config("only the files of a path can be pinned")
        if set(self.nanos.values()) - {"wall", "instant"} or (self.nanos and self.path is None):
            raise SyncError.config("nanosecond columns of files are wall or instant")
        if self.query is not None:
            check_query(self.query)
            if self.split is not None:
                raise SyncError.config("a query cannot be split into ranges; split a table")

    def frame(self, spark: SparkSession, **views: DataFrame) -> DataFrame:
        """The lazy source. ``views`` are frames a query names as ``{name}``."""
        self.check()
        if self.query is not None:
            df = run_query(spark, self.query, self.params, **views)
        else:
            base = self._base(spark)
            if self.split is not None:
                check_split_column(base.schema, self.split)
            df = base.where(self._predicate()) if self.where else base
            if self.columns:
                df = df.select(*[column(c) for c in self.columns])
        check_declared(df.schema, self.declared)
        return df

    def _base(self, spark: SparkSession) -> DataFrame:
        if self.snapshot is not None:
            base = self.snapshot.frame(spark)
        else:
            base = spark.read.parquet(self.path) if self.path is not None else spark.table(self.table)
        return base.withColumns({name: self._micros(base, name, kind) for name, kind in self.nanos.items()})

    @staticmethod
    def _micros(base: DataFrame, name: str, kind: str):
        """A column read in nanoseconds as a timestamp; what would lose digits or its year fails the row."""
        known = {f.name: f.dataType for f in base.schema.fields}.get(name)
        if not isinstance(known, T.LongType):
            raise SyncError.schema(f"{name} is not stored in nanoseconds")
        value = column(name)
        instant = nanos_to_instant(value)
        kept = F.when(bindable_year(instant), instant)
        why = F.concat(F.lit(f"TYPE: {name} has digits below a microsecond: "), value.cast("string"), F.lit(" ns"))
        failed = F.when(value.isNotNull(), F.raise_error(why).cast("timestamp"))
        exact = F.coalesce(kept, failed)
        return exact.cast("timestamp_ntz") if kind == "wall" else exact

    def _predicate(self):
        return F.expr(self.where)

    def slices(self, spark: SparkSession) -> list[DataFrame]:
        """One frame per range slice; each predicate reaches the scan next to ``where``."""
        if self.split is None:
            return [self.frame(spark)]
        base = replace(self, columns=(), declared={}).frame(spark)
        frames = [base.where(F.expr(p)) for p in self.split.predicates()]
        return [f.select(*[column(c) for c in self.columns]) for f in frames] if self.columns else frames


# Text a placeholder cannot stand in: quoted strings, quoted names and comments.
_OPAQUE = r"'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`|--[^\n]*|/\*.*?\*/"


def run_query(spark: SparkSession, query: str, params: Sequence[Parameter] = (), **views: DataFrame) -> DataFrame:
    """Spark SQL with ``?`` parameters bound, in the order of the text, as typed literals.

    They are passed to Spark by name: it binds bare ``?`` in plan order, a WHERE before its SELECT.
    """
    text, found = number_placeholders(check_query(query))
    if found != len(params):
        raise SyncError.config(f"{len(params)} values for {found} parameters")
    bound = {f"p{i}": p.bind() for i, p in enumerate(params)}
    values = {name: F.lit(None) if value is None else value for name, value in bound.items()}
    return spark.sql(text, args=values, **views) if values else spark.sql(text, **views)


def number_placeholders(query: str) -> tuple[str, int]:
    """The query with each ``?`` named ``:p0``, ``:p1``, ... and how many there were."""
    pieces = re.split(rf"({_OPAQUE}|\?)", query, flags=re.DOTALL)
    found = 0
    for i, piece in enumerate(pieces):
        if piece == "?":
            pieces[i] = f":p{found}"
            found += 1
    return "".join(pieces), found
