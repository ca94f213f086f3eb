"""Mapping a source schema onto a target schema: checks on the driver, expressions for executors."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from exactsync.errors import SyncError
from exactsync.functions.casts import exact_cast, lost
from exactsync.functions.text import column, quoted
from exactsync.functions.times import offset_seconds
from exactsync.types import ColumnType, compatible, of_field, of_sql

#: Column of :meth:`MappingPlan.marked` that says why the target cannot take a row.
PROBLEM = "_problem"

SEMANTICS = "each commit group stands by itself: groups already visible stay if a later one fails, and a failed run is not continued"


@dataclass(frozen=True)
class TargetColumn:
    name: str
    type: ColumnType
    nullable: bool = True
    has_default: bool = False
    default: object = None
    generated: bool = False
    key: bool = False

    @classmethod
    def sql(cls, name: str, sql_type: str, **options) -> "TargetColumn":
        return cls(name, of_sql(sql_type), **options)

    @classmethod
    def from_field(cls, f: T.StructField) -> "TargetColumn":
        meta = f.metadata or {}
        return cls(
            f.name,
            of_field(f),
            f.nullable,
            bool(meta.get("has_default", False)),
            meta.get("default"),
            bool(meta.get("generated", False)),
            bool(meta.get("key", False)),
        )

    def struct_field(self) -> T.StructField:
        flags: dict = {"key": self.key, "generated": self.generated, "has_default": self.has_default}
        extra = {name: True for name, on in flags.items() if on}
        if self.default is not None:
            extra["default"] = self.default
        return self.type.field(self.name, self.nullable, extra)


def check_declared(schema: T.StructType, declared: Mapping[str, str]) -> None:
    """Named output columns must have exactly the declared type."""
    fields = {f.name: f for f in schema.fields}
    for name, ddl in declared.items():
        if name not in fields:
            raise SyncError.schema(f"the source has no column {name}, for which a type is declared")
        expected = T._parse_datatype_string(ddl)
        if fields[name].dataType != expected:
            received = fields[name].dataType.simpleString()
            raise SyncError.type(f"{name}: expected {expected.simpleString()}, received {received}")


def check_unchanged(planned: T.StructType, actual: T.StructType) -> None:
    """Column count, order, names and types as planned; nullability may differ."""
    shape = lambda s: [(f.name, f.dataType) for f in s.fields]
    if shape(planned) != shape(actual):
        raise SyncError("SCHEMA_CHANGED", "the source no longer has the columns it was planned with")


@dataclass(frozen=True)
class MappingPlan:
    """Checked pairs of source field and target column, in output order."""

    pairs: tuple[tuple[T.StructField, TargetColumn], ...]
    target: tuple[TargetColumn, ...]
    offset: int = 0
    source_schema: T.StructType = field(default_factory=T.StructType)

    def _converted(self, src: T.StructField, dst: TargetColumn) -> tuple[Column, Column]:
        raw = column(src.name)
        return raw, exact_cast(raw, of_field(src), dst.type, self.offset)

    @staticmethod
    def _problems(src: T.StructField, dst: TargetColumn, raw: Column) -> list[Column]:
        """Why a value that came out NULL cannot be written; NULL where that is no problem."""
        out = []
        if not dst.type.covers(of_field(src)) and of_field(src).kind != "null":
            why = F.lit(f"TYPE: {dst.name} cannot hold exactly as {dst.type.describe()}: ")
            out.append(F.when(raw.isNotNull(), F.concat(why, raw.cast("string"))))
        if not dst.nullable:
            out.append(F.lit(f"TYPE: NULL in required column {dst.name}"))
        return out

    def columns(self) -> list[Column]:
        """Guarded output columns. They must be the last projection before the write."""
        out = []
        for src, dst in self.pairs:
            raw, value = self._converted(src, dst)
            problems = self._problems(src, dst, raw)
            checks = [F.when(why.isNotNull(), F.raise_error(why).cast(dst.type.spark)) for why in problems]
            guarded = F.coalesce(value, *checks) if checks else value
            out.append(guarded.alias(dst.name, metadata=dst.struct_field().metadata))
        return out

    def marked(self, df: DataFrame, fill_omitted: bool = False, *carried: Column) -> DataFrame:
        """Like :meth:`apply`, but a row the target cannot take gets the first reason in ``_problem`` and fails nothing.

        ``carried`` are further named columns of ``df`` to keep."""
        check_unchanged(self.source_schema, df.schema)
        both = []
        for n, (src, dst) in enumerate(self.pairs):
            raw, value = self._converted(src, dst)
            both += [raw.alias(f"_raw{n}"), value.alias(f"_value{n}")]
        converted = df.select(*carried, *both)
        out, problems = [F.col(c) for c in converted.columns if not c.startswith(("_raw", "_value"))], []
        for n, (src, dst) in enumerate(self.pairs):
            raw, value = F.col(f"_raw{n}"), F.col(f"_value{n}")
            out.append(value.alias(dst.name, metadata=dst.struct_field().metadata))
            problems += [F.when(value.isNull(), why) for why in self._problems(src, dst, raw)]
        problem = F.coalesce(*problems) if problems else F.lit(None).cast("string")
        return converted.select(*out, *(self.omitted_columns() if fill_omitted else []), problem.alias(PROBLEM))

    def omitted_columns(self) -> list[Column]:
        """Writable target columns the mapping leaves out: their default, else NULL."""
        mapped = {dst.name for _, dst in self.pairs}
        return [
            F.lit(t.default if t.has_default else None).cast(t.type.spark).alias(t.name)
            for t in self.target
            if t.name not in mapped and not t.generated
        ]

    def apply(self, df: DataFrame, fill_omitted: bool = False) -> DataFrame:
        check_unchanged(self.source_schema, df.schema)
        return df.select(*self.columns(), *(self.omitted_columns() if fill_omitted else []))

    def failures(self) -> Column:
        """Array of the target columns that could not take the row's values."""
        marks = []
        for src, dst in self.pairs:
            raw, value = self._converted(src, dst)
            bad = lost(raw, value) if dst.nullable else value.isNull()
            marks.append(F.when(bad, F.lit(dst.name)))
        return F.array_compact(F.array(*marks)) if marks else F.array().cast("array<string>")

    def violations(self, df: DataFrame, label: str = "failed_columns") -> DataFrame:
        """Source rows that would fail the copy, with the columns at fault."""
        return df.withColumn(label, self.failures()).where(F.size(label) > 0)

    def violation_counts(self, df: DataFrame) -> DataFrame:
        """One row: per target column, how many rows it cannot take."""
        counts = []
        for src, dst in self.pairs:
            raw, value = self._converted(src, dst)
            bad = lost(raw, value) if dst.nullable else value.isNull()
            counts.append(F.count_if(bad).alias(dst.name))
        return df.agg(*counts)

    def output_schema(self) -> T.StructType:
        return T.StructType([dst.struct_field() for _, dst in self.pairs])

    def report(self) -> dict:
        """What a dry run tells: both schemas and the commit semantics."""
        describe = lambda name, t, nullable: {"name": name, "type": t.describe(), "nullable": nullable}
        return {
            "valid": True,
            "source_schema": [describe(f.name, of_field(f), f.nullable) for f in self.source_schema.fields],
            "target_schema": [describe(t.name, t.type, t.nullable) for _, t in self.pairs],
            "semantics": SEMANTICS,
        }


def plan_mapping(
    source: T.StructType,
    target: Sequence[TargetColumn] | T.StructType,
    mapping: Iterable[tuple[str, str]] = (),
    time_zone: str = "+00:00",
) -> MappingPlan:
    """Check and order ``(source, target)`` name pairs; no pairs means every column by name.

    Names are matched case-sensitively, whatever the session's case setting.
    """
    if isinstance(target, T.StructType):
        target = [TargetColumn.from_field(f) for f in target.fields]
    wanted = list(mapping) or [(f.name, f.name) for f in source.fields]
    fields = {f.name: f for f in source.fields}
    columns = {t.name: t for t in target}
    seen: set[str] = set()
    pairs = []
    for source_name, target_name in wanted:
        quoted(source_name), quoted(target_name)
        if target_name in seen:
            raise SyncError.config(f"two mappings write {target_name}")
        seen.add(target_name)
        if source_name not in fields:
            raise SyncError.schema(f"the mapping reads {source_name}, which the source lacks")
        if target_name not in columns:
            raise SyncError.schema(f"the mapping writes {target_name}, which the target lacks")
        src, dst = fields[source_name], columns[target_name]
        if dst.generated:
            raise SyncError.schema(f"{target_name} is computed by the target and takes no values")
        if not compatible(of_field(src), dst.type):
            raise SyncError.type(
                f"{target_name}: incompatible {of_field(src).describe()} -> {dst.type.describe()}; "
                "select a converted value in the source instead"
            )
        pairs.append((src, dst))
    for t in target:
        if not (t.generated or t.has_default or t.nullable or t.name in seen):
            raise SyncError.schema(f"nothing is mapped to {t.name}, which allows no NULL and has no default")
    return MappingPlan(tuple(pairs), tuple(target), offset_seconds(time_zone), source)
