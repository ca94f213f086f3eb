"""Differences of two tables by a tree of checksums: only key ranges whose sums differ are looked at more closely.

A row's mark is two 64-bit hashes of all its values, which tell NULL, an empty text, NaN and both zeros apart. The marks of a range are summed
in four 32-bit parts beside the row count, so order and partitioning do not matter, repeated rows do, and sums are exact. Each level
takes one aggregation per side over the ranges that differed one level above, with their bounds as predicates that reach
the scan. The rows of the last ranges are compared as ``row_diff`` compares them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from exactsync.errors import SyncError
from exactsync.functions.decimals import negative_zero
from exactsync.functions.text import column
from exactsync.operators.verify import row_diff

FANOUT, LEAF_ROWS, MOST_RANGES = 64, 10_000, 256
_RANGE = "_range"
_PARTS = ("a", "b", "c", "d")
_LOW = (1 << 32) - 1


@dataclass(frozen=True, order=True)
class KeyRange:
    """Keys from ``low`` up to ``high``, that one not included; ``nulls`` is the range of rows without a key."""

    low: int
    high: int
    nulls: bool = False

    def holds(self, key: Column) -> Column:
        return key.isNull() if self.nulls else (key >= self.low) & (key < self.high)

    def cut(self, pieces: int) -> list["KeyRange"]:
        width = self.high - self.low
        ends = sorted({self.low + width * n // pieces for n in range(pieces + 1)})
        return [KeyRange(a, b) for a, b in zip(ends, ends[1:])]


def row_mark(schema: T.StructType) -> list[Column]:
    """Two independent 64-bit hashes of a whole row."""
    parts: list[Column] = []
    for f in schema.fields:
        value = column(f.name)
        parts += [value, value.isNull()]
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            parts.append(F.coalesce(negative_zero(value), F.lit(False)))
    return [F.xxhash64(F.lit("first"), *parts), F.xxhash64(F.lit("second"), *parts)]


def _sums(df: DataFrame, key: str, ranges: list[KeyRange]) -> DataFrame:
    """Rows and mark sums of each range; partial sums before the shuffle, one row per range after it."""
    value = column(key)
    number = F.lit(len(ranges))
    inside = F.lit(False)
    for n, r in reversed(list(enumerate(ranges))):
        number = F.when(r.holds(value), n).otherwise(number)
        inside = r.holds(value) | inside
    first, second = row_mark(df.schema)
    marked = df.where(inside).select(number.alias(_RANGE), first.alias("_m1"), second.alias("_m2"))
    halves = [F.shiftrightunsigned(m, 32) if high else F.col(m).bitwiseAND(F.lit(_LOW)) for m in ("_m1", "_m2") for high in (True, False)]
    sums = [F.sum(half).alias(name) for name, half in zip(_PARTS, halves, strict=True)]
    return marked.groupBy(_RANGE).agg(F.count(F.lit(1)).alias("n"), *sums)


def _differing(left: DataFrame, right: DataFrame, key: str, ranges: list[KeyRange]) -> list[tuple[KeyRange, int]]:
    """The ranges whose sums differ, with the rows of the larger side."""
    a, b = _sums(left, key, ranges).alias("a"), _sums(right, key, ranges).alias("b")
    same = F.lit(True)
    for name in ("n", *_PARTS):
        same = same & F.col(f"a.{name}").eqNullSafe(F.col(f"b.{name}"))
    both = a.join(b, F.col(f"a.{_RANGE}") == F.col(f"b.{_RANGE}"), "full").where(~same)
    rows = F.greatest(F.coalesce("a.n", F.lit(0)), F.coalesce("b.n", F.lit(0)))
    found = both.select(F.coalesce(f"a.{_RANGE}", f"b.{_RANGE}").alias("place"), rows.alias("rows")).collect()
    return sorted((ranges[r["place"]], r["rows"]) for r in found)


def differing_ranges(
    left: DataFrame,
    right: DataFrame,
    key: str,
    *,
    fanout: int = FANOUT,
    leaf_rows: int = LEAF_ROWS,
    most: int = MOST_RANGES,
) -> list[KeyRange]:
    """Key ranges in which the sides differ, small ones as far as they can be told apart with at most ``most`` predicates."""
    kind = left.schema[key].dataType
    if left.schema != right.schema and [(f.name, f.dataType) for f in left.schema] != [(f.name, f.dataType) for f in right.schema]:
        raise SyncError.schema("the two sides have other columns")
    if not isinstance(kind, T.IntegralType):
        raise SyncError.config("checksums go by ranges of a whole-number key")
    ends = [df.agg(F.min(column(key)), F.max(column(key))).first() for df in (left, right)]
    lows, highs = [e[0] for e in ends if e[0] is not None], [e[1] for e in ends if e[1] is not None]
    start = KeyRange(min(lows), max(highs) + 1).cut(fanout) if lows else []
    found = _differing(left, right, key, [*start, KeyRange(0, 0, True)])
    while True:
        closer = {r for r, n in found if n > leaf_rows and not r.nulls and r.high - r.low > 1}
        # Ranges that would need too many predicates stay as they are: they are compared row by row below.
        pieces = min(fanout, (most - len(found)) // len(closer)) if closer else 0
        if pieces < 2:
            return [r for r, _ in found]
        told = _differing(left, right, key, [p for r in sorted(closer) for p in r.cut(pieces)])
        found = sorted([(r, n) for r, n in found if r not in closer] + told)


def range_diff(left: DataFrame, right: DataFrame, key: str, **options) -> DataFrame:
    """``row_diff`` of the two sides, reading the rows of differing key ranges alone."""
    ranges = differing_ranges(left, right, key, **options)
    inside = F.lit(False)
    for r in _joined(ranges):
        inside = inside | r.holds(column(key))
    return row_diff(left.where(inside), right.where(inside))


def _joined(ranges: list[KeyRange]) -> list[KeyRange]:
    """Neighbouring ranges as one: fewer predicates."""
    out: list[KeyRange] = []
    for r in sorted(ranges, key=lambda r: (r.nulls, r.low)):
        if out and not r.nulls and not out[-1].nulls and out[-1].high == r.low:
            out[-1] = KeyRange(out[-1].low, r.high)
        else:
            out.append(r)
    return out
