"""Range split of an integer column into slices that together hold every row exactly once."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal
from typing import ClassVar

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from exactsync.errors import SyncError
from exactsync.functions.text import column, quoted

# Fixed value: the most slices of a split read.
MAX_SLICES = 1024
# A stored table may have as many key ranges as file systems list folders well.
MAX_KEY_RANGES = 1 << 20
# Cuts a quantile sketch proposes for each slice, and its size: ranks are off by about 1 in 10,000.
_PROPOSED, _SKETCH = 16, 20_000


@dataclass(frozen=True)
class RangeSplit:
    """Bounds only set the stride: rows below, above or with NULL still fall into a slice."""

    most: ClassVar[int] = MAX_SLICES

    column: str
    lower: int
    upper: int
    partitions: int

    def __post_init__(self):
        quoted(self.column)
        in_range = -(2**63) <= self.lower < self.upper <= 2**64 - 1
        if not in_range or not 1 <= self.partitions <= self.most:
            raise SyncError.config("Invalid split bounds or partition count")

    @classmethod
    def over(cls, rows: DataFrame, name: str, least: int = 1, rows_each: int = 1_000_000):
        """At least ``least`` ranges over the values of a column, more as the table grows; one aggregation."""
        key = column(name)
        low, high, n = rows.agg(F.min(key), F.max(key), F.count(F.lit(1))).first()
        lower, upper = (0, 1) if low is None else (int(low), int(high) + 1)
        return cls(name, lower, upper, min(cls.most, max(least, -(-n // rows_each))))

    def cuts(self) -> list[int]:
        width, n = self.upper - self.lower, self.partitions
        return sorted({self.lower + width * i // n for i in range(1, n)})

    @property
    def slices(self) -> int:
        return len(self.cuts()) + 1

    def predicates(self) -> list[str]:
        """SQL predicates, one per slice, as a JDBC partitioned read takes them."""
        cuts, name = self.cuts(), quoted(self.column)
        if not cuts:
            return ["1=1"]
        first = f"{name} < {cuts[0]} OR {name} IS NULL"
        inner = [f"{name} >= {a} AND {name} < {b}" for a, b in zip(cuts, cuts[1:])]
        return [first, *inner, f"{name} >= {cuts[-1]}"]

    def slice_id(self) -> Column:
        """Slice number of a row, by arithmetic instead of a chain of up to 1023 comparisons."""
        value = column(self.column)
        width, n = self.upper - self.lower, self.partitions
        if n == 1:
            return F.lit(0)
        if width < n:
            # Narrower than the slice count: cuts coincide, so count them one by one.
            passed = [F.when(value >= F.lit(c), 1).otherwise(0) for c in self.cuts()]
            total = F.lit(0)
            for p in passed:
                total = total + p
            return total
        small = -(2**63) <= self.lower and self.upper < 2**63 and (width + 1) * n < 2**63
        number = (lambda v: F.lit(v).cast("bigint")) if small else (lambda v: F.lit(Decimal(v)).cast("decimal(38,0)"))
        wide = value.cast("bigint") if small else value.cast("decimal(38,0)")
        if small:
            # A decimal(20,0) column may exceed bigint; clamp it before narrowing.
            clamped = F.least(F.greatest(value, F.lit(self.lower)), F.lit(self.upper)).cast("bigint")
        else:
            clamped = F.least(F.greatest(wide, number(self.lower)), number(self.upper))
        position = clamped - number(self.lower)
        slot = F.call_function("div", (position + number(1)) * number(n) - number(1), number(width))
        last = F.lit(self.partitions - 1).cast("bigint")
        # greatest/least skip NULLs, so NULL needs its own branch.
        return F.when(value.isNull(), F.lit(0)).otherwise(F.least(slot.cast("bigint"), last).cast("int"))


@dataclass(frozen=True)
class BalancedSplit(RangeSplit):
    """A split with cuts at given values, chosen by the rows between them instead of by the width."""

    at: tuple[int, ...] = ()

    def __post_init__(self):
        super().__post_init__()
        if list(self.at) != sorted(set(self.at)) or len(self.at) + 1 > self.most:
            raise SyncError.config("cuts must increase")

    @classmethod
    def over(cls, rows: DataFrame, name: str, slices: int, where: Column | None = None) -> "BalancedSplit":
        """About ``slices`` slices of equal depth: a quantile sketch proposes many cuts, one exact count between them
        chooses. A value that fills more than a slice ends one."""
        key = column(name)
        kept = rows if where is None else rows.where(where)
        proposed = _sketched(kept, key, min(cls.most * _PROPOSED, slices * _PROPOSED))
        if not proposed:
            return cls(name, 0, 1, 1)
        # A cut before and after each proposed value: a heavy one can stand alone.
        edges = sorted({e for v in proposed for e in (v, v + 1) if -(2**63) < e < 2**63})
        place = _place_of(key, edges)
        counted = kept.where(key.isNotNull()).groupBy(place.alias("place")).agg(F.count(F.lit(1)).alias("n")).collect()
        depths = {r["place"]: r["n"] for r in counted}  # at most two per proposed cut
        cuts = _even_cuts([depths.get(n, 0) for n in range(len(edges) + 1)], edges, slices)
        return cls(name, proposed[0], max(proposed[-1], proposed[0] + 1), len(cuts) + 1, tuple(cuts))

    def cuts(self) -> list[int]:
        return list(self.at)

    def slice_id(self) -> Column:
        """Slice number of a row, by binary search over the cuts; NULL is in the first slice."""
        return F.when(column(self.column).isNull(), F.lit(0)).otherwise(_place_of(column(self.column), list(self.at)))


def _sketched(rows: DataFrame, key: Column, number: int) -> list[int]:
    """So many values at even ranks, the least and the greatest among them; the sketch is a map-side combined aggregate."""
    kind = rows.select(key.alias("k")).schema["k"].dataType
    ranks = F.array(*[F.lit(n / number) for n in range(number + 1)])
    if isinstance(kind, T.DecimalType):
        sketch = F.kll_sketch_agg_double(key.cast("double"), F.lit(_SKETCH))
        found = F.kll_sketch_get_quantile_double("s", ranks)
    else:
        sketch = F.kll_sketch_agg_bigint(key.cast("bigint"), F.lit(_SKETCH))
        found = F.kll_sketch_get_quantile_bigint("s", ranks)
    if rows.where(key.isNotNull()).isEmpty():
        return []
    values = rows.where(key.isNotNull()).agg(sketch.alias("s")).select(found.alias("q")).first()["q"]
    return sorted({int(v) for v in values})


def _place_of(value: Column, cuts: list[int]) -> Column:
    """How many of the sorted cuts are at or below the value: nested conditions, as deep as the logarithm of their number."""

    def below(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value < F.lit(cuts[middle]), below(low, middle)).otherwise(below(middle + 1, high))

    return below(0, len(cuts))


def _even_cuts(depths: list[int], edges: list[int], slices: int) -> list[int]:
    """Edges that make the slices about equally deep, where ``depths`` are the rows before, between and after the edges.

    A piece above its share ends a slice, which it has for itself but for less than half a share before it; the rest is cut
    evenly between such pieces."""
    heavy: set[int] = set()
    while True:
        rest = sum(d for n, d in enumerate(depths) if n not in heavy)
        share = rest / max(1, slices - len(heavy))
        more = {n for n, d in enumerate(depths) if d > share} - heavy
        if not more or len(heavy) + len(more) >= slices:
            break
        heavy |= more
    cuts: set[int] = set()

    def cut_evenly(first: int, end: int) -> None:
        """Cuts inside the pieces from ``first`` up to ``end``, each at the edge nearest to where it should be."""
        size, held, ends = sum(depths[first:end]), 0, []
        for n in range(first, end - 1):
            held += depths[n]
            ends.append((held, edges[n]))
        number = round(size / share) if share else 0
        for n in range(1, number):
            if ends:
                cuts.add(min(ends, key=lambda e: (abs(e[0] - size * n / number), e[1]))[1])  # noqa: B023

    start = 0
    for n in sorted(heavy):
        if n and sum(depths[start:n]) >= share / 2:
            cut_evenly(start, n)
            cuts.add(edges[n - 1])
        if sum(depths[n + 1 :]):
            cuts.add(edges[n])
        start = n + 1
    cut_evenly(start, len(depths))
    return sorted(cuts)[: MAX_SLICES - 1]


@dataclass(frozen=True)
class KeyLayout(RangeSplit):
    """Key ranges a stored table is kept in: choose as many as keep a range at a size worth rewriting."""

    most: ClassVar[int] = MAX_KEY_RANGES


def check_split_column(schema: T.StructType, split: RangeSplit) -> None:
    """The column must be a stored integer (or an unsigned 64-bit one held as decimal(20,0))."""
    fields = {f.name: f.dataType for f in schema.fields}
    t = fields.get(split.column)
    whole = isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)) or t == T.DecimalType(20, 0)
    if not whole:
        raise SyncError.config("split column must be a physical integer column")
