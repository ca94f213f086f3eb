"""Verifying a copy: checksums per side, exact row difference, generated test rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from exactsync.errors import SyncError
from exactsync.functions.decimals import negative_zero
from exactsync.functions.text import column


def _exact(df: DataFrame, name: str, value: Column) -> Column:
    """A value in a type whose sum is exact; floats have none."""
    kind = df.select(value.alias(name)).schema[name].dataType
    if isinstance(kind, T.DecimalType):
        return value.cast(T.DecimalType(38, kind.scale))
    if isinstance(kind, T.IntegralType):
        return value.cast(T.DecimalType(38, 0))
    raise SyncError.type(f"{name}: {kind.simpleString()} has no exact sum; sum a whole number or a decimal")


def checksum(df: DataFrame, sums: Mapping[str, Column]) -> DataFrame:
    """Row count and named sums in one pass, in each value's own scale; partial sums before the tiny shuffle."""
    wide = [F.sum(_exact(df, name, value)).alias(name) for name, value in sums.items()]
    return df.agg(F.count(F.lit(1)).alias("n_rows"), *wide)


def compare_checksums(left: DataFrame, right: DataFrame, sums: Mapping[str, Column]) -> DataFrame:
    """One row per measure with both values, as text with all their digits, and whether they agree."""
    one = lambda df, side: checksum(df, sums).select(F.lit(1).alias("_side"), F.struct("*").alias(side))
    both = one(left, "left").join(one(right, "right"), "_side")  # one row on either side
    rows = [
        F.struct(
            F.lit(n).alias("measure"),
            F.col("left")[n].cast("string").alias("left_value"),
            F.col("right")[n].cast("string").alias("right_value"),
            F.col("left")[n].eqNullSafe(F.col("right")[n]).alias("same"),
        )
        for n in ("n_rows", *sums)
    ]
    return both.select(F.explode(F.array(*rows)).alias("row")).select("row.*")


def same_value(left: Column, right: Column, kind: T.DataType) -> Column:
    """Equality that tells -0.0 from 0.0 and takes NULL and NaN as equal to themselves."""
    same = left.eqNullSafe(right)
    if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        same = same & F.coalesce(negative_zero(left) == negative_zero(right), F.lit(True))
    return same


def row_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that occur more often on one side: ``surplus`` > 0 on the left, < 0 on the right.

    One grouping over both sides with map-side counts, so repeated rows shrink before the
    shuffle; empty means the two hold the same rows. -0.0 and 0.0 are different values.
    """
    floats = [f.name for f in left.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    names = left.columns
    signs = {f"_sign_{n}": F.coalesce(negative_zero(column(n)), F.lit(False)) for n in floats}
    rows = lambda df, step: df.select(*[column(c) for c in names], F.lit(step).cast("bigint").alias("_d"))
    marked = rows(left, 1).unionAll(rows(right, -1)).withColumns(signs)
    counted = marked.groupBy(*[column(c) for c in names], *[column(c) for c in signs]).agg(F.sum("_d").alias("surplus"))
    shown = lambda c: F.when(column(f"_sign_{c}"), -0.0).otherwise(column(c)).alias(c) if c in floats else column(c)
    # Grouping shows both zeros as 0.0, so the sign is put back.
    return counted.where(F.col("surplus") != 0).select(*[shown(c) for c in names], "surplus")


def bench_columns(number: Column) -> list[Column]:
    """The benchmark row of a whole number: id, amount with four digits, short text."""
    return [
        number.cast("bigint").alias("id"),
        (number.cast("decimal(16,0)") / 10000).cast("decimal(20,4)").alias("amount"),
        F.concat(F.lit("row-"), number.cast("string")).alias("payload"),
    ]


def generate_rows(spark: SparkSession, rows: int, tasks: int | None = None) -> DataFrame:
    """Repeatable benchmark table, generated on the executors."""
    source = spark.range(0, rows, 1, tasks) if tasks else spark.range(rows)
    return source.select(*bench_columns(F.col("id")))
