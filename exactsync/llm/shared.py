"""Helpers the operators share: session set-up, staged tables, hash columns and sorted runs."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from exactsync.session import checkpoint_dir, configure

# ASCII white space: space and the characters 0x09 to 0x0D.
SPACES = " \t\n\x0b\x0c\r"
_ARROW_ROWS = "2000"


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of the package, and smaller Arrow batches, as texts are long."""
    configure(spark)
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", _ARROW_ROWS)
    return spark


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4()}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(column: Column) -> Column:
    """A-Z to a-z and nothing else; ``lower`` is the same on pure ASCII and much faster than ``translate``."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    plain = F.octet_length(column) == F.char_length(column)
    return F.when(plain, F.lower(column)).otherwise(F.translate(column, upper, upper.lower()))


def digest(*columns: Column) -> list[Column]:
    """128 bits of hash as two longs (the second under another seed)."""
    return [F.xxhash64(*columns), F.xxhash64(F.lit("second"), *columns)]


def partition_count(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables with all rows of each key, from a partition sorted by ``keys``; several keys may share a table.

    The rows of the last key in a batch wait for the next batch, so memory holds one batch and one key.
    """
    waiting: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        first_key = tuple(batch.column(k)[0].as_py() for k in keys)
        end_key = tuple(batch.column(k)[batch.num_rows - 1].as_py() for k in keys)
        if last is not None and first_key != last:
            yield pa.Table.from_batches(waiting)
            waiting = []
        cut = 0
        if end_key != first_key:
            cut = _last_change(batch, keys)
            waiting.append(batch.slice(0, cut))
            yield pa.Table.from_batches(waiting)
            waiting = []
        waiting.append(batch.slice(cut))
        last = end_key
    if waiting:
        yield pa.Table.from_batches(waiting)


def boundaries(table: pa.Table, keys: list[str]):
    """Start offsets of the runs of equal keys, and the number of rows at the end."""
    import numpy as np

    changed = np.zeros(table.num_rows, dtype=bool)
    changed[0] = True
    for key in keys:
        values = table.column(key).to_numpy()
        changed[1:] |= values[1:] != values[:-1]
    return np.append(np.flatnonzero(changed), table.num_rows)


def _last_change(batch: pa.RecordBatch, keys: list[str]) -> int:
    return int(boundaries(pa.Table.from_batches([batch]), keys)[-2])
