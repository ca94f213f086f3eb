"""A fixed set of source files for all groups of a copy.

What is in a folder may change while a copy of many groups runs. A snapshot is the list of data files with their sizes and modification
times, taken from Spark's own hidden file columns when the copy is planned. Every group reads that list, so files that come
later belong to none; and before a group becomes visible the files are looked at again, so no group is committed from a file that
was replaced or removed meanwhile.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from exactsync.errors import SyncError


@dataclass(frozen=True)
class Snapshot:
    """The files of a Parquet folder at one moment: (path, bytes, modification time in microseconds), by path."""

    root: str
    files: tuple[tuple[str, int, int], ...]
    schema: T.StructType

    @classmethod
    def take(cls, spark: SparkSession, root: str) -> "Snapshot":
        rows = spark.read.parquet(root)
        return cls(root, _states(rows), rows.schema)

    def frame(self, spark: SparkSession) -> DataFrame:
        """All rows of the files, with the columns the folder had."""
        if not self.files:
            return spark.createDataFrame([], self.schema)
        return self._reader(spark).parquet(*self._paths())

    def check(self, spark: SparkSession) -> None:
        """Fail if a file is not what it was."""
        if not self.files:
            return
        try:
            now = _states(self._reader(spark).parquet(*self._paths()))
        except PySparkException as e:
            raise SyncError("SOURCE_CHANGED", f"files of {self.root} are gone: {str(e).splitlines()[0]}") from e
        changed = sorted(set(self.files) - set(now))
        if changed:
            raise SyncError("SOURCE_CHANGED", f"{len(changed)} files of {self.root} were replaced, {changed[0][0]} first")

    def _paths(self) -> Sequence[str]:
        return [path for path, _, _ in self.files]

    def _reader(self, spark: SparkSession):
        # Partition columns come from the folder names below the root.
        return spark.read.schema(self.schema).option("basePath", self.root)


def _states(rows: DataFrame) -> tuple[tuple[str, int, int], ...]:
    """One row per file that has rows; no column of the data is read."""
    state = rows.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_size").alias("size"),
        F.unix_micros(F.col("_metadata.file_modification_time")).alias("changed"),
    )
    return tuple(sorted(tuple(r) for r in state.distinct().collect()))
