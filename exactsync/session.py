"""Session settings the results depend on."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Casts must fail rather than wrap, and timestamps must not move with a local zone.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Nanoseconds of Parquet files come as whole numbers, which ``Source`` checks; without this they cannot be read.
    "spark.sql.legacy.parquet.nanosAsLong": "true",
}
# A wide guarded copy generates large methods, and HotSpot never compiles those over 8000 bytes of
# bytecode. Below this limit Spark splits the expressions into small methods instead.
PREFERRED = {"spark.sql.codegen.hugeMethodLimit": ("65535", "8000")}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a live session (all are runtime settings)."""
    for key, value in REQUIRED.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    for key, (default, better) in PREFERRED.items():
        if spark.conf.get(key, default) == default:
            spark.conf.set(key, better)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send the package's sources to the Python workers, once per application: they need them for Arrow functions."""
    context = spark.sparkContext
    if getattr(context, "_exactsync_shipped", False):
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="exactsync-src-")) / "exactsync_src.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._exactsync_shipped = True


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Only where all run on one machine a temporary one stands in."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    context = spark.sparkContext
    if getattr(context, "_exactsync_folder", None) is None:
        context._exactsync_folder = tempfile.mkdtemp(prefix="exactsync-")
    return context._exactsync_folder


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: later steps do not run what made it again."""
    path = f"{checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4()}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
