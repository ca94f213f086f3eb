"""Load accounting: which rows a load takes, filters out or does not select, and the ratio check."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from exactsync.errors import SyncError

VERDICT = "_verdict"
LOADED, FILTERED, UNSELECTED = "loaded", "filtered", "unselected"


def check_ratio_option(ratio: float) -> float:
    if not 0.0 <= ratio <= 1.0:
        raise SyncError.config("max filter ratio must be 0..1")
    return ratio


def with_verdict(
    df: DataFrame,
    reject: Column | None = None,
    partition: Column | None = None,
    partitions: Sequence[object] = (),
) -> DataFrame:
    """Mark each row. Rows outside the listed target partitions are not selected; of the
    selected ones those that break a target-side rule are filtered."""
    verdict = F.lit(LOADED)
    if reject is not None:
        verdict = F.when(F.coalesce(reject, F.lit(False)), FILTERED).otherwise(verdict)
    if partitions:
        inside = F.coalesce(partition.isin(list(partitions)), F.lit(False))
        verdict = F.when(~inside, UNSELECTED).otherwise(verdict)
    return df.withColumn(VERDICT, verdict)


def counters() -> list[Column]:
    """The three counts of one pass, for ``agg`` or ``observe``."""
    return [F.count_if(F.col(VERDICT) == name).alias(name) for name in (LOADED, FILTERED, UNSELECTED)]


def receipt(submitted: int, loaded: int, filtered: int, unselected: int, max_ratio: float = 0.0) -> dict:
    """Checked receipt of a load: every submitted row is accounted for, rejects stay in bounds."""
    if loaded + filtered + unselected != submitted:
        raise SyncError.unknown("Load counts disagree with the submitted rows")
    if filtered and filtered > max_ratio * (filtered + loaded):
        raise SyncError("LOAD_FILTERED", f"{filtered} rows filtered, allowed ratio {max_ratio}")
    return {"loaded": loaded, "filtered": filtered + unselected, "affected": loaded}


def receipts(counted: DataFrame, max_ratio: float) -> DataFrame:
    """The same rule over a frame with submitted/loaded/filtered/unselected columns."""
    submitted, loaded = F.col("submitted"), F.col("loaded")
    filtered, unselected = F.col("filtered"), F.col("unselected")
    state = (
        F.when(loaded + filtered + unselected != submitted, "COMMIT_UNKNOWN")
        .when(filtered.cast("double") > F.lit(max_ratio) * (filtered + loaded), "LOAD_FILTERED")
        .otherwise("OK")
    )
    return counted.withColumn("state", state).withColumn("reported_filtered", filtered + unselected)
