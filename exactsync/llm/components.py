"""Connected components of a distributed link table: alternating large and small stars.

Each round is a few aggregations and joins; its links are staged in the shared folder, so lineage stays short and
nothing but two sums reaches the driver. Neighbour lists are never gathered: a node's smallest neighbour is a map-side
combined minimum, and a hub's join is an ordinary join that adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from exactsync.llm.shared import staged


def _print(links: DataFrame):
    """Count and hash sum of a set of links; equal sets have equal values."""
    mixed = F.xxhash64("high", "low")
    return links.agg(
        F.count("*"), F.sum(F.shiftright(mixed, 20)), F.sum(mixed.bitwiseAND(F.lit((1 << 20) - 1)))
    ).first()


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``node`` and ``root`` (the smallest node it is linked with, directly or not) of every linked node.

    Self-links and repeated links change nothing; rows with a null end are ignored.
    """
    real = links[left].isNotNull() & links[right].isNotNull() & (links[left] != links[right])
    stars = staged(
        links.where(real).select(F.greatest(left, right).alias("high"), F.least(left, right).alias("low")).distinct(),
        "links",
    )
    seen = _print(stars)
    while seen[0]:
        both = stars.select(F.col("high").alias("u"), F.col("low").alias("v")).unionByName(
            stars.select(F.col("low").alias("u"), F.col("high").alias("v"))
        )
        smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.join(smallest, "u").where("v > u").select(F.col("v").alias("high"), F.col("m").alias("low")).distinct()
        )
        lowest = large.groupBy("high").agg(F.min("low").alias("m"))
        met = large.join(lowest, "high")
        small = (
            met.where("low > m")
            .select(F.col("low").alias("high"), F.col("m").alias("low"))
            .unionByName(lowest.select("high", F.col("m").alias("low")))
            .distinct()
        )
        stars = staged(small, "links")
        now = _print(stars)
        if now == seen:
            break
        seen = now
    roots = stars.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct()
    return stars.select(F.col("high").alias("node"), F.col("low").alias("root")).unionByName(roots)
