"""Upsert as DataFrame plans: key checks, last-wins, merged result and affected-row counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from exactsync.errors import SyncError
from exactsync.functions.text import column

_SLICE, _IN, _OLD = "_slice", "_in", "_old"

# Affected rows per incoming row, as multi-row upserts report them.
NEW, CHANGED, UNCHANGED = 1, 2, 0
#: Incoming rows a slice of :func:`affected` holds, so that a task's memory does not grow with the table.
SLICE_ROWS = 250_000


def update_columns(columns: Sequence[str], keys: Sequence[str], wanted: Sequence[str] = ()) -> list[str]:
    """Columns an upsert sets on a matching key: the wanted ones, else all mapped non-keys."""
    if not keys:
        raise SyncError.config("an upsert finds rows by key, and no key is given")
    for name in [*keys, *wanted]:
        if name not in columns:
            raise SyncError.config(f"{name} is a key or is to be updated, but nothing is mapped to it")
    if set(wanted) & set(keys):
        raise SyncError.config("a key cannot be updated")
    updates = list(wanted) or [c for c in columns if c not in keys]
    if not updates:
        raise SyncError.config("all mapped columns are keys, so there is nothing to update")
    return updates


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count; counted map-side first."""
    counted = df.groupBy(*[column(k) for k in keys]).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.where(F.col("n_rows") > 1)


def insert_conflicts(incoming: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Incoming rows whose key the target already holds; only target keys are read."""
    return incoming.join(target.select(*[column(k) for k in keys]), list(keys), "left_semi")


def last_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the last by ``order`` (which must be total within a key).

    Spark keeps only the best row per key and task before the shuffle (WindowGroupLimit), so
    a key with a third of all rows costs one row per task.
    """
    w = W.partitionBy(*[column(k) for k in keys]).orderBy(*[column(o).desc_nulls_last() for o in order])
    return df.withColumn("_nth", F.row_number().over(w)).where(F.col("_nth") == 1).drop("_nth")


def collapse(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], updates: Sequence[str]
) -> DataFrame:
    """One incoming row per key, as writing the rows one by one would leave it.

    Update columns end with the last row's values. Other columns are only set by the first
    row, and only when the key is new.
    """
    kept = [c for c in columns if c not in keys and c not in updates]
    if not kept:
        return last_wins(df, keys, order).select(*[column(c) for c in columns])
    at = F.struct(*[column(o) for o in order])
    grouped = df.groupBy(*[column(k) for k in keys]).agg(
        F.max_by(F.struct(*[column(c) for c in updates]), at).alias("_last"),
        F.min_by(F.struct(*[column(c) for c in kept]), at).alias("_first"),
    )
    pick = lambda c: column(c) if c in keys else F.col("_last" if c in updates else "_first")[c].alias(c)
    return grouped.select(*[pick(c) for c in columns])


def upsert(
    target: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    updates: Sequence[str] | None = None,
    effect: str | None = None,
    defaults: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Target after the upsert. ``incoming`` holds each key once (see :func:`collapse`).

    One full outer join, so each side is read once whatever its size. Target columns that ``incoming`` lacks
    stay; for new keys they take their value in ``defaults``, else NULL.
    ``effect`` names an extra column: affected rows of the incoming row, NULL without one.
    """
    names, fill = incoming.columns, defaults or {}
    updates = update_columns(names, keys, updates or ())
    t = target.select(*[column(k) for k in keys], F.struct(*[column(c) for c in target.columns]).alias(_OLD))
    i = incoming.select(*[column(k) for k in keys], F.struct(*[column(c) for c in names]).alias(_IN))
    joined = t.join(i, list(keys), "full_outer")
    merged = [_merged(c, names, keys, updates, fill.get(c)) for c in target.columns]
    return joined.select(*merged, *_effect(updates, effect))


def _effect(updates: Sequence[str], name: str | None) -> list[Column]:
    if name is None:
        return []
    same = F.lit(True)
    for c in updates:
        same = same & F.col(_OLD)[c].eqNullSafe(F.col(_IN)[c])
    value = F.when(F.col(_OLD).isNull(), NEW).when(same, UNCHANGED).otherwise(CHANGED)
    return [F.when(F.col(_IN).isNotNull(), value).cast("bigint").alias(name)]


def _merged(
    name: str, names: Sequence[str], keys: Sequence[str], updates: Sequence[str], default: Column | None
) -> Column:
    if name in keys:
        return column(name)
    old = F.col(_OLD)[name]
    if name not in names:
        return (old if default is None else F.when(F.col(_OLD).isNull(), default).otherwise(old)).alias(name)
    new = F.col(_IN)[name]
    if name in updates:
        return F.when(F.col(_IN).isNotNull(), new).otherwise(old).alias(name)
    return F.when(F.col(_OLD).isNull(), new).otherwise(old).alias(name)


def affected(
    incoming: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    updates: Sequence[str],
    order: Sequence[str],
) -> DataFrame:
    """Per key: incoming rows and how many are new, changed (counting 2) and unchanged.

    Rows with the same key apply one after the other. A hot key is cut into range slices:
    within a slice neighbours are compared locally, then one summary row per slice is chained.
    There are as many slices and tasks as the rows need (they are counted first), whatever the session's number of shuffle partitions.
    """
    n = max(incoming.sparkSession.sparkContext.defaultParallelism, -(-incoming.count() // SLICE_ROWS))
    key_cols = [column(k) for k in keys]
    values = F.struct(*[column(u) for u in updates])
    at = F.struct(*[column(o) for o in order])
    ranged = incoming.repartitionByRange(n, *key_cols, *[column(o) for o in order])
    rows = ranged.select(*key_cols, values.alias(_IN), at.alias("_at"), F.spark_partition_id().alias(_SLICE))
    w = W.partitionBy(*key_cols, _SLICE).orderBy("_at")
    compared = rows.repartition(n, *key_cols, _SLICE).withColumn("_before", F.lag(F.struct(_IN)).over(w))
    pieces = compared.groupBy(*key_cols, _SLICE).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count_if(F.col("_before").isNotNull() & ~F.col("_before")[_IN].eqNullSafe(F.col(_IN))).alias("_changed"),
        F.min_by(_IN, "_at").alias("_head"),
        F.max_by(_IN, "_at").alias("_tail"),
    )
    chain = W.partitionBy(*key_cols).orderBy(_SLICE)
    old = target.select(*key_cols, F.struct(values.alias(_IN)).alias(_OLD))
    chained = pieces.repartition(n, *key_cols).withColumn("_prior", F.lag(F.struct(F.col("_tail").alias(_IN))).over(chain))
    linked = chained.join(old, list(keys), "left")
    prior = F.coalesce("_prior", _OLD)
    summed = linked.withColumn("_fresh", prior.isNull()).withColumn(
        "_turn", prior.isNotNull() & ~prior[_IN].eqNullSafe(F.col("_head"))
    )
    per_key = summed.groupBy(*key_cols).agg(
        F.sum("_rows").alias("incoming_rows"),
        F.count_if("_fresh").alias("new_rows"),
        (F.sum("_changed") + F.count_if("_turn")).alias("changed_rows"),
    )
    return per_key.withColumn(
        "affected_rows", F.col("new_rows") * NEW + F.col("changed_rows") * CHANGED
    )
