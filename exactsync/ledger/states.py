"""Ledger questions answered over its two tables, ``runs`` and append-only ``batch_events``.

All of it is grouping and joining by run, batch, label or request id. Groupings combine
map-side, so a run with a third of all batches does not land on one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from exactsync.errors import SyncError
from exactsync.functions.text import batch_label

# The states of batches and runs, and the label states a target reports.
INTENT, CONFIRMED, NOT_COMMITTED, UNKNOWN = "INTENT", "CONFIRMED", "NOT_COMMITTED", "UNKNOWN"
PENDING_STATES = (INTENT, UNKNOWN)
TERMINAL_STATES = ("SUCCEEDED", "FAILED", "CANCELLED", "INTERRUPTED")
LABEL_VISIBLE, LABEL_ABORTED, LABEL_UNKNOWN = "VISIBLE", "ABORTED", "UNKNOWN"
LABEL_IN_FLIGHT = ("PREPARE", "COMMITTED")
HOOK_STAGES = ("pre_sql", "post_sql")

DEFAULT_PAGE, MAX_PAGE = 50, 500

RUNS_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("request_id", T.StringType()),
        T.StructField("fingerprint", T.StringType()),
        T.StructField("state", T.StringType(), False),
        T.StructField("stage", T.StringType(), False),
        T.StructField("created_at", T.TimestampType(), False),
        T.StructField("updated_at", T.TimestampType(), False),
        T.StructField("rows_read", T.LongType()),
        T.StructField("bytes_read", T.LongType()),
        T.StructField("rows_submitted", T.LongType()),
        T.StructField("rows_committed", T.LongType()),
        T.StructField("rows_filtered", T.LongType()),
        T.StructField("server_affected_rows", T.LongType()),
        T.StructField("batches_committed", T.LongType()),
        T.StructField("partial_write", T.BooleanType()),
        T.StructField("commit_unknown", T.BooleanType()),
        T.StructField("error", T.StringType()),
        T.StructField("config", T.StringType()),
        T.StructField("seq", T.LongType()),
    ]
)
EVENTS_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("batch_id", T.LongType(), False),
        T.StructField("state", T.StringType(), False),
        T.StructField("rows", T.LongType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("label", T.StringType()),
        T.StructField("loaded", T.LongType()),
        T.StructField("filtered", T.LongType()),
        T.StructField("affected", T.LongType()),
        T.StructField("detail", T.StringType()),
        T.StructField("ts", T.TimestampType(), False),
        T.StructField("seq", T.LongType()),
    ]
)


def _latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys and c not in order]
    newest = F.max(F.struct(*order, *rest)).alias("_e")
    grouped = df.groupBy(*keys).agg(newest)
    return grouped.select(*[F.col(c) if c in keys else F.col("_e")[c].alias(c) for c in df.columns])


def current_batches(events: DataFrame, tie: str | None = None) -> DataFrame:
    """Latest event per batch, by time and then by the ``tie`` column."""
    return _latest(events, ["run_id", "batch_id"], ["ts", tie] if tie else ["ts"])


def current_runs(runs: DataFrame) -> DataFrame:
    """Latest row per run of an append-only ``runs`` table."""
    return _latest(runs, ["run_id"], ["seq"])


def confirm(batches: DataFrame, receipts: DataFrame) -> DataFrame:
    """Verdict per receipt: a batch is confirmed only from INTENT, and only once.

    Further receipts of the same batch are errors, as are those of batches never announced.
    """
    keys = ["run_id", "batch_id"]
    counted = receipts.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_receipts"))
    joined = counted.join(batches.select(*keys, F.col("state").alias("batch_state")), keys, "left")
    accepted = F.when(F.col("batch_state") == INTENT, 1).otherwise(0)
    return joined.select(
        *keys,
        "batch_state",
        accepted.cast("bigint").alias("confirmed"),
        (F.col("n_receipts") - accepted).cast("bigint").alias("refused"),
    )


def rejected_state(commit_unknown: Column) -> Column:
    """State of a failed batch."""
    return F.when(F.coalesce(commit_unknown, F.lit(False)), UNKNOWN).otherwise(NOT_COMMITTED)


def reconcile(batches: DataFrame, labels: DataFrame, max_filter_ratio: float = 0.0) -> DataFrame:
    """What to do with each pending batch, given the label states found in the target.

    Visible data is confirmed, unless filtering was allowed and no counters survive; aborted
    data may be sent again under the same label; an unfinished commit is waited for; anything
    else stays unknown.
    """
    pending = batches.where(F.col("state").isin(*PENDING_STATES)).select("run_id", "batch_id", "rows", "label")
    found = labels.select(
        "label", "label_state", F.col("loaded").alias("_loaded"), F.coalesce("filtered", F.lit(0)).alias("_filtered")
    )
    state, loaded, filtered = F.col("label_state"), F.col("_loaded"), F.col("_filtered")
    complete = (loaded + filtered == F.col("rows")) & ((filtered == 0) | F.lit(max_filter_ratio > 0.0))
    believable = F.when(loaded.isNull(), F.lit(max_filter_ratio == 0.0)).otherwise(complete)
    action = (
        F.when((state == LABEL_VISIBLE) & believable, "CONFIRM")
        .when(state == LABEL_ABORTED, "RETRY")
        .when(state.isin(*LABEL_IN_FLIGHT), "WAIT")
        .otherwise("COMMIT_UNKNOWN")
    )
    joined = pending.join(found, "label", "left").withColumn("action", action)
    confirmed = F.when(F.col("action") == "CONFIRM", F.coalesce(loaded, F.col("rows")))
    return joined.withColumn("loaded", confirmed).drop("_loaded", "_filtered")


def rollup(batches: DataFrame) -> DataFrame:
    """Counters per run from the current state of its batches."""
    confirmed = F.col("state") == CONFIRMED
    total = lambda c: F.coalesce(F.sum(F.when(confirmed, F.col(c))), F.lit(0)).cast("bigint")
    return batches.groupBy("run_id").agg(
        F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("rows_submitted"),
        total("loaded").alias("rows_committed"),
        total("filtered").alias("rows_filtered"),
        total("affected").alias("server_affected_rows"),
        F.count_if(confirmed).alias("batches_committed"),
        F.max(F.col("state").isin(*PENDING_STATES)).alias("pending"),
    )


def pending_runs(batches: DataFrame) -> DataFrame:
    """Runs with a batch whose outcome is open."""
    return batches.where(F.col("state").isin(*PENDING_STATES)).select("run_id").distinct()


def with_flags(runs: DataFrame, counters: DataFrame) -> DataFrame:
    """Terminal flags: something was written although the run failed; the outcome is open.

    ``runs`` brings ``run_id``, ``state`` and ``error_unknown``.
    """
    known = runs.select("run_id", "state", "error_unknown")
    joined = known.join(counters.select("run_id", "rows_committed", "pending"), "run_id", "left")
    committed = F.coalesce("rows_committed", F.lit(0))
    pending = F.coalesce("pending", F.lit(False))
    return joined.select(
        "run_id",
        "state",
        committed.alias("rows_committed"),
        ((F.col("state") != "SUCCEEDED") & (committed > 0)).alias("partial_write"),
        (pending | F.coalesce("error_unknown", F.lit(False))).alias("commit_unknown"),
    )


def interrupt(runs: DataFrame, counters: DataFrame) -> DataFrame:
    """Runs after a restart: unfinished ones are interrupted and never resumed.

    ``runs`` brings ``run_id``, ``state``, ``stage``, ``hooks`` (number of statements of its
    hook stage) and the flags it had.
    """
    known = runs.select("run_id", "state", "stage", "hooks", "commit_unknown", "partial_write")
    joined = known.join(counters.select("run_id", "rows_committed", "pending"), "run_id", "left")
    open_run = ~F.col("state").isin(*TERMINAL_STATES)
    in_hooks = F.col("stage").isin(*HOOK_STAGES) & (F.col("hooks") > 0)
    pending = F.coalesce("pending", F.lit(False))
    committed = F.coalesce("rows_committed", F.lit(0))
    return joined.select(
        "run_id",
        F.when(open_run, "INTERRUPTED").otherwise(F.col("state")).alias("state"),
        "stage",
        F.when(open_run, pending | in_hooks).otherwise(F.col("commit_unknown")).alias("commit_unknown"),
        F.when(open_run, committed > 0).otherwise(F.col("partial_write")).alias("partial_write"),
    )


def request_verdicts(requests: DataFrame, runs: DataFrame, cancelled: DataFrame) -> DataFrame:
    """Verdict per incoming request: the original run, a conflict, cancelled before, or new."""
    known = runs.select("request_id", "run_id", F.col("fingerprint").alias("known_fingerprint"))
    tombs = cancelled.select("request_id").distinct().withColumn("cancelled", F.lit(True))
    joined = requests.join(known, "request_id", "left").join(tombs, "request_id", "left")
    verdict = (
        F.when(F.col("run_id").isNotNull() & (F.col("known_fingerprint") == F.col("fingerprint")), "EXISTING")
        .when(F.col("run_id").isNotNull(), "CONFLICT")
        .when(F.col("cancelled"), "REQUEST_CANCELLED")
        .otherwise("NEW")
    )
    return joined.select(
        "request_id", verdict.alias("verdict"), F.when(verdict == "EXISTING", F.col("run_id")).alias("run_id")
    )


def request_status(request_ids: DataFrame, runs: DataFrame, cancelled: DataFrame) -> DataFrame:
    """Known requests with their run and whether a cancellation was asked for."""
    tombs = cancelled.select("request_id").distinct().withColumn("_cancelled", F.lit(True))
    joined = request_ids.join(runs.select("request_id", "run_id", "state"), "request_id", "left").join(
        tombs, "request_id", "left"
    )
    known = joined.where(F.col("run_id").isNotNull() | F.col("_cancelled"))
    return known.select(
        "request_id", F.coalesce("_cancelled", F.lit(False)).alias("cancel_requested"), "run_id", "state"
    )


def runs_page(runs: DataFrame, limit: int = DEFAULT_PAGE, offset: int = 0) -> DataFrame:
    """Newest runs first. Spark keeps ``offset + limit`` rows per task, no full sort."""
    if not 1 <= limit <= MAX_PAGE:
        raise SyncError.config(f"a page has 1 to {MAX_PAGE} runs, not {limit}")
    if offset < 0:
        raise SyncError.config("a page cannot begin before the first run")
    return runs.orderBy(F.col("created_at").desc(), F.col("run_id").desc()).offset(offset).limit(limit)


def run_batches(batches: DataFrame, run_id: str) -> DataFrame:
    """Batches of one run in order of their id."""
    return batches.where(F.col("run_id") == run_id).orderBy("batch_id")


def with_labels(batches: DataFrame, prefix: str) -> DataFrame:
    return batches.withColumn("label", batch_label(prefix, F.col("run_id"), F.col("batch_id")))
