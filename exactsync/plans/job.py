"""A copy job: source frame -> checked mapping -> committed groups -> ledger receipts."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, fields, is_dataclass, replace
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession

from exactsync.errors import SyncError, prevailing
from exactsync.functions.sizes import fixed_row_bytes, guard_row_bytes, row_bytes
from exactsync.functions.text import check_label_prefix, column
from exactsync.ledger.store import Ledger
from exactsync.operators.batching import DEFAULT_MAX_ROW_BYTES, Limits
from exactsync.operators.upsert import update_columns
from exactsync.plans.dealt import DealtGroup, deal, dealt_rows
from exactsync.plans.mapping import MappingPlan, plan_mapping
from exactsync.session import configure
from exactsync.sinks.catalog import CatalogTarget
from exactsync.sinks.dataset import ParquetTarget, Receipt
from exactsync.sinks.hooks import Hook, run_hooks
from exactsync.sinks.jdbc import JdbcTarget
from exactsync.sources.jdbc import JdbcSource
from exactsync.sources.table import Source

# Bounds of the retry and parallelism options.
MAX_RETRIES = 16
MAX_PARALLEL_GROUPS = 32
MAX_BACKOFF_EXPONENT = 10

#: Writes a group under a label, announcing it before it becomes visible.
Write = Callable[[str, Callable[[int, int], None]], Receipt]


@dataclass(frozen=True)
class SyncJob:
    """Each slice of the source's split is one commit group: it becomes visible at once and keeps standing if a later one fails.

    By default a Spark job and a scan copy each slice, for sources that prune by its predicate. With ``single_scan`` one
    write deals all rows to their groups (``plans.dealt``) and the groups are committed one by one from its files. After a failure
    no further group starts, unless appended groups are to ``keep_going``. ``gather`` shuffles the rows of a group together
    before that write, for many groups of rows in no order."""

    source: Source | JdbcSource
    target: ParquetTarget | CatalogTarget | JdbcTarget
    mapping: Sequence[tuple[str, str]] = ()
    updates: Sequence[str] = ()
    order: Sequence[str] = ()
    time_zone: str = "+00:00"
    label_prefix: str = "exactsync"
    pre_sql: Sequence[Hook] = ()
    post_sql: Sequence[Hook] = ()
    reject: Column | None = None
    partition: Column | None = None
    partitions: Sequence[object] = ()
    max_filter_ratio: float = 0.0
    max_row_bytes: int = DEFAULT_MAX_ROW_BYTES
    limits: Limits | None = None
    writers: int | None = None
    parallel_groups: int = 1
    single_scan: bool = False
    keep_going: bool = False
    gather: bool = False
    retries: int = 2
    backoff_ms: int = 200
    request_id: str | None = None
    views: Mapping[str, DataFrame] = field(default_factory=dict)
    extra_config: Mapping[str, object] = field(default_factory=dict)

    def plan(self, spark: SparkSession) -> MappingPlan:
        """All checks that need no data: types, names, keys, options."""
        configure(spark)
        check_label_prefix(self.label_prefix)
        if not 0 <= self.retries <= MAX_RETRIES:
            raise SyncError.config(f"retries must be 0..{MAX_RETRIES}")
        if self.writers is not None and self.writers < 1:
            raise SyncError.config("writers must be positive")
        plan = plan_mapping(
            self.source.frame(spark, **self.views).schema, self.target.columns, self.mapping, self.time_zone
        )
        names = [dst.name for _, dst in plan.pairs]
        if self.target.model == "upsert":
            update_columns(names, self.target.keys, self.updates)
        elif self.updates or self.order:
            raise SyncError.config("update and order columns require upsert")
        if not 1 <= self.parallel_groups <= MAX_PARALLEL_GROUPS:
            raise SyncError.config(f"parallel_groups must be 1..{MAX_PARALLEL_GROUPS}")
        if self.target.model != "append" and self.parallel_groups > 1:
            raise SyncError.config("only append groups can be committed in parallel: others depend on the stored keys")
        if self.single_scan and (self.source.split is None or self.limits is not None):
            raise SyncError.config("a single scan deals the slices of a split, without batch limits")
        if self.keep_going and self.target.model != "append":
            raise SyncError.config("only appended groups do not depend on one that failed")
        if self.gather and not self.single_scan:
            raise SyncError.config("rows are gathered for a single scan only")
        if self.partitions and self.partition is None:
            raise SyncError.config("a list of partitions needs the partition expression")
        if self.target.model == "upsert" and self.limits is not None:
            raise SyncError.config("batch limits apply to append and insert")
        self.target.check_contract(spark)
        writable = [c.name for c in self.target.columns if not c.generated]
        if self.target.full_row and set(writable) - set(names):
            raise SyncError.config("full rows are asked for, but some columns the target stores are not mapped")
        for key in self.target.keys:
            if key not in names:
                raise SyncError.config(f"nothing is mapped to the key column {key}")
        return plan

    def transform(self, frame: DataFrame, plan: MappingPlan) -> DataFrame:
        """Guarded target columns of one source frame, lazily. Upserts keep to mapped columns."""
        if self.writers is not None:
            # Only for sources that arrive in too few partitions: it moves every row once.
            frame = frame.repartition(self.writers)
        flat = fixed_row_bytes(frame.schema)
        if flat is None or flat > self.max_row_bytes:
            # The guard is consumed by a filter that keeps every row it does not fail on.
            frame = frame.where(guard_row_bytes(row_bytes(frame.schema), self.max_row_bytes) >= 0)
        return plan.apply(frame, fill_omitted=self.target.model != "upsert")

    def config(self) -> dict:
        """What identifies the request: every option that can change its outcome. Secrets are redacted in the ledger."""
        describe = lambda c: None if c is None else str(c)
        return {
            "source": {k: plain_value(v) for k, v in vars(self.source).items() if v},
            "target": {"root": self.target.root, "full_row": self.target.full_row, **self.target.contract()},
            "mapping": [list(pair) for pair in self.mapping],
            "updates": list(self.updates),
            "order": list(self.order),
            "time_zone": self.time_zone,
            "label_prefix": self.label_prefix,
            "pre_sql": [describe_hook(h) for h in self.pre_sql],
            "post_sql": [describe_hook(h) for h in self.post_sql],
            "reject": describe(self.reject),
            "partition": describe(self.partition),
            "partitions": [plain_value(p) for p in self.partitions],
            "max_filter_ratio": self.max_filter_ratio,
            "max_row_bytes": self.max_row_bytes,
            "limits": None if self.limits is None else plain_value(self.limits),
            "single_scan": self.single_scan,
            "keep_going": self.keep_going,
            "views": {name: view.schema.simpleString() for name, view in sorted(self.views.items())},
            **self.extra_config,
        }

    def run(self, spark: SparkSession, ledger: Ledger) -> dict:
        """Run to a terminal ledger row; the failure, if any, is in its ``error``."""
        run_id, new = ledger.submit(self.config(), self.request_id)
        if not new:
            return ledger.run(run_id)
        error: SyncError | None = None
        read = {"rows_read": 0, "bytes_read": 0}
        try:
            ledger.update(run_id, state="RUNNING", stage="validate")
            self.plan(spark)
            ledger.update(run_id, stage="pre_sql")
            run_hooks(spark, self.pre_sql)
            # Hooks may have changed the target; from here on a pinned source stays as it is.
            job = replace(self, source=self.source.pinned(spark)) if self.source.pin else self
            plan = job.plan(spark)
            ledger.update(run_id, stage="transfer")
            job._transfer(spark, ledger, run_id, plan, read)
            ledger.update(run_id, stage="post_sql")
            run_hooks(spark, self.post_sql)
        except Exception as e:
            error = prevailing(error, as_sync_error(e))
        state = "SUCCEEDED" if error is None else ("CANCELLED" if error.code == "CANCELLED" else "FAILED")
        return ledger.finish(run_id, state, error, **read)

    def _transfer(self, spark, ledger: Ledger, run_id: str, plan: MappingPlan, read: dict) -> None:
        groups = self._dealt(spark, run_id, plan) if self.single_scan else self._sliced(spark, plan)
        failures: list[SyncError] = []
        done: list[Receipt] = []

        def copy(group: tuple[int, Write]) -> None:
            # After a failure no new group starts; those under way still record their outcome.
            if failures and not self.keep_going:
                return
            try:
                if ledger.cancel_requested(self.request_id):
                    raise SyncError("CANCELLED", "the request was cancelled before this group")
                done.append(self._copy_group(ledger, run_id, *group))
            except Exception as e:
                failures.append(as_sync_error(e))

        with ThreadPoolExecutor(self.parallel_groups) as pool:
            list(pool.map(copy, groups))
        read["rows_read"] = sum(r.loaded + r.filtered for r in done)
        read["bytes_read"] = sum(r.bytes for r in done)
        error: SyncError | None = None
        for failure in failures:
            error = prevailing(error, failure)
        if error is not None:
            raise error

    def _label(self, run_id: str, group: int | str) -> str:
        return f"{self.label_prefix}_{run_id.replace('-', '')}_{group}"

    def _sliced(self, spark: SparkSession, plan: MappingPlan) -> list[tuple[int, Write]]:
        """A scan and a write per slice."""
        frames = self.source.slices(spark) if self.source.split else [self.source.frame(spark, **self.views)]

        def writer(frame: DataFrame) -> Write:
            return lambda label, announce: self._write(self.transform(frame, plan), label, announce)

        return [(n, writer(frame)) for n, frame in enumerate(frames)]

    def _dealt(self, spark: SparkSession, run_id: str, plan: MappingPlan) -> list[tuple[int, Write]]:
        """One scan and one write of all rows; groups without rows are left out."""
        options = {"reject": self.reject, "partition": self.partition, "partitions": self.partitions}
        frame = self.source.frame(spark, **self.views)
        rows = dealt_rows(
            frame, plan, self.source.split, fill_omitted=self.target.model != "upsert", max_row_bytes=self.max_row_bytes, **options
        )
        if self.writers is not None:
            rows = rows.repartition(self.writers)
        # Appended and inserted groups stay in the files of this write, in the target's own folder if it has one.
        in_place = self.target.model != "upsert"
        folder = self.target.staging(spark, self._label(run_id, "dealt"))
        groups = deal(rows, folder, self.target.layout if in_place else None, self.gather)
        self.source.check_files(spark)

        def writer(group: DealtGroup) -> Write:
            def write(label: str, announce) -> Receipt:
                checked = group.receipt(self.max_filter_ratio)
                if in_place:
                    return self._retried(lambda: self.target.adopt(spark, label, group.path, checked, group.bytes, announce))
                stored = spark.read.parquet(group.folder).select(*[column(dst.name) for _, dst in plan.pairs])
                return self._write(stored, label, announce)

            return write

        return [(group.number, writer(group)) for group in groups]

    def _copy_group(self, ledger: Ledger, run_id: str, group: int, write: Write) -> Receipt:
        label = self._label(run_id, group)
        announced: list[int] = []

        def announce(rows: int, size: int) -> None:
            self.source.check_files(ledger.spark)  # rows of a file that was replaced meanwhile never become visible
            # Staged and counted but not visible yet: from here on the outcome must be recorded.
            if not announced:
                ledger.intent(run_id, group, label, rows, size)
                announced.append(rows)

        try:
            receipt = write(label, announce)
        except Exception as e:
            failure = as_sync_error(e)
            # Once announced, only the marker tells whether the group became visible.
            settled = self._settle(ledger.spark, label, failure) if announced else None
            if settled is None:
                if announced:
                    ledger.rejected(run_id, group, failure)
                raise failure from e
            receipt = settled
        try:
            ledger.confirmed(run_id, group, receipt.loaded, receipt.filtered, receipt.affected)
        except Exception as e:
            raise SyncError.unknown("Target committed but its receipt could not be saved") from e
        return receipt

    def _settle(self, spark: SparkSession, label: str, failure: SyncError) -> Receipt | None:
        """Receipt of a group whose write failed after its announcement but did become visible. Without a marker it
        did not; if the marker cannot be looked up, ``failure`` is marked as of unknown outcome."""
        try:
            return self.target.receipt(spark, label)
        except Exception:
            failure.commit_unknown, failure.retryable = True, False
            return None

    def _write(self, mapped: DataFrame, label: str, announce) -> Receipt:
        return self._retried(
            lambda: self.target.write(
                mapped,
                label,
                order=self.order,
                updates=self.updates,
                reject=self.reject,
                partition=self.partition,
                partitions=self.partitions,
                max_filter_ratio=self.max_filter_ratio,
                limits=self.limits,
                announce=announce,
            )
        )

    def _retried(self, write: Callable[[], Receipt]) -> Receipt:
        for attempt in range(self.retries + 1):
            try:
                return write()
            except SyncError as e:
                # Only what is known to have changed nothing is sent again, under the same label.
                if not e.retryable or e.commit_unknown or attempt == self.retries:
                    raise
            time.sleep(self.backoff_ms * 2 ** min(attempt, MAX_BACKOFF_EXPONENT) / 1000)
        raise AssertionError("unreachable")


def as_sync_error(e: Exception) -> SyncError:
    """The failure class of any exception; guard messages carry theirs in the text."""
    if isinstance(e, SyncError):
        return e
    text = str(e)
    for code in ("ROW_TOO_LARGE", "TYPE"):
        mark = text.find(f"{code}: ")
        if mark >= 0:
            return SyncError(code, text[mark + len(code) + 2 :].splitlines()[0])
    return SyncError("SPARK", text.splitlines()[0] if text else type(e).__name__)


def plain_value(value):
    """A configuration value as JSON holds it, the same in every process."""
    if value is None or isinstance(value, (bool, int, float, str)):
        return value
    if isinstance(value, Mapping):
        return {str(k): plain_value(v) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [plain_value(v) for v in value]
    if is_dataclass(value):
        return {"type": type(value).__name__, **{f.name: plain_value(getattr(value, f.name)) for f in fields(value)}}
    if callable(value):
        return describe_hook(value)
    return f"{type(value).__name__}:{value}"


def describe_hook(hook) -> object:
    """SQL text as it is; of a callable its name, its code and what it is bound to."""
    if isinstance(hook, str):
        return hook
    if isinstance(hook, partial):
        return ["partial", describe_hook(hook.func), plain_value(hook.args), plain_value(hook.keywords)]
    code = getattr(hook, "__code__", None)
    name = f"{getattr(hook, '__module__', '')}.{getattr(hook, '__qualname__', type(hook).__name__)}"
    if code is None:
        return name
    cells = [plain_value(c.cell_contents) for c in hook.__closure__ or ()]
    constants = [plain_value(c) for c in code.co_consts if not hasattr(c, "co_code")]
    body = hashlib.sha256(code.co_code + repr((code.co_names, constants)).encode()).hexdigest()
    return [name, body, cells, plain_value(hook.__defaults__ or ())]
