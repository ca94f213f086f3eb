"""Writing the ledger: every state change is one small JSON file that is created only once.

The files form two append-only tables that Spark reads back (``runs`` and ``batch_events``, one
folder per run); the current state is the latest row. Creating a file only if it is absent gives
the rules their atomicity: one run per request id, one outcome per batch. There are a few files
per commit group, none per row batch, so the ledger stays small next to the data.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from exactsync.errors import SyncError
from exactsync.functions.text import redacted
from exactsync.ledger import states
from exactsync.sinks import files

_COUNTERS = (
    "rows_read",
    "bytes_read",
    "rows_submitted",
    "rows_committed",
    "rows_filtered",
    "server_affected_rows",
    "batches_committed",
)
_READ_COUNTERS = ("rows_read", "bytes_read")
_INTENT, _OUTCOME, _RECONCILED = 0, 1, 2


def _now() -> str:
    return datetime.now(timezone.utc).isoformat(timespec="microseconds")


def _canonical(config: Mapping) -> str:
    return json.dumps(config, sort_keys=True, default=str)


def config_fingerprint(config: Mapping) -> str:
    return hashlib.sha256(_canonical(config).encode("utf-8")).hexdigest()


def check_request_id(request_id: str) -> str:
    if not 1 <= len(request_id.encode("utf-8")) <= 200:
        raise SyncError.config("a request id has 1 to 200 bytes in UTF-8")
    return request_id


@dataclass(frozen=True)
class Ledger:
    spark: SparkSession
    root: str

    # -- tables --------------------------------------------------------------------------

    def _table(self, name: str, schema, run_id: str | None = None) -> DataFrame:
        base = f"{self.root}/{name}"
        path = f"{base}/run_id={run_id}" if run_id else base
        if not files.exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).option("basePath", base).json(path)
        return rows.select(*schema.names)

    def events(self, run_id: str | None = None) -> DataFrame:
        return self._table("batch_events", states.EVENTS_SCHEMA, run_id)

    def batches(self, run_id: str | None = None) -> DataFrame:
        return states.current_batches(self.events(run_id), tie="seq")

    def runs(self) -> DataFrame:
        return states.current_runs(self._table("runs", states.RUNS_SCHEMA))

    def run(self, run_id: str) -> dict:
        """Latest row of one run, read straight from its folder."""
        folder = self._folder("runs", run_id)
        for name in reversed(self._files(folder)):
            return {"run_id": run_id, **files.read_json(self.spark, f"{folder}/{name}")}
        raise SyncError("NOT_FOUND", f"no run {run_id} in this ledger")

    def run_batches(self, run_id: str) -> DataFrame:
        return states.run_batches(self.batches(run_id), run_id)

    def page(self, limit: int = states.DEFAULT_PAGE, offset: int = 0) -> DataFrame:
        """Runs, newest first."""
        return states.runs_page(self.runs(), limit, offset)

    def request(self, request_id: str) -> dict:
        """The run a request started and whether its cancellation was asked for."""
        path = self._request_file("requests", request_id)
        known = files.read_json(self.spark, path) if files.exists(self.spark, path) else None
        cancelled = self.cancel_requested(request_id)
        if known is None and not cancelled:
            raise SyncError("NOT_FOUND", f"nothing is known of request {request_id}")
        run = self.run(known["run_id"]) if known else None
        return {"request_id": request_id, "cancel_requested": cancelled, "run": run}

    def _folder(self, table: str, run_id: str) -> str:
        return f"{self.root}/{table}/run_id={run_id}"

    def _files(self, folder: str) -> list[str]:
        return [n for n in files.names(self.spark, folder) if n.endswith(".json") and not n.startswith(".")]

    # -- requests ------------------------------------------------------------------------

    def _request_file(self, kind: str, request_id: str) -> str:
        digest = hashlib.sha256(check_request_id(request_id).encode("utf-8")).hexdigest()
        return f"{self.root}/{kind}/{digest}.json"

    def submit(self, config: Mapping, request_id: str | None = None) -> tuple[str, bool]:
        """Run id and whether it is new. The same request gives the original run."""
        run_id, fingerprint = str(uuid.uuid4()), config_fingerprint(config)
        if request_id is not None:
            path = self._request_file("requests", request_id)
            known = self._known_request(path, fingerprint)
            if known:
                return known, False
            if self.cancel_requested(request_id):
                raise SyncError("REQUEST_CANCELLED", "a cancellation of this request came first")
            entry = {"request_id": request_id, "fingerprint": fingerprint, "run_id": run_id}
            if not files.create_json(self.spark, path, entry):
                return self._known_request(path, fingerprint), False
        self._put_run(
            run_id,
            {
                "request_id": request_id,
                "fingerprint": fingerprint,
                "state": "QUEUED",
                "stage": "queued",
                "created_at": _now(),
                "config": _canonical(redacted(dict(config))),
                **_zero_counters(),
            },
        )
        return run_id, True

    def _known_request(self, path: str, fingerprint: str) -> str | None:
        if not files.exists(self.spark, path):
            return None
        known = files.read_json(self.spark, path)
        if known["fingerprint"] != fingerprint:
            raise SyncError("CONFLICT", "this request_id was used for another configuration before")
        return known["run_id"]

    def cancel_request(self, request_id: str) -> str | None:
        """Leave a tombstone; gives the run the request already started, if any."""
        tombstone = {"request_id": request_id, "created_at": _now()}
        files.create_json(self.spark, self._request_file("cancelled", request_id), tombstone)
        path = self._request_file("requests", request_id)
        known = files.read_json(self.spark, path) if files.exists(self.spark, path) else None
        if known is None:
            return None
        if self.run(known["run_id"])["state"] not in states.TERMINAL_STATES:
            self.update(known["run_id"], state="CANCELLING")
        return known["run_id"]

    def cancel_requested(self, request_id: str | None) -> bool:
        return request_id is not None and files.exists(self.spark, self._request_file("cancelled", request_id))

    # -- runs ----------------------------------------------------------------------------

    def _put_run(self, run_id: str, values: dict) -> None:
        folder = self._folder("runs", run_id)
        seq = len(self._files(folder))
        row = {k: v for k, v in values.items() if k != "run_id"}
        while not files.create_json(self.spark, f"{folder}/{seq:06d}.json", {**row, "seq": seq, "updated_at": _now()}):
            seq += 1

    def update(self, run_id: str, **changes) -> None:
        """Add a row with the changes; what another writer has put there meanwhile is read again, never undone."""
        folder = self._folder("runs", run_id)
        while True:
            names = self._files(folder)
            row = files.read_json(self.spark, f"{folder}/{names[-1]}") if names else {}
            if row.get("state") == "CANCELLING" and changes.get("state") == "RUNNING":
                changes = {k: v for k, v in changes.items() if k != "state"}
            seq = len(names)
            new = {**{k: v for k, v in row.items() if k != "run_id"}, **changes, "seq": seq, "updated_at": _now()}
            if files.create_json(self.spark, f"{folder}/{seq:06d}.json", new):
                return

    def finish(self, run_id: str, state: str, error: SyncError | None = None, **changes) -> dict:
        """Terminal row with counters from the batches and the two flags."""
        rolled = states.rollup(self.batches(run_id)).drop("run_id").take(1)
        counters = rolled[0].asDict() if rolled else {}
        pending = bool(counters.pop("pending", False))
        base = {c: 0 for c in _COUNTERS if c not in _READ_COUNTERS}
        values = {**self.run(run_id), **base, **counters, **changes, "state": state}
        values["partial_write"] = state != "SUCCEEDED" and values["rows_committed"] > 0
        values["commit_unknown"] = pending or bool(error and error.commit_unknown)
        values["error"] = json.dumps(error.as_dict()) if error else None
        self._put_run(run_id, values)
        return values

    def interrupt_unfinished(self) -> None:
        """After a restart: close unfinished runs without resuming them.

        Call it only when no other process runs jobs on this ledger.
        """
        runs = self.runs().where(~F.col("state").isin(*states.TERMINAL_STATES))
        hooks = F.lit(0)
        for stage in states.HOOK_STAGES:
            listed = F.from_json(F.get_json_object("config", f"$.{stage}"), "array<string>")
            hooks = F.when(F.col("stage") == stage, F.coalesce(F.size(listed), F.lit(0))).otherwise(hooks)
        rolled = states.rollup(self.batches())
        flags = states.interrupt(runs.withColumn("hooks", hooks), rolled)
        reason = SyncError("INTERRUPTED", "the process ended during the run; it stays as it is").as_dict()
        # One row per run that was open at the crash, bounded by how many may run at once.
        for row in flags.join(rolled.drop("pending"), "run_id", "left").toLocalIterator():
            values = {k: v for k, v in row.asDict().items() if v is not None}
            self.update(values.pop("run_id"), error=json.dumps(reason), **values)

    # -- batches -------------------------------------------------------------------------

    def _event(self, run_id: str, batch_id: int, seq: int, state: str, **values) -> bool:
        row = {"batch_id": batch_id, "state": state, "ts": _now(), "seq": seq, **values}
        path = f"{self._folder('batch_events', run_id)}/{batch_id:09d}-{seq}.json"
        return files.create_json(self.spark, path, row)

    def _announced(self, run_id: str, batch_id: int) -> dict | None:
        path = f"{self._folder('batch_events', run_id)}/{batch_id:09d}-{_INTENT}.json"
        return files.read_json(self.spark, path) if files.exists(self.spark, path) else None

    def intent(self, run_id: str, batch_id: int, label: str, rows: int, bytes_: int = 0) -> None:
        if not self._event(run_id, batch_id, _INTENT, states.INTENT, label=label, rows=rows, bytes=bytes_):
            raise SyncError("STATE_STORE", f"batch {batch_id} has an announcement already")

    def confirmed(
        self, run_id: str, batch_id: int, loaded: int, filtered: int, affected: int, detail: str = ""
    ) -> None:
        """Only from INTENT, and only once."""
        known = self._announced(run_id, batch_id)
        values = {"loaded": loaded, "filtered": filtered, "affected": affected, "detail": detail}
        if known is None or not self._event(
            run_id, batch_id, _OUTCOME, states.CONFIRMED, **_batch_facts(known), **values
        ):
            raise SyncError("STATE_STORE", f"batch {batch_id} was not announced, or its outcome is known")

    def rejected(self, run_id: str, batch_id: int, error: SyncError) -> None:
        known = self._announced(run_id, batch_id) or {}
        self._event(
            run_id,
            batch_id,
            _OUTCOME,
            states.UNKNOWN if error.commit_unknown else states.NOT_COMMITTED,
            **_batch_facts(known),
            detail=json.dumps(error.as_dict()),
        )

    def reconcile(self, labels: DataFrame, max_filter_ratio: float = 0.0) -> list[dict]:
        """Settle pending batches by the labels found in the target; gives what was done to each.

        Only batches that were open at a crash are pending, so they are few.
        """
        done = []
        if "affected" not in labels.columns:
            labels = labels.withColumn("affected", F.lit(None).cast("bigint"))
        settled = states.reconcile(self.batches(), labels, max_filter_ratio)
        effects = labels.select("label", "affected")
        for row in settled.join(effects, "label", "left").toLocalIterator():
            facts = {"label": row["label"], "rows": row["rows"]}
            if row["action"] == "CONFIRM":
                affected = row["loaded"] if row["affected"] is None else row["affected"]
                self._event(
                    row["run_id"],
                    row["batch_id"],
                    _RECONCILED,
                    states.CONFIRMED,
                    **facts,
                    loaded=row["loaded"],
                    filtered=(row["rows"] or 0) - (row["loaded"] or 0),
                    affected=affected,
                    detail='{"state":"VISIBLE","reconciled":true}',
                )
            elif row["action"] == "RETRY":
                self._event(
                    row["run_id"],
                    row["batch_id"],
                    _RECONCILED,
                    states.NOT_COMMITTED,
                    **facts,
                    detail='{"state":"ABORTED","reconciled":true}',
                )
            done.append(row.asDict())
        for run_id in sorted({d["run_id"] for d in done if d["action"] in ("CONFIRM", "RETRY")}):
            self._roll_up_again(run_id)
        return done

    def _roll_up_again(self, run_id: str) -> None:
        """Counters and flags of a finished run after its batches were settled; its state stays."""
        known = self.run(run_id)
        if known["state"] not in states.TERMINAL_STATES:
            return
        told = json.loads(known["error"]) if known.get("error") else None
        error = None
        if told is not None:
            error = SyncError(told["code"], told["message"], retryable=bool(told.get("retryable")))
        self.finish(run_id, known["state"], error)


def _batch_facts(intent: dict) -> dict:
    return {name: intent.get(name) for name in ("label", "rows", "bytes")}


def _zero_counters() -> dict:
    return {**dict.fromkeys(_COUNTERS, 0), "partial_write": False, "commit_unknown": False}
