import json

import pytest
from pyspark.sql import functions as F

from exactsync.errors import SyncError
from exactsync.ledger import states
from exactsync.ledger.store import Ledger


@pytest.fixture
def ledger(spark, root):
    return Ledger(spark, root)


def test_submission_is_idempotent(ledger):
    run_id, new = ledger.submit({"a": 1, "password": "p"}, "r1")
    assert new
    assert ledger.submit({"password": "p", "a": 1}, "r1") == (run_id, False)
    with pytest.raises(SyncError) as e:
        ledger.submit({"a": 2}, "r1")
    assert e.value.code == "CONFLICT"
    assert ledger.submit({"a": 1})[1] and ledger.submit({"a": 1})[1]
    assert "[REDACTED]" in ledger.run(run_id)["config"] and '"p"' not in ledger.run(run_id)["config"]
    for bad in ("", "x" * 201, "中" * 67):
        with pytest.raises(SyncError):
            ledger.submit({}, bad)


def test_tombstone_refuses_a_later_submission(ledger):
    assert ledger.cancel_request("r1") is None
    with pytest.raises(SyncError) as e:
        ledger.submit({"a": 1}, "r1")
    assert e.value.code == "REQUEST_CANCELLED"
    run_id, _ = ledger.submit({"a": 1}, "r2")
    assert ledger.request("r2")["run"]["run_id"] == run_id and not ledger.request("r2")["cancel_requested"]
    assert ledger.request("r1") == {"request_id": "r1", "cancel_requested": True, "run": None}
    with pytest.raises(SyncError):
        ledger.request("r3")
    assert [r.run_id for r in ledger.page().collect()] == [run_id]
    assert ledger.cancel_request("r2") == run_id
    assert ledger.run(run_id)["state"] == "CANCELLING"


def test_confirm_once_and_interruption(ledger):
    run_id, _ = ledger.submit({"a": 1}, "r1")
    ledger.intent(run_id, 0, "label0", rows=3)
    ledger.confirmed(run_id, 0, 3, 0, 6)
    with pytest.raises(SyncError) as e:
        ledger.confirmed(run_id, 0, 3, 0, 6)
    assert e.value.code == "STATE_STORE"
    with pytest.raises(SyncError):
        ledger.confirmed(run_id, 9, 3, 0, 6)
    with pytest.raises(SyncError):
        ledger.intent(run_id, 0, "label0", rows=3)
    ledger.intent(run_id, 1, "label1", rows=5)
    ledger.interrupt_unfinished()
    run = ledger.run(run_id)
    assert run["state"] == "INTERRUPTED" and run["rows_committed"] == 3
    assert run["server_affected_rows"] == 6 and run["rows_submitted"] == 8
    assert run["partial_write"] and run["commit_unknown"]
    assert json.loads(run["error"])["code"] == "INTERRUPTED"
    assert ledger.submit({"a": 1}, "r1") == (run_id, False)
    assert [(b["batch_id"], b["state"]) for b in ledger.run_batches(run_id).collect()] == [(0, "CONFIRMED"), (1, "INTENT")]


def test_interruption_in_hooks_is_unknown_only_with_hooks(ledger):
    with_hooks, _ = ledger.submit({"post_sql": ["ANALYZE"], "pre_sql": []})
    without, _ = ledger.submit({"post_sql": [], "n": 2})
    done, _ = ledger.submit({"n": 3})
    for run_id in (with_hooks, without):
        ledger.update(run_id, state="RUNNING", stage="post_sql")
    ledger.finish(done, "SUCCEEDED")
    ledger.interrupt_unfinished()
    assert ledger.run(with_hooks)["commit_unknown"] is True
    assert ledger.run(without)["commit_unknown"] is False
    assert ledger.run(done)["state"] == "SUCCEEDED"


def test_rejected_batches(ledger):
    run_id, _ = ledger.submit({})
    ledger.intent(run_id, 0, "l0", rows=4)
    ledger.rejected(run_id, 0, SyncError("TYPE", "no"))
    ledger.intent(run_id, 1, "l1", rows=4)
    ledger.rejected(run_id, 1, SyncError.unknown("lost"))
    found = {b["batch_id"]: b["state"] for b in ledger.batches().collect()}
    assert found == {0: "NOT_COMMITTED", 1: "UNKNOWN"}
    finished = ledger.finish(run_id, "FAILED", SyncError("TYPE", "no"))
    assert finished["commit_unknown"] and not finished["partial_write"]


def test_reconciling_a_visible_label(spark, ledger):
    run_id, _ = ledger.submit({})
    ledger.intent(run_id, 0, "l0", rows=4)
    ledger.intent(run_id, 1, "l1", rows=4)
    labels = spark.createDataFrame([("l0", "VISIBLE", 4, 0)], "label string, label_state string, loaded bigint, filtered bigint")
    assert {d["batch_id"]: d["action"] for d in ledger.reconcile(labels)} == {0: "CONFIRM", 1: "COMMIT_UNKNOWN"}
    assert {b["batch_id"]: b["state"] for b in ledger.batches().collect()} == {0: "CONFIRMED", 1: "INTENT"}
    assert [d["batch_id"] for d in ledger.reconcile(labels)] == [1]


def test_missing_run(ledger):
    with pytest.raises(SyncError) as e:
        ledger.run("nope")
    assert e.value.code == "NOT_FOUND"


def test_reconcile_actions(spark):
    batches = spark.createDataFrame(
        [("r", i, "INTENT", 5, f"l{i}") for i in range(8)] + [("r", 8, "CONFIRMED", 5, "l8")],
        "run_id string, batch_id bigint, state string, rows bigint, label string",
    )
    labels = spark.createDataFrame(
        [
            ("l0", "VISIBLE", 5, 0),
            ("l1", "VISIBLE", None, None),
            ("l2", "VISIBLE", 4, 0),
            ("l3", "VISIBLE", 4, 1),
            ("l4", "ABORTED", None, None),
            ("l5", "PREPARE", None, None),
            ("l6", "UNKNOWN", None, None),
        ],
        "label string, label_state string, loaded bigint, filtered bigint",
    )
    act = lambda ratio: {r.batch_id: r.action for r in states.reconcile(batches, labels, ratio).collect()}
    unknown = "COMMIT_UNKNOWN"
    assert act(0.0) == {0: "CONFIRM", 1: "CONFIRM", 2: unknown, 3: unknown, 4: "RETRY", 5: "WAIT", 6: unknown, 7: unknown}
    assert act(0.5) == {0: "CONFIRM", 1: unknown, 2: unknown, 3: "CONFIRM", 4: "RETRY", 5: "WAIT", 6: unknown, 7: unknown}


def test_runs_page_bounds(spark):
    runs = spark.range(700).select(F.concat(F.lit("run-"), F.col("id")).alias("run_id"), F.col("id").cast("timestamp").alias("created_at"))
    assert states.runs_page(runs).count() == 50
    assert states.runs_page(runs, limit=500).count() == 500
    for limit, offset in ((501, 0), (0, 0), (5, -1)):
        with pytest.raises(SyncError):
            states.runs_page(runs, limit, offset)
    assert [r.run_id for r in states.runs_page(runs, limit=2, offset=3).collect()] == ["run-696", "run-695"]
