"""Ledger questions over runs and batch events derived from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from exactsync.functions import text
from exactsync.ledger import states
from exactsync.queries.registry import derive, load, query

# Three events per batch in shuffled order, 25 batches per run.
EVENTS = """
SELECT concat('run-', CAST(CAST(floor(event_id / 75) AS BIGINT) AS STRING)) AS run_id,
       CAST(floor(event_id / 3) AS BIGINT) AS batch_id,
       CASE WHEN event_type = 'error' THEN 'UNKNOWN' WHEN event_type = 'signup' THEN 'NOT_COMMITTED'
            WHEN event_type = 'click' THEN 'INTENT' ELSE 'CONFIRMED' END AS state,
       user_id + 1 AS rows, (user_id + 1) * 100 AS bytes,
       concat('load_', CAST(CAST(floor(event_id / 3) AS BIGINT) AS STRING)) AS label,
       CASE WHEN user_id % 3 = 0 THEN user_id ELSE user_id + 1 END AS loaded,
       CASE WHEN user_id % 3 = 0 THEN 1 ELSE 0 END AS filtered,
       2 * user_id AS affected, (event_id * 7919) % 100003 AS ts, event_id
FROM {events}
"""
_CURRENT = f"""
    SELECT * EXCLUDE (nth) FROM (
        SELECT *, row_number() OVER (PARTITION BY run_id, batch_id ORDER BY ts DESC, event_id DESC) AS nth
        FROM ({EVENTS}))
    WHERE nth = 1"""


def _batches(spark, sf):
    return states.current_batches(derive(spark, sf, EVENTS), tie="event_id")


@query("ledger_current_state", f"SELECT run_id, batch_id, state, rows, bytes, label, event_id FROM ({_CURRENT})")
def ledger_current_state(spark, sf):
    return _batches(spark, sf).select("run_id", "batch_id", "state", "rows", "bytes", "label", "event_id")


# Every event brings a receipt; those of views name batches nobody announced.
RECEIPTS = f"""
SELECT run_id, CASE WHEN rows % 7 = 0 THEN batch_id + 1000000000 ELSE batch_id END AS batch_id FROM ({EVENTS})
"""


@query(
    "ledger_double_confirm",
    f"""
    SELECT r.run_id, r.batch_id, b.state AS batch_state, CAST(CASE WHEN b.state = 'INTENT' THEN 1 ELSE 0 END AS BIGINT) AS confirmed,
           CAST(n - CASE WHEN b.state = 'INTENT' THEN 1 ELSE 0 END AS BIGINT) AS refused
    FROM (SELECT run_id, batch_id, count(*) AS n FROM ({RECEIPTS}) GROUP BY 1, 2) r
    LEFT JOIN ({_CURRENT}) b USING (run_id, batch_id)
    """,
)
def ledger_double_confirm(spark, sf):
    return states.confirm(_batches(spark, sf), derive(spark, sf, RECEIPTS))


LABELS = f"""
SELECT label, CASE min(rows) % 6 WHEN 0 THEN 'VISIBLE' WHEN 1 THEN 'ABORTED' WHEN 2 THEN 'PREPARE'
                   WHEN 3 THEN 'COMMITTED' WHEN 4 THEN 'UNKNOWN' ELSE 'VISIBLE' END AS label_state,
       CASE WHEN min(bytes) % 400 = 0 THEN NULL ELSE min(loaded) END AS loaded, min(filtered) AS filtered
FROM ({EVENTS}) GROUP BY label
"""


def _reconcile_oracle(ratio: float) -> str:
    allowed = "true" if ratio > 0 else "false"
    return f"""
    SELECT run_id, batch_id, label, label_state, action,
           CASE WHEN action = 'CONFIRM' THEN coalesce(label_loaded, rows) END AS loaded
    FROM (SELECT b.run_id, b.batch_id, b.rows, b.label, l.label_state, l.loaded AS label_loaded,
            CASE WHEN l.label_state = 'VISIBLE' AND
                      CASE WHEN l.loaded IS NULL THEN NOT {allowed}
                           ELSE l.loaded + l.filtered = b.rows AND (l.filtered = 0 OR {allowed}) END THEN 'CONFIRM'
                 WHEN l.label_state = 'ABORTED' THEN 'RETRY'
                 WHEN l.label_state IN ('PREPARE', 'COMMITTED') THEN 'WAIT' ELSE 'COMMIT_UNKNOWN' END AS action
          FROM ({_CURRENT}) b LEFT JOIN ({LABELS}) l ON b.label = l.label
          WHERE b.state IN ('INTENT', 'UNKNOWN'))
    """


def _reconciled(spark, sf, ratio):
    acted = states.reconcile(_batches(spark, sf), derive(spark, sf, LABELS), ratio)
    return acted.select("run_id", "batch_id", "label", "label_state", "action", "loaded")


@query("ledger_reconcile", _reconcile_oracle(0.0))
def ledger_reconcile(spark, sf):
    return _reconciled(spark, sf, 0.0)


@query("ledger_reconcile_filtered", _reconcile_oracle(0.1))
def ledger_reconcile_filtered(spark, sf):
    return _reconciled(spark, sf, 0.1)


@query(
    "ledger_rejected",
    f"""
    SELECT state, count(*) AS n_batches FROM (
        SELECT CASE WHEN state = 'UNKNOWN' THEN 'UNKNOWN' ELSE 'NOT_COMMITTED' END AS state FROM ({_CURRENT}))
    GROUP BY 1
    """,
)
def ledger_rejected(spark, sf):
    failed = _batches(spark, sf).select(states.rejected_state(F.col("state") == "UNKNOWN").alias("state"))
    return failed.groupBy("state").agg(F.count(F.lit(1)).alias("n_batches"))


_ROLLED = f"""
    SELECT run_id, CAST(sum(rows) AS BIGINT) AS rows_submitted,
           CAST(coalesce(sum(loaded) FILTER (state = 'CONFIRMED'), 0) AS BIGINT) AS rows_committed,
           CAST(coalesce(sum(filtered) FILTER (state = 'CONFIRMED'), 0) AS BIGINT) AS rows_filtered,
           CAST(coalesce(sum(affected) FILTER (state = 'CONFIRMED'), 0) AS BIGINT) AS server_affected_rows,
           count(*) FILTER (state = 'CONFIRMED') AS batches_committed,
           max(state IN ('INTENT', 'UNKNOWN')) AS pending
    FROM ({_CURRENT}) GROUP BY run_id"""


@query("run_rollup", _ROLLED)
def run_rollup(spark, sf):
    return states.rollup(_batches(spark, sf))


@query("runs_pending", f"SELECT DISTINCT run_id FROM ({_CURRENT}) WHERE state IN ('INTENT', 'UNKNOWN')")
def runs_pending(spark, sf):
    return states.pending_runs(_batches(spark, sf))


# One run per batch number of the events and some without batches.
RUNS = """
SELECT concat('run-', CAST(CASE WHEN c_custkey % 10 = 9 THEN c_custkey + 1000000 ELSE c_custkey END AS STRING)) AS run_id,
       CASE c_custkey % 7 WHEN 0 THEN 'SUCCEEDED' WHEN 1 THEN 'FAILED' WHEN 2 THEN 'CANCELLED' WHEN 3 THEN 'QUEUED'
                          WHEN 4 THEN 'RUNNING' WHEN 5 THEN 'CANCELLING' ELSE 'INTERRUPTED' END AS state,
       CASE c_nationkey % 4 WHEN 0 THEN 'pre_sql' WHEN 1 THEN 'transfer' WHEN 2 THEN 'post_sql' ELSE 'validate' END AS stage,
       c_nationkey % 3 AS hooks, c_acctbal < 0 AS error_unknown, c_acctbal < 500 AS commit_unknown,
       c_acctbal > 5000 AS partial_write
FROM {customer}
"""


@query(
    "run_flags",
    f"""
    SELECT run_id, r.state, coalesce(rows_committed, 0) AS rows_committed,
           r.state <> 'SUCCEEDED' AND coalesce(rows_committed, 0) > 0 AS partial_write,
           coalesce(pending, false) OR error_unknown AS commit_unknown
    FROM ({RUNS}) r LEFT JOIN ({_ROLLED}) USING (run_id)
    """,
)
def run_flags(spark, sf):
    return states.with_flags(derive(spark, sf, RUNS), states.rollup(_batches(spark, sf)))


_OPEN = "r.state NOT IN ('SUCCEEDED', 'FAILED', 'CANCELLED', 'INTERRUPTED')"


@query(
    "runs_interrupted",
    f"""
    SELECT run_id, CASE WHEN {_OPEN} THEN 'INTERRUPTED' ELSE r.state END AS state, stage,
           CASE WHEN {_OPEN} THEN coalesce(pending, false) OR (stage IN ('pre_sql', 'post_sql') AND hooks > 0)
                ELSE commit_unknown END AS commit_unknown,
           CASE WHEN {_OPEN} THEN coalesce(rows_committed, 0) > 0 ELSE partial_write END AS partial_write
    FROM ({RUNS}) r LEFT JOIN ({_ROLLED}) USING (run_id)
    """,
)
def runs_interrupted(spark, sf):
    return states.interrupt(derive(spark, sf, RUNS), states.rollup(_batches(spark, sf)))


_FIELDS = "c_name, CASE WHEN c_nationkey % 6 = 0 THEN NULL ELSE c_mktsegment END AS segment, c_nationkey"
_PRINT = "sha256(concat_ws(chr(31), coalesce(c_name, chr(30)), coalesce(segment, chr(30)), CAST(c_nationkey AS VARCHAR)))"


def _with_print(df):
    fields = [F.col(c) for c in ("c_name", "segment", "c_nationkey")]
    return df.withColumn("fingerprint", text.fingerprint(*fields))


@query("request_fingerprint", f"SELECT c_custkey, {_PRINT} AS fingerprint FROM (SELECT c_custkey, {_FIELDS} FROM {{customer}})")
def request_fingerprint(spark, sf):
    rows = derive(spark, sf, f"SELECT c_custkey, {_FIELDS} FROM {{customer}}")
    return _with_print(rows).select("c_custkey", "fingerprint")


KNOWN = f"""
SELECT concat('req-', CAST(c_custkey AS STRING)) AS request_id, concat('run-', CAST(c_custkey AS STRING)) AS run_id,
       CASE WHEN c_acctbal > 0 THEN 'SUCCEEDED' ELSE 'FAILED' END AS state, {_FIELDS}
FROM {{customer}}
"""
# The same requests again: some with another configuration, some under ids not seen before.
REQUESTS = """
SELECT concat('req-', CAST(CASE WHEN c_custkey % 3 = 0 THEN c_custkey + 1000000 ELSE c_custkey END AS STRING)) AS request_id,
       c_name, CASE WHEN c_custkey % 5 = 0 THEN 'CHANGED' WHEN c_nationkey % 6 = 0 THEN NULL ELSE c_mktsegment END AS segment,
       c_nationkey
FROM {customer}
"""
TOMBSTONES = """
SELECT concat('req-', CAST(CASE WHEN c_custkey % 2 = 0 THEN c_custkey + 1000000 ELSE c_custkey END AS STRING)) AS request_id
FROM {customer}
"""


@query(
    "request_verdict",
    f"""
    SELECT q.request_id, CASE WHEN k.run_id IS NOT NULL AND k.fingerprint = q.fingerprint THEN 'EXISTING'
                              WHEN k.run_id IS NOT NULL THEN 'CONFLICT' WHEN t.request_id IS NOT NULL THEN 'REQUEST_CANCELLED'
                              ELSE 'NEW' END AS verdict,
           CASE WHEN k.fingerprint = q.fingerprint THEN k.run_id END AS run_id
    FROM (SELECT request_id, {_PRINT} AS fingerprint FROM ({REQUESTS})) q
    LEFT JOIN (SELECT request_id, run_id, {_PRINT} AS fingerprint FROM ({KNOWN})) k USING (request_id)
    LEFT JOIN (SELECT DISTINCT request_id FROM ({TOMBSTONES})) t USING (request_id)
    """,
)
def request_verdict(spark, sf):
    incoming = _with_print(derive(spark, sf, REQUESTS)).select("request_id", "fingerprint")
    runs = _with_print(derive(spark, sf, KNOWN)).select("request_id", "run_id", "fingerprint")
    return states.request_verdicts(incoming, runs, derive(spark, sf, TOMBSTONES))


@query(
    "request_status",
    f"""
    SELECT q.request_id, t.request_id IS NOT NULL AS cancel_requested, k.run_id, k.state
    FROM (SELECT request_id FROM ({REQUESTS})) q
    LEFT JOIN ({KNOWN}) k USING (request_id)
    LEFT JOIN (SELECT DISTINCT request_id FROM ({TOMBSTONES})) t USING (request_id)
    WHERE k.run_id IS NOT NULL OR t.request_id IS NOT NULL
    """,
)
def request_status(spark, sf):
    asked = derive(spark, sf, REQUESTS).select("request_id")
    return states.request_status(asked, derive(spark, sf, KNOWN), derive(spark, sf, TOMBSTONES))


_RUN_LIST = """
SELECT concat('run-', CAST(o_orderkey AS STRING)) AS run_id, o_orderstatus AS state, o_orderdate AS created_at FROM {orders}
"""


@query("runs_page", f"SELECT * FROM ({_RUN_LIST}) ORDER BY created_at DESC, run_id DESC LIMIT 50 OFFSET 100")
def runs_page(spark, sf):
    return states.runs_page(derive(spark, sf, _RUN_LIST), limit=50, offset=100)


# A configuration with passwords of every shape: text, escaped text, nested object, nested array, null. In the
# redacted text they are simply left out of the concatenation, so SQL shares nothing with the code under test.
_SECRETS = (
    """concat('"p-', event_type, ' ', CAST(event_id AS STRING), chr(92), '"x"')""",
    """concat(chr(123), '"a":', chr(123), '"b":[', CAST(user_id AS STRING), ',', props, ']', chr(125), chr(125))""",
    """concat('[[1,', chr(123), '"deep":"s"', chr(125), '],"t"]')""",
    "'null'",
)


def _config_sql(secrets, spaces: str) -> str:
    a, b, c, d = secrets
    member = f"""'"password"{spaces}:{spaces}',"""
    return f"""
SELECT event_id, concat(chr(123), '"reader":', chr(123), '"user":"u', CAST(user_id AS STRING), '",', {member} {a}, chr(125),
              ',"writer":[', chr(123), {member} {b}, ',"note":"password"', chr(125), ',', chr(123), {member} {c},
              chr(125), ',', chr(123), {member} {d}, ',"passwords":1', chr(125), ']', chr(125)) AS config
FROM {{events}}
"""


_CONFIGS = _config_sql(_SECRETS, " ")


@query("redact_config", _config_sql(["""'"[REDACTED]"'"""] * 4, ""))
def redact_config(spark, sf):
    return derive(spark, sf, _CONFIGS).withColumn("config", text.redact_config(F.col("config")))


@query(
    "batch_list",
    f"SELECT batch_id, state, rows, bytes, label FROM ({_CURRENT}) WHERE run_id = 'run-3'",
)
def batch_list(spark, sf):
    return states.run_batches(_batches(spark, sf), "run-3").select("batch_id", "state", "rows", "bytes", "label")
