"""Batch application of command logs as named queries; each result is the next snapshot."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators import apply, lists, transactions
from ledgerline.plans.mapping import Ledger
from ledgerline.plans.registry import query

# New rows get ids above every id of the mapped snapshots.
FIRST_ID = 10**15


def _committed(ledger: Ledger, log: str):
    return apply.committed_commands(ledger[log])


query(
    "committed_commands",
    """
SELECT seq, txn_id, ts, key, item, op, score FROM ll_keyed_commands WHERE committed""",
)(
    lambda ledger: _committed(ledger, "keyed_commands").select("seq", "txn_id", "ts", "key", "item", "op", "score")
)


def _job_requests(ledger: Ledger):
    parameters = F.create_map(F.lit("RetryCount"), F.col("retries"), F.lit("Priority"), F.col("priority"))
    return ledger["job_requests"].withColumn("parameters", parameters)


query(
    "create_jobs",
    f"""
SELECT {FIRST_ID} + seq AS id, CAST(NULL AS BIGINT) AS stateid, CAST(NULL AS VARCHAR) AS statename,
       CASE WHEN invocationdata = '' THEN '{{}}' ELSE invocationdata END AS invocationdata,
       coalesce(arguments, '[]') AS arguments, createdat,
       createdat + to_microseconds(CAST(expire_in * 1000000 AS BIGINT)) AS expireat
FROM ll_job_requests""",
)(lambda ledger: apply.create_jobs(_job_requests(ledger), FIRST_ID, FIRST_ID)[0])

query(
    "create_job_parameters",
    f"""
SELECT {FIRST_ID} + 2 * (row_number() OVER (ORDER BY seq) - 1) AS id, {FIRST_ID} + seq AS jobid, 'RetryCount' AS name, retries AS value
FROM ll_job_requests
UNION ALL
SELECT {FIRST_ID} + 2 * (row_number() OVER (ORDER BY seq) - 1) + 1, {FIRST_ID} + seq, 'Priority', priority FROM ll_job_requests""",
)(lambda ledger: apply.create_jobs(_job_requests(ledger), FIRST_ID, FIRST_ID)[1])


# A state for an unknown job voids its transaction.
_GOOD = """good AS (
  SELECT * FROM ll_job_commands WHERE committed AND txn_id NOT IN (
    SELECT txn_id FROM ll_job_commands
    WHERE committed AND op IN ('set_state', 'add_state') AND jobid NOT IN (SELECT id FROM ll_job)))"""


def _good(ledger: Ledger):
    return apply.reject_unknown_jobs(_committed(ledger, "job_commands"), ledger["job"])[0]


query(
    "rejected_states",
    """
SELECT seq, txn_id, jobid, op FROM ll_job_commands
WHERE committed AND op IN ('set_state', 'add_state') AND jobid NOT IN (SELECT id FROM ll_job)""",
)(
    lambda ledger: apply.reject_unknown_jobs(_committed(ledger, "job_commands"), ledger["job"])[1].select(
        "seq", "txn_id", "jobid", "op"
    )
)

query(
    "apply_states",
    f"""
WITH {_GOOD},
last AS (SELECT jobid, max(seq) AS seq, arg_max(name, seq) AS name FROM good WHERE op = 'set_state' GROUP BY jobid)
SELECT j.id, CASE WHEN l.jobid IS NULL THEN j.stateid ELSE {FIRST_ID} + l.seq END AS stateid,
       CASE WHEN l.jobid IS NULL THEN j.statename ELSE l.name END AS statename,
       j.invocationdata, j.arguments, j.createdat, j.expireat
FROM ll_job j LEFT JOIN last l ON l.jobid = j.id""",
)(lambda ledger: apply.apply_states(ledger["job"], ledger["state"], _good(ledger), FIRST_ID)[0])

query(
    "append_states",
    f"""
WITH {_GOOD}
SELECT id, jobid, name, reason, createdat, data FROM ll_state
UNION ALL
SELECT {FIRST_ID} + seq, jobid, name, reason, ts, CASE WHEN data = '' THEN '{{}}' ELSE data END
FROM good WHERE op IN ('set_state', 'add_state')""",
)(lambda ledger: apply.apply_states(ledger["job"], ledger["state"], _good(ledger), FIRST_ID)[1])

query(
    "apply_job_expiry",
    f"""
WITH {_GOOD},
last AS (SELECT jobid, op, ts, ttl_seconds FROM (
  SELECT *, row_number() OVER (PARTITION BY jobid ORDER BY seq DESC) AS rn FROM good
  WHERE op IN ('expire_job', 'persist_job')) WHERE rn = 1)
SELECT j.id, j.stateid, j.statename, j.invocationdata, j.arguments, j.createdat,
       CASE l.op WHEN 'expire_job' THEN l.ts + to_seconds(CAST(floor(l.ttl_seconds) AS BIGINT))
                 WHEN 'persist_job' THEN NULL ELSE j.expireat END AS expireat
FROM ll_job j LEFT JOIN last l ON l.jobid = j.id""",
)(lambda ledger: apply.apply_job_expiry(ledger["job"], _good(ledger)))

query(
    "apply_job_parameters",
    f"""
WITH known AS (SELECT * FROM ll_parameter_commands WHERE jobid IN (SELECT id FROM ll_job)),
last AS (SELECT jobid, name, value, first_seq FROM (
  SELECT jobid, name, value, row_number() OVER (PARTITION BY jobid, name ORDER BY seq DESC) AS rn,
         min(seq) OVER (PARTITION BY jobid, name) AS first_seq FROM known) WHERE rn = 1)
SELECT p.id, p.jobid, p.name, CASE WHEN l.jobid IS NULL THEN p.value ELSE l.value END AS value
FROM ll_jobparameter p LEFT JOIN last l ON l.jobid = p.jobid AND l.name = p.name
UNION ALL
SELECT {FIRST_ID} + first_seq, jobid, name, value FROM last l
WHERE NOT EXISTS (SELECT 1 FROM ll_jobparameter p WHERE p.jobid = l.jobid AND p.name = l.name)""",
)(
    lambda ledger: apply.apply_job_parameters(
        ledger["job"], ledger["jobparameter"], ledger["parameter_commands"], FIRST_ID
    )[0]
)

query(
    "apply_enqueue",
    f"""
SELECT id, jobid, queue, fetchedat, updatecount FROM ll_jobqueue
UNION ALL
SELECT {FIRST_ID} + seq, jobid, queue, NULL, 0 FROM ll_queue_commands WHERE committed""",
)(lambda ledger: apply.apply_enqueue(ledger["jobqueue"], _committed(ledger, "queue_commands"), FIRST_ID))

query(
    "apply_counters",
    f"""
SELECT id, key, value, expireat FROM ll_counter
UNION ALL
SELECT {FIRST_ID} + seq, key, CASE op WHEN 'increment' THEN 1 ELSE -1 END,
       ts + to_seconds(CAST(floor(ttl_seconds) AS BIGINT))
FROM ll_counter_commands WHERE committed""",
)(lambda ledger: apply.apply_counters(ledger["counter"], _committed(ledger, "counter_commands"), FIRST_ID))


def _items_check(payload: str, commands: str = "c AS (SELECT * FROM ll_keyed_commands WHERE committed)") -> str:
    """Next keyed snapshot: replayed per row from its last removal, its rebirth and later expiries."""
    return f"""
WITH {commands},
start AS (SELECT id, key, item, score, CAST(score AS VARCHAR) AS value, expireat FROM ll_keyed_snapshot),
rows AS (SELECT key, item FROM start UNION SELECT key, item FROM c WHERE op IN ('add', 'add_score')),
kills AS (SELECT r.key, r.item, max(c.seq) AS kill FROM rows r
          LEFT JOIN c ON c.key = r.key AND (c.op = 'remove_key' OR (c.op = 'remove' AND c.item = r.item))
          GROUP BY r.key, r.item),
adds AS (SELECT k.key, k.item, min(c.seq) AS born, arg_max(c.{payload}, c.seq) AS {payload} FROM kills k
         JOIN c ON c.key = k.key AND c.item = k.item AND c.op IN ('add', 'add_score')
                   AND (k.kill IS NULL OR c.seq > k.kill)
         GROUP BY k.key, k.item),
alive AS (SELECT k.key, k.item, s.id AS old_id, a.born, CASE WHEN s.id IS NULL THEN a.born ELSE -1 END AS since,
                 coalesce(a.{payload}, s.{payload}) AS {payload}, s.expireat
          FROM kills k LEFT JOIN start s ON s.key = k.key AND s.item = k.item AND k.kill IS NULL
          LEFT JOIN adds a ON a.key = k.key AND a.item = k.item
          WHERE s.id IS NOT NULL OR a.born IS NOT NULL),
touched AS (SELECT v.key, v.item, c.expire_at, row_number() OVER (PARTITION BY v.key, v.item ORDER BY c.seq DESC) AS rn
            FROM alive v JOIN c ON c.key = v.key AND c.op IN ('expire', 'persist') AND c.seq > v.since),
done AS (SELECT coalesce(v.old_id, {FIRST_ID} + v.born) AS id, v.key, v.item, v.{payload},
                CASE WHEN t.rn IS NULL THEN v.expireat ELSE t.expire_at END AS expireat
         FROM alive v LEFT JOIN touched t ON t.key = v.key AND t.item = v.item AND t.rn = 1)"""


def _set_snapshot(ledger: Ledger):
    return ledger["keyed_snapshot"].select("id", "key", "score", F.col("item").alias("value"), "expireat")


def _hash_snapshot(ledger: Ledger):
    # Hash values are text: the snapshot's score in whole hundredths.
    cents = F.round(F.col("score") * 100).cast("bigint").cast("string")
    return ledger["keyed_snapshot"].select("id", "key", F.col("item").alias("field"), cents.alias("value"), "expireat")


query("apply_set", _items_check("score") + "\nSELECT id, key, score, item AS value, expireat FROM done")(
    lambda ledger: apply.apply_set(_set_snapshot(ledger), _committed(ledger, "keyed_commands"), FIRST_ID)
)

query(
    "apply_hash",
    _items_check("value").replace(
        "CAST(score AS VARCHAR) AS value", "CAST(CAST(round(score * 100) AS BIGINT) AS VARCHAR) AS value"
    )
    + "\nSELECT id, key, item AS field, value, expireat FROM done",
)(lambda ledger: apply.apply_hash(_hash_snapshot(ledger), _committed(ledger, "keyed_commands"), FIRST_ID))


def _list_snapshot(ledger: Ledger):
    return ledger["keyed_snapshot"].select("id", "key", F.col("item").alias("value"), "expireat")


query(
    "apply_list",
    f"""
WITH c AS (SELECT * FROM ll_list_commands WHERE committed),
rows AS (SELECT id, key, item AS value, expireat, -1 AS born FROM ll_keyed_snapshot
         UNION ALL SELECT {FIRST_ID} + seq, key, item, NULL, seq FROM c WHERE op = 'insert'),
alive AS (SELECT * FROM rows r WHERE NOT EXISTS (
            SELECT 1 FROM c WHERE c.op = 'remove' AND c.key = r.key AND c.item = r.value AND c.seq > r.born)
          AND NOT EXISTS (SELECT 1 FROM c WHERE c.op = 'trim' AND c.key = r.key AND c.seq > r.born)),
touched AS (SELECT a.id, c.expire_at, row_number() OVER (PARTITION BY a.id ORDER BY c.seq DESC) AS rn
            FROM alive a JOIN c ON c.key = a.key AND c.op IN ('expire', 'persist') AND c.seq > a.born)
SELECT a.id, a.key, a.value, CASE WHEN t.rn IS NULL THEN a.expireat ELSE t.expire_at END AS expireat
FROM alive a LEFT JOIN touched t ON t.id = a.id AND t.rn = 1""",
)(lambda ledger: lists.apply_list(_list_snapshot(ledger), _committed(ledger, "list_commands"), FIRST_ID))


_ROW = "STRUCT(id BIGINT, value VARCHAR, expireat TIMESTAMP)"


# Every list replayed one command after another, all lists side by side.
@query(
    "apply_list_with_trims",
    f"""
WITH RECURSIVE c AS (
  SELECT key, seq, item, CASE WHEN op = 'expire' THEN 'trim' ELSE op END AS op, CASE WHEN op = 'expire' THEN 1 ELSE trim_from END AS low,
         CASE WHEN op = 'expire' THEN 20 ELSE trim_to END AS high, row_number() OVER (PARTITION BY key ORDER BY seq) AS n
  FROM ll_list_commands WHERE committed),
start AS (SELECT key, list({{'id': id, 'value': item, 'expireat': expireat}} ORDER BY id) AS rows FROM ll_keyed_snapshot GROUP BY key),
replay(key, n, rows) AS (
  SELECT k.key, CAST(0 AS BIGINT), CAST(coalesce(s.rows, []) AS {_ROW}[])
  FROM (SELECT key FROM c UNION SELECT key FROM start) k LEFT JOIN start s ON s.key = k.key
  UNION ALL
  SELECT r.key, c.n,
         CASE c.op WHEN 'insert' THEN list_append(r.rows, CAST({{'id': {FIRST_ID} + c.seq, 'value': c.item, 'expireat': NULL}} AS {_ROW}))
                   WHEN 'remove' THEN [x FOR x IN r.rows IF x.value <> c.item]
                   WHEN 'trim' THEN r.rows[c.low + 1 : c.high + 1]
                   ELSE [CAST({{'id': x.id, 'value': x.value, 'expireat': NULL}} AS {_ROW}) FOR x IN r.rows] END
  FROM replay r JOIN c ON c.key = r.key AND c.n = r.n + 1),
last AS (SELECT key, unnest(arg_max(rows, n)) AS x FROM replay GROUP BY key)
SELECT x.id AS id, key, x.value AS value, x.expireat AS expireat FROM last""",
)
def _list_with_trims(ledger: Ledger):
    """Expiry commands read as trims to positions 1..20."""
    log = _committed(ledger, "list_commands")
    trim = F.col("op") == "expire"
    trims = {
        "trim_from": F.when(trim, F.lit(1)).otherwise(F.col("trim_from")),
        "trim_to": F.when(trim, F.lit(20)).otherwise(F.col("trim_to")),
        "op": F.when(trim, F.lit("trim")).otherwise(F.col("op")),
    }
    return lists.apply_list(_list_snapshot(ledger), log.withColumns(trims), FIRST_ID)


# Transactions replayed one command after another. A member of a set is the number of its key and its item; the
# state is the members before the transaction, those after its commands so far, and whether one of them failed.
def _replayed(log: str) -> str:
    return f"""
log AS ({log}),
numbered AS (SELECT seq, txn_id, op, CAST(substr(key, 2) AS BIGINT) * 1000 + CAST(substr(item, 2) AS BIGINT) AS member,
                    CAST(substr(key, 2) AS BIGINT) AS owner, row_number() OVER (ORDER BY txn_id, seq) AS n
             FROM log WHERE op IN ('insert', 'add', 'add_score', 'remove', 'remove_key')),
replay(n, txn_id, held, work, failed) AS (
  SELECT CAST(0 AS BIGINT), CAST(-1 AS BIGINT),
         (SELECT list(CAST(substr(key, 2) AS BIGINT) * 1000 + CAST(substr(item, 2) AS BIGINT)) FROM ll_keyed_snapshot
          WHERE (key, item) IN (SELECT (key, item) FROM log WHERE op = 'insert')), CAST([] AS BIGINT[]), TRUE
  UNION ALL
  SELECT c.n, c.txn_id, r.held,
         CASE WHEN c.op = 'remove' THEN [x FOR x IN r.work IF x <> c.member]
              WHEN c.op = 'remove_key' THEN [x FOR x IN r.work IF x // 1000 <> c.owner]
              WHEN list_contains(r.work, c.member) THEN r.work ELSE list_append(r.work, c.member) END,
         r.failed OR (c.op = 'insert' AND list_contains(r.work, c.member))
  FROM (SELECT s.n, CASE WHEN s.same OR s.failed THEN s.held ELSE s.work END AS held,
               CASE WHEN s.same OR NOT s.failed THEN s.work ELSE s.held END AS work, s.same AND s.failed AS failed
        FROM (SELECT r.*, c.txn_id = r.txn_id AS same FROM replay r JOIN numbered c ON c.n = r.n + 1) s) r
  JOIN numbered c ON c.n = r.n + 1),
clashing AS (SELECT DISTINCT txn_id FROM replay WHERE failed AND n > 0)"""


def _set_batches(ledger: Ledger):
    """Clicks and views as batch inserts, beside the other commands."""
    log = _committed(ledger, "transaction_log").where("target = 'set'")
    return log.select("txn_id", "seq", "key", "item", "op", "score", "expire_at")


_SET_LOG = "SELECT * FROM ll_transaction_log WHERE committed AND target = 'set'"
_AS_ADDED = "CASE WHEN op = 'insert' THEN 'add' ELSE op END AS op, CASE WHEN op = 'insert' THEN CAST(0 AS DOUBLE) ELSE score END AS score"

query(
    "apply_set_range",
    _items_check(
        "score",
        f"""RECURSIVE {_replayed(_SET_LOG)},
c AS (SELECT seq, key, item, {_AS_ADDED}, expire_at FROM log WHERE txn_id NOT IN (SELECT txn_id FROM clashing))""",
    )
    + "\nSELECT id, key, score, item AS value, expireat FROM done",
)(lambda ledger: transactions.apply_set_range(_set_snapshot(ledger), _set_batches(ledger), FIRST_ID)[0])

# A state for an unknown job voids its transaction before any batch insert is looked at.
_VOID = f"""RECURSIVE whole AS (SELECT * FROM ll_transaction_log WHERE committed),
stateless AS (SELECT DISTINCT txn_id FROM whole
              WHERE target = 'job' AND op IN ('set_state', 'add_state') AND jobid NOT IN (SELECT id FROM ll_job)),
{_replayed("SELECT * FROM whole WHERE target = 'set' AND txn_id NOT IN (SELECT txn_id FROM stateless)")},
void AS (SELECT txn_id, '{transactions.UNKNOWN_JOB}' AS reason FROM stateless
         UNION ALL SELECT txn_id, '{transactions.EXISTING_MEMBER}' FROM clashing),
good AS (SELECT * FROM whole WHERE txn_id NOT IN (SELECT txn_id FROM void))"""


def _all_tables(ledger: Ledger):
    named = {name: ledger[name] for name in ("job", "state", "jobqueue", "counter")}
    named |= {"set": _set_snapshot(ledger), "hash": _hash_snapshot(ledger), "list": _list_snapshot(ledger)}
    return transactions.apply_transactions(named, _committed(ledger, "transaction_log"), FIRST_ID)


@query("void_transactions", f"WITH {_VOID}\nSELECT txn_id, reason FROM void")
def _void_transactions(ledger: Ledger):
    return transactions.void_transactions(
        ledger["job"],
        _set_snapshot(ledger),
        _committed(ledger, "transaction_log").select(
            "txn_id", "seq",
            *[F.when(F.col("target").isin("set", "job"), F.col("op")).alias("op")],
            *[F.when(F.col("target") == "set", F.col(c)).alias(c) for c in ("key", "item")],
            F.when(F.col("target") == "job", F.col("jobid")).alias("jobid"),
        ),
    )


@query(
    "apply_transactions",
    _items_check("score", f"{_VOID},\nc AS (SELECT seq, key, item, {_AS_ADDED}, expire_at FROM good WHERE target = 'set')")
    + f""",
last_state AS (SELECT jobid, max(seq) AS seq, arg_max(name, seq) AS name FROM good WHERE target = 'job' AND op = 'set_state' GROUP BY jobid),
last_expiry AS (SELECT jobid, arg_max(ts, seq) AS ts, arg_max(coalesce(ttl_seconds, -1), seq) AS ttl
                FROM good WHERE target = 'job' AND op = 'expire_job' GROUP BY jobid),
fields AS (SELECT key, item, min(seq) AS born, arg_max(value, seq) AS value FROM good WHERE target = 'hash' GROUP BY key, item)
SELECT 'set' AS target, id, key AS owner, item AS what, CAST(score AS VARCHAR) AS value, expireat FROM done
UNION ALL
SELECT 'job', j.id, CAST(coalesce({FIRST_ID} + l.seq, j.stateid) AS VARCHAR), coalesce(l.name, j.statename), j.invocationdata,
       CASE WHEN e.jobid IS NULL THEN j.expireat WHEN e.ttl >= 0 THEN e.ts + to_seconds(CAST(floor(e.ttl) AS BIGINT)) END
FROM ll_job j LEFT JOIN last_state l ON l.jobid = j.id LEFT JOIN last_expiry e ON e.jobid = j.id
UNION ALL
SELECT 'state', id, CAST(jobid AS VARCHAR), name, reason, createdat FROM ll_state
UNION ALL
SELECT 'state', {FIRST_ID} + seq, CAST(jobid AS VARCHAR), name, reason, ts FROM good
WHERE target = 'job' AND op IN ('set_state', 'add_state')
UNION ALL
SELECT 'queue', id, CAST(jobid AS VARCHAR), queue, CAST(updatecount AS VARCHAR), fetchedat FROM ll_jobqueue
UNION ALL
SELECT 'queue', {FIRST_ID} + seq, CAST(jobid AS VARCHAR), queue, '0', NULL FROM good WHERE target = 'queue'
UNION ALL
SELECT 'counter', id, key, NULL, CAST(value AS VARCHAR), expireat FROM ll_counter
UNION ALL
SELECT 'counter', {FIRST_ID} + seq, key, NULL, '1', ts + to_seconds(CAST(floor(ttl_seconds) AS BIGINT)) FROM good WHERE target = 'counter'
UNION ALL
SELECT 'list', id, key, NULL, item, expireat FROM ll_keyed_snapshot
UNION ALL
SELECT 'list', {FIRST_ID} + seq, key, NULL, item, NULL FROM good WHERE target = 'list'
UNION ALL
SELECT 'hash', s.id, s.key, s.item, coalesce(f.value, CAST(CAST(round(s.score * 100) AS BIGINT) AS VARCHAR)), s.expireat
FROM ll_keyed_snapshot s LEFT JOIN fields f ON f.key = s.key AND f.item = s.item
UNION ALL
SELECT 'hash', {FIRST_ID} + born, key, item, value, NULL FROM fields f
WHERE NOT EXISTS (SELECT 1 FROM ll_keyed_snapshot s WHERE s.key = f.key AND s.item = f.item)""",
)
def _apply_transactions(ledger: Ledger):
    """All next tables in one shape."""
    after, _ = _all_tables(ledger)
    text = lambda c: F.col(c).cast("string")
    none = F.lit(None).cast("string")
    shapes = [
        ("set", "set", F.col("key"), F.col("value"), text("score"), "expireat"),
        ("job", "job", text("stateid"), F.col("statename"), F.col("invocationdata"), "expireat"),
        ("state", "state", text("jobid"), F.col("name"), F.col("reason"), "createdat"),
        ("jobqueue", "queue", text("jobid"), F.col("queue"), text("updatecount"), "fetchedat"),
        ("counter", "counter", F.col("key"), none, text("value"), "expireat"),
        ("list", "list", F.col("key"), none, F.col("value"), "expireat"),
        ("hash", "hash", F.col("key"), F.col("field"), F.col("value"), "expireat"),
    ]
    parts = [
        after[name].select(F.lit(target).alias("target"), "id", owner.alias("owner"), what.alias("what"), value.alias("value"), F.col(at).alias("expireat"))
        for name, target, owner, what, value, at in shapes
    ]
    return reduce(DataFrame.unionByName, parts)


_SERVERS = """
turned AS (SELECT *, last_value(CASE WHEN op IN ('announce', 'remove') THEN op END IGNORE NULLS) OVER (
             PARTITION BY id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS turn
           FROM ll_server_commands),
known AS (SELECT *, CASE WHEN turn = 'announce' THEN TRUE WHEN turn = 'remove' THEN FALSE
                         ELSE id IN (SELECT id FROM ll_server) END AS registered FROM turned)"""

query(
    "apply_servers",
    f"""
WITH {_SERVERS},
effective AS (SELECT * FROM known WHERE op <> 'heartbeat' OR registered),
last AS (SELECT id, arg_max(op, seq) AS op, arg_max(ts, seq) AS ts FROM effective GROUP BY id),
payload AS (SELECT id, arg_max(data, seq) AS data FROM ll_server_commands WHERE op = 'announce' GROUP BY id),
ids AS (SELECT id FROM ll_server UNION SELECT id FROM last)
SELECT i.id, CASE WHEN p.id IS NOT NULL THEN p.data ELSE s.data END AS data,
       CASE WHEN l.id IS NOT NULL THEN l.ts ELSE s.lastheartbeat END AS lastheartbeat
FROM ids i LEFT JOIN ll_server s ON s.id = i.id LEFT JOIN last l ON l.id = i.id LEFT JOIN payload p ON p.id = i.id
WHERE coalesce(l.op, 'none') <> 'remove'""",
)(lambda ledger: apply.apply_servers(ledger["server"], ledger["server_commands"])[0])

query(
    "rejected_heartbeats",
    f"WITH {_SERVERS}\nSELECT seq, ts, id, op, data FROM known WHERE op = 'heartbeat' AND NOT registered",
)(lambda ledger: apply.apply_servers(ledger["server"], ledger["server_commands"])[1])
