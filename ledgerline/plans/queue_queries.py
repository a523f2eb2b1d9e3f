"""Queue reads, claims and leases as named queries."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from ledgerline.operators import claims, leases, maintain, queues
from ledgerline.plans.mapping import ASOF_JOBS, Ledger
from ledgerline.plans.registry import query

QUEUE, OFFSET, LIMIT = "low", 3, 100
CLAIMED_QUEUES = ["urgent", "low", "high"]
TIMEOUT = timedelta(minutes=30)
WORKERS = 200

_NAMES = ", ".join(f"'{name}'" for name in CLAIMED_QUEUES)
_FREE = f"""queue IN ({_NAMES})
  AND (fetchedat IS NULL OR fetchedat < TIMESTAMP '{ASOF_JOBS}' + INTERVAL '-1800 SECONDS')"""


def _ids(fetched: str) -> str:
    return f"""
SELECT jobid AS id FROM ll_jobqueue
WHERE queue = '{QUEUE}' AND fetchedat {fetched} AND jobid IN (SELECT id FROM ll_job)
GROUP BY jobid ORDER BY jobid LIMIT {LIMIT} OFFSET {OFFSET}"""


_ENQUEUED_AT = """CASE WHEN s.name = 'Enqueued'
  THEN CAST(replace(replace(json_extract_string(s.data, '$.EnqueuedAt'), 'T', ' '), 'Z', '') AS TIMESTAMP) END"""

query("queues", "SELECT DISTINCT queue FROM ll_jobqueue")(lambda ledger: queues.queues(ledger["jobqueue"]))

query(
    "queue_counts",
    """
SELECT queue, count(*) - count(fetchedat) AS enqueued, count(fetchedat) AS fetched
FROM ll_jobqueue GROUP BY queue""",
)(lambda ledger: queues.queue_counts(ledger["jobqueue"]))

query("enqueued_job_ids", f"SELECT id AS job_id FROM ({_ids('IS NULL')})")(
    lambda ledger: queues.enqueued_job_ids(ledger["jobqueue"], ledger["job"], QUEUE, OFFSET, LIMIT)
)

query("fetched_job_ids", f"SELECT id AS job_id FROM ({_ids('IS NOT NULL')})")(
    lambda ledger: queues.fetched_job_ids(ledger["jobqueue"], ledger["job"], QUEUE, OFFSET, LIMIT)
)

query(
    "enqueued_jobs",
    f"""
SELECT j.id AS job_id, j.invocationdata, j.arguments, s.name AS state, {_ENQUEUED_AT} AS enqueued_at
FROM ll_job j LEFT JOIN ll_state s ON s.id = j.stateid
WHERE j.id IN ({_ids("IS NULL")})
  AND (EXISTS (SELECT 1 FROM ll_jobqueue q WHERE q.jobid = j.id AND q.fetchedat IS NULL)
       OR NOT EXISTS (SELECT 1 FROM ll_jobqueue q WHERE q.jobid = j.id))""",
)(lambda ledger: queues.enqueued_jobs(ledger["jobqueue"], ledger["job"], ledger["state"], QUEUE, OFFSET, LIMIT))

query(
    "fetched_jobs",
    f"""
SELECT j.id AS job_id, j.invocationdata, j.arguments, j.statename AS state,
       (SELECT max(q.fetchedat) FROM ll_jobqueue q WHERE q.jobid = j.id) AS fetched_at
FROM ll_job j WHERE j.id IN ({_ids("IS NOT NULL")})""",
)(lambda ledger: queues.fetched_jobs(ledger["jobqueue"], ledger["job"], QUEUE, OFFSET, LIMIT))

query(
    "queue_overview",
    f"""
WITH counts AS (SELECT queue, count(*) FILTER (WHERE fetchedat IS NULL) AS enqueued,
                       count(*) FILTER (WHERE fetchedat IS NOT NULL) AS fetched FROM ll_jobqueue GROUP BY queue),
firsts AS (SELECT queue, id, stateid, row_number() OVER (PARTITION BY queue ORDER BY id) AS rank
           FROM (SELECT DISTINCT q.queue, j.id, j.stateid FROM ll_jobqueue q JOIN ll_job j ON j.id = q.jobid
                 WHERE q.fetchedat IS NULL))
SELECT c.queue, c.enqueued, c.fetched, f.rank, f.id AS job_id, s.name AS state, {_ENQUEUED_AT} AS enqueued_at
FROM counts c LEFT JOIN (SELECT * FROM firsts WHERE rank <= 5) f ON f.queue = c.queue
LEFT JOIN ll_state s ON s.id = f.stateid""",
)(lambda ledger: queues.queue_overview(ledger["jobqueue"], ledger["job"], ledger["state"]))

query("claimable", f"SELECT id, jobid, queue, fetchedat, updatecount FROM ll_jobqueue WHERE {_FREE}")(
    lambda ledger: queues.claimable(ledger["jobqueue"], CLAIMED_QUEUES, TIMEOUT, ASOF_JOBS)
)

_CLAIMED = f"""SELECT id, jobid, queue, {{TS:{ASOF_JOBS}}} AS fetchedat,
       CAST((updatecount + 1) % 2000000000 AS INT) AS updatecount, slot"""

query(
    "claim_batch",
    f"""{_CLAIMED}
FROM (SELECT *, row_number() OVER (ORDER BY fetchedat NULLS FIRST, queue, jobid, id) AS slot
      FROM ll_jobqueue WHERE {_FREE}) WHERE slot <= {WORKERS}""",
)(lambda ledger: queues.claim_batch(ledger["jobqueue"], CLAIMED_QUEUES, TIMEOUT, ASOF_JOBS, WORKERS))

query(
    "claim_per_queue",
    f"""{_CLAIMED}
FROM (SELECT *, row_number() OVER (PARTITION BY queue ORDER BY fetchedat NULLS FIRST, jobid, id) AS slot
      FROM ll_jobqueue WHERE {_FREE}) WHERE slot <= {WORKERS}""",
)(lambda ledger: queues.claim_per_queue(ledger["jobqueue"], CLAIMED_QUEUES, TIMEOUT, ASOF_JOBS, WORKERS))


@query(
    "apply_claims",
    f"""
WITH taken AS (SELECT id FROM ll_jobqueue WHERE {_FREE}
               ORDER BY fetchedat NULLS FIRST, queue, jobid, id LIMIT {WORKERS})
SELECT id, jobid, queue, CASE WHEN id IN (SELECT id FROM taken) THEN {{TS:{ASOF_JOBS}}} ELSE fetchedat END AS fetchedat,
       CASE WHEN id IN (SELECT id FROM taken) THEN updatecount + 1 ELSE updatecount END AS updatecount
FROM ll_jobqueue""",
)
def _apply_claims(ledger: Ledger):
    claims = queues.claim_batch(ledger["jobqueue"], CLAIMED_QUEUES, TIMEOUT, ASOF_JOBS, WORKERS)
    return queues.apply_claims(ledger["jobqueue"], claims)


_EXPIRED = f"fetchedat < TIMESTAMP '{ASOF_JOBS}' + INTERVAL '-1800 SECONDS'"

# One worker after the other; the state is how many rows each queue has given.
query(
    "claim_for_workers",
    f"""
WITH RECURSIVE free AS (
  SELECT *, row_number() OVER (ORDER BY fetchedat NULLS FIRST, queue, jobid, id) AS place FROM ll_jobqueue
  WHERE fetchedat IS NULL OR {_EXPIRED}),
names AS (SELECT queue, row_number() OVER (ORDER BY queue) AS q FROM (SELECT DISTINCT queue FROM free)),
heads AS (SELECT n.q, f.place, row_number() OVER (PARTITION BY n.q ORDER BY f.place) - 1 AS k FROM free f JOIN names n ON n.queue = f.queue),
turns AS (SELECT worker, list(n.q) AS qs, row_number() OVER (ORDER BY worker) AS n
          FROM (SELECT DISTINCT worker, unnest(string_split(queues, ',')) AS queue FROM ll_listeners) l JOIN names n ON n.queue = l.queue
          GROUP BY worker),
replay(n, worker, best, given) AS (
  SELECT CAST(0 AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), (SELECT list(CAST(0 AS BIGINT)) FROM names)
  UNION ALL
  SELECT n, worker, best[1], [CASE WHEN i = best[2] THEN given[i] + 1 ELSE given[i] END FOR i IN range(1, len(given) + 1)]
  FROM (SELECT t.n, t.worker, any_value(r.given) AS given, min([h.place, h.q]) AS best
        FROM replay r JOIN turns t ON t.n = r.n + 1 LEFT JOIN heads h ON list_contains(t.qs, h.q) AND h.k = r.given[h.q]
        GROUP BY t.n, t.worker))
{_CLAIMED.replace(", slot", ", r.worker AS slot")} FROM replay r JOIN free f ON f.place = r.best""",
)(
    lambda ledger: claims.claim_for_workers(
        ledger["jobqueue"], ledger["listeners"].withColumn("queues", F.split("queues", ",")), TIMEOUT, ASOF_JOBS
    )
)

query(
    "apply_acks",
    """
SELECT id, jobid, queue, fetchedat, updatecount FROM ll_jobqueue q
WHERE NOT EXISTS (SELECT 1 FROM ll_lease_tokens t WHERE t.id = q.id AND t.token = q.fetchedat)""",
)(lambda ledger: queues.apply_acks(ledger["jobqueue"], ledger["lease_tokens"]))

query(
    "apply_requeues",
    """
SELECT id, jobid, queue, CASE WHEN EXISTS (SELECT 1 FROM ll_lease_tokens t WHERE t.id = q.id AND t.token = q.fetchedat)
                              THEN NULL ELSE fetchedat END AS fetchedat, updatecount
FROM ll_jobqueue q""",
)(lambda ledger: queues.apply_requeues(ledger["jobqueue"], ledger["lease_tokens"]))

query(
    "apply_keep_alives",
    f"""
SELECT id, jobid, queue, CASE WHEN EXISTS (SELECT 1 FROM ll_lease_tokens t WHERE t.id = q.id AND t.token = q.fetchedat)
                              THEN {{TS:{ASOF_JOBS}}} ELSE fetchedat END AS fetchedat, updatecount
FROM ll_jobqueue q""",
)(lambda ledger: queues.apply_keep_alives(ledger["jobqueue"], ledger["lease_tokens"]))

query(
    "lease_due",
    f"""
SELECT id, jobid, queue, fetchedat, date_diff('microsecond', fetchedat, {{TS:{ASOF_JOBS}}}) / 1e6 AS idle_seconds
FROM ll_jobqueue WHERE fetchedat <= {{TS:{ASOF_JOBS}}} - INTERVAL '6' MINUTE""",
)(lambda ledger: queues.lease_due(ledger["jobqueue"], TIMEOUT, ASOF_JOBS))

query(
    "lease_fold",
    """
WITH log AS (SELECT c.*, q.fetchedat AS start FROM ll_lease_commands c JOIN ll_jobqueue q ON q.id = c.id),
turned AS (SELECT *, last_value(CASE WHEN op IN ('fetch', 'requeue') THEN op END IGNORE NULLS) OVER (
             PARTITION BY id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS turn FROM log),
marked AS (SELECT *, CASE WHEN turn = 'fetch' THEN TRUE WHEN turn = 'requeue' THEN FALSE ELSE start IS NOT NULL END AS held
           FROM turned),
gone AS (SELECT DISTINCT id FROM marked WHERE op = 'ack' AND held),
final AS (SELECT id, arg_max(CASE WHEN op = 'requeue' THEN NULL ELSE ts END, seq) AS at,
                 arg_max(op, seq) AS op
          FROM marked WHERE op IN ('fetch', 'requeue') OR (op = 'keep_alive' AND held) GROUP BY id)
SELECT q.id, q.jobid, q.queue,
       CASE WHEN f.id IS NULL THEN q.fetchedat WHEN f.op = 'requeue' THEN NULL ELSE f.at END AS fetchedat, q.updatecount
FROM ll_jobqueue q LEFT JOIN final f ON f.id = q.id WHERE q.id NOT IN (SELECT id FROM gone)""",
)(lambda ledger: leases.lease_fold(ledger["jobqueue"], ledger["lease_commands"]))

query(
    "orphan_queue_rows",
    """
SELECT id, jobid, queue, fetchedat, updatecount FROM ll_jobqueue
WHERE jobid NOT IN (SELECT id FROM ll_job WHERE expireat IS NULL OR expireat >= TIMESTAMP '1999-01-01 00:00:00')""",
)(
    lambda ledger: maintain.orphan_queue_rows(ledger["jobqueue"], maintain.purge(ledger["job"], ASOF_JOBS))
)
