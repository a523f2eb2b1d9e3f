"""Job-ledger reads as named queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import monitor
from ledgerline.operators import queues as queue_ops
from ledgerline.plans.mapping import ASOF_EVENTS, Ledger
from ledgerline.plans.registry import query
from ledgerline.sources.schemas import SCHEMAS, union_sources

OFFSET, LIMIT = 5, 50

for _table in SCHEMAS:
    _columns = ", ".join(SCHEMAS[_table].names)
    query(f"scan_{_table}", f"SELECT {_columns} FROM ll_{_table}")(
        lambda ledger, table=_table: ledger[table].select(*SCHEMAS[table].names)
    )


def _time(*keys: str) -> str:
    """SQL for a time in a state payload under any of the given spellings of its key."""
    found = ", ".join(f"json_extract_string(s.data, '$.{key}')" for key in keys)
    return f"CAST(replace(replace(coalesce({found}, NULL), 'T', ' '), 'Z', '') AS TIMESTAMP)"


def _page_check(state: str, columns: str) -> str:
    return f"""
SELECT j.id AS job_id, j.invocationdata, j.arguments, {columns}
FROM (SELECT * FROM ll_job WHERE statename = '{state}' ORDER BY id DESC LIMIT {LIMIT} OFFSET {OFFSET}) j
LEFT JOIN ll_state s ON j.stateid = s.id"""


def _page(operator):
    return lambda ledger: operator(ledger["job"], ledger["state"], OFFSET, LIMIT)


query(
    "jobs_by_state",
    """
SELECT n.statename, count(j.id) AS jobs
FROM (VALUES ('Enqueued'), ('Scheduled'), ('Processing'), ('Succeeded'), ('Failed'), ('Deleted')) n(statename)
LEFT JOIN ll_job j ON j.statename = n.statename GROUP BY n.statename""",
)(lambda ledger: monitor.jobs_by_state(ledger["job"]))

query(
    "processing_jobs",
    _page_check(
        "Processing",
        "CASE WHEN list_contains(json_keys(s.data), 'ServerId') THEN json_extract_string(s.data, '$.ServerId') "
        f"ELSE json_extract_string(s.data, '$.ServerName') END AS server_id, {_time('StartedAt')} AS started_at",
    ),
)(_page(monitor.processing_jobs))

query(
    "scheduled_jobs",
    _page_check("Scheduled", f"{_time('EnqueueAt')} AS enqueue_at, {_time('ScheduledAt')} AS scheduled_at"),
)(_page(monitor.scheduled_jobs))

query(
    "failed_jobs",
    _page_check(
        "Failed",
        "s.reason, json_extract_string(s.data, '$.ExceptionType') AS exception_type, "
        "json_extract_string(s.data, '$.ExceptionMessage') AS exception_message, "
        f"json_extract_string(s.data, '$.ExceptionDetails') AS exception_details, {_time('FailedAt')} AS failed_at",
    ),
)(_page(monitor.failed_jobs))

query(
    "succeeded_jobs",
    _page_check(
        "Succeeded",
        "json_extract_string(s.data, '$.Result') AS result, "
        "CAST(json_extract_string(s.data, '$.PerformanceDuration') AS BIGINT) "
        "+ CAST(json_extract_string(s.data, '$.latency') AS BIGINT) AS total_duration, "
        f"{_time('SucceededAt', 'SUCCEEDEDAT')} AS succeeded_at",
    ),
)(_page(monitor.succeeded_jobs))

query("deleted_jobs", _page_check("Deleted", f"{_time('DeletedAt')} AS deleted_at"))(_page(monitor.deleted_jobs))

query(
    "jobs_page_per_state",
    f"""
SELECT j.statename, j.rn - 1 AS position, j.id AS job_id, j.invocationdata, j.arguments, j.createdat, j.expireat,
       s.reason AS state_reason, s.data AS state_data
FROM (SELECT *, row_number() OVER (PARTITION BY statename ORDER BY id DESC) AS rn
      FROM ll_job WHERE statename IS NOT NULL) j
LEFT JOIN ll_state s ON s.id = j.stateid
WHERE j.rn > {OFFSET} AND j.rn <= {OFFSET + LIMIT}""",
)(_page(monitor.jobs_page_per_state))

query(
    "job_details",
    """
SELECT id AS job_id, 'job' AS section, CAST(NULL AS BIGINT) AS state_id, statename AS name, arguments AS reason,
       invocationdata AS value, createdat AS at, expireat AS expire_at FROM ll_job
UNION ALL
SELECT jobid, 'parameter', NULL, name, NULL, value, NULL, NULL FROM ll_jobparameter
WHERE jobid IN (SELECT id FROM ll_job)
UNION ALL
SELECT jobid, 'state', id, name, reason, data, createdat, NULL FROM ll_state WHERE jobid IN (SELECT id FROM ll_job)""",
)(lambda ledger: monitor.job_details(ledger["job"], ledger["jobparameter"], ledger["state"]))


@query(
    "job_data",
    """
SELECT id AS job_id, json_extract_string(invocationdata, '$.Type') AS invocation_type,
       json_extract_string(invocationdata, '$.Method') AS invocation_method,
       json_extract_string(arguments, '$[0]') AS first_argument,
       CAST(json_array_length(arguments) AS BIGINT) AS argument_count, statename, createdat
FROM ll_job""",
)
def _job_data(ledger: Ledger):
    return monitor.job_data(ledger["job"]).select(
        "job_id",
        F.col("invocation")["Type"].alias("invocation_type"),
        F.col("invocation")["Method"].alias("invocation_method"),
        F.get("arguments", 0).alias("first_argument"),
        F.size("arguments").cast("bigint").alias("argument_count"),
        "statename",
        "createdat",
    )


query(
    "state_data",
    """
SELECT j.id AS job_id, s.name, s.reason, s.data FROM ll_job j JOIN ll_state s ON s.id = j.stateid""",
)(lambda ledger: monitor.state_data(ledger["job"], ledger["state"]))

query(
    "job_parameters",
    """
SELECT jobid AS job_id, max(CASE WHEN name = 'RetryCount' THEN value END) AS "RetryCount",
       max(CASE WHEN name = 'CurrentCulture' THEN value END) AS "CurrentCulture"
FROM ll_jobparameter WHERE name IN ('RetryCount', 'CurrentCulture') GROUP BY jobid""",
)(lambda ledger: monitor.job_parameters(ledger["jobparameter"], ["RetryCount", "CurrentCulture"]))


def _all_queues(ledger: Ledger):
    return union_sources([("orders", ledger["jobqueue"]), ("documents", ledger["jobqueue_documents"])])


def _total(key: str) -> str:
    parts = [f"coalesce((SELECT sum(value) FROM ll_{t} WHERE key = '{key}'), 0)" for t in ("counter", "aggregatedcounter")]
    return " + ".join(parts)


def _jobs(state: str) -> str:
    return f"(SELECT count(id) FROM ll_job WHERE statename = '{state}')"


query(
    "statistics",
    f"""
SELECT {_jobs("Enqueued")} AS enqueued, {_jobs("Failed")} AS failed, {_jobs("Processing")} AS processing,
       {_jobs("Scheduled")} AS scheduled, (SELECT count(*) FROM ll_server) AS servers,
       CAST({_total("stats:succeeded")} AS BIGINT) AS succeeded, CAST({_total("stats:deleted")} AS BIGINT) AS deleted,
       (SELECT count(*) FROM ll_set WHERE key = 'recurring-jobs') AS recurring,
       (SELECT count(DISTINCT queue) FROM ll_jobqueue) + (SELECT count(DISTINCT queue) FROM ll_jobqueue_documents)
         AS queues""",
)(
    lambda ledger: monitor.statistics(
        ledger["job"],
        ledger["counter"],
        ledger["aggregatedcounter"],
        ledger["set"],
        ledger["server"],
        queue_ops.queues_of_sources(_all_queues(ledger)),
    )
)

query(
    "queues_multi_source",
    """
SELECT DISTINCT 'orders' AS source, queue FROM ll_jobqueue
UNION ALL
SELECT DISTINCT 'documents', queue FROM ll_jobqueue_documents""",
)(lambda ledger: queue_ops.queues_of_sources(_all_queues(ledger)))

query(
    "servers",
    """
SELECT id AS name, lastheartbeat AS heartbeat,
       json_extract_string(data, '$.Queues[0]') || ',' || json_extract_string(data, '$.Queues[1]') AS queues,
       CAST(replace(replace(json_extract_string(data, '$.StartedAt'), 'T', ' '), 'Z', '') AS TIMESTAMP) AS started_at,
       CAST(json_extract_string(data, '$.WorkerCount') AS INT) AS workers_count
FROM ll_server""",
)(lambda ledger: monitor.servers(ledger["server"]).withColumn("queues", F.array_join("queues", ",")))


def _timeline_check(points: str, pattern: str) -> str:
    return f"""
WITH points AS ({points}),
labels AS (SELECT kind, "at", 'stats:' || kind || ':' || strftime("at", '{pattern}') AS bucket_key
           FROM points, (VALUES ('succeeded'), ('failed')) k(kind)),
sums AS (SELECT key, value FROM ll_counter UNION ALL SELECT key, value FROM ll_aggregatedcounter)
SELECT l.kind, l."at", l.bucket_key, CAST(coalesce(sum(b.value), 0) AS BIGINT) AS n
FROM labels l LEFT JOIN sums b ON b.key = l.bucket_key GROUP BY l.kind, l."at", l.bucket_key"""


query(
    "daily_timeline",
    _timeline_check(
        f"SELECT CAST(TIMESTAMP '{ASOF_EVENTS[:10]} 00:00:00' - i * INTERVAL '1' DAY AS TIMESTAMP) AS \"at\" FROM range(7) t(i)",
        "%Y-%m-%d",
    ),
)(lambda ledger: monitor.daily_timeline(ledger["counter"], ledger["aggregatedcounter"], ASOF_EVENTS))

query(
    "hourly_timeline",
    _timeline_check(
        f"SELECT CAST(TIMESTAMP '{ASOF_EVENTS}' - i * INTERVAL '1' HOUR AS TIMESTAMP) AS \"at\" FROM range(24) t(i)",
        "%Y-%m-%d-%H",
    ),
)(lambda ledger: monitor.hourly_timeline(ledger["counter"], ledger["aggregatedcounter"], ASOF_EVENTS))
