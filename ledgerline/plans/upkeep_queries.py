"""Upkeep jobs and snapshot conversion as named queries."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame

from ledgerline.operators import expiry, maintain
from ledgerline.plans.apply_queries import FIRST_ID
from ledgerline.plans.mapping import ASOF_EVENTS, ASOF_JOBS, Ledger
from ledgerline.plans.registry import query
from ledgerline.session import new_folder
from ledgerline.sources.schemas import EXPIRING_TABLES, SCHEMAS, fill_payloads, normalize_snapshot
from ledgerline.sources.snapshots import SnapshotStore

CLOCKS = {name: ASOF_JOBS if name in ("job", "list") else ASOF_EVENTS for name in EXPIRING_TABLES}

ROLLUP_CHECK = f"""
WITH d AS (SELECT min(id) AS id, key, sum(value) AS value, max(expireat) AS expireat FROM ll_counter GROUP BY key)
SELECT a.id, a.key, CAST(a.value + d.value AS BIGINT) AS value, d.expireat
FROM ll_aggregatedcounter a JOIN d ON d.key = a.key
UNION ALL
SELECT {FIRST_ID} + id, key, CAST(value AS BIGINT), expireat FROM d WHERE key NOT IN (SELECT key FROM ll_aggregatedcounter)
UNION ALL
SELECT id, key, value, expireat FROM ll_aggregatedcounter WHERE key NOT IN (SELECT key FROM d)"""

query("counter_rollup", ROLLUP_CHECK)(
    lambda ledger: maintain.counter_rollup(ledger["counter"], ledger["aggregatedcounter"], FIRST_ID)[0]
)

query(
    "counter_compaction",
    """
SELECT id, key, value, expireat FROM ll_counter
WHERE key NOT IN ('stats:succeeded', 'stats:deleted') OR expireat IS NOT NULL
UNION ALL
SELECT min(id), key, CAST(sum(value) AS BIGINT), NULL FROM ll_counter
WHERE key IN ('stats:succeeded', 'stats:deleted') AND expireat IS NULL GROUP BY key HAVING sum(value) > 0""",
)(lambda ledger: maintain.counter_compaction(ledger["counter"]))

for _table in EXPIRING_TABLES:
    _columns = ", ".join(SCHEMAS[_table].names)
    query(
        f"purge_{_table}",
        f"SELECT {_columns} FROM ll_{_table} WHERE (expireat < {{TS:{CLOCKS[_table]}}}) IS NOT TRUE",
    )(lambda ledger, table=_table: maintain.purge(ledger[table].select(*SCHEMAS[table].names), CLOCKS[table]))



@query("purge_job_by_month", f"SELECT {', '.join(SCHEMAS['job'].names)} FROM ll_job WHERE (expireat < {{TS:{CLOCKS['job']}}}) IS NOT TRUE")
def _purge_by_month(ledger: Ledger) -> DataFrame:
    path, schema = new_folder(ledger.spark), SCHEMAS["job"]
    expiry.write_by_expiry(ledger["job"].select(*schema.names), path, unit="month")
    expiry.purge_by_expiry(ledger.spark, path, schema, CLOCKS["job"], "month")
    return expiry.read_by_expiry(ledger.spark, path, schema).drop(expiry.DAY)


query(
    "purge_summary",
    "\nUNION ALL\n".join(
        f"SELECT '{name}' AS table_name, count(*) FILTER (WHERE expireat < {{TS:{CLOCKS[name]}}}) AS removed, "
        f"count(*) FILTER (WHERE (expireat < {{TS:{CLOCKS[name]}}}) IS NOT TRUE) AS kept FROM ll_{name}"
        for name in EXPIRING_TABLES
    ),
)(lambda ledger: maintain.purge_summary({name: ledger[name] for name in EXPIRING_TABLES}, CLOCKS))

for _name, _table in (("purge_cascade", "state"), ("purge_cascade_parameters", "jobparameter")):
    query(
        _name,
        f"""
SELECT {", ".join(SCHEMAS[_table].names)} FROM ll_{_table} c
WHERE NOT EXISTS (SELECT 1 FROM ll_job j WHERE j.id = c.jobid AND j.expireat < {{TS:{ASOF_JOBS}}})""",
    )(lambda ledger, table=_table: maintain.purge_cascade(ledger[table], ledger["job"], ASOF_JOBS))

query(
    "live_servers",
    f"""
SELECT id, data, lastheartbeat FROM ll_server
WHERE NOT (lastheartbeat < {{TS:{ASOF_EVENTS}}} - INTERVAL '600000 MILLISECONDS')""",
)(lambda ledger: maintain.live_servers(ledger["server"], timedelta(minutes=10), ASOF_EVENTS))

query(
    "upgrade_snapshot",
    """
SELECT CAST(id AS BIGINT) AS id, CAST(stateid AS BIGINT) AS stateid, statename,
       CASE WHEN invocationdata = '' THEN '{}' ELSE invocationdata END AS invocationdata,
       CASE WHEN arguments = '' THEN '[]' ELSE arguments END AS arguments, createdat, expireat FROM ll_old_job""",
)(lambda ledger: normalize_snapshot(ledger["old_job"], "job"))

query(
    "upgrade_queue_snapshot",
    """
SELECT CAST(id AS BIGINT) AS id, jobid, queue, fetchedat, CAST(0 AS INT) AS updatecount FROM ll_old_jobqueue""",
)(lambda ledger: normalize_snapshot(ledger["old_jobqueue"], "jobqueue"))


@query("publish_snapshot", "SELECT id, jobid, queue, fetchedat, updatecount FROM ll_jobqueue")
def _published(ledger: Ledger):
    store = SnapshotStore(ledger.spark, new_folder(ledger.spark))
    tables = {name: ledger[name].select(*SCHEMAS[name].names) for name in ("jobqueue", "server")}
    store.publish(tables, cluster_by={"jobqueue": ["queue", "fetchedat"]})
    # The next version leaves the queue as it is.
    store.publish({"server": tables["server"]})
    store.drop_before(store.current())
    return store.read("jobqueue")


@query(
    "json_defaults",
    """
SELECT seq, coalesce(nullif(invocationdata, ''), '{}') AS invocationdata,
       coalesce(nullif(arguments, ''), '[]') AS arguments FROM ll_job_requests""",
)
def _json_defaults(ledger: Ledger):
    return fill_payloads(ledger["job_requests"].select("seq", "invocationdata", "arguments"), "job")
