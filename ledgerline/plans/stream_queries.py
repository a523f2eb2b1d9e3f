"""The streaming jobs as named queries: the events table replayed as a stream until it is used up.

Watermark-driven results are final up to the last event minus the delay, which is what the checking
SQL states.
"""

from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.plans.apply_queries import FIRST_ID
from ledgerline.plans.mapping import Ledger, stream_view
from ledgerline.plans.registry import query
from ledgerline.plans.upkeep_queries import ROLLUP_CHECK
from ledgerline.session import work_dir
from ledgerline.streaming import runs, timelines, timers

DELAY = "1 hour"
TIMEOUT = timedelta(minutes=30)
_FINAL = "(SELECT max(ts) - INTERVAL '1' HOUR FROM events)"


def _run_folder(ledger: Ledger) -> str:
    return f"{work_dir(ledger.spark)}/streams/{uuid.uuid4().hex}"


def _emitted(ledger: Ledger, results: DataFrame) -> DataFrame:
    folder = _run_folder(ledger)
    runs.to_files(results, f"{folder}/out", f"{folder}/checkpoint", available_now=True).awaitTermination()
    return ledger.spark.read.schema(results.schema).parquet(f"{folder}/out")


@query("stream_counter_rollup", ROLLUP_CHECK)
def _rollup(ledger: Ledger) -> DataFrame:
    folder = _run_folder(ledger)
    tiers = runs.counter_tiers(ledger.spark, f"{folder}/out")
    runs.rollup_stream(stream_view(ledger, "counter"), tiers, f"{folder}/checkpoint", available_now=True).awaitTermination()
    return runs.rolled_counters(ledger["aggregatedcounter"], tiers, FIRST_ID)


for _name, _width, _part, _pattern in (
    ("stream_hourly_timeline", "1 hour", "hour", "%Y-%m-%d-%H"),
    ("stream_daily_timeline", "1 day", "day", "%Y-%m-%d"),
):
    query(
        _name,
        f"""
SELECT kind, date_trunc('{_part}', ts) AS "at",
       'stats:' || kind || ':' || strftime(date_trunc('{_part}', ts), '{_pattern}') AS bucket_key,
       CAST(sum(delta) AS BIGINT) AS n
FROM ll_event_kind WHERE date_trunc('{_part}', ts) + INTERVAL '1' {_part.upper()} <= {_FINAL}
GROUP BY kind, date_trunc('{_part}', ts)""",
    )(
        lambda ledger, width=_width: _emitted(
            ledger, timelines.timeline_stream(stream_view(ledger, "event_kind"), width, DELAY)
        )
    )


@query(
    "stream_job_states",
    """
SELECT jobid, max(seq) AS seq, arg_max(name, seq) AS statename
FROM ll_job_commands WHERE committed AND op = 'set_state' GROUP BY jobid""",
)
def _job_states(ledger: Ledger) -> DataFrame:
    folder = _run_folder(ledger)
    moves = stream_view(ledger, "job_commands").where(F.col("committed") & (F.col("op") == "set_state"))
    tiers = runs.state_tiers(ledger.spark, f"{folder}/out")
    runs.to_tiers(
        moves, tiers, f"{folder}/checkpoint", available_now=True, shape=lambda batch, _: runs.state_changes(batch)
    ).awaitTermination()
    return runs.current_states(tiers)


query(
    "stream_worker_liveness",
    f"""
WITH beats AS (SELECT 'srv-' || CAST(user_id AS STRING) AS server, ts,
                      lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS next FROM events)
SELECT server, ts AS last_heartbeat, ts + INTERVAL '30' MINUTE AS gone_at FROM beats
WHERE (next IS NULL OR next >= ts + INTERVAL '30' MINUTE) AND ts + INTERVAL '30' MINUTE <= {_FINAL}""",
)(
    lambda ledger: _emitted(
        ledger,
        timelines.liveness_stream(
            ledger.events_stream().selectExpr("ts", "'srv-' || CAST(user_id AS STRING) AS server"), TIMEOUT, DELAY
        ),
    )
)



def _leases_check(log: str) -> str:
    return f"""
WITH log AS ({log}),
turns AS (
  SELECT *, last_value(CASE WHEN op <> 'keep_alive' THEN op END IGNORE NULLS)
              OVER (PARTITION BY id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS turn
  FROM log),
gone AS (SELECT id, min(seq) AS gone FROM turns WHERE op = 'ack' AND turn = 'fetch' GROUP BY id),
acting AS (
  SELECT id, seq, ts, op, lead(ts) OVER (PARTITION BY id ORDER BY seq) AS next
  FROM turns LEFT JOIN gone USING (id) WHERE (gone IS NULL OR seq <= gone) AND (op = 'fetch' OR turn = 'fetch'))
SELECT id, ts AS fetchedat, ts + INTERVAL '30' MINUTE AS expired_at FROM acting
WHERE op IN ('fetch', 'keep_alive')
  AND (next > ts + INTERVAL '30' MINUTE OR (next IS NULL AND ts + INTERVAL '30' MINUTE < {_FINAL}))"""


query("stream_lease_expiry", _leases_check("SELECT * FROM ll_lease_commands"))(
    lambda ledger: _emitted(ledger, timers.lease_stream(stream_view(ledger, "lease_commands"), TIMEOUT, DELAY))
)

query(
    # A lease of the queue is a fetch before the log.
    "stream_lease_expiry_from_queue",
    _leases_check("""
SELECT seq, id, ts, op FROM ll_lease_commands WHERE id IN (SELECT id FROM ll_queue_at_start)
UNION ALL SELECT -1, id, fetchedat, 'fetch' FROM ll_queue_at_start WHERE fetchedat IS NOT NULL"""),
)(
    lambda ledger: _emitted(
        ledger,
        timers.lease_stream(stream_view(ledger, "lease_commands"), TIMEOUT, DELAY, queue=ledger["queue_at_start"]),
    )
)

query(
    "stream_counter_expiry",
    f"SELECT id, expireat FROM ll_counter_all WHERE expireat <= {_FINAL}",
)(lambda ledger: _emitted(ledger, timelines.row_expiry_stream(stream_view(ledger, "counter_all"), DELAY)))

query(
    # The watermark follows the commands that the stream lets through.
    "stream_key_expiry",
    """
WITH touches AS (
  SELECT key, expire_at, ts, lead(ts) OVER (PARTITION BY key ORDER BY seq) AS next
  FROM ll_keyed_commands WHERE committed AND op IN ('expire', 'persist'))
SELECT key, expire_at AS expireat FROM touches
WHERE next > expire_at OR (next IS NULL AND expire_at < (SELECT max(ts) - INTERVAL '1' HOUR FROM touches))""",
)(
    lambda ledger: _emitted(
        ledger,
        timers.key_expiry_stream(
            stream_view(ledger, "keyed_commands").where(F.col("committed") & F.col("op").isin("expire", "persist")),
            DELAY,
        ),
    )
)


@query(
    "stream_new_work",
    """
SELECT queue, count(*) AS enqueued, max(seq) AS last_seq FROM ll_queue_commands WHERE committed GROUP BY queue""",
)
def _new_work(ledger: Ledger) -> DataFrame:
    folder = _run_folder(ledger)
    enqueues = stream_view(ledger, "queue_commands").where("committed")
    runs.to_batches(
        enqueues, f"{folder}/out", f"{folder}/checkpoint", available_now=True, shape=runs.new_work
    ).awaitTermination()
    announced = ledger.spark.read.schema("queue string, enqueued bigint, last_seq bigint").parquet(f"{folder}/out")
    return announced.groupBy("queue").agg(F.sum("enqueued").alias("enqueued"), F.max("last_seq").alias("last_seq"))
