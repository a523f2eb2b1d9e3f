"""Queue reads, claims and lease upkeep."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.clock import as_datetime, instant, seconds_between, whole_seconds
from ledgerline.functions.payload import state_fields, utc_time
from ledgerline.functions.ranking import position_in_order, top_per_key
from ledgerline.operators.keys import BROADCAST_ROWS, bounded, id_page, restrict, with_absent_keys
from ledgerline.operators.monitor import with_current_state

# Fixed value: the update counter of a queue row wraps here.
UPDATE_COUNT_WRAP = 2_000_000_000
KEEP_ALIVES_PER_TIMEOUT = 5
FIRST_JOBS = 5


def queues(jobqueue: DataFrame) -> DataFrame:
    """Names of all queues that hold a row."""
    return jobqueue.select("queue").distinct()


def queues_of_sources(jobqueue: DataFrame) -> DataFrame:
    """Queue names per source; a name used by two sources is listed for both."""
    return jobqueue.select("source", "queue").distinct()


def queue_counts(jobqueue: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Waiting and leased rows per queue, duplicates and rows of purged jobs included.

    An asked queue without rows counts 0 and 0.
    """
    counts = (
        restrict(jobqueue, "queue", names)
        .groupBy("queue")
        .agg(
            F.count_if(F.col("fetchedat").isNull()).alias("enqueued"),
            F.count_if(F.col("fetchedat").isNotNull()).alias("fetched"),
        )
    )
    return with_absent_keys(counts, "queue", names, {"enqueued": F.lit(0), "fetched": F.lit(0)})


def _id_page(jobqueue: DataFrame, job: DataFrame, queue: str, fetched: bool, offset: int, limit: int) -> DataFrame:
    """Page of distinct ids of waiting or leased rows whose job exists, lowest first.

    Made distinct before the join, so a job queued many times is combined map-side.
    """
    wanted = F.col("fetchedat").isNotNull() if fetched else F.col("fetchedat").isNull()
    ids = jobqueue.where((F.col("queue") == queue) & wanted).select(F.col("jobid").alias("id")).distinct()
    return id_page(ids.join(job.select("id"), "id", "left_semi"), offset, limit, derived=True)


def enqueued_job_ids(jobqueue: DataFrame, job: DataFrame, queue: str, offset: int, limit: int) -> DataFrame:
    """Page of distinct existing job ids waiting in a queue, lowest first."""
    return _id_page(jobqueue, job, queue, False, offset, limit).select(F.col("id").alias("job_id"))


def fetched_job_ids(jobqueue: DataFrame, job: DataFrame, queue: str, offset: int, limit: int) -> DataFrame:
    """Page of distinct existing job ids leased from a queue, lowest first."""
    return _id_page(jobqueue, job, queue, True, offset, limit).select(F.col("id").alias("job_id"))


def _enqueued_at() -> Column:
    at = utc_time(state_fields(F.col("state_data"))["enqueuedat"])
    return F.when(F.col("state_name") == "Enqueued", at)


def enqueued_jobs(
    jobqueue: DataFrame, job: DataFrame, state: DataFrame, queue: str, offset: int, limit: int
) -> DataFrame:
    """Page of waiting jobs with their state; the enqueue time is shown only in state Enqueued.

    Every id on the page comes from a waiting row of the same snapshot, so the rule "some queue row
    of the job is waiting" already holds and the queue need not be joined a second time.
    """
    ids = _id_page(jobqueue, job, queue, False, offset, limit)
    jobs = job.join(bounded(ids, limit), "id", "left_semi")
    return with_current_state(jobs, state, limit).select(
        F.col("id").alias("job_id"),
        "invocationdata",
        "arguments",
        F.col("state_name").alias("state"),
        _enqueued_at().alias("enqueued_at"),
    )


def fetched_jobs(jobqueue: DataFrame, job: DataFrame, queue: str, offset: int, limit: int) -> DataFrame:
    """Page of leased jobs, one row per job with its latest lease start in any queue."""
    ids = _id_page(jobqueue, job, queue, True, offset, limit)
    leases = (
        jobqueue.where(F.col("fetchedat").isNotNull())
        .select(F.col("jobid").alias("id"), "fetchedat")
        .join(bounded(ids, limit), "id", "left_semi")
        .groupBy("id")
        .agg(F.max("fetchedat").alias("fetched_at"))
    )
    return job.join(bounded(leases, limit), "id").select(
        F.col("id").alias("job_id"),
        "invocationdata",
        "arguments",
        F.col("statename").alias("state"),
        "fetched_at",
    )


def queue_overview(jobqueue: DataFrame, job: DataFrame, state: DataFrame, first: int = FIRST_JOBS) -> DataFrame:
    """Every queue with its counts and its first waiting jobs, one row per shown job.

    A queue with nothing waiting keeps one row with NULL job columns.
    """
    waiting = jobqueue.where(F.col("fetchedat").isNull()).select("queue", F.col("jobid").alias("id")).distinct()
    live = waiting.join(job.select("id", "stateid"), "id")
    firsts = with_current_state(top_per_key(live, ["queue"], [F.col("id")], first), state).select(
        "queue",
        F.col("rank").cast("bigint").alias("rank"),
        F.col("id").alias("job_id"),
        F.col("state_name").alias("state"),
        _enqueued_at().alias("enqueued_at"),
    )
    return queue_counts(jobqueue).join(firsts, "queue", "left")


def claimable(jobqueue: DataFrame, names: Sequence[str], timeout: timedelta, asof: datetime | str) -> DataFrame:
    """Rows a worker may take: never leased, or leased longer ago than the whole-second timeout."""
    if not names:
        raise ValueError("at least one queue name is needed")
    oldest = as_datetime(asof) - timedelta(seconds=whole_seconds(timeout))
    free = F.col("fetchedat").isNull() | (F.col("fetchedat") < instant(oldest))
    return jobqueue.where(F.col("queue").isin(list(names)) & free)


def claim_order() -> list[Column]:
    """Never-leased rows first, then by queue name and job id; the row id settles ties."""
    return [F.col("fetchedat").asc_nulls_first(), F.col("queue"), F.col("jobid"), F.col("id")]


def claim_batch(
    jobqueue: DataFrame, names: Sequence[str], timeout: timedelta, asof: datetime | str, workers: int
) -> DataFrame:
    """The rows ``workers`` idle workers take now, stamped, with the worker's ``slot``.

    Few workers' rows are the first of each task's first; for many, rows are numbered in ranges of the claim order."""
    if workers < 1:
        raise ValueError("at least one worker is needed")
    free = claimable(jobqueue, names, timeout, asof)
    if workers > BROADCAST_ROWS:
        placed = position_in_order(free, [], claim_order(), "slot").where(F.col("slot") < workers)
        return stamped(placed.withColumn("slot", F.col("slot") + 1), asof)
    first = free.orderBy(*claim_order()).limit(workers)
    # Only the claimed rows, one per worker, meet in this window.
    slots = first.withColumn("slot", F.row_number().over(Window.orderBy(*claim_order())))
    return stamped(slots, asof)


def claim_per_queue(
    jobqueue: DataFrame, names: Sequence[str], timeout: timedelta, asof: datetime | str, workers: int
) -> DataFrame:
    """The same with ``workers`` idle workers subscribed to each queue alone."""
    if workers < 1:
        raise ValueError("at least one worker is needed")
    free = claimable(jobqueue, names, timeout, asof)
    return stamped(top_per_key(free, ["queue"], claim_order(), workers).withColumnRenamed("rank", "slot"), asof)


def stamped(claims: DataFrame, asof: datetime | str) -> DataFrame:
    return claims.select(
        "id",
        "jobid",
        "queue",
        instant(asof).alias("fetchedat"),
        ((F.col("updatecount") + 1) % UPDATE_COUNT_WRAP).cast("int").alias("updatecount"),
        F.col("slot").cast("bigint").alias("slot"),
    )


def apply_claims(jobqueue: DataFrame, claims: DataFrame) -> DataFrame:
    """Next queue after a set of claims."""
    stamps = claims.select("id", F.col("fetchedat").alias("_at"), F.col("updatecount").alias("_count"))
    return jobqueue.join(stamps, "id", "left").select(
        "id",
        "jobid",
        "queue",
        F.coalesce("_at", "fetchedat").alias("fetchedat"),
        F.coalesce("_count", "updatecount").alias("updatecount"),
    )


def _tokens(df: DataFrame) -> DataFrame:
    return df.where(F.col("token").isNotNull()).select("id", F.col("token").alias("fetchedat")).distinct()


def apply_acks(jobqueue: DataFrame, acks: DataFrame) -> DataFrame:
    """Next queue after acknowledgements ``(id, token)``; a stale token does nothing."""
    return jobqueue.join(_tokens(acks), ["id", "fetchedat"], "left_anti").select(*jobqueue.columns)


def apply_requeues(jobqueue: DataFrame, requeues: DataFrame) -> DataFrame:
    """Next queue after giving leases back ``(id, token)``; a stale token does nothing."""
    returned = _tokens(requeues).withColumn("_returned", F.lit(True))
    return jobqueue.join(returned, ["id", "fetchedat"], "left").select(
        "id",
        "jobid",
        "queue",
        F.when(F.col("_returned").isNull(), F.col("fetchedat")).alias("fetchedat"),
        "updatecount",
    )


def apply_keep_alives(jobqueue: DataFrame, beats: DataFrame) -> DataFrame:
    """Next queue after keep-alives ``(id, token, ts)``; a stale token does nothing.

    A keep-alive replaces the token, so of several with one token only the first counts.
    """
    first = (
        beats.where(F.col("token").isNotNull())
        .groupBy("id", F.col("token").alias("fetchedat"))
        .agg(F.min("ts").alias("_ts"))
    )
    return jobqueue.join(first, ["id", "fetchedat"], "left").select(
        "id", "jobid", "queue", F.coalesce("_ts", "fetchedat").alias("fetchedat"), "updatecount"
    )


def lease_due(jobqueue: DataFrame, timeout: timedelta, asof: datetime | str) -> DataFrame:
    """Leases whose holder owes a keep-alive: a fifth of the timeout has passed since the last one."""
    latest = as_datetime(asof) - timeout / KEEP_ALIVES_PER_TIMEOUT
    idle = seconds_between(F.col("fetchedat"), instant(asof))
    return jobqueue.where(F.col("fetchedat") <= instant(latest)).select(
        "id", "jobid", "queue", "fetchedat", idle.alias("idle_seconds")
    )
