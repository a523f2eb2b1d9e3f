"""Reads of the job ledger: counts, pages per state, details, statistics, timelines."""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.clock import as_datetime, instant
from ledgerline.functions.payload import SERVER_PAYLOAD, state_fields, utc_time, whole_number
from ledgerline.functions.ranking import range_per_key
from ledgerline.operators.keys import Keys, bounded, check_page, group, id_page, restrict

# State names, counter keys and the key of the recurring-job set.
STATE_NAMES = ("Enqueued", "Scheduled", "Processing", "Succeeded", "Failed", "Deleted")
RECURRING_SET = "recurring-jobs"
STATS_PREFIX = "stats:"

_JOB_COLUMNS = ("id", "invocationdata", "arguments", "createdat", "expireat", "statename", "stateid")


def jobs_by_state(job: DataFrame) -> DataFrame:
    """Number of jobs in each current state; the known states appear even when empty.

    Jobs without a state are in no count.
    """
    counts = job.where(F.col("statename").isNotNull()).groupBy("statename").agg(F.count(F.lit(1)).alias("jobs"))
    known = job.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(name) for name in STATE_NAMES])).alias("statename"),
        F.lit(0).cast("bigint").alias("jobs"),
    )
    return counts.unionByName(known).groupBy("statename").agg(F.sum("jobs").alias("jobs"))


def with_current_state(page: DataFrame, state: DataFrame, rows: int | None = None) -> DataFrame:
    """``page`` with name, reason and data of the state its ``stateid`` points at (NULL when missing).

    The state history is the large side, so it is cut down by a semi join with the page's ids, which
    are broadcast when the page is bounded, before the outer join. Payloads may be of any width, so
    they are never broadcast by hint.
    """
    wanted = bounded(page.where(F.col("stateid").isNotNull()).select(F.col("stateid").alias("id")), rows)
    current = (
        state.select("id", "name", "reason", "data")
        .join(wanted, "id", "left_semi")
        .select(
            F.col("id").alias("stateid"),
            F.col("name").alias("state_name"),
            F.col("reason").alias("state_reason"),
            F.col("data").alias("state_data"),
        )
    )
    return page.join(current, "stateid", "left")


def jobs_in_state(job: DataFrame, state: DataFrame, name: str, offset: int, limit: int) -> DataFrame:
    """One page of the jobs in a state, newest id first, with the current state's reason and data."""
    page = id_page(job.where(F.col("statename") == name).select(*_JOB_COLUMNS), offset, limit, descending=True)
    return with_current_state(page, state, limit)


def _decoded(page: DataFrame, columns: dict[str, Column]) -> DataFrame:
    # Payloads are parsed after paging, and once per row.
    parsed = page.withColumn("_fields", state_fields(F.col("state_data")))
    kept = [F.col("id").alias("job_id"), "invocationdata", "arguments"]
    return parsed.select(*kept, *[c.alias(n) for n, c in columns.items()]).orderBy(F.col("job_id").desc())


def _field(name: str) -> Column:
    return F.col("_fields")[name.lower()]


def _has(name: str) -> Column:
    return F.map_contains_key(F.col("_fields"), name.lower())


def processing_jobs(job: DataFrame, state: DataFrame, offset: int, limit: int) -> DataFrame:
    """Processing jobs. The server is ServerId when that key is present, even if null, else ServerName."""
    page = jobs_in_state(job, state, "Processing", offset, limit)
    return _decoded(
        page,
        {
            "server_id": F.when(_has("ServerId"), _field("ServerId")).otherwise(_field("ServerName")),
            "started_at": utc_time(_field("StartedAt")),
        },
    )


def scheduled_jobs(job: DataFrame, state: DataFrame, offset: int, limit: int) -> DataFrame:
    page = jobs_in_state(job, state, "Scheduled", offset, limit)
    return _decoded(
        page,
        {"enqueue_at": utc_time(_field("EnqueueAt")), "scheduled_at": utc_time(_field("ScheduledAt"))},
    )


def failed_jobs(job: DataFrame, state: DataFrame, offset: int, limit: int) -> DataFrame:
    page = jobs_in_state(job, state, "Failed", offset, limit)
    return _decoded(
        page,
        {
            "reason": F.col("state_reason"),
            "exception_type": _field("ExceptionType"),
            "exception_message": _field("ExceptionMessage"),
            "exception_details": _field("ExceptionDetails"),
            "failed_at": utc_time(_field("FailedAt")),
        },
    )


def succeeded_jobs(job: DataFrame, state: DataFrame, offset: int, limit: int) -> DataFrame:
    """Succeeded jobs; the total duration is known only when both of its parts are recorded."""
    page = jobs_in_state(job, state, "Succeeded", offset, limit)
    total = whole_number(_field("PerformanceDuration")) + whole_number(_field("Latency"))
    return _decoded(
        page,
        {
            "result": _field("Result"),
            "total_duration": F.when(_has("PerformanceDuration") & _has("Latency"), total),
            "succeeded_at": utc_time(_field("SucceededAt")),
        },
    )


def deleted_jobs(job: DataFrame, state: DataFrame, offset: int, limit: int) -> DataFrame:
    page = jobs_in_state(job, state, "Deleted", offset, limit)
    return _decoded(page, {"deleted_at": utc_time(_field("DeletedAt"))})


def jobs_page_per_state(job: DataFrame, state: DataFrame, offset: int, limit: int) -> DataFrame:
    """The same page of every state at once."""
    check_page(offset, limit)
    live = job.where(F.col("statename").isNotNull()).select(*_JOB_COLUMNS)
    page = range_per_key(live, ["statename"], offset, offset + limit - 1, descending=True)
    return with_current_state(page, state).select(
        "statename",
        "position",
        F.col("id").alias("job_id"),
        "invocationdata",
        "arguments",
        "createdat",
        "expireat",
        "state_reason",
        "state_data",
    )


def job_details(job: DataFrame, parameters: DataFrame, state: DataFrame, ids: Keys = None) -> DataFrame:
    """Job, its parameters and its state history, one row per fact.

    ``section`` is 'job', 'parameter' or 'state'; a job's history reads newest first by descending
    ``state_id``. Facts stay rows, so a job with a huge history is spread like any other data.
    A parameter stored twice shows its newest value. Unknown ids give no rows: states and parameters
    reference their job, so none of theirs is stored and no existence join is needed.
    """
    jobs = restrict(job, "id", ids)
    none, when = F.lit(None).cast("string"), F.lit(None).cast("timestamp_ntz")
    no_id = F.lit(None).cast("bigint")
    head = jobs.select(
        F.col("id").alias("job_id"),
        F.lit("job").alias("section"),
        no_id.alias("state_id"),
        F.col("statename").alias("name"),
        F.col("arguments").alias("reason"),
        F.col("invocationdata").alias("value"),
        F.col("createdat").alias("at"),
        F.col("expireat").alias("expire_at"),
    )
    properties = (
        group(restrict(parameters, "jobid", ids), "jobid", "name")
        .agg(F.max_by("value", "id").alias("value"))
        .select(
            F.col("_by.jobid").alias("job_id"),
            F.lit("parameter").alias("section"),
            no_id.alias("state_id"),
            "_by.name",
            none.alias("reason"),
            "value",
            when.alias("at"),
            when.alias("expire_at"),
        )
    )
    history = restrict(state, "jobid", ids).select(
        F.col("jobid").alias("job_id"),
        F.lit("state").alias("section"),
        F.col("id").alias("state_id"),
        "name",
        "reason",
        F.col("data").alias("value"),
        F.col("createdat").alias("at"),
        when.alias("expire_at"),
    )
    return head.unionByName(properties).unionByName(history)


def job_data(job: DataFrame, ids: Keys = None) -> DataFrame:
    """Invocation (as a map), arguments (as an array), state name and creation time of jobs."""
    return restrict(job, "id", ids).select(
        F.col("id").alias("job_id"),
        F.from_json("invocationdata", "map<string,string>").alias("invocation"),
        F.from_json("arguments", "array<string>").alias("arguments"),
        "statename",
        "createdat",
    )


def state_data(job: DataFrame, state: DataFrame, ids: Keys = None) -> DataFrame:
    """Name, reason and data of each job's current state; jobs without one give no row."""
    pointers = restrict(job, "id", ids).select(F.col("id").alias("job_id"), F.col("stateid").alias("id"))
    return pointers.join(state.select("id", "name", "reason", "data"), "id").drop("id")


def job_parameters(parameters: DataFrame, names: list[str], ids: Keys = None) -> DataFrame:
    """The named parameters of each job, one column per name."""
    if not names:
        raise ValueError("at least one parameter name is needed")
    newest = [F.max_by("value", F.when(F.col("name") == n, F.col("id"))).alias(n) for n in names]
    chosen = restrict(parameters, "jobid", ids).where(F.col("name").isin(names))
    return group(chosen, "jobid").agg(*newest).select(F.col("_by.jobid").alias("job_id"), *names)


def statistics(
    job: DataFrame,
    counter: DataFrame,
    aggregated: DataFrame,
    sets: DataFrame,
    server: DataFrame,
    queues: DataFrame,
) -> DataFrame:
    """The dashboard row. Succeeded and Deleted come from the counters, not from the job rows.

    ``queues`` holds one row per (source, queue). Each source is reduced to (metric, n) rows first,
    so the final aggregate reads a handful of rows.
    """
    live = ("Enqueued", "Failed", "Processing", "Scheduled")
    by_state = (
        job.where(F.col("statename").isin(*live))
        .groupBy(F.lower("statename").alias("metric"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    totals = (
        counter.select("key", "value")
        .unionByName(aggregated.select("key", "value"))
        .where(F.col("key").isin(STATS_PREFIX + "succeeded", STATS_PREFIX + "deleted"))
        .groupBy(F.substring_index("key", ":", -1).alias("metric"))
        .agg(F.sum("value").alias("n"))
    )

    def rows(df: DataFrame, metric: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(metric).alias("metric"), "n")

    parts = [
        by_state,
        totals,
        rows(server, "servers"),
        rows(sets.where(F.col("key") == RECURRING_SET), "recurring"),
        rows(queues, "queues"),
    ]
    metrics = ("enqueued", "failed", "processing", "scheduled", "servers", "succeeded", "deleted", "recurring", "queues")
    return reduce(DataFrame.unionByName, parts).agg(
        *[F.coalesce(F.sum(F.when(F.col("metric") == m, F.col("n"))), F.lit(0)).alias(m) for m in metrics]
    )


def servers(server: DataFrame) -> DataFrame:
    """Workers with their decoded payload; an unknown start is the earliest representable time, an unknown
    number of threads 0."""
    payload = F.from_json("data", SERVER_PAYLOAD)
    earliest = F.lit("0001-01-01 00:00:00").cast("timestamp_ntz")
    return server.withColumn("_payload", payload).select(
        F.col("id").alias("name"),
        F.col("lastheartbeat").alias("heartbeat"),
        F.col("_payload.Queues").alias("queues"),
        F.coalesce(utc_time(F.col("_payload.StartedAt")), earliest).alias("started_at"),
        F.coalesce("_payload.WorkerCount", F.lit(0)).alias("workers_count"),
    )


def _timeline(
    counter: DataFrame, aggregated: DataFrame, kinds: tuple[str, ...], points: list[datetime], pattern: str
) -> DataFrame:
    labels = [(kind, at, f"{STATS_PREFIX}{kind}:{at.strftime(pattern)}") for kind in kinds for at in points]
    totals = (
        aggregated.select("key", "value")
        .unionByName(counter.select("key", "value"))
        .where(F.col("key").isin([key for _, _, key in labels]))
        .groupBy("key")
        .agg(F.sum("value").alias("n"))
    )
    slots = counter.sparkSession.range(1).select(
        F.inline(
            F.array(
                *[F.struct(F.lit(k).alias("kind"), instant(at).alias("at"), F.lit(key).alias("key")) for k, at, key in labels]
            )
        )
    )
    # At most one total per label, so the right side is as small as the label list.
    return slots.join(F.broadcast(totals), "key", "left").select(
        "kind", "at", F.col("key").alias("bucket_key"), F.coalesce("n", F.lit(0)).alias("n")
    )


def daily_timeline(
    counter: DataFrame, aggregated: DataFrame, asof: datetime | str, kinds: tuple[str, ...] = ("succeeded", "failed")
) -> DataFrame:
    """Counts of the last seven days, today included, zero-filled."""
    today = as_datetime(asof).replace(hour=0, minute=0, second=0, microsecond=0)
    days = [today - timedelta(days=i) for i in range(7)]
    return _timeline(counter, aggregated, kinds, days, "%Y-%m-%d")


def hourly_timeline(
    counter: DataFrame, aggregated: DataFrame, asof: datetime | str, kinds: tuple[str, ...] = ("succeeded", "failed")
) -> DataFrame:
    """Counts of the last 24 hours, zero-filled; the labels keep the minutes of ``asof``."""
    end = as_datetime(asof)
    hours = [end - timedelta(hours=i) for i in range(24)]
    return _timeline(counter, aggregated, kinds, hours, "%Y-%m-%d-%H")
