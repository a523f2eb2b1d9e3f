"""Upkeep jobs: counter rollup, expiry purge with cascade, compaction, silent workers."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.clock import as_datetime, instant
from ledgerline.operators.keys import merged
from ledgerline.sources.schemas import EXPIRING_TABLES

# The counters that compaction looks after.
COMPACTED_COUNTERS = ("stats:succeeded", "stats:deleted")


def counter_rollup(counter: DataFrame, aggregated: DataFrame, first_id: int = 0) -> tuple[DataFrame, DataFrame]:
    """Next (aggregatedcounter, counter): every delta is summed into its key's rolled-up value.

    A key with new deltas takes their latest expiry, even NULL; the maximum ignores NULLs, so one
    expiring delta makes a key expire. Both results come from one snapshot, so no delta is lost, and all
    deltas are consumed. The two tables number their rows apart: a new key gets ``first_id`` plus its lowest
    delta id, so ``first_id`` must lie above the ids of rolled-up counters.
    """
    deltas = counter.groupBy("key").agg(
        F.min("id").alias("_id"), F.sum("value").alias("_value"), F.max("expireat").alias("_expireat")
    )
    fresh = F.col("_id").isNotNull()
    rolled = merged(aggregated, deltas, ["key"]).select(
        F.coalesce(F.col("id"), F.lit(first_id) + F.col("_id")).cast("bigint").alias("id"),
        "key",
        (F.coalesce("value", F.lit(0)) + F.coalesce("_value", F.lit(0))).alias("value"),
        F.when(fresh, F.col("_expireat")).otherwise(F.col("expireat")).alias("expireat"),
    )
    return rolled, counter.limit(0)


def counter_compaction(counter: DataFrame, names: tuple[str, ...] = COMPACTED_COUNTERS) -> DataFrame:
    """Next counter table with the never-expiring deltas of ``names`` collapsed to one row each.

    A counter whose total is zero or negative disappears.
    """
    collapsible = F.col("key").isin(*names) & F.col("expireat").isNull()
    totals = (
        counter.where(collapsible)
        .groupBy("key")
        .agg(F.min("id").alias("id"), F.sum("value").alias("value"))
        .where(F.col("value") > 0)
        .select("id", "key", "value", F.lit(None).cast(counter.schema["expireat"].dataType).alias("expireat"))
    )
    return counter.where(~collapsible).select("id", "key", "value", "expireat").unionByName(totals)


def purge(df: DataFrame, asof: datetime | str) -> DataFrame:
    """Rows that outlive ``asof``: without expiry, or expiring at it or later."""
    return df.where(F.col("expireat").isNull() | (F.col("expireat") >= instant(asof)))


def expired(df: DataFrame, asof: datetime | str) -> DataFrame:
    """Rows that a purge at ``asof`` removes."""
    return df.where(F.col("expireat") < instant(asof))


def purge_cascade(children: DataFrame, job: DataFrame, asof: datetime | str) -> DataFrame:
    """Rows of a job's dependent table (state, jobparameter) that outlive the purge of jobs."""
    gone = expired(job, asof).select(F.col("id").alias("jobid"))
    return children.join(gone, "jobid", "left_anti").select(*children.columns)


def purge_summary(tables: Mapping[str, DataFrame], asof: Mapping[str, datetime | str]) -> DataFrame:
    """Rows per expiring table that a purge removes and keeps."""
    counts = [
        tables[name].agg(
            F.lit(name).alias("table_name"),
            F.count_if(F.col("expireat") < instant(asof[name])).alias("removed"),
            F.count(F.lit(1)).alias("total"),
        )
        for name in EXPIRING_TABLES
        if name in tables
    ]
    summary = reduce(DataFrame.unionByName, counts)
    return summary.select("table_name", "removed", (F.col("total") - F.col("removed")).alias("kept"))


def orphan_queue_rows(jobqueue: DataFrame, job: DataFrame) -> DataFrame:
    """Queue rows whose job does not exist (a purge does not touch the queue)."""
    known = job.select(F.col("id").alias("jobid"))
    return jobqueue.join(known, "jobid", "left_anti").select(*jobqueue.columns)


def live_servers(server: DataFrame, timeout: timedelta, asof: datetime | str) -> DataFrame:
    """Workers that were heard from within ``timeout`` (compared in whole milliseconds)."""
    if timeout < timedelta(0):
        raise ValueError("the timeout must not be negative")
    oldest = as_datetime(asof) - timedelta(milliseconds=timeout // timedelta(milliseconds=1))
    return server.where(F.col("lastheartbeat") >= instant(oldest))
