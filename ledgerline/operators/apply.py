"""Batch application of command logs to ledger snapshots.

A command row carries a unique, increasing ``seq``; commands of one transaction share ``txn_id``.
Every function takes a snapshot and commands and returns the next snapshot. New rows get the id
``first_id + seq``, so ``first_id`` must lie above the ids in use.

A key, an item or a job may own a large share of the log. Everything that can be combined before
the shuffle is an aggregate, joins keep the log on the side that can be split at run time, and an
aggregate after a join on its own keys goes through ``group``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.clock import plus_seconds, plus_whole_seconds
from ledgerline.functions.payload import json_or_default
from ledgerline.functions.ranking import carry_last, running_sum
from ledgerline.operators.keys import group, merged


def committed_commands(commands: DataFrame, transactions: DataFrame | None = None) -> DataFrame:
    """Commands of committed transactions, by the ``committed`` flag or a frame of committed ids."""
    if transactions is None:
        return commands.where(F.col("committed"))
    return commands.join(transactions.select("txn_id").distinct(), "txn_id", "left_semi")


def reject_unknown_jobs(commands: DataFrame, job: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(commands to apply, rejects): a state for an unknown job fails and voids its whole transaction.

    Expiry commands for unknown jobs are not failures; they simply find nothing to update.
    """
    known = job.select(F.col("id").alias("jobid"))
    rejects = commands.where(F.col("op").isin("set_state", "add_state")).join(known, "jobid", "left_anti")
    void = group(rejects, "txn_id").agg(F.count(F.lit(1))).select("_by.txn_id")
    return commands.join(void, "txn_id", "left_anti"), rejects.select(*commands.columns)


def create_jobs(requests: DataFrame, first_id: int = 0, first_parameter_id: int = 0) -> tuple[DataFrame, DataFrame]:
    """(job rows, jobparameter rows) for requests
    ``(seq, invocationdata, arguments, createdat, expire_in, parameters map)``.

    Parameters are numbered from ``first_parameter_id`` on, in the order of ``seq`` and of the map."""
    job_id = (F.lit(first_id) + F.col("seq")).cast("bigint")
    jobs = requests.select(
        job_id.alias("id"),
        F.lit(None).cast("bigint").alias("stateid"),
        F.lit(None).cast("string").alias("statename"),
        json_or_default(F.col("invocationdata"), "{}").alias("invocationdata"),
        json_or_default(F.col("arguments"), "[]").alias("arguments"),
        "createdat",
        plus_seconds(F.col("createdat"), F.col("expire_in")).alias("expireat"),
    )
    count = F.coalesce(F.size("parameters"), F.lit(0))
    numbered = running_sum(requests.select("seq", "parameters"), F.greatest(count, F.lit(0)), "_earlier")
    parameters = numbered.select("seq", "_earlier", F.posexplode(F.map_entries("parameters")).alias("_pos", "_entry")).select(
        (F.lit(first_parameter_id) + F.col("_earlier") + F.col("_pos")).cast("bigint").alias("id"),
        job_id.alias("jobid"),
        F.col("_entry.key").alias("name"),
        F.col("_entry.value").alias("value"),
    )
    return jobs, parameters


def apply_states(
    job: DataFrame, state: DataFrame, commands: DataFrame, first_id: int = 0
) -> tuple[DataFrame, DataFrame]:
    """Next (job, state). ``set_state`` appends and moves the job's pointer, ``add_state`` only appends.

    Commands are ``(seq, ts, jobid, op, name, reason, data)`` that passed ``reject_unknown_jobs``.
    """
    state_id = (F.lit(first_id) + F.col("seq")).cast("bigint")
    changes = commands.where(F.col("op").isin("set_state", "add_state"))
    appended = changes.select(
        state_id.alias("id"),
        "jobid",
        "name",
        "reason",
        F.col("ts").alias("createdat"),
        json_or_default(F.col("data"), "{}").alias("data"),
    )
    pointers = (
        changes.where(F.col("op") == "set_state")
        .groupBy("jobid")
        .agg(F.max(state_id).alias("_stateid"), F.max_by("name", "seq").alias("_statename"))
        .withColumnRenamed("jobid", "id")
    )
    moved = F.col("_stateid").isNotNull()
    next_job = job.join(pointers, "id", "left").select(
        "id",
        F.coalesce("_stateid", "stateid").alias("stateid"),
        F.when(moved, F.col("_statename")).otherwise(F.col("statename")).alias("statename"),
        *[c for c in job.columns if c not in ("id", "stateid", "statename")],
    )
    return next_job, state.unionByName(appended)


def apply_job_expiry(job: DataFrame, commands: DataFrame) -> DataFrame:
    """Next job table after ``expire_job`` (ts + ttl, fraction of a second dropped) and ``persist_job``."""
    expire_at = F.when(F.col("op") == "expire_job", plus_whole_seconds(F.col("ts"), F.col("ttl_seconds")))
    last = (
        commands.where(F.col("op").isin("expire_job", "persist_job"))
        .groupBy(F.col("jobid").alias("id"))
        .agg(F.max("seq").alias("_seq"), F.max_by(expire_at, "seq").alias("_expireat"))
    )
    value = F.when(F.col("_seq").isNotNull(), F.col("_expireat")).otherwise(F.col("expireat"))
    return job.join(last, "id", "left").withColumn("expireat", value).select(*job.columns)


def apply_job_parameters(
    job: DataFrame, parameters: DataFrame, commands: DataFrame, first_id: int = 0
) -> tuple[DataFrame, DataFrame]:
    """(next jobparameter, rejects): last value per (job, name) wins, NULL included.

    A name stored twice for a job is updated in both rows; a parameter of an unknown job is rejected.
    """
    known = job.select(F.col("id").alias("jobid"))
    rejects = commands.join(known, "jobid", "left_anti").select(*commands.columns)
    last = (
        commands.groupBy("jobid", "name")
        .agg(F.min("seq").alias("_first"), F.max_by("value", "seq").alias("_value"))
        .join(known, "jobid", "left_semi")
    )
    touched = F.col("_first").isNotNull()
    return merged(parameters, last, ["jobid", "name"]).select(
        F.coalesce("id", (F.lit(first_id) + F.col("_first")).cast("bigint")).alias("id"),
        "jobid",
        "name",
        F.when(touched, F.col("_value")).otherwise(F.col("value")).alias("value"),
    ), rejects


def apply_enqueue(jobqueue: DataFrame, commands: DataFrame, first_id: int = 0) -> DataFrame:
    """Next queue after enqueues ``(seq, queue, jobid)``; the same job may be queued again."""
    added = commands.select(
        (F.lit(first_id) + F.col("seq")).cast("bigint").alias("id"),
        "jobid",
        "queue",
        F.lit(None).cast(jobqueue.schema["fetchedat"].dataType).alias("fetchedat"),
        F.lit(0).alias("updatecount"),
    )
    return jobqueue.select(*added.columns).unionByName(added)


def apply_counters(counter: DataFrame, commands: DataFrame, first_id: int = 0) -> DataFrame:
    """Next counter table after ``increment`` / ``decrement`` commands ``(seq, ts, key, op, ttl_seconds)``.

    Without a ttl the delta never expires; with one it expires after its whole seconds.
    """
    value = F.when(F.col("op") == "increment", F.lit(1)).when(F.col("op") == "decrement", F.lit(-1))
    added = commands.where(F.col("op").isin("increment", "decrement")).select(
        (F.lit(first_id) + F.col("seq")).cast("bigint").alias("id"),
        "key",
        value.cast("bigint").alias("value"),
        plus_whole_seconds(F.col("ts"), F.col("ttl_seconds")).alias("expireat"),
    )
    return counter.select(*added.columns).unionByName(added)


def key_commands(commands: DataFrame, removal: Column) -> DataFrame:
    """Per key: its last whole-key removal and its last expire / persist with the expiry it set."""
    touch = F.col("op").isin("expire", "persist")
    return (
        group(commands.where(removal | touch), "key")
        .agg(
            F.max(F.when(removal, F.col("seq"))).alias("_key_kill"),
            F.max(F.when(touch, F.col("seq"))).alias("_touch"),
            F.max_by("expire_at", F.when(touch, F.col("seq"))).alias("_touch_at"),
        )
        .select("_by.key", "_key_kill", "_touch", "_touch_at")
    )


def _apply_items(snapshot: DataFrame, commands: DataFrame, item: str, payload: str, first_id: int) -> DataFrame:
    """Upserts and removals per (key, item), whole-key removals and expiries.

    A row lives if it was added, or was in the snapshot, after its last removal. Its id and the expiries
    that reach it are those since it was (re)created; an upsert changes the payload only.
    """
    by_key = key_commands(commands, F.col("op") == "remove_key")
    removes = commands.where(F.col("op") == "remove")
    by_item = group(removes, "key", "item").agg(F.max("seq").alias("_item_kill")).select("_by.*", "_item_kill")
    killed = F.greatest("_key_kill", "_item_kill")

    live = (
        commands.where(F.col("op").isin("add", "add_score"))
        .select("seq", "key", "item", F.col(payload).alias("_payload"))
        .join(by_key, "key", "left")
        .join(by_item, ["key", "item"], "left")
        .where(killed.isNull() | (F.col("seq") > killed))
    )
    adds = (
        group(live, "key", "item")
        .agg(
            F.min("seq").alias("_born"),
            F.max_by("_payload", "seq").alias("_payload"),
            F.first("_touch").alias("_add_touch"),
            F.first("_touch_at").alias("_add_touch_at"),
        )
        .select("_by.key", "_by.item", "_born", "_payload", "_add_touch", "_add_touch_at")
    )
    base = snapshot.withColumnRenamed(item, "item")
    extended = base.join(by_key, "key", "left").join(by_item, ["key", "item"], "left")
    rows = merged(base, adds, ["key", "item"], extended)
    kept = F.col("id").isNotNull() & killed.isNull()
    added = F.col("_born").isNotNull()
    since = F.when(kept, F.lit(-1)).otherwise(F.col("_born"))
    reached = F.coalesce("_touch", "_add_touch") > since
    values = {
        "id": F.when(kept, F.col("id")).otherwise((F.lit(first_id) + F.col("_born")).cast("bigint")),
        "key": F.col("key"),
        item: F.col("item"),
        payload: F.when(added, F.col("_payload")).otherwise(F.col(payload)),
        "expireat": F.when(reached, F.coalesce("_touch_at", "_add_touch_at")).when(kept, F.col("expireat")),
    }
    return rows.where(kept | added).select(*[values[c].alias(c) for c in snapshot.columns])


def apply_set(sets: DataFrame, commands: DataFrame, first_id: int = 0) -> DataFrame:
    """Next set table. Commands: ``(seq, key, item, op, score, expire_at)`` with op add, add_score,
    remove, remove_key, expire or persist."""
    return _apply_items(sets, commands, "value", "score", first_id)


def apply_hash(hashes: DataFrame, commands: DataFrame, first_id: int = 0) -> DataFrame:
    """Next hash table. Commands as for ``apply_set`` with the field as item and a ``value``."""
    return _apply_items(hashes, commands, "field", "value", first_id)


def apply_servers(server: DataFrame, commands: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(next worker table, rejected heartbeats) for ``(seq, ts, id, op, data)`` with op announce,
    heartbeat or remove. A heartbeat of a worker that is not registered at that moment is rejected."""
    announce, beat = F.col("op") == "announce", F.col("op") == "heartbeat"

    def last(condition: Column, value: Column) -> Column:
        return F.max_by(value, F.when(condition, F.col("seq")))

    latest = commands.groupBy("id").agg(
        F.max(F.when(F.col("op") == "remove", F.col("seq"))).alias("_kill"),
        F.max(F.when(announce, F.col("seq"))).alias("_announced"),
        last(announce, F.col("data")).alias("_data"),
        F.max(F.when(announce | beat, F.col("seq"))).alias("_heard"),
        last(announce | beat, F.col("ts")).alias("_heard_at"),
    )
    since = F.coalesce("_kill", F.lit(-1))
    fresh = F.coalesce(F.col("_announced") > since, F.lit(False))
    stays = F.col("lastheartbeat").isNotNull() & F.col("_kill").isNull()
    heard = F.coalesce(F.col("_heard") > since, F.lit(False))
    next_server = merged(server, latest, ["id"]).where(fresh | stays).select(
        "id",
        F.when(fresh, F.col("_data")).otherwise(F.col("data")).alias("data"),
        F.when(heard, F.col("_heard_at")).otherwise(F.col("lastheartbeat")).alias("lastheartbeat"),
    )
    change = F.when(F.col("op").isin("announce", "remove"), F.col("op"))
    beats = carry_last(commands, ["id"], "seq", change, "_before").where(beat)
    unknown = beats.where(F.col("_before").isNull()).join(server.select("id"), "id", "left_anti")
    rejects = unknown.unionByName(beats.where(F.col("_before") == "remove")).select(*commands.columns)
    return next_server, rejects
