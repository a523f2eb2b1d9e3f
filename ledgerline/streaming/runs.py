"""Streaming queries that write: sinks that replay a batch without counting it twice."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ledgerline.operators.maintain import counter_rollup
from ledgerline.streaming.tiers import FAN, Tiers


def _started(writer: DataStreamWriter, checkpoint: str, available_now: bool, interval: str) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def to_files(
    results: DataFrame, path: str, checkpoint: str, available_now: bool = False, interval: str = "1 minute"
) -> StreamingQuery:
    """Append results to a folder, each row exactly once."""
    writer = results.writeStream.format("parquet").outputMode("append").option("path", path)
    return _started(writer, checkpoint, available_now, interval)


def to_batches(
    results: DataFrame,
    path: str,
    checkpoint: str,
    mode: str = "append",
    available_now: bool = False,
    interval: str = "1 minute",
    shape: Callable[[DataFrame], DataFrame] = lambda batch: batch,
) -> StreamingQuery:
    """Write every micro-batch to its own folder; a replayed batch overwrites itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        shape(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return _started(results.writeStream.outputMode(mode).foreachBatch(write), checkpoint, available_now, interval)


def to_tiers(
    results: DataFrame,
    tiers: Tiers,
    checkpoint: str,
    mode: str = "append",
    available_now: bool = False,
    interval: str = "1 minute",
    shape: Callable[[DataFrame, int], DataFrame] = lambda batch, _: batch,
) -> StreamingQuery:
    """Add every micro-batch to ``tiers``; a replayed batch overwrites itself."""
    writer = results.writeStream.outputMode(mode)
    return _started(writer.foreachBatch(lambda batch, n: tiers.add(shape(batch, n), n)), checkpoint, available_now, interval)


def counter_tiers(spark: SparkSession, path: str, fan: int = FAN) -> Tiers:
    """Sums per key of a delta stream. A key keeps the lowest id of its first batch and takes the expiry of its last."""

    def merge(rows: DataFrame) -> DataFrame:
        return rows.groupBy("key").agg(
            F.min_by("id", "first").alias("id"),
            F.sum("value").alias("value"),
            F.max_by("expireat", "last").alias("expireat"),
            F.min("first").alias("first"),
            F.max("last").alias("last"),
        )

    return Tiers(spark, path, "key string, id bigint, value bigint, expireat timestamp_ntz, first bigint, last bigint", merge, fan)


def rollup_stream(
    deltas: DataFrame, tiers: Tiers, checkpoint: str, available_now: bool = False, interval: str = "5 minutes"
) -> StreamingQuery:
    """Counter rollup of a delta stream ``(id, key, value, expireat)`` into ``counter_tiers``: a micro-batch writes one
    row per key that it holds, however many keys there are."""

    def sums(batch: DataFrame, number: int) -> DataFrame:
        return batch.groupBy("key").agg(
            F.min("id").alias("id"),
            F.sum("value").alias("value"),
            F.max("expireat").alias("expireat"),
            F.lit(number).cast("bigint").alias("first"),
            F.lit(number).cast("bigint").alias("last"),
        )

    return to_tiers(deltas, tiers, checkpoint, "append", available_now, interval, sums)


def rolled_counters(base: DataFrame, tiers: Tiers, first_id: int = 0) -> DataFrame:
    """The rolled-up counters after all batches of ``rollup_stream``, from those before the first one. New keys are
    numbered as in ``counter_rollup``."""
    rolled, _ = counter_rollup(tiers.read(), base, first_id)
    return rolled


def state_tiers(spark: SparkSession, path: str, fan: int = FAN) -> Tiers:
    """Latest state per job of all batches of ``state_changes``."""
    return Tiers(spark, path, "jobid bigint, seq bigint, name string", state_changes, fan)


def state_changes(changes: DataFrame) -> DataFrame:
    """Latest state per job of a batch of changes ``(seq, jobid, name)``: the jobs that moved. Changes of one job
    are combined before the shuffle. Batches are merged by ``seq``, so no state is kept."""
    return (
        changes.groupBy("jobid")
        .agg(F.max(F.struct("seq", "name")).alias("latest"))
        .select("jobid", "latest.seq", "latest.name")
    )


def current_states(tiers: Tiers) -> DataFrame:
    """Current state per job from ``state_tiers``; none before the first batch."""
    return tiers.read().select("jobid", "seq", F.col("name").alias("statename"))


def new_work(batch: DataFrame) -> DataFrame:
    """What a micro-batch of enqueues ``(seq, jobid, queue)`` announces: rows per queue."""
    return batch.groupBy("queue").agg(F.count(F.lit(1)).alias("enqueued"), F.max("seq").alias("last_seq"))
