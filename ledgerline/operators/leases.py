"""Queue leases replayed from a lease log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.ranking import BUCKET_WIDTH, carry_last


def lease_fold(jobqueue: DataFrame, log: DataFrame, width: int = BUCKET_WIDTH) -> DataFrame:
    """Next queue after a lease log ``(seq, id, ts, op)`` with op fetch, keep_alive, requeue or ack.

    The log records what holders did: a fetch grants a lease, and the holder presents the token it
    last received, so keep-alive, requeue and ack act exactly when the row is leased. An acknowledged
    row is gone for good; entries of rows that are not in the queue do nothing.

    A row is leased at an ack if the last fetch or requeue before it is a fetch, or if there is none
    and the row started leased. What remains is decided by the last entries of each kind.
    """
    held = F.col("fetchedat").isNotNull()
    turning = F.col("op").isin("fetch", "requeue")
    marks = log.where(turning | (F.col("op") == "ack")).select("seq", "id", "op")
    acks = carry_last(marks, ["id"], "seq", F.when(turning, F.col("op")), "_before", width).where(F.col("op") == "ack")
    done = (
        acks.where(F.coalesce("_before", F.lit("start")) != "requeue")
        .groupBy("id")
        .agg(F.max(F.col("_before") == "fetch").alias("_acked"))
        .withColumn("_acked", F.coalesce("_acked", F.lit(False)))
    )
    touching = F.col("op").isin("fetch", "keep_alive")
    last = log.groupBy("id").agg(
        F.max_by("op", F.when(turning, F.col("seq"))).alias("_turn"),
        F.max_by("ts", F.when(touching, F.col("seq"))).alias("_touched"),
    )
    leased = (F.col("_turn") == "fetch") | (F.col("_turn").isNull() & held)
    return (
        jobqueue.join(done, "id", "left")
        # An ack seen before any fetch or requeue counts if the row started leased.
        .where(F.col("_acked").isNull() | (~F.col("_acked") & ~held))
        .join(last, "id", "left")
        .withColumn("fetchedat", F.when(leased, F.coalesce("_touched", "fetchedat")))
        .select(*jobqueue.columns)
    )
