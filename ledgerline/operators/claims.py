"""Claims of workers that listen to different queues.

Workers come in an order, and each takes the first row in claim order among its own queues that no worker before
it took: never-leased rows by queue name, then expired leases by age.

Never-leased rows are settled queue by queue: every worker asks its first queue, a queue keeps the first workers for whom it
has rows, the others ask their next queue. A worker kept now gives way to an earlier one that comes later, which is
why all who ask are looked at again. The k-th queue by name keeps its final workers from round k on, so rounds
are bounded by the number of queues, and each round is a ranking of who asks.

Workers that found nothing take expired leases. There all queues share one order by age, so who takes what depends on
every worker before. They are replayed in blocks of ``BLOCK_WORKERS``; a block reads no more rows of a queue than it has
workers listening to it, and what it took per queue is where the next one starts.
"""

from __future__ import annotations

import heapq
from datetime import datetime, timedelta

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.clock import as_datetime, instant, whole_seconds
from ledgerline.functions.ranking import BUCKET_WIDTH, position_in_order, position_per_key
from ledgerline.operators.queues import stamped
from ledgerline.session import stored

BLOCK_WORKERS = 20_000


def claim_for_workers(
    jobqueue: DataFrame, workers: DataFrame, timeout: timedelta, asof: datetime | str, block: int = BLOCK_WORKERS, width: int = BUCKET_WIDTH
) -> DataFrame:
    """Rows that ``workers`` ``(worker bigint, queues array<string>)`` take now, stamped, with the worker as ``slot``.

    ``worker`` is unique and gives the order. A worker without queues, or for which nothing is left, takes nothing; a
    queue listed twice counts once, null ones do not.
    """
    asked = stored(
        workers.select(F.col("worker").cast("bigint").alias("worker"), F.explode(F.array_distinct("queues")).alias("queue")).where("queue IS NOT NULL")
    )
    listeners = stored(asked.groupBy("queue").agg(F.count(F.lit(1)).alias("_listeners")))
    oldest = instant(as_datetime(asof) - timedelta(seconds=whole_seconds(timeout)))
    heard = jobqueue.join(listeners.select("queue"), "queue", "left_semi")
    # No queue gives more rows than it has listeners.
    fresh = position_in_order(heard.where("fetchedat IS NULL"), ["queue"], [F.col("jobid"), F.col("id")], "_place")
    fresh = stored(fresh.join(listeners, "queue").where("_place < _listeners").drop("_listeners"))
    kept = _kept_by_queues(asked, fresh, width)
    first = kept.join(fresh, ["queue", "_place"]).select(*jobqueue.columns, F.col("worker").alias("slot"))
    expired = heard.where(F.col("fetchedat").isNotNull() & (F.col("fetchedat") < oldest))
    second = _replayed(asked.join(kept.select("worker"), "worker", "left_anti"), expired, block)
    late = jobqueue.join(second, "id").select(*jobqueue.columns, F.col("worker").alias("slot"))
    return stamped(first.unionByName(late), asof)


def _kept_by_queues(asked: DataFrame, rows: DataFrame, width: int) -> DataFrame:
    """``worker, queue, _place``: the never-leased row of each worker that gets one."""
    sizes = rows.groupBy("queue").agg(F.count(F.lit(1)).alias("_rows"))
    # A queue without rows is not asked; the others by name.
    lists = asked.join(sizes.select("queue"), "queue", "left_semi").groupBy("worker").agg(F.array_sort(F.collect_list("queue")).alias("_list"))
    state = stored(lists.withColumn("_at", F.lit(0)))
    while True:
        asking = state.where(F.col("_at") < F.size("_list")).withColumn("queue", F.expr("_list[_at]"))
        ranked = position_per_key(asking.select("worker", "queue"), ["queue"], "worker", width=width, name="_place")
        placed = ranked.join(sizes, "queue").select("worker", "queue", "_place", (F.col("_place") >= F.col("_rows")).alias("_refused"))
        told = stored(state.join(placed, "worker", "left"))
        refused = F.coalesce("_refused", F.lit(False))
        if told.where(refused).isEmpty():
            return told.where("queue IS NOT NULL").select("worker", "queue", "_place")
        state = told.select("worker", "_list", (F.col("_at") + refused.cast("int")).alias("_at"))


def _replayed(asked: DataFrame, rows: DataFrame, block: int) -> DataFrame:
    """``id, worker`` of workers that take expired leases, block by block."""
    order = [F.col("fetchedat"), F.col("queue"), F.col("jobid"), F.col("id")]
    asked = stored(asked)
    claims = asked.sparkSession.createDataFrame([], "id bigint, worker bigint")
    if asked.isEmpty() or rows.isEmpty():
        return claims
    listeners = asked.groupBy("queue").agg(F.count(F.lit(1)).alias("_listeners"))
    lines = position_in_order(rows.select("id", "queue", "fetchedat", "jobid"), ["queue"], [order[0], *order[2:]], "_place")
    lines = lines.join(listeners, "queue").where("_place < _listeners").drop("_listeners")
    # Ages as one number, so that a block compares numbers.
    lines = stored(position_in_order(lines, [], order, "age").select("queue", "_place", "age", "id"))
    places = position_in_order(asked.select("worker").distinct(), [], [F.col("worker")], "_number")
    asked = stored(asked.join(places, "worker").withColumn("_block", F.expr(f"_number div {int(block)}")))
    blocks = asked.agg(F.max("_block")).first()[0] + 1
    # What earlier blocks took, per queue.
    taken = stored(asked.sparkSession.createDataFrame([], "queue string, _taken bigint"))
    for number in range(blocks):
        here = asked.where(F.col("_block") == number).select("worker", "queue")
        count = here.groupBy("queue").agg(F.count(F.lit(1)).alias("_most"))
        start = F.coalesce("_taken", F.lit(0))
        near = lines.join(count, "queue").join(taken, "queue", "left").where(F.col("_place").between(start, start + F.col("_most") - 1))
        turns = here.select("queue", F.lit(True).alias("turn"), F.col("worker").alias("at"), F.lit(0).cast("bigint").alias("id"))
        both = turns.unionByName(near.select("queue", F.lit(False).alias("turn"), F.col("age").alias("at"), "id"))
        done = stored(both.groupBy(F.lit(0).alias("_one")).applyInPandas(_replay_block, "queue string, id bigint, worker bigint"))
        claims = claims.unionByName(done.select("id", "worker"))
        if number + 1 < blocks:
            more = done.groupBy("queue").agg(F.count(F.lit(1)).alias("_taken"))
            taken = stored(taken.unionByName(more).groupBy("queue").agg(F.sum("_taken").alias("_taken")))
    return claims


def _replay_block(block: pd.DataFrame) -> pd.DataFrame:
    """One worker after the other takes the oldest row left in its queues."""
    rows = block[~block.turn]
    lines: dict[str, list] = {}
    for queue, age, id_ in zip(rows.queue, rows["at"], rows["id"]):
        lines.setdefault(queue, []).append((age, id_))
    for line in lines.values():
        heapq.heapify(line)
    out = []
    for worker, queues in block[block.turn].groupby("at", sort=True)["queue"]:
        heads = [(lines[queue][0], queue) for queue in queues if lines.get(queue)]
        if heads:
            (_, id_), queue = min(heads)
            heapq.heappop(lines[queue])
            out.append((queue, id_, worker))
    return pd.DataFrame(out, columns=["queue", "id", "worker"])
