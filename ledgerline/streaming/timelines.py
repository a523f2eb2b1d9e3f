"""Windows over event streams with built-in stateful operators."""

from __future__ import annotations

from datetime import timedelta
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ledgerline.functions.clock import watermarked, without_zone
from ledgerline.operators.monitor import STATS_PREFIX

LABELS = {"1 hour": "yyyy-MM-dd-HH", "1 day": "yyyy-MM-dd"}


def timeline_stream(events: DataFrame, width: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """Totals per kind and closed tumbling window of a stream ``(ts, kind, delta)``.

    A window is emitted once, after the watermark passes its end; later rows for it are dropped
    (see ``LateRows``).
    """
    slots = watermarked(events, delay).groupBy(F.window("ts", width), "kind").agg(F.sum("delta").alias("n"))
    label = F.date_format(F.col("window.start"), LABELS[width])
    return slots.select(
        "kind",
        without_zone(F.col("window.start")).alias("at"),
        F.concat(F.lit(STATS_PREFIX), "kind", F.lit(":"), label).alias("bucket_key"),
        "n",
    )


class LateRows(StreamingQueryListener):
    """Counts rows that stateful operators dropped as later than the watermark, over all batches of every query.

    Add it with ``spark.streams.addListener`` before a query starts; ``dropped`` holds totals by query id.
    """

    def __init__(self) -> None:
        self.dropped: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        self.dropped.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        late = sum(operator.numRowsDroppedByWatermark for operator in event.progress.stateOperators)
        query = str(event.progress.id)
        self.dropped[query] = self.dropped.get(query, 0) + late

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def liveness_stream(beats: DataFrame, timeout: timedelta, delay: str = "1 hour") -> DataFrame:
    """Workers of a stream ``(ts, server)`` that fell silent: one row per silence of ``timeout`` or longer.

    A worker's heartbeats less than the timeout apart form one session; the session closes when the
    watermark passes its end, which is the moment the worker counts as gone.
    """
    gap = f"{timeout // timedelta(microseconds=1)} microseconds"
    sessions = watermarked(beats, delay).groupBy(F.session_window("ts", gap), "server")
    return sessions.agg(F.max("ts").alias("last")).select(
        "server",
        without_zone(F.col("last")).alias("last_heartbeat"),
        without_zone(F.col("session_window.end")).alias("gone_at"),
    )


def row_expiry_stream(rows: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Tombstones of a stream of expiring rows ``(ts, id, expireat)`` that are written once, as deltas are.

    A row is a session from its event time to its expiry, so its tombstone is due when the watermark
    passes the expiry. A row that never expires leaves no state behind. Rows whose expiry may be moved
    to an earlier time need ``timers.key_expiry_stream``.
    """
    timed = watermarked(rows.where(F.col("expireat").isNotNull()), delay)
    # A session must have some length, also for a row that arrives already expired.
    micros = F.greatest(F.unix_micros(F.col("expireat").cast("timestamp")) - F.unix_micros("ts"), F.lit(1))
    length = F.make_interval(secs=(micros / F.lit(Decimal(1000000))).cast("decimal(18,6)"))
    sessions = timed.groupBy(F.session_window("ts", length), "id")
    return sessions.agg(F.max("expireat").alias("expireat")).select("id", "expireat")
