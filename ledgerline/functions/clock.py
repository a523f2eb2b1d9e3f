"""Time helpers. Every ledger time is UTC; "now" is always an explicit argument."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_datetime(asof: datetime | str) -> datetime:
    """``asof`` as a naive UTC datetime."""
    if isinstance(asof, str):
        asof = datetime.fromisoformat(asof)
    if asof.tzinfo is not None:
        asof = (asof - asof.utcoffset()).replace(tzinfo=None)
    return asof


def instant(asof: datetime | str) -> Column:
    """``asof`` as a foldable literal, so comparisons with it reach the scan."""
    return F.lit(as_datetime(asof).isoformat(sep=" ")).cast("timestamp_ntz")


def whole_seconds(span: timedelta | float) -> int:
    """Length of a span in seconds, fraction dropped towards zero."""
    return int(span.total_seconds() if isinstance(span, timedelta) else span)


def plus_whole_seconds(ts: Column, seconds: Column) -> Column:
    """``ts`` moved by ``seconds`` with the fraction dropped."""
    return ts + F.make_dt_interval(secs=seconds.cast("bigint").cast("decimal(18,6)"))


def plus_seconds(ts: Column, seconds: Column) -> Column:
    """``ts`` moved by ``seconds``, microseconds kept."""
    return ts + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def seconds_between(start: Column, end: Column) -> Column:
    """Seconds from ``start`` to ``end`` as a double."""
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(1000000.0)


def watermarked(stream: DataFrame, delay: str) -> DataFrame:
    """``stream`` with its ``ts`` as event time (watermarks take zoned timestamps only)."""
    return stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)


def without_zone(ts: Column) -> Column:
    """A zoned timestamp as its UTC time."""
    return ts.cast("timestamp_ntz")
