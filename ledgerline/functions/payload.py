"""Decoding of the JSON payload columns."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

SERVER_PAYLOAD = "WorkerCount INT, Queues ARRAY<STRING>, StartedAt STRING"


def state_fields(data: Column) -> Column:
    """State payload as a map with lower-case keys (payload keys are read ignoring case); of keys that differ
    in case only the last counts."""
    entries = F.transform(
        F.map_entries(F.from_json(data, "map<string,string>")),
        lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")),
    )
    last = lambda all_: F.filter(
        all_, lambda e, i: ~F.exists(F.slice(all_, i + 2, F.size(all_)), lambda later: later["key"] == e["key"])
    )
    return F.map_from_entries(F.transform(F.array(entries), last).getItem(0))


def utc_time(text: Column) -> Column:
    """ISO-8601 text as a UTC timestamp without zone, whatever the session's zone; NULL when it does not parse.

    Text without a zone is UTC.
    """
    zoned = text.rlike(r"(?i)(Z|UTC|GMT|[+-][0-9]{2}:?[0-9]{2})\s*$") & text.rlike("[0-9]T|[0-9] [0-9]")
    micros = F.unix_micros(text.try_cast("timestamp"))
    moved = F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(
        secs=(micros / F.lit(Decimal(1000000))).cast("decimal(18,6)")
    )
    return F.when(zoned, moved).otherwise(text.try_cast("timestamp_ntz"))


def whole_number(text: Column) -> Column:
    """Text as a 64-bit integer; NULL when it does not parse."""
    return text.try_cast("bigint")


def json_or_default(payload: Column, default: str) -> Column:
    """Payload with NULL and empty text replaced by ``default`` ('{}' or '[]')."""
    return F.coalesce(F.nullif(payload, F.lit("")), F.lit(default))
