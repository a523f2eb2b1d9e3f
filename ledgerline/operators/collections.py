"""Reads of the keyed sets, lists, hashes and counters, for all keys or the keys asked for.

Nothing here filters on expiry: an expired row stays readable until it is purged.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.clock import instant, seconds_between
from ledgerline.functions.ranking import BUCKET_WIDTH, position_per_key, range_per_key, top_per_key
from ledgerline.operators.keys import Keys, group, restrict, with_absent_keys

NO_TTL = -1.0


def _check_scores(from_score: float, to_score: float) -> None:
    if to_score < from_score:
        raise ValueError("to_score must not be below from_score")


def set_items(sets: DataFrame, keys: Keys = None) -> DataFrame:
    """Members of each set, one row per member."""
    return restrict(sets, "key", keys).select("key", "value")


def set_lowest(sets: DataFrame, from_score: float, to_score: float, keys: Keys = None) -> DataFrame:
    """The member with the lowest score in the range, per set; equal scores go by id."""
    _check_scores(from_score, to_score)
    scored = restrict(sets, "key", keys).where(F.col("score").between(from_score, to_score))
    lowest = F.min_by("value", F.struct("score", "id"))
    return group(scored, "key").agg(lowest.alias("value")).select("_by.key", "value")


def set_lowest_n(sets: DataFrame, from_score: float, to_score: float, n: int, keys: Keys = None) -> DataFrame:
    """The first ``n`` members by score in the range, per set, with their ``rank``."""
    _check_scores(from_score, to_score)
    if n < 1:
        raise ValueError("n must be at least 1")
    scored = restrict(sets, "key", keys).where(F.col("score").between(from_score, to_score))
    ranked = top_per_key(scored.select("id", "key", "value", "score"), ["key"], [F.col("score"), F.col("id")], n)
    return ranked.select("key", F.col("rank").cast("bigint").alias("rank"), "value", "score")


def set_range(sets: DataFrame, start: int, end: int, keys: Keys = None, width: int = BUCKET_WIDTH) -> DataFrame:
    """Members ``start..end`` of each set, oldest first. ``width``: see ``position_per_key``."""
    rows = restrict(sets, "key", keys).select("id", "key", "value")
    return range_per_key(rows, ["key"], start, end, width=width).select("key", "position", "value")


def list_items(lists: DataFrame, keys: Keys = None, width: int = BUCKET_WIDTH) -> DataFrame:
    """Contents of each list with their position, newest first. ``width``: see ``position_per_key``."""
    rows = restrict(lists, "key", keys).select("id", "key", "value")
    return position_per_key(rows, ["key"], descending=True, width=width).select("key", "position", "value")


def list_range(lists: DataFrame, start: int, end: int, keys: Keys = None, width: int = BUCKET_WIDTH) -> DataFrame:
    """Elements ``start..end`` of each list, newest first. ``width``: see ``position_per_key``."""
    rows = restrict(lists, "key", keys).select("id", "key", "value")
    return range_per_key(rows, ["key"], start, end, descending=True, width=width).select("key", "position", "value")


def trim_lists(
    lists: DataFrame, keep_from: int, keep_to: int, keys: Keys = None, width: int = BUCKET_WIDTH
) -> DataFrame:
    """Lists cut to positions ``keep_from..keep_to``, oldest first; lists not asked for stay whole."""
    kept = range_per_key(restrict(lists, "key", keys), ["key"], keep_from, keep_to, width=width).select(*lists.columns)
    if keys is None:
        return kept
    if isinstance(keys, DataFrame):
        asked = keys.select(F.col(keys.columns[0]).alias("key"))
        return lists.join(asked, "key", "left_anti").select(*lists.columns).unionByName(kept)
    return lists.where(~F.col("key").isin(list(keys))).unionByName(kept)


def key_counts(items: DataFrame, keys: Keys = None) -> DataFrame:
    """Number of rows per key of a set, list or hash table; 0 for an asked key without rows."""
    counts = group(restrict(items, "key", keys), "key").agg(F.count(F.lit(1)).alias("n"))
    return with_absent_keys(counts.select("_by.key", "n"), "key", keys, {"n": F.lit(0)})


def key_ttl(items: DataFrame, asof: datetime | str, keys: Keys = None) -> DataFrame:
    """Seconds until the earliest expiry per key of a set, list or hash table; -1 if there is none."""
    earliest = group(restrict(items, "key", keys), "key").agg(F.min("expireat").alias("_at"))
    ttl = earliest.select(
        "_by.key", F.coalesce(seconds_between(instant(asof), F.col("_at")), F.lit(NO_TTL)).alias("ttl_seconds")
    )
    return with_absent_keys(ttl, "key", keys, {"ttl_seconds": F.lit(NO_TTL)})


def hash_entries(hashes: DataFrame, keys: Keys = None) -> DataFrame:
    """Fields and values of each hash, one row per field; an absent hash has no rows."""
    return restrict(hashes, "key", keys).select("key", "field", "value")


def hash_value(hashes: DataFrame, field: str, keys: Keys = None) -> DataFrame:
    """One field of each hash that has it."""
    return restrict(hashes, "key", keys).where(F.col("field") == field).select("key", "value")


def counter_value(counter: DataFrame, aggregated: DataFrame, keys: Keys = None) -> DataFrame:
    """Pending deltas plus the rolled-up value per counter; 0 for an asked key without rows."""
    both = counter.select("key", "value").unionByName(aggregated.select("key", "value"))
    totals = group(restrict(both, "key", keys), "key").agg(F.sum("value").alias("value"))
    return with_absent_keys(totals.select("_by.key", "value"), "key", keys, {"value": F.lit(0).cast("bigint")})
