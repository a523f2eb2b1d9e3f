"""Restriction of an all-keys operator to the keys asked for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from ledgerline.functions.ranking import deep_page
from ledgerline.session import stored

Keys = DataFrame | Sequence[str] | Sequence[int] | None

# A page this long or shorter is small enough to broadcast whatever the size of the ledger.
BROADCAST_ROWS = 10_000


def restrict(df: DataFrame, column: str, keys: Keys) -> DataFrame:
    """Rows whose ``column`` is among ``keys``: a short list (pushed to the scan) or a one-column frame."""
    if keys is None:
        return df
    if isinstance(keys, DataFrame):
        wanted = keys.select(F.col(keys.columns[0]).alias(column))
        return df.join(wanted, column, "left_semi")
    return df.where(F.col(column).isin(list(keys)))


def with_absent_keys(result: DataFrame, column: str, keys: Keys, defaults: dict[str, Column]) -> DataFrame:
    """Adds a row of ``defaults`` for every asked key that ``result`` lacks."""
    if keys is None:
        return result
    if not isinstance(keys, DataFrame):
        if not keys:
            return result
        kind = result.schema[column].dataType
        listed = F.explode(F.array(*[F.lit(key).cast(kind) for key in keys]))
        keys = result.sparkSession.range(1).select(listed.alias(column))
    asked = keys.select(F.col(keys.columns[0]).alias(column)).distinct()
    filled = asked.join(result, column, "left")
    return filled.select(
        *[F.coalesce(F.col(c), defaults[c]).alias(c) if c in defaults else F.col(c) for c in result.columns]
    )


def group(df: DataFrame, *columns: str) -> GroupedData:
    """Rows grouped by ``_by``, a struct of the columns, for aggregates next to a join on the same keys.

    Grouped by the plain columns, aggregate and join would share one partitioning. After a join a hot
    key would then be aggregated in one task instead of being combined map-side, and on either side of
    it the partitions of the join could not be split at run time, which needs a shuffle of its own
    directly below each input. The struct keeps the two apart for one shuffle of aggregated rows.
    """
    return df.groupBy(F.struct(*columns).alias("_by"))


def bounded(page: DataFrame, rows: int | None) -> DataFrame:
    """``page`` with a broadcast hint when its limit proves it small; otherwise the planner decides."""
    return F.broadcast(page) if rows is not None and rows <= BROADCAST_ROWS else page


def merged(snapshot: DataFrame, changes: DataFrame, keys: list[str], extended: DataFrame | None = None) -> DataFrame:
    """Snapshot rows with the change of their key beside them, and the changes of new keys.

    ``keys`` identify a row of ``changes``. A full outer join would shuffle the whole snapshot whatever
    the number of changes; here few changes are broadcast to it, and only keys meet in the second join.
    ``extended`` is the snapshot with columns joined to it, which need not be computed for the keys.
    """
    touched = snapshot.select(*keys).join(changes.select(*keys), keys, "left_semi")
    new = changes.join(touched, keys, "left_anti")
    rows = snapshot if extended is None else extended
    return rows.join(changes, keys, "left").unionByName(new, allowMissingColumns=True)


def check_page(offset: int, limit: int) -> None:
    if offset < 0 or limit < 0:
        raise ValueError("offset and limit must not be negative")


def id_page(rows: DataFrame, offset: int, limit: int, descending: bool = False, derived: bool = False) -> DataFrame:
    """Page by a unique integer ``id``. Near the top every task sends its first rows to one; a deep page is looked up by
    counts first, so that no task gets the rows before it. ``derived`` rows are written before they are counted."""
    check_page(offset, limit)
    if offset + limit > BROADCAST_ROWS:
        return deep_page(stored(rows) if derived else rows, "id", offset, limit, descending)
    return rows.orderBy(F.col("id").desc() if descending else F.col("id")).offset(offset).limit(limit)
