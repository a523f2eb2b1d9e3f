"""Ledger table schemas and conversion of older extracts to them."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from ledgerline.functions.payload import json_or_default

_LONG, _INT, _DOUBLE, _TEXT, _TIME = LongType(), IntegerType(), DoubleType(), StringType(), TimestampNTZType()


def _table(*columns: tuple[str, DataType, bool]) -> StructType:
    return StructType([StructField(name, kind, nullable) for name, kind, nullable in columns])


# Name, type and nullability of the columns of the ledger tables. Times are UTC.
_COUNTER = _table(("id", _LONG, False), ("key", _TEXT, False), ("value", _LONG, False), ("expireat", _TIME, True))
SCHEMAS = {
    "job": _table(
        ("id", _LONG, False),
        ("stateid", _LONG, True),
        ("statename", _TEXT, True),
        ("invocationdata", _TEXT, False),
        ("arguments", _TEXT, False),
        ("createdat", _TIME, False),
        ("expireat", _TIME, True),
    ),
    "state": _table(
        ("id", _LONG, False),
        ("jobid", _LONG, False),
        ("name", _TEXT, False),
        ("reason", _TEXT, True),
        ("createdat", _TIME, False),
        ("data", _TEXT, True),
    ),
    "jobparameter": _table(
        ("id", _LONG, False), ("jobid", _LONG, False), ("name", _TEXT, False), ("value", _TEXT, True)
    ),
    "jobqueue": _table(
        ("id", _LONG, False),
        ("jobid", _LONG, False),
        ("queue", _TEXT, False),
        ("fetchedat", _TIME, True),
        ("updatecount", _INT, False),
    ),
    "counter": _COUNTER,
    "aggregatedcounter": _COUNTER,
    "hash": _table(
        ("id", _LONG, False),
        ("key", _TEXT, False),
        ("field", _TEXT, False),
        ("value", _TEXT, True),
        ("expireat", _TIME, True),
    ),
    "list": _table(("id", _LONG, False), ("key", _TEXT, False), ("value", _TEXT, True), ("expireat", _TIME, True)),
    "set": _table(
        ("id", _LONG, False),
        ("key", _TEXT, False),
        ("score", _DOUBLE, False),
        ("value", _TEXT, False),
        ("expireat", _TIME, True),
    ),
    "server": _table(("id", _TEXT, False), ("data", _TEXT, True), ("lastheartbeat", _TIME, False)),
}
EXPIRING_TABLES = ("aggregatedcounter", "counter", "job", "list", "set", "hash")
# What an absent or empty payload stands for.
JSON_DEFAULTS = {
    ("job", "invocationdata"): "{}",
    ("job", "arguments"): "[]",
    ("state", "data"): "{}",
    ("server", "data"): "{}",
}
# Column defaults of columns that older extracts lack.
ADDED_DEFAULTS = {("jobqueue", "updatecount"): 0}


def read_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """One ledger table from parquet, with its declared schema (no inference)."""
    return spark.read.schema(SCHEMAS[table]).parquet(path)


def read_live_table(
    spark: SparkSession, url: str, table: str, lower: int, upper: int, partitions: int, properties: dict[str, str]
) -> DataFrame:
    """One ledger table from a live database over JDBC, split on its id range.

    ``server`` has text ids, so it is read in one piece; it holds one row per worker process.
    """
    options = {**properties, "url": url, "dbtable": properties.get("dbtable", table), "preferTimestampNTZ": "true"}
    if table != "server":
        options |= {
            "partitionColumn": "id",
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return normalize_snapshot(spark.read.format("jdbc").options(**options).load(), table)


def _upgraded(df: DataFrame, table: str, target: StructField, present: dict[str, str]):
    if target.name not in present:
        return F.lit(ADDED_DEFAULTS.get((table, target.name))).cast(target.dataType).alias(target.name)
    value = F.col(f"`{present[target.name]}`")
    if df.schema[present[target.name]].dataType != target.dataType:
        value = value.cast(target.dataType)
    default = JSON_DEFAULTS.get((table, target.name))
    if default:
        value = F.when(value == "", F.lit(default)).otherwise(value)
    return value.alias(target.name)


def normalize_snapshot(df: DataFrame, table: str) -> DataFrame:
    """Any older extract of ``table`` in the current shape.

    Ids widen to 64 bits, text loses its length limit, times become UTC, empty JSON text becomes an
    empty document, columns added since get their default and dropped columns go.
    """
    present = {name.lower(): name for name in df.columns}
    return df.select([_upgraded(df, table, target, present) for target in SCHEMAS[table]])


def fill_payloads(df: DataFrame, table: str) -> DataFrame:
    """Payload columns with NULL or empty text replaced by an empty document."""
    filled = {
        column: json_or_default(F.col(column), default)
        for (owner, column), default in JSON_DEFAULTS.items()
        if owner == table
    }
    return df.withColumns(filled)


def union_sources(sources: Iterable[tuple[str, DataFrame]]) -> DataFrame:
    """Several queue sources as one frame with a ``source`` column; nothing is merged across sources."""
    tagged = [df.withColumn("source", F.lit(name)) for name, df in sources]
    if not tagged:
        raise ValueError("at least one source is needed")
    return reduce(DataFrame.unionByName, tagged)
