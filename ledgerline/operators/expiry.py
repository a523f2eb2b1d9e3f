"""Tables laid out by expiry day, so that a purge reads and rewrites one day and drops whole folders before it.

A table is a folder of ``expireday=<date>`` partitions; rows without an expiry lie in the partition of null. A purge at
a moment removes the partitions of earlier days without reading them, and replaces the partition of that very day by
its rows that live on; all other files stay as they are. Where expiries spread over years, lay out by ``"month"``: a
folder then holds a month, named by its first day. A table keeps the unit it was written with.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from ledgerline.functions.clock import as_datetime, instant
from ledgerline.session import discard, stored

DAY = "expireday"


def _first_day(moment: datetime | str, unit: str) -> date:
    day = as_datetime(moment).date()
    return {"day": day, "month": day.replace(day=1)}[unit]


def _with_day(df: DataFrame, unit: str) -> DataFrame:
    return df.withColumn(DAY, F.to_date(F.date_trunc(unit, "expireat")))


def write_by_expiry(df: DataFrame, path: str, mode: str = "append", unit: str = "day") -> None:
    """Writes rows into the partitions of their expiry days. Rows are gathered by day, so a day has few files. Shuffle
    partitions with many rows, such as those that never expire, are split over tasks, with the days that share them."""
    laid = _with_day(df, unit).hint("rebalance", DAY)
    laid.write.mode(mode).partitionBy(DAY).parquet(path)


def read_by_expiry(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A table with the columns of ``schema`` and its day of expiry."""
    return spark.read.schema(StructType([*schema.fields, StructField(DAY, DateType())])).parquet(path)


def outliving(table: DataFrame, asof: datetime | str, unit: str = "day") -> DataFrame:
    """Rows that outlive ``asof``, as ``maintain.purge`` has them; partitions of earlier days are not read."""
    day = F.lit(_first_day(asof, unit))
    return table.where(F.col(DAY).isNull() | (F.col(DAY) > day) | ((F.col(DAY) == day) & (F.col("expireat") >= instant(asof))))


def purge_by_expiry(spark: SparkSession, path: str, schema: StructType, asof: datetime | str, unit: str = "day") -> None:
    """Removes the rows of a table that do not outlive ``asof``.

    Days that are over go first, folder by folder. The rows of the last day that live on are written to the work folder,
    and then take the place of their partition in one commit. A purge that dies is run again; should it die inside that
    commit, the rows are still in the work folder.
    """
    last = _first_day(asof, unit)
    days = _days(spark, path)
    for day in sorted(d for d in days if d < last):
        discard(spark, f"{path}/{DAY}={day}")
    if last not in days:
        return
    border = read_by_expiry(spark, path, schema).where(F.col(DAY) == F.lit(last))
    if border.where(F.col("expireat") < instant(asof)).isEmpty():
        return
    living = stored(border.where(F.col("expireat") >= instant(asof)).drop(DAY))
    if living.isEmpty():
        discard(spark, f"{path}/{DAY}={last}")
        return
    _with_day(living, unit).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path)


def _days(spark: SparkSession, path: str) -> set[date]:
    """Days that have a partition: one name each, whatever the rows."""
    folders = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{DAY}=*")
    files = folders.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    names = [entry.getPath().getName().removeprefix(f"{DAY}=") for entry in files.globStatus(folders) or []]
    return {date.fromisoformat(name) for name in names if not name.startswith("__")}
