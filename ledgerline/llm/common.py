"""Words, prefix sums and step tables shared by the operators."""

from __future__ import annotations

import gc
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.session import discard, new_folder

# A word is a run of anything but the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\f\r"


def words(text: Column) -> Column:
    """Words of a text as an array; null counts as empty."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def word_count(text: Column) -> Column:
    """Number of words, counted as blank-to-word changes without building the words.

    Every blank becomes a space and every other character is left; runs of spaces are then squeezed.
    """
    plain = F.translate(F.coalesce(text, F.lit("")), BLANKS, " " * len(BLANKS))
    spaced = F.trim(F.regexp_replace(plain, " {2,}", " "))
    gaps = F.length(spaced) - F.length(F.replace(spaced, F.lit(" "), F.lit("")))
    return F.when(spaced == "", F.lit(0)).otherwise(gaps + 1).cast("bigint")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often the body uses it."""
    return F.transform(F.array(value), body).getItem(0)


def crc32_text(column: str) -> Column:
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


class Steps:
    """Tables written by the steps of one operator, in the shared work folder.

    Their files outlive executors. ``free`` removes a table that no later step reads, and lets the engine
    drop shuffle files of finished steps, which it otherwise keeps until the driver collects its garbage.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[int, str] = {}

    def table(self, df: DataFrame) -> DataFrame:
        path = new_folder(self.spark)
        df.write.parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(back)] = path
        self.release()
        return back

    def free(self, *tables: DataFrame) -> None:
        for table in tables:
            path = self.paths.pop(id(table), None)
            if path:
                discard(self.spark, path)
        self.release()

    def release(self) -> None:
        gc.collect()
        self.spark._jvm.System.gc()


def id_number(name: str = "doc_id") -> Column:
    """An id as a number; null is the least one."""
    return F.coalesce(F.col(name).cast("bigint"), F.lit(-(1 << 63)).cast("bigint"))


def ids_repeat(docs: DataFrame) -> bool:
    """Whether any two rows share a ``doc_id``, null included."""
    return bool(docs.groupBy(id_number().alias("_id")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").take(1))


def with_row_keys(steps: Steps, docs: DataFrame, name: str) -> DataFrame:
    """Adds a number of its own to every row, in the order of ``doc_id``, null first.

    Where no id repeats it is the id itself; else rows are sorted, numbered and written once.
    """
    own = docs.withColumn(name, id_number())
    if not ids_repeat(docs):
        return own
    order = [name, "_mark", "_tie"]
    placed = own.withColumns({"_mark": F.xxhash64("text"), "_tie": F.monotonically_increasing_id()})
    placed = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    return steps.table(placed.withColumn(name, F.monotonically_increasing_id()).drop("_mark", "_tie"))


def with_text_keys(steps: Steps, docs: DataFrame, name: str) -> DataFrame:
    """Like ``with_row_keys``, but rows with the same id and text share their number."""
    if not ids_repeat(docs):
        return docs.withColumn(name, id_number())
    told = docs.withColumns({"_id": id_number(), "_mark": F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)})
    order = ["_id", "_mark"]
    marks = told.groupBy(F.struct(*order).alias("_k")).agg(F.count(F.lit(1))).select("_k.*")
    numbered = steps.table(
        marks.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(name, F.monotonically_increasing_id())
    )
    keyed = steps.table(told.join(numbered.hint("merge"), order).select(*docs.columns, name))
    steps.free(numbered)
    return keyed


def running_total(
    steps: Steps, df: DataFrame, group: Sequence[str], order: Sequence[str], values: dict[str, Column]
) -> DataFrame:
    """Adds exclusive prefix sums ``{name: value}`` per group, in the given order of columns.

    Rows are range-partitioned by group and order, so a hot group spreads over many tasks; one summary row
    per group and partition carries sums across. ``order`` should make rows distinct: rows that tie in it
    may change places. Group columns must not be null.
    """
    part = "_part"
    narrow = df
    for name, value in values.items():
        narrow = narrow.withColumn(f"_v_{name}", value)
    ranged = steps.table(narrow.repartitionByRange(*group, *order).withColumn(part, F.spark_partition_id()))
    carried = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy(*group, part).agg(*[F.sum(f"_v_{n}").alias(f"_s_{n}") for n in values])
    before = totals.select(
        *group, part, *[F.coalesce(F.sum(f"_s_{n}").over(carried), F.lit(0)).alias(f"_b_{n}") for n in values]
    )
    inside = Window.partitionBy(*group, part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = ranged.select(
        "*", *[F.coalesce(F.sum(f"_v_{n}").over(inside), F.lit(0)).alias(f"_w_{n}") for n in values]
    ).join(before, [*group, part])
    return summed.select(
        *df.columns, *[(F.col(f"_b_{n}") + F.col(f"_w_{n}")).cast("bigint").alias(n) for n in values]
    )
