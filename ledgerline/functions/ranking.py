"""Per-key order operators that never put a whole hot key into one task.

Ids and command sequence numbers are unique integers, so ``value div width`` cuts every key into
buckets of at most ``width`` rows. Work inside a bucket is an ordinary window; what crosses buckets
is one summary row per bucket. Nothing is sampled, so a lost task recomputes the same buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.session import stored

BUCKET_WIDTH = 1 << 20
TOURNAMENT_SALTS = (65536, 256)


def _group(keys: list[str], order: str, width: int) -> Column:
    """Key and bucket as one struct. Partitioned by plain columns, rows that come from a join on the key
    would stay where the join put them: every bucket of a hot key in one task."""
    return F.struct(*keys, F.expr(f"`{order}` div {int(width)}").alias("_bucket"))


def _keys_of_group(keys: list[str]) -> list[Column]:
    return [F.col(f"_group.{key}") for key in keys]


def position_per_key(
    df: DataFrame,
    keys: list[str],
    order: str = "id",
    descending: bool = False,
    width: int = BUCKET_WIDTH,
    name: str = "position",
) -> DataFrame:
    """Adds the 0-based position of each row within its key, by a unique integer column."""
    direction = (lambda c: F.col(c).desc()) if descending else (lambda c: F.col(c).asc())
    rows = df.withColumn("_group", _group(keys, order, width))
    before = F.sum("_rows").over(
        Window.partitionBy(*_keys_of_group(keys))
        .orderBy(direction("_group._bucket"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        rows.groupBy("_group")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_group", F.coalesce(before, F.lit(0)).alias("_before"))
    )
    within = F.row_number().over(Window.partitionBy("_group").orderBy(direction(order)))
    return (
        rows.withColumn("_within", within)
        .join(offsets, "_group")
        .withColumn(name, F.col("_before") + F.col("_within") - F.lit(1))
        .select(*df.columns, name)
    )


def running_sum(df: DataFrame, value: Column, name: str, order: str = "seq", width: int = BUCKET_WIDTH) -> DataFrame:
    """Adds the sum of ``value`` over all strictly earlier rows, by a unique integer column.

    Buckets of the order are summed up one by one, so one task sees a row per bucket.
    """
    rows = df.withColumn("_value", value).withColumn("_bucket", F.expr(f"`{order}` div {int(width)}"))
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        rows.groupBy("_bucket")
        .agg(F.sum("_value").alias("_sum"))
        .select("_bucket", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy("_bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.withColumn("_within", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
        .join(before, "_bucket")
        .withColumn(name, F.col("_before") + F.col("_within"))
        .select(*df.columns, name)
    )


def range_per_key(
    df: DataFrame,
    keys: list[str],
    start: int,
    end: int,
    order: str = "id",
    descending: bool = False,
    width: int = BUCKET_WIDTH,
) -> DataFrame:
    """Rows at positions ``start..end`` (0-based, inclusive) of each key, with their ``position``."""
    if start < 0 or end - start + 1 < 0:
        raise ValueError("the range must start at 0 or later and must not have a negative length")
    if end < pruned_rank(df):
        column = F.col(order).desc() if descending else F.col(order).asc()
        first = top_per_key(df, keys, [column], end + 1).where(F.col("rank") > start)
        return first.withColumn("position", (F.col("rank") - 1).cast("bigint")).drop("rank")
    return position_per_key(df, keys, order, descending, width).where(F.col("position").between(start, end))


def pruned_rank(df: DataFrame) -> int:
    """Largest n for which this session prunes ``row_number() <= n`` before the shuffle."""
    return int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))


def top_per_key(df: DataFrame, keys: list[str], by: list[Column], n: int) -> DataFrame:
    """First ``n`` rows of each key in the order ``by``, with their 1-based ``rank``.

    The rows of a key play a tournament: winners of salted sub-groups meet in one group. The salt is the
    task's partition, so that within the pruning threshold a task sends at most ``n`` rows of a key, and the
    last group of a hot key holds at most ``n`` rows per salt. Beyond the threshold nothing is pruned in the
    task, so there are more and finer rounds.
    """
    salts = TOURNAMENT_SALTS if n > pruned_rank(df) else TOURNAMENT_SALTS[-1:]
    for salt in salts:
        df = df.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salt)))
        sub = Window.partitionBy(F.struct(*keys, "_salt")).orderBy(*by)
        df = df.withColumn("_rank", F.row_number().over(sub)).where(F.col("_rank") <= n).drop("_rank", "_salt")
    # The struct keeps the pruning ahead of a shuffle also when rows come from a join on the keys.
    rank = F.row_number().over(Window.partitionBy(F.struct(*keys)).orderBy(*by))
    return df.withColumn("rank", rank).where(F.col("rank") <= n)


def carry_last(
    df: DataFrame, keys: list[str], order: str, value: Column, name: str, width: int = BUCKET_WIDTH
) -> DataFrame:
    """Adds the last non-null ``value`` among the strictly earlier rows of the same key."""
    rows = df.withColumn("_group", _group(keys, order, width)).withColumn("_value", value)
    within = F.last("_value", ignorenulls=True).over(
        Window.partitionBy("_group").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    )
    earlier = F.last("_last", ignorenulls=True).over(
        Window.partitionBy(*_keys_of_group(keys))
        .orderBy("_group._bucket")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = (
        rows.groupBy("_group")
        .agg(F.max_by("_value", F.when(F.col("_value").isNotNull(), F.col(order))).alias("_last"))
        .select("_group", earlier.alias("_carried"))
    )
    return (
        rows.withColumn("_within", within)
        .join(carried, "_group")
        .withColumn(name, F.coalesce("_within", "_carried"))
        .select(*df.columns, name)
    )


def carry_latest(
    df: DataFrame, keys: list[str], order: str, values: dict[str, Column], tie: str | None = None, width: int = BUCKET_WIDTH
) -> DataFrame:
    """``carry_last`` of several values at once; rows of a key may share ``order`` if ``tie`` tells them apart.

    Rows that share ``order`` lie in one bucket."""
    named = {f"_v{i}": value for i, value in enumerate(values.values())}
    rows = df.withColumn("_group", _group(keys, order, width)).withColumns(named)
    place = F.struct(order, *([tie] if tie else []))
    within = Window.partitionBy("_group").orderBy(order, *([tie] if tie else [])).rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy(*_keys_of_group(keys)).orderBy("_group._bucket").rowsBetween(Window.unboundedPreceding, -1)
    last = {v: F.max_by(v, F.when(F.col(v).isNotNull(), place)).alias(f"_last{v}") for v in named}
    carried = (
        rows.groupBy("_group")
        .agg(*last.values())
        .select("_group", *[F.last(f"_last{v}", ignorenulls=True).over(across).alias(f"_carried{v}") for v in named])
    )
    return (
        rows.withColumns({f"_within{v}": F.last(v, ignorenulls=True).over(within) for v in named})
        .join(carried, "_group")
        .select(*df.columns, *[F.coalesce(f"_within{v}", f"_carried{v}").alias(name) for v, name in zip(named, values)])
    )


def position_in_order(df: DataFrame, keys: list[str], order: list[Column], name: str = "position") -> DataFrame:
    """Adds the 0-based position of each row within its key, by any columns that tell its rows apart.

    Rows are dealt by ranges of key and order and written once, so a hot key spreads over many tasks; what crosses
    ranges is one count per key and range. Keys must not be null.
    """
    ranged = stored(df.repartitionByRange(*keys, *order).withColumn("_range", F.spark_partition_id()))
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = ranged.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_rows"))
    before = before.select(*keys, "_range", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy(*keys, "_range").orderBy(*order))
    return (
        ranged.withColumn("_within", within)
        .join(before, [*keys, "_range"])
        .withColumn(name, F.col("_before") + F.col("_within") - F.lit(1))
        .select(*df.columns, name)
    )


def page_range(df: DataFrame, order: str, offset: int, limit: int, descending: bool = False, few: int = 100_000) -> tuple[int, int, int] | None:
    """(least, greatest, offset left) of the unique integer column ``order`` between which a page lies, or None.

    Counts of 1024 equal ranges find the ranges that the page's first and last rows lie in, then those are looked
    into, until at most ``few`` rows lie around the page. Every pass is a scan with the range pushed down and combines to at
    most 1024 rows per task; nothing is sorted.
    """
    ends = df.agg(F.min(order), F.max(order)).first()
    if ends[0] is None or limit == 0:
        return None
    (low, high), left = ends, offset
    while True:
        width = (high - low) // 1024 + 1
        inside = df.where(F.col(order).between(low, high))
        # The difference of two 64-bit integers may need more bits.
        bucket = F.floor((F.col(order).cast("decimal(20,0)") - F.lit(low)) / F.lit(width)).cast("int").alias("_bucket")
        counts = inside.groupBy(bucket).agg(F.count(F.lit(1)).alias("_rows")).collect()
        counts = sorted(((r["_bucket"], r["_rows"]) for r in counts), reverse=descending)
        taken, kept = 0, []
        for number, rows in counts:
            if taken + rows > left and taken < left + limit:
                kept.append((number, rows, taken))
            taken += rows
        if not kept:
            return None
        left -= kept[0][2]
        first, last = sorted((kept[0][0], kept[-1][0]))
        low, high = low + first * width, min(high, low + (last + 1) * width - 1)
        if width == 1 or sum(rows for _, rows, _ in kept) <= max(few, 2 * limit) or len(kept) == len(counts):
            return low, high, left


def deep_page(df: DataFrame, order: str, offset: int, limit: int, descending: bool = False) -> DataFrame:
    """Rows ``offset .. offset + limit - 1`` by a unique integer column, sorted; only rows around the page are sorted."""
    found = page_range(df, order, offset, limit, descending)
    by = F.col(order).desc() if descending else F.col(order).asc()
    if found is None:
        return df.orderBy(by).limit(0)
    low, high, left = found
    return df.where(F.col(order).between(low, high)).orderBy(by).offset(left).limit(limit)
