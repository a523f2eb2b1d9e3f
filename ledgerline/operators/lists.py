"""Batch application of list commands, trims included.

Removals and whole-list trims depend on values and times only and are settled by joins. A positional
trim depends on what is in the list at that moment, so a list's trims act one after another. Lists
with few rows and commands are folded inside one row; larger ones are trimmed in rounds, the n-th trim
of all of them at once, each round ranking rows without gathering a list in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.ranking import BUCKET_WIDTH, carry_last, position_per_key
from ledgerline.operators.apply import key_commands
from ledgerline.operators.keys import group
from ledgerline.session import new_folder, stored

# A list with at most this many rows and commands is folded in one row.
FOLD_ROWS = 1000


def _empty() -> Column:
    return F.col("trim_to") < F.col("trim_from")


def _keeps_nothing() -> Column:
    return (F.col("op") == "trim") & _empty()


def apply_list(
    lists: DataFrame, commands: DataFrame, first_id: int = 0, fold_rows: int = FOLD_ROWS, width: int = BUCKET_WIDTH
) -> DataFrame:
    """Next list table. Commands: ``(seq, key, item, op, expire_at, trim_from, trim_to)`` with op insert,
    remove (all equal values), trim (keep those positions, oldest first), expire or persist."""
    by_key = key_commands(commands, _keeps_nothing())
    trims = commands.where(F.col("op") == "trim").select("seq", "key", "trim_from", "trim_to")
    negative = F.col("trim_to") < F.col("trim_from") - 1
    checked = trims.agg(
        F.count_if(~_empty()).alias("positional"),
        F.count_if(negative).alias("negative"),
        F.count_if(F.col("trim_from") < 0).alias("before"),
    ).first()
    if checked["negative"] or checked["before"]:
        raise ValueError("a trim must start at 0 or later and must not keep a negative number of rows")
    born = lists.select("id", "key", "value", "expireat", F.lit(-1).cast("bigint").alias("_born")).unionByName(
        commands.where(F.col("op") == "insert").select(
            (F.lit(first_id) + F.col("seq")).cast("bigint").alias("id"),
            "key",
            F.col("item").alias("value"),
            F.lit(None).cast(lists.schema["expireat"].dataType).alias("expireat"),
            F.col("seq").alias("_born"),
        )
    )
    removes = commands.where(F.col("op") == "remove").select("seq", "key", F.col("item").alias("value"))

    if not checked["positional"]:
        alive = _without_removed(born, removes)
    else:
        sizes = stored(
            born.select("key")
            .unionByName(commands.select("key"))
            .groupBy("key")
            .agg(F.count(F.lit(1)).alias("_rows"))
            .join(trims.where(~_empty()).select("key").distinct(), "key", "left_semi")
        )
        small = sizes.where(F.col("_rows") <= fold_rows).select("key")
        large = sizes.where(F.col("_rows") > fold_rows).select("key")
        untrimmed = _without_removed(born.join(sizes.select("key"), "key", "left_anti"), removes)
        # No such list reaches beyond its own rows, so positions above may be cut to an integer's range.
        most = F.lit(fold_rows + 1).cast("bigint")
        short = trims.withColumns({c: F.least(F.col(c).cast("bigint"), most) for c in ("trim_from", "trim_to")})
        folded = _fold_in_rows(*[df.join(small, "key", "left_semi") for df in (born, removes, short)])
        alive = untrimmed.unionByName(folded)
        if not large.isEmpty():
            parts = [df.join(large, "key", "left_semi") for df in (born, removes, trims)]
            alive = alive.unionByName(_trim_in_rounds(*parts, width))

    reached = F.col("_touch") > F.col("_born")
    return (
        alive.join(by_key, "key", "left")
        .where(F.col("_key_kill").isNull() | (F.col("_born") > F.col("_key_kill")))
        .withColumn("expireat", F.when(reached, F.col("_touch_at")).otherwise(F.col("expireat")))
        .select(*lists.columns)
    )


def _without_removed(born: DataFrame, removes: DataFrame) -> DataFrame:
    """Rows with no later removal of their value."""
    last = group(removes, "key", "value").agg(F.max("seq").alias("_removed")).select("_by.*", "_removed")
    joined = born.join(last, ["key", "value"], "left")
    return joined.where(F.col("_removed").isNull() | (F.col("_born") > F.col("_removed"))).select(*born.columns)


def _fold_in_rows(born: DataFrame, removes: DataFrame, trims: DataFrame) -> DataFrame:
    """Replay of lists of at most FOLD_ROWS rows and commands, each as one array."""
    none = F.lit(None)
    row = F.struct("id", "value", "expireat", "_born")
    events = (
        born.select("key", F.col("_born").alias("seq"), F.col("id").alias("ord"), F.lit("insert").alias("op"),
                    row.alias("row"), none.cast("int").alias("trim_from"), none.cast("int").alias("trim_to"))
        .unionByName(
            removes.select("key", "seq", F.lit(0).cast("bigint").alias("ord"), F.lit("remove").alias("op"),
                           F.struct(none.cast("bigint").alias("id"), "value",
                                    none.cast(born.schema["expireat"].dataType).alias("expireat"),
                                    none.cast("bigint").alias("_born")).alias("row"),
                           none.cast("int").alias("trim_from"), none.cast("int").alias("trim_to"))
        )
        .unionByName(
            trims.select("key", "seq", F.lit(0).cast("bigint").alias("ord"), F.lit("trim").alias("op"),
                         none.cast(born.select(row.alias("row")).schema["row"].dataType).alias("row"),
                         F.col("trim_from").cast("int").alias("trim_from"),
                         F.col("trim_to").cast("int").alias("trim_to"))
        )
    )
    log = events.groupBy("key").agg(
        F.array_sort(F.collect_list(F.struct("seq", "ord", "op", "trim_from", "trim_to", "row"))).alias("log")
    )
    start = F.array().cast(f"array<{events.schema['row'].dataType.simpleString()}>")

    def step(acc: Column, e: Column) -> Column:
        return (
            F.when(e["op"] == "insert", F.concat(acc, F.array(e["row"])))
            .when(
                e["op"] == "remove",
                F.filter(acc, lambda x: ~F.coalesce(x["value"] == e["row"]["value"], F.lit(False))),
            )
            .otherwise(F.slice(acc, e["trim_from"] + 1, e["trim_to"] - e["trim_from"] + 1))
        )

    rows = log.select("key", F.explode(F.aggregate("log", start, step)).alias("row"))
    return rows.select("row.id", "key", "row.value", "row.expireat", "row._born")


def _trim_in_rounds(born: DataFrame, removes: DataFrame, trims: DataFrame, width: int) -> DataFrame:
    """Exact trims of lists of any size: round n applies every list's n-th trim."""
    # The removal that ends a row is the first one of its value after it was born: the log read
    # backwards, the last removal seen. Snapshot rows, all born at -1, share the earliest removal.
    newest_first = (-F.col("seq")).alias("back")
    matchable = (F.col("_born") >= 0) & F.col("value").isNotNull()
    inserted = born.where(matchable)
    merged = inserted.select("key", "value", (-F.col("_born")).alias("back"), F.lit(None).cast("bigint").alias("_at"),
                             "id", "expireat", "_born")
    marks = removes.select("key", "value", newest_first, F.col("seq").alias("_at"))
    later = (
        carry_last(
            merged.unionByName(marks, allowMissingColumns=True), ["key", "value"], "back", F.col("_at"), "_removed", width
        )
        .where(F.col("id").isNotNull())
        .select(*born.columns, "_removed")
    )
    earliest = group(removes, "key", "value").agg(F.min("seq").alias("_removed")).select("_by.*", "_removed")
    kept = born.where(~matchable).join(earliest, ["key", "value"], "left").select(*born.columns, "_removed")
    rows = kept.unionByName(later)

    turns = stored(position_per_key(trims, ["key"], "seq", width=width, name="_turn"))
    last_turn = turns.agg(F.max("_turn")).first()[0]
    # A list leaves the rounds after its last trim, so every round rewrites only those still in it.
    finished = new_folder(born.sparkSession)
    rows = stored(rows)
    for turn in range(last_turn + 1):
        now = turns.where(F.col("_turn") == turn).select("key", F.col("seq").alias("_now"), "trim_from", "trim_to")
        rows.join(now, "key", "left_anti").write.mode("append").parquet(finished)
        timed = rows.join(now, "key")
        later = timed.where(F.col("_born") > F.col("_now")).select(*rows.columns)
        present = timed.where((F.col("_born") < F.col("_now")) & ~F.coalesce(F.col("_removed") < F.col("_now"), F.lit(False)))
        ranked = position_per_key(present, ["key"], "id", width=width)
        survivors = ranked.where(F.col("position").between(F.col("trim_from"), F.col("trim_to"))).select(*rows.columns)
        rows = stored(later.unionByName(survivors))
    rows.write.mode("append").parquet(finished)
    settled = born.sparkSession.read.schema(rows.schema).parquet(finished)
    return settled.where(F.col("_removed").isNull()).select(*born.columns)
