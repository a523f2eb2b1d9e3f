"""One log of transactions over all tables: which of them hold, and the tables after them.

Transactions run one after another, by ``txn_id``, their commands by ``seq``. A transaction is void as a whole if
it sets the state of an unknown job, or if one of its batch inserts meets a member that the set has at that moment.
Whether it has depends on earlier transactions, which may themselves be void: a void one frees the members that it
would have inserted and keeps those that it would have removed.

Transactions with such an insert are settled in rounds. In a round every insert looks back along its member's history to
the last transaction known to hold and to those in between that are still open. Without open ones that matter it is
settled. If exactly one open transaction decides it, and the same one all other open inserts of its transaction, then
the verdict is that one's or its opposite, and such verdicts are passed on by pointer doubling: rounds grow with the
logarithm of a chain. Only a transaction that waits for several open ones at once waits for the next round. The earliest
open one never waits, and what is decided is dropped. Verdicts of arbitrary conflicts cannot all be had in
logarithmic rounds: picking the first non-conflicting ones in order is a P-complete problem. So as soon as a round leaves
more than an eighth open, the rest is replayed in blocks of transactions, in order, one task after another. What a block
leaves behind of a member or a key goes to the next block that touches it, so every row is read once.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.ranking import BUCKET_WIDTH, carry_latest
from ledgerline.operators import apply, lists
from ledgerline.operators.keys import group
from ledgerline.session import new_folder, stored

UNKNOWN_JOB, EXISTING_MEMBER = "unknown job", "existing member"
# Before every transaction; a member of the snapshot was added one later.
NEVER = -(1 << 63)
STATE_OPS = ("set_state", "add_state")
# About so many rows are replayed by one task.
BLOCK_ROWS = 1 << 19
# A line of a block: what happens to a member (item) or to a key (no item), by transaction ``txn``; or, without
# ``txn``, the next block that touches it.
_LINE = "key string, item string, txn bigint, asks boolean, there boolean, open boolean, next int"
_LEFT = "key string, item string, txn bigint, there boolean, dest int"
_LOST = -1


def unknown_job_transactions(job: DataFrame, commands: DataFrame) -> DataFrame:
    """Ids of transactions with a state for a job that does not exist."""
    states = commands.where(F.col("op").isin(*STATE_OPS)).select("txn_id", F.col("jobid").alias("id"))
    missing = states.join(job.select("id"), "id", "left_anti")
    return group(missing, "txn_id").agg(F.count(F.lit(1))).select("_by.txn_id")


def _histories(sets: DataFrame, commands: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """(histories, key removals) of the members that some batch insert asks for.

    A history has a row per (key, item, transaction): whether an insert of it depends on earlier transactions
    (``asks``), whether one meets a member of its own transaction (``clash``), and whether the member is there after it (``there``). Key removals are ``key, txn``.
    """
    inserts = commands.where(F.col("op") == "insert")
    asked = group(inserts, "key", "item").agg(F.count(F.lit(1))).select("_by.*")
    asked_keys = group(inserts, "key").agg(F.count(F.lit(1))).select("_by.key")
    events = (
        commands.where(F.col("op").isin("insert", "add", "add_score", "remove"))
        .select("txn_id", "seq", "key", "item", "op")
        .join(asked, ["key", "item"], "left_semi")
        .withColumn("adds", F.col("op") != "remove")
    )
    removals = commands.where(F.col("op") == "remove_key").select("txn_id", "seq", "key").join(asked_keys, "key", "left_semi")
    # What the own transaction did before: to the item, and to the whole key.
    own = stored(carry_latest(events, ["txn_id", "key", "item"], "seq", {"before": F.struct("seq", "adds")}, width=width))
    cleared = carry_latest(
        own.withColumn("removal", F.lit(None).cast("bigint")).unionByName(
            removals.withColumn("removal", F.col("seq")), allowMissingColumns=True
        ),
        ["txn_id", "key"], "seq", {"cleared": F.col("removal")}, width=width,
    ).where("item IS NOT NULL")
    insert = F.col("op") == "insert"
    after_clear = F.col("cleared").isNull() | (F.col("before.seq") > F.col("cleared"))
    clash = insert & F.coalesce(F.col("before.adds") & after_clear, F.lit(False))
    asks = insert & F.col("before").isNull() & F.col("cleared").isNull()
    rows = group(cleared, "key", "item", "txn_id").agg(
        F.max(asks).alias("asks"), F.max(clash).alias("clash"), F.max("seq").alias("seq"), F.max_by("adds", "seq").alias("there")
    ).select("_by.*", "asks", "clash", "seq", "there")
    last_clear = group(removals, "key", "txn_id").agg(F.max("seq").alias("cleared")).select("_by.*", "cleared")
    ended = rows.join(last_clear, ["key", "txn_id"], "left").select(
        "key", "item", F.col("txn_id").alias("txn"), "asks", "clash",
        (F.col("there") & (F.col("cleared").isNull() | (F.col("seq") > F.col("cleared")))).alias("there"),
    )
    base = sets.select("key", F.col("value").alias("item")).join(asked, ["key", "item"], "left_semi").select(
        "key", "item", F.lit(NEVER + 1).cast("bigint").alias("txn"), F.lit(False).alias("asks"), F.lit(False).alias("clash"), F.lit(True).alias("there")
    )
    return ended.unionByName(base), last_clear.select("key", F.col("txn_id").alias("txn"))


def _answers(histories: DataFrame, removals: DataFrame, open_txns: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """(answers, histories that open inserts still need). Per open insert ``txn``: ``passes`` if settled, else the one open transaction ``var`` that decides it, whose
    verdict (``flip`` false) or its opposite is the answer; ``waits`` if there are several."""
    mark = open_txns.withColumn("open", F.lit(True))
    waiting = histories.where("asks").join(open_txns, "txn", "left_semi")
    asked = group(waiting, "key", "item").agg(F.count(F.lit(1))).select("_by.*")
    rows = stored(
        histories.join(asked, ["key", "item"], "left_semi").join(mark, "txn", "left").withColumn("open", F.coalesce("open", F.lit(False)))
    )
    opened, there = F.col("open"), F.col("there")
    first = stored(
        carry_latest(
            rows, ["key", "item"], "txn",
            {
                "held": F.when(~opened, F.struct("txn", "there")),
                "last": F.when(opened, F.col("txn")),
                "last_in": F.when(opened & there, F.col("txn")),
                "last_out": F.when(opened & ~there, F.col("txn")),
            },
            width=width,
        )
    )
    # The open transaction before the last open one.
    twice = carry_latest(first, ["key", "item"], "txn", {"open_row": F.when(opened, F.struct("txn", "there", F.col("last").alias("second")))}, width=width)
    asking = stored(twice.where(opened & F.col("asks")))
    # Key removals are looked up once per (key, transaction) that asks.
    pairs = group(asking, "key", "txn").agg(F.count(F.lit(1))).select("_by.*")
    marked = removals.join(group(asking, "key").agg(F.count(F.lit(1))).select("_by.key"), "key", "left_semi").join(mark, "txn", "left")
    timeline = marked.select("key", "txn", F.coalesce("open", F.lit(False)).alias("open"), F.lit(1).alias("kind")).unionByName(
        pairs.select("key", "txn", F.lit(None).cast("boolean").alias("open"), F.lit(0).alias("kind"))
    )
    cleared = carry_latest(
        timeline, ["key"], "txn", {"key_held": F.when(~opened, F.col("txn")), "key_last": F.when(opened, F.col("txn"))}, "kind", width
    )
    cleared = carry_latest(
        cleared, ["key"], "txn", {"key_open": F.when(opened, F.struct("txn", F.col("key_last").alias("second")))}, "kind", width
    )
    looked = asking.join(cleared.where("kind = 0").drop("open", "kind"), ["key", "txn"])

    never = F.lit(NEVER).cast("bigint")
    at = lambda c: F.coalesce(F.col(c), never)
    by_key = at("key_held") > at("held.txn")
    since = F.greatest(at("key_held"), at("held.txn"))
    has = ~by_key & F.coalesce(F.col("held.there"), F.lit(False))
    told = looked.select(
        "txn", since.alias("since"), has.alias("has"), "last_in", F.greatest(at("last_out"), at("key_last")).alias("gone"),
        F.col("open_row.txn").alias("near"), F.col("open_row.there").alias("near_there"),
        F.array_distinct(F.filter(F.array("open_row.txn", "open_row.second", "key_open.txn", "key_open.second"), lambda t: t > since)).alias("vars"),
    )
    settled = F.when(F.col("has") & (F.col("gone") <= F.col("since")), F.lit(False)).when(
        ~F.col("has") & (at("last_in") <= F.col("since")), F.lit(True)
    )
    var = F.when(F.size("vars") == 1, F.element_at("vars", 1))
    # It changes what is there, or the answer would be settled: if it holds, the member is there or is not.
    return told.select(
        "txn", settled.alias("passes"), F.when(settled.isNull(), var).alias("var"),
        F.coalesce((F.col("near") == var) & F.col("near_there"), F.lit(False)).alias("flip"),
        (settled.isNull() & var.isNull()).alias("waits"),
    ), rows.drop("open")


def _pointers(answers: DataFrame) -> DataFrame:
    """Per transaction that all its inserts agree on: verdict = ``flip`` differs from that of ``var`` (null: void)."""
    told = group(answers, "txn").agg(
        F.max(~F.coalesce("passes", F.lit(True))).alias("fails"),
        F.max("waits").alias("waits"),
        F.min("var").alias("low"),
        F.max("var").alias("high"),
        F.max(F.when(F.col("var").isNotNull(), F.col("flip"))).alias("opposite"),
        F.max(F.when(F.col("var").isNotNull(), ~F.col("flip"))).alias("same"),
    )
    # Asked to hold both with and without another, it never does.
    never = F.col("fails") | (F.col("opposite") & F.col("same") & (F.col("low") == F.col("high")))
    one = ~F.col("waits") & F.coalesce(F.col("low") == F.col("high"), F.lit(True))
    return told.where(F.coalesce(never, F.lit(False)) | one).select(
        F.col("_by.txn").alias("txn"),
        F.when(~F.coalesce(never, F.lit(False)), F.col("low")).alias("var"),
        F.when(F.coalesce(never, F.lit(False)), F.lit(False)).otherwise(F.coalesce("opposite", F.lit(True))).alias("flip"),
    )


def _doubled(pointers: DataFrame) -> tuple[DataFrame, int]:
    """Pointers followed to their ends: to a verdict, or to a transaction that waits; and the rounds that took."""
    steps = 0
    while True:
        to = pointers.select(F.col("txn").alias("var"), F.col("var").alias("_var"), F.col("flip").alias("_flip"), F.lit(True).alias("_known"))
        joined = stored(pointers.join(to, "var", "left"))
        steps += 1
        known = F.col("_known").isNotNull()
        pointers = joined.select(
            "txn", F.when(known, F.col("_var")).otherwise(F.col("var")).alias("var"),
            F.when(known, F.col("flip") != F.col("_flip")).otherwise(F.col("flip")).alias("flip"),
        )
        if joined.where(known & F.col("_var").isNotNull()).isEmpty():
            return pointers, steps


def _replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One block, transaction by transaction: those that do not hold (``dest`` = -1), and what is left to later blocks."""
    state: dict[tuple, tuple[int, bool]] = {}  # last transaction on a member, or on a key's removal, and whether it is there
    touched, log = [], []
    for batch in batches:
        for key, item, txn, asks, there, open_, next_ in zip(*[column.to_pylist() for column in batch.columns]):
            place = (key, item)
            if txn is None:
                touched.append((place, next_))
            elif open_ is None:
                state[place] = (txn, there)
            else:
                log.append((txn, place, asks, there, open_))
    log.sort(key=lambda line: line[0])
    lost, at, never = [], 0, (NEVER, False)
    while at < len(log):
        txn, end, holds = log[at][0], at, True
        while end < len(log) and log[end][0] == txn:
            _, place, asks, _, open_ = log[end]
            if open_ and asks:
                last, there = state.get(place, never)
                holds = holds and not (there and last >= state.get((place[0], None), never)[0])
            end += 1
        if holds:
            state.update((line[1], (txn, line[3])) for line in log[at:end])
        else:
            lost.append(txn)
        at = end
    left = [(*place, *state[place], next_) for place, next_ in touched if next_ is not None and place in state]
    rows = [(None, None, txn, None, _LOST) for txn in lost] + left
    kinds = (pa.string(), pa.string(), pa.int64(), pa.bool_(), pa.int32())
    columns = zip(*rows) if rows else [()] * len(kinds)
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["key", "item", "txn", "there", "dest"])


def _in_blocks(histories: DataFrame, removals: DataFrame, open_txns: DataFrame, block_rows: int) -> DataFrame:
    """Open transactions that do not hold, by replay in blocks of about ``block_rows`` rows."""
    spark = histories.sparkSession
    mark = open_txns.withColumn("open", F.lit(True))
    asked = group(histories.where("asks").join(open_txns, "txn", "left_semi"), "key", "item").agg(F.count(F.lit(1))).select("_by.*")
    keys = group(asked, "key").agg(F.count(F.lit(1))).select("_by.key")
    base = F.col("txn") == NEVER + 1
    members = histories.join(asked, ["key", "item"], "left_semi").select("key", "item", "txn", "asks", "there")
    cleared = removals.join(keys, "key", "left_semi").select(
        "key", F.lit(None).cast("string").alias("item"), "txn", F.lit(False).alias("asks"), F.lit(False).alias("there")
    )
    rows = stored(members.unionByName(cleared).join(mark, "txn", "left").withColumn("open", F.coalesce("open", F.lit(False))))
    log = rows.where(~base)
    blocks = -(-log.count() // block_rows)
    # The bounds need not be exact, only the same for all.
    cuts = sorted({int(c) for c in log.approxQuantile("txn", [i / blocks for i in range(1, blocks)], 0.25 / blocks)}) if blocks > 1 else []
    bounds = F.array(*[F.lit(c).cast("bigint") for c in cuts]) if cuts else F.array().cast("array<bigint>")
    block = F.size(F.filter(bounds, lambda c: c < F.col("txn")))
    log = stored(log.withColumn("block", block))
    # One line per member, or key, and block that touches it; members of the snapshot come before the first.
    touches = log.where("item IS NOT NULL").select("key", "item", "block")
    starts = rows.where(base).select("key", "item", F.lit(-1).alias("block"))
    of_keys = log.select("key", F.lit(None).cast("string").alias("item"), "block")
    places = group(touches.unionByName(starts).unionByName(of_keys), "key", "item", "block").agg(F.count(F.lit(1))).select("_by.*")
    following = stored(places.withColumn("next", F.lead("block").over(Window.partitionBy("key", "item").orderBy("block"))))
    left, lines = new_folder(spark), new_folder(spark)
    following.where("block = -1 AND next IS NOT NULL").select(
        "key", "item", F.lit(NEVER + 1).cast("bigint").alias("txn"), F.lit(True).alias("there"), F.col("next").alias("dest")
    ).write.partitionBy("dest").parquet(f"{left}/block=-1")
    log.unionByName(following.where("block >= 0"), allowMissingColumns=True).repartition("block").write.partitionBy("block").parquet(lines)
    for number in range(len(cuts) + 1):
        lines_of = spark.read.schema(_LINE + ", block int").parquet(lines).where(F.col("block") == number)
        handed = spark.read.schema(_LEFT + ", block int").parquet(left).where(F.col("dest") == number)
        columns = [column.split()[0] for column in _LINE.split(", ")]
        together = lines_of.select(*columns).unionByName(handed.select("key", "item", "txn", "there"), allowMissingColumns=True)
        replayed = together.select(*columns).coalesce(1).mapInArrow(_replay, _LEFT)
        replayed.write.partitionBy("dest").parquet(f"{left}/block={number}")
    return spark.read.schema(_LEFT + ", block int").parquet(left).where(F.col("dest") == _LOST).select("txn")


def void_transactions(
    job: DataFrame | None,
    sets: DataFrame,
    commands: DataFrame,
    width: int = BUCKET_WIDTH,
    rounds: list[int] | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``txn_id, reason`` of the transactions of ``commands`` that are void.

    Commands are ``(txn_id, seq, op, key, item)`` on sets (op insert, add, add_score, remove, remove_key; others are
    ignored) and, if ``job`` is given, ``jobid``. Transactions follow each other by ``txn_id`` and must not interleave in
    ``seq``. ``rounds`` gets the number of doubling steps of each round; what a round leaves is replayed in blocks of about ``block_rows`` rows.
    """
    on_sets = commands.where("key IS NOT NULL")
    if job is None:
        unknown = commands.select("txn_id").limit(0)
    else:
        unknown = stored(unknown_job_transactions(job, commands))
        on_sets = on_sets.join(unknown, "txn_id", "left_anti")
    histories, removals = _histories(sets, on_sets, width)
    histories, removals = stored(histories), stored(removals)
    clash = stored(group(histories.where("clash"), "txn").agg(F.count(F.lit(1))).select("_by.txn"))
    void = clash
    histories = histories.join(clash, "txn", "left_anti")
    removals = removals.join(clash, "txn", "left_anti")
    open_txns = stored(group(histories.where("asks"), "txn").agg(F.count(F.lit(1))).select("_by.txn"))
    waiting = open_txns.count()
    while waiting:
        answers, histories = _answers(histories, removals, open_txns, width)
        ends, steps = _doubled(stored(_pointers(answers)))
        decided = stored(ends.where("var IS NULL"))
        if rounds is not None:
            rounds.append(steps)
        lost = decided.where(~F.col("flip")).select("txn")
        void = void.unionByName(lost)
        histories = histories.join(lost, "txn", "left_anti")
        removals = stored(removals.join(lost, "txn", "left_anti"))
        open_txns = stored(open_txns.join(decided, "txn", "left_anti"))
        before, waiting = waiting, open_txns.count()
        if waiting > before // 8:
            void = void.unionByName(_in_blocks(histories, removals, open_txns, block_rows))
            break
    return unknown.select("txn_id", F.lit(UNKNOWN_JOB).alias("reason")).unionByName(
        void.select(F.col("txn").alias("txn_id"), F.lit(EXISTING_MEMBER).alias("reason"))
    )


def apply_transactions(
    tables: dict[str, DataFrame], log: DataFrame, first_id: int = 0, width: int = BUCKET_WIDTH
) -> tuple[dict[str, DataFrame], DataFrame]:
    """(next tables, void transactions) after a log of committed transactions over all tables.

    ``tables`` holds job, state, jobqueue, counter, set, hash and list. A command has ``target`` (job, queue, counter, set,
    hash or list) and the columns of that table's commands: see ``apply_states``, ``apply_job_expiry``,
    ``apply_enqueue``, ``apply_counters``, ``apply_set``, ``apply_hash`` and ``apply_list``. On sets ``insert`` is a batch
    insert's item. What a void transaction says is applied to no table.
    """
    checked = log.select(
        "txn_id", "seq", F.when(F.col("target").isin("set", "job"), F.col("op")).alias("op"), F.when(F.col("target") == "set", F.col("key")).alias("key"),
        F.when(F.col("target") == "set", F.col("item")).alias("item"), F.when(F.col("target") == "job", F.col("jobid")).alias("jobid"),
    )
    void = stored(void_transactions(tables["job"], tables["set"], checked, width))
    kept = log.join(void.select("txn_id"), "txn_id", "left_anti")
    of = lambda target: kept.where(F.col("target") == target)
    inserted = F.col("op") == "insert"
    members = of("set").withColumns(
        {"op": F.when(inserted, F.lit("add")).otherwise(F.col("op")), "score": F.when(inserted, F.lit(0.0)).otherwise(F.col("score"))}
    )
    job, state = apply.apply_states(tables["job"], tables["state"], of("job"), first_id)
    return {
        "job": apply.apply_job_expiry(job, of("job")),
        "state": state,
        "jobqueue": apply.apply_enqueue(tables["jobqueue"], of("queue"), first_id),
        "counter": apply.apply_counters(tables["counter"], of("counter"), first_id),
        "set": apply.apply_set(tables["set"], members, first_id),
        "hash": apply.apply_hash(tables["hash"], of("hash"), first_id),
        "list": lists.apply_list(tables["list"], of("list"), first_id),
    }, void


def apply_set_range(
    sets: DataFrame, commands: DataFrame, first_id: int = 0, width: int = BUCKET_WIDTH, rounds: list[int] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(next set table, void transactions) after batch inserts ``(txn_id, seq, key, item)``, alone or, with ``op``, beside
    add, add_score, remove, remove_key, expire and persist (then with ``score`` and ``expire_at``)."""
    if "op" not in commands.columns:
        at = sets.schema["expireat"].dataType
        commands = commands.withColumns({"op": F.lit("insert"), "score": F.lit(0.0), "expire_at": F.lit(None).cast(at)})
    void = stored(void_transactions(None, sets, commands, width, rounds)).select("txn_id")
    inserted = F.col("op") == "insert"
    kept = commands.join(void, "txn_id", "left_anti").withColumns(
        {"op": F.when(inserted, F.lit("add")).otherwise(F.col("op")), "score": F.when(inserted, F.lit(0.0)).otherwise(F.col("score"))}
    )
    return apply.apply_set(sets, kept, first_id), void
