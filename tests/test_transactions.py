import random
from datetime import datetime

import pytest
from test_apply import BASE, JOB, SET, STATE, job

from ledgerline.operators import transactions

NOW = datetime(2024, 5, 1, 12)
RANGE = "txn_id LONG, seq LONG, key STRING, item STRING"
LOG = (
    "txn_id LONG, seq LONG, target STRING, op STRING, key STRING, item STRING, score DOUBLE, value STRING, expire_at TIMESTAMP, jobid LONG, "
    "name STRING, reason STRING, data STRING, ttl_seconds DOUBLE, queue STRING, trim_from INT, trim_to INT, ts TIMESTAMP"
)
FIELDS = [column.split()[0] for column in LOG.split(", ")]
TABLES = {
    "jobqueue": "id LONG, jobid LONG, queue STRING, fetchedat TIMESTAMP, updatecount INT",
    "counter": "id LONG, key STRING, value LONG, expireat TIMESTAMP",
    "hash": "id LONG, key STRING, field STRING, value STRING, expireat TIMESTAMP",
    "list": "id LONG, key STRING, value STRING, expireat TIMESTAMP",
}


def replay(start, commands):
    """(members with their scores, void transactions) of commands (txn, seq, key, item, op, score), one after another."""
    have, void = dict(start), set()
    for txn in sorted({c[0] for c in commands}):
        work = dict(have)
        for _, _, key, item, op, score in sorted(c for c in commands if c[0] == txn):
            if op == "insert":
                if (key, item) in work:
                    void.add(txn)
                work[key, item] = 0.0
            elif op in ("add", "add_score"):
                work[key, item] = score
            elif op == "remove":
                work.pop((key, item), None)
            elif op == "remove_key":
                work = {k: v for k, v in work.items() if k[0] != key}
        if txn not in void:
            have = work
    return have, void


def sets(frame, members):
    return frame([(i, k, s, v, None) for i, ((k, v), s) in enumerate(sorted(members.items()))], SET)


def outcome(result):
    after, failed = result
    rows, lost = after.collect(), [r.txn_id for r in failed.collect()]
    assert len(rows) == len({(r.key, r.value) for r in rows}) and len(lost) == len(set(lost))
    return {(r.key, r.value): r.score for r in rows}, set(lost)


@pytest.mark.parametrize("seed", [1, 2])
def test_range_inserts_equal_replay(frame, seed):
    rng = random.Random(seed)
    start = {("k", f"v{i}"): 1.0 for i in range(3)}
    log = [(t, 10 * t + n, "k" if rng.random() < 0.5 else "l", f"v{rng.randrange(40)}", "insert", 0.0) for t in range(40) for n in range(rng.randrange(1, 4))]
    got = outcome(transactions.apply_set_range(sets(frame, start), frame([c[:4] for c in log], RANGE), BASE))
    assert got == replay(start, log)


@pytest.mark.parametrize("seed, width", [(1, 1 << 20), (2, 7), (3, 1 << 20), (4, 3), (5, 1 << 20)])
def test_inserts_beside_removals_equal_replay(frame, seed, width):
    """Batch inserts, adds, removals of members and of keys; removals and adds in void transactions have no effect."""
    rng = random.Random(seed)
    keys, items = ["k", "l"], [f"v{i}" for i in range(4 + seed)]
    start = {(k, v): 1.0 for k in keys for v in items if rng.random() < 0.4}
    ops = ["insert"] * 5 + ["add", "add_score", "remove", "remove", "remove", "remove_key"]
    log = []
    for t in range(60):
        for n in range(rng.randrange(1, 4)):
            log.append((t, 10 * t + n, rng.choice(keys), rng.choice(items), rng.choice(ops), float(rng.randrange(9))))
    commands = frame([(*c, None) for c in log], RANGE + ", op STRING, score DOUBLE, expire_at TIMESTAMP")
    got = outcome(transactions.apply_set_range(sets(frame, start), commands, BASE, width))
    want = replay(start, log)
    assert got == want and 5 < len(want[1]) < 55


def test_a_chain_of_conflicts_takes_logarithmic_rounds(spark, frame):
    """Each transaction collides with the next one only: every other one holds, however long the chain."""
    n = 10_000
    commands = spark.range(2 * n).selectExpr("id div 2 AS txn_id", "id AS seq", "'k' AS key", "concat('v', id div 2 + id % 2) AS item")
    rounds = []
    after, failed = transactions.apply_set_range(frame([], SET), commands, rounds=rounds)
    assert {r.txn_id for r in failed.collect()} == set(range(1, n, 2)) and after.count() == n
    assert sum(rounds) + len(rounds) < 20


def test_a_chain_through_removals(spark, frame):
    """Each transaction takes a member out that the next one puts in; the first one fails, so all fail."""
    n = 300
    rows = [(t, 2 * t, "k", f"v{t}", "insert", 0.0, None) for t in range(n)] + [(t, 2 * t + 1, "k", f"v{t + 1}", "remove", 0.0, None) for t in range(n)]
    commands = frame(rows, RANGE + ", op STRING, score DOUBLE, expire_at TIMESTAMP")
    rounds = []
    after, failed = transactions.apply_set_range(sets(frame, {("k", f"v{t}"): 1.0 for t in range(n + 1)}), commands, rounds=rounds)
    assert failed.count() == n and after.count() == n + 1 and sum(rounds) < 14


def test_many_ask_for_one_member(spark, frame):
    """A hot member is settled for all who ask at once."""
    commands = spark.range(5000).selectExpr("id AS txn_id", "id AS seq", "'k' AS key", "'v' AS item")
    rounds = []
    after, failed = transactions.apply_set_range(frame([], SET), commands, rounds=rounds)
    assert failed.count() == 4999 and after.count() == 1 and sum(rounds) <= 4


def test_conflicts_of_several_are_replayed_in_blocks(frame):
    """Transactions that wait for several others need one round, however deep their conflicts are."""
    rng = random.Random(9)
    keys, items = ["k", "l", "m"], [f"v{i}" for i in range(6)]
    start = {(k, v): 1.0 for k in keys for v in items if rng.random() < 0.4}
    ops = ["insert"] * 6 + ["add", "remove", "remove", "remove", "remove", "remove_key"]
    log = [(t, 10 * t + n, rng.choice(keys), rng.choice(items), rng.choice(ops), 0.0) for t in range(400) for n in range(3)]
    commands = frame([(*c, None) for c in log], RANGE + ", op STRING, score DOUBLE, expire_at TIMESTAMP")
    for block_rows in (1 << 19, 150):
        rounds = []
        void = transactions.void_transactions(None, sets(frame, start), commands, rounds=rounds, block_rows=block_rows)
        lost = [r.txn_id for r in void.collect()]
        assert sorted(lost) == sorted(replay(start, log)[1]) and len(rounds) == 1


def command(txn, seq, target, op, **rest):
    given = {"txn_id": txn, "seq": seq, "target": target, "op": op, "ts": NOW, "score": 0.0, **rest}
    return tuple(given.get(field) for field in FIELDS)


def test_a_void_transaction_reaches_every_table(frame):
    """All that a void transaction says is dropped, whatever table made it void; what it kept from others is free."""
    log = [
        # Holds, in seven tables.
        command(1, 10, "set", "insert", key="s", item="a"),
        command(1, 11, "job", "set_state", jobid=1, name="One", data="{}"),
        command(1, 12, "queue", "enqueue", jobid=1, queue="q"),
        command(1, 13, "counter", "increment", key="c"),
        command(1, 14, "hash", "add", key="h", item="f", value="1"),
        command(1, 15, "list", "insert", key="l", item="x"),
        # Void by an existing member: its other commands go, too.
        command(2, 20, "job", "set_state", jobid=1, name="Two", data="{}"),
        command(2, 21, "queue", "enqueue", jobid=1, queue="r"),
        command(2, 22, "counter", "increment", key="c"),
        command(2, 23, "hash", "add", key="h", item="f", value="2"),
        command(2, 24, "list", "insert", key="l", item="y"),
        command(2, 25, "set", "insert", key="s", item="b"),
        command(2, 26, "set", "insert", key="s", item="a"),
        # Void by an unknown job: the member that it inserts stays free.
        command(3, 30, "set", "insert", key="s", item="c"),
        command(3, 31, "job", "add_state", jobid=404, name="None", data="{}"),
        command(3, 32, "job", "expire_job", jobid=1, ttl_seconds=5.0),
        # Holds, since 2 and 3 do not.
        command(4, 40, "set", "insert", key="s", item="b"),
        command(4, 41, "set", "insert", key="s", item="c"),
        command(4, 42, "list", "insert", key="l", item="z"),
        command(4, 43, "job", "expire_job", jobid=404, ttl_seconds=5.0),
    ]
    tables = {name: frame([], schema) for name, schema in TABLES.items()} | {
        "job": frame([job(1), job(2)], JOB), "state": frame([], STATE), "set": frame([], SET)
    }
    after, void = transactions.apply_transactions(tables, frame(log, LOG), BASE)
    assert {(r.txn_id, r.reason) for r in void.collect()} == {(2, transactions.EXISTING_MEMBER), (3, transactions.UNKNOWN_JOB)}
    assert {(r.id, r.value) for r in after["set"].collect()} == {(BASE + 10, "a"), (BASE + 40, "b"), (BASE + 41, "c")}
    assert [(r.id, r.name) for r in after["state"].collect()] == [(BASE + 11, "One")]
    assert {(r.id, r.statename, r.expireat) for r in after["job"].collect()} == {(1, "One", None), (2, None, None)}
    assert [(r.id, r.queue) for r in after["jobqueue"].collect()] == [(BASE + 12, "q")]
    assert [(r.id, r.value) for r in after["counter"].collect()] == [(BASE + 13, 1)]
    assert [(r.field, r.value) for r in after["hash"].collect()] == [("f", "1")]
    assert {r.value for r in after["list"].collect()} == {"x", "z"}


def test_empty_log(frame):
    tables = {name: frame([], schema) for name, schema in TABLES.items()} | {"job": frame([job(1)], JOB), "state": frame([], STATE), "set": frame([], SET)}
    after, void = transactions.apply_transactions(tables, frame([], LOG), BASE)
    assert void.count() == 0 and after["job"].count() == 1 and after["set"].count() == 0
