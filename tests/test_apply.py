import random
from datetime import datetime, timedelta

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from ledgerline.operators import apply, lists

NOW = datetime(2024, 5, 1, 12)
BASE = 1_000_000
JOB = "id LONG, stateid LONG, statename STRING, invocationdata STRING, arguments STRING, createdat TIMESTAMP, expireat TIMESTAMP"
STATE = "id LONG, jobid LONG, name STRING, reason STRING, createdat TIMESTAMP, data STRING"
PARAMETER = "id LONG, jobid LONG, name STRING, value STRING"
CHANGE = "seq LONG, txn_id LONG, committed BOOLEAN, ts TIMESTAMP, jobid LONG, op STRING, name STRING, reason STRING, data STRING, ttl_seconds DOUBLE"
SET = "id LONG, key STRING, score DOUBLE, value STRING, expireat TIMESTAMP"
HASH = "id LONG, key STRING, field STRING, value STRING, expireat TIMESTAMP"
LIST = "id LONG, key STRING, value STRING, expireat TIMESTAMP"
KEYED = "seq LONG, key STRING, item STRING, op STRING, score DOUBLE, value STRING, expire_at TIMESTAMP"
LISTED = "seq LONG, key STRING, item STRING, op STRING, expire_at TIMESTAMP, trim_from INT, trim_to INT"
SERVER = "id STRING, data STRING, lastheartbeat TIMESTAMP"
SERVED = "seq LONG, ts TIMESTAMP, id STRING, op STRING, data STRING"


def job(i, stateid=None, name=None):
    return (i, stateid, name, "{}", "[]", NOW, None)


def change(seq, jobid, op, txn=1, committed=True, name="State", ttl=None, data="{}"):
    return (seq, txn, committed, NOW, jobid, op, name, "r", data, ttl)


def test_set_state_moves_only_that_job(frame):
    jobs, log = frame([job(1), job(2)], JOB), frame([change(3, 1, "set_state", data="")], CHANGE)
    after, states = apply.apply_states(jobs, frame([], STATE), log, BASE)
    assert {r.id: (r.stateid, r.statename) for r in after.collect()} == {1: (BASE + 3, "State"), 2: (None, None)}
    assert [(r.id, r.jobid, r.data) for r in states.collect()] == [(BASE + 3, 1, "{}")]


def test_add_state_leaves_the_pointer(frame):
    log = frame([change(3, 1, "add_state")], CHANGE)
    after, states = apply.apply_states(frame([job(1)], JOB), frame([], STATE), log, BASE)
    assert after.first().stateid is None and states.count() == 1


def test_only_committed_transactions_apply(frame, spark):
    log = frame([change(1, 1, "set_state", txn=1), change(2, 1, "set_state", txn=2, committed=False)], CHANGE)
    assert [r.seq for r in apply.committed_commands(log).collect()] == [1]
    chosen = spark.createDataFrame([(2,)], "txn_id LONG")
    assert [r.seq for r in apply.committed_commands(log, chosen).collect()] == [2]


def test_state_of_an_unknown_job_voids_its_transaction(frame):
    log = frame([change(1, 1, "set_state", txn=1), change(2, 404, "set_state", txn=1), change(3, 1, "set_state", txn=2), change(4, 404, "expire_job", txn=2)], CHANGE)
    good, rejects = apply.reject_unknown_jobs(log, frame([job(1)], JOB))
    assert sorted(r.seq for r in good.collect()) == [3, 4] and [r.seq for r in rejects.collect()] == [2]


def test_job_expiry_drops_the_fraction_and_last_wins(frame):
    jobs = frame([job(1), job(2), (3, None, None, "{}", "[]", NOW, NOW)], JOB)
    log = frame([change(1, 1, "persist_job"), change(2, 1, "expire_job", ttl=60.9), change(3, 3, "persist_job"), change(4, 404, "expire_job", ttl=1.0)], CHANGE)
    after = {r.id: r.expireat for r in apply.apply_job_expiry(jobs, log).collect()}
    assert after == {1: NOW + timedelta(seconds=60), 2: None, 3: None}


def test_parameters_upsert_null_included(frame):
    commands = frame([(1, 1, "P", "a"), (2, 1, "P", "b"), (3, 2, "P", None), (4, 2, "Q", "n"), (5, 404, "P", "x")], "seq LONG, jobid LONG, name STRING, value STRING")
    stored = frame([(7, 2, "P", "old")], PARAMETER)
    after, rejects = apply.apply_job_parameters(frame([job(1), job(2)], JOB), stored, commands, BASE)
    assert sorted(tuples(after.select("id", "jobid", "name", "value"))) == [(7, 2, "P", None), (BASE + 1, 1, "P", "b"), (BASE + 4, 2, "Q", "n")]
    assert [r.seq for r in rejects.collect()] == [5]


def test_create_job_with_parameters(frame):
    requests = frame([(1, "", None, NOW, 1.5)], "seq LONG, invocationdata STRING, arguments STRING, createdat TIMESTAMP, expire_in DOUBLE")
    requests = requests.withColumn("parameters", F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit(None).cast("string")))
    jobs, parameters = apply.create_jobs(requests, BASE, BASE)
    row = jobs.first()
    assert (row.id, row.invocationdata, row.arguments, row.expireat) == (BASE + 1, "{}", "[]", NOW + timedelta(seconds=1.5))
    assert sorted(tuples(parameters)) == [(BASE, BASE + 1, "a", "1"), (BASE + 1, BASE + 1, "b", None)]


def test_jobs_may_have_any_number_of_parameters(spark):
    many = spark.range(1, 4).selectExpr(
        "id AS seq", "'' AS invocationdata", "'' AS arguments", "timestamp_ntz'2024-01-01 00:00:00' AS createdat", "1.0D AS expire_in",
        "CASE id WHEN 2 THEN NULL ELSE map_from_arrays(transform(sequence(1, 5000), i -> 'p' || i), transform(sequence(1, 5000), i -> 'v')) END AS parameters",
    )
    rows = apply.create_jobs(many, BASE, BASE)[1].collect()
    assert sorted(r.id for r in rows) == list(range(BASE, BASE + 10000))
    assert {r.jobid for r in rows if r.id < BASE + 5000} == {BASE + 1}


def test_enqueue_allows_duplicates(frame):
    queue = frame([(1, 7, "q", NOW, 3)], "id LONG, jobid LONG, queue STRING, fetchedat TIMESTAMP, updatecount INT")
    added = frame([(1, "q", 7), (2, "q", 7)], "seq LONG, queue STRING, jobid LONG")
    assert sorted(r.id for r in apply.apply_enqueue(queue, added, BASE).collect()) == [1, BASE + 1, BASE + 2]


def test_counter_commands(frame):
    commands = frame([(1, NOW, "k", "increment", None), (2, NOW, "k", "decrement", 10.9)], "seq LONG, ts TIMESTAMP, key STRING, op STRING, ttl_seconds DOUBLE")
    after = apply.apply_counters(frame([], "id LONG, key STRING, value LONG, expireat TIMESTAMP"), commands, BASE)
    assert sorted((r.value, r.expireat) for r in after.collect() if r.expireat) == [(-1, NOW + timedelta(seconds=10))]
    assert [r.expireat for r in after.collect() if r.value == 1] == [None]


def replay_items(start, log):
    """Sequential meaning of set and hash commands; rows are key, item -> [id, payload, expireat]."""
    rows = {k: list(v) for k, v in start.items()}
    for seq, key, item, op, payload, at in log:
        if op in ("add", "add_score"):
            rows.setdefault((key, item), [BASE + seq, None, None])[1] = payload
        elif op == "remove":
            rows.pop((key, item), None)
        elif op == "remove_key":
            rows = {k: v for k, v in rows.items() if k[0] != key}
        else:
            for k, v in rows.items():
                if k[0] == key:
                    v[2] = at if op == "expire" else None
    return rows


def keyed_log(rng, n):
    log = []
    for seq in range(n):
        op = rng.choices(["add", "add_score", "remove", "remove_key", "expire", "persist"], [8, 8, 5, 1, 3, 1])[0]
        key = "hot" if rng.random() < 0.4 else f"k{rng.randrange(6)}"
        at = NOW + timedelta(seconds=seq) if op == "expire" else None
        log.append((seq, key, f"v{rng.randrange(6)}", op, float(seq), at))
    return log


@pytest.mark.parametrize("seed,n", [(1, 30), (2, 200), (3, 600)])
def test_set_and_hash_equal_replay(frame, seed, n):
    rng = random.Random(seed)
    start = {(k, f"v{i}"): (10 * j + i, -1.0, rng.choice([None, NOW])) for j, k in enumerate(["hot", "k1", "only"]) for i in range(4)}
    log = keyed_log(rng, n)
    want = replay_items(start, log)
    commands = frame([(s, k, i, op, p, str(p), at) for s, k, i, op, p, at in log], KEYED)
    sets = frame([(v[0], k[0], v[1], k[1], v[2]) for k, v in start.items()], SET)
    got = {(r.key, r.value): [r.id, r.score, r.expireat] for r in apply.apply_set(sets, commands, BASE).collect()}
    assert got == want
    hashes = frame([(v[0], k[0], k[1], str(v[1]), v[2]) for k, v in start.items()], HASH)
    got = {(r.key, r.field): [r.id, r.value, r.expireat] for r in apply.apply_hash(hashes, commands, BASE).collect()}
    assert got == {k: [v[0], str(v[1]), v[2]] for k, v in want.items()}


def test_a_log_applies_in_two_halves(frame):
    log = keyed_log(random.Random(9), 200)
    frames = [frame([(s, k, i, op, p, "", at) for s, k, i, op, p, at in part], KEYED) for part in (log, log[:90], log[90:])]
    empty = frame([], SET)
    whole = apply.apply_set(empty, frames[0], BASE)
    halves = apply.apply_set(apply.apply_set(empty, frames[1], BASE), frames[2], BASE)
    assert sorted(map(str, tuples(whole))) == sorted(map(str, tuples(halves)))


def test_adding_twice_overwrites_the_score(frame):
    commands = frame([(1, "k", "v", "add", 0.0, "", None), (2, "k", "v", "add_score", 3.2, "", None)], KEYED)
    assert [(r.value, r.score) for r in apply.apply_set(frame([], SET), commands).collect()] == [("v", 3.2)]


def test_many_transactions_tag_their_jobs(frame):
    """1000 transactions each tag a job with a shared tag and one of ten group tags, and link it back."""
    log = []
    for i in range(1000):
        for n, (key, item) in enumerate([("tags:shared", i), (f"tags:g{i % 10}", i), (f"job:{i}", "shared"), (f"job:{i}", f"g{i % 10}")]):
            log.append((i * 10 + n, key, str(item), "add", 0.0, "", None))
    counts = apply.apply_set(frame([], SET), frame(log, KEYED)).groupBy("key").count().collect()
    found = {r.key: r["count"] for r in counts}
    assert found["tags:shared"] == 1000 and all(found[f"tags:g{g}"] == 100 for g in range(10))
    assert sum(n for k, n in found.items() if k.startswith("job:")) == 2000


def replay_list(start, log, base=BASE):
    """Sequential meaning of list commands; rows are [id, key, value, expireat]."""
    rows = [list(r) for r in start]
    for seq, key, item, op, at, low, high in log:
        if op == "insert":
            rows.append([base + seq, key, item, None])
        elif op == "remove":
            rows = [r for r in rows if not (r[1] == key and r[2] is not None and r[2] == item)]
        elif op == "trim":
            mine = sorted(r[0] for r in rows if r[1] == key)[low : high + 1]
            rows = [r for r in rows if r[1] != key or r[0] in mine]
        else:
            for r in rows:
                if r[1] == key:
                    r[3] = at if op == "expire" else None
    return sorted(map(str, rows))


def list_log(rng, n, trims):
    log = []
    for seq in range(n):
        op = rng.choices(["insert", "remove", "trim", "expire", "persist"], [20, 2, trims, 2, 1])[0]
        key = "hot" if rng.random() < 0.4 else f"k{rng.randrange(4)}"
        low = rng.randrange(3) if op == "trim" else None
        high = low + rng.randrange(-1, 9) if op == "trim" else None
        item = None if op == "insert" and rng.random() < 0.1 else f"v{rng.randrange(8)}"
        log.append((seq, key, item, op, NOW + timedelta(seconds=seq) if op == "expire" else None, low, high))
    return log


@pytest.mark.parametrize("fold_rows,width", [(1000, 1 << 20), (40, 1 << 20), (0, 7)])
@pytest.mark.parametrize("trims", [0, 1])
def test_lists_equal_replay(frame, trims, fold_rows, width):
    """In one row, in rounds, and with both at once."""
    rng = random.Random(fold_rows + trims)
    start = [(i, rng.choice(["hot", "k1", "only"]), rng.choice([None, "v1", "v2"]), rng.choice([None, NOW])) for i in range(30)]
    log = list_log(rng, 160, trims)
    after = lists.apply_list(frame(start, LIST), frame(log, LISTED), BASE, fold_rows, width)
    assert sorted(str(list(r)) for r in after.collect()) == replay_list(start, log)


def test_trim_to_a_negative_length_is_an_error(frame):
    with pytest.raises(ValueError):
        lists.apply_list(frame([], LIST), frame([(1, "k", None, "trim", None, 3, 1)], LISTED))


def replay_servers(start, log):
    rows, rejects = dict(start), []
    for seq, ts, i, op, data in log:
        if op == "announce":
            rows[i] = (data, ts)
        elif op == "remove":
            rows.pop(i, None)
        elif i in rows:
            rows[i] = (rows[i][0], ts)
        else:
            rejects.append(seq)
    return rows, rejects


def test_servers_equal_replay(frame):
    rng = random.Random(3)
    start = {f"s{i}": ("{}", NOW) for i in range(5)}
    log = [(seq, NOW + timedelta(seconds=seq), f"s{rng.randrange(9)}", rng.choices(["announce", "heartbeat", "remove"], [1, 6, 2])[0], f"d{seq}") for seq in range(120)]
    after, rejects = apply.apply_servers(frame([(i, *v) for i, v in start.items()], SERVER), frame(log, SERVED))
    want, want_rejects = replay_servers(start, log)
    assert {r.id: (r.data, r.lastheartbeat) for r in after.collect()} == want
    assert sorted(r.seq for r in rejects.collect()) == want_rejects


def test_second_announcement_wins(frame):
    log = frame([(1, NOW, "s", "announce", "a"), (2, NOW, "s", "announce", "b")], SERVED)
    after, _ = apply.apply_servers(frame([], SERVER), log)
    assert [(r.id, r.data) for r in after.collect()] == [("s", "b")]
