import time
from datetime import datetime, timedelta

import pytest
from conftest import tuples

from ledgerline.operators.maintain import counter_rollup
from ledgerline.streaming import runs, timelines, timers

NOW = datetime(2024, 5, 1, 12)
COUNTER = "id LONG, key STRING, value LONG, expireat TIMESTAMP"


@pytest.fixture
def stream(spark, frame, tmp_path):
    """Batches of rows as a stream that takes one file per micro-batch, in order."""

    def make(batches, schema):
        folder = tmp_path / "in"
        for n, batch in enumerate(batches):
            frame(batch, schema).coalesce(1).write.parquet(str(folder / f"part={n}"))
        shape = spark.read.parquet(str(folder / "part=0")).schema
        files = spark.readStream.schema(shape).option("maxFilesPerTrigger", 1)
        return files.option("recursiveFileLookup", True).parquet(str(folder))

    return make


@pytest.fixture
def emitted(spark, tmp_path):
    def run(results):
        out = str(tmp_path / "out")
        query = runs.to_files(results, out, str(tmp_path / "checkpoint"), available_now=True)
        query.awaitTermination()
        return spark.read.schema(results.schema).parquet(out), query

    return run


def at(minutes):
    return NOW + timedelta(minutes=minutes)


def test_rollup_equals_batch_and_survives_replay(spark, frame, stream, tmp_path):
    batches = [[(10 * b + i, f"k{i % 3}", i, at(b) if i % 2 else None) for i in range(6)] for b in range(3)]
    start = frame([(1000, "k0", 5, NOW)], COUNTER)
    deltas = stream(batches, COUNTER)
    tiers = runs.counter_tiers(spark, str(tmp_path / "tiers"), fan=2)

    def run(checkpoint):
        runs.rollup_stream(deltas, tiers, str(tmp_path / checkpoint), available_now=True).awaitTermination()
        return sorted(tuples(runs.rolled_counters(start, tiers, 500)))

    want = start
    for batch in batches:
        want, _ = counter_rollup(frame(batch, COUNTER), want, 500)
    assert run("first") == sorted(tuples(want))
    # The same batches again, as after a lost checkpoint, overwrite themselves.
    assert run("second") == sorted(tuples(want))


def test_batches_lie_in_few_folders(spark, frame, tmp_path):
    """Any number of batches is covered by a logarithmic number of folders, at any moment and after a replay."""
    tiers = runs.state_tiers(spark, str(tmp_path / "tiers"), fan=3)
    assert tiers.folders() == [] and tuples(tiers.read()) == []
    latest = {}
    for n in range(20):
        rows = [(j, 10 * n + j, f"s{n}") for j in range(10) if (n + j) % 4 == 0]
        latest |= {j: (j, seq, name) for j, seq, name in rows}
        batch = frame(rows, "jobid LONG, seq LONG, name STRING").coalesce(1)
        tiers.add(batch, n)
        if n in (8, 12):
            tiers.add(batch, n)
        digits, left = 0, n + 1
        while left:
            left, digit = divmod(left, 3)
            digits += digit
        assert len(tiers.folders()) == digits
        if n in (0, 7, 8, 9, 13, 19):
            assert sorted(tuples(tiers.read())) == sorted(latest.values())
    kept = {p.name for p in (tmp_path / "tiers").iterdir()}
    assert "2-8" in kept and "1-8" in kept and "0-8" not in kept


def test_an_unfinished_folder_is_not_read(spark, frame, tmp_path):
    tiers = runs.state_tiers(spark, str(tmp_path / "tiers"), fan=2)
    for n in range(2):
        tiers.add(frame([(n, n, "s")], "jobid LONG, seq LONG, name STRING"), n)
    assert [f.rsplit("/", 1)[1] for f in tiers.folders()] == ["1-1"]
    (tmp_path / "tiers" / "1-1" / "_SUCCESS").unlink()  # as if the merge had died
    assert [f.rsplit("/", 1)[1] for f in tiers.folders()] == ["0-0", "0-1"]


def test_a_micro_batch_writes_its_own_keys_only(spark, frame, stream, tmp_path):
    """What a batch writes does not depend on how many keys came before."""
    batches = [[(i, f"k{i}", 1, None) for i in range(5000)], [(6000, "k1", 1, None)], [(6001, "new", 1, None)]]
    tiers = runs.counter_tiers(spark, str(tmp_path / "tiers"))
    runs.rollup_stream(stream(batches, COUNTER), tiers, str(tmp_path / "checkpoint"), available_now=True).awaitTermination()
    sizes = [spark.read.parquet(str(tmp_path / "tiers" / f"0-{n}")).count() for n in range(3)]
    assert sizes == [5000, 1, 1]


def test_timeline_drops_and_counts_late_rows(spark, stream, emitted):
    late = timelines.LateRows()
    spark.streams.addListener(late)
    batches = [
        [(at(0), "succeeded", 1), (at(59), "succeeded", 1), (at(61), "failed", 1)],
        [(at(200), "succeeded", 1)],
        [(at(201), "succeeded", 1)],
        # Too late by now: lateness is judged by the watermark of the batch before.
        [(at(5), "succeeded", 100)],
    ]
    results, query = emitted(timelines.timeline_stream(stream(batches, "ts TIMESTAMP, kind STRING, delta LONG")))
    assert sorted(tuples(results)) == [
        ("failed", at(60), "stats:failed:2024-05-01-13", 1),
        ("succeeded", at(0), "stats:succeeded:2024-05-01-12", 2),
    ]
    for _ in range(100):  # progress is reported from another thread
        if late.dropped.get(str(query.id)):
            break
        time.sleep(0.1)
    spark.streams.removeListener(late)
    assert late.dropped[str(query.id)] == 1


def test_silence_is_reported_once_per_gap(stream, emitted):
    batches = [[(at(0), "a"), (at(20), "a"), (at(0), "b")], [(at(40), "a"), (at(60), "b")], [(at(500), "c")]]
    results, _ = emitted(timelines.liveness_stream(stream(batches, "ts TIMESTAMP, server STRING"), timedelta(minutes=30)))
    assert sorted(tuples(results)) == [("a", at(40), at(70)), ("b", at(0), at(30)), ("b", at(60), at(90))]


def test_job_states_follow_the_log_across_batches(spark, stream, tmp_path):
    batches = [[(1, 7, "A"), (3, 7, "C"), (2, 8, "B")], [(5, 8, "E"), (4, 7, "D")], [(0, 9, "Z"), (2, 7, "late")]]
    changes = runs.state_changes(stream(batches, "seq LONG, jobid LONG, name STRING"))
    tiers = runs.state_tiers(spark, str(tmp_path / "tiers"))
    runs.to_tiers(changes, tiers, str(tmp_path / "checkpoint"), "update", available_now=True).awaitTermination()
    assert sorted(tuples(runs.current_states(tiers))) == [(7, 4, "D"), (8, 5, "E"), (9, 0, "Z")]


LEASE = "seq LONG, id LONG, ts TIMESTAMP, op STRING"


def test_lease_runs_out_unless_kept_alive_or_ended(stream, emitted):
    batches = [
        [(1, 1, at(0), "fetch"), (2, 2, at(0), "fetch"), (3, 3, at(0), "fetch"), (4, 4, at(0), "fetch"), (5, 5, at(0), "keep_alive")],
        [(7, 2, at(20), "keep_alive"), (8, 3, at(10), "ack"), (9, 4, at(10), "requeue"), (10, 4, at(25), "fetch")],
        [(20, 99, at(115), "keep_alive")],
        [(21, 1, at(116), "keep_alive")],
        [(30, 99, at(400), "keep_alive")],
    ]
    results, _ = emitted(timers.lease_stream(stream(batches, LEASE), timedelta(minutes=30)))
    # Row 1 runs out, is kept alive late by its holder, and runs out again.
    assert sorted(tuples(results)) == [
        (1, at(0), at(30)), (1, at(116), at(146)), (2, at(20), at(50)), (4, at(25), at(55)),
    ]


@pytest.mark.parametrize("cuts", [1, 2, 12])
def test_leases_do_not_depend_on_batches(stream, emitted, cuts):
    log = [
        (1, 1, at(0), "fetch"), (2, 2, at(1), "fetch"), (3, 1, at(20), "keep_alive"), (4, 2, at(25), "ack"), (5, 2, at(30), "fetch"),
        (6, 1, at(90), "keep_alive"), (7, 3, at(91), "requeue"), (8, 3, at(92), "fetch"), (9, 1, at(200), "requeue"), (10, 1, at(210), "fetch"),
        (11, 3, at(310), "fetch"), (12, 99, at(900), "keep_alive"),
    ]
    size = -(-len(log) // cuts)
    results, _ = emitted(timers.lease_stream(stream([log[i : i + size] for i in range(0, len(log), size)], LEASE), timedelta(minutes=30)))
    assert sorted(tuples(results)) == [
        (1, at(20), at(50)), (1, at(90), at(120)), (1, at(210), at(240)), (3, at(92), at(122)), (3, at(310), at(340)),
    ]


@pytest.mark.parametrize("cuts", [1, 2, 5])
def test_key_expiries_do_not_depend_on_batches(stream, emitted, cuts):
    log = [(1, at(0), "a", at(10)), (2, at(5), "b", at(50)), (3, at(20), "a", at(60)), (4, at(40), "b", None), (5, at(70), "a", at(80)), (6, at(900), "z", None)]
    size = -(-len(log) // cuts)
    schema = "seq LONG, ts TIMESTAMP, key STRING, expire_at TIMESTAMP"
    results, _ = emitted(timers.key_expiry_stream(stream([log[i : i + size] for i in range(0, len(log), size)], schema)))
    assert sorted(tuples(results)) == [("a", at(10)), ("a", at(60)), ("a", at(80))]


def test_entries_swapped_between_batches(stream, emitted):
    """Within the delay the order of arrival does not matter: a keep-alive before its fetch."""
    batches = [[(2, 1, at(20), "keep_alive"), (3, 2, at(30), "fetch")], [(1, 1, at(0), "fetch"), (4, 2, at(45), "ack")], [(9, 99, at(400), "keep_alive")], [(10, 99, at(401), "keep_alive")]]
    results, _ = emitted(timers.lease_stream(stream(batches, LEASE), timedelta(minutes=30)))
    assert sorted(tuples(results)) == [(1, at(20), at(50))]


def test_expire_after_its_persist(stream, emitted):
    """The expiry that passed before the persist is emitted though its command arrives later."""
    schema = "seq LONG, ts TIMESTAMP, key STRING, expire_at TIMESTAMP"
    batches = [[(2, at(30), "a", None)], [(1, at(0), "a", at(10))], [(9, at(400), "z", None)], [(10, at(401), "z", None)]]
    results, _ = emitted(timers.key_expiry_stream(stream(batches, schema)))
    assert sorted(tuples(results)) == [("a", at(10))]


def test_rows_expire_once_their_time_has_come(stream, emitted):
    batches = [[(at(0), 1, at(30)), (at(0), 2, None), (at(0), 3, at(900)), (at(0), 4, at(-10))], [(at(200), 5, at(201))]]
    results, _ = emitted(timelines.row_expiry_stream(stream(batches, "ts TIMESTAMP, id LONG, expireat TIMESTAMP")))
    assert sorted(tuples(results)) == [(1, at(30)), (4, at(-10))]


def test_latest_expiry_of_a_key_counts(stream, emitted):
    schema = "seq LONG, ts TIMESTAMP, key STRING, expire_at TIMESTAMP"
    batches = [
        [(1, at(0), "a", at(30)), (2, at(0), "b", at(30)), (3, at(0), "c", at(900)), (4, at(0), "d", at(30))],
        [(5, at(5), "b", None), (6, at(5), "c", at(40)), (7, at(6), "d", at(600)), (0, at(6), "a", at(800))],
        [(9, at(300), "z", None)],
    ]
    results, _ = emitted(timers.key_expiry_stream(stream(batches, schema)))
    assert sorted(tuples(results)) == [("a", at(30)), ("c", at(40))]


def test_new_work_is_announced_per_queue(spark, stream, tmp_path):
    batches = [[(1, 7, "a"), (2, 8, "a")], [(3, 9, "b")]]
    out = str(tmp_path / "out")
    enqueues = stream(batches, "seq LONG, jobid LONG, queue STRING")
    runs.to_batches(enqueues, out, str(tmp_path / "checkpoint"), available_now=True, shape=runs.new_work).awaitTermination()
    assert sorted(tuples(spark.read.parquet(out).select("queue", "enqueued", "last_seq"))) == [("a", 2, 2), ("b", 1, 3)]
