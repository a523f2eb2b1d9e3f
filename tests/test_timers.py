"""Waiting entries in chunks of state, and streams that start from a queue or forget."""

import random
from datetime import timedelta

import pytest
from conftest import tuples
from test_streaming import LEASE, at, emitted, stream  # noqa: F401

from ledgerline.streaming import timers

HALF_HOUR = timedelta(minutes=30)


class Chunks:
    """A map state that counts what is read."""

    def __init__(self):
        self.kept, self.read = {}, 0

    def updateValue(self, key, value):
        self.kept[key] = value

    def getValue(self, key):
        self.read += len(self.kept[key][0]) // 24
        return self.kept[key]

    def removeKey(self, key):
        del self.kept[key]


def plain_ready(waiting, now):
    """What may be settled: in the order of seq as long as times have passed."""
    waiting.sort()
    count = 0
    while count < len(waiting) and timers._millis_after(waiting[count][1]) <= now:
        count += 1
    out, waiting[:] = waiting[:count], waiting[count:]
    return out


@pytest.mark.parametrize("seed", range(6))
def test_chunks_settle_like_one_list(monkeypatch, seed):
    monkeypatch.setattr(timers, "CHUNK_ENTRIES", 5)
    rng = random.Random(seed)
    chunks, packed, plain, now = Chunks(), None, [], 0
    seqs = rng.sample(range(10_000), 400)
    for call in range(200):
        new = [(seqs.pop(), now * 1000 + rng.randrange(-20_000, 60_000), rng.randrange(5)) for _ in range(rng.randrange(3))]
        now += rng.randrange(20)
        waiting = timers.Waiting(chunks, packed)
        waiting.add(new)
        plain += new
        assert waiting.ready(now) == plain_ready(plain, now)
        assert waiting.next_time() == (plain[0][1] if plain else None)
        assert waiting.earliest() == min((e[1] for e in plain), default=None)
        assert sum(line[0] for line in waiting.lines.values()) == len(plain)
        packed = bytes(waiting.packed())
    assert len(chunks.kept) == len(waiting.lines)


def test_a_busy_key_is_read_in_linear_time():
    """A million entries within the delay, settled over 200 calls: each is read a few times, not once per call."""
    n, calls = 1_000_000, 200
    chunks = Chunks()
    waiting = timers.Waiting(chunks, None)
    waiting.add([(i, 1000 * i, 1) for i in range(n)])
    done = 0
    for call in range(1, calls + 1):
        waiting = timers.Waiting(chunks, bytes(waiting.packed()))
        done += len(waiting.ready(n * call // calls))
    assert done == n and not waiting.lines and not chunks.kept and chunks.read < 1.5 * n


def test_entries_behind_a_late_one_are_not_read_again():
    """One entry with a small seq and a late time holds up all others; they are looked at when its time has passed."""
    chunks = Chunks()
    waiting = timers.Waiting(chunks, None)
    waiting.add([(0, 10_000_000, 1)] + [(i, 1000 * i, 1) for i in range(1, 5001)])
    for now in range(1, 5000, 50):
        assert waiting.ready(now) == []
    assert chunks.read < 20_000 and waiting.next_time() == 10_000_000
    assert [e[0] for e in waiting.ready(10_001)] == list(range(5001))


def test_leases_of_the_queue_run_already(spark, frame, stream, emitted):  # noqa: F811
    queue = frame([(1, at(-10)), (2, at(-10)), (3, None), (4, at(-10)), (5, at(-10)), (6, None)], "id LONG, fetchedat TIMESTAMP")
    batches = [
        [(1, 1, at(5), "keep_alive"), (2, 2, at(6), "ack"), (3, 3, at(7), "fetch"), (4, 77, at(8), "fetch"), (5, 5, at(9), "requeue"), (6, 6, at(9), "keep_alive")],
        [(7, 2, at(100), "fetch"), (8, 5, at(101), "fetch"), (9, 4, at(102), "keep_alive")],
        [(10, 3, at(400), "ack")],
        [(11, 3, at(401), "keep_alive")],
    ]
    results, _ = emitted(timers.lease_stream(stream(batches, LEASE), HALF_HOUR, queue=queue))
    # 2 was acknowledged, 77 is not in the queue; 4 ran out and was kept alive by its holder later.
    assert sorted(tuples(results)) == [
        (1, at(5), at(35)), (3, at(7), at(37)), (4, at(-10), at(20)), (4, at(102), at(132)), (5, at(101), at(131)),
    ]


def test_acknowledged_rows_are_forgotten_after_the_horizon(spark, stream, emitted):  # noqa: F811
    batches = [
        [(2 * i + k, i, at(i + k), "ack" if k else "fetch") for i in range(40) for k in range(2)],
        [(1000, 99, at(500), "keep_alive")],
        [(1001, 99, at(501), "keep_alive")],
        [(1002, 99, at(10_000), "keep_alive")],
        [(1003, 99, at(10_001), "keep_alive")],
    ]
    results, query = emitted(timers.lease_stream(stream(batches, LEASE), HALF_HOUR, horizon=timedelta(days=1)))
    assert tuples(results) == []
    kept = [p["stateOperators"][0]["customMetrics"] for p in query.recentProgress if p["stateOperators"]]
    rows = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    # All keys are remembered after the acknowledgements were settled, none once the horizon has passed.
    assert max(rows) >= 40 and rows[-1] < 10, (rows, kept[-1])


def test_a_lease_ends_by_the_next_entry_of_the_log(spark, stream, emitted):  # noqa: F811
    """The next entry by seq lies beyond the watermark; an earlier time behind it does not hold the expiry back."""
    batches = [[(1, 1, at(0), "fetch"), (2, 1, at(200), "requeue"), (3, 1, at(10), "keep_alive")]]
    results, _ = emitted(timers.lease_stream(stream(batches, LEASE), HALF_HOUR))
    assert tuples(results) == [(1, at(0), at(30))]
