from datetime import datetime, timedelta

import pytest
from conftest import tuples
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerline.operators import maintain

NOW = datetime(2024, 5, 1, 12)
COUNTER = "id LONG, key STRING, value LONG, expireat TIMESTAMP"
JOB = "id LONG, expireat TIMESTAMP"
SERVER = "id STRING, data STRING, lastheartbeat TIMESTAMP"


def test_rollup_sums_deltas(frame):
    deltas = frame([(i, k, v, None) for i, (k, v) in enumerate([("key", 1), ("key", 5), ("key", 15), ("key2", 5), ("key2", 10)])], COUNTER)
    rolled, rest = maintain.counter_rollup(deltas, frame([], COUNTER))
    assert {r.key: r.value for r in rolled.collect()} == {"key": 21, "key2": 15}
    assert rest.count() == 0


def test_rollup_replaces_expiry_even_by_null(frame):
    old = frame([(1, "a", 1, NOW), (2, "b", 1, NOW), (3, "c", 1, NOW)], COUNTER)
    later = NOW + timedelta(days=1)
    deltas = frame([(4, "a", 1, None), (5, "b", 1, None), (6, "b", 1, later)], COUNTER)
    rolled, _ = maintain.counter_rollup(deltas, old)
    assert {r.key: (r.id, r.value, r.expireat) for r in rolled.collect()} == {
        "a": (1, 2, None),
        "b": (2, 3, later),
        "c": (3, 1, NOW),
    }


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.sampled_from("abc"), st.integers(-5, 5)), max_size=20),
    st.dictionaries(st.sampled_from("abcd"), st.integers(-5, 5)),
)
def test_rollup_keeps_totals(frame, deltas, old):
    pending = frame([(i, k, v, None) for i, (k, v) in enumerate(deltas)], COUNTER)
    rolled, _ = maintain.counter_rollup(pending, frame([(i, k, v, None) for i, (k, v) in enumerate(old.items())], COUNTER))
    want = dict(old)
    for key, value in deltas:
        want[key] = want.get(key, 0) + value
    assert {r.key: r.value for r in rolled.collect()} == want


def test_compaction(frame):
    rows = [(i, "stats:succeeded", 1, None) for i in range(5)]
    rows += [(10, "stats:deleted", 1, None), (11, "stats:deleted", -1, None)]
    rows += [(20, "stats:succeeded", 7, NOW), (21, "other", 1, None), (22, "other", 1, None)]
    kept = sorted(tuples(maintain.counter_compaction(frame(rows, COUNTER))))
    assert kept == [(0, "stats:succeeded", 5, None), (20, "stats:succeeded", 7, NOW), (21, "other", 1, None), (22, "other", 1, None)]


def test_purge_is_strict_and_idempotent(frame):
    rows = frame([(1, NOW - timedelta(seconds=1)), (2, NOW), (3, None), (4, NOW + timedelta(days=30))], JOB)
    once = maintain.purge(rows, NOW)
    assert sorted(r.id for r in once.collect()) == [2, 3, 4]
    assert maintain.purge(once, NOW).count() == 3
    assert [r.id for r in maintain.expired(rows, NOW).collect()] == [1]


def test_cascade_follows_purged_jobs_but_not_the_queue(frame):
    jobs = frame([(1, NOW - timedelta(days=1)), (2, None)], JOB)
    states = frame([(10, 1), (11, 2)], "id LONG, jobid LONG")
    assert [r.id for r in maintain.purge_cascade(states, jobs, NOW).collect()] == [11]
    rows = frame([(5, 1), (6, 2)], "id LONG, jobid LONG")
    orphans = maintain.orphan_queue_rows(rows, maintain.purge(jobs, NOW))
    assert [r.id for r in orphans.collect()] == [5]


def test_summary_counts_per_table(frame):
    rows = frame([(1, NOW - timedelta(days=1)), (2, None)], JOB)
    assert tuples(maintain.purge_summary({"job": rows}, {"job": NOW})) == [("job", 1, 1)]


def test_silent_workers_go(frame):
    rows = frame([("s1", "{}", NOW - timedelta(days=1)), ("s2", "{}", NOW - timedelta(hours=12))], SERVER)
    assert [r.id for r in maintain.live_servers(rows, timedelta(hours=15), NOW).collect()] == ["s2"]
    assert maintain.live_servers(rows, timedelta(days=1), NOW).count() == 2
    with pytest.raises(ValueError):
        maintain.live_servers(rows, timedelta(seconds=-1), NOW)
