import random
from datetime import datetime, timedelta

import pytest
from conftest import tuples
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerline.operators import leases, queues
from ledgerline.sources.schemas import union_sources

NOW = datetime(2024, 5, 1, 12)
HALF_HOUR = timedelta(minutes=30)
QUEUE = "id LONG, jobid LONG, queue STRING, fetchedat TIMESTAMP, updatecount INT"
JOB = "id LONG, stateid LONG, statename STRING, invocationdata STRING, arguments STRING, createdat TIMESTAMP, expireat TIMESTAMP"
STATE = "id LONG, jobid LONG, name STRING, reason STRING, createdat TIMESTAMP, data STRING"


def job(i):
    return (i, None, "Enqueued", "{}", "[]", NOW, None)


def test_fetched_job_appears_once_with_its_latest_lease(frame):
    rows = frame([(1, 7, "default", NOW, 0), (2, 7, "default", NOW + timedelta(seconds=1), 0), (3, 7, "other", NOW + timedelta(seconds=9), 0)], QUEUE)
    page = queues.fetched_jobs(rows, frame([job(7)], JOB), "default", 0, 10).collect()
    assert [(r.job_id, r.fetched_at) for r in page] == [(7, NOW + timedelta(seconds=9))]


def test_counts_include_orphans_and_pages_do_not(frame):
    rows = frame([(1, 7, "q", None, 0), (2, 7, "q", None, 0), (3, 404, "q", None, 0), (4, 8, "q", NOW, 0)], QUEUE)
    jobs = frame([job(7), job(8)], JOB)
    assert tuples(queues.queue_counts(rows)) == [("q", 3, 1)]
    assert sorted(tuples(queues.queue_counts(rows, ["q", "absent"]))) == [("absent", 0, 0), ("q", 3, 1)]
    assert tuples(queues.enqueued_job_ids(rows, jobs, "q", 0, 10)) == [(7,)]
    assert tuples(queues.fetched_job_ids(rows, jobs, "q", 0, 10)) == [(8,)]


def test_overview_keeps_queues_with_nothing_waiting(frame):
    rows = frame([(i, i, "a", None, 0) for i in range(1, 9)] + [(20, 20, "b", NOW, 0)], QUEUE)
    jobs = frame([job(i) for i in range(1, 9)] + [job(20)], JOB)
    found = queues.queue_overview(rows, jobs, frame([], STATE)).collect()
    assert sorted((r.queue, r.enqueued, r.fetched, r.job_id or 0) for r in found) == [("a", 8, 0, i) for i in range(1, 6)] + [("b", 0, 1, 0)]


def test_old_lease_is_delivered_again(frame):
    rows = frame([(1, 1, "default", NOW - timedelta(days=1), 0), (2, 2, "default", NOW - timedelta(minutes=30), 0)], QUEUE)
    assert [r.id for r in queues.claimable(rows, ["default"], HALF_HOUR, NOW).collect()] == [1]


def test_only_the_claimed_row_is_stamped(frame):
    rows = frame([(1, 1, "default", None, 4), (2, 2, "default", None, 0)], QUEUE)
    claims = queues.claim_batch(rows, ["default"], HALF_HOUR, NOW, 1)
    after = {r.id: (r.fetchedat, r.updatecount) for r in queues.apply_claims(rows, claims).collect()}
    assert after == {1: (NOW, 5), 2: (None, 0)}


def test_claims_go_by_queue_name_then_old_leases(frame):
    old = NOW - timedelta(days=1)
    rows = frame([(1, 9, "1", old, 0), (2, 3, "3", None, 0), (3, 2, "2", None, 0), (4, 1, "1", None, 0)], QUEUE)
    claims = queues.claim_batch(rows, ["3", "1", "2"], HALF_HOUR, NOW, 9).orderBy("slot")
    assert [r.jobid for r in claims.collect()] == [1, 2, 3, 9]


def test_claims_per_queue(frame):
    rows = frame([(i, i, "a" if i % 2 else "b", None, 0) for i in range(10)], QUEUE)
    claims = queues.claim_per_queue(rows, ["a", "b"], HALF_HOUR, NOW, 2).collect()
    assert sorted((r.queue, r.slot, r.jobid) for r in claims) == [("a", 1, 1), ("a", 2, 3), ("b", 1, 0), ("b", 2, 2)]


def test_update_count_wraps(frame):
    rows = frame([(1, 1, "q", None, 1_999_999_999)], QUEUE)
    assert queues.claim_batch(rows, ["q"], HALF_HOUR, NOW, 1).first().updatecount == 0


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("abc"), st.none() | st.integers(0, 60)), max_size=25), st.integers(1, 10))
def test_claims_take_the_first_free_rows_only(frame, waiting, workers):
    rows = [(i, i, q, None if age is None else NOW - timedelta(minutes=age), 0) for i, (q, age) in enumerate(waiting)]
    free = [r for r in rows if r[2] != "c" and (r[3] is None or NOW - r[3] > HALF_HOUR)]
    free.sort(key=lambda r: (r[3] is not None, r[3] or NOW, r[2], r[1]))
    claims = queues.claim_batch(frame(rows, QUEUE), ["b", "a"], HALF_HOUR, NOW, workers).orderBy("slot")
    assert [r.id for r in claims.collect()] == [r[0] for r in free[:workers]]


def test_claim_arguments(frame):
    rows = frame([], QUEUE)
    with pytest.raises(ValueError):
        queues.claimable(rows, [], HALF_HOUR, NOW)
    with pytest.raises(ValueError):
        queues.claim_batch(rows, ["q"], HALF_HOUR, NOW, 0)


TOKEN = "id LONG, token TIMESTAMP, ts TIMESTAMP"


def leased(frame):
    return frame([(1, 1, "q", NOW, 0), (2, 2, "q", NOW, 0), (3, 3, "q", None, 0)], QUEUE)


def test_ack_needs_the_current_token(frame):
    stale = NOW - timedelta(seconds=1)
    acks = frame([(1, NOW, NOW), (2, stale, NOW), (3, None, NOW), (999, NOW, NOW)], TOKEN)
    assert sorted(r.id for r in queues.apply_acks(leased(frame), acks).collect()) == [2, 3]


def test_requeue_needs_the_current_token(frame):
    after = queues.apply_requeues(leased(frame), frame([(1, NOW, NOW), (2, NOW - timedelta(seconds=1), NOW)], TOKEN))
    assert {r.id: r.fetchedat for r in after.collect()} == {1: None, 2: NOW, 3: None}


def test_keep_alive_slides_the_lease_once_per_token(frame):
    first, second = NOW + timedelta(minutes=5), NOW + timedelta(minutes=10)
    beats = frame([(1, NOW, second), (1, NOW, first), (2, NOW - timedelta(seconds=1), first)], TOKEN)
    assert {r.id: r.fetchedat for r in queues.apply_keep_alives(leased(frame), beats).collect()} == {1: first, 2: NOW, 3: None}


def test_keep_alive_is_due_after_a_fifth_of_the_timeout(frame):
    rows = frame([(1, 1, "q", NOW - timedelta(minutes=6), 0), (2, 2, "q", NOW - timedelta(minutes=5), 0), (3, 3, "q", None, 0)], QUEUE)
    assert [(r.id, r.idle_seconds) for r in queues.lease_due(rows, HALF_HOUR, NOW).collect()] == [(1, 360.0)]


def test_long_queue_names_and_sources_stay_apart(frame):
    name = "a-queue-name-of-more-than-twenty-characters"
    rows = frame([(1, 1, name, None, 0)], QUEUE)
    assert sorted(tuples(queues.queues_of_sources(union_sources([("x", rows), ("y", rows)])))) == [("x", name), ("y", name)]


def replay(rows, log):
    """Sequential meaning of a lease log."""
    queue = {r[0]: r[3] for r in rows}
    for _, i, ts, op in sorted(log):
        if i not in queue:
            continue
        if op == "fetch":
            queue[i] = ts
        elif queue[i] is not None:
            if op == "ack":
                del queue[i]
            else:
                queue[i] = ts if op == "keep_alive" else None
    return queue


@pytest.mark.parametrize("width", [3, 1 << 20])
def test_lease_fold_equals_replay(frame, width):
    rng = random.Random(5)
    rows = [(i, i, "q", rng.choice([None, NOW]), 0) for i in range(60)]
    log = []
    for seq in range(500):
        i = 1 if rng.random() < 0.3 else rng.randrange(70)
        op = rng.choices(["fetch", "keep_alive", "requeue", "ack"], [5, 5, 3, 1])[0]
        log.append((seq, i, NOW + timedelta(seconds=seq), op))
    folded = leases.lease_fold(frame(rows, QUEUE), frame(log, "seq LONG, id LONG, ts TIMESTAMP, op STRING"), width)
    assert {r.id: r.fetchedat for r in folded.collect()} == replay(rows, log)
