from datetime import datetime, timedelta

from conftest import tuples

from ledgerline.operators import monitor

NOW = datetime(2024, 5, 1, 12, 34, 56)
JOB = "id LONG, stateid LONG, statename STRING, invocationdata STRING, arguments STRING, createdat TIMESTAMP, expireat TIMESTAMP"
STATE = "id LONG, jobid LONG, name STRING, reason STRING, createdat TIMESTAMP, data STRING"
PARAMETER = "id LONG, jobid LONG, name STRING, value STRING"
COUNTER = "id LONG, key STRING, value LONG, expireat TIMESTAMP"


def job(i, stateid=None, name=None):
    return (i, stateid, name, '{"Type":"T"}', '["\\"a\\""]', NOW, None)


def state(i, jobid, name, data):
    return (i, jobid, name, "why", NOW, data)


def test_succeeded_reads_keys_ignoring_case(frame):
    data = '{"SUCCEEDEDAT":"2018-05-03T13:28:18.3939693Z","PerformanceDuration":"53","latency":"6730"}'
    row = monitor.succeeded_jobs(frame([job(1, 5, "Succeeded")], JOB), frame([state(5, 1, "Succeeded", data)], STATE), 0, 10).first()
    assert row.total_duration == 6783
    assert row.succeeded_at == datetime(2018, 5, 3, 13, 28, 18, 393969)


def test_duration_needs_both_parts(frame):
    states = [state(5, 1, "Succeeded", '{"PerformanceDuration":"53"}'), state(6, 2, "Succeeded", '{"PerformanceDuration":"x","Latency":"1"}')]
    jobs = frame([job(1, 5, "Succeeded"), job(2, 6, "Succeeded")], JOB)
    assert [r.total_duration for r in monitor.succeeded_jobs(jobs, frame(states, STATE), 0, 10).collect()] == [None, None]


def test_present_null_server_id_wins(frame):
    states = [
        state(5, 1, "Processing", '{"ServerId":null,"ServerName":"n"}'),
        state(6, 2, "Processing", '{"ServerName":"n","StartedAt":"2024-01-01T02:00:00+02:00"}'),
    ]
    jobs = frame([job(1, 5, "Processing"), job(2, 6, "Processing")], JOB)
    rows = {r.job_id: r for r in monitor.processing_jobs(jobs, frame(states, STATE), 0, 10).collect()}
    assert rows[1].server_id is None and rows[2].server_id == "n"
    assert rows[2].started_at == datetime(2024, 1, 1)


def test_page_is_newest_first_and_keeps_jobs_without_state_row(frame):
    jobs = frame([job(i, 100 + i, "Failed") for i in range(1, 8)] + [job(9, None, None)], JOB)
    rows = monitor.failed_jobs(jobs, frame([state(106, 6, "Failed", '{"ExceptionType":"E"}')], STATE), 1, 3).collect()
    assert [(r.job_id, r.exception_type) for r in rows] == [(6, "E"), (5, None), (4, None)]


def test_page_of_every_state(frame):
    jobs = frame([job(i, None, "A" if i % 2 else "B") for i in range(10)] + [job(50)], JOB)
    rows = monitor.jobs_page_per_state(jobs, frame([], STATE), 1, 2).collect()
    assert sorted((r.statename, r.position, r.job_id) for r in rows) == [("A", 1, 7), ("A", 2, 5), ("B", 1, 6), ("B", 2, 4)]


def test_counts_are_zero_filled_and_skip_jobs_without_state(frame):
    counts = dict(tuples(monitor.jobs_by_state(frame([job(1, 1, "Failed"), job(2), job(3, 1, "Custom")], JOB))))
    assert counts["Failed"] == 1 and counts["Deleted"] == 0 and counts["Custom"] == 1 and len(counts) == 7


def test_current_state_is_the_one_pointed_at(frame):
    states = frame([state(5, 1, "old", "{}"), state(6, 1, "Name", '{"K":"V"}')], STATE)
    assert tuples(monitor.state_data(frame([job(1, 6, "Name"), job(2)], JOB), states)) == [(1, "Name", "why", '{"K":"V"}')]


def test_details(frame):
    states = frame([state(5, 1, "a", "{}"), state(6, 1, "b", "{}"), state(7, 2, "c", "{}")], STATE)
    parameters = frame([(1, 1, "P", "old"), (2, 1, "P", "new"), (3, 2, "P", "x")], PARAMETER)
    rows = monitor.job_details(frame([job(1, 6, "b"), job(2, 7, "c")], JOB), parameters, states, [1, 404]).collect()
    facts = sorted((r.section, r.state_id or 0, r.name, r.value) for r in rows)
    assert facts == [("job", 0, "b", '{"Type":"T"}'), ("parameter", 0, "P", "new"), ("state", 5, "a", "{}"), ("state", 6, "b", "{}")]


def test_invocation_is_decoded(frame):
    row = monitor.job_data(frame([job(1)], JOB)).first()
    assert row.invocation == {"Type": "T"} and row.arguments == ['"a"']


def test_parameters_as_columns(frame):
    parameters = frame([(1, 1, "P", "old"), (2, 1, "P", None), (3, 1, "Q", "q")], PARAMETER)
    assert tuples(monitor.job_parameters(parameters, ["P", "Q"])) == [(1, None, "q")]


def test_hourly_timeline_adds_both_tables(frame):
    key = f"stats:succeeded:{NOW:%Y-%m-%d-%H}"
    points = monitor.hourly_timeline(frame([(1, key, 5, None)], COUNTER), frame([(1, key, 7, None)], COUNTER), NOW, ("succeeded",))
    rows = points.collect()
    assert len(rows) == 24 and sum(r.n for r in rows) == 12
    assert [r.at for r in rows if r.n] == [NOW]


def test_daily_timeline_starts_today(frame):
    key = f"stats:failed:{NOW - timedelta(days=6):%Y-%m-%d}"
    gone = f"stats:failed:{NOW - timedelta(days=7):%Y-%m-%d}"
    rows = monitor.daily_timeline(frame([(1, key, 5, None), (2, gone, 9, None)], COUNTER), frame([], COUNTER), NOW).collect()
    assert len(rows) == 14 and sum(r.n for r in rows) == 5


def test_statistics_of_an_empty_ledger_are_zero(frame):
    row = monitor.statistics(
        frame([], JOB), frame([], COUNTER), frame([], COUNTER), frame([], "key STRING"), frame([], "id STRING"),
        frame([], "source STRING, queue STRING"),
    ).first()
    assert len(row) == 9 and set(row) == {0}


def test_servers_decode_their_payload(frame):
    rows = frame([("s", '{"WorkerCount":3,"Queues":["a","b"],"StartedAt":"2024-01-02T00:00:00Z"}', NOW)], "id STRING, data STRING, lastheartbeat TIMESTAMP")
    row = monitor.servers(rows).first()
    assert (row.name, row.workers_count, row.queues, row.started_at) == ("s", 3, ["a", "b"], datetime(2024, 1, 2))
    bare = frame([("s", "{}", NOW)], "id STRING, data STRING, lastheartbeat TIMESTAMP")
    assert monitor.servers(bare).selectExpr("CAST(started_at AS STRING)").first()[0].startswith("0001-01-01")


def test_payload_keys_that_differ_in_case_and_zones(spark):
    from ledgerline.functions.payload import state_fields, utc_time

    rows = spark.createDataFrame([('{"a":"1","A":"2","b":"3"}',), ("broken",), (None,)], "data STRING")
    got = [r[0] for r in rows.select(state_fields(rows.data)).collect()]
    assert got[0] == {"a": "2", "b": "3"} and not got[2]
    texts = ["2024-03-01T12:00:00Z", "2024-03-01T12:00:00.5+02:00", "2024-03-01T12:00:00", "2024-11-03T05:30:00Z", "x", None]
    times = spark.createDataFrame([(t,) for t in texts], "t STRING")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            found = [None if r[0] is None else str(r[0]) for r in times.select(utc_time(times.t)).collect()]
            assert found == ["2024-03-01 12:00:00", "2024-03-01 10:00:00.500000", "2024-03-01 12:00:00", "2024-11-03 05:30:00", None, None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
