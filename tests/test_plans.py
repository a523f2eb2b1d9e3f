"""Plans over stored ledger tables: what reaches the scan, what is shuffled, what is broadcast."""

import re
from datetime import timedelta

import pytest

import __spark_entry__ as entry
from ledgerline.operators import apply, collections, maintain, monitor, queues
from ledgerline.plans.mapping import ASOF_EVENTS, ASOF_JOBS, Ledger
from ledgerline.plans.registry import all_queries
from ledgerline.sources.schemas import SCHEMAS
from ledgerline.sources.snapshots import SnapshotStore

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def ledger(spark, tmp_path_factory):
    """The mapped tables published as a snapshot, so plans start at real ledger files."""
    store = SnapshotStore(spark, str(tmp_path_factory.mktemp("ledger")))
    mapped = Ledger(spark, FOLDER)
    store.publish({name: mapped[name] for name in SCHEMAS}, cluster_by={"counter": ["key"], "job": ["statename", "id"]})
    return {name: store.read(name) for name in SCHEMAS}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    return df._jdf.queryExecution().explainString(df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def scans(df) -> list[str]:
    return re.findall(r"\(\d+\) Scan parquet.*?(?=\n\n|\Z)", formatted(df), re.S)


BATCH = [name for name in all_queries() if not name.startswith("stream_")]


@pytest.mark.parametrize("name", BATCH)
def test_no_query_pairs_rows_without_a_key_or_leaves_the_jvm(spark, name):
    text = plan(entry.queries()[name](spark, FOLDER))
    # The only batch step in Python, a block of workers at a time, ends in a written table.
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert node not in text


def test_purge_filters_at_the_scan(ledger):
    (scan,) = scans(maintain.purge(ledger["counter"], ASOF_EVENTS))
    assert "GreaterThanOrEqual(expireat" in scan


def test_summary_reads_only_the_expiry(ledger):
    (scan,) = scans(maintain.purge_summary({"job": ledger["job"]}, {"job": ASOF_JOBS}))
    assert "ReadSchema: struct<expireat:timestamp_ntz>" in scan


def test_timeline_asks_the_scan_for_its_keys(ledger):
    found = scans(monitor.daily_timeline(ledger["counter"], ledger["aggregatedcounter"], ASOF_EVENTS))
    assert len(found) == 2
    for scan in found:
        assert "In(key, [" in scan and "ReadSchema: struct<key:string,value:bigint>" in scan


def test_state_counts_read_one_column(ledger):
    (scan,) = scans(monitor.jobs_by_state(ledger["job"]))
    assert "ReadSchema: struct<statename:string>" in scan


def test_claims_filter_at_the_scan_and_sort_only_the_first(ledger):
    df = queues.claim_batch(ledger["jobqueue"], ["low"], timedelta(minutes=30), ASOF_JOBS, 10)
    (scan,) = scans(df)
    assert "EqualTo(queue,low)" in scan and "LessThan(fetchedat" in scan
    assert "TakeOrderedAndProject" in plan(df)


def test_page_takes_the_first_rows_before_joining(ledger):
    text = plan(monitor.succeeded_jobs(ledger["job"], ledger["state"], 5, 50))
    assert text.count("TakeOrderedAndProject") >= 1
    assert "BroadcastHashJoin [id" in text and "LeftSemi, BuildRight" in text
    # Payloads are parsed above the page, not at the scan.
    assert text.index("from_json") < text.index("TakeOrderedAndProject")


def test_ranges_prune_before_the_shuffle(ledger):
    for df in (
        collections.list_range(ledger["list"], 2, 20),
        collections.set_lowest_n(ledger["set"], 0.0, 1.0, 5),
        monitor.jobs_page_per_state(ledger["job"], ledger["state"], 0, 50),
    ):
        text = plan(df)
        assert text.rindex("WindowGroupLimit") > text.rindex("Exchange hashpartitioning") or "Partial" in text


def test_ranks_of_asked_keys_leave_the_partitions_of_the_join(spark, ledger):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        asked = ledger["list"].select("key").distinct()
        pruned = plan(collections.list_range(ledger["list"], 2, 20, asked))
        whole = plan(collections.list_items(ledger["list"], asked))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for text in (pruned, whole):
        window = text.index("row_number()")
        assert text.index("Exchange hashpartitioning", window) < text.index("SortMergeJoin [key", window)
    join = pruned.index("SortMergeJoin [key")
    assert pruned.index("Partial") < join


def test_few_commands_do_not_shuffle_the_snapshot(ledger, frame):
    commands = frame([(1, 1, "set_state", "S", None, None, None)], "seq LONG, jobid LONG, op STRING, name STRING, reason STRING, data STRING, ts TIMESTAMP")
    after, _ = apply.apply_states(ledger["job"], ledger["state"], commands)
    after.collect()
    text = plan(after)
    assert "BroadcastHashJoin" in text.split("Initial Plan")[0]


def test_counter_sums_are_partial_before_the_shuffle(ledger):
    text = plan(collections.counter_value(ledger["counter"], ledger["aggregatedcounter"]))
    assert text.count("partial_sum") >= 1


def _orders_and_lines(spark, folder, first):
    """Three orders from ``first`` on; a line with two rows, one with the same row twice, and one without a part."""
    day = "TIMESTAMP_NTZ '1998-01-01 00:00:00'"
    lines = [(first, 1, 9, 9, "A"), (first, 2, 5, 1, "R"), (first, 2, 4, 7, "N"), (first + 1, 3, 2, 2, "R"), (first + 1, 3, 2, 2, "R"), (first + 2, 1, None, 3, "A")]
    rows = spark.createDataFrame(lines, "l_orderkey LONG, l_linenumber INT, l_partkey LONG, l_suppkey LONG, l_returnflag STRING")
    rows.selectExpr("*", "'O' AS l_linestatus", f"{day} AS l_shipdate").write.parquet(f"{folder}/lineitem.parquet")
    orders = spark.range(first, first + 3).selectExpr("id AS o_orderkey", "id AS o_custkey", "'O' AS o_orderstatus", f"{day} AS o_orderdate")
    orders.write.parquet(f"{folder}/orders.parquet")


def test_state_ids_of_many_orders_fit(spark, tmp_path):
    """Order keys for which the formula of ids would leave 64 bits: rows keep ids of their own, in the same order."""
    found = {}
    for first in (7, 11_529_200, 53_999_997):
        _orders_and_lines(spark, f"{tmp_path}/{first}", first)
        mapped = Ledger(spark, f"{tmp_path}/{first}")
        states = sorted(tuple(r) for r in mapped["state"].select("jobid", "id", "name").collect() if r.id is not None)
        jobs = {r.id - first: (r.stateid, r.statename) for r in mapped["job"].select("id", "stateid", "statename").collect()}
        assert len(states) == 5 and len({s[1] for s in states}) == 4 and [s[1] for s in states] == sorted(s[1] for s in states)
        assert jobs[0] == states[2][1:] and jobs[1] == states[4][1:]
        found[first] = [s[1] for s in states], [(s[0] - first, s[2]) for s in states]
    assert found[53_999_997][1] == found[11_529_200][1] == found[7][1]
    for first in (7, 11_529_200):
        assert found[first][0] == [((o * 8 + n) * 10**6 + p) * 10**5 + s for o, n, p, s in
                                   [(first, 1, 9, 9), (first, 2, 4, 7), (first, 2, 5, 1), (first + 1, 3, 2, 2), (first + 1, 3, 2, 2)]]
