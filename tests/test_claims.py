import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from test_plans import scans

from ledgerline.functions.ranking import deep_page, page_range, position_in_order
from ledgerline.operators import claims, keys, queues

NOW = datetime(2024, 5, 1, 12)
HALF_HOUR = timedelta(minutes=30)
QUEUE = "id LONG, jobid LONG, queue STRING, fetchedat TIMESTAMP, updatecount INT"
WORKERS = "worker LONG, queues ARRAY<STRING>"


def replay(rows, workers):
    """(worker, row) of workers that take one row after the other."""
    free = [r for r in rows if r[3] is None or r[3] < NOW - HALF_HOUR]
    free.sort(key=lambda r: (r[3] is not None, r[3] or NOW, r[2], r[1], r[0]))
    out = []
    for worker, names in sorted(workers, key=lambda w: w[0]):
        row = next((r for r in free if r[2] in (names or [])), None)
        if row:
            free.remove(row)
            out.append((worker, row[0]))
    return out


@pytest.mark.parametrize("seed, block, width", [(1, 20_000, 1 << 20), (2, 7, 5), (3, 1, 1 << 20), (4, 40, 3)])
def test_workers_of_different_queues_equal_replay(spark, frame, seed, block, width):
    rng = random.Random(seed)
    names = ["a", "b", "c", "d", "e"]
    rows = []
    for i in range(150):
        age = rng.choice([None, None, timedelta(minutes=rng.randrange(20, 60)), timedelta(minutes=rng.randrange(31, 400))])
        rows.append((2**60 + i, rng.randrange(60), rng.choice(names), None if age is None else NOW - age, 1_999_999_999))
    workers = [(2**55 + 3 * i, rng.sample([*names, "none"], rng.randrange(0, 4)) + ["a"] * rng.randrange(2)) for i in range(120)]
    workers += [(1, None), (2, []), (3, ["none"]), (4, ["b", "b"])]
    got = claims.claim_for_workers(frame(rows, QUEUE), spark.createDataFrame(workers, WORKERS), HALF_HOUR, NOW, block, width).collect()
    assert sorted((r.slot, r.id) for r in got) == replay(rows, workers)
    assert {(r.fetchedat, r.updatecount) for r in got} == {(NOW, 0)}


def test_no_workers_and_no_rows(spark, frame):
    none = spark.createDataFrame([], WORKERS)
    some = spark.createDataFrame([(1, ["a"])], WORKERS)
    assert claims.claim_for_workers(frame([(1, 1, "a", None, 0)], QUEUE), none, HALF_HOUR, NOW).count() == 0
    assert claims.claim_for_workers(frame([], QUEUE), some, HALF_HOUR, NOW).count() == 0


def test_many_workers_are_numbered_in_ranges(frame, monkeypatch):
    monkeypatch.setattr(queues, "BROADCAST_ROWS", 10)
    rows = [(i, i * 7 % 50, "ab"[i % 2], None if i % 3 else NOW - timedelta(hours=1, minutes=i % 4), 0) for i in range(100)]
    got = queues.claim_batch(frame(rows, QUEUE), ["a", "b"], HALF_HOUR, NOW, 60)
    want = sorted(rows, key=lambda r: (r[3] is not None, r[3] or NOW, r[2], r[1], r[0]))[:60]
    assert [r.id for r in got.orderBy("slot").collect()] == [r[0] for r in want]
    assert sorted(r.slot for r in got.collect()) == list(range(1, 61))
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" not in text and "GlobalLimit" not in text


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("spread", [1, 977, 10**13])
def test_deep_pages(spark, descending, spread):
    """Ids dense and sparse, beyond the ends and below 0."""
    n = 3000
    df = spark.range(n).select(((F.col("id") - 1000) * spread).alias("id")).repartition(5)
    ids = sorted(((i - 1000) * spread for i in range(n)), reverse=descending)
    for offset, limit in ((0, 3), (1234, 50), (2990, 50), (2999, 1), (3000, 5), (10, 0), (0, 5000)):
        low_high = page_range(df, "id", offset, limit, descending, few=10)
        got = [r.id for r in deep_page(df, "id", offset, limit, descending).collect()]
        assert got == ids[offset : offset + limit], (offset, limit)
        if limit == 50 and offset == 1234:
            low, high, _ = low_high
            assert sum(low <= i <= high for i in ids) < 300
    assert deep_page(df.limit(0), "id", 0, 5).collect() == []


def test_ids_at_the_ends_of_the_type(spark):
    ids = [-(2**63), -1, 0, 2**63 - 1]
    df = spark.createDataFrame([(i,) for i in ids], "id LONG")
    assert [r.id for r in deep_page(df, "id", 1, 3).collect()] == ids[1:]


def test_a_deep_page_sorts_only_its_own_rows(spark, tmp_path):
    """At offset 10^6 the range is pushed to the scan and few rows pass it."""
    spark.range(2_000_000).select(F.col("id"), F.lit("S").alias("statename")).write.parquet(str(tmp_path / "job"))
    job = spark.read.parquet(str(tmp_path / "job")).where("statename = 'S'")
    page = keys.id_page(job, 1_000_000, 20, descending=True)
    assert [r.id for r in page.collect()] == list(range(999_999, 999_979, -1))
    (scan,) = scans(page)
    low, high = (int(x) for x in re.search(r"GreaterThanOrEqual\(id,(\d+)\), LessThanOrEqual\(id,(\d+)\)", scan).groups())
    assert high - low < 5000


def test_positions_of_a_hot_key(spark):
    rows = [("hot", i * 37 % 1000, None if i % 5 else i) for i in range(1000)] + [("cold", 1, 1)]
    df = spark.createDataFrame(rows, "k STRING, a INT, b INT")
    got = position_in_order(df, ["k"], [F.col("b").asc_nulls_first(), F.col("a")]).collect()
    want = sorted((r for r in rows if r[0] == "hot"), key=lambda r: (r[2] is not None, r[2] or 0, r[1]))
    assert sorted((r.position, r.a) for r in got if r.k == "hot") == [(i, r[1]) for i, r in enumerate(want)]
