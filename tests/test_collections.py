from datetime import datetime, timedelta

import pytest
from conftest import tuples

from ledgerline.operators import collections as keyed

NOW = datetime(2024, 5, 1, 12)
SET = "id LONG, key STRING, score DOUBLE, value STRING, expireat TIMESTAMP"
LIST = "id LONG, key STRING, value STRING, expireat TIMESTAMP"
HASH = "id LONG, key STRING, field STRING, value STRING, expireat TIMESTAMP"
COUNTER = "id LONG, key STRING, value LONG, expireat TIMESTAMP"


def scored(frame, *scores):
    rows = [(i, "key", s, str(s), None) for i, s in enumerate(scores)]
    return frame(rows + [(99, "another-key", -2.0, "-2.0", None)], SET)


def test_lowest_score_in_range(frame):
    sets = scored(frame, 1.0, -1.0, -5.0)
    assert tuples(keyed.set_lowest(sets, -1.0, 3.0, ["key"])) == [("key", "-1.0")]
    first = keyed.set_lowest_n(sets, -1.0, 3.0, 10, ["key"]).orderBy("rank")
    assert [r.value for r in first.collect()] == ["-1.0", "1.0"]


def test_first_three_by_score(frame):
    sets = scored(frame, 1.0, 1.5, 2.0, 2.5, -1.0, -5.0)
    first = keyed.set_lowest_n(sets, -1.0, 3.0, 3, ["key"]).orderBy("rank")
    assert [r.value for r in first.collect()] == ["-1.0", "1.0", "1.5"]


def test_equal_scores_go_by_id(frame):
    sets = frame([(2, "k", 0.0, "b", None), (1, "k", 0.0, "z", None)], SET)
    assert tuples(keyed.set_lowest(sets, 0.0, 0.0)) == [("k", "z")]


def test_score_arguments(frame):
    sets = scored(frame, 1.0)
    with pytest.raises(ValueError):
        keyed.set_lowest(sets, 1.0, 0.0)
    with pytest.raises(ValueError):
        keyed.set_lowest_n(sets, 0.0, 1.0, 0)


def lists(frame):
    rows = [(1, "list-1", "1", None), (2, "list-2", "2", None), (3, "list-1", "3", None)]
    return frame(rows + [(4, "list-1", "4", None), (5, "list-1", "5", None)], LIST)


def test_list_reads_newest_first(frame):
    items = keyed.list_items(lists(frame), ["list-1"]).orderBy("position")
    assert [r.value for r in items.collect()] == ["5", "4", "3", "1"]
    page = keyed.list_range(lists(frame), 1, 2, ["list-1"]).orderBy("position")
    assert [r.value for r in page.collect()] == ["4", "3"]


def test_set_range_reads_oldest_first(frame):
    sets = frame([(i, "set-1", 0.0, str(i), None) for i in range(1, 6)] + [(9, "set-2", 0.0, "4", None)], SET)
    page = keyed.set_range(sets, 2, 3, ["set-1"]).orderBy("position")
    assert [r.value for r in page.collect()] == ["3", "4"]


@pytest.mark.parametrize("bounds,kept", [((1, 2), ["1", "2"]), ((1, 100), ["1", "2", "3"]), ((1, 0), [])])
def test_trim_keeps_oldest_positions(frame, bounds, kept):
    rows = frame([(i, "list", str(i), None) for i in range(4)] + [(9, "other", "x", None)], LIST)
    trimmed = keyed.trim_lists(rows, *bounds, keys=["list"]).orderBy("id")
    assert [r.value for r in trimmed.collect()] == kept + ["x"]


def test_trim_takes_keys_as_a_frame(frame, spark):
    rows = frame([(i, "list", str(i), None) for i in range(4)] + [(9, "other", "x", None)], LIST)
    asked = spark.createDataFrame([("list",)], ["key"])
    assert keyed.trim_lists(rows, 0, 0, asked).count() == 2


@pytest.mark.parametrize("as_frame", [False, True])
def test_counts_and_ttl(frame, spark, as_frame):
    soon, later = NOW + timedelta(hours=1), NOW + timedelta(hours=2)
    rows = frame([(1, "k", "f1", "v", later), (2, "k", "f2", "v", soon), (3, "never", "f", "v", None)], HASH)
    keys = ["k", "never", "absent"]
    if as_frame:
        keys = spark.createDataFrame([(k,) for k in keys], ["key"])
    assert dict(tuples(keyed.key_counts(rows, keys))) == {"k": 2, "never": 1, "absent": 0}
    assert dict(tuples(keyed.key_ttl(rows, NOW, keys))) == {"k": 3600.0, "never": -1.0, "absent": -1.0}
    assert keyed.key_counts(rows).count() == 2


def test_hash_reads(frame):
    rows = frame([(1, "h", "Key1", "a", None), (2, "h", "Key2", None, None), (3, "g", "Key1", "c", None)], HASH)
    assert sorted(tuples(keyed.hash_entries(rows, ["h"]))) == [("h", "Key1", "a"), ("h", "Key2", None)]
    assert keyed.hash_entries(rows, ["absent"]).count() == 0
    assert sorted(tuples(keyed.hash_value(rows, "Key1"))) == [("g", "c"), ("h", "a")]


def test_counter_sums_both_tables(frame):
    pending = frame([(1, "a", 2, None), (2, "a", -1, None), (3, "b", 4, None)], COUNTER)
    rolled = frame([(1, "a", 10, None)], COUNTER)
    assert dict(tuples(keyed.counter_value(pending, rolled, ["a", "none"]))) == {"a": 11, "none": 0}


def test_expired_rows_stay_readable(frame):
    rows = frame([(1, "k", 0.0, "v", NOW - timedelta(days=1))], SET)
    assert keyed.set_items(rows).count() == 1
