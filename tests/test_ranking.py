import random

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from ledgerline.functions import ranking

ROWS = "id LONG, key STRING, value STRING"


def rows(seed=1, n=400):
    rng = random.Random(seed)
    ids = rng.sample(range(5 * n), n)
    # A third of the rows share one key.
    return [(i, "hot" if rng.random() < 0.34 else f"k{rng.randrange(20)}", rng.choice("abc")) for i in ids]


@pytest.mark.parametrize("width", [1, 7, 100, 1 << 20])
@pytest.mark.parametrize("descending", [False, True])
def test_position_matches_sorting(frame, width, descending):
    data = rows()
    want = {}
    for key in {k for _, k, _ in data}:
        for position, i in enumerate(sorted((i for i, k, _ in data if k == key), reverse=descending)):
            want[i] = position
    got = ranking.position_per_key(frame(data, ROWS), ["key"], descending=descending, width=width)
    assert {r["id"]: r["position"] for r in got.collect()} == want


def test_range_is_the_same_pruned_or_bucketed(frame, monkeypatch):
    data = frame(rows(2), ROWS)
    pruned = sorted(tuples(ranking.range_per_key(data, ["key"], 3, 40)))
    monkeypatch.setattr(ranking, "pruned_rank", lambda df: 0)
    assert sorted(tuples(ranking.range_per_key(data, ["key"], 3, 40, width=13))) == pruned


@pytest.mark.parametrize("start,end", [(-1, 3), (3, 1)])
def test_range_rejects_negative_bounds(frame, start, end):
    with pytest.raises(ValueError):
        ranking.range_per_key(frame(rows(), ROWS), ["key"], start, end)


def test_empty_range_is_allowed(frame):
    assert ranking.range_per_key(frame(rows(), ROWS), ["key"], 1, 0).count() == 0


def test_top_is_the_same_with_a_tournament(frame, monkeypatch):
    data = frame(rows(3), ROWS)
    by = [F.col("value"), F.col("id")]
    plain = sorted(tuples(ranking.top_per_key(data, ["key"], by, 9)))
    monkeypatch.setattr(ranking, "pruned_rank", lambda df: 0)
    assert sorted(tuples(ranking.top_per_key(data, ["key"], by, 9))) == plain


def test_pruned_range_limits_before_the_shuffle(frame):
    plan = ranking.range_per_key(frame(rows(), ROWS), ["key"], 0, 9)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan


@pytest.mark.parametrize("width", [1, 5, 1 << 20])
def test_carry_last(frame, width):
    data = sorted(rows(4))
    seen, want = {}, {}
    for i, key, value in data:
        want[i] = seen.get(key)
        if value != "a":
            seen[key] = value
    marked = F.when(F.col("value") != "a", F.col("value"))
    got = ranking.carry_last(frame(data, ROWS), ["key"], "id", marked, "before", width=width)
    assert {r["id"]: r["before"] for r in got.collect()} == want
