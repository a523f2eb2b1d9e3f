import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import negatives

SCHEMA = "vec_id BIGINT, embedding ARRAY<DOUBLE>, label INT, shard STRING, block INT, vector STRING, dims INT"


def frame(spark, rows):
    return spark.createDataFrame([(*row, "x", 1, "y", 2) for row in rows], SCHEMA)


def brute(rows, positives=5, negatives_=5):
    own = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        own[i] = min(own.get(i, (label, v)), (label, v))
    own = {i: ((label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * x) for x in v]) for i, (label, v) in own.items()}
    out = []
    for a in own:
        if a % 100:
            continue
        label, v = own[a]
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, lab) for i, (lab, w) in own.items() if i != a and len(w) == len(v))
        for p_score, p, _ in [s for s in scored if s[2] == label][:positives]:
            inside = [s for s in scored if s[2] != label and 80 * -p_score <= 100 * -s[0] <= 100 * -p_score]
            out += [(a, p, rank + 1, i, -p_score, -s) for rank, (s, i, _) in enumerate(inside[:negatives_])]
    return sorted(out)


def found(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize(
    "kind, shard_rows, anchor_rows", [("clusters", 150, 3), ("clusters", 8192, 8192), ("ties", 100, 2), ("long", 130, 8192)]
)
def test_equals_brute_force(spark, kind, shard_rows, anchor_rows):
    rng = np.random.default_rng(5)
    n, dim = 900, 12
    x = rng.normal(size=(20, dim))[rng.integers(0, 20, n)] + 0.4 * rng.normal(size=(n, dim))
    if kind == "ties":
        x = rng.integers(-1, 2, (n, 4)) / 256.0
    if kind == "long":
        x *= rng.lognormal(0, 1, (n, 1))
    rows = [(i, v.tolist(), int(rng.integers(0, 10))) for i, v in enumerate(x)]
    got = negatives.mine(
        frame(spark, rows), F.col("vec_id") % 100 == 0, negatives.shifted_label(), shard_rows=shard_rows, anchor_rows=anchor_rows
    )
    want = brute(rows)
    assert want and found(got) == want


ODD = [
    (0, [1.0, 0.5], 3),
    (0, [1.0, 0.25], 3),  # repeats an id: the least row counts
    (0, [1.0, 0.25], None),
    (100, [0.0, 0.0], 2),  # zero vector
    (200, [-1.0, -1.0], 2),  # negative scores only: empty windows
    (300, [1.0], 4),  # other length
    (301, [1.0], 4),
    (302, [0.9], 5),
    (400, [], 4),
    (401, [], 4),
    (402, [], 5),
    (1, [1.0, 1.0], 4),
    (2, [0.9, 0.25], 4),
    (3, [0.9, 0.25], 5),
    (4, [0.9, 0.25], 5),
    (5, [1.0, None], 4),
    (6, [1.0, math.nan], 4),
    (8, [math.inf, 1.0], 4),
    (9, None, 4),
    (None, [1.0, 1.0], 4),
    (10, [1.0, 1.0], None),
    (-100, [0.7, 0.1], 4),
    (-7, [0.7, 0.1], 3),
    (12, [0.1, 0.1], 2),
    (13, [0.0, 0.0], 2),
    (14, [0.3, -0.3], 9),
]


def test_odd_rows(spark):
    want = brute(ODD)
    assert want and found(negatives.mined(frame(spark, ODD))) == want


def test_scores_beyond_doubles(spark):
    """Sums of products above 2^53 are still exact."""
    rows = [(i, [float(2**20 + i % 3), float(2**19 - i % 5), 1 / 256 * (i % 7)], i % 4) for i in range(0, 220, 2)]
    want = brute(rows)
    assert max(r[4] for r in want) > 2**53 and found(negatives.mined(frame(spark, rows))) == want


def test_empty_table(spark):
    assert found(negatives.mined(frame(spark, []))) == []


def test_stops_before_the_end():
    """With few dimensions the threshold closes all windows early, and the rows left unscored are worse."""
    rng = np.random.default_rng(2)
    x = np.floor(256 * rng.normal(size=(4000, 2)))
    lists = negatives.Lists(np.arange(4000), np.zeros(4000), x, True)
    counts = []
    real = lists.vectors

    class Counted:
        dtype = real.dtype

        def __getitem__(self, rows):
            counts.append(len(rows))
            return real[rows]

    lists.vectors = Counted()
    anchor = np.array([200.0, -90.0])
    ((found_, scores),) = lists.best(anchor, np.ones(4000, bool), [(None, None)], 5)
    want = np.sort(real @ anchor)[::-1][:5]
    assert scores.tolist() == want.tolist() and sum(counts) < 1000
