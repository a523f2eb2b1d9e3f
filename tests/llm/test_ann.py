import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import ann

SCHEMA = "vec_id BIGINT, embedding ARRAY<DOUBLE>, id STRING, data INT"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA)


def brute(rows, chosen, k):
    ok = [(i, np.array(v)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, v in ok:
        if chosen(q):
            all_ = sorted((-float(v @ w), i) for i, w in ok if i != q and len(w) == len(v))
            out[q] = [(i, -s) for s, i in all_[:k]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def recall(got, want):
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    return hits / sum(map(len, want.values()))


def clustered(rng, n, dim, lengths):
    centres = rng.normal(size=(20, dim))
    return (centres[rng.integers(0, 20, n)] + 0.5 * rng.normal(size=(n, dim))) * lengths


@pytest.mark.parametrize("kind", ["unit", "long"])
def test_recall_and_scores(spark, kind):
    rng = np.random.default_rng(1)
    x = clustered(rng, 3000, 24, 1.0)
    x = x / np.linalg.norm(x, axis=1, keepdims=True) if kind == "unit" else x * rng.lognormal(0, 0.7, (3000, 1))
    rows = [(i * 3, v.tolist()) for i, v in enumerate(x)]
    got = found(ann.nearest(frame(spark, rows), F.col("id") % 20 == 0, 20, shard_rows=700))
    want = brute(rows, lambda q: q % 20 == 0, 20)
    assert set(got) == set(want) and recall(got, want) >= 0.95
    place = dict(rows)
    for q, best in got.items():
        assert best == sorted(best, key=lambda b: (-b[1], b[0])) and len(best) == 20
        assert all(abs(s - np.dot(place[q], place[i])) < 1e-9 for i, s in best)


def test_a_third_are_copies(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 8))
    x[:250] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = found(ann.nearest(frame(spark, rows), F.col("id") % 20 == 0, 20, shard_rows=200))
    want = brute(rows, lambda q: q % 20 == 0, 20)
    assert [i for i, _ in got[0]] == list(range(1, 21)) and [i for i, _ in got[20]] == [*range(20), 21][:20]
    assert recall(got, want) >= 0.95


def test_odd_rows(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0])]
    rows += [(6, [float("inf"), 1.0]), (7, []), (8, [1e200, 1.0]), (9, [1.0, 2.0, 3.0]), (10, [1e-200, 0.0]), (None, [1.0, 1.0]), (1, [0.5, 0.5])]
    got = found(ann.nearest(frame(spark, rows), F.lit(True), 20))
    assert set(got) == {0, 1, 8, 9, 10} - {9}
    assert [i for i, _ in got[0]] == [8, 1, 1, 10] and [i for i, _ in got[1]] == [8, 0, 10]


def test_empty(spark):
    assert ann.nearest(frame(spark, []), F.lit(True), 5).collect() == []
    assert ann.nearest(frame(spark, [(1, [1.0])]), F.lit(True), 5).collect() == []


def test_stored_shard_is_the_same():
    rng = np.random.default_rng(5)
    shard = ann.Shard(np.arange(300), rng.normal(size=(300, 6)))
    again = ann.Shard.load(shard.dump())
    q = rng.normal(size=(10, 6))
    assert again.beam == shard.beam
    for a, b in zip(shard.search(np.arange(10), q, 5), again.search(np.arange(10), q, 5)):
        assert (a == b).all()


@pytest.mark.parametrize("spread", [0.0, 0.5, 1.0])
def test_vectors_without_clusters(spark, spread):
    """Recall holds where neighbours are hardly nearer than others, and where a few long vectors are near to all."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(4000, 64)) * rng.lognormal(0, spread, (4000, 1))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = found(ann.nearest(frame(spark, rows), F.col("id") % 20 == 0, 20, shard_rows=1400))
    want = brute(rows, lambda q: q % 20 == 0, 20)
    assert set(got) == set(want) and recall(got, want) >= 0.9


def test_full_shard_without_clusters():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(ann.SHARD_ROWS, 64))
    chosen = np.arange(0, len(x), 40)
    found_for, ids, _ = ann.Shard(np.arange(len(x)), x).search(chosen, x[chosen], 20)
    sims = x[chosen] @ x.T
    sims[np.arange(len(chosen)), chosen] = -np.inf
    best = np.argsort(-sims, 1)[:, :20]
    assert sum(np.isin(best[i], ids[found_for == q]).sum() for i, q in enumerate(chosen)) >= 0.9 * best.size


def test_beam_follows_the_vectors():
    rng = np.random.default_rng(8)
    near = ann.Shard(np.arange(3000), clustered(rng, 3000, 16, 1.0))
    far = ann.Shard(np.arange(3000), rng.normal(size=(3000, 64)))
    assert near.beam == ann.BEAM and (far.beam == 0 or far.beam > ann.BEAM)
