import random
from collections import defaultdict
from fractions import Fraction

from pyspark.sql import functions as F

from ledgerline.llm import mixing
from ledgerline.llm.common import word_count


def levels(sizes, weights, share, most):
    """Water filling by repeated resharing."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, rest = {}, Fraction(sum(sizes.values()) * share, 100)
    open_ = set(names)
    while open_:
        level = rest / sum(weight[s] for s in open_)
        full = {s for s in open_ if most * sizes[s] <= level * weight[s]}
        if not full:
            target |= {s: level * weight[s] for s in open_}
            break
        target |= {s: Fraction(most * sizes[s]) for s in full}
        rest -= sum(most * sizes[s] for s in full)
        open_ -= full
    return target


def test_targets_and_cuts(documents):
    rng = random.Random(2)
    sources = ["a", "B", "é", "\U0001f600", "￮", None, "", "c", "z"]
    rows = [(i, "w " * rng.choice([0, 1, 3, 40, 200]), rng.choice(sources[: rng.randrange(1, 10)])) for i in range(300)]
    rows += [(7, rows[7][1], rows[7][2]), (900, None, "a"), (901, "x " * 5000, "z")]
    got = mixing.mix(documents(rows)).collect()
    assert len(got) == len(rows)
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in got:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 2 * r.size
    want = levels(dict(sizes), (5, 2, 1), 150, 2)
    for s in sizes:
        assert abs(target[s] - float(want[s])) < 1e-6
        assert taken[s] == int(target[s])
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(documents(rows)).collect()))


def test_only_one_epoch_is_cut(documents):
    rows = [(i, "w " * 10, "a") for i in range(50)] + [(100 + i, "w " * 10, "b") for i in range(50)]
    got = mixing.mix(documents(rows)).collect()
    partial = [r for r in got if r.taken % r.size]
    assert len(partial) <= 2


def test_taken_documents(documents):
    rows = [(i, f" a{i}\n b  c\td ", "a") for i in range(20)] + [(50, None, "b"), (51, "", "b")]
    docs = documents(rows)
    plan = mixing.mix(docs)
    out = mixing.taken_documents(docs, plan)
    assert out.columns == docs.columns
    words = out.select(F.sum(word_count(F.col("text")))).first()[0]
    assert words == plan.agg(F.sum("taken")).first()[0]
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(texts[r.doc_id].startswith(r.text) for r in out.collect())


def test_empty_and_wordless(documents):
    assert mixing.mix(documents([])).collect() == []
    got = mixing.mix(documents([(1, None, None), (2, "", "a")])).collect()
    assert [(r.size, r.taken, r.target) for r in got] == [(0, 0, 0.0)] * 2


def test_word_count(spark):
    texts = ["", " ", "a", " a ", "a\x0bb\x0c\rc\n\nd", "  x\x1cy", None, "a  b"]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    assert [r[0] for r in df.select(word_count(df.t)).collect()] == [0, 0, 1, 1, 4, 2, 0, 2]


def test_no_python_in_plan(documents):
    text = mixing.mix(documents([(1, "a b", "s")]))._jdf.queryExecution().toString()
    assert "Python" not in text and "Pandas" not in text
