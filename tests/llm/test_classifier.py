import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import classifier

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    got = classifier.classify(docs, labels).join(labels, "doc_id").where("held_out").collect()
    right = sum(r.predicted == r.quality for r in got)
    assert len(got) > 50 and right / len(got) > 0.95
    assert all(0 <= r.score <= 1 for r in got)


def test_column_equals_model(spark, documents):
    rng = np.random.default_rng(1)
    x = rng.random((500, len(classifier.STATISTICS)))
    y = ((x[:, 2] > 0.4) & (x[:, 6] <= 0.7)).astype(float)
    model = classifier.fit(x, y)
    assert ((model.scores(x) >= 0.5) == y).mean() > 0.97 and 0 < len(model.rules) < 150
    names = [f"s_{n}" for n in classifier.STATISTICS]
    df = spark.createDataFrame([tuple(map(float, r)) for r in x[:50]], ", ".join(f"{n} double" for n in names))
    got = [r[0] for r in df.select(model.column()).collect()]
    assert np.allclose(got, model.scores(x[:50]), atol=1e-9)


def test_lasso_keeps_few(spark):
    rng = np.random.default_rng(2)
    z = rng.normal(size=(2000, 60))
    y = (rng.random(2000) < 1 / (1 + np.exp(-(2 * z[:, 3] - 1.5 * z[:, 7])))).astype(float)
    b, w = classifier.lasso(z, y, 0.03)
    assert set(np.flatnonzero(np.abs(w) > 0.2)) == {3, 7} and (np.abs(w) < 1e-9).sum() > 40


def test_statistics_match_brute_force(documents):
    rng = random.Random(1)
    texts = [None, "", "a", "A a! a!! a!! 12\n\nx #\nx #", " ".join(rng.choice(["Ab", "c,", "d.", "7", "$x"]) for _ in range(300)), "w " * 100_000]
    rows = classifier.with_statistics(documents(list(enumerate(texts))), ["doc_id"]).collect()
    import re

    for r in rows:
        text = texts[r.doc_id] or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        n = max(1, len(w))
        lines = [x for x in text.split("\n") if x.strip()]
        assert r.s_words == len(w)
        assert r.s_symbols == pytest.approx(sum(c in "#*$%&|<>" for c in text) / n)
        assert r.s_marks == pytest.approx(text.count("!") / n)
        assert r.s_distinct == pytest.approx(len(set(w)) / n)
        assert r.s_echoes == pytest.approx(sum(a == b for a, b in zip(w, w[1:])) / n)
        assert r.s_ended == pytest.approx(sum(x[-1] in ".!?,;:" for x in w) / n)
        assert r.s_line_copies == pytest.approx((len(lines) - len(set(lines))) / max(1, len(lines)))


def test_one_class_no_labels_and_empty(spark, documents):
    labels = "doc_id BIGINT, quality INT, toxic INT"
    docs = documents([(1, "a b"), (2, None), (None, "x"), (1, "a b")])
    none = classifier.classify(docs, spark.createDataFrame([], labels)).collect()
    assert len(none) == 4 and all(r.score == 0.5 and r.predicted == 0 for r in none)
    ones = classifier.classify(docs, spark.createDataFrame([(1, 1, 0), (None, 0, 0), (2, None, 0)], labels)).collect()
    assert len({r.score for r in ones}) == 1 and ones[0].score > 0.5
    assert classifier.classify(documents([]), spark.createDataFrame([], labels)).collect() == []


def test_held_out_labels_teach_nothing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    score = lambda l: sorted((r.doc_id, r.score) for r in classifier.classify(docs, l).collect())
    assert score(labels) == score(turned)
