import random
import re
import zlib
from collections import Counter

import pytest

from ledgerline.llm import spelling
from ledgerline.llm.common import Steps


def brute_words(rows, min_chars=6, min_count=5, every=199):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(str.maketrans(spelling.UPPER, spelling.LOWER))
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if n >= min_count and len(w) >= min_chars}


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(counts, ratio=5):
    near = {w: [v for v in counts if one_apart(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(out, key=lambda row: row[0])


def found(df):
    columns = ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((tuple(row) for row in df.select(*columns).collect()), key=lambda row: row[0])


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", 1, 2) for i, t in rows], "doc_id BIGINT, text STRING, word STRING, _doc STRING, n INT, number INT")


@pytest.mark.parametrize("partitions", [1, 4, 37])
def test_equals_brute_force_over_any_partitions(spark, partitions):
    """Few letters and much repetition: words share long prefixes across partitions, and characters repeat in a row."""
    rng = random.Random(partitions)
    counts = {}
    while len(counts) < 600:
        counts["".join(rng.choice("aabé") for _ in range(rng.randrange(1, 9)))] = int(5 ** rng.uniform(0, 6))
    df = spark.createDataFrame(list(counts.items()), "word STRING, n BIGINT").repartition(3)
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = found(spelling.variants(df, Steps(spark)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = brute(counts)
    assert got == want and sum(row[1] is not None and row[2] != row[1] for row in want) > 20


def test_words_of_texts(spark):
    rng = random.Random(4)
    base = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(5, 9))) for _ in range(40)]
    rows = [(i if i % 9 else None, " ".join(rng.choice(base).title() for _ in range(200)) + ", xx_yy1zz ÀBCDEFG×÷ 漢字漢字漢字漢字") for i in range(60)]
    rows += [(100, None), (101, ""), (102, "a" * 50_000), (103, "Straße-Straßen " * 9), (None, None)]
    rows += [(200 + i, "z" * 400 + " " + "z" * 401) for i in range(6)] + [(3, "same same same sameness " * 20)] * 2
    counts = brute_words(rows)
    docs = frame(spark, rows)
    assert {r["word"]: r["n"] for r in spelling.word_counts(docs, typo_every=199).collect()} == counts
    assert found(spelling.spelling_variants(docs)) == brute(counts)


def test_long_chain_of_forms(spark):
    counts = {"abcdef" + "g" * i: 5 * 6**i for i in range(20)}
    got = found(spelling.variants(spark.createDataFrame(list(counts.items()), "word STRING, n BIGINT"), Steps(spark)))
    assert got == brute(counts) and {row[2] for row in got} == {"abcdef" + "g" * 19}


def test_empty(spark):
    assert found(spelling.spelling_variants(frame(spark, []))) == []
    assert found(spelling.spelling_variants(frame(spark, [(1, None), (None, "short words only")]))) == []
