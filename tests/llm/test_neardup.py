import random

import numpy as np

from ledgerline.llm import neardup
from ledgerline.llm.common import Steps
from ledgerline.llm.components import components


def brute(rows):
    sets = {}
    for doc, text in rows:
        w = (text or "").encode().lower().split()
        size = min(3, len(w))
        sets[doc] = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if w else set()
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    docs = sorted(sets)
    for i, a in enumerate(docs):
        for b in docs[:i]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (len(sets[d]), find(d), find(d) == d) for d in docs}


def got(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def test_equals_brute_force(documents):
    rng = random.Random(1)
    word = lambda: rng.choice("abcdefghijklmnop") + rng.choice("xyz\x1cé")
    rows = []
    for family in range(12):
        base = [word() for _ in range(rng.choice([1, 2, 3, 20, 120, 300]))]
        for _ in range(rng.choice([1, 2, 5, 40])):
            text = list(base)
            for _ in range(rng.randrange(0, 5)):
                if len(text) > 30:
                    text[rng.randrange(len(text))] = word()
            rows.append((len(rows) * 7 % 1009, rng.choice([" ", "\n", "\t "]).join(text).upper() if rng.random() < 0.3 else " ".join(text)))
    rows += [(2000, None), (2001, ""), (2002, " \n"), (2003, None), (2004, "One"), (2005, "one"), (2006, "one two"), (2007, "oné")]
    assert got(neardup.near_duplicates(documents(rows))) == brute(rows)


def test_many_copies_and_long_text(documents):
    rng = random.Random(2)
    base = [str(rng.random()) for _ in range(200)]
    chain = []
    for i in range(120):  # a drifting family: neighbours are similar, the ends are not
        base[i % 200] = f"n{i}"
        chain.append(" ".join(base))
    long = " ".join(str(i) for i in range(150_000))
    rows = [(500 + i, chain[0]) for i in range(400)] + [(i, t) for i, t in enumerate(chain)] + [(3000, long), (3001, long + " end")]
    out = got(neardup.near_duplicates(documents(rows)))
    assert {out[i][1] for i in range(120)} == {0} and {out[500 + i][1] for i in range(400)} == {0}
    assert out[3000][1] == out[3001][1] == 3000 and sum(v[2] for v in out.values()) == 2


def test_single_links_in_a_large_family(documents):
    """Variants of one template, each with one partner above the threshold and thousands below it."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(200)]

    def changed(words, count, skip=()):
        places = []
        while len(places) < count:
            at = rng.randrange(3, 197)
            if all(abs(at - p) > 2 for p in (*places, *skip)):
                places.append(at)
        out = list(words)
        for at in places:
            out[at] = f"n{rng.random()}"
        return out, places

    rows = []
    for i in range(4000):
        variant, places = changed(base, 6)
        rows += [(2 * i, " ".join(variant)), (2 * i + 1, " ".join(changed(variant, 5, places)[0]))]
    out = got(neardup.near_duplicates(documents(rows)))
    assert {d: v[1] for d, v in out.items()} == {d: d // 2 * 2 for d, _ in rows}


def test_join_of_prefixes_is_exact(spark, documents, monkeypatch):
    """Every link between different components comes out, also of shingles too frequent for one block."""
    monkeypatch.setattr(neardup, "BLOCK", 7)
    rng = random.Random(6)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(150):
        text = base[: rng.randrange(45, 61)]
        for _ in range(rng.randrange(0, 4)):
            text[rng.randrange(len(text))] = rng.choice("abc")
        rows.append((i, " ".join(text)))
    docs = documents(rows).selectExpr("doc_id AS doc", "CAST(text AS BINARY) AS text")
    members = spark.createDataFrame([(i, i % 5) for i, _ in rows], "doc bigint, component bigint")
    steps = Steps(spark)
    links = neardup.confirmed(steps, neardup.overlapping(steps, members, docs, 3, 85), docs, 3, 85)
    sets = [{tuple(t.split()[j : j + 3]) for j in range(len(t.split()) - 2)} for _, t in rows]
    want = {(a, b) for b in range(150) for a in range(b) if a % 5 != b % 5 and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])}
    assert {(r.a, r.b) for r in links.collect()} == want and len(want) > 100


def test_repeated_rows_null_id_and_empty(documents):
    rows = [(5, "a b c d"), (5, "a b c d"), (None, "a b c d"), (7, "x")]
    out = neardup.near_duplicates(documents(rows)).collect()
    assert len(out) == 4
    assert all(r.component_id is None for r in out if r.doc_id != 7)
    assert [r.kept for r in out if r.doc_id is None] == [True]
    assert neardup.near_duplicates(documents([])).collect() == []


def test_neighbours_across_partitions(spark, monkeypatch):
    """The same pairs come out of one partition and of many."""
    rng = np.random.default_rng(3)
    base = rng.integers(0, 256, (40, 64)).astype(np.uint8)
    rows = []
    for i in range(400):
        key = base[i % 40].copy()
        key[rng.integers(0, 64, 6)] = rng.integers(0, 256, 6)
        rows.append((i, bytearray(key.tobytes())))
    df = spark.createDataFrame(rows, "rep bigint, signature binary")
    one = {(r.a, r.b) for r in neardup.candidates(Steps(spark), df).collect()}
    monkeypatch.setattr(neardup, "ROWS_EACH", 700)
    many = {(r.a, r.b) for r in neardup.candidates(Steps(spark), df).collect()}
    assert one == many and len(one) > 1000


def test_components(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(1, 60)] + [(1000, i) for i in range(1001, 1300)]
    links += [(rng.randrange(2000, 2400), rng.randrange(2000, 2400)) for _ in range(250)] + [(5000, 5000)]
    rng.shuffle(links)
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    rows = components(Steps(spark), spark.createDataFrame(links, "a bigint, b bigint")).collect()
    assert {r.node: r.component for r in rows} == {x: find(x) for x in root} and len(rows) == len(root)
    assert components(Steps(spark), spark.createDataFrame([], "a bigint, b bigint")).collect() == []
