import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerline.llm import classifier, mixing

from . import test_packing, test_repeats

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows before the first and after every stage."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = {"documents": docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(str(folder / name))
        docs = spark.read.parquet(str(folder / name))
        out[name] = docs.collect()
    return out


def test_names_and_columns(stages):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "minhash_near_dedup", "suffix_repeats", "mixing", "packing"]
    assert all(list(stages[n][0].asDict()) == COLUMNS for n in names[:-1])


def test_quality_keeps_what_scores_well(spark, stages):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    want = {r.doc_id for r in classifier.classify(docs, labels).collect() if r.predicted}
    assert {r.doc_id for r in stages["quality_classifier"]} == want
    quality = {r.doc_id: r.quality for r in labels.collect()}
    kept = Counter(quality[d] for d in want if d in quality)
    assert kept[1] > 0.95 * sum(quality.values()) and kept[0] <= 2
    assert {r for r in stages["quality_classifier"]} <= set(stages["documents"])


def test_near_duplicates_against_brute_force(stages):
    rows = [(r.doc_id, r.text) for r in stages["quality_classifier"]]
    sets = {}
    for doc, text in rows:
        w = text.encode().lower().split()
        size = min(5, len(w))
        sets[doc] = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if w else set()
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a in sets:
        for b in sets:
            common = len(sets[a] & sets[b]) if a < b else 0
            if common and 100 * common >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert sorted(r.doc_id for r in stages["minhash_near_dedup"]) == sorted(d for d in sets if find(d) == d)
    assert len(sets) > len(stages["minhash_near_dedup"])


def test_repeats_against_brute_force(stages):
    rows = [(r.doc_id, r.text) for r in stages["minhash_near_dedup"]]
    want = {d: kept.decode("utf-8", "ignore") for d, _, kept, _ in test_repeats.brute(rows)}
    got = {r.doc_id: r.text for r in stages["suffix_repeats"]}
    before = dict(rows)
    assert got == {d: t for d, t in want.items() if t == before[d] or WORD.search(t)}
    assert got != before


def test_mix_meets_budgets(spark, stages):
    docs = spark.createDataFrame(stages["suffix_repeats"])
    target = {r.source: int(r.target) for r in mixing.mix(docs).collect()}
    words = defaultdict(int)
    for r in stages["mixing"]:
        words[r.source] += len(WORD.findall(r.text))
    assert dict(words) == {s: t for s, t in target.items() if t}


def test_packing_of_the_mix(stages):
    rows, texts = stages["packing"], Counter()
    for r in stages["mixing"]:
        texts[r.doc_id, len(test_packing.ids_of(r.text))] += len(test_packing.ids_of(r.text))
    packed = Counter()
    for r in rows:
        packed[r.doc_id, r.doc_tokens] += r.length
    assert packed == texts
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    used = 0
    for members in places.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        used += at
        assert at <= 2048
    assert used > 0.97 * 2048 * (len(places) - 1)


def test_run_gives_the_last_stage(spark, stages):
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    key = lambda r: (r.doc_id, r.start, r.length, r.ids_crc32)
    assert sorted(map(key, rows)) == sorted(map(key, stages["packing"]))


def test_odd_input(spark, documents):
    odd = documents([(1, None, None), (2, "", "a"), (None, "x y z", "a"), (None, "x y z", "a"), (3, "x y z", "a"), (3, "x y z", "b"), (4, "w " * 50_000, "b")])
    for docs in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, FOLDER)
            rows = out.collect()
            if name != "packing":
                assert out.columns == docs.columns
            if docs is not odd:
                assert rows == []
    near = corpus_pipeline.near_duplicates(spark, odd, FOLDER).collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0) for r in near) == [(False, 0), (True, 1), (True, 2), (True, 4)]



def test_columns_with_clashing_names_pass_through(spark, documents):
    """Extra columns named like anything inside a stage come out as they went in."""
    names = ["own", "row", "doc", "kept", "_own", "_mark", "_tie", "_id", "_kept", "_share", "_of", "_words", "_part", "taken", "target", "predicted", "a.b"]
    rows = [(i, f"{w} " * 3 + " ".join(f"{w}{j}" for j in range(60)), "st"[i % 2]) for i, w in enumerate(["alpha", "beta", "gamma", "alpha", "delta"])]
    rows.append((9, rows[0][1] + " more words", "s"))
    for docs in (documents(rows), documents([*rows, (1, "shares an id " * 20, "s")])):
        docs = docs.select("*", *[F.concat(F.lit(f"{n} "), F.col("doc_id").cast("string")).alias(n) for n in names])
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, FOLDER)
            got = out.collect()
            if name != "packing":
                assert out.columns == docs.columns
                assert name == "quality_classifier" or got
                assert all(r[n] == f"{n} {r.doc_id}" for r in got for n in names)


def test_rows_that_share_an_id_are_documents(spark, documents):
    """Null and repeated ids with different texts: nothing goes but near copies, repeats and what no budget covers."""
    text = lambda name, n: " ".join(f"{name}{i}" for i in range(n))
    rows = [(None, text("a", 60), "a"), (None, text("b", 50), "b"), (None, text("b", 50), "b"), (7, text("c", 60), "a"), (7, text("d", 40), "b")]
    rows += [(8, text("e", 30) + " " + text("c", 60) + " " + text("f", 60), "a")]
    docs = documents(rows)
    near = corpus_pipeline.near_duplicates(spark, docs, FOLDER).cache()
    assert sorted(r.text for r in near.collect()) == sorted({r[1] for r in rows})
    left = corpus_pipeline.repeated_passages(spark, near, FOLDER).cache()
    texts = {r.text for r in left.collect()}
    assert {r[1] for r in rows[:5]} < texts and len(texts) == 5
    (cut,) = texts - {r[1] for r in rows}
    assert text("e", 29) in cut and text("c", 60) not in cut and text("f", 60)[9:] in cut
    target = {r.source: int(r.target) for r in mixing.mix(left).collect()}
    words = defaultdict(int)
    for r in corpus_pipeline.mixed(spark, left, FOLDER).collect():
        words[r.source] += len(WORD.findall(r.text))
    assert dict(words) == target
