import random

import numpy as np
import pytest

from ledgerline.llm import repeats


def brute(rows, span=100):
    """Kept bytes and number of spans per row; rows are (doc_id, text)."""
    first = {}
    order = sorted(((-(1 << 63) if d is None else d), (t or "").encode()) for d, t in rows)
    for doc, text in order:
        for s in range(len(text) - span + 1):
            w = text[s : s + span]
            first[w] = min(first.get(w, (doc, s)), (doc, s))
    hit = {}
    for doc, text in order:
        marks = hit.setdefault(doc, set())
        for s in range(len(text) - span + 1):
            if first[text[s : s + span]] != (doc, s):
                marks.update(range(s, s + span))
    out = []
    for doc, text in order:
        keep = [i not in hit[doc] for i in range(len(text))]
        spans = sum(not k and (i == 0 or keep[i - 1]) for i, k in enumerate(keep))
        out.append((doc, len(text), bytes(b for b, k in zip(text, keep) if k), spans))
    return sorted(out)


def got(df):
    return sorted((-(1 << 63) if r.doc_id is None else r.doc_id, r.n_bytes, bytes(r.kept), len(r.spans)) for r in df.collect())


def corpus(rng):
    chunk = lambda n: "".join(rng.choice("abcdé \n") for _ in range(n))
    shared = [chunk(n) for n in (40, 99, 100, 101, 108, 130, 260, 900)]
    rows = []
    for doc in range(70):
        text = "".join(rng.choice(shared) if rng.random() < 0.5 else chunk(rng.randrange(1, 150)) for _ in range(rng.randrange(0, 9)))
        if rng.random() < 0.1:
            text = "".join(rng.choice(["ab", "a", "xyz"]) for _ in range(1)) * rng.randrange(30, 300) + text
        rows.append((doc * 3 % 71, text))
    edited = list(rows[5][1] + shared[-1])
    for at in range(0, len(edited), 130):
        edited[at] = "#"
    rows += [(200, "".join(edited)), (201, rows[5][1] + shared[-1]), (202, None), (203, ""), (204, "z" * 5000), (205, "é" * 500)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(documents, monkeypatch, seed):
    rows = corpus(random.Random(seed))
    assert got(repeats.dedup(documents(rows))) == brute(rows)


def test_segments_of_long_texts(documents, monkeypatch):
    rng = random.Random(9)
    chunk = lambda n: "".join(rng.choice("abcd ") for _ in range(n))
    long = chunk(5 * repeats.SEGMENT // 4)
    piece = long[repeats.SEGMENT - 576 : repeats.SEGMENT + 924]  # across the border of two segments
    rows = [(1, long), (2, chunk(500) + piece + chunk(300)), (3, piece[7:])]
    out = {r.doc_id: r for r in repeats.dedup(documents(rows)).collect()}
    assert out[1].n_removed == 0
    spans = [(s.start, s.end) for s in out[2].spans]
    assert len(spans) == 1 and spans[0][0] in range(490, 501) and spans[0][1] in range(2000, 2010)
    assert out[3].n_removed == 1493


def test_same_doc_id_null_and_empty(documents):
    text = "".join(random.Random(3).choice("abcdef") for _ in range(300))
    rows = [(1, text), (1, text), (2, text + "x"), (None, text[:150])]
    assert got(repeats.dedup(documents(rows))) == brute(rows)
    assert repeats.dedup(documents([])).collect() == []


def test_different_texts_of_one_doc_id(documents):
    """A passage is cut from the row that repeats it, not from others with its id, null or not."""
    rng = random.Random(8)
    text = lambda n: "".join(rng.choice("abcdef") for _ in range(n))
    passage = text(200)
    for same in (5, None):
        clean, again = text(400), "#" * 20 + passage + "#" * 20
        rows = [(-(1 << 62) if same else same, passage), (same, clean), (same, again), (9, clean[:300])]
        out = {(r.doc_id, r.n_bytes): (r.n_removed, bytes(r.kept).decode()) for r in repeats.dedup(documents(rows)).collect()}
        assert out[same, 400] == (0, clean) and out[9, 300] == (300, "")
        assert sorted((out[rows[0][0], 200][0], out[same, 240][0])) == [0, 200]


def test_windows_of_equal_content_share_their_anchor():
    rng = np.random.default_rng(1)
    passage = rng.integers(97, 110, 500).astype(np.uint8)
    a = np.concatenate([rng.integers(97, 110, 333).astype(np.uint8), passage])
    found = []
    for data in (a, passage):
        gram, run, low, n, _, at = repeats.runs(data, np.array([0, len(data)]), 100)
        found.append({int(l) + int(d) - (333 if data is a else 0): int(g) for g, l, d in zip(gram, low, at)})
    assert all(found[0].get(place) == gram for place, gram in found[1].items())


def test_merged_spans():
    low, high = repeats.merged_spans(np.array([5, 0, 20, 9]), np.array([10, 3, 30, 20]))
    assert low.tolist() == [0, 5] and high.tolist() == [3, 30]
