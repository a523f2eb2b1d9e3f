import functools
import random
import zlib
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

from ledgerline.llm import packing
from ledgerline.llm.tokens import WordIds, tokenizer_path


@functools.cache
def tokenizer():
    return Tokenizer.from_file(tokenizer_path())


def ids_of(text):
    return [*tokenizer().encode(text or "", add_special_tokens=False).ids, 1]


def verify(rows, texts):
    """Every id in exactly one piece, checksums right, sequences gapless; returns the share of padding."""
    pieces = defaultdict(list)
    sequences = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(texts)
    for doc_id, text in texts.items():
        ids, at = ids_of(text), 0
        for r in sorted(pieces[doc_id], key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    padding = total = 0
    for members in sequences.values():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
        total += at
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    return padding / total


def test_word_ids_equal_whole_texts():
    rng = random.Random(1)
    alphabet = ["a", "B", "É", "é", "'s", "'ll", "12", "<|endoftext|>", "ß", "Σ", "漢", " ", " ", "\x1c", "!!", "\U0001f600", "İ"]
    texts = ["".join(rng.choice(alphabet) + rng.choice(["", " ", "\n", "\t\x0b", "\r\x0c"]) for _ in range(rng.randrange(0, 40))) for _ in range(400)]
    words = WordIds(tokenizer_path())
    for part in (texts[:200], texts[200:], texts[:50]):
        flat, sizes = words.ids([t.encode() for t in part])
        at = 0
        for text, size in zip(part, sizes):
            assert [*flat[at : at + size].tolist(), 1] == ids_of(text)
            at += size


def test_part_checksums():
    rng = np.random.default_rng(1)
    for length in (1, 63, 64, 65, 128, 700, 2047):
        ids = rng.integers(0, 49408, length).astype("<u4")
        marks = [zlib.crc32(ids[:m]) for m in range(64, length, 64)]
        for low in range(0, length, 64):
            for high in [*range(low + 64, length, 64), length]:
                assert packing.part_crc(marks, zlib.crc32(ids), length, low, high) == zlib.crc32(ids[low:high].tobytes())


def test_least_squares():
    rng = np.random.default_rng(2)
    for _ in range(20):
        matrix = rng.integers(0, 3, (12, 40)).astype(float)
        want = np.where(rng.random(40) < 0.2, rng.random(40) * 10, 0)
        x = packing.least_squares(matrix, matrix @ want)
        assert (x >= 0).all() and np.abs(matrix @ x - matrix @ want).max() < 1e-6
        noisy = rng.normal(size=12)
        x = packing.least_squares(matrix, noisy)
        gradient = matrix.T @ (matrix @ x - noisy)
        assert gradient.min() > -1e-6 and np.abs(gradient[x > 0]).max(initial=0) < 1e-6


def test_pack(documents):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgé") for _ in range(rng.randrange(1, 6)))
    texts = {i: " ".join(word() for _ in range(rng.choice([1, 5, 40, 300, 900, 2500]))) for i in range(300)}
    texts |= {400: None, 401: "", 402: "x " * 2047, 403: "x " * 60_000}
    assert verify(packing.pack(documents(list(texts.items()))).collect(), texts) < 0.03


def test_one_length_is_cut_to_fill(documents):
    texts = {i: "x " * 1499 for i in range(200)}
    assert verify(packing.pack(documents(list(texts.items()))).collect(), texts) < 0.03


def test_repeats_and_empty(documents):
    rows = packing.pack(documents([(1, "a b")] * 5)).collect()
    assert [r.length for r in rows] == [3] * 5 and len({(r.sequence_id, r.offset) for r in rows}) == 5
    assert packing.pack(documents([])).collect() == []
