"""Subword ids of whole texts, word by word.

The tokenizer never joins characters across blanks, so a text's ids are its words' ids one after the other,
and a bounded cache of words saves most of the work. Texts are handled as UTF-8 bytes: splitting bytes
splits at exactly the six ASCII blanks.
"""

from __future__ import annotations

import functools
import os

import numpy as np

CACHE_WORDS = 400_000
CHUNK_BYTES = 4 << 20
# Words are encoded many at a time, with this character between them; its id tells them apart.
MARK = "\x01"
TOGETHER = 256


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    """The words of this process: kept from task to task."""
    return WordIds(path)


class WordIds(dict):
    """Words numbered as they come, with their ids as slices of one array.

    Holds at most ``CACHE_WORDS`` and one chunk's words; beyond that the half used least is forgotten and the
    others get new numbers, which shows in ``generation``.
    """

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        mark = self.tokenizer.encode(f" {MARK} ", add_special_tokens=False).ids
        between = self.tokenizer.encode(f"a {MARK} b", add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 and between[1:-1] == mark else None
        self.new: list[bytes] = []
        self.generation = 0
        self.used = 0
        self.flat = np.empty(1 << 16, np.uint32)
        self.starts = np.empty(1 << 14, np.int64)
        self.sizes = np.empty(1 << 14, np.int64)
        self.hits = np.zeros(1 << 14, np.int64)

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number

    def forget(self) -> None:
        n = len(self)
        keep = np.sort(np.argsort(-self.hits[:n], kind="stable")[: CACHE_WORDS // 2])
        names = list(self)
        sizes = self.sizes[keep]
        ends = np.cumsum(sizes)
        flat = self.flat[np.repeat(self.starts[keep] - (ends - sizes), sizes) + np.arange(ends[-1])]
        self.clear()
        self.update((names[i], number) for number, i in enumerate(keep.tolist()))
        self.flat, self.used = flat, len(flat)
        self.starts, self.sizes, self.hits = ends - sizes, sizes, self.hits[keep]
        self.generation += 1

    def learn(self) -> None:
        """Looks up the ids of the words that came since the last call."""
        first, count = len(self) - len(self.new), len(self.new)
        self.starts, self.sizes = _room(self.starts, first, count), _room(self.sizes, first, count)
        self.hits = _room(self.hits, first, count)
        self.hits[first : first + count] = 0
        for at in range(0, count, 1 << 14):
            part = self.new[at : at + (1 << 14)]
            ids, sizes = self.encode([word.decode("utf-8", "replace") for word in part])
            low, high = first + at, first + at + len(part)
            self.flat = _room(self.flat, self.used, len(ids))
            self.flat[self.used : self.used + len(ids)] = ids
            self.sizes[low:high] = sizes
            self.starts[low:high] = self.used + np.cumsum(sizes) - sizes
            self.used += len(ids)
        self.new = []

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words in a row, and each word's number of ids."""
        if self.mark is None or any(MARK in word for word in words):
            found = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
            return np.array([i for ids in found for i in ids], np.uint32), np.array(list(map(len, found)), np.int64)
        lines = [f" {MARK} ".join([*words[at : at + TOGETHER], ""]) for at in range(0, len(words), TOGETHER)]
        found = self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, np.uint32) for e in found])
        marks = np.flatnonzero(ids == self.mark)
        return np.delete(ids, marks), np.diff(marks, prepend=-1) - 1

    def numbers(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers of all texts in a row, and each text's number of words."""
        if len(self) > CACHE_WORDS:
            self.forget()
        # A task that failed half-way may have left words behind that were never looked up.
        if self.new:
            self.learn()
        numbers: list[int] = []
        counts = np.empty(len(texts), np.int64)
        get = self.__getitem__
        for i, text in enumerate(texts):
            found = text.split()
            counts[i] = len(found)
            numbers.extend(map(get, found))
        if self.new:
            self.learn()
        numbers = np.array(numbers, np.int64)
        self.hits[: len(self)] += np.bincount(numbers, minlength=len(self))
        return numbers, counts

    def ids(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and each text's number of ids."""
        numbers, counts = self.numbers([_lowered(text) for text in texts])
        sizes = self.sizes[numbers]
        ends = np.concatenate(([0], np.cumsum(sizes)))
        ids = self.flat[np.repeat(self.starts[numbers] - ends[:-1], sizes) + np.arange(ends[-1])]
        bounds = np.concatenate(([0], np.cumsum(counts)))
        return ids, np.diff(ends[bounds])


def _lowered(text: bytes) -> bytes:
    """Lower case where the tokenizer would do the same: fewer different words. Not where composed characters
    may depend on case, nor where a special token might come about."""
    return text.lower() if text.isascii() and b"<|" not in text else text


def _room(array: np.ndarray, used: int, more: int) -> np.ndarray:
    if used + more <= len(array):
        return array
    bigger = np.empty(max(2 * len(array), used + more), array.dtype)
    bigger[:used] = array[:used]
    return bigger


def chunks(texts: list[bytes | None]):
    """Ranges of consecutive texts of a few megabytes together, or one longer text."""
    low = size = 0
    for i, text in enumerate(texts):
        more = len(text) if text else 0
        if i > low and size + more > CHUNK_BYTES:
            yield low, i
            low, size = i, 0
        size += more
    if low < len(texts):
        yield low, len(texts)
