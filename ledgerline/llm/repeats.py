"""Exact repeats across a corpus: every byte under a window of bytes that also starts earlier is removed.

Depth-limited radix sort by most significant digits. The suffixes of interest are those with at least a
window's bytes left, compared through that depth only. A digit is a hash of a stretch of the window:

1. the window's *anchor*, its 24-byte stretch with the least hash. Equal windows have equal anchors at equal
   places, and consecutive windows mostly share one, so a run of some 39 windows is one row here. Anchors
   found once are done: their windows are unique.
2. the run, that is all bytes of the windows that share an anchor. Of equal runs only the first can hold a
   first occurrence; all windows of the others are repeats.
3. the whole window, for first runs whose anchor also has other runs, which are few: mostly the two ends of
   a repeated passage.

Each pass groups by the digits so far with counts and minima that combine before the shuffle, so an anchor
or window that a third of the corpus shares costs one row per task. Equal groups after the last pass are the
repeated windows; the earliest (document, start) stays.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import Steps, with_text_keys

SPAN = 100
GRAM = 24
# Bytes looked at together. Longer texts are taken in segments that overlap by a window less one.
SEGMENT = 1 << 18

_U = np.uint64
_BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)  # odd: they have inverses modulo 2^64
_POSITION = 24


@functools.cache
def _values(which: int) -> np.ndarray:
    """A 64-bit value for each byte."""
    return np.frombuffer(b"".join(hashlib.blake2b(bytes([which, b]), digest_size=8).digest() for b in range(256)), "<u8")


@functools.cache
def _powers(which: int) -> tuple[np.ndarray, np.ndarray]:
    base = _BASES[which]
    tables = []
    for b in (base, pow(base, -1, 1 << 64)):
        table = np.full(SEGMENT + 1, b, _U)
        table[0] = 1
        tables.append(np.multiply.accumulate(table))
    return tables[0], tables[1]


class Stretches:
    """Hashes of any stretches of up to ``SEGMENT`` bytes, from prefix sums of a polynomial modulo 2^64."""

    def __init__(self, data: np.ndarray, which: int):
        powers, self.inverse = _powers(which)
        self.prefix = np.zeros(len(data) + 1, _U)
        np.cumsum(_values(which)[data] * powers[: len(data)], out=self.prefix[1:])

    def of(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return mixed((self.prefix[high] - self.prefix[low]) * self.inverse[low])

    def grams(self, length: int) -> np.ndarray:
        """Of every stretch of this length."""
        count = len(self.prefix) - length
        return mixed((self.prefix[length:] - self.prefix[:count]) * self.inverse[:count])


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _U(32))
    x *= _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(29)
    x *= _U(0xA0761D6478BD642F)
    x ^= x >> _U(32)
    return x


def runs(data: np.ndarray, bounds: np.ndarray, span: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: anchor's hash, run's hash, first window, number of windows, text number,
    anchor's distance from the first window's start.

    ``bounds`` are the places where the texts laid end to end in ``data`` begin and end.
    """
    sizes = np.diff(bounds)
    windows = np.maximum(sizes - span + 1, 0)
    total = int(windows.sum())
    if not total:
        empty = np.empty(0, np.int64)
        return empty, empty, empty, empty, empty, empty
    stretches = Stretches(data, 0)
    grams = stretches.grams(GRAM)
    # Hash above, place below: the least value names the leftmost of equal anchors.
    best = (grams >> _U(_POSITION) << _U(_POSITION)) | np.arange(len(grams), dtype=_U)
    width, have = span - GRAM + 1, 1
    while 2 * have <= width:
        best = np.minimum(best[:-have], best[have:])
        have *= 2
    if have < width:
        best = np.minimum(best[: len(best) - (width - have)], best[width - have :])
    text = np.repeat(np.arange(len(sizes)), windows)
    before = np.cumsum(windows) - windows
    start = np.arange(total) - before[text] + bounds[:-1][text]
    anchor = (best[start] & _U((1 << _POSITION) - 1)).astype(np.int64)
    new = np.empty(total, bool)
    new[0] = True
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, total))
    low = start[first]
    run = stretches.of(low, low + count + span - 1)
    return grams[anchor[first]].view(np.int64), run.view(np.int64), low, count, text[first], anchor[first] - low


def segments(texts: list[bytes], span: int):
    """Groups of ``(text number, offset, bytes)`` of up to ``SEGMENT`` bytes together."""
    group, size = [], 0
    for number, text in enumerate(texts):
        for at in range(0, max(1, len(text) - span + 1), SEGMENT - span + 1):
            part = text[at : at + SEGMENT]
            if len(part) < span:
                continue
            if size + len(part) > SEGMENT:
                yield group
                group, size = [], 0
            group.append((number, at, part))
            size += len(part)
    if group:
        yield group


def laid_out(group) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(b"".join(part for _, _, part in group), np.uint8)
    return data, np.concatenate(([0], np.cumsum([len(part) for _, _, part in group])))


BLOCK = 8  # windows of one block differ in at most 7 bytes at either end, which fit into a long integer


def anchors(docs: DataFrame, span: int) -> DataFrame:
    """Each anchor's hash with its number of runs, summed up per segment."""

    def count(batches):
        for batch in batches:
            texts = [text or b"" for text in batch.column("text").to_pylist()]
            for group in segments(texts, span):
                gram, n = np.unique(runs(*laid_out(group), span)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(n)], names=["gram", "n"])

    return docs.select("text").mapInArrow(count, "gram bigint, n bigint")


_RUN = ["gram", "run", "doc", "low", "n", "at"]


def all_runs(docs: DataFrame, span: int) -> DataFrame:
    """Runs: anchor and run hash, document, first window's start, number of windows, anchor's distance from the start."""

    def find(batches):
        for batch in batches:
            ids = batch.column("doc").to_numpy(zero_copy_only=False)
            texts = [text or b"" for text in batch.column("text").to_pylist()]
            for group in segments(texts, span):
                data, bounds = laid_out(group)
                gram, run, low, n, part, at = runs(data, bounds, span)
                number = np.array([g[0] for g in group])[part]
                offset = np.array([g[1] for g in group])[part]
                start = low - bounds[:-1][part] + offset
                columns = [gram, run, ids[number].astype(np.int64), start, n.astype(np.int32), at.astype(np.int32)]
                yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=_RUN)

    return docs.mapInArrow(find, "gram bigint, run bigint, doc bigint, low bigint, n int, at int")


_BLOCK = ["core", "left", "right", "j_low", "j_high", "doc", "low", "n"]


def blocks(wanted: DataFrame, docs: DataFrame, span: int) -> DataFrame:
    """Runs cut into blocks: the hash of the bytes common to a block's windows, and the bytes around them.

    A window that starts ``j`` bytes before the core takes ``j`` bytes of ``left`` and ``BLOCK - 1 - j`` of
    ``right``, which are packed from the core outwards.
    """
    edge = BLOCK - 1
    core_length = span - edge

    def cut(batches):
        for batch in batches:
            ids = batch.column("doc").to_numpy(zero_copy_only=False)
            texts = batch.column("text").to_pylist()
            lists = batch.column("runs")
            counts = np.array([len(x) for x in lists], np.int64)
            flat = lists.flatten()
            low, n, at = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(3))
            number = np.repeat(np.arange(len(texts)), counts)
            length = n.astype(np.int64) + span - 1
            ends = np.cumsum(length)
            cuts = [0]
            while cuts[-1] < len(length):
                done = ends[cuts[-1] - 1] if cuts[-1] else 0
                cuts.append(max(cuts[-1] + 1, int(np.searchsorted(ends, done + SEGMENT, "right"))))
            for a, b in zip(cuts, cuts[1:]):
                data = np.frombuffer(
                    b"".join(texts[i][s : s + k] for i, s, k in zip(number[a:b].tolist(), low[a:b].tolist(), length[a:b].tolist())),
                    np.uint8,
                )
                yield emit(data, ids[number[a:b]], low[a:b], n[a:b].astype(np.int64), at[a:b].astype(np.int64), length[a:b])

    def emit(data, doc, low, n, at, length):
        base = np.cumsum(length) - length
        last, first = at // BLOCK, (at - n + 1) // BLOCK
        each = last - first + 1
        run = np.repeat(np.arange(len(n)), each)
        block = np.arange(len(run)) - (np.cumsum(each) - each)[run] + first[run]
        far = np.minimum(at[run] - block * BLOCK, edge)  # greatest distance of a start from the core
        near = np.maximum(at[run] - n[run] + 1 - block * BLOCK, 0)
        core = base[run] + at[run] - block * BLOCK
        digit = mixed(Stretches(data, 1).of(core, core + core_length) + block.astype(_U) * _U(_BASES[0]))
        left, right = np.zeros(len(run), np.int64), np.zeros(len(run), np.int64)
        for i in range(edge):
            left |= np.where(i < far, data[np.maximum(core - 1 - i, 0)].astype(np.int64) << 8 * i, 0)
            right |= np.where(i < edge - near, data[np.minimum(core + core_length + i, len(data) - 1)].astype(np.int64) << 8 * i, 0)
        start = low[run] + at[run] - block * BLOCK - far
        columns = [digit.view(np.int64), left, right, near.astype(np.int32), far.astype(np.int32), doc[run].astype(np.int64), start, (far - near + 1).astype(np.int32)]
        return pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=_BLOCK)

    listed = wanted.groupBy("doc").agg(F.collect_list(F.struct("low", "n", "at")).alias("runs"))
    return docs.join(listed.hint("merge"), "doc").select("doc", "text", "runs").mapInArrow(
        cut, "core bigint, `left` bigint, `right` bigint, j_low int, j_high int, doc bigint, low bigint, n int"
    )


def settle(rows: DataFrame, digits: list[str], rest: list[str], carried: list[str]) -> tuple[DataFrame, DataFrame]:
    """One pass over rows of ``n`` windows: those that equal an earlier row, and first ones that stay open.

    Rows are equal if ``digits`` and ``rest`` are. A first row is open if others have its digits but not its rest.
    """
    # Grouped by a struct, the classes are dealt anew for the join, so that a hot class can be split there.
    equal = (
        rows.groupBy(F.struct(*digits, *rest).alias("_k"))
        .agg(F.min(F.struct("doc", "low", *carried)).alias("first"), F.count(F.lit(1)).alias("_n"))
        .select("_k.*", "first", "_n")
    )
    later = (
        rows.join(equal.where("_n > 1"), [*digits, *rest])
        .where((F.col("doc") != F.col("first.doc")) | (F.col("low") != F.col("first.low")))
        .select("doc", "low", "n")
    )
    several = equal.groupBy(*digits).agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1").select(*digits)
    return later, equal.join(several, digits, "left_semi").select(*digits, *rest, "first.*")


def repeated_windows(steps: Steps, docs: DataFrame, span: int = SPAN) -> DataFrame:
    """Runs ``doc, low, n`` of windows (starts ``low`` to ``low + n - 1``) that also start earlier; runs may overlap."""
    found_twice = anchors(docs, span).groupBy("gram").agg(F.sum("n").alias("_n")).where("_n > 1").select("gram")
    grams = steps.table(found_twice)
    candidates = steps.table(all_runs(docs, span).join(grams, "gram"))
    steps.free(grams)
    later, open_ = settle(candidates, ["gram"], ["run"], ["n", "at"])
    later_runs, wanted = steps.table(later), steps.table(open_.select("doc", "low", "n", "at"))
    steps.free(candidates)
    cut = steps.table(blocks(wanted, docs, span))
    steps.free(wanted)
    later, open_ = settle(cut, ["core"], ["left", "right", "j_low", "j_high"], ["n"])
    later_blocks, wanted = steps.table(later), steps.table(open_)
    steps.free(cut)
    single = wanted.withColumn("j", F.explode(F.sequence("j_low", "j_high"))).select(
        "core",
        "j",
        F.expr("`left` & (shiftleft(1L, 8 * j) - 1)").alias("l"),
        F.expr(f"`right` & (shiftleft(1L, 8 * ({BLOCK - 1} - j)) - 1)").alias("r"),
        "doc",
        (F.col("low") + F.col("j_high") - F.col("j")).alias("low"),
        F.lit(1).alias("n"),
    )
    later_windows = steps.table(settle(single, ["core", "j"], ["l", "r"], [])[0])
    steps.free(wanted)
    return later_runs.unionByName(later_blocks).unionByName(later_windows)


def merged_spans(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of stretches as maximal runs."""
    order = np.argsort(low, kind="stable")
    low, high = low[order], np.maximum.accumulate(high[order])
    new = np.ones(len(low), bool)
    new[1:] = low[1:] > high[:-1]
    at = np.flatnonzero(new)
    return low[at], high[np.append(at[1:] - 1, len(low) - 1)] if len(low) else high


def dedup(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """Documents without their repeated bytes: ``doc_id, n_bytes, spans, n_removed, kept`` (kept as binary).

    A byte goes if a window of ``span`` bytes over it also starts earlier: in a document with a smaller
    ``doc_id``, or earlier in the same one. A null text is empty; a null ``doc_id`` is the smallest. Rows that
    share both ``doc_id`` and text are one place in this order: none of them is earlier than the other. Different
    texts under one ``doc_id`` are documents of their own, in the order of their digests. An empty table gives an
    empty result. ``spans`` lists the maximal removed stretches as (start, end); the kept bytes need not be valid
    UTF-8, since a cut may fall within a character.
    """
    steps = Steps(docs.sparkSession)
    keyed = with_text_keys(steps, docs.select("doc_id", "text"), "doc")
    found = removed(steps, keyed.select("doc", F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text")), span)
    return found.drop("doc")


def removed(steps: Steps, source: DataFrame, span: int = SPAN) -> DataFrame:
    """``dedup`` of ``doc, doc_id, text`` in the order of ``doc``, which is kept beside ``doc_id``."""
    if span < GRAM + BLOCK:
        raise ValueError(f"a window has at least {GRAM + BLOCK} bytes")
    later = repeated_windows(steps, source, span)
    listed = later.groupBy("doc").agg(F.collect_list(F.struct("low", "n")).alias("found"))

    def remove(batches):
        for batch in batches:
            rows = []
            for doc, own, text, found in zip(*(batch.column(c) for c in ("doc", "doc_id", "text", "found"))):
                text = text.as_py() or b""
                if found.is_valid:
                    values = found.values
                    low = values.field(0).to_numpy(zero_copy_only=False).astype(np.int64)
                    high = low + values.field(1).to_numpy(zero_copy_only=False) + span - 1
                    low, high = merged_spans(np.minimum(low, len(text)), np.minimum(high, len(text)))
                    spans = [(a, b) for a, b in zip(low.tolist(), high.tolist()) if b > a]
                else:
                    spans = []
                kept = b"".join(text[a:b] for a, b in zip([0, *(b for _, b in spans)], [*(a for a, _ in spans), len(text)]))
                rows.append((doc.as_py(), own.as_py(), len(text), spans, len(text) - len(kept), kept))
            if rows:
                yield pa.RecordBatch.from_pylist(
                    [
                        {"doc": d, "doc_id": o, "n_bytes": n, "spans": [{"start": a, "end": b} for a, b in s], "n_removed": r, "kept": k}
                        for d, o, n, s, r, k in rows
                    ],
                    schema=_RESULT,
                )

    return source.join(listed.hint("merge"), "doc", "left").mapInArrow(
        remove, "doc bigint, doc_id bigint, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, n_removed bigint, kept binary"
    )


_RESULT = pa.schema(
    [
        ("doc", pa.int64()),
        ("doc_id", pa.int64()),
        ("n_bytes", pa.int64()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        ("n_removed", pa.int64()),
        ("kept", pa.binary()),
    ]
)

CHECK = r"""
WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
starts AS (SELECT doc_id, h, unnest(range(greatest(length(h) // 2 - 99, 0))) AS s FROM texts),
windows AS (SELECT doc_id, s, md5_number(substr(h, 2 * s + 1, 200)) AS w FROM starts),
firsts AS (SELECT w, min((doc_id::HUGEINT << 40) + s) AS f FROM windows GROUP BY w HAVING count(*) > 1),
later AS (
  SELECT doc_id, s FROM windows JOIN firsts USING (w) WHERE (doc_id::HUGEINT << 40) + s <> f),
marked AS (
  SELECT doc_id, s, CASE WHEN s <= lag(s + 100) OVER (PARTITION BY doc_id ORDER BY s) THEN 0 ELSE 1 END AS new FROM later),
spans AS (
  SELECT doc_id, min(s) AS a, max(s) + 100 AS b
  FROM (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY s) AS g FROM marked) GROUP BY doc_id, g),
kept AS (
  SELECT doc_id, substr(h, 2 * coalesce(lag(b) OVER w, 0) + 1, 2 * (a - coalesce(lag(b) OVER w, 0))) AS part, a
  FROM spans JOIN texts USING (doc_id) WINDOW w AS (PARTITION BY doc_id ORDER BY a)),
ended AS (
  SELECT doc_id, string_agg(part, '' ORDER BY a) AS front, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last
  FROM kept JOIN spans USING (doc_id, a) GROUP BY doc_id)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(front, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM texts LEFT JOIN ended USING (doc_id)
"""
