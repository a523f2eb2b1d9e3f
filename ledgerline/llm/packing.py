"""Packing documents into fixed windows: repeat counts of length combinations by non-negative least squares.

A document becomes full windows and one remainder. Remainders are counted by length in units; combinations
of up to three lengths that fill a window are enumerated, and non-negative least squares finds how often to
use each so that they use up the counts. The n-th remainder of a length goes to the n-th place that the
solution has for it, which needs only ranks, a distributed prefix sum. What is left is packed greedily.
"""

from __future__ import annotations

import functools
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import Steps, running_total
from ledgerline.llm.tokens import chunks, tokenizer_path, word_ids

WINDOW = 2048
UNIT = 8
END_ID = 1
# Left-over pieces may be cut at every GRID-th id: checksums of the parts follow from those kept at the grid.
GRID = 64
GREEDY_ROWS = 1 << 16

_PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, marks array<bigint>"
)


def pieces(docs: DataFrame, path: str, window: int = WINDOW) -> DataFrame:
    """Full windows and the remainder of every document, cut from its ids and an end id.

    ``marks`` holds a remainder's checksums of its first 64, 128, ... ids; it is empty for full windows.
    """

    def cut(batches):
        words = word_ids(path)
        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            texts = [text or b"" for text in batch.column("text").to_pylist()]
            for low, high in chunks(texts):
                rows = []
                flat, sizes = words.ids(texts[low:high])
                at = 0
                for doc_id, size in zip(doc_ids[low:high], sizes.tolist(), strict=True):
                    ids = np.append(flat[at : at + size], np.uint32(END_ID)).astype("<u4")
                    at += size
                    for start in range(0, size + 1, window):
                        piece = ids[start : start + window]
                        marks, crc = [], 0
                        if len(piece) < window:
                            for mark in range(0, len(piece) - 1, GRID):
                                if mark:
                                    crc = zlib.crc32(piece[mark - GRID : mark], crc)
                                    marks.append(crc)
                            crc = zlib.crc32(piece[len(marks) * GRID :], crc)
                        else:
                            crc = zlib.crc32(piece)
                        rows.append((doc_id, start, len(piece), crc, size + 1, marks))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, t) for column, t in zip(zip(*rows), _ARROW, strict=True)], names=_NAMES
                )

    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return source.mapInArrow(cut, _PIECES)


_ARROW = [pa.int64()] * 5 + [pa.list_(pa.int64())]
_PLACED = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
_NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "marks"]


def combinations(units: list[int], full: int) -> list[tuple[int, ...]]:
    """Up to three of the given lengths that add up to ``full``, largest first."""
    have = set(units)
    found = [(full,)] if full in have else []
    for a in sorted(have, reverse=True):
        if a < full and a >= full - a and full - a in have:
            found.append((a, full - a))
        for b in sorted(have, reverse=True):
            c = full - a - b
            if a >= b >= c > 0 and c in have:
                found.append((a, b, c))
    return found


def least_squares(matrix: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Non-negative ``x`` that minimises ``|matrix @ x - target|``, by the active-set method of Lawson and Hanson."""
    columns = matrix.shape[1]
    x = np.zeros(columns)
    active: list[int] = []
    tolerance = 1e-9 * max(1.0, float(np.abs(target).max(initial=0)))
    for _ in range(3 * matrix.shape[0]):
        gradient = matrix.T @ (target - matrix @ x)
        gradient[active] = -np.inf
        best = int(np.argmax(gradient)) if columns else 0
        if not columns or gradient[best] <= tolerance:
            break
        active.append(best)
        while True:
            solution = np.linalg.lstsq(matrix[:, active], target, rcond=None)[0]
            if (solution > 0).all():
                break
            old = x[active]
            falling = solution <= 0
            step = np.min(old[falling] / np.maximum(old[falling] - solution[falling], 1e-300))
            moved = old + step * (solution - old)
            x[:] = 0
            keep = [i for i, value in enumerate(moved) if value > tolerance * 1e-3]
            x[[active[i] for i in keep]] = moved[keep]
            if len(keep) == len(active):  # nothing fell: numerically at the bound
                keep = [i for i in keep if not falling[i]]
            active = [active[i] for i in keep]
            if not active:
                break
        x[:] = 0
        if not active:
            break
        x[active] = solution
    return x


def plan(counts: dict[int, int], full: int) -> tuple[list[tuple[int, int, int, int, int]], dict[int, int], int]:
    """Places for lengths: ``(units, first rank, end rank, first window, slot)``, ranks used per length, and windows."""
    units = sorted(counts)
    options = combinations(units, full)
    row = {unit: i for i, unit in enumerate(units)}
    matrix = np.zeros((len(units), len(options)))
    for j, option in enumerate(options):
        for unit in option:
            matrix[row[unit], j] += 1
    target = np.array([counts[unit] for unit in units], float)
    # Relative to the root of the counts, rare lengths matter as well as common ones.
    scale = 1 / np.sqrt(np.maximum(target, 1))
    x = least_squares(matrix * scale[:, None], target * scale)
    used = dict.fromkeys(units, 0)
    places, windows = [], 0
    for j in sorted(range(len(options)), key=lambda j: -x[j]):
        option = options[j]
        each = {unit: option.count(unit) for unit in option}
        repeats = min(int(x[j] + 0.5), *((counts[u] - used[u]) // n for u, n in each.items()))
        if repeats <= 0:
            continue
        for slot, unit in enumerate(option):
            places.append((unit, used[unit], used[unit] + repeats, windows, slot))
            used[unit] += repeats
        windows += repeats
    return places, used, windows


@functools.cache
def _shift() -> list[list[int]]:
    """Tables that carry a CRC-32 over ``GRID`` four-byte zeros, one per byte of the value."""
    zeros = bytes(4 * GRID)
    one = [zlib.crc32(zeros, 1 << bit) ^ zlib.crc32(zeros, 0) for bit in range(32)]
    tables = []
    for byte in range(4):
        table = [0] * 256
        for value in range(256):
            for bit in range(8):
                if value >> bit & 1:
                    table[value] ^= one[8 * byte + bit]
        tables.append(table)
    return tables


def part_crc(marks: list[int], whole: int, length: int, low: int, high: int) -> int:
    """Checksum of ids ``low..high`` of a piece from checksums of its beginnings; ``low`` lies on the grid, and
    ``high`` does or is the end."""
    to_high = whole if high == length else marks[high // GRID - 1]
    if not low:
        return to_high
    value = marks[low // GRID - 1]
    steps, rest = divmod(high - low, GRID)
    a, b, c, d = _shift()
    for _ in range(steps):
        value = a[value & 255] ^ b[value >> 8 & 255] ^ c[value >> 16 & 255] ^ d[value >> 24]
    # crc32(zeros, v) runs over the zeros from state v; the constant part of the checksum cancels out.
    value = zlib.crc32(bytes(4 * rest), value) ^ zlib.crc32(bytes(4 * rest), 0)
    return to_high ^ value


def greedy(rows: list[tuple], window: int) -> list[tuple]:
    """Packs ``(length, whole crc, marks)`` by best fit, longest first; pieces of windows that stay open by more
    than the grid are then laid end to end and cut there.

    Returns ``(row, low, high, crc, window number, offset)``.
    """
    space = [[] for _ in range(window + 1)]
    mask = 0
    bins: list[list[int]] = []
    left: list[int] = []
    for i in sorted(range(len(rows)), key=lambda i: (-rows[i][0], i)):
        length = rows[i][0]
        fitting = mask >> length
        if fitting:
            gap = length + (fitting & -fitting).bit_length() - 1
            number = space[gap].pop()
            if not space[gap]:
                mask &= ~(1 << gap)
        else:
            gap, number = window, len(bins)
            bins.append([])
            left.append(0)
        bins[number].append(i)
        left[number] = gap - length
        if left[number]:
            space[left[number]].append(number)
            mask |= 1 << left[number]
    out, number, loose = [], 0, []
    for members, gap in zip(bins, left, strict=True):
        if gap >= GRID:
            loose += members
            continue
        at = 0
        for i in members:
            out.append((i, 0, rows[i][0], rows[i][1], number, at))
            at += rows[i][0]
        number += 1
    at = 0
    for i in loose:
        length, whole, marks = rows[i]
        low = 0
        while low < length:
            high = length if length - low <= window - at else low + (window - at) // GRID * GRID
            if high > low:
                out.append((i, low, high, part_crc(marks, whole, length, low, high), number, at))
                at += high - low
                low = high
            if low < length:
                number, at = number + 1, 0
    return out


def pack(docs: DataFrame, path: str | None = None, window: int = WINDOW, unit: int = UNIT) -> DataFrame:
    """Pieces of all documents with their place: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    A null or empty text is its end id alone. Rows that repeat a document are packed each on its own. An
    empty table gives an empty result. Sequence numbers are unique but not without gaps.
    """
    steps = Steps(docs.sparkSession)
    spark = docs.sparkSession
    cut = steps.table(pieces(docs, path or tokenizer_path(), window))
    lengths = cut.select("*", F.ceil(F.col("length") / unit).cast("int").alias("units"))
    counts = {row[0]: row[1] for row in lengths.groupBy("units").count().collect()}
    places, used, windows = plan(counts, window // unit)
    ranked = running_total(
        steps, lengths, ["units"], ["doc_id", "start", "length", "ids_crc32"], {"rank": F.lit(1)}
    )
    # One row per length and combination in use: at most three times the number of lengths.
    listed = spark.createDataFrame(places, "units int, low bigint, high bigint, first bigint, slot int")
    after, rest = {}, 0
    for units in sorted(counts):
        after[units] = rest - used[units]
        rest += counts[units] - used[units]
    shift = spark.createDataFrame(list(after.items()), "units int, shift bigint")
    placed = steps.table(
        ranked.join(
            F.broadcast(listed), (ranked.units == listed.units) & (ranked.rank >= listed.low) & (ranked.rank < listed.high), "left"
        )
        .drop(listed.units)
        .join(F.broadcast(shift), "units", "left")
    )
    fits = placed.where("first IS NOT NULL").select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("first") + F.col("rank") - F.col("low")).alias("sequence_id"), "slot"
    )
    # A window holds at most three pieces.
    single = fits.where(F.col("length") == window).withColumn("offset", F.lit(0).cast("bigint")).drop("slot")
    shared = (
        fits.where(F.col("length") < window)
        .groupBy("sequence_id")
        .agg(F.array_sort(F.collect_list(F.struct("slot", "doc_id", "start", "length", "ids_crc32", "doc_tokens"))).alias("p"))
        .select("sequence_id", "p", F.posexplode("p").alias("i", "one"))
        .select(
            "one.doc_id", "one.start", "one.length", "one.ids_crc32", "one.doc_tokens", "sequence_id",
            F.aggregate(F.slice("p", F.lit(1), F.col("i")), F.lit(0).cast("bigint"), lambda s, x: s + x["length"]).alias("offset"),
        )
    )
    groups = max(1, -(-rest // GREEDY_ROWS))
    stride = -(-rest // groups) * 2 + 1  # windows of a group: at most one per piece, and one more when pieces are cut

    def remaining(table):
        table = table.sort_by([(name, "ascending") for name in ("doc_id", "start", "length", "ids_crc32")])
        column = {name: table.column(name).to_pylist() for name in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "marks")}
        first = windows + table.column("bucket")[0].as_py() * stride
        rows = list(zip(column["length"], column["ids_crc32"], column["marks"], strict=True))
        out = [
            (column["doc_id"][i], column["start"][i] + low, high - low, crc, column["doc_tokens"][i], first + number, at)
            for i, low, high, crc, number, at in greedy(rows, window)
        ]
        return pa.table([pa.array(values, pa.int64()) for values in zip(*out)], names=_PLACED)

    loose = (
        placed.where("first IS NULL")
        .withColumn("bucket", F.pmod(F.col("rank") + F.col("shift"), F.lit(groups)))
        .groupBy("bucket")
        .applyInArrow(remaining, "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, `offset` bigint")
    )
    return single.select(_PLACED).unionByName(shared.select(_PLACED)).unionByName(loose.select(_PLACED))
