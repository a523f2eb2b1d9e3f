"""Near-duplicates by an LSH forest: neighbours in several sorted orders of min-hash signatures.

Equal shingle sets are one class from the start, however many copies there are. Each class has a signature
of 64 one-byte min-hashes, and each tree of the forest sorts all classes by the signature read from another
place on. Classes that agree in the first bytes are neighbours there; in dense regions the order goes on to
deeper bytes, so the nearest in line are those with the longest common prefix. Candidates with too few
bytes in common are dropped; the others are confirmed on their full shingle sets.

In a region of more classes than are looked at in line, pairs can stand too far apart in every order. Classes
of such regions that are not yet one component also meet in an exact join on the prefixes of their sets.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import Steps
from ledgerline.llm.components import components
from ledgerline.llm.tokens import chunks

BYTES = 64
TREES = 16
STEP = BYTES // TREES
# A pair of similarity 0.8 agrees in three given min-hashes with probability 0.51: some tree of 16 has it with
# 1 - 1e-5, one of similarity 0.85 with 1 - 3e-7.
DEPTH = 3
# Candidates agree in so many of the 64 at least: 4.5 standard deviations below what is expected at the threshold.
SPREAD = 4.5
# Neighbours looked at in line. Regions of more classes are completed by ``overlapping``, so this cuts nothing off.
REACH = 16
NEAR = 1
ROWS_EACH = 200_000
# Slots that counts of shingles are summed in, to tell frequent from rare ones; they only set an order.
SLOT_BITS = 20
# Rows of one shingle that meet in one place.
BLOCK = 1000
CACHE_WORDS = 300_000

_U = np.uint64
_LEAST_ID = -(1 << 63)


class WordHashes(dict):
    """64-bit hashes of words, cached by number."""

    def __init__(self):
        super().__init__()
        self.values_ = np.empty(1 << 14, _U)

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        if number == len(self.values_):
            self.values_ = np.concatenate([self.values_, np.empty_like(self.values_)])
        self.values_[number] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return number

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > CACHE_WORDS:
            self.clear()
        numbers = np.array(list(map(self.__getitem__, words)), np.int64)
        return self.values_[numbers]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _U(31))
    x *= _U(0x7FB5D329728EA185)
    x ^= x >> _U(27)
    x *= _U(0x81DADEF4BC2DD44D)
    x ^= x >> _U(33)
    return x


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of runs of ``size`` words; of all words if there are fewer; none without words."""
    if not len(hashes):
        return hashes
    size = min(size, len(hashes))
    count = len(hashes) - size + 1
    out = np.full(count, size, _U)
    for i in range(size):
        out = _mixed(out * _U(0x9E3779B97F4A7C15) + hashes[i : i + count])
    return np.unique(out)


_FACTORS = np.frombuffer(hashlib.shake_128(b"min-hash factors").digest(8 * BYTES), "<u8") | _U(1)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One byte of each of 64 min-hashes per non-empty set."""
    out = np.empty((len(sets), BYTES), np.uint8)
    low = 0
    while low < len(sets):
        high, size = low, 0
        while high < len(sets) and (high == low or size + len(sets[high]) <= 1 << 15):
            size += len(sets[high])
            high += 1
        flat = np.concatenate(sets[low:high])
        starts = np.concatenate(([0], np.cumsum([len(s) for s in sets[low : high - 1]], dtype=np.int64))).astype(np.int64)
        for k in range(BYTES):
            least = np.minimum.reduceat(flat * _FACTORS[k], starts)
            out[low:high, k] = (_mixed(least) >> _U(56)).astype(np.uint8)
        low = high
    return out


def _sets(texts: list[bytes], words: WordHashes, size: int) -> list[np.ndarray]:
    split = [text.lower().split() for text in texts]  # of bytes: lowers A-Z, splits at the six blanks
    flat = words.of([w for part in split for w in part])
    bounds = np.concatenate(([0], np.cumsum([len(part) for part in split], dtype=np.int64))).astype(np.int64)
    return [shingles(flat[a:b], size) for a, b in zip(bounds, bounds[1:])]


def signed(docs: DataFrame, size: int) -> DataFrame:
    """``doc, n, digest, signature`` per row; digest and signature are null for empty sets."""

    def sign(batches):
        words = WordHashes()
        for batch in batches:
            ids = batch.column("doc").to_pylist()
            texts = [text or b"" for text in batch.column("text").to_pylist()]
            for low, high in chunks(texts):
                sets = _sets(texts[low:high], words, size)
                full = [s for s in sets if len(s)]
                rows = iter(signatures(full)) if full else iter(())
                digests, marks = [], []
                for s in sets:
                    digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                    marks.append(next(rows).tobytes() if len(s) else None)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[low:high], pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()), pa.array(marks, pa.binary())],
                    names=["doc", "n", "digest", "signature"],
                )

    return docs.mapInArrow(sign, "doc bigint, n bigint, digest binary, signature binary")


def least_common(percent: int) -> int:
    share = percent / 100
    return int(BYTES * share - SPREAD * (BYTES * share * (1 - share)) ** 0.5)


def _pairs(tree: np.ndarray, key: np.ndarray, node: np.ndarray, least: int, first: int = 0) -> tuple[np.ndarray, ...]:
    """Neighbours among sorted rows: nodes and distance in line. With ``first``, only pairs across that row."""
    prefix = tree.astype(np.int64)
    for i in range(DEPTH):
        prefix = prefix << 8 | key[:, i]
    left, right, far = [], [], []
    for step in range(1, REACH + 1):
        near = np.flatnonzero(prefix[:-step] == prefix[step:])
        if not len(near):
            break
        if first:
            near = near[(near < first) & (near + step >= first)]
        for at in range(0, len(near), 1 << 16):
            i = near[at : at + (1 << 16)]
            i = i[(key[i] == key[i + step]).sum(1) >= least]
            left.append(np.minimum(node[i], node[i + step]))
            right.append(np.maximum(node[i], node[i + step]))
            far.append(np.full(len(i), step, np.int32))
    if not left:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int32)
    return np.concatenate(left), np.concatenate(right), np.concatenate(far)


_EDGE = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("step", pa.int32()), ("border", pa.int32()), ("place", pa.int32()), ("tree", pa.int32()), ("key", pa.binary())])
_EDGE_SQL = "a bigint, b bigint, step int, border int, place int, tree int, key binary"


def candidates(steps: Steps, classes: DataFrame, percent: int = 85) -> DataFrame:
    """Pairs of neighbouring classes in any tree: ``a, b, step`` (least distance in line)."""
    rows = classes.select(
        F.col("rep").alias("node"),
        F.posexplode(
            F.array(*[F.concat(F.substring("signature", 1 + t * STEP, BYTES), F.substring("signature", 1, t * STEP)) for t in range(TREES)])
        ).alias("tree", "key"),
    )
    total = classes.count() * TREES
    least = least_common(percent)
    ordered = rows.repartitionByRange(max(1, -(-total // ROWS_EACH)), "tree", "key", "node").sortWithinPartitions("tree", "key", "node")

    def neighbours(batches):
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        table = pa.Table.from_batches(parts)
        node, tree = (table.column(c).to_numpy() for c in ("node", "tree"))
        key = np.frombuffer(b"".join(table.column("key").to_pylist()), np.uint8).reshape(-1, BYTES)
        a, b, far = _pairs(tree, key, node, least)
        for at in range(0, len(a), 1 << 16):
            cut = slice(at, at + (1 << 16))
            empty = pa.nulls(len(a[cut]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(a[cut]), pa.array(b[cut]), pa.array(far[cut]), empty, empty, empty, pa.nulls(len(a[cut]), pa.binary())], schema=_EDGE
            )
        # Rows at either end meet the next partition's: border p lies before partition p.
        me, n = TaskContext.get().partitionId(), len(node)
        ends = [(i, me, REACH + i) for i in range(min(REACH, n))] + [(i, me + 1, i - n + REACH) for i in range(max(0, n - REACH), n)]
        yield pa.RecordBatch.from_pylist(
            [
                {"a": int(node[i]), "b": None, "step": None, "border": border, "place": place, "tree": int(tree[i]), "key": key[i].tobytes()}
                for i, border, place in ends
            ],
            schema=_EDGE,
        )

    found = steps.table(ordered.mapInArrow(neighbours, _EDGE_SQL))

    def across(frame):
        import pandas as pd

        frame = frame.sort_values("place")
        first = int((frame["place"] < REACH).sum())
        if not 0 < first < len(frame):
            return pd.DataFrame({"a": [], "b": [], "step": []}).astype({"a": "int64", "b": "int64", "step": "int32"})
        key = np.frombuffer(b"".join(frame["key"]), np.uint8).reshape(-1, BYTES)
        a, b, far = _pairs(frame["tree"].to_numpy(), key, frame["a"].to_numpy(), least, first)
        return pd.DataFrame({"a": a, "b": b, "step": far})

    borders = found.where("border IS NOT NULL").groupBy("border").applyInPandas(across, "a bigint, b bigint, step int")
    inside = found.where("border IS NULL").select("a", "b", "step")
    return inside.unionByName(borders).groupBy("a", "b").agg(F.min("step").alias("step"))


def crowded(classes: DataFrame, found: DataFrame) -> DataFrame:
    """``doc, component`` of classes in a region of more than can all meet in line, and of several components."""
    named = classes.join(found.select(F.col("node").alias("rep"), "component"), "rep", "left")
    rows = named.select(
        F.col("rep").alias("doc"),
        F.coalesce("component", "rep").alias("component"),
        F.posexplode(F.array(*[F.substring("signature", 1 + t * STEP, DEPTH) for t in range(TREES)])).alias("tree", "prefix"),
    )
    # Grouped by a struct, the regions are dealt anew for the join, so that a large one can be split there.
    regions = (
        rows.groupBy(F.struct("tree", "prefix").alias("_k"))
        .agg(F.count(F.lit(1)).alias("_n"), F.min("component").alias("_low"), F.max("component").alias("_high"))
        .where((F.col("_n") > REACH + 1) & (F.col("_low") != F.col("_high")))
        .select("_k.*")
    )
    return rows.join(regions.hint("merge"), ["tree", "prefix"]).groupBy("doc").agg(F.min("component").alias("component"))


def overlapping(steps: Steps, members: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Every pair ``a, b`` of ``members`` (``doc, component``) of different components that may be similar enough.

    With its shingles in one order for all, rarest first, a pair of sizes ``x, y`` that has ``common`` of them in
    common shares one among the first ``x - common + 1`` of the one and ``y - common + 1`` of the other.
    """
    texts = steps.table(docs.join(members.hint("merge"), "doc").select("doc", "component", "text"))

    def count(batches):
        words, slots = WordHashes(), np.zeros(1 << SLOT_BITS, np.int64)
        for batch in batches:
            whole = [text or b"" for text in batch.column("text").to_pylist()]
            for low, high in chunks(whole):
                for s in _sets(whole[low:high], words, size):
                    np.add.at(slots, (s >> _U(64 - SLOT_BITS)).astype(np.int64), 1)
        used = np.flatnonzero(slots)
        for at in range(0, len(used), 1 << 16):
            cut = used[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(cut.astype(np.int32)), pa.array(slots[cut])], names=["slot", "n"])

    counted = texts.mapInArrow(count, "slot int, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    often = np.zeros(1 << SLOT_BITS, np.int64)
    often[counted.column("slot").to_numpy()] = counted.column("n").to_numpy()

    def first(batches):
        words = WordHashes()
        for batch in batches:
            ids, names = (batch.column(c).to_pylist() for c in ("doc", "component"))
            whole = [text or b"" for text in batch.column("text").to_pylist()]
            for low, high in chunks(whole):
                for doc, name, s in zip(ids[low:high], names[low:high], _sets(whole[low:high], words, size)):
                    if not len(s):
                        continue
                    order = np.lexsort((s, often[(s >> _U(64 - SLOT_BITS)).astype(np.int64)]))
                    head = s[order[: len(s) + percent * len(s) // -100 + 1]].view(np.int64)
                    k = len(head)
                    columns = [head, np.full(k, doc), np.full(k, name), np.full(k, len(s)), np.arange(k)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["shingle", "doc", "component", "n", "place"])

    heads = steps.table(texts.mapInArrow(first, "shingle bigint, doc bigint, component bigint, n bigint, place bigint"))
    steps.free(texts)
    shared = (
        heads.groupBy(F.struct("shingle").alias("_k"))
        .agg(F.count(F.lit(1)).alias("_n"), F.min("component").alias("_low"), F.max("component").alias("_high"))
        .where("_low <> _high")
        .select("_k.shingle", F.ceil(F.col("_n") / BLOCK).cast("int").alias("blocks"))
    )
    # A frequent shingle's rows are dealt to blocks, and every two blocks meet in a place of their own.
    dealt = steps.table(
        heads.join(shared.hint("merge"), "shingle")
        .withColumn("block", F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("shingle", "doc", "component", "n", "place", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    )
    steps.free(heads)
    side = lambda name: F.struct("doc", "component", "n", "place").alias(name)
    x = dealt.where("block = low").select("shingle", "low", "high", side("x")).hint("merge")
    y = dealt.where("block = high").select("shingle", "low", "high", side("y")).hint("merge")
    common = F.expr(f"({percent} * (x.n + y.n) + {99 + percent}) div {100 + percent}")
    met = x.join(y, ["shingle", "low", "high"]).where(
        (F.col("x.component") != F.col("y.component"))
        & ((F.col("low") < F.col("high")) | (F.col("x.doc") < F.col("y.doc")))
        & (F.col("x.place") <= F.col("x.n") - common)
        & (F.col("y.place") <= F.col("y.n") - common)
    )
    out = steps.table(met.select(F.least("x.doc", "y.doc").alias("a"), F.greatest("x.doc", "y.doc").alias("b")).distinct())
    steps.free(dealt)
    return out


def confirmed(steps: Steps, pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs whose full shingle sets are similar enough."""
    # Neither side of these joins has a bound on its size, so none is broadcast.
    needed = pairs.select(F.col("a").alias("doc")).union(pairs.select(F.col("b").alias("doc"))).distinct().hint("merge")

    def build(batches):
        words = WordHashes()
        for batch in batches:
            ids = batch.column("doc").to_pylist()
            texts = [text or b"" for text in batch.column("text").to_pylist()]
            for low, high in chunks(texts):
                sets = _sets(texts[low:high], words, size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[low:high], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["doc", "members"]
                )

    sets = steps.table(docs.join(needed, "doc").mapInArrow(build, "doc bigint, members binary"))
    left = sets.select(F.col("doc").alias("a"), F.col("members").alias("one")).hint("merge")
    right = sets.select(F.col("doc").alias("b"), F.col("members").alias("other")).hint("merge")

    def compare(batches):
        for batch in batches:
            keep = []
            for one, other in zip(batch.column("one"), batch.column("other")):
                x, y = (np.frombuffer(v.as_py(), _U) for v in (one, other))
                if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                    keep.append(False)
                    continue
                at = np.searchsorted(x, y)
                common = int((x[np.minimum(at, len(x) - 1)] == y).sum())
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    links = pairs.select("a", "b").join(left, "a").join(right, "b").mapInArrow(compare, "a bigint, b bigint")
    out = steps.table(links)
    steps.free(sets)
    return out


def _joined(steps: Steps, found: DataFrame, links: DataFrame) -> DataFrame:
    """Components with more links between them."""
    return steps.table(components(steps, links.unionByName(found.select(F.col("node").alias("a"), F.col("component").alias("b")))))


def near_duplicates(docs: DataFrame, size: int = 3, percent: int = 85) -> DataFrame:
    """Groups of near-duplicates: ``doc_id, n_shingles, component_id, kept``, one row per input row.

    Documents are linked if ``100 * common >= percent * all`` holds for their sets of distinct lower-cased
    ``size``-word shingles; a component is what links connect, named by its least ``doc_id``, which is kept.
    A null text, or one without words, has no shingles and no links. Rows that share a ``doc_id`` share a
    component if each has shingles. A null ``doc_id`` is the least one. An empty table gives an empty result.
    """
    steps = Steps(docs.sparkSession)
    source = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LEAST_ID).cast("bigint")).alias("doc"), F.col("text").cast("binary").alias("text")
    )
    marked = steps.table(signed(source, size))
    classes = steps.table(
        marked.where("n > 0").groupBy("digest").agg(F.min("doc").alias("rep"), F.min("signature").alias("signature"))
    )
    pairs = steps.table(candidates(steps, classes, percent))
    # The nearest in line connect most of a family; of the others only pairs that are still apart matter.
    links = confirmed(steps, pairs.where(F.col("step") <= NEAR), source, size, percent)
    found = steps.table(components(steps, links))
    name = lambda side: found.select(F.col("node").alias(side), F.col("component").alias(f"of_{side}"))
    apart = steps.table(
        pairs.where(F.col("step") > NEAR)
        .join(name("a"), "a", "left")
        .join(name("b"), "b", "left")
        .where(F.coalesce("of_a", "a") != F.coalesce("of_b", "b"))
        .select("a", "b")
    )
    if apart.take(1):
        found = _joined(steps, found, confirmed(steps, apart, source, size, percent))
    members = steps.table(crowded(classes, found))
    if members.take(1):
        apart = overlapping(steps, members, source, size, percent)
        if apart.take(1):
            found = _joined(steps, found, confirmed(steps, apart, source, size, percent))
    named = classes.select("digest", "rep").join(
        found.select(F.col("node").alias("rep"), "component"), "rep", "left"
    ).select("digest", F.coalesce("component", "rep").alias("component"))
    joined = marked.select("doc", "n", "digest").join(named, "digest", "left")
    whole = F.coalesce("component", "doc")
    plain = lambda c: F.when(c != F.lit(_LEAST_ID), c)
    return joined.select(
        plain(F.col("doc")).alias("doc_id"),
        F.col("n").alias("n_shingles"),
        plain(whole).alias("component_id"),
        (F.col("doc") == whole).alias("kept"),
    )


CHECK = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
  FROM texts),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes m ON m.doc_id = a JOIN sizes n ON n.doc_id = b WHERE 100 * c >= 85 * (m.n + n.n - c)),
reached AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id,
       doc_id = least(doc_id, coalesce(m, doc_id)) AS kept
FROM texts LEFT JOIN sizes USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS m FROM reached GROUP BY a) USING (doc_id)
"""
