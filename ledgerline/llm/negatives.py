"""Hard negatives for anchors: other labels' rows that score nearly as high as a positive.

Vectors become integers, scores are exact integer inner products. Rows lie in shards; a shard keeps one list of
its rows per dimension, sorted by that component. An anchor walks all lists at once, from the top where its own
component is positive and from the bottom where it is negative, scores every row that comes up, and stops by
the threshold algorithm: no row that has not come up can score more than the anchor's product with the values
that the lists have reached. Once that lies strictly below the k-th score of every window asked for, or below
the window, the shard holds nothing better. In many dimensions much of a shard comes up before that.

Anchors meet shards in blocks (``ANCHOR_ROWS`` by ``SHARD_ROWS``), so no task holds all rows or all anchors.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import Steps

SHARD_ROWS = 8192
ANCHOR_ROWS = 8192
SCALE = 256
POSITIVES = 5
NEGATIVES = 5
# A negative scores between this share of its positive and all of it.
LOW_PERCENT = 80
FIRST_DEPTH = 64
# Doubles hold sums of products exactly below this; beyond it scores are computed with Python's integers.
EXACT = 1 << 53


class Lists:
    """Rows of one shard with their sorted lists."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, exact: bool):
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels, vectors = ids[order], labels[order], vectors[order]
        self.order = np.ascontiguousarray(np.argsort(vectors, axis=0, kind="stable").T)
        self.vectors = vectors if exact else _integers(vectors)
        self.sorted = np.take_along_axis(self.vectors, self.order.T, axis=0)

    def best(self, anchor: np.ndarray, may: np.ndarray, windows: list[tuple[int | None, int | None]], k: int) -> list[np.ndarray]:
        """For every window (low, high) of scores the ``k`` best rows among those that ``may`` come, as (row, score)
        ordered by score, ties by id."""
        n = len(self.ids)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        scores = np.zeros(n, self.vectors.dtype)
        seen, scored = np.zeros(n, bool), np.zeros(n, bool)
        found: list = [None] * len(windows)
        depth = 0
        while True:
            to = min(n, depth + max(FIRST_DEPTH, depth))
            if len(up) + len(down):
                seen[self.order[up, n - to : n - depth].ravel()] = True
                seen[self.order[down, depth:to].ravel()] = True
                bound = anchor[up] @ self.sorted[n - to, up] + anchor[down] @ self.sorted[to - 1, down]
            else:
                to, bound = n, 0
                seen[:] = True
            new = np.flatnonzero(seen & ~scored)
            scores[new] = self.vectors[new] @ anchor
            scored[new] = True
            usable = np.flatnonzero(scored & may)
            reached = scores[usable]
            depth = to
            for w, (low, high) in enumerate(windows):
                if found[w] is not None:
                    continue
                inside = np.ones(len(usable), bool)
                if low is not None:
                    inside &= (reached >= low).astype(bool)
                if high is not None:
                    inside &= (reached <= high).astype(bool)
                own, values = usable[inside], reached[inside]
                kth = _kth(values, k)
                if depth == n or (kth is not None and bound < kth) or (low is not None and bound < low):
                    if kth is not None:
                        top = (values >= kth).astype(bool)
                        own, values = own[top], values[top]
                    # Rows lie in the order of their ids, which a stable sort keeps among equals.
                    first = np.argsort(-values, kind="stable")[:k]
                    found[w] = (own[first], values[first])
            if all(f is not None for f in found):
                return found


def _kth(values: np.ndarray, k: int):
    if len(values) < k:
        return None
    return (np.sort(values) if values.dtype == object else np.partition(values, len(values) - k))[len(values) - k]


def _integers(vectors: np.ndarray) -> np.ndarray:
    out = np.empty(vectors.shape, object)
    out.ravel()[:] = [int(x) for x in vectors.ravel().tolist()]
    return out


def _matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    flat = column.combine_chunks()
    return np.asarray(flat.flatten(), np.float64).reshape(len(flat), dims)


def usable(vectors: DataFrame, id_column: str, vector_column: str, label_column: str, label) -> DataFrame:
    """``vec_id, label, vector, dims`` of rows that take part, vectors in whole numbers (as doubles)."""
    vector = F.col(vector_column).cast("array<double>")
    rows = vectors.select(F.col(id_column).cast("bigint").alias("vec_id"), F.col(label_column).cast("bigint").alias("_label"), vector.alias("_vector"))
    finite = F.forall("_vector", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    taken = rows.where(F.col("vec_id").isNotNull() & F.col("_label").isNotNull() & F.col("_vector").isNotNull() & finite)
    # One row per id: the least by label and vector.
    single = taken.groupBy("vec_id").agg(F.min(F.struct("_label", "_vector")).alias("_r"))
    own = single.select("vec_id", F.col("_r._label").alias("label"), F.col("_r._vector").alias("vector"))
    # A whole double stays one: floor() would give a bigint, which large components overflow.
    return own.select("vec_id", label.alias("label"), "vector", F.size("vector").alias("dims"))


def _searched(shards: DataFrame, anchors: DataFrame, numbers: tuple[int, int], k: int, schema: str, scan) -> DataFrame:
    """``scan(lists, anchor row)`` for every anchor in every shard of vectors of its length."""
    n_shards, n_blocks = numbers
    key = ["dims", "shard", "block"]
    cut = lambda column, n: F.pmod(F.xxhash64(column), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    rows = shards.withColumn("shard", cut("vec_id", n_shards)).withColumn("block", every(n_blocks))
    asked = anchors.withColumn("block", cut("anchor_id", n_blocks)).withColumn("shard", every(n_shards))

    def meet(keys, left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if left.num_rows and right.num_rows:
            dims = keys[0].as_py()
            vectors, wanted = np.floor(SCALE * _matrix(left["vector"], dims)), np.floor(SCALE * _matrix(right["wanted"], dims))
            most = float(np.abs(vectors).max(initial=0)) * float(np.abs(wanted).max(initial=0)) * max(1, dims)
            exact = most < EXACT
            lists = Lists(left["vec_id"].to_numpy(), left["label"].to_numpy(), vectors, exact)
            wanted = wanted if exact else _integers(wanted)
            others = right.drop_columns(["wanted"]).to_pylist()
            for anchor, row in zip(wanted, others):
                out.extend(scan(lists, anchor, row))
        names = [field.split()[0] for field in schema.split(", ")]
        columns = list(zip(*out)) if out else [[]] * len(names)
        return pa.table({name: pa.array([int(x) for x in column], pa.int64()) for name, column in zip(names, columns)})

    return rows.groupBy(*key).cogroup(asked.groupBy("own_dims", "shard", "block")).applyInArrow(meet, schema)


def mine(
    vectors: DataFrame, anchor, label=None, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label",
    positives: int = POSITIVES, negatives: int = NEGATIVES, shard_rows: int = SHARD_ROWS, anchor_rows: int = ANCHOR_ROWS,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``: for every anchor (rows that the
    condition ``anchor`` on ``vec_id`` takes) and each of its ``positives`` best rows of its label the ``negatives``
    best rows of other labels in the positive's window. ``label`` is an expression over ``vec_id`` and ``label``.

    Rows with a null id, label, vector or component or a non-finite one take no part. Rows that share an id count
    once: the least by label, then vector. Vectors of different lengths do not meet; a zero vector scores 0. Ties go
    by smaller id. An anchor without a positive, or whose windows are empty, gives no row, as does an empty table.
    Scores must fit a 64-bit integer.
    """
    steps = Steps(vectors.sparkSession)
    rows = steps.table(usable(vectors, id_column, vector_column, label_column, F.col("label") if label is None else label))
    anchors = rows.where(anchor).select(
        F.col("vec_id").alias("anchor_id"), F.col("label").alias("own_label"), F.col("vector").alias("wanted"), F.col("dims").alias("own_dims")
    )
    counted = rows.agg(F.count(F.lit(1)), F.count_if(anchor)).first()
    numbers = (-(-max(1, counted[0]) // shard_rows), -(-max(1, counted[1]) // anchor_rows))

    def same(lists: Lists, vector, row):
        may = (lists.labels == row["own_label"]) & (lists.ids != row["anchor_id"])
        ((found, scores),) = lists.best(vector, may, [(None, None)], positives)
        return [(row["anchor_id"], lists.ids[i], s) for i, s in zip(found, scores)]

    near = _searched(rows, anchors, numbers, positives, "anchor_id bigint, positive_id bigint, positive_score bigint", same)
    by_score = Window.partitionBy("anchor_id").orderBy(F.col("positive_score").desc(), "positive_id")
    chosen = near.withColumn("_rank", F.row_number().over(by_score)).where(F.col("_rank") <= positives)
    windows = steps.table(
        chosen.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("windows"))
    )

    def others(lists: Lists, vector, row):
        may = lists.labels != row["own_label"]
        spans = [(-(-LOW_PERCENT * w["positive_score"] // 100), w["positive_score"]) for w in row["windows"]]
        out = []
        for w, (found, scores) in zip(row["windows"], lists.best(vector, may, spans, negatives)):
            out.extend((row["anchor_id"], w["positive_id"], w["positive_score"], lists.ids[i], s) for i, s in zip(found, scores))
        return out

    hard = _searched(
        rows, anchors.join(windows, "anchor_id"), numbers, negatives,
        "anchor_id bigint, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint", others,
    )
    by_score = Window.partitionBy("anchor_id", "positive_id").orderBy(F.col("negative_score").desc(), "negative_id")
    return hard.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def shifted_label():
    """Every seventh id's label is moved by one: the noise that the query mines against."""
    own = F.col("label")
    return F.when(F.col("vec_id") % 7 == 0, (own + 1) % 10).otherwise(own)


def mined(vectors: DataFrame) -> DataFrame:
    return mine(vectors, F.col("vec_id") % 100 == 0, shifted_label())


CHECK = f"""
WITH ranked AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v,
         row_number() OVER (PARTITION BY vec_id ORDER BY label, CAST(embedding AS DOUBLE[])) AS copy
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
rows AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                [floor({SCALE} * x) FOR x IN v] AS v FROM ranked WHERE copy = 1),
scored AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
                  CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
           FROM rows a JOIN rows b ON b.vec_id <> a.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0),
positives AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES})
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND {LOW_PERCENT} * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) <= {NEGATIVES}"""
