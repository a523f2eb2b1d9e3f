"""Approximate nearest neighbours by largest inner product: a robust-pruned directed graph per shard.

Rows are dealt by hash into shards of bounded size. In each shard equal vectors become one node; greedy
searches over the graph so far propose neighbours for a batch of new nodes, and relaxed distance pruning
keeps those that no kept neighbour is much closer to. Vectors get one more component that makes them equally
long, so largest inner product and least distance agree; queries have 0 there. Every query is answered in
every shard by beam search from a central node and the longest ones, the beam is scored in double precision on
the original vectors, and a window keeps the best of all shards.

How wide a beam must be depends on the vectors. So each shard, once built, asks some of its own vectors, compares
with all inner products, and doubles its beam until enough of the true neighbours come up. A shard whose graph
does not lead there with the widest beam is searched row by row.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import Steps

SHARD_ROWS = 8192
DEGREE = 32
SLACK = 16  # edges above the degree before a node is pruned again
BEAM = 64
RELAX = 1.2
BATCH = 512
ENTRIES = 16
# A shard's beam is measured with so many of its vectors, and doubled until this share of their neighbours is found.
MEASURED = 128
RECALL = 0.95
WIDEST = 256


def beam_search(
    vectors: np.ndarray, graph: np.ndarray, entries: np.ndarray, queries: np.ndarray, beam: int
) -> tuple[np.ndarray, np.ndarray]:
    """Nodes in each query's final beam, best first, and all nodes that its search expanded; -1 pads both."""
    entries = entries[:beam]
    rows, width = len(queries), graph.shape[1]
    ids = np.full((rows, beam), -1, np.int32)
    sims = np.full((rows, beam), -np.inf, np.float32)
    done = np.zeros((rows, beam), bool)
    seen = np.zeros((rows, len(vectors)), bool)
    first = queries @ vectors[entries].T
    order = np.argsort(-first, 1, kind="stable")
    ids[:, : len(entries)], seen[:, entries] = entries[order], True
    sims[:, : len(entries)] = np.take_along_axis(first, order, 1)
    expanded = []
    active = np.arange(rows)
    while len(active):
        open_ = ~done[active] & (ids[active] >= 0)
        some = open_.any(1)
        active, open_ = active[some], open_[some]
        if not len(active):
            break
        place = open_.argmax(1)
        node = ids[active, place]
        done[active, place] = True
        step = np.full(rows, -1, np.int32)
        step[active] = node
        expanded.append(step)
        near = graph[node]
        fresh = near >= 0
        fresh &= ~seen[active[:, None], near]
        r, c = np.nonzero(fresh)
        seen[active[r], near[r, c]] = True
        found = np.full((len(active), width), -np.inf, np.float32)
        found[r, c] = np.einsum("ij,ij->i", vectors[near[r, c]], queries[active[r]])
        all_sims = np.concatenate([sims[active], found], 1)
        all_ids = np.concatenate([ids[active], np.where(fresh, near, -1)], 1)
        all_done = np.concatenate([done[active], np.zeros_like(fresh)], 1)
        order = np.argsort(-all_sims, 1, kind="stable")[:, :beam]
        sims[active] = np.take_along_axis(all_sims, order, 1)
        ids[active] = np.take_along_axis(all_ids, order, 1)
        done[active] = np.take_along_axis(all_done, order, 1)
    return ids, np.stack(expanded, 1) if expanded else np.empty((rows, 0), np.int32)


def robust_prune(
    vectors: np.ndarray, square: float, points: np.ndarray, candidates: np.ndarray, degree: int, relax: float
) -> np.ndarray:
    """Up to ``degree`` neighbours of each point among its candidates (-1 pads): nearest first, leaving out those
    that a kept one is nearer to by the factor ``relax``. ``square`` is the squared length of all vectors."""
    rows = len(points)
    valid = (candidates >= 0) & (candidates != points[:, None])
    safe = np.where(valid, candidates, 0)
    own = np.einsum("ijk,ik->ij", vectors[safe], vectors[points])
    apart = np.where(valid, np.maximum(2 * (square - own), 0), np.inf)
    # Repeated candidates: only the first of each counts.
    order = np.lexsort((safe, apart), axis=1)
    safe, apart = np.take_along_axis(safe, order, 1), np.take_along_axis(apart, order, 1)
    same = np.zeros_like(valid)
    same[:, 1:] = (safe[:, 1:] == safe[:, :-1]) & np.isfinite(apart[:, 1:])
    alive = np.isfinite(apart) & ~same
    nearby = vectors[safe]
    between = np.maximum(2 * (square - np.matmul(nearby, nearby.transpose(0, 2, 1))), 0) * np.float32(relax * relax)
    out = np.full((rows, degree), -1, np.int32)
    count = np.zeros(rows, np.int64)
    for i in range(safe.shape[1]):
        pick = alive[:, i] & (count < degree)
        if not pick.any():
            continue
        at = np.flatnonzero(pick)
        out[at, count[at]] = safe[at, i]
        count[at] += 1
        alive[at] &= between[at, i] > apart[at]
        alive[at, i] = False
    return out


def build_graph(vectors: np.ndarray, square: float, entry: int, degree: int = DEGREE, beam: int = BEAM, relax: float = RELAX) -> np.ndarray:
    """Out-neighbours of every node (-1 pads), inserted in random batches that double in size."""
    n, width = len(vectors), degree + SLACK
    graph = np.full((n, width), -1, np.int32)
    fill = np.zeros(n, np.int64)
    order = np.random.default_rng(7).permutation(n)
    order = np.concatenate(([entry], order[order != entry]))
    at = 1
    while at < n:
        batch = order[at : at + min(BATCH, at)]
        _, expanded = beam_search(vectors, graph, order[:1], vectors[batch], beam)
        kept = robust_prune(vectors, square, batch, expanded, degree, relax)
        graph[batch, :degree] = kept
        fill[batch] = (kept >= 0).sum(1)
        source = np.repeat(batch, degree)[(kept >= 0).ravel()].astype(np.int32)
        target = kept[kept >= 0]
        by = np.argsort(target, kind="stable")
        source, target = source[by], target[by]
        nodes, first, more = np.unique(target, return_index=True, return_counts=True)
        room = fill[nodes] + more <= width
        put = np.repeat(room, more)
        slot = (np.arange(len(target)) - np.repeat(first, more)) + fill[target]
        graph[target[put], slot[put]] = source[put]
        fill[nodes[room]] += more[room]
        full = np.flatnonzero(~room)
        for low in range(0, len(full), 1024):
            part = full[low : low + 1024]
            extra = np.full((len(part), int(more[part].max())), -1, np.int32)
            for j, i in enumerate(part):
                extra[j, : more[i]] = source[first[i] : first[i] + more[i]]
            pruned = robust_prune(vectors, square, nodes[part], np.concatenate([graph[nodes[part]], extra], 1), degree, relax)
            graph[nodes[part]] = -1
            graph[nodes[part], :degree] = pruned
            fill[nodes[part]] = (pruned >= 0).sum(1)
        at += len(batch)
    return graph


class Shard:
    """One shard's vectors, graph and ids, as they are stored."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int = 20, beam: int = BEAM):
        order = np.lexsort((ids, *vectors.T[::-1]))
        ids, vectors = ids[order], vectors[order]
        new = np.ones(len(ids), bool)
        new[1:] = (vectors[1:] != vectors[:-1]).any(1)
        self.ids, self.vectors = ids, vectors[new]
        self.starts = np.append(np.flatnonzero(new), len(ids))  # members of a node, by id
        flat, square = self.flat()
        middle = int(np.argmax(flat @ flat.mean(0)))
        self.graph = build_graph(flat, square, middle)
        # The longest vectors have the least in the last component.
        longest = np.argsort(flat[:, -1], kind="stable")[:ENTRIES]
        self.entries = np.concatenate(([middle], longest[longest != middle]))[:ENTRIES]
        self.beam = self.measured_beam(flat, k, beam)

    def flat(self) -> tuple[np.ndarray, float]:
        # Scaled by a power of two, so that squares neither overflow nor vanish in single precision.
        scale = 2.0 ** -np.floor(np.log2(np.abs(self.vectors).max()))
        scaled = self.vectors * scale
        squares = (scaled * scaled).sum(1)
        most = float(squares.max())
        last = np.sqrt(np.maximum(most - squares, 0))
        return np.column_stack([scaled, last]).astype(np.float32), most

    def measured_beam(self, flat: np.ndarray, k: int, beam: int) -> int:
        """The first beam, doubled from the given one, that finds enough of the nearest nodes; 0 if none up to the widest does."""
        chosen = np.random.default_rng(13).permutation(len(flat))[:MEASURED]
        queries = flat[chosen].copy()
        queries[:, -1] = 0
        sims = queries @ flat.T
        sims[np.arange(len(chosen)), chosen] = -np.inf
        k = min(k, len(flat) - 1)
        if k < 1:
            return beam
        # What is as near as the k-th counts as found: nodes may tie in single precision.
        least = -np.partition(-sims, k - 1, 1)[:, k - 1]
        while beam <= WIDEST:
            nodes, _ = beam_search(flat, self.graph, self.entries, queries, max(beam, k + 1))
            near = np.take_along_axis(sims, np.maximum(nodes, 0), 1) >= least[:, None]
            if np.minimum((near & (nodes >= 0)).sum(1), k).mean() >= RECALL * k:
                return beam
            beam *= 2
        return 0

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(
            out, ids=self.ids, vectors=self.vectors, starts=self.starts, graph=self.graph, entries=self.entries, beam=self.beam
        )
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Shard:
        shard = cls.__new__(cls)
        with np.load(io.BytesIO(data)) as stored:
            shard.ids, shard.vectors, shard.starts, shard.graph = (stored[k] for k in ("ids", "vectors", "starts", "graph"))
            shard.entries, shard.beam = stored["entries"], int(stored["beam"])
        return shard

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
        """The ``k`` best rows for each query, its own row left out: query ids, row ids, scores."""
        flat, _ = self.flat()
        length = np.abs(queries).max(1, keepdims=True)
        scaled = np.column_stack([queries / length, np.zeros(len(queries))]).astype(np.float32)
        if self.beam:
            nodes, _ = beam_search(flat, self.graph, self.entries, scaled, max(self.beam, k + 1))
        else:  # twice as many as are wanted, for those that tie in single precision
            nodes = np.argsort(-(scaled @ flat.T), 1, kind="stable")[:, : 2 * k + 1]
        out = ([], [], [])
        for query_id, query, found in zip(query_ids, queries, nodes):
            found = found[found >= 0]
            scores = np.einsum("ij,j->i", self.vectors[found], query)
            # A node holds all rows with its vector; the first k + 1 by id suffice.
            members = [self.ids[self.starts[f] : min(self.starts[f + 1], self.starts[f] + k + 1)] for f in found]
            ids = np.concatenate(members)
            scores = np.repeat(scores, [len(m) for m in members])
            other = ids != query_id
            ids, scores = ids[other], scores[other]
            best = np.lexsort((ids, -scores))[:k]
            out[0].append(np.full(len(best), query_id))
            out[1].append(ids[best])
            out[2].append(scores[best])
        return tuple(np.concatenate(column) for column in out)


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``id, vector, dim`` of rows that take part: an id and a non-zero vector of finite numbers."""
    value = F.col(vector_column).cast("array<double>")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = vectors.select(F.col(id_column).cast("bigint").alias("id"), value.alias("vector"))
    return rows.where(
        F.col("id").isNotNull()
        & F.forall("vector", lambda x: F.coalesce(finite(x), F.lit(False)))
        & F.exists("vector", lambda x: x != 0)
    ).withColumn("dim", F.size("vector"))


def build_index(
    rows: DataFrame, k: int, shard_rows: int = SHARD_ROWS, beam: int = BEAM
) -> tuple[DataFrame, dict[int, int]]:
    """Index rows ``dim, shard, data`` (lazy), and the number of shards per number of components. Beams are
    measured for the ``k`` nearest."""
    counts = {r["dim"]: r["count"] for r in rows.groupBy("dim").count().collect()}
    shards = {dim: max(1, -(-count // shard_rows)) for dim, count in counts.items()}
    number = F.lit(1)
    for dim, n in shards.items():
        number = F.when(F.col("dim") == dim, F.lit(n)).otherwise(number)

    def build(keys, table):
        ids = table.column("id").to_numpy().astype(np.int64)
        flat = table.column("vector").combine_chunks().flatten().to_numpy().astype(np.float64)
        shard = Shard(ids, flat.reshape(len(ids), keys[0].as_py()), k, beam)
        return pa.table({"dim": [keys[0].as_py()], "shard": [keys[1].as_py()], "data": [shard.dump()]}, schema=_INDEX)

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("id"), number).cast("int"))
    return dealt.groupBy("dim", "shard").applyInArrow(build, "dim int, shard int, data binary"), shards


_INDEX = pa.schema([("dim", pa.int32()), ("shard", pa.int32()), ("data", pa.binary())])


def search_index(index: DataFrame, shards: dict[int, int], queries: DataFrame, k: int) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` best rows found for each query, best first, ties by id."""
    spread = F.array().cast("array<int>")
    for dim, n in shards.items():
        spread = F.when(F.col("dim") == dim, F.sequence(F.lit(0), F.lit(n - 1))).otherwise(spread)
    asked = queries.groupBy("id", "dim").agg(F.min("vector").alias("vector"))
    null = lambda kind: F.lit(None).cast(kind)
    # A shard's index comes first in its task, its queries follow; only one index is held at a time.
    stream = (
        asked.withColumn("shard", F.explode(spread))
        .select("dim", "shard", "id", "vector", null("binary").alias("data"))
        .unionByName(index.select("dim", "shard", null("bigint").alias("id"), null("array<double>").alias("vector"), "data"))
        .repartition(max(1, sum(shards.values())), "dim", "shard")
        .sortWithinPartitions("dim", "shard", F.col("id").asc_nulls_first())
    )

    def answer(batches):
        shard, waiting = None, []

        def flush():
            ids = np.array([i for i, _ in waiting], np.int64)
            found = shard.search(ids, np.array([v for _, v in waiting], np.float64), k)
            waiting.clear()
            return pa.RecordBatch.from_arrays(list(map(pa.array, found)), names=["query_id", "vec_id", "score"])

        for batch in batches:
            for id_, vector, data in zip(batch.column("id").to_pylist(), batch.column("vector"), batch.column("data")):
                if data.is_valid:
                    if waiting:
                        yield flush()
                    shard = Shard.load(data.as_py())
                    continue
                waiting.append((id_, vector.values.to_numpy()))
                if len(waiting) == BATCH:
                    yield flush()
        if waiting:
            yield flush()

    found = stream.mapInArrow(answer, "query_id bigint, vec_id bigint, score double")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def nearest(
    vectors: DataFrame, chosen, k: int, id_column: str = "vec_id", vector_column: str = "embedding",
    shard_rows: int = SHARD_ROWS, beam: int = BEAM,
) -> DataFrame:
    """The ``k`` rows with the largest inner product found for each row that the condition ``chosen`` on ``id`` takes.

    Null vectors, zero vectors and those with a null or non-finite component take no part, nor do rows
    without an id; vectors of different lengths are not compared. Equal vectors tie and go by id, and rows
    that repeat an id are candidates each, but not for their own id. With fewer candidates than ``k`` all
    that the beam reaches come back; an empty table gives an empty result.
    """
    steps = Steps(vectors.sparkSession)
    rows = usable(vectors, id_column, vector_column)
    index, shards = build_index(rows, k, shard_rows, beam)
    return search_index(steps.table(index), shards, rows.where(chosen), k)
