"""Exact top-k inner-product search by ball trees: branch and bound per shard, with the current k-th score shared.

Vectors are whole numbers. Each shard of at most SHARD vectors is built into a ball tree once and written down. Queries are
worked off in blocks of bounded size, each broadcast to all shards and, once its results are written, dropped from them. A first job
searches one shard of every length and so finds a k-th score that each query is sure to reach; it is broadcast with the
block, and the shards then descend their trees from there, nodes in the order of their upper bound on the inner product, and leave out a node only where its bound is below the
current k-th score, so ties are kept. At most k rows per query and shard are shuffled.

Defined results: vectors that are null or hold null, NaN or infinite components take no part; vectors of different length don't
meet; equal scores go to the smaller vec_id; repeated ids are candidates each, apart from the query's own id; scores are
whole numbers, computed exactly while they stay below 2**63.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, materialize

SHARD = 16_384
LEAF = 128
QUERY_BLOCK = 8_192


def quantize(embedding: Column, factor: int = 1024) -> Column:
    """floor(factor * x) of each component, or null where the vector takes no part."""
    as_double = embedding.cast("array<double>")
    odd = F.exists(as_double, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(embedding.isNotNull() & ~odd, F.transform(as_double, lambda x: F.floor(x * factor)))


def _products(q: np.ndarray, x: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products as int64: through floats where their sums stay below 2**53, else in integers."""
    return (q @ x.T).astype(np.int64) if exact else q.astype(np.int64) @ x.astype(np.int64).T


class BallTree:
    """Arrays in the order of the leaves; node i holds rows [start[i], stop[i]), its children are left[i] and left[i] + 1."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.arange(len(ids))
        self.start, self.stop, self.left, centres, radii = [0], [len(ids)], [-1], [], []
        node = 0
        while node < len(self.start):
            a, b = self.start[node], self.stop[node]
            rows = vectors[order[a:b]].astype(np.float64)
            centre = rows.mean(axis=0)
            away = np.sqrt(((rows - centre) ** 2).sum(axis=1))
            centres.append(centre)
            radii.append(away.max())
            if b - a > LEAF and radii[-1] > 0:
                # split halfway along the line between two far points
                one = rows[away.argmax()]
                other = rows[((rows - one) ** 2).sum(axis=1).argmax()]
                along = rows @ (other - one)
                order[a:b] = order[a:b][np.argsort(along, kind="stable")]
                self.left[node] = len(self.start)
                self.start += [a, (a + b) // 2]
                self.stop += [(a + b) // 2, b]
                self.left += [-1, -1]
            node += 1
        self.ids, self.vectors = ids[order], vectors[order]
        self.centres, self.radii = np.array(centres), np.array(radii) * (1 + 1e-9) + 1e-6
        self.largest = np.abs(vectors).max(initial=0)

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """ids and scores (len(queries) x k) of the best rows with a score of at least `floor`; missing ones have id -1."""
        n = len(queries)
        best_ids = np.full((n, k), -1, np.int64)
        best = np.full((n, k), np.iinfo(np.int64).min)
        bound = floor.copy()  # the k-th score of each query as far as it is known
        norms = np.sqrt((queries.astype(np.float64) ** 2).sum(axis=1))
        exact = float(np.abs(queries).max(initial=0)) * float(self.largest) * queries.shape[1] < 2**53
        as_float = queries.astype(np.float64) if exact else queries

        def upper(node: int, some: np.ndarray) -> np.ndarray:
            top = queries[some] @ self.centres[node] + norms[some] * self.radii[node]
            return top + np.abs(top) * 1e-9 + 1e-6

        def leaf(node: int, some: np.ndarray) -> None:
            a, b = self.start[node], self.stop[node]
            score = _products(as_float[some], self.vectors[a:b], exact)
            ids = np.broadcast_to(self.ids[a:b], score.shape)
            out = (ids == query_ids[some, None]) | (score < bound[some, None])
            score = np.concatenate([best[some], np.where(out, np.iinfo(np.int64).min, score)], axis=1)
            ids = np.concatenate([best_ids[some], np.where(out, -1, ids)], axis=1)
            order = np.lexsort((ids, -np.maximum(score, -(2**63 - 1))), axis=1)[:, :k]
            best[some], best_ids[some] = np.take_along_axis(score, order, 1), np.take_along_axis(ids, order, 1)
            bound[some] = np.maximum(bound[some], np.where(best_ids[some, k - 1] >= 0, best[some, k - 1], bound[some]))

        stack = [(0, np.arange(n))]
        while stack:
            node, some = stack.pop()
            some = some[upper(node, some) >= bound[some]]
            if not len(some):
                continue
            child = self.left[node]
            if child < 0:
                leaf(node, some)
                continue
            first = upper(child, some) >= upper(child + 1, some)
            # the stack gives the better child of each query first
            stack += [(child + 1, some[first]), (child, some[~first]), (child, some[first]), (child + 1, some[~first])]
        return best_ids, best


def _trees(vectors: DataFrame, shard: int) -> DataFrame:
    """vectors: vec_id, vector (array<long>). One row per shard and length: shard, dim, blob."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list]] = {}

        def flush(dim: int) -> pa.RecordBatch:
            ids, rows = held.pop(dim)
            tree = BallTree(np.concatenate(ids), np.concatenate(rows))
            return pa.RecordBatch.from_pydict({"dim": pa.array([dim], pa.int32()), "blob": pa.array([pickle.dumps(tree, protocol=5)], pa.binary())})

        for batch in batches:
            for a in range(0, batch.num_rows, shard):
                part = batch.slice(a, shard)
                lists, ids = part.column(1), part.column(0).to_numpy(zero_copy_only=False)
                sizes = np.diff(lists.offsets.to_numpy())
                flat = lists.flatten().to_numpy(zero_copy_only=False)
                begin = lists.offsets.to_numpy()[:-1] - lists.offsets.to_numpy()[0]
                for dim in np.unique(sizes):
                    pick = np.flatnonzero(sizes == dim)
                    dim = int(dim)
                    got = held.setdefault(dim, ([], []))
                    got[0].append(ids[pick])
                    got[1].append(flat[begin[pick][:, None] + np.arange(dim)].astype(np.int64))
                    if sum(map(len, got[0])) >= shard:
                        yield flush(dim)
        for dim in list(held):
            yield flush(dim)

    return map_arrow(vectors, build, "dim int, blob binary")


def _search(trees: DataFrame, block: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]], k: int) -> DataFrame:
    """block: for each length the ids, the vectors and the scores to reach of a bounded number of queries. The results are written."""
    shared = trees.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if dim not in shared.value:
                    continue
                query_ids, queries, floor = shared.value[dim]
                ids, scores = pickle.loads(blob.as_py()).search(query_ids, queries, k, floor)
                found = ids >= 0
                yield pa.RecordBatch.from_pydict({"query_id": np.repeat(query_ids, found.sum(axis=1)), "vec_id": ids[found], "score": scores[found]})

    found = materialize(map_arrow(trees, run, "query_id long, vec_id long, score long"), "found")
    shared.destroy()
    return found


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, shard: int = SHARD, query_block: int = QUERY_BLOCK) -> DataFrame:
    """vectors: vec_id, vector (array<long> or null). query_id, rank, vec_id, score of the k best other rows for each query."""
    known = vectors.where("vector is not null and vec_id is not null")
    trees = materialize(_trees(known, shard).withColumn("nth", F.monotonically_increasing_id()), "ball-trees")
    queries = known.where(is_query).distinct()
    count = queries.count()
    parts = max(1, -(-count // query_block))
    # hashed parts of a known count, sorted by part, so that the others' row groups are skipped
    blocks = materialize(queries.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(parts))).repartition("part").sortWithinPartitions("part"), "queries")
    sample = [r["nth"] for r in trees.groupBy("dim").agg(F.min("nth").alias("nth")).collect()] if count else []
    out = None
    for part in range(parts):
        rows = blocks.where(F.col("part") == part).drop("part").toArrow().sort_by("vec_id") if count else None
        block: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        if rows is not None:
            ids, lists = rows["vec_id"].to_numpy(), rows["vector"].to_pylist()
            for dim in sorted({len(x) for x in lists}):
                at = [i for i, x in enumerate(lists) if len(x) == dim]
                block[dim] = ids[at], np.array([lists[i] for i in at], np.int64).reshape(len(at), dim), np.full(len(at), np.iinfo(np.int64).min)
            first = _search(trees.where(F.col("nth").isin(sample)), block, k).groupBy("query_id").agg(F.min("score").alias("s"), F.count("*").alias("n")).where(F.col("n") >= k)
            reached = {r["query_id"]: r["s"] for r in first.collect()}
            for dim, (ids, x, low) in block.items():
                block[dim] = ids, x, np.array([reached.get(int(i), m) for i, m in zip(ids, low, strict=True)], np.int64)
        found = _search(trees, block, k)
        out = found if out is None else out.unionByName(found)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as x from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
pairs as (
  select q.vec_id as query_id, c.vec_id,
    list_sum(list_transform(generate_series(1, len(q.x)), lambda i: q.x[i] * c.x[i]))::bigint as score
  from v q join v c on q.vec_id % 100 = 0 and q.vec_id <> c.vec_id),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from pairs)
select query_id, rank::int as rank, vec_id, score from ranked where rank <= 10
"""
