"""Connected components by alternating large-star and small-star steps (Kiveris et al. 2014) on DataFrames.

Every step is a pre-aggregated minimum per node and a join with it. No node's neighbours are collected: the rows of a node with very many
stream through the join, whose large partitions are split (adaptive skew join). Each iteration is written to the shared folder.
Up to FEW edges are joined up in one task instead: every iteration would cost some ten stages of as many tasks as a shuffle has partitions.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, materialize

MAX_ITERATIONS = 60
#: Edges that one task joins up (some 10 MB there); more are spread over the cluster.
FEW = 1 << 16


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("h")).first()
    return row["n"], row["h"]


def _step(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    joined = large.join(least, "a")
    return joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _together(edges: DataFrame) -> DataFrame:
    """All components in one task, by union and find."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above: dict[int, int] = {}

        def top(x: int) -> int:
            while (y := above.setdefault(x, x)) != x:
                above[x] = x = above[y]
            return x

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                a, b = top(a), top(b)
                above[max(a, b)] = min(a, b)
        found = [(x, top(x)) for x in above if above[x] != x]
        yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], names=["node", "component"])

    return map_arrow(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).coalesce(1), run, "node long, component long")


def components(edges: DataFrame) -> DataFrame:
    """edges: a, b (long). Gives (node, component) of every node that is not the smallest of its component."""
    edges = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    state = _state(edges)
    if 0 < state[0] <= FEW:
        return materialize(_together(edges), "components-of-few")
    for _ in range(MAX_ITERATIONS):
        if not state[0]:
            break
        edges = materialize(_step(edges), "stars")
        new = _state(edges)
        if new == state:
            break
        state = new
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
