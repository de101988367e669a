"""Best-fit packing in bulk-synchronous rounds.

Lengths are whole numbers up to the capacity, so the range-sorted orders of documents and of gaps are kept as runs: a document is
known by its length and its rank among the documents of that length, a gap by its size and a run of sequence numbers. A round takes the
longest documents left, opens sequences for those that no gap can hold, sweeps over the sorted runs so that every document seeks its
successor among the gaps (the smallest that is large enough), settles conflicts by rank (of documents that seek one gap the
longest wins, the losers go on to the next gap in the same sweep) and updates the gaps. Rounds end when no document is left.

Ranks come from counts per task, which are summed per length on the cluster. The runs are few however many documents there are (at
most one per length, and a round adds no more gaps than there are runs), so the sweeps of some rounds are one task of a job that reads
the state which the job before has written; the pieces stay spread in their tasks. Nothing but the number of documents left reaches the driver.

Defined results: a null text counts as empty and has one token, the end mark; repeated rows, rows with one doc_id and rows without any are
packed as they are; an empty table packs into nothing.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from .bpe import MAX_KEPT, FlatBpe
from .common import map_arrow, materialize, text_slices

CAPACITY = 1024
END_ID = 2


#: A round takes the lengths from the longest one left down to this share of the capacity below it: finer steps come closer to
#: plain best fit (at 32 within a hundredth on the cases of the tests), and need more rounds.
STEPS = 32
#: Rounds after which the state is written.
ROUNDS_PER_JOB = 16
_DOC, _GAP, _OPENED, _PLACED = range(4)
_RUNS = pa.schema([("kind", pa.int32()), *((c, pa.int64()) for c in ("size", "n", "first", "low", "offset"))])


def _sweep(docs: dict[int, int], gaps: dict[int, list[tuple[int, int]]]) -> Iterator[tuple[int, int, int, int]]:
    """Matches documents (number per length) with gaps (runs of sequences per size), one each: (length, gap, first sequence, number).
    Sizes ascend; a gap takes the longest document that it can hold and no smaller gap has taken, so a document that loses
    a gap to a longer one goes on to the next. Takes what it matches out of docs and gaps."""
    waiting: list[int] = []  # lengths with documents left, the longest last
    for size in sorted(docs.keys() | gaps.keys()):
        if docs.get(size):
            waiting.append(size)
        free = []
        for first, n in sorted(gaps.get(size, ())):
            while n and waiting:
                length = waiting[-1]
                used = min(n, docs[length])
                yield length, size, first, used
                first, n, docs[length] = first + used, n - used, docs[length] - used
                if not docs[length]:
                    waiting.pop()
            if n:
                free.append((first, n))
        gaps[size] = free


def _round(runs: list[tuple[int, int, int, int]], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """One round over the state (kind, size, n, first): placements (kind _PLACED, with low and offset) and the new state."""
    left = {size: n for kind, size, n, _ in runs if kind == _DOC}
    rank = {size: first for kind, size, _, first in runs if kind == _DOC}
    opened = max(first for kind, _, _, first in runs if kind == _OPENED)
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for kind, size, n, first in runs:
        if kind == _GAP:
            gaps[size].append((first, n))
    over = max(left) - max(1, capacity // STEPS)
    docs = {size: n for size, n in left.items() if size > over}
    homeless = -(-sum(size * n for size, n in docs.items() if size > max(gaps, default=0)) // capacity)
    if homeless:
        gaps[capacity].append((opened, homeless))
    out = [(_OPENED, 0, 0, opened + homeless, 0, 0)]

    def place(length: int, n: int, first: int, offset: int) -> None:
        if n:
            out.append((_PLACED, length, n, first, rank[length], offset))
            rank[length] += n

    matches = sorted(_sweep(docs, gaps))
    new = [(size, first, n) for size, found in gaps.items() for first, n in found]
    for length, gap, first, n in matches:
        place(length, n, first, capacity - gap)
    for length, gap, first, n in matches:  # what is left of the length goes beside, as far as these gaps have room
        more = gap // length - 1
        extra = min(docs[length], more * n)
        docs[length] -= extra
        full, part = divmod(extra, more) if extra else (0, 0)
        for layer in range(more if full else part):
            place(length, full + (layer < part), first, capacity - gap + (layer + 1) * length)
        some = min(part, 1)
        new += [(gap - (more + 1) * length, first, full), (gap - (part + 1) * length, first + full, some), (gap - length, first + full + some, n - full - some)]
    out += [(_GAP, size, n, first, 0, 0) for size, first, n in new if size and n]
    return out + [(_DOC, size, docs.get(size, n), rank[size], 0, 0) for size, n in left.items() if docs.get(size, n)]


def plan(counts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """counts: length, n. Gives length, low, high, first, offset: documents of a length whose rank is from low to below high have this
    offset in the sequences that follow first."""
    spark = counts.sparkSession
    schema = "kind int, size long, n long, first long, low long, offset long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = [r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns[:4]), strict=True)]
        found = []
        for _ in range(ROUNDS_PER_JOB):
            if any(kind == _DOC for kind, *_ in runs):
                rows = _round(runs, capacity)
                found += [r for r in rows if r[0] == _PLACED]
                runs = [r[:4] for r in rows if r[0] != _PLACED]
        found += [(*r, 0, 0) for r in runs]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in found], f.type) for i, f in enumerate(_RUNS)], schema=_RUNS)

    docs = counts.select(F.lit(_DOC).alias("kind"), F.col("length").alias("size"), "n", *(F.lit(0).alias(c) for c in ("first", "low", "offset")))
    counter = spark.createDataFrame([(_OPENED, 0, 0, 0, 0, 0)], schema)
    new, rounds = docs.unionByName(counter), []
    while True:
        seen = Observation()
        left = F.coalesce(F.sum(F.when(F.col("kind") == _DOC, F.col("n"))), F.lit(0)).alias("left")
        rounds.append(materialize(new.coalesce(1).observe(seen, left), "round"))
        if not seen.get["left"]:
            break
        new = map_arrow(rounds[-1].where(F.col("kind") != _PLACED).coalesce(1), run, schema)
    written = spark.read.schema(rounds[-1].schema).parquet(*(f for r in rounds for f in r.inputFiles()))
    return written.where(F.col("kind") == _PLACED).select(F.col("size").alias("length"), "low", (F.col("low") + F.col("n")).alias("high"), "first", "offset")


_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("task", pa.int32()), ("nth", pa.int64())])


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, kept: int = MAX_KEPT) -> DataFrame:
    """One row per piece, with its task and its rank among that task's pieces of the same length."""
    shared = docs.sparkSession.sparkContext.broadcast(FlatBpe.from_file(path, kept))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        mark = end_id.to_bytes(4, "little")
        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in text_slices(texts):
                rows = []
                for doc_id, ids in zip(doc_ids[a:b], shared.value.encode(texts[a:b]), strict=True):
                    ids += mark
                    n, at, k = len(ids) // 4, 0, 0
                    while at < n:
                        size = (n - 1) % capacity + 1 if k == 0 else capacity
                        rows.append((doc_id, k, at, size, zlib.crc32(ids[4 * at : 4 * (at + size)]), task, int(seen[size])))
                        seen[size] += 1
                        at, k = at + size, k + 1
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _PIECES, strict=True)], schema=_PIECES)

    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long")


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to written pieces (columns length, task, nth), and drops task and nth."""
    per_task = pieces.groupBy("length", "task").agg((F.max("nth") + 1).alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = per_task.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    placed = plan(per_task.groupBy("length").agg(F.sum("n").alias("n")), capacity)
    ranked = pieces.join(base, ["length", "task"]).withColumn("rank", F.col("base") + F.col("nth"))
    on = (ranked["length"] == placed["length"]) & (ranked["rank"] >= placed["low"]) & (ranked["rank"] < placed["high"])
    kept = [ranked[c] for c in pieces.columns if c not in ("task", "nth")]
    return ranked.join(placed, on).select(*kept, (placed["first"] + ranked["rank"] - placed["low"]).alias("sequence_id"), placed["offset"].alias("offset"))


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, kept: int = MAX_KEPT) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: every document in sequences of at most `capacity` tokens.
    kept: pieces of texts whose ids a worker keeps (see bpe), a matter of memory against time alone."""
    return pack(materialize(token_pieces(docs, path, capacity, end_id, kept), "pieces"), capacity)
