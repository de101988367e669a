"""Quality classifier: nearest-neighbour voting over latent-semantic vectors.

A text becomes a vector of hashed counts (runs of five characters by their classes, runs of three as they stand), as square roots of
their shares, scaled by inverse frequency and projected on the leading singular vectors of a bounded sample of labelled texts. The
labelled vectors (at most MAX_LABELLED x RANK floats) are broadcast; every text meets all of them in blocks of exact
cosine products, and its K nearest vote by similarity.

Defined results: a null text counts as empty; an empty text, whose vector is zero, gets the share of label 1; similarities are
compared in steps of 1 / STEPS, and equal ones go to the smaller doc_id; without labels of both kinds the share decides, 0.5 without
any.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SLICE_CHARS, ddl_of, map_arrow, trim
from .language_id import code_points

BITS = 11
WIDTH = 1 << BITS
RANK = 64
#: Of the subspace iteration: vectors beside the wanted ones, and rounds.
SPARE, ITERATIONS = 16, 10
K = 15
#: Labelled texts that a model is fitted on at most, chosen by a hash of their id.
MAX_LABELLED = 4_096
BLOCK = 256
THRESHOLD = 0.3
#: Rounding errors of a product are far below a step, so that equal vectors are equally near.
STEPS = 1 << 14
_A, _B = np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B)


def _counts(text: str) -> np.ndarray:
    """Hashed counts of the whole text, in slices. Letters are folded to classes (upper, lower) in one view, kept in another."""
    out = np.zeros(WIDTH, np.float32)
    for a in range(0, len(text), SLICE_CHARS):
        x = code_points(text[a : a + SLICE_CHARS + 4]).astype(np.uint32)
        n = min(SLICE_CHARS, len(x))
        small = np.minimum(x, 127)
        shape = _SHAPE[small]
        # five characters by their classes: markup, shouting, digits and the lengths of short words show here
        h = np.zeros(len(x), np.uint32)
        for k in range(5):
            h = h * np.uint32(7)
            h[: max(0, len(x) - k)] += shape[k:]
        buckets = ((h[:n] + np.uint32(1)) * _A) >> np.uint32(32 - BITS + 1)
        out += np.bincount(buckets.astype(np.int64), minlength=WIDTH)
        # three characters as they are: the frequent ones of clean prose, and repeats
        y = x * _B
        z = y.copy()
        z[: max(0, len(x) - 1)] += y[1:] * np.uint32(31)
        z[: max(0, len(x) - 2)] += y[2:] * np.uint32(961)
        buckets = ((z[:n] * _A) >> np.uint32(32 - BITS + 1)) + np.uint32(WIDTH // 2)
        out += np.bincount(buckets.astype(np.int64), minlength=WIDTH)
    return out


def _shapes() -> np.ndarray:
    """Classes of ASCII: blank 0, lower 1, upper 2, digit 3, stop 4, comma and quotes 5, else 6; what is beyond ASCII counts as lower."""
    out = np.full(128, 6, np.uint32)
    for i in range(127):
        c = chr(i)
        out[i] = 0 if c.isspace() else 1 if c.islower() else 2 if c.isupper() else 3 if c.isdigit() else 4 if c in ".\n" else 5 if c in ",'\"" else 6
    out[127] = 1
    return out


_SHAPE = _shapes()


def raw_vectors(texts: list[str | None]) -> np.ndarray:
    """One row per text: counts as shares of the text, so that its length does not tell."""
    out = np.zeros((len(texts), WIDTH), np.float32)
    for i, text in enumerate(texts):
        if text:
            n = _counts(text)
            out[i] = np.sqrt(n / n.sum())
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def _nearest(near: np.ndarray, k: int) -> np.ndarray:
    """The columns of the k largest values of each row; of equal ones the first."""
    least = np.partition(near, near.shape[1] - k, axis=1)[:, [near.shape[1] - k]]
    take = near >= least
    tied = np.flatnonzero(take.sum(axis=1) > k)
    if len(tied):
        above, equal = near[tied] > least[tied], near[tied] == least[tied]
        take[tied] = above | (equal & (np.cumsum(equal, axis=1) <= k - above.sum(axis=1, keepdims=True)))
    return np.nonzero(take)[1].reshape(len(near), k)


@dataclass(frozen=True)
class Model:
    scale: np.ndarray  # WIDTH
    basis: np.ndarray  # WIDTH x RANK
    vectors: np.ndarray  # labelled x RANK, unit rows in the order of doc_id
    labels: np.ndarray  # 0 or 1
    share: float  # of label 1

    def project(self, raw: np.ndarray) -> np.ndarray:
        return _unit((raw * self.scale) @ self.basis)

    def score(self, texts: list[str | None]) -> np.ndarray:
        out = np.full(len(texts), self.share)
        if not 0 < self.labels.sum() < len(self.labels):
            return out
        k = min(K, len(self.labels))
        for a in range(0, len(texts), BLOCK):
            raw = raw_vectors(texts[a : a + BLOCK])
            some = np.flatnonzero(raw.any(axis=1))
            if len(some):
                near = np.rint(self.project(raw[some]) @ self.vectors.T * STEPS) / STEPS
                best = _nearest(near, k)
                weight = np.maximum(np.take_along_axis(near, best, axis=1), 0).astype(np.float64) ** 4 + 1e-9
                out[a + some] = (weight * self.labels[best]).sum(axis=1) / weight.sum(axis=1)
        return np.clip(out, 0, 1)


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Model:
    """docs: doc_id, text; labels: doc_id, quality (0, 1 or null). The sample of labels has a documented bound, so it may be
    broadcast to the texts, and its vectors may meet on the driver."""
    known = labels.where("quality is not null").select("doc_id", F.col("quality").cast("int").alias("quality")).distinct()
    n = known.count()
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
    sample = known.where(place / float(1 << 20) < min(1.0, 1.25 * max_labelled / max(1, n))).orderBy(place, "doc_id", "quality").limit(max_labelled)
    chosen = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK):
                part = batch.slice(a, BLOCK)
                raw = raw_vectors(part.column(2).to_pylist()).astype(np.float16)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([zlib.compress(r.tobytes(), 1) for r in raw], pa.binary())], names=["doc_id", "quality", "raw"])

    rows = map_arrow(chosen.select(F.col("doc_id").cast("long"), "quality", "text"), vectors, "doc_id long, quality int, raw binary").toArrow().sort_by([("doc_id", "ascending"), ("quality", "ascending")])
    labels = np.array([int(x == 1) for x in rows["quality"].to_pylist()], np.int64)
    share = float(labels.mean()) if len(labels) else 0.5
    raw = np.empty((len(labels), WIDTH), np.float16)
    for i, x in enumerate(rows["raw"]):
        raw[i] = np.frombuffer(zlib.decompress(x.as_py()), np.float16)
    del rows
    some = raw.any(axis=1)
    if not some.all():
        raw, labels = raw[some], labels[some]
    scale = np.log1p(len(raw) / (1.0 + np.count_nonzero(raw, axis=0))).astype(np.float32)
    basis = _leading(raw, scale)
    vectors = [_unit(x @ basis) for x in _blocks(raw, scale)]
    model = Model(scale, basis, np.concatenate([np.zeros((0, basis.shape[1]), np.float32), *vectors]), labels, share)
    del raw
    trim()
    return model


def _blocks(raw: np.ndarray, scale: np.ndarray) -> Iterator[np.ndarray]:
    for a in range(0, len(raw), BLOCK):
        yield raw[a : a + BLOCK].astype(np.float32) * scale


def _leading(raw: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """The leading RANK right singular vectors of the scaled rows, by subspace iteration over blocks of them: all that it holds
    beside the rows is a few matrices of WIDTH x (RANK + SPARE)."""

    def times(q: np.ndarray) -> np.ndarray:
        out = np.zeros(q.shape, np.float32)
        for x in _blocks(raw, scale):
            out += x.T @ (x @ q)
        return out

    q = np.linalg.qr(np.random.default_rng(0).standard_normal((WIDTH, RANK + SPARE)).astype(np.float32))[0]
    for _ in range(ITERATIONS):
        q = np.linalg.qr(times(q))[0]
    inner = np.linalg.eigh(q.T.astype(np.float64) @ times(q))[1][:, ::-1][:, :RANK]
    return np.ascontiguousarray(q @ inner.astype(np.float32))


def predict(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`keep` columns and the score (how likely label 1 is) of every row of docs; the text alone decides."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    chosen = docs.select(*keep, F.col("text").alias("__text"))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 2_048):
                part = batch.slice(a, 2_048)
                score = shared.value.score(part.column(part.num_columns - 1).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(score, pa.float64())], names=[*part.schema.names[:-1], "score"])

    return map_arrow(chosen, run, f"{ddl}, score double")


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, as they are, whose score reaches the threshold."""
    shared, text = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 2_048):
                part = batch.slice(a, 2_048)
                yield part.filter(pa.array(shared.value.score(part.column(text).to_pylist()) >= threshold, pa.bool_()))

    return map_arrow(docs, run, ddl_of(docs))
