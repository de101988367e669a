"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training sums n-gram counts per language on the executors; one count vector per language is what reaches the driver. Scoring
broadcasts the log-probability matrix (languages x BUCKETS floats) and sums, per text, the rows its n-grams select, in numpy.

Defined results: a null text, or one without a letter, is `und` with score 0; ties go to the language that sorts first; a text
is always read whole, in slices that share two characters so that no n-gram is lost. With no labelled row every text is `und`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SLICE_CHARS, ddl_of, map_arrow, text_slices

BITS = 14
ORDERS = 3
#: A model learns from about so many labelled texts per language at most, chosen by a hash of their id.
MAX_TRAIN_PER_LANG = 20_000
SMOOTHING = 0.1
#: A text so many standard deviations below its language's mean is in none of the learned languages.
DEVIATIONS = 10
#: Texts of fewer n-grams (a word or two) cannot be told from foreign ones and are not rejected for this.
LEAST_GRAMS = 16
#: Labelled rows from which their spread is known.
LEAST_ROWS = 100
_PRIMES = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35))


@cache
def letters() -> np.ndarray:
    """For every code point whether it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _pieces(texts: list[str | None]) -> Iterator[tuple[int, str, bool]]:
    """(index, piece, last of its text): long texts come in pieces which overlap by ORDERS - 1 characters."""
    for i, text in enumerate(texts):
        text = (text or "").lower()
        for a in range(0, max(1, len(text)), SLICE_CHARS):
            yield i, text[a : a + SLICE_CHARS + ORDERS - 1], a + SLICE_CHARS >= len(text)


def gram_buckets(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of (text index, letter flag, buckets): buckets[k] are those of the n-grams of k + 1 characters that start at each
    place. All runs of other characters than letters count as one blank; n-grams end at the text's end."""
    table = letters()

    def block(parts: list[tuple[int, str, bool]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        # a blank and a stop mark end each piece, so that no n-gram runs into the next
        points = code_points("".join(f"{p}\0\0" for _, p, _ in parts))
        sizes = np.array([len(p) + 2 for _, p, _ in parts])
        owner = np.repeat(np.array([i for i, _, _ in parts]), sizes)
        # what is past a slice belongs to the next one: its n-grams start there
        start = np.ones(len(points), bool)
        ends = np.cumsum(sizes)
        for (_, _, last), end in zip(parts, ends, strict=True):
            if not last:
                start[end - 2 - (ORDERS - 1) : end] = False
        letter = table[points]
        keep = letter.copy()
        keep[1:] |= letter[:-1]  # the first of a run of others stands for the run
        keep[0] = True
        points, owner, start, letter = np.where(letter, points, 32)[keep].astype(np.uint32), owner[keep], start[keep], letter[keep]
        out, h = [], np.zeros(len(points), np.uint32)
        for k in range(ORDERS):
            h = h * _PRIMES[0]
            h[: max(0, len(points) - k)] += (points[k:] + np.uint32(1)) * _PRIMES[1]
            mixed = (h ^ (h >> np.uint32(15))) * _PRIMES[2]
            out.append((mixed >> np.uint32(32 - BITS)).astype(np.int32))
        return owner[start], letter[start], np.stack(out)[:, start]

    parts, size = [], 0
    for part in _pieces(texts):
        if parts and size + len(part[1]) > SLICE_CHARS:
            yield block(parts)
            parts, size = [], 0
        parts.append(part)
        size += len(part[1])
    if parts:
        yield block(parts)


@dataclass(frozen=True)
class Model:
    langs: list[str]
    prior: np.ndarray  # log, of each language
    weights: np.ndarray  # log-probabilities, BUCKETS x languages

    def score(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        return self.measure(texts)[:2]

    def measure(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Language, score, mean log-likelihood per n-gram in that language, and n-grams of each order."""
        total = np.zeros((len(texts), len(self.langs)))
        grams, has_letter = np.zeros(len(texts)), np.zeros(len(texts), bool)
        for owner, letter, buckets in gram_buckets(texts):
            cuts = np.flatnonzero(np.diff(owner, prepend=-1))
            if not len(cuts):
                continue
            who = owner[cuts]
            values = self.weights[buckets[0]]
            for row in buckets[1:]:
                values += self.weights[row]
            np.add.at(total, who, np.add.reduceat(values, cuts, axis=0, dtype=np.float64))
            np.add.at(grams, who, np.diff(np.append(cuts, len(owner))))
            has_letter[who] |= np.logical_or.reduceat(letter, cuts)
        if not self.langs:
            return ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts)), grams
        # the orders overlap and are not independent: their mean stands for one of them
        post = self.prior + total / ORDERS
        post -= post.max(axis=1, keepdims=True)
        prob = np.exp(post)
        prob /= prob.sum(axis=1, keepdims=True)
        best = prob.argmax(axis=1)
        pred = [self.langs[b] if ok else "und" for b, ok in zip(best, has_letter, strict=True)]
        mean = total[np.arange(len(texts)), best] / ORDERS / np.maximum(grams, 1)
        return pred, np.where(has_letter, prob.max(axis=1), 0.0), mean, grams


@dataclass(frozen=True)
class Spread:
    """Of the mean log-likelihood per n-gram of known texts: the mean in each language, and a variance of base + per_gram / n-grams,
    and the furthest that a labelled text lies below its language's mean: no labelled text is rejected."""

    means: dict[str, float]
    base: float
    per_gram: float
    furthest: float

    def known(self, pred: list[str], mean: np.ndarray, grams: np.ndarray) -> np.ndarray:
        centre = np.array([self.means.get(x, -np.inf) for x in pred])
        room = DEVIATIONS * np.sqrt(self.base + self.per_gram / np.maximum(grams, 1))
        return (grams < LEAST_GRAMS) | (mean >= centre - np.maximum(room, self.furthest))


def spread_of(labelled: DataFrame, model: Model) -> Spread | None:
    """Over all labelled rows; None if they are too few to tell. Sums per language are what reaches the driver."""
    shared = labelled.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 2_048):
                pred, _, mean, grams = shared.value.measure(batch.slice(a, 2_048).column(0).to_pylist())
                yield pa.RecordBatch.from_arrays([pa.array(pred, pa.string()), pa.array(mean), pa.array(1 / np.maximum(grams, 1))], names=["lang", "m", "r"])

    rows = map_arrow(labelled.where("lang is not null").select("text"), run, "lang string, m double, r double").where("lang <> 'und'")
    sums = [F.sum(x).alias(k) for k, x in {"n": F.lit(1), "m": F.col("m"), "mm": F.expr("m*m"), "r": F.col("r"), "rr": F.expr("r*r"), "rm": F.expr("r*m"), "rmm": F.expr("r*m*m")}.items()]
    least = F.min(F.when(F.col("r") * LEAST_GRAMS <= 1, F.col("m")))
    found = rows.groupBy("lang").agg(*sums, least.alias("least")).collect()
    n = sum(x["n"] for x in found)
    if n < LEAST_ROWS:
        return None
    # least squares of the squared distances from the language's mean on the reciprocal of the n-grams
    means = {x["lang"]: x["m"] / x["n"] for x in found}
    d = sum(x["mm"] - x["m"] * means[x["lang"]] for x in found)
    rd = sum(x["rmm"] - 2 * x["rm"] * means[x["lang"]] + x["r"] * means[x["lang"]] ** 2 for x in found)
    r, rr = (sum(x[k] for x in found) for k in ("r", "rr"))
    room = n * rr - r * r
    slope = max(0.0, (n * rd - r * d) / room) if room > 1e-12 else 0.0
    furthest = max((means[x["lang"]] - x["least"] for x in found if x["least"] is not None), default=0.0)
    return Spread(means, max(1e-3, (d - slope * r) / n), slope, furthest + 1e-6)


def crc_bucket(id_column: Column, modulus: int) -> Column:
    return F.crc32(id_column.cast("string")) % modulus


def fit(labelled: DataFrame, max_per_lang: int = MAX_TRAIN_PER_LANG) -> Model:
    """labelled: doc_id, text, lang. Counts are pre-aggregated inside each task, then summed per language and bucket."""
    rows = {r["lang"]: r["n"] for r in labelled.where("lang is not null").groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(rows)
    if not langs:
        return Model([], np.zeros(0), np.zeros((1 << BITS, 0), np.float32))
    share = F.create_map(*[F.lit(x) for k in langs for x in (k, min(1.0, max_per_lang / rows[k]))])
    part = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    chosen = labelled.where("lang is not null").where(part < share[F.col("lang")]).select("text", "lang")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(langs), 1 << BITS), np.int64)
        at = {k: i for i, k in enumerate(langs)}
        for batch in batches:
            lang = np.array([at[x] for x in batch.column(1).to_pylist()], np.int64)
            texts = batch.column(0).to_pylist()
            for a, b in text_slices(texts):
                for owner, _, buckets in gram_buckets(texts[a:b]):
                    cell = lang[a:b][owner] << BITS
                    for row in buckets:
                        sums += np.bincount(cell + row, minlength=sums.size).reshape(sums.shape)
        k, bucket = np.nonzero(sums)
        yield pa.RecordBatch.from_pydict({"k": k.astype(np.int32), "bucket": bucket.astype(np.int32), "n": sums[k, bucket]})

    counted = map_arrow(chosen, count, "k int, bucket int, n long").groupBy("k", "bucket").agg(F.sum("n").alias("n")).toArrow()
    n = np.zeros((1 << BITS, len(langs)))
    n[counted["bucket"].to_numpy(), counted["k"].to_numpy()] = counted["n"].to_numpy()
    prior = np.log([rows[k] for k in langs]) - np.log(sum(rows.values()))
    return Model(langs, prior, np.log((n + SMOOTHING) / (n + SMOOTHING).sum(axis=0)).astype(np.float32))


def predict(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`keep` columns, lang_pred and score of every row of docs; the text alone decides."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    chosen = docs.select(*keep, F.col("text").alias("__text"))
    fields = [*chosen.schema.fields[:-1]]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 2_048):
                part = batch.slice(a, 2_048)
                pred, score = shared.value.score(part.column(part.num_columns - 1).to_pylist())
                columns = [*part.columns[:-1], pa.array(pred, pa.string()), pa.array(score, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names[:-1], "lang_pred", "score"])

    return map_arrow(chosen, run, f"{ddl}, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: Model, min_score: float = 0.5, spread: Spread | None = None) -> DataFrame:
    """The rows of docs, as they are, whose language is known with a score of at least min_score. The score says which of the learned
    languages it is; with a spread, texts in none of them (or in no language) are rejected too."""
    shared, text = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 2_048):
                part = batch.slice(a, 2_048)
                pred, score, mean, grams = shared.value.measure(part.column(text).to_pylist())
                keep = (np.array(pred, object) != "und") & (score >= min_score)
                yield part.filter(pa.array(keep & spread.known(pred, mean, grams) if spread else keep, pa.bool_()))

    return map_arrow(docs, run, ddl_of(docs))
