"""Near-duplicate documents by HyperMinHash.

A document's shingle hashes fall into BUCKETS buckets by their leading bits. Of the least value in each bucket a 16-bit register keeps
the number of leading zeros (6 bits) and the MANTISSA bits that follow the first one; an empty bucket takes the register of a donor
bucket, tried in an order that is the same for all documents. BANDS bands of ROWS registers are hashed to keys: two documents at the
threshold 0.85 share at least one with a probability of 1 - 3e-7, at 0.8 of 1 - 7e-5.

1. Rows with equal sets form classes (counts are pre-aggregated); one row stands for each.
2. Classes that share a key form a group. Its most central member (whose keys many others share) leads it, and every
   member is compared with its leaders: pairs grow with the members, not with their square. Their components are found.
3. What is left are pairs with one leader whose components differ, at least one of them outside the leader's component. The members'
   differences from the leader are joined by prefix filtering, which finds every pair at the threshold. Where members share
   a difference, those of the component that has most of them there meet the others only, never each other.

A pair of large sets is compared by the collision-corrected Jaccard estimate of its registers first; unless that lies well below the
threshold, and for all smaller sets, the full sets decide. No group is capped: members of one component need no more
comparisons, the others get them all.

Defined results: a null or wordless text has an empty set, no links, and is kept. Rows are documents of their own, also where they share
a doc_id; a row's component_id is the smallest doc_id among the rows that it is linked with. A row without doc_id has its n_shingles, no
component_id, no links, and is kept. The order of rows decides nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, map_arrow, materialize, with_rows_of
from .linking import link
from .shingles import mix, shingle_hashes, text_words, word_hashes

BUCKETS, ROWS = 192, 6
BANDS = BUCKETS // ROWS
MANTISSA = 10
#: Standard errors below the threshold at which an estimate is believed without a look at the sets.
MARGIN = 6.0
#: Sets of fewer shingles leave buckets empty, so that registers repeat: they are compared as they are.
ESTIMATED = 4 * BUCKETS
#: Classes with more than max(HOT, rows / MOST_HOT) rows are looked up in a broadcast table: there are MOST_HOT of them at most.
HOT, MOST_HOT = 256, 100_000


def _donors() -> np.ndarray:
    """Row j: the order in which an empty bucket j asks the others; j itself comes first."""
    order = np.argsort(mix(np.arange(BUCKETS * BUCKETS, dtype=np.uint64)).reshape(BUCKETS, BUCKETS), axis=1)
    own = np.arange(BUCKETS)[:, None]
    return np.concatenate([own, order[order != own].reshape(BUCKETS, BUCKETS - 1)], axis=1)


_DONORS = _donors()


def registers(hashes: np.ndarray) -> np.ndarray:
    """Registers of a sorted set of shingle hashes: BUCKETS uint32, the donor's number above the 16 bits."""
    # hash * BUCKETS in 128 bits: the upper half is the bucket, the lower half the place in it, in the order of the hashes
    low = ((hashes & np.uint64(0xFFFFFFFF)) * np.uint64(BUCKETS)) >> np.uint64(32)
    bucket = (((hashes >> np.uint64(32)) * np.uint64(BUCKETS) + low) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    least = hashes[first] * np.uint64(BUCKETS)
    high = np.floor(np.log2((least >> np.uint64(11)).astype(np.float64) + 0.5)).astype(np.int64)
    zeros = 52 - np.clip(high, 0, 52)
    shift = np.maximum(high + 11 - MANTISSA, 0).astype(np.uint64)
    mantissa = (least >> shift) & np.uint64((1 << MANTISSA) - 1)
    register = (zeros.astype(np.uint64) << np.uint64(MANTISSA)) | mantissa
    held = np.zeros(BUCKETS, np.uint32)
    full = np.zeros(BUCKETS, bool)
    held[bucket[first]], full[bucket[first]] = register.astype(np.uint32), True
    donor = np.arange(BUCKETS)
    empty = np.flatnonzero(~full)
    if len(empty):
        donor[empty] = _DONORS[empty, full[_DONORS[empty]].argmax(axis=1)]
    return held[donor] | (donor.astype(np.uint32) << np.uint32(16))


def band_keys(regs: np.ndarray) -> np.ndarray:
    """One key per band, for rows of registers."""
    h = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(regs), BANDS))
    parts = regs.reshape(len(regs), BANDS, ROWS).astype(np.uint64)
    for k in range(ROWS):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, k])
    return h.astype(np.int64)


def collisions(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The share of registers that are equal by chance, though their least values differ, of sets of n and m shingles: the sum over
    all cells (octave and mantissa) of both sets' chances to have their least value there."""
    a, b = (np.maximum(np.asarray(x, np.float64), 1)[..., None] / BUCKETS for x in (n, m))
    low = 2.0 ** -np.arange(1.0, 54)
    within = np.exp(-(a + b) * low) - np.exp(-2 * (a + b) * low)
    both_full = np.expm1(-a) * np.expm1(-b)
    return (low * 2.0**-MANTISSA * a * b / (a + b) * within / both_full).sum(axis=-1)


def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard estimates of rows of registers of sets of n and m shingles: the share of equal ones, less what collisions add."""
    same, by_chance = (a == b).mean(axis=-1), collisions(n, m)
    return np.clip((same - by_chance) / (1 - by_chance), 0, 1)


def shingle_set(text: str | None, size: int) -> np.ndarray:
    return np.unique(shingle_hashes(word_hashes(text_words(text)), size))


def _class_hash(s: np.ndarray) -> tuple[int, int]:
    """Two hashes of a set, whatever its order; 0, 0 of an empty one."""
    return int(mix(s).sum().astype(np.int64)), int(mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum().astype(np.int64))


def _signed(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n_shingles, class_hash (two halves), keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 1_024):
                part = batch.slice(a, 1_024)
                n, one, two, regs = [], [], [], np.zeros((part.num_rows, BUCKETS), np.uint32)
                for i, text in enumerate(part.column(1)):
                    s = shingle_set(text.as_py(), size)
                    a_hash, b_hash = _class_hash(s)
                    n.append(len(s))
                    one.append(a_hash)
                    two.append(b_hash)
                    if len(s):
                        regs[i] = registers(s)
                keys = pa.ListArray.from_arrays(pa.array(np.arange(part.num_rows + 1) * BANDS, pa.int32()), pa.array(band_keys(regs).ravel()))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), keys], names=["doc_id", "n_shingles", "one", "two", "keys"])

    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, "doc_id long, n_shingles long, one long, two long, keys array<long>")


def _sets(docs: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """node, shingle set (sorted, as bytes) and, of sets large enough, registers of the classes `nodes` (doc_id, one, two, node), read
    again."""
    chosen = with_rows_of(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), nodes, "inner", 100)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                sets = [shingle_set(t.as_py(), size) for t in part.column(0)]
                # rows that share a doc_id may differ: the class's own one is meant
                own = [i for i, (s, one, two) in enumerate(zip(sets, part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True)) if _class_hash(s) == (one, two)]
                columns = [part.column(3).take(pa.array(own, pa.int32())), pa.array([sets[i].tobytes() for i in own], pa.binary()), pa.array([registers(sets[i]).tobytes() if len(sets[i]) >= ESTIMATED else b"" for i in own], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "hashes", "regs"])

    return map_arrow(chosen.select("text", "one", "two", "node"), run, "node long, hashes binary, regs binary").dropDuplicates(["node"])


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose sets have 100 * intersection >= percent * union."""
    left = sets.select(F.col("node").alias("a"), F.col("hashes").alias("ha"), F.col("regs").alias("ra"))
    right = sets.select(F.col("node").alias("b"), F.col("hashes").alias("hb"), F.col("regs").alias("rb"))
    joined = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "ha", "hb", "ra", "rb")
    need = percent / 100
    least = need - MARGIN * np.sqrt(need * (1 - need) / BUCKETS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1_024):
                part = batch.slice(start, 1_024)
                n, m = (np.array([len(h.as_buffer()) // 8 for h in part.column(k)], np.int64) for k in (2, 3))
                large = np.flatnonzero(np.minimum(n, m) >= ESTIMATED)
                regs = [np.frombuffer(b"".join(part.column(k).take(pa.array(large)).to_pylist()), np.uint32).reshape(-1, BUCKETS) for k in (4, 5)]
                look = np.ones(part.num_rows, bool)
                look[large] = estimate(*regs, n[large], m[large]) >= least
                keep = np.zeros(part.num_rows, bool)
                for i in np.flatnonzero(look):
                    x, y = (np.frombuffer(part.column(k)[int(i)].as_buffer(), np.uint64) for k in (2, 3))
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep[i] = 100 * both >= percent * (len(x) + len(y) - both)
                yield pa.RecordBatch.from_arrays([part.column(k).filter(pa.array(keep)) for k in (0, 1)], names=["a", "b"])

    return map_arrow(joined, run, "a long, b long")


def _differences(placed: DataFrame, sets: DataFrame) -> DataFrame:
    """placed with `diff`: the hashes by which the set of x differs from its leader's, those that x has first."""
    left = sets.select(F.col("node").alias("x"), F.col("hashes").alias("hx"))
    right = sets.select(F.col("node").alias("lead"), F.col("hashes").alias("hl"))
    joined = placed.join(left, "x").join(right, "lead").select("lead", "x", "n", "lead_n", "at", "outside", "hx", "hl")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                diffs = []
                for hx, hl in zip(part.column(6), part.column(7), strict=True):
                    own, lead = np.frombuffer(hx.as_buffer(), np.uint64), np.frombuffer(hl.as_buffer(), np.uint64)
                    diffs.append(np.concatenate([np.setdiff1d(own, lead, assume_unique=True), np.setdiff1d(lead, own, assume_unique=True)]).astype(np.int64))
                yield pa.RecordBatch.from_arrays([*part.columns[:6], pa.array(diffs, pa.list_(pa.int64()))], names=["lead", "x", "n", "lead_n", "at", "outside", "diff"])

    return map_arrow(joined, run, "lead long, x long, n long, lead_n long, at long, outside boolean, diff array<long>")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of docs."""
    with Scratch() as scratch:
        signed = scratch.keep(materialize(_signed(docs, size).withColumn("row", F.monotonically_increasing_id()), "signatures"))
        key = ["one", "two", "n_shingles"]
        full = signed.where("n_shingles > 0 and doc_id is not null")
        classes = full.groupBy(key).agg(F.min("doc_id").alias("first"), F.min("row").alias("node"), F.count("*").alias("copies"))
        classes = materialize(classes, "classes")
        reps = full.join(classes.select(F.col("node").alias("row")), "row", "left_semi")
        reps = materialize(reps.select(F.col("row").alias("node"), F.col("n_shingles").alias("n"), "keys"), "representatives")
        banded = reps.select("node", "n", F.explode("keys").alias("key"))
        shared = banded.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
        members = materialize(banded.join(shared, "key"), "members")
        wanted = members.select("node").distinct().join(classes, "node").select(F.col("first").alias("doc_id"), "one", "two", "node")
        sets = materialize(_sets(docs, wanted, size), "sets")
        linked = link(members, percent, lambda pairs: _linked(pairs, sets, percent), lambda placed: _differences(placed, sets))
        nodes = linked.unionByName(linked.select(F.col("component").alias("node"), "component").distinct())
        nodes = nodes.join(classes.select("node", "first"), "node")
        least = nodes.groupBy("component").agg(F.min("first").alias("component_id"))
        nodes = nodes.join(least, "component").select("node", "component_id")
        by_class = classes.join(nodes, "node", "left").select(*key, "copies", F.coalesce("component_id", "first").alias("component_id"))
        by_class = scratch.keep(materialize(by_class, "components"))

    # the rows of classes with very many are looked up where they are, the others meet their class by a shuffle
    most = max(HOT, signed.count() // MOST_HOT)
    hot = F.broadcast(by_class.where(F.col("copies") > most).drop("copies"))
    names = ["doc_id", "n_shingles", "component_id"]
    rows = full.select("doc_id", *key)
    many = rows.join(hot, key).select(names)
    few = rows.join(hot, key, "left_anti").join(by_class.where(F.col("copies") <= most), key).select(names)
    alone = signed.where("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    out = many.unionByName(few).unionByName(alone)
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """docs without those that a near duplicate of smaller doc_id stands for; the rows of a doc_id stay if one of them is kept."""
    gone = near_duplicates(docs, size, percent).groupBy("doc_id").agg(F.max("kept").alias("kept")).where(~F.col("kept")).select("doc_id")
    return with_rows_of(docs, gone, "left_anti").select(*docs.columns)


#: near_duplicates(size=3, percent=85).
ORACLE_SQL = r"""
with recursive split as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
  from documents),
words as (select doc_id, len(w) as n_words, unnest(w) as x, generate_subscripts(w, 1) as i from split),
runs as (
  select doc_id, n_words, i, x, lead(x) over next as y, lead(x, 2) over next as z from words
  window next as (partition by doc_id order by i)),
shingles as (
  select distinct doc_id, case when n_words = 1 then x when n_words = 2 then x || ' ' || y else x || ' ' || y || ' ' || z end as shingle
  from runs where i <= greatest(1, n_words - 2)),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
pairs as (
  select a.doc_id as a, b.doc_id as b, count(*) as n_both from shingles a join shingles b on a.shingle = b.shingle and a.doc_id < b.doc_id
  group by a.doc_id, b.doc_id),
links as (
  select a, b from pairs join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * n_both >= 85 * (x.n + y.n - n_both)),
edges as (select a, b from links union all select b, a from links),
reach as (select a as doc_id, b from edges union select r.doc_id, e.b from reach r join edges e on r.b = e.a),
least as (select doc_id, min(b) as low from reach group by doc_id)
select d.doc_id, coalesce(n, 0) as n_shingles, least(d.doc_id, coalesce(low, d.doc_id)) as component_id,
  d.doc_id = least(d.doc_id, coalesce(low, d.doc_id)) as kept
from documents d left join sizes using (doc_id) left join least using (doc_id)
"""
