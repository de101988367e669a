"""Substring dedup: MinHash banding of paragraphs, exact Jaccard similarity, and removal of all but one place of each component.

A paragraph is a content-defined run of words: a text is cut before each word pair whose hash is the least within REACH words on
either side, so that a passage is cut alike wherever it stands, whatever surrounds it, and one of 50 words holds whole
paragraphs. Paragraphs have REACH + 1 words at least (but for the ends of a text) and MAX_WORDS at most.

1. The bands of a paragraph are the least MinHash values of its n distinct five-word shingles, each a band of one row. Their number is
   tuned to the threshold: two paragraphs at a Jaccard similarity of 0.8 share ceil(0.8 n) shingles at least, so with
   n - ceil(0.8 n) + 1 bands they share one for certain (a recall of 1). Bands that occur in one document only are dropped after a
   pre-aggregated count; a bit table of the others is what the paragraphs are filtered by where they are.
2. Equal paragraphs form classes. Classes that share a band are compared by the exact Jaccard similarity of their shingle sets: all
   pairs of up to SMALL classes. Bands of more (a shingle of a very common line) are replaced by the classes' rarest shingles, as
   many as any class at the threshold must share one of; where more than SMALL share one of these, each is compared with its
   leaders and the others by their differences from these (linking.py), so that pairs grow with the classes and none is lost.
3. Classes joined by links form components; a component that spans two documents or more repeats. Its first place (smallest
   doc_id, then start) is kept.
4. Seeds are runs of RUN_WORDS words whose hash is the least in a window of PASSAGE words (winnowing): equal passages of PASSAGE
   words or more have one in common wherever they stand, also where they hold no whole paragraph. They go through the steps
   above as classes of their own.
5. Touching places that are not kept are joined to stretches, and each is extended word by word to both sides as far as the words
   are those at the kept place of its outer paragraph or seed, CONTEXT words at most (a passage's outermost seed is no further from
   its end). Where its outer seed is aligned otherwise than its outer paragraph (which may be similar only), both are followed.
   Stretches count from RUN_WORDS words, with what they grow by. A kept place is given if a stretch that counts holds a place of its
   component, or of that of a seed in it, and if it has RUN_WORDS words with the parts that touch it.

Defined results: null, empty and wordless texts have no paragraphs; words are cut and folded as for shingles; offsets count characters;
repeated rows (doc_id and text) are one document; rows that share a doc_id but not a text are told apart by text_crc32, and what only
they share does not repeat across documents; a row without doc_id takes no part; a stretch's `no` and component are those of its first
part; no row is given for a document without repeated passages.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, ddl_of, map_arrow, materialize, sized, text_slices
from .linking import link
from .shingles import _LETTER, _STEP, mix

REACH = 6
MAX_WORDS = 64
SHINGLE, PERCENT = 5, 80
RUN_WORDS = 12
PASSAGE = 51
CONTEXT = PASSAGE - RUN_WORDS + 1
#: Classes that share a band and are compared with each other outright.
SMALL = 32
#: The bit table has 2 ** MAX_BITS bits at most (8 MB) and 16 per band below that; with more bands it lets more paragraphs through, and
#: loses none.
MAX_BITS = 26
#: Kept places that more than max(HOT, asks / MOST_HOT) stretches are compared with are looked up in a broadcast table: there are MOST_HOT
#: of them at most.
HOT, MOST_HOT = 256, 10_000
#: Up to so many paragraphs a slice's shingles are sorted within them by one 64-bit key.
_OWNERS = 1 << 20
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 32


_FOLDED = _LETTER[_FOLD]


@lru_cache(1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of _STEP, and of its inverse modulo 2 ** 64."""
    return tuple(np.cumprod(np.full(n, x, np.uint64)) for x in (int(_STEP), pow(int(_STEP), -1, 1 << 64)))


class Words:
    """The words of texts (bytes) in flat arrays: byte places first and last + 1 in flat, hash, and the text that each is of."""

    def __init__(self, data: list[bytes]):
        self.flat = flat = np.frombuffer(b" ".join([*data, b""]), np.uint8)
        sizes = np.array([len(d) + 1 for d in data], np.int64)
        self.begin = np.cumsum(sizes) - sizes
        blank = _SPACE[flat]
        turn = np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8))
        self.first, self.last = np.flatnonzero(turn == -1), np.flatnonzero(turn == 1)
        self.doc = np.searchsorted(self.begin, self.first, side="right") - 1
        if not len(self.first):
            self.hash = np.zeros(0, np.uint64)
            return
        # the bytes' random values weighted by powers of an odd number, which are those of the word's own places after division
        length = self.last - self.first
        kept = flat[~blank]
        at = np.cumsum(length) - length
        power, inverse = _powers(max(1 << 19, len(kept)))
        self.hash = mix(np.add.reduceat(_FOLDED[kept] * power[: len(kept)], at) * inverse[at] + length.astype(np.uint64))

    def characters(self) -> np.ndarray:
        """Of each byte, the number of characters of all texts (and the blanks between) up to it, itself included."""
        return np.cumsum((self.flat & 0xC0) != 0x80)


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


class Paragraphs:
    """The paragraphs of texts in UTF-8: index of the first word, number of words, hash; their five-word shingles in flat arrays."""

    def __init__(self, data: list[bytes]):
        self.words = words = Words(data)
        word, doc = words.hash, words.doc
        self.n = n = len(word)
        if not n:
            self.starts = self.count = self.doc = self.head = np.zeros(0, np.int64)
            self.hash, self.shingle, self.owner = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
            return
        # cuts: the least pair hash within REACH words on either side, the leftmost where equal
        pair = np.full(n, _TOP)
        pair[:-1] = mix(word[:-1] * _STEP + word[1:])
        same = np.flatnonzero(doc[:-1] != doc[1:])
        pair[same] = _TOP
        cut = pair != _TOP
        for k in range(1, REACH + 1):
            cut[k:] &= (pair[k:] < pair[:-k]) | (doc[k:] != doc[:-k])
            cut[:-k] &= (pair[:-k] <= pair[k:]) | (doc[k:] != doc[:-k])
        self.head = np.diff(doc, prepend=-1) != 0
        cut |= self.head
        starts = np.flatnonzero(cut)
        since = np.arange(n) - np.repeat(starts, np.diff(np.append(starts, n)))
        cut |= since % MAX_WORDS == 0
        self.starts = starts = np.flatnonzero(cut)
        self.count = count = np.diff(np.append(starts, n))
        self.doc = doc[starts]
        since = np.arange(n) - np.repeat(starts, count)
        # hashes of whole paragraphs and of their shingles
        self.hash = mix(np.add.reduceat(mix(word) * np.cumprod(np.full(MAX_WORDS, _STEP, np.uint64))[since], starts) + count.astype(np.uint64))
        run = np.full(n, np.uint64(SHINGLE))
        for k in range(SHINGLE):
            m = max(0, n - k)
            run[:m] = mix(run[:m] * _STEP + word[k:])
        self.run = run.copy()  # of SHINGLE words from each word on, whatever paragraphs they lie in
        inside = since + SHINGLE <= np.repeat(count, count)
        short = starts[count < SHINGLE]
        run[short], inside[short] = self.hash[count < SHINGLE], True
        self.owner = np.repeat(np.arange(len(starts)), count)[inside]
        self.shingle = run[inside]

    def bands(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys of the bands, the paragraph of each, and the number of distinct shingles of each paragraph."""
        owner, order = self.owner, mix(self.shingle ^ np.uint64(0x2545F4914F6CDD1D))
        if not len(owner):
            return order.astype(np.int64), owner, owner
        if len(self.starts) <= _OWNERS:
            bits = np.uint64(_OWNERS.bit_length() - 1)
            order = order[np.argsort((owner.astype(np.uint64) << (np.uint64(64) - bits)) | (order >> bits))]
        else:
            order = order[np.lexsort((order, owner))]
        new = np.concatenate([[True], (order[1:] != order[:-1]) | (owner[1:] != owner[:-1])])
        key, owner = order[new], owner[new]
        n_set = np.bincount(owner, minlength=len(self.starts))
        rank = np.arange(len(key)) - np.repeat(np.cumsum(n_set) - n_set, n_set)
        prefix = rank <= (n_set + -n_set * PERCENT // 100)[owner]
        return key[prefix].astype(np.int64), owner[prefix], n_set

    def seeds(self) -> tuple[np.ndarray, np.ndarray]:
        """The words at which seeds start, and their hashes."""
        if not self.n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        seeds, gram = _seeds(self.run, self.words.doc)
        return seeds, gram.astype(np.int64)

    def no(self) -> np.ndarray:
        """The number of each paragraph within its text."""
        first = np.flatnonzero(np.diff(self.doc, prepend=-1))
        return np.arange(len(self.starts)) - np.repeat(first, np.diff(np.append(first, len(self.starts))))

    def places(self, start: np.ndarray, count: np.ndarray) -> dict[str, np.ndarray]:
        """Of runs of count words from start on: doc, at (word), start, end (characters), closes (it ends its text)."""
        words = self.words
        chars = words.characters()
        doc = words.doc[start]
        base = chars[words.begin[doc]] - 1
        from_ = np.searchsorted(words.doc, doc)
        until = np.searchsorted(words.doc, doc, side="right")
        return {"doc": doc, "at": start - from_, "start": chars[words.first[start]] - 1 - base, "end": chars[words.last[start + count - 1] - 1] - base, "n_words": count, "closes": start + count == until}


def _seeds(shingle: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words at which a seed starts, and the seeds' hashes. shingle: of SHINGLE words from each word on."""
    windows, n = PASSAGE - RUN_WORDS + 1, len(doc) - PASSAGE + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    m = len(doc) - RUN_WORDS + 1
    gram = shingle[:m]
    for k in (SHINGLE, RUN_WORDS - SHINGLE):
        gram = mix(gram * _STEP + shingle[k : k + m])
    least = _sliding(np.minimum, gram, windows)
    least[doc[:n] != doc[PASSAGE - 1 :]] = 0  # windows that span two texts
    pad = np.zeros(windows - 1, np.uint64)
    seeds = np.flatnonzero((_sliding(np.maximum, np.concatenate([pad, least, pad]), windows) == gram) & (gram != 0))
    return seeds, mix(gram[seeds] ^ np.uint64(0x2127599BF4325C37))


def _sliding(function: np.ufunc, x: np.ndarray, width: int) -> np.ndarray:
    """function over each run of `width` values, by doubling."""
    have = 1
    while have * 2 <= width:
        x, have = function(x[:-have], x[have:]), have * 2
    return function(x[: len(x) - (width - have)], x[width - have :])


_PLACE = ["doc_id", "tid", "no", "at", "start", "end", "n_words", "n_set", "closes", "hash"]
_KINDS = [pa.int64(), pa.int64(), *[pa.int32()] * 6, pa.bool_(), pa.int64()]


def _texts(docs: DataFrame) -> DataFrame:
    """doc_id, tid (the text's CRC32, which tells rows with one doc_id apart) and text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).where("doc_id is not null")
    return chosen.select("doc_id", F.crc32("text").alias("tid"), "text")


def _keys(docs: DataFrame) -> DataFrame:
    """key, low and high (the least and the largest doc_id) of all bands and seeds, summed up within each slice of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_numpy(), batch.column(2).to_pylist()
            for a, b in text_slices(texts):
                p = Paragraphs([_bytes(t) for t in texts[a:b]])
                key, owner, _ = p.bands()
                seeds, seed = p.seeds()
                key, who = np.concatenate([key, seed]), ids[a:b][np.concatenate([p.doc[owner], p.words.doc[seeds]])]
                order = np.argsort(key)
                key, who = key[order], who[order]
                first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else order
                low, high = (f.reduceat(who, first) if len(key) else who for f in (np.minimum, np.maximum))
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (key[first], low, high)], names=["key", "low", "high"])

    return map_arrow(_texts(docs), run, "key long, low long, high long")


def _members(docs: DataFrame, marks: np.ndarray) -> DataFrame:
    """The paragraphs, and seeds with -1 - no of the paragraph they start in, that have keys whose bits are set; with those keys."""
    held, bits = docs.sparkSession.sparkContext.broadcast(marks), len(marks).bit_length() + 5

    def marked(key: np.ndarray) -> np.ndarray:
        take = np.ones(len(key), bool)
        for at in _probes(key, bits):
            take &= (held.value[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
        return take

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, tids, texts = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_pylist()
            for a, b in text_slices(texts):
                p = Paragraphs([_bytes(t) for t in texts[a:b]])
                key, owner, n_set = p.bands()
                take = marked(key)
                key, owner = key[take], owner[take]
                n = np.bincount(owner, minlength=len(p.starts))
                some = np.flatnonzero(n)
                seeds, seed = p.seeds()
                take = marked(seed)
                seeds, seed = seeds[take], seed[take]
                no = p.no()
                parts = p.places(np.concatenate([p.starts[some], seeds]), np.concatenate([p.count[some], np.full(len(seeds), RUN_WORDS)]))
                parts["no"] = np.concatenate([no[some], -1 - no[np.searchsorted(p.starts, seeds, side="right") - 1]])
                parts["n_set"] = np.concatenate([n_set[some], np.ones(len(seeds), np.int64)])
                parts["hash"] = np.concatenate([p.hash[some].astype(np.int64), seed])
                parts["doc_id"], parts["tid"] = ids[a:b][parts["doc"]], tids[a:b][parts["doc"]]
                arrays = [pa.array(parts[k].astype(t.to_pandas_dtype()), t) for k, t in zip(_PLACE, _KINDS, strict=True)]
                bounds = np.concatenate([[0], np.cumsum(np.concatenate([n[some], np.ones(len(seeds), np.int64)]))])
                keys = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(np.concatenate([key, seed]), pa.int64()))
                yield pa.RecordBatch.from_arrays([*arrays, keys], names=[*_PLACE, "keys"])

    return map_arrow(_texts(docs), run, "doc_id long, tid long, no int, at int, start int, end int, n_words int, n_set int, closes boolean, hash long, keys array<long>")


def _with_places(docs: DataFrame, places: DataFrame, how: str, size: Column) -> DataFrame:
    """The texts joined with rows by doc_id and tid, broadcast if they are small."""
    return _texts(docs).join(sized(materialize(places, "places"), size), ["doc_id", "tid"], how)


def _shingle_sets(docs: DataFrame, places: DataFrame, repeated: bool) -> DataFrame:
    """places: node, doc_id, tid, no, one of each paragraph class. Gives node and its distinct shingles, from the texts read again."""
    wanted = places.groupBy("doc_id", "tid").agg(F.collect_list(F.struct("no", "node")).alias("some"))
    chosen = _with_places(docs, wanted, "inner", F.lit(128) + 40 * F.size("some")).select("doc_id", "text", "some")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, some = batch.column(1).to_pylist(), batch.column(2)
            for a, b in text_slices(texts):
                p = Paragraphs([_bytes(t) for t in texts[a:b]])
                part = some.slice(a, b - a)
                flat, doc = part.flatten(), np.repeat(np.arange(b - a), part.value_lengths().to_numpy())
                which = np.searchsorted(p.doc, doc) + flat.field("no").to_numpy()
                bounds, shingle = np.searchsorted(p.owner, np.arange(len(p.doc) + 1)), p.shingle.astype(np.int64)
                sets = [np.unique(shingle[bounds[i] : bounds[i + 1]]) for i in which.tolist()]
                yield pa.RecordBatch.from_arrays([flat.field("node"), pa.array(sets, pa.list_(pa.int64()))], names=["node", "shingles"])

    sets = map_arrow(chosen, run, "node long, shingles array<long>")
    return sets.dropDuplicates(["node"]) if repeated else sets


def _linked(docs: DataFrame, members: DataFrame, classes: DataFrame, repeated: bool) -> DataFrame:
    """(node, component) of the classes of paragraphs that are linked with others."""
    keyed = members.where("no >= 0").select(F.col("hash").alias("node"), F.col("n_set").alias("n"), F.explode("keys").alias("key")).distinct()
    groups = keyed.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    keyed = materialize(keyed.join(groups, "key"), "near-keys")
    places = classes.join(keyed.select(F.col("node").alias("hash")).distinct(), "hash", "left_semi")
    sets = materialize(_shingle_sets(docs, places.select(F.col("hash").alias("node"), F.col("first.doc_id").alias("doc_id"), F.col("first.tid").alias("tid"), F.col("first.no").alias("no")), repeated), "shingle-sets")
    # bands of many: the rarest shingles of each of their classes
    hot = sets.join(keyed.where(F.col("members") > SMALL).select("node").distinct(), "node", "left_semi")
    each = hot.select("node", F.size("shingles").alias("n"), F.explode("shingles").alias("key"))
    often = each.groupBy("key").agg(F.count("*").alias("members"))
    order = F.sort_array(F.collect_list(F.struct("members", "key")))
    rarest = F.slice("order", F.lit(1), (F.col("n") - F.ceil(F.col("n") * PERCENT / 100) + 1).cast("int"))
    ranked = each.join(often, "key").groupBy("node", "n").agg(order.alias("order")).select("node", "n", F.explode(rarest).alias("o")).select("node", "n", F.col("o.key").alias("key"))
    groups = ranked.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    rare = materialize(ranked.join(groups, "key"), "rare-keys")
    few = keyed.where(F.col("members") <= SMALL).unionByName(rare.where(F.col("members") <= SMALL), allowMissingColumns=True).select("key", "node", "n")
    x, y = (few.select("key", F.col("node").alias(k), F.col("n").alias(f"n{k}")) for k in "ab")
    fit = (F.least("na", "nb") * 100 >= F.greatest("na", "nb") * PERCENT) & (F.col("a") > F.col("b"))
    pairs = x.join(y, "key").where(fit).select("a", "b")

    def compare(pairs: DataFrame) -> DataFrame:
        left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
        right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
        both = F.size(F.array_intersect("sa", "sb"))
        alike = both * 100 >= (F.size("sa") + F.size("sb") - both) * PERCENT
        return pairs.distinct().join(left, "a").join(right, "b").where(alike).select("a", "b")

    def differences(placed: DataFrame) -> DataFrame:
        left = sets.select(F.col("node").alias("x"), F.col("shingles").alias("sx"))
        right = sets.select(F.col("node").alias("lead"), F.col("shingles").alias("sl"))
        diff = F.concat(F.sort_array(F.array_except("sx", "sl")), F.sort_array(F.array_except("sl", "sx")))
        return placed.join(left, "x").join(right, "lead").select("lead", "x", "n", "lead_n", "at", "outside", diff.alias("diff"))

    return link(rare.where(F.col("members") > SMALL), PERCENT, compare, differences, pairs)


_PART = ["no", "at", "start", "end", "n_words", "closes", "component", "top_doc", "top_tid", "top_start", "top_end", "top_opens", "top_closes", "kept"]
_STRETCH = "doc_id long, tid long, no int, at int, end_at int, start int, end int, run_words int, kept boolean, components array<long>, top_doc long"
_ASK = "left boolean, pos int, word int, to_doc long, to_tid long, to_pos int"


def _running(x: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Of each row the largest x (0 or more) of the rows before it of its document (rows come by document), -1 for the first."""
    step = np.int64(x.max(initial=0)) + 2
    most = np.maximum.accumulate(x + 1 + doc * step)
    before = np.concatenate([[0], most[:-1]]) - doc * step - 1
    return np.maximum(before, -1)


def _stretches(doc: np.ndarray, p: dict[str, np.ndarray]) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    """The parts of documents (by doc, then at and no) as kept ones and as stretches of those that are not. Gives rows, the parts that
    these hold (indexes, with bounds), and what the stretches ask: row, left, pos, word, to_doc, to_tid, to_pos."""
    n, end = len(doc), p["at"] + p["n_words"]
    no = np.where(p["no"] >= 0, p["no"], -1 - p["no"])
    new = np.concatenate([[True], doc[1:] != doc[:-1]]) if n else np.zeros(0, bool)
    # runs of touching parts, kept or not
    run = np.cumsum(new | (p["at"] > _running(end, doc))) - 1
    cuts = np.flatnonzero(np.diff(run, prepend=-1))
    words = (np.maximum.reduceat(end, cuts) - p["at"][cuts])[run] if n else end
    # kept: paragraphs, and seeds that reach beyond the kept parts before them; the other seeds are held by the paragraph they start in
    kept = p["kept"]
    covered = _running(np.where(kept, end, 0), doc)
    alone = np.flatnonzero(kept & ((p["no"] >= 0) | (end > covered)))
    whole = np.flatnonzero(kept & (p["no"] >= 0))
    inner = np.flatnonzero(kept & (p["no"] < 0) & (end <= covered))
    step = np.int64(no.max(initial=0)) + 1
    around = np.searchsorted(alone, whole[np.searchsorted((doc * step + no)[whole], (doc * step + no)[inner])])
    # stretches of parts that are not kept
    rest = np.flatnonzero(~kept)
    doc_r, end_r, at_r, seed = doc[rest], end[rest], p["at"][rest], p["no"][rest] < 0
    first = np.flatnonzero((np.diff(doc_r, prepend=-1) != 0) | (at_r > _running(end_r, doc_r)))
    bounds = np.append(first, len(rest))
    size = np.diff(bounds)
    stretch = np.repeat(np.arange(len(first)), size)
    top = np.maximum.reduceat(end_r, first) if len(first) else end_r
    is_last = np.flatnonzero(end_r == top[stretch])
    last = is_last[np.flatnonzero(np.diff(stretch[is_last], prepend=-1))]
    seeds = np.flatnonzero(seed)
    lead_seed = np.flatnonzero(np.diff(stretch[seeds], prepend=-1))
    with_seed = stretch[seeds][lead_seed]
    first_seed, last_seed = seeds[lead_seed], seeds[np.append(lead_seed[1:], len(seeds)) - 1] if len(seeds) else seeds
    a, z, fs, ls = rest[first], rest[last], rest[first_seed], rest[last_seed]

    def turned(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether the kept places of two parts do not lie as the parts do."""
        apart = (p["top_doc"][x] != p["top_doc"][y]) | (p["top_tid"][x] != p["top_tid"][y])
        return apart | (p["start"][x] - p["start"][y] != p["top_start"][x] - p["top_start"][y]) | (p["end"][x] - p["end"][y] != p["top_end"][x] - p["top_end"][y])

    by_first = turned(a[with_seed], fs) & (p["at"][fs] - p["at"][a[with_seed]] < PASSAGE)
    by_last = turned(z[with_seed], ls) & (top[with_seed] - p["at"][ls] - RUN_WORDS < PASSAGE)
    rows = np.concatenate([np.arange(len(first)), with_seed[by_first], np.arange(len(first)), with_seed[by_last]])
    part = np.concatenate([a, fs[by_first], z, ls[by_last]])
    left = np.arange(len(part)) < len(first) + by_first.sum()
    word = np.where(left, p["at"][part], end[part])
    # nothing stands beyond the end of a text
    some = ~np.where(left, (word == 0) | p["top_opens"][part], p["closes"][part] | p["top_closes"][part])
    asks = {"row": rows, "left": left, "pos": np.where(left, p["start"][part], p["end"][part]), "word": word, "to_doc": p["top_doc"][part], "to_tid": p["top_tid"][part], "to_pos": np.where(left, p["top_start"][part], p["top_end"][part])}
    asks = {k: v[some] for k, v in asks.items()}
    asks["row"] = asks["row"] + len(alone)
    by_row = np.argsort(np.concatenate([np.arange(len(alone)), around]), kind="stable")
    held = np.concatenate([np.concatenate([alone, inner])[by_row], rest])
    sizes = np.concatenate([1 + np.bincount(around, minlength=len(alone)), size])
    one = np.concatenate([alone, a])
    out = {
        "doc": doc[one], "no": no[one], "at": p["at"][one], "end_at": np.concatenate([end[alone], top]), "start": p["start"][one],
        "end": np.concatenate([p["end"][alone], p["end"][z]]), "run_words": words[one], "kept": kept[one], "top_doc": p["top_doc"][one],
    }
    return out, held, np.concatenate([[0], np.cumsum(sizes)]), asks


def _parts_to_stretches(parts: DataFrame) -> DataFrame:
    """parts: doc_id, tid, parts (array of _PART structs)."""
    ddl = f"{_STRETCH}, asks array<struct<{', '.join(x.replace(' ', ':') for x in _ASK.split(', '))}>>"
    ask = [("left", pa.bool_()), ("pos", pa.int32()), ("word", pa.int32()), ("to_doc", pa.int64()), ("to_tid", pa.int64()), ("to_pos", pa.int32())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(2).flatten()
            doc = np.repeat(np.arange(batch.num_rows), batch.column(2).value_lengths().to_numpy())
            p = {k: flat.field(k).to_numpy(zero_copy_only=False) for k in _PART}
            p = {k: v if v.dtype == bool else v.astype(np.int64) for k, v in p.items()}
            order = np.lexsort((p["no"], p["at"], doc))
            doc, p = doc[order], {k: v[order] for k, v in p.items()}
            out, held, bounds, asks = _stretches(doc, p)
            by_row = np.argsort(asks["row"], kind="stable")
            ask_bounds = np.searchsorted(asks["row"][by_row], np.arange(len(out["no"]) + 1))
            structs = pa.StructArray.from_arrays([pa.array(asks[k][by_row].astype(t.to_pandas_dtype()), t) for k, t in ask], fields=[pa.field(k, t) for k, t in ask])
            who = pa.array(out["doc"], pa.int64())
            small = [pa.array(out[k].astype(np.int32)) for k in ("no", "at", "end_at", "start", "end", "run_words")]
            columns = [batch.column(0).take(who), batch.column(1).take(who), *small, pa.array(out["kept"]), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(p["component"][held])), pa.array(out["top_doc"]), pa.ListArray.from_arrays(pa.array(ask_bounds, pa.int32()), structs)]
            yield pa.RecordBatch.from_arrays(columns, names=[*(x.split()[0] for x in _STRETCH.split(", ")), "asks"])

    return map_arrow(parts, run, ddl)


def _around(words: Words, doc: np.ndarray, pos: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words before (left) or after pos (characters) of texts doc, CONTEXT at most, from the nearest on: their hashes, the
    character at which each ends on its far side, and the bounds of each spot's."""
    chars = words.characters()
    base = chars[words.begin] - 1
    starts, ends = chars[words.first] - 1, chars[words.last - 1]
    place = base[doc] + pos
    from_ = np.searchsorted(words.doc, doc)
    until = np.searchsorted(words.doc, doc, side="right")
    at = np.where(left, np.searchsorted(ends, place, side="right"), np.searchsorted(starts, place))
    at = np.clip(at, from_, until)
    n = np.minimum(CONTEXT, np.where(left, at - from_, until - at))
    bounds = np.concatenate([[0], np.cumsum(n)])
    k = np.arange(bounds[-1]) - np.repeat(bounds[:-1], n)
    side = np.repeat(left, n)
    which = np.repeat(at, n) + np.where(side, -1 - k, k)
    return words.hash[which].astype(np.int64), np.where(side, starts[which], ends[which]) - np.repeat(base[doc], n), bounds


def _extensions(docs: DataFrame, stretches: DataFrame, repeated: bool) -> DataFrame:
    """doc_id, tid, at, and the word and character to which each stretch grows on its left (from, low) and right (to, high), where it
    does."""
    asked = materialize(stretches.select("doc_id", "tid", "at", F.explode("asks").alias("s")).select("doc_id", "tid", "at", "s.*"), "asked")
    own = asked.select("doc_id", "tid", F.col("at").alias("of"), "left", "pos")
    targets = asked.select(F.col("to_doc").alias("doc_id"), F.col("to_tid").alias("tid"), F.lit(None).cast("int").alias("of"), "left", F.col("to_pos").alias("pos"))
    spots = own.unionByName(targets).groupBy("doc_id", "tid").agg(F.collect_set(F.struct("of", "left", "pos")).alias("spots"))
    joined = _with_places(docs, spots, "inner", F.lit(128) + 48 * F.size("spots")).select("doc_id", "tid", "text", "spots")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spots = batch.column(2).to_pylist(), batch.column(3)
            for a, b in text_slices(texts):
                part = spots.slice(a, b - a)
                flat, doc = part.flatten(), np.repeat(np.arange(b - a), part.value_lengths().to_numpy())
                left, pos = flat.field("left"), flat.field("pos")
                hashes, far, bounds = _around(Words([_bytes(t) for t in texts[a:b]]), doc, pos.to_numpy().astype(np.int64), left.to_numpy(zero_copy_only=False))
                bounds, who = pa.array(bounds, pa.int32()), pa.array(a + doc)
                columns = [batch.column(0).take(who), batch.column(1).take(who), flat.field("of"), left, pos, pa.ListArray.from_arrays(bounds, pa.array(hashes)), pa.ListArray.from_arrays(bounds, pa.array(far.astype(np.int32)))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "tid", "of", "left", "pos", "words", "far"])

    found = map_arrow(joined, read, "doc_id long, tid long, of int, left boolean, pos int, words array<long>, far array<int>")
    found = materialize(found.dropDuplicates(["doc_id", "tid", "of", "left", "pos"]) if repeated else found, "contexts")
    place = ["to_doc", "to_tid", "to_pos", "left"]
    kept = found.where("of is null").select(F.col("doc_id").alias("to_doc"), F.col("tid").alias("to_tid"), F.col("pos").alias("to_pos"), "left", F.col("words").alias("other"))
    mine = found.where("of is not null").select("doc_id", "tid", F.col("of").alias("at"), "left", "pos", "words", "far")
    often = asked.groupBy(place).agg(F.count("*").alias("n"))
    hot = often.where(F.col("n") > max(HOT, asked.count() // MOST_HOT)).drop("n")
    asks = asked.join(mine, ["doc_id", "tid", "at", "left", "pos"])
    hot = F.broadcast(materialize(kept.join(hot, place), "common-places"))
    pairs = asks.join(hot, place).unionByName(asks.join(hot.drop("other"), place, "left_anti").join(kept, place))
    pairs = pairs.select("doc_id", "tid", "at", "left", "pos", "word", "words", "far", "other")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, pos, word = (batch.column(k).to_numpy(zero_copy_only=False) for k in (3, 4, 5))
            n = _same(batch.column(6), batch.column(8))
            far = batch.column(7)
            starts = np.cumsum(far.value_lengths().to_numpy()) - far.value_lengths().to_numpy()
            flat = np.append(far.flatten().to_numpy(), 0)
            pos = np.where(n > 0, flat[np.minimum(starts + n - 1, len(flat) - 1)], pos)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(pos.astype(np.int32)), pa.array((word + np.where(left, -n, n)).astype(np.int32))], names=["doc_id", "tid", "at", "left", "pos", "word"])

    grown = map_arrow(pairs, compare, "doc_id long, tid long, at int, left boolean, pos int, word int")
    low = lambda name: F.min(F.when(F.col("left"), F.col(name)))
    high = lambda name: F.max(F.when(~F.col("left"), F.col(name)))
    return grown.groupBy("doc_id", "tid", "at").agg(low("pos").alias("low"), low("word").alias("from"), high("pos").alias("high"), high("word").alias("to"))


def _same(x: pa.ListArray, y: pa.ListArray) -> np.ndarray:
    """Of each row of two lists, how many values are equal from the first on."""
    a, b = (v.flatten().to_numpy() for v in (x, y))
    la, lb = (v.value_lengths().to_numpy().astype(np.int64) for v in (x, y))
    both = np.minimum(la, lb)
    k = np.arange(both.sum()) - np.repeat(np.cumsum(both) - both, both)
    equal = a[np.repeat(np.cumsum(la) - la, both) + k] == b[np.repeat(np.cumsum(lb) - lb, both) + k]
    out = both.copy()
    some = np.flatnonzero(both)
    if len(some):
        starts = (np.cumsum(both) - both)[some]
        out[some] = np.minimum(both[some], np.minimum.reduceat(np.where(equal, CONTEXT, k), starts))
    return out


def _probes(keys: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """Two bits of each key; they are least hashes, so their own upper bits are not even."""
    for salt in (0, 0x61C8864680B583EB):
        yield mix(keys.view(np.uint64) ^ np.uint64(salt)) >> np.uint64(64 - bits)


def _marks(keys: DataFrame) -> np.ndarray:
    """A bit table with two bits of each key set."""
    bits = min(MAX_BITS, max(16, 4 + keys.count().bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << bits - 6, np.uint64)
        for batch in batches:
            for at in _probes(batch.column(0).to_numpy(), bits):
                np.bitwise_or.at(table, at >> np.uint64(6), np.uint64(1) << (at & np.uint64(63)))
        used = np.flatnonzero(table)
        yield pa.RecordBatch.from_pydict({"at": used, "word": table[used].astype(np.int64)})

    found = map_arrow(keys, run, "at long, word long").groupBy("at").agg(F.bit_or("word").alias("word")).toArrow()
    table = np.zeros(1 << bits - 6, np.uint64)
    table[found["at"].to_numpy()] = found["word"].to_numpy().view(np.uint64)
    return table


def repeated_passages(docs: DataFrame, run_words: int = RUN_WORDS) -> DataFrame:
    """doc_id, no, start, end, n_words, component_id, first_doc_id, kept, text_crc32 of each passage that repeats across documents: of
    the paragraphs that are kept, and of whole stretches elsewhere."""
    with Scratch() as scratch:
        shared = _keys(docs).groupBy("key").agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low <> high").select("key")
        members = materialize(_members(docs, _marks(materialize(shared, "shared-keys"))), "members")
        # rows that repeat count once; that costs a shuffle only where a doc_id occurs twice
        repeated = not docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 and doc_id is not null").isEmpty()
        if repeated:
            members = materialize(members.dropDuplicates(["doc_id", "tid", "no", "at"]), "members")
        place = F.struct("doc_id", "start", "no", "end", "tid", (F.col("at") == 0).alias("opens"), "closes")
        classes = members.groupBy("hash").agg(F.min(place).alias("first"), F.max("doc_id").alias("high"))
        classes = materialize(classes, "classes")
        found = _linked(docs, members, classes, repeated)
        at = found.select(F.col("node").alias("hash"), F.col("component"))
        classes = classes.join(at, "hash", "left").withColumn("component", F.coalesce("component", "hash"))
        spans = classes.groupBy("component").agg(F.min("first").alias("top"), F.max("high").alias("high")).where(F.col("top.doc_id") != F.col("high"))
        top = [F.col(f"top.{x}").alias(f"top_{k}") for x, k in (("doc_id", "doc"), ("tid", "tid"), ("no", "no"), ("start", "start"), ("end", "end"), ("opens", "opens"), ("closes", "closes"))]
        chosen = materialize(classes.select("hash", "component").join(spans, "component").select("hash", "component", *top), "repeats")
        kept = F.expr("doc_id = top_doc and tid = top_tid and no = top_no and start = top_start")
        parts = members.drop("keys", "n_set").join(chosen, "hash").withColumn("kept", kept)
        parts = parts.groupBy("doc_id", "tid").agg(F.collect_list(F.struct(*_PART)).alias("parts"))
        stretches = scratch.keep(materialize(_parts_to_stretches(parts), "stretches"))
        here = ["doc_id", "tid"]
        grown = stretches.where("not kept").join(_extensions(docs, stretches, repeated), [*here, "at"], "left")
        grown = grown.withColumns({"start": F.least("start", "low"), "from": F.least("at", "from"), "end": F.greatest("end", "high"), "end_at": F.greatest("end_at", "to")})
        grown = grown.where(F.col("end_at") - F.col("from") >= run_words)
        before = Window.partitionBy(here).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
        grown = grown.withColumns({"start": F.greatest("start", F.max("end").over(before)), "from": F.greatest("from", F.max("end_at").over(before))})
        grown = grown.withColumn("n_words", F.col("end_at") - F.col("from"))
        grown = scratch.keep(materialize(grown.select(*here, "no", "start", "end", "n_words", "components", F.col("top_doc").alias("first_doc_id"), F.lit(False).alias("kept")), "grown"))

    first = stretches.where(F.col("kept") & (F.col("run_words") >= run_words)).select(*here, "no", "start", "end", (F.col("end_at") - F.col("at")).alias("n_words"), "components", F.col("top_doc").alias("first_doc_id"), "kept")
    place = [*here, "start", "end"]
    cut = grown.select(F.explode("components").alias("component")).distinct()
    found = first.select(*place, F.explode("components").alias("component")).join(cut, "component", "left_semi").select(place).distinct()
    names = ["doc_id", "no", "start", "end", "n_words", F.col("components")[0].alias("component_id"), "first_doc_id", "kept", F.col("tid").alias("text_crc32")]
    return grown.where("end > start").select(names).unionByName(first.join(found, place, "left_semi").select(names))


def remove_repeats(docs: DataFrame, passages: DataFrame) -> DataFrame:
    """docs without the passages that are not kept: each is cut out with the white space after it; other columns stay."""
    gone = passages.where(~F.col("kept")).groupBy("doc_id", F.col("text_crc32").alias("__tid")).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("__gone"))
    rows = materialize(gone.withColumnRenamed("doc_id", "__id"), "cuts")
    marked = docs.withColumns({"__own": F.col("doc_id").cast("long"), "__crc": F.crc32(F.coalesce(F.col("text").cast("string"), F.lit("")))})
    joined = marked.join(sized(rows, F.lit(128) + 40 * F.size("__gone")), F.expr("__own = __id and __crc = __tid"), "left").select(*docs.columns, "__gone")
    names = joined.columns
    text, spans = names.index("text"), names.index("__gone")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, cuts = batch.column(text).to_pylist(), batch.column(spans).to_pylist()
            columns = list(batch.columns[:-1])
            columns[text] = pa.array([_without(t, c) if c else t for t, c in zip(texts, cuts, strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names[:-1])

    return map_arrow(joined, run, ddl_of(joined.drop("__gone"))).select(*docs.columns)


def _without(text: str, cuts: list[dict]) -> str:
    out, at = [], 0
    for c in cuts:
        out.append(text[at : c["start"]])
        at = c["end"]
        while at < len(text) and text[at] in " \t\n\v\f\r":
            at += 1
    return "".join([*out, text[at:]])
