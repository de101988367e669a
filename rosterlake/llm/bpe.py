"""Byte-pair encoding in batched numpy merge rounds, and decoding.

The symbols of many words lie in one flat array. A round looks every adjacent pair up by binary search over the sorted pair
keys, finds the lowest rank of each word, and merges all its places (from the left where they overlap); words without a
mergeable pair leave. Texts are cut at white space first, and what a piece encodes to is kept in a bounded table of the
worker, so that merging happens once for a piece and not once for each of its occurrences.

Two kinds of tokenizer file are read: byte-level with a leading blank, and word-end with lower case. Defined results: a
null text counts as empty and has no token; control strings of the file in a text are single tokens, as in the tokenizers library.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, text_slices

#: Pieces in a worker's young table (twice as many of those with a blank before them), and characters and bytes of ids that it holds
#: for each of them; at that many of either it becomes the old one, and the old one goes. So long pieces take no more than short ones.
MAX_KEPT = 150_000
HELD_EACH = 64
# White space as Unicode has it; str.split() also cuts at U+001C to U+001F.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_WORD_SPLIT = rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{_SPACE}\p{{L}}\p{{N}}]+"
_BYTE_SPLIT = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"


@cache
def byte_letters() -> list[str]:
    """The printable letter of each byte in byte-level vocabularies: itself if it is visible, else the next from U+0100 on."""
    out, spare = [], 0x100
    for b in range(256):
        visible = 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF
        out.append(chr(b if visible else spare))
        spare += not visible
    return out


class _Kept(dict):
    """The place of each piece in `ids`. A piece that is asked for and not there gets the next place, filled from the
    old table or, later, by learning what is in `new`. A full table becomes the old one of an empty one, and its own old one goes."""

    def __init__(self, most: int, old: _Kept | None = None):
        super().__init__()
        self.most, self.old = most, old
        self.ids: list[bytes] = []
        self.new: list[tuple[str, int]] = []
        self.held = 0

    def __missing__(self, piece: str) -> int:
        ids, old = self.ids, self.old
        at = self[piece] = len(ids)
        was = None if old is None else old.get(piece)
        if was is None:
            self.new.append((piece, at))
            ids.append(b"")
        else:
            ids.append(old.ids[was])
            self.held += len(piece) + len(ids[at])
        return at

    def turned(self) -> _Kept:
        if len(self) <= self.most and self.held <= self.most * HELD_EACH:
            return self
        self.old = None
        return _Kept(self.most, self)


class FlatBpe:
    """Tables of one tokenizer file; it can be pickled, and workers fill the piece tables for themselves."""

    def __init__(self, file: dict, kept: int = MAX_KEPT):
        self.kept = kept
        model = file["model"]
        vocab: dict[str, int] = model["vocab"]
        self.end = model.get("end_of_word_suffix") or ""
        self.tokens = {i: t for t, i in vocab.items()} | {t["id"]: t["content"] for t in file["added_tokens"]}
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.size = max(self.tokens) + 1
        # keys fit 32 bits for vocabularies of up to 65,536 tokens
        self.kind = np.uint32 if self.size < 1 << 16 else np.int64
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left, right = (np.array([vocab[p[k]] for p in pairs], np.int64) for k in (0, 1))
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order].astype(self.kind), order.astype(np.int32)
        self.made = np.array([vocab[a + b] for a, b in pairs], self.kind)
        letters = byte_letters()
        self.first = np.array([vocab[c] for c in letters], self.kind)
        self.last = np.array([vocab[c + self.end] for c in letters], self.kind)
        self.spelt: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None
        self._clear()

    def _clear(self) -> None:
        self.plain, self.spaced = _Kept(self.kept), _Kept(2 * self.kept)
        self.marks: dict[str, bytes] = {}

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("plain", "spaced", "marks")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._clear()

    @classmethod
    def from_file(cls, path: str, kept: int = MAX_KEPT) -> FlatBpe:
        with open(path, encoding="utf-8") as f:
            return cls(json.load(f), kept)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pair = left * self.kind(self.size) + right
        at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
        return np.where(self.keys[at] == pair, self.ranks[at], np.int32(len(self.made)))

    def merge(self, words: list[str]) -> tuple[np.ndarray, list[int]]:
        """The token ids of all words in one array, and where each word begins (and the last one ends)."""
        data = [w.encode("utf-8", "surrogatepass") for w in words]
        sizes = np.array([len(d) for d in data], np.int64)
        flat = np.frombuffer(b"".join(data), np.uint8)
        owner = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
        symbols = self.first[flat]
        if self.end:
            ends = np.cumsum(sizes)[sizes > 0] - 1
            symbols[ends] = self.last[flat[ends]]
        never = len(self.made)
        # rank[i] is that of the pair (i, i + 1); the last symbol of a word starts none
        rank = np.full(len(symbols), never, np.int32)
        inner = np.flatnonzero(owner[:-1] == owner[1:])
        rank[inner] = self._rank(symbols[inner], symbols[inner + 1])
        done_symbols, done_owner = [np.zeros(0, self.kind)], [np.zeros(0, np.int32)]
        while len(symbols):
            cuts = np.flatnonzero(np.diff(owner, prepend=-1))
            low = np.repeat(np.minimum.reduceat(rank, cuts), np.diff(np.append(cuts, len(owner))))
            over = low == never
            if over.any():
                done_symbols.append(symbols[over])
                done_owner.append(owner[over])
                symbols, owner, rank, low = symbols[~over], owner[~over], rank[~over], low[~over]
                if not len(symbols):
                    break
            # of overlapping places (a a a) every other one counts, from the left of the run
            where = np.flatnonzero(rank == low)
            run = np.flatnonzero(np.diff(where, prepend=-2) != 1)
            nth = np.arange(len(where)) - np.repeat(run, np.diff(np.append(run, len(where))))
            where = where[nth % 2 == 0]
            symbols[where] = self.made[rank[where]]
            keep = np.ones(len(symbols), bool)
            keep[where + 1] = False
            symbols, owner, rank = symbols[keep], owner[keep], rank[keep]
            # only the pairs on either side of a merged symbol are new
            merged = where - np.arange(len(where))
            changed = np.concatenate([merged, merged[merged > 0] - 1])
            changed = changed[changed < len(symbols) - 1]
            rank[merged] = never
            changed = changed[owner[changed] == owner[changed + 1]]
            rank[changed] = self._rank(symbols[changed], symbols[changed + 1])
        symbols, owner = np.concatenate(done_symbols), np.concatenate(done_owner)
        bounds = np.cumsum(np.bincount(owner, minlength=len(words))).tolist()
        return symbols[np.argsort(owner, kind="stable")].astype("<u4"), [0, *bounds]

    def _cut(self, text: str) -> list[tuple[list[str], list[str]]]:
        """Runs of (pieces, pieces that have a blank before them); each encodes alone as it does in the text."""
        if self.end:
            if not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
            text = text.replace("Σ", "σ").lower()  # letter by letter, so without the final sigma
            return [(text.split() if not _ODD.search(text) else [p for p in _BLANKS.split(text) if p], [])]
        words, between = text.split(), text.count(" ") + text.count("\n")
        if len(words) != between + 1 or sum(map(len, words)) + between != len(text):
            return [(_BYTES.findall(text), [])]
        # no white space but single blanks and breaks between words: a break is a token, and words carry the blank before them
        out, at = [], 0
        for line in text.split("\n"):
            end = at + line.count(" ") + 1
            out.append((["\n", words[at]] if at else [words[0]], words[at + 1 : end]))
            at = end
        return out

    def _mark(self, mark: str) -> bytes:
        if mark not in self.marks:
            self.marks[mark] = self.merge([mark])[0].tobytes()
        return self.marks[mark]

    def _learn(self, kept: _Kept, blank: str) -> None:
        """Fills the places of the new pieces, which stand for themselves after `blank`. Letters alone are one word; one mark after
        letters is a word of its own, so that such a piece is made of known ones where the letters are known."""
        words, places, others = [], [], []
        for p, at in kept.new:
            if p.isalpha():
                words.append(blank + p)
                places.append(at)
                continue
            known = kept.get(p[:-1]) if p[-1] in _MARKS and p[:-1].isalpha() else None
            if known is None or not kept.ids[known]:
                others.append((p, at))
                continue
            kept.ids[at] = kept.ids[known] + self._mark(p[-1])
        find = (_WORDS if self.end else _BYTES).findall
        cut = [find(blank + p) for p, _ in others]
        alone = len(words)
        words += {w for ws in cut for w in ws}
        flat, bounds = self.merge(words)
        raw = flat.tobytes()
        found = [raw[4 * a : 4 * b] for a, b in zip(bounds, bounds[1:], strict=False)]
        for at, ids in zip(places, found, strict=False):
            kept.ids[at] = ids
        where = {w: alone + i for i, w in enumerate(words[alone:])}
        for (_, at), ws in zip(others, cut, strict=True):
            kept.ids[at] = b"".join([found[where[w]] for w in ws])
        kept.held += sum([len(p) + len(kept.ids[at]) for p, at in kept.new])
        kept.new = []

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """Of each text the ids as little-endian unsigned 32-bit integers."""
        self.plain, self.spaced = plain, spaced = self.plain.turned(), self.spaced.turned()
        marks, cut = self._specials, []
        for text in texts:
            text = text or ""
            if any(name in text for name in self.special):
                parts = [p if i % 2 else self._cut(p) for i, p in enumerate(marks.split(text)) if p]
            else:
                parts = [self._cut(text)] if text else []
            # from pieces to their places: one look-up for each piece of the text
            cut.append([p if isinstance(p, str) else [(list(map(plain.__getitem__, a)), list(map(spaced.__getitem__, b))) for a, b in p] for p in parts])
        self._learn(plain, "")
        self._learn(spaced, " ")
        plain_ids, spaced_ids = plain.ids.__getitem__, spaced.ids.__getitem__
        for parts in cut:
            ids = []
            for part in parts:
                if isinstance(part, str):
                    ids.append(self.special[part].to_bytes(4, "little"))
                else:
                    for a, b in part:
                        ids += map(plain_ids, a)
                        ids += map(spaced_ids, b)
            yield b"".join(ids)

    @property
    def _specials(self) -> regex.Pattern:
        return _special_pattern(tuple(self.special))

    def _spelt(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bytes of all tokens (for word-end files with a blank after each) in one array, where those of an id begin, and how many."""
        if self.spelt is None:
            parts = [(self.tokens[i].encode() + b" " if self.end else self.bytes_of(i)) if i in self.tokens else b"" for i in range(self.size)]
            sizes = np.array([len(x) for x in parts], np.int64)
            self.spelt = np.frombuffer(b"".join(parts), np.uint8), np.cumsum(sizes) - sizes, sizes
        return self.spelt

    def decode_all(self, texts: list[bytes]) -> list[bytes]:
        """The decoded texts in UTF-8 of the ids of texts, as the tokenizers library does: token by token with a blank between for
        word-end files, else their bytes, with a replacement character for what is no UTF-8."""
        flat, start, size = self._spelt()
        ids = np.frombuffer(b"".join(texts), "<u4").astype(np.int64)
        n = size[ids]
        ends = np.cumsum(n)
        spelt = flat[np.arange(int(n.sum())) + np.repeat(start[ids] - (ends - n), n)].tobytes()
        counts = np.cumsum([len(x) // 4 for x in texts])
        cuts = np.concatenate([[0], np.concatenate([[0], ends])[counts]]).tolist()
        if self.end:
            return [spelt[a : max(a, b - 1)] for a, b in zip(cuts, cuts[1:], strict=False)]
        return [spelt[a:b].decode("utf-8", "replace").encode() for a, b in zip(cuts, cuts[1:], strict=False)]

    def decode(self, ids: bytes) -> str:
        return self.decode_all([ids])[0].decode()

    def bytes_of(self, i: int) -> bytes:
        """What a token of a byte-level file stands for."""
        token = self.tokens[i]
        return token.encode() if token in self.special else bytes(_BACK[c] for c in token)


@cache
def _special_pattern(names: tuple[str, ...]) -> regex.Pattern:
    return regex.compile(f"({'|'.join(map(regex.escape, names))})" if names else r"(?!)()")


_MARKS = frozenset(".,;:!?)]}\"'")
_WORDS, _BYTES = regex.compile(_WORD_SPLIT), regex.compile(_BYTE_SPLIT)
_ODD, _BLANKS = regex.compile("[\x1c-\x1f]"), regex.compile(f"[{_SPACE}]+")
_BACK = {c: b for b, c in enumerate(byte_letters())}
_OUT = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids (array of int) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(FlatBpe.from_file(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in text_slices(texts):
                ids = [np.frombuffer(x, "<u4").astype(np.int32) for x in shared.value.encode(texts[a:b])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, "doc_id long, ids array<int>")


def encode_digests(docs: DataFrame, path: str) -> DataFrame:
    """Number of tokens and digests of the ids, and of the text that these decode to, of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(FlatBpe.from_file(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in text_slices(texts):
                ids = list(shared.value.encode(texts[a:b]))
                rows = [(len(x) // 4, hashlib.sha256(x).hexdigest(), hashlib.sha256(back).hexdigest()) for x, back in zip(ids, shared.value.decode_all(ids), strict=True)]
                columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), list(_OUT)[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *columns], schema=_OUT)

    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
