"""Word shingles of whole texts as sets of 64-bit hashes, in numpy.

Words are runs of characters other than U+0020 and U+0009 to U+000D, with A to Z lower-cased; bytes.split() and
bytes.lower() cut and fold UTF-8 in just this way.
"""

from __future__ import annotations

import numpy as np

_STEP, _FIN = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose bits all depend on all."""
    x = (x ^ (x >> np.uint64(32))) * _FIN
    x = (x ^ (x >> np.uint64(29))) * _STEP
    return x ^ (x >> np.uint64(32))


_LETTER = mix(np.arange(1, 257, dtype=np.uint64))


def word_hashes(words: list[bytes]) -> np.ndarray:
    """One hash per word: its bytes' random values, weighted by powers of an odd number, mixed with its length."""
    if not words:
        return np.zeros(0, np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    flat = _LETTER[np.frombuffer(b"".join(words), np.uint8)]
    starts = np.cumsum(sizes) - sizes
    place = np.arange(len(flat)) - np.repeat(starts, sizes)
    top = int(sizes.max())
    power = np.cumprod(np.full(top, _STEP, np.uint64))
    return mix(np.add.reduceat(flat * power[place], starts) + sizes.astype(np.uint64))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the runs of `size` words, in order; of the whole sequence if it is shorter; none without words."""
    if not len(words):
        return words
    size = min(size, len(words))
    n = len(words) - size + 1
    h = np.full(n, np.uint64(size))
    for k in range(size):
        h = mix(h * _STEP + words[k : k + n])
    return h


def text_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()
