"""Vectorised word spans and word hashes of UTF-8 text, shared by the operators that run numpy in tasks.

Words are maximal runs of bytes that a 256-entry table marks.  Both word classes used here are
closed under UTF-8 (every byte of a non-ASCII character is a word byte), so working on bytes gives
the same words as working on characters.
"""

from __future__ import annotations

import numpy as np

#: bytes of ``[^\x20\x09-\x0D]`` : everything but ASCII white space.
NON_SPACE = np.ones(256, dtype=bool)
NON_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

#: bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` : digits, a-z and all non-ASCII characters.
ALNUM_LOWER = np.zeros(256, dtype=bool)
ALNUM_LOWER[0x30:0x3A] = True
ALNUM_LOWER[0x61:0x7B] = True
ALNUM_LOWER[0x80:] = True

_CHUNK = 1 << 20  # bytes hashed at once: bounds the temporary arrays


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalising bit mixer on uint64 (a bijection, so it adds no collisions)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _stream(n: int, salt: int) -> np.ndarray:
    """n fixed pseudo-random odd 64-bit values."""
    i = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt)
    return mix64(i) | np.uint64(1)


_BYTE = _stream(256, 11)
_POS = _stream(256, 97)


def spans(buf: np.ndarray, word_byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end offsets of every word in a byte buffer."""
    edge = np.empty(len(buf) + 2, dtype=np.int8)
    edge[0] = edge[-1] = 0
    edge[1:-1] = word_byte[buf]
    step = np.diff(edge)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def hash_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word: position-weighted sum of byte values, mixed with the length."""
    global _POS
    size = ends - starts
    if not len(size):
        return np.zeros(0, dtype=np.uint64)
    if int(size.max()) > len(_POS):
        _POS = _stream(int(size.max()) * 2, 97)
    out = np.empty(len(size), dtype=np.uint64)
    total = np.cumsum(size)
    lo = 0
    while lo < len(size):
        base = total[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(total, base + _CHUNK, "right")))
        n = size[lo:hi]
        first = np.cumsum(n) - n
        pos = np.arange(int(n.sum())) - np.repeat(first, n)
        at = np.repeat(starts[lo:hi], n) + pos
        out[lo:hi] = np.add.reduceat(_BYTE[buf[at]] * _POS[pos], first)
        lo = hi
    return mix64(out + size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


class WordTable:
    """Words of a list of texts: ``hash``, ``doc`` (index of the text), ``start`` / ``end`` offsets
    in ``data``.  A null text has no words."""

    def __init__(self, texts, word_byte: np.ndarray = NON_SPACE, lower: bool = False):
        raw = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]
        data = b"\n".join(raw)
        self.data = data.lower() if lower else data  # bytes.lower changes A-Z only
        buf = np.frombuffer(self.data, dtype=np.uint8)
        self.start, self.end = spans(buf, word_byte)
        length = np.fromiter((len(r) + 1 for r in raw), dtype=np.int64, count=len(raw))
        stop = np.cumsum(length)
        self.doc = np.searchsorted(stop, self.start, "right")
        self.n_words = np.bincount(self.doc, minlength=len(raw)).astype(np.int64)
        self.first = np.cumsum(self.n_words) - self.n_words
        self.hash = hash_spans(buf, self.start, self.end)

    def words(self, lo: int, hi: int) -> list[bytes]:
        d = self.data
        return [d[a:b] for a, b in zip(self.start[lo:hi].tolist(), self.end[lo:hi].tolist(), strict=True)]


def rolling_hash(word: np.ndarray, width: int) -> np.ndarray:
    """Rabin-Karp hash of every window of ``width`` words: a polynomial in an odd base modulo 2**64,
    rolled with prefix sums (one subtraction and one product per window)."""
    n = len(word)
    if n < width:
        return np.zeros(0, dtype=np.uint64)
    base = 0x5851F42D4C957F2D
    inverse = pow(base, -1, 1 << 64)
    down = np.full(n, inverse, dtype=np.uint64)
    down[0] = 1
    down = np.cumprod(down)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(word * down, out=sums[1:])
    up = np.full(n - width + 1, base, dtype=np.uint64)
    up[0] = pow(base, width - 1, 1 << 64)
    return mix64((sums[width:] - sums[:-width]) * np.cumprod(up))


def slices(texts: list, chars: int = 1 << 21):
    """(lo, hi) ranges of a batch of texts of about ``chars`` characters: bounds a task's arrays
    whatever the length of the texts in a batch (one longer text is a range of its own)."""
    lo = size = 0
    for i, t in enumerate(texts):
        n = len(t) if t is not None else 0
        if i > lo and size + n > chars:
            yield lo, i
            lo, size = i, 0
        size += n
    if texts:
        yield lo, len(texts)


def fresh(name: str, taken: list[str]) -> str:
    """``name``, lengthened until no column of a table has it (names are compared without case)."""
    taken = {c.lower() for c in taken}
    while name.lower() in taken:
        name += "_"
    return name
