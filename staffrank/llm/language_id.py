"""Language identification by hyperdimensional profiles.

Every letter has a fixed random vector of ``DIM`` signs.  A trigram is the product of its three
letters' vectors, the first one permuted twice and the second once, so that order counts; a text is
the sum of its trigrams.  The sum over all training texts of a language is its prototype, and a text
has the language whose prototype makes the smallest angle with its vector.

Letters are code points that Unicode calls letters or marks, in lower case; whatever lies between
them is one blank.  Trigrams have a letter in the middle.  The vector of a letter is drawn with its
code point as seed, so any alphabet works and nothing is stored.

Training is one pass: a task sums its texts into one vector for each language, and Spark adds these up
per language and component.  The prototypes (``DIM`` numbers a language) are sent to all tasks for a
second pass.  Sums are whole numbers, so results do not depend on the partitions.

A null text, or one without a letter, is ``und`` with score 0.  Without any training text all are
``und``.  Equal cosines: the language first in the order of its name.  The score is the cosine, 0 if
it is negative.  Texts of any length are read whole, in windows.  Other columns are kept.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staffrank.llm.words import fresh, mix64, slices

DIM = 1024
UNKNOWN = "und"
WINDOW = 1 << 18  #: code points whose trigrams are counted together
GRAMS = 1 << 13  #: trigram vectors that one product takes
HELD = 1 << 14  #: trigram vectors that a worker keeps
TEXTS = 256  #: text vectors held at once


@cache
def kinds() -> np.ndarray:
    """2 for the code points that are letters, 1 for marks, 0 for all others."""
    kind = {"L": 2, "M": 1}
    return np.fromiter((kind.get(unicodedata.category(chr(i))[0], 0) for i in range(sys.maxunicode + 1)), np.int8, sys.maxunicode + 1)


def letter_vectors(codes: np.ndarray, dim: int = DIM) -> np.ndarray:
    """Fixed random signs of code points (rows), one bit each of mixed (code point, place) words."""
    place = np.arange(-(-dim // 64), dtype=np.uint64)
    word = mix64(codes.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) + mix64(place + np.uint64(1))[None, :])
    bits = np.unpackbits(word.astype("<u8").view(np.uint8), axis=1, bitorder="little")[:, :dim]
    return bits.astype(np.float32) * 2 - 1


def gram_vectors(grams: np.ndarray, dim: int = DIM) -> np.ndarray:
    """Vectors of trigrams (three code points in one 63-bit number): the permutation is a rotation."""
    vector = np.ones((len(grams), dim), np.float32)
    for shift, bits in ((2, 42), (1, 21), (0, 0)):
        code, which = np.unique((grams >> bits) & 0x1FFFFF, return_inverse=True)
        vector *= np.roll(letter_vectors(code, dim), shift, axis=1)[which]
    return vector


class _Held:
    """Vectors of the trigrams met last, so that frequent ones are made once in a worker."""

    def __init__(self, dim: int):
        self.dim, self.gram, self.vector = dim, np.zeros(0, np.int64), np.zeros((0, dim), np.float32)

    def of(self, grams: np.ndarray) -> np.ndarray:
        """Vectors of sorted trigrams."""
        at = np.minimum(np.searchsorted(self.gram, grams), max(len(self.gram) - 1, 0))
        new = grams if not len(self.gram) else grams[self.gram[at] != grams]
        if not len(new):
            return self.vector[at]
        if len(self.gram) + len(new) > HELD:
            self.gram, self.vector = grams, gram_vectors(grams, self.dim)
            return self.vector
        place = np.searchsorted(self.gram, new)
        self.gram, self.vector = np.insert(self.gram, place, new), np.insert(self.vector, place, gram_vectors(new, self.dim), axis=0)
        return self.vector[np.searchsorted(self.gram, grams)]


_held = cache(_Held)


def _distinct(code: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The trigrams around the places ``at``: each once, sorted, and which one each place has."""
    seen = np.zeros(sys.maxunicode + 1, bool)
    seen[code] = True
    letter = np.flatnonzero(seen)
    n = len(letter)
    if n**3 > 1 << 22:
        return np.unique(code[at - 1] << 42 | code[at] << 21 | code[at + 1], return_inverse=True)
    rank = np.cumsum(seen) - 1  # few letters: a table instead of a sort
    small = rank[code]
    cell = (small[at - 1] * n + small[at]) * n + small[at + 1]
    seen = np.zeros(n**3, bool)
    seen[cell] = True
    found = np.flatnonzero(seen)
    return letter[found // n**2] << 42 | letter[found // n % n] << 21 | letter[found % n], (np.cumsum(seen) - 1)[cell]


def text_vectors(texts: list[str], dim: int = DIM, owner: np.ndarray | None = None) -> np.ndarray:
    """The sum of each text's trigram vectors; zeros for a text without a letter.

    With ``owner`` (a row number for each text, ascending): the sums of the texts of each owner.
    """
    raw = [t.lower().encode("utf-32-le", "surrogatepass") for t in texts]
    size = np.fromiter((len(r) // 4 + 1 for r in raw), np.int64, len(raw))
    # a blank before the first text and after every text
    code = np.frombuffer(b"\0\0\0\0" + b"".join(r + b"\0\0\0\0" for r in raw), "<u4")
    stop = 1 + np.cumsum(size)
    worded = np.zeros(len(raw), bool)
    first = np.minimum(stop - size, len(code) - 1)
    if len(raw):  # a text of marks alone has no trigrams
        worded = np.maximum.reduceat(kinds()[code], first) == 2
    owner = np.arange(len(raw)) if owner is None else owner
    out = np.zeros((int(owner[-1]) + 1 if len(raw) else 0, dim))
    for lo in range(1, len(code) - 1, WINDOW):
        hi = min(lo + WINDOW, len(code) - 1)
        some = code[lo - 1: hi + 1].astype(np.int64)
        some[kinds()[some] == 0] = 0
        at = np.flatnonzero(some[1:-1]) + 1
        text = np.searchsorted(stop, at + lo - 1, "right")
        at, text = at[worded[text]], text[worded[text]]
        if not len(at):
            continue
        gram, which = _distinct(some, at)
        row = owner[text]
        base, n = int(row[0]), int(row[-1] - row[0]) + 1
        for low in range(0, len(gram), GRAMS):
            vectors = _held(dim).of(gram[low: low + GRAMS])
            g = len(vectors)
            mine = slice(None) if len(gram) <= GRAMS else (which >= low) & (which < low + GRAMS)
            cell = (row[mine] - base) * g + which[mine] - low
            for t in range(0, n, TEXTS):  # bounds the table of counts
                m = min(TEXTS, n - t)
                inside = cell if n <= TEXTS else cell[(cell >= t * g) & (cell < (t + m) * g)]
                counts = np.bincount(inside - t * g, minlength=m * g)
                out[base + t: base + t + m] += counts.reshape(m, g).astype(np.float32) @ vectors
    return out


def _parts(texts: list[str]) -> Iterator[slice]:
    for lo, hi in slices(texts, WINDOW * 4):
        for a in range(lo, hi, TEXTS):
            yield slice(a, min(a + TEXTS, hi))


def train(docs: DataFrame, text: str = "text", lang: str = "lang", dim: int = DIM) -> dict[str, np.ndarray]:
    """Prototype of every language among rows with a text and a language."""

    def bundled(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for f in frames:
            texts, langs = f.text.tolist(), f.lang.to_numpy()
            for part in _parts(texts):
                names, owner = np.unique(langs[part].astype(str), return_inverse=True)
                order = np.argsort(owner, kind="stable")
                vectors = text_vectors([texts[part.start + i] for i in order], dim, owner[order])
                for name, vector in zip(names.tolist(), vectors, strict=True):
                    sums[name] = sums.get(name, 0) + vector
        if sums:
            yield pd.DataFrame({"lang": list(sums), "v": [x.tolist() for x in sums.values()]})

    given = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    told = given.mapInPandas(bundled, "lang string, v array<double>").select("lang", F.posexplode("v").alias("i", "x"))
    prototypes: dict[str, np.ndarray] = {}
    for r in told.groupBy("lang", "i").agg(F.sum("x").alias("x")).toLocalIterator():
        prototypes.setdefault(r.lang, np.zeros(dim))[r.i] = r.x
    return {k: prototypes[k] for k in sorted(prototypes) if prototypes[k].any()}


def with_language(docs: DataFrame, prototypes: dict[str, np.ndarray], out: str, text: str = "text") -> DataFrame:
    """Adds the struct column ``out`` (lang, score)."""
    spark = docs.sparkSession
    names = list(prototypes)
    dim = len(prototypes[names[0]]) if names else DIM
    unit = np.array([prototypes[k] / np.linalg.norm(prototypes[k]) for k in names]).reshape(len(names), dim)
    sent = spark.sparkContext.broadcast((names, unit))

    @F.pandas_udf("lang string, score double")
    def nearest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names, unit = sent.value
        for series in batches:
            texts = ["" if t is None else t for t in series]
            lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            for part in _parts(texts):
                vectors = text_vectors(texts[part], unit.shape[1])
                length = np.linalg.norm(vectors, axis=1)
                for i in np.flatnonzero(length) if names else ():
                    cosine = unit @ vectors[i] / length[i]
                    best = int(cosine.argmax())
                    lang[part.start + i], score[part.start + i] = names[best], min(max(cosine[best], 0.0), 1.0)
            yield pd.DataFrame({"lang": lang, "score": score})

    return docs.withColumn(out, nearest(F.col(text)))


def held_out(doc_id: str = "doc_id", folds: int = 5) -> F.Column:
    """Whether a row is kept from training; rows without an id are."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == 0, F.lit(True))


def identify(docs: DataFrame, out: str = "language") -> DataFrame:
    """The documents with ``held_out`` and ``out`` (lang, score), learned from the rows not held out."""
    mark = fresh("held_out", docs.columns)
    marked = docs.withColumn(mark, held_out())
    return with_language(marked, train(marked.where(~F.col(mark))), out)
