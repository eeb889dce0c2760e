"""Benchmark decontamination: Wu-Manber multi-pattern search over words.

Test strings are windows of ``width`` consecutive words of a benchmark item (an item of fewer words
is one window of its own length).  All strings of one length form a :class:`Matcher`:

* *shift table*: for every block of two words inside a string, how far the search may move on when
  the text shows this block; unknown blocks skip almost a whole string;
* *buckets*: strings by the hash of their last block; where the shift is zero, only the strings of
  that bucket whose first word also fits are looked at;
* *direct comparison* of the words confirms each occurrence.

The benchmark is a stated query set.  It is read in blocks of bounded size; each block is broadcast
and every document is searched once per block, in place, without a shuffle of the documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staffrank.llm.words import ALNUM_LOWER, WordTable, slices

WIDTH = 13
BLOCK_BYTES = 4 << 20  # benchmark text per broadcast block

FOUND = "n_words long, spans array<struct<start:int,stop:int>>, items array<string>"


def _blocks(words: np.ndarray, size: int) -> np.ndarray:
    """Block value ending at each word: the last word's hash, mixed with the one before if size is 2."""
    if size == 1:
        return words
    out = words.copy()
    out[1:] += words[:-1] * np.uint64(0x9E3779B97F4A7C15)
    return out


class Matcher:
    """Wu-Manber tables of test strings that all have ``length`` words."""

    def __init__(self, length: int):
        self.length = length
        self.block = min(2, length)
        self.default = length - self.block + 1
        self.shift: dict[int, int] = {}
        self.bucket: dict[int, list[tuple[int, bytes]]] = {}
        self.items: dict[bytes, set[str]] = {}

    def add(self, string: bytes, hashes: np.ndarray, item: str) -> None:
        if string in self.items:
            self.items[string].add(item)
            return
        self.items[string] = {item}
        blocks = _blocks(hashes, self.block).tolist()
        for end in range(self.block - 1, self.length):
            move = self.length - 1 - end
            self.shift[blocks[end]] = min(move, self.shift.get(blocks[end], self.default))
        self.bucket.setdefault(blocks[-1], []).append((int(hashes[0]), string))

    def search(self, blocks: list[int], words: list[int], lo: int, hi: int, text) -> Iterator[tuple[int, bytes]]:
        """(first word, string) of every occurrence in words lo..hi; ``text(a, b)`` joins words a..b."""
        shift, default, back = self.shift, self.default, self.length - 1
        i = lo + back
        while i < hi:
            move = shift.get(blocks[i], default)
            if move:
                i += move
                continue
            for first, string in self.bucket.get(blocks[i], ()):
                if words[i - back] == first and text(i - back, i + 1) == string:
                    yield i - back, string
            i += 1


def build(items: list[tuple[str, str]], width: int = WIDTH) -> list[Matcher]:
    """Matchers (one per string length) of (item id, text) rows."""
    table = WordTable([t for _, t in items], ALNUM_LOWER, lower=True)
    by_length: dict[int, Matcher] = {}
    for k, (item, _) in enumerate(items):
        n, lo = int(table.n_words[k]), int(table.first[k])
        length = min(n, width)
        if not length:
            continue
        matcher = by_length.setdefault(length, Matcher(length))
        words = table.words(lo, lo + n)
        for a in range(n - length + 1):
            matcher.add(b" ".join(words[a: a + length]), table.hash[lo + a: lo + a + length], item)
    return list(by_length.values())


def search_texts(texts: list, matchers: list[Matcher]) -> pd.DataFrame:
    """Word count, merged hit spans (word offsets) and sorted items for each text."""
    table = WordTable(texts, ALNUM_LOWER, lower=True)
    words = table.hash.tolist()
    blocks = {size: _blocks(table.hash, size).tolist() if size > 1 else words for size in {m.block for m in matchers}}

    def joined(a: int, b: int) -> bytes:
        return b" ".join(table.words(a, b))

    rows = []
    for n, lo in zip(table.n_words.tolist(), table.first.tolist(), strict=True):
        hits, items = [], set()
        for m in matchers:
            for at, string in m.search(blocks[m.block], words, lo, lo + n, joined):
                hits.append((at - lo, at - lo + m.length))
                items |= m.items[string]
        rows.append((n, merged(hits), sorted(items)))
    return pd.DataFrame(rows, columns=["n_words", "spans", "items"])


def merged(spans: list[tuple[int, int]]) -> list[dict]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [{"start": a, "stop": b} for a, b in out]


def benchmark_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[str, str]]]:
    """The benchmark's rows in blocks of about ``block_bytes``; null ids or texts have no strings."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id IS NOT NULL AND text IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    n = max(1, -(-size // block_bytes))
    for k in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        yield [(r.item_id, r.text) for r in part.collect()]


def _searcher(tables):
    @F.pandas_udf(FOUND)
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            texts = texts.tolist()
            parts = [search_texts(texts[lo:hi], tables.value) for lo, hi in slices(texts)]
            yield pd.concat(parts, ignore_index=True) if parts else search_texts([], tables.value)

    return search


def with_hits(docs: DataFrame, benchmark: DataFrame, out: str, width: int = WIDTH,
              block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with a struct column ``out`` of (n_words, n_hit, spans, items, contaminated).

    ``spans`` are the merged word ranges covered by occurrences, ``n_hit`` the words in them,
    ``items`` the ids (as strings, sorted) of items with an occurring string.  Contaminated: some
    word is hit, and hits are a twentieth of the words or more.

    Defined cases: a null or empty document has no words, no hits and is clean; null items and items
    without a word have no strings; equal strings of several items report all of them; equal rows
    each get their own result; an empty benchmark leaves every document clean.
    """
    sc = docs.sparkSession.sparkContext
    parts = []
    for items in benchmark_blocks(benchmark, block_bytes):
        parts.append(_searcher(sc.broadcast(build(items, width)))(F.col("text").cast("string")))
    if len(parts) == 1:
        found = docs.withColumn(out, parts[0])
        spans, items, n_words = F.col(f"{out}.spans"), F.col(f"{out}.items"), F.col(f"{out}.n_words")
    else:
        names = [f"{out}_{k}" for k in range(len(parts))]
        found = docs.withColumns(dict(zip(names, parts, strict=True)))

        @F.pandas_udf("array<struct<start:int,stop:int>>")
        def merge(spans: pd.Series) -> pd.Series:
            return pd.Series([merged([(s["start"], s["stop"]) for s in row]) for row in spans])

        found = found.withColumn(out, F.struct(
            F.col(f"{names[0]}.n_words").alias("n_words"),
            merge(F.flatten(F.array(*[F.col(f"{n}.spans") for n in names]))).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.array(*[F.col(f"{n}.items") for n in names])))).alias("items"))).drop(*names)
        spans, items, n_words = F.col(f"{out}.spans"), F.col(f"{out}.items"), F.col(f"{out}.n_words")
    n_hit = F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return found.withColumn(out, F.struct(
        n_words.alias("n_words"), n_hit.alias("n_hit"), spans.alias("spans"), items.alias("items"),
        ((n_hit > 0) & (n_hit * 20 >= n_words)).alias("contaminated")))
