"""SimHash near-dedup: a byte-position inverted index with count filtering.

Two 64-bit fingerprints that differ in at most ``max_bits`` bits differ in at most ``max_bits`` of
their eight bytes, so at least ``8 - max_bits`` bytes agree position by position: the *guaranteed
matches*.  Steps:

1. fingerprint every document; equal fingerprints become one node (partial aggregation), so groups
   of copies of any size cost nothing further;
2. index every node under joint postings (positions, bytes): with ``g`` guaranteed matches, any
   ``8 - g + 3`` positions hold three matches, so the three-byte postings over seven positions (for
   g = 4) miss no pair.  One-byte postings would each hold a 256th of all nodes;
3. in each posting, tally the equal positional bytes of the pairs, keep those with the guaranteed
   number, verify by the bit distance, and pass on the links that join the posting's nodes (a
   spanning forest).  A posting over ``BLOCK`` nodes is cut into blocks that are paired as rows, so
   that no task holds more than two blocks of it;
4. connected components over the links.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staffrank.llm.components import components
from staffrank.session import ensure_checkpoint_dir

SHINGLE = 4
MAX_BITS = 4
SEED = 42
BLOCK = 2048        # nodes of one posting in a block
JOINT = 3           # bytes in one joint posting
_TALLY = 1 << 16    # shingle hashes tallied at once


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Bit i is 1 if it is set in over half of the shingles' XXH64 values; no words: zero."""
    words = b"" if text is None else text.encode("utf-8", "surrogatepass").lower()
    words = words.split()  # at ASCII white space
    if not words:
        return 0
    data = b" ".join(words)
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
    ends = np.cumsum(size) - 1
    starts = ends - size + 1
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    lows, highs = starts[:n].tolist(), ends[len(words) - n:].tolist()
    hashes = np.array([digest(data[a:b], SEED) for a, b in zip(lows, highs, strict=True)], dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for k in range(0, n, _TALLY):
        part = hashes[k: k + _TALLY]
        ones += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def with_fingerprint(docs: DataFrame, out: str, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with a long column ``out``: the fingerprint's 64 bits as a signed number."""

    @F.pandas_udf("long")
    def prints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64))

    return docs.withColumn(out, prints(F.col("text").cast("string")))


def _differing_bytes(x: np.ndarray) -> np.ndarray:
    """How many of the eight bytes of each value are not zero."""
    x = x | (x >> np.uint64(4))
    x = x | (x >> np.uint64(2))
    x = x | (x >> np.uint64(1))
    return np.bitwise_count(x & np.uint64(0x0101010101010101))


def _stars(nodes: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """(smallest node, node) for every node that links reach from a smaller one inside this posting.

    Nodes that are reached leave the search, so dense groups take few comparisons."""
    left, out = np.unique(np.asarray(nodes, dtype=np.int64)).view(np.uint64), []
    left = left[np.argsort(left.view(np.int64))]
    while len(left) > 1:
        root, frontier, left = left[0], left[:1], left[1:]
        while len(frontier) and len(left):
            near = np.zeros(len(left), dtype=bool)
            step = max(1, (1 << 20) // len(left))
            for k in range(0, len(frontier), step):
                x = frontier[k: k + step, None] ^ left[None, :]
                tallied = 8 - _differing_bytes(x) >= 8 - max_bits
                near |= (tallied & (np.bitwise_count(x) <= max_bits)).any(axis=0)
            frontier, left = left[near], left[~near]
            out += [(int(root.view(np.int64)), f) for f in frontier.view(np.int64).tolist()]
    return out


def _stars_of(max_bits: int):
    @F.pandas_udf("array<struct<a:long,b:long>>")
    def stars(lists: pd.Series) -> pd.Series:
        return pd.Series([[{"a": a, "b": b} for a, b in _stars(x, max_bits)] for x in lists])

    return stars


def links(nodes: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """(a, b): links between distinct fingerprints (column ``fp``) whose components are those of
    all pairs within ``max_bits`` bits."""
    if not 1 <= max_bits <= 5:
        raise ValueError("joint postings of three bytes need a distance of 1 to 5 bits")
    positions = range(8 - (8 - max_bits) + JOINT)
    byte = lambda p: F.shiftrightunsigned("fp", 8 * p).bitwiseAND(255)
    keys = []
    for number, (p, q, r) in enumerate(combinations(positions, JOINT)):
        keys.append(F.shiftleft(F.lit(number).cast("long"), 24) + byte(p) * 65536 + byte(q) * 256 + byte(r))
    postings = nodes.select("fp", F.explode(F.array(*keys)).alias("posting"))
    sizes = postings.groupBy("posting").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
    x = F.col("a").bitwiseXOR(F.col("b"))
    some = x.bitwiseOR(F.shiftrightunsigned(x, 4))
    some = some.bitwiseOR(F.shiftrightunsigned(some, 2))
    some = some.bitwiseOR(F.shiftrightunsigned(some, 1)).bitwiseAND(F.lit(0x0101010101010101))
    tallied = 8 - F.bit_count(some) >= 8 - max_bits
    pairs = sizes.where(F.col("n") == 2).where(tallied & (F.bit_count(x) <= max_bits)).select("a", "b")
    larger = sizes.where(F.col("n") > 2).select("posting", F.ceil(F.col("n") / block).alias("blocks"))
    blocks = (postings.join(larger, "posting")
              .groupBy("posting", "blocks", F.pmod(F.xxhash64("fp"), "blocks").alias("block"))
              .agg(F.collect_list("fp").alias("fps")))
    stars = _stars_of(max_bits)
    one = blocks.where("blocks = 1").select("fps")
    many = blocks.where("blocks > 1")
    other = many.select("posting", F.col("block").alias("block2"), F.col("fps").alias("fps2"))
    two = (many.join(other, "posting").where("block <= block2")
           .select(F.when(F.col("block") == F.col("block2"), F.col("fps")).otherwise(F.concat("fps", "fps2")).alias("fps")))
    found = one.unionByName(two).select(F.explode(stars("fps")).alias("s")).select("s.a", "s.b")
    return pairs.unionByName(found)


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per input row: ``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``, the
    smallest ``doc_id`` that links of at most ``max_bits`` differing bits reach.

    Other columns of ``docs`` are ignored, whatever their names.  Defined cases: texts without words
    (null, empty, white space) have fingerprint zero and link like any other; fewer words than a
    shingle make one shingle; equal rows each get a row, with one component; a null ``doc_id`` keeps
    its row and never names a component (null if no member has an id); an empty table gives an
    empty table.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    prints = with_fingerprint(rows, "fp", shingle).select("doc_id", "fp").checkpoint()
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")).checkpoint()
    roots = components(links(nodes.select("fp"), max_bits))
    rooted = (nodes.join(roots, nodes["fp"] == roots["node"], "left")
              .select("fp", "first_id", F.coalesce("root", "fp").alias("root")))
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    members = rooted.join(named, "root").select("fp", "component_id")
    return (prints.join(members, "fp", "left")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))
