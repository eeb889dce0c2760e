"""Hard negatives: for anchor and positive, the best rows of other labels that score just below the positive.

Every vector becomes integers, ``floor(256 * x)``; a score is the integer inner product.  The search
compares every anchor with every row, but scores few pairs in full:

* index (one pass, written once): a vector is turned by a fixed random rotation and described by
  one-bit codes.  A code is the signs of the rotated vector; its alignment with the vector is stored
  beside it.  What a code leaves over is described by the next one, so the remainder shrinks by
  about 0.6 for each of ``LEVELS`` codes;
* estimate: a rotated anchor is rounded to ``BITS`` bits; its product with a code is a few popcounts of
  ``AND`` of bit planes.  By Cauchy-Schwarz the remainder changes the score by at most its length
  times the length of the anchor's part across the code, and the rounding error has a bound, so each
  pair has an interval that surely holds its score;
* filter: pairs go on to the next code only while their interval can still hold a wanted score, and
  the pairs left after the last code are scored with integers.  Nothing rests on probability: the
  result equals brute force.

Anchors are taken in blocks of bounded size.  For each block one job over the index finds the
positives, a second one the negatives; a task keeps the best few of each anchor only.  The finished
blocks are files in the shared folder.

Rows with a null id, label or vector, or with a null or non-finite component, take no part.  Rows
that share an id are one row, the smallest by label and components.  Vectors of different length are
not compared; an empty vector scores 0.  Ties go to the smaller id.  An empty table gives no rows;
other columns are not read.  A vector longer than 2**31 (after scaling) raises an error, as its
scores need not fit a long.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from functools import cache, partial

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from staffrank.session import shared_dir

SCALE = 256
EVERY = 100  #: rows whose id it divides are anchors
POSITIVES = NEGATIVES = 5
FLOOR = 80  #: a negative scores at least so many hundredths of its positive
LEVELS = 4  #: one-bit codes of a vector
BITS = 6  #: of a component of a rotated anchor
BLOCK = 1 << 18  #: components of the anchors that are sent to the tasks at once
TILE = 1 << 20  #: pairs that a task looks at together

FOUND = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


@cache
def rotation(dim: int) -> np.ndarray:
    """A fixed random orthogonal matrix."""
    return np.linalg.qr(np.random.default_rng(dim).standard_normal((dim, dim)))[0] if dim else np.zeros((0, 0))


def _words(bits: np.ndarray) -> np.ndarray:
    """Rows of truth values as rows of 64-bit words."""
    packed = np.packbits(bits, axis=-1, bitorder="little")
    pad = -packed.shape[-1] % 8
    packed = np.concatenate([packed, np.zeros((*packed.shape[:-1], pad), np.uint8)], axis=-1)
    return np.ascontiguousarray(packed).view(np.uint64)


def encode(z: np.ndarray, levels: int = LEVELS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes (rows x levels x words) of integer vectors, their alignments (cosines) and the lengths."""
    dim = z.shape[1]
    rest = z.astype(np.float64) @ rotation(dim).T
    length = np.sqrt((rest * rest).sum(1))
    if len(length) and length.max() >= 2**31:
        raise OverflowError("a vector is too long for scores of type long")
    codes, aligned = [], []
    for _ in range(levels):
        sign = rest >= 0
        size = np.sqrt((rest * rest).sum(1))
        step = np.abs(rest).mean(1) if dim else size
        aligned.append(np.divide(step * np.sqrt(dim), size, out=np.zeros_like(size), where=size > 0))
        rest = rest - np.where(sign, step[:, None], -step[:, None])
        codes.append(_words(sign))
    return np.stack(codes, axis=1), np.minimum(np.stack(aligned, axis=1), 1.0), length


class Rows:
    """Coded vectors of one length: ``step`` and ``left`` are what code k adds and leaves over."""

    def __init__(self, frame: pd.DataFrame, dim: int, levels: int = LEVELS):
        n = len(frame)
        self.id, self.label = frame.vec_id.to_numpy(np.int64), frame.label.to_numpy(np.int64)
        self.z = np.frombuffer(b"".join(frame.z), np.int64).reshape(n, dim)
        self.codes = np.frombuffer(b"".join(frame.codes), np.uint64).reshape(n, levels, -(-dim // 64))
        aligned = np.frombuffer(b"".join(frame.aligned), np.float64).reshape(n, levels)
        self.length = frame.length.to_numpy(np.float64)
        left = self.length[:, None] * np.cumprod(np.sqrt(1 - aligned**2), axis=1)
        before = np.concatenate([self.length[:, None], left[:, :-1]], axis=1)
        self.step = aligned * before / np.sqrt(max(dim, 1))
        self.left = left


class Anchors:
    """Anchors of one vector length with the bit planes of their rotated, rounded components."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, z: np.ndarray):
        self.id, self.label, self.z, self.dim = ids, labels, z, z.shape[1]
        turned = z.astype(np.float64) @ rotation(self.dim).T
        top = (1 << BITS) - 1
        self.low = turned.min(1, initial=0)
        width = (turned.max(1, initial=0) - self.low) / top
        self.width = np.where(width > 0, width, 1.0)
        whole = np.clip(np.rint((turned - self.low[:, None]) / self.width[:, None]), 0, top).astype(np.int64)
        self.error = np.abs(turned - self.low[:, None] - whole * self.width[:, None]).sum(1) * (1 + 1e-9) + 1e-6
        self.planes = np.stack([_words((whole >> j) & 1 == 1) for j in range(BITS)], axis=1)
        self.total = whole.sum(1)
        self.square = (turned * turned).sum(1) * (1 + 1e-9) + 1e-6

    def with_code(self, code: np.ndarray, col) -> np.ndarray:
        """Product of the rounded anchors ``col`` with sign vectors (``code``: ... x words)."""
        both = np.zeros(np.broadcast_shapes(code.shape[:-1], self.total[col].shape), np.int64)
        for j in range(BITS):
            for w in range(code.shape[-1]):
                both += np.bitwise_count(code[..., w] & self.planes[col, j, w]).astype(np.int64) << j
        ones = np.bitwise_count(code).astype(np.int64).sum(-1)
        return self.low[col] * (2 * ones - self.dim) + self.width[col] * (2 * both - self.total[col])

    def scored(self, rows: Rows, allowed: np.ndarray, wanted: Callable) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, anchor, score) of the allowed pairs that ``wanted(lowest, highest, anchor)`` cannot rule out."""
        everyone = np.arange(len(self.id))
        row, col, guess, off = None, everyone[None, :], 0.0, 0.0
        at = np.arange(len(rows.id))[:, None]
        for k in range(rows.step.shape[1]):
            part = self.with_code(rows.codes[at, k], col)
            step = rows.step[at, k]
            guess, off = guess + step * part, off + step * self.error[col]
            along = np.maximum(np.abs(part) - self.error[col], 0.0)
            across = np.sqrt(np.maximum(self.square[col] - along * along / max(self.dim, 1), 0.0))
            # the last part is far above the errors of floating point
            reach = off + rows.left[at, k] * across + 1e-6 * (1 + rows.length[at] * np.sqrt(self.square[col]))
            keep = wanted(guess - reach, guess + reach, col)
            if row is None:
                row, col = np.nonzero(keep & allowed)
                guess, off, at = guess[row, col], off[row, col], row
            else:
                row, col, guess, off = row[keep], col[keep], guess[keep], off[keep]
                at = row
        score = np.empty(len(row), np.int64)
        size = max(1, (1 << 22) // max(self.dim, 1))
        for lo in range(0, len(row), size):
            cut = slice(lo, lo + size)
            score[cut] = (rows.z[row[cut]] * self.z[col[cut]]).sum(1)
        return row, col, score


class Best:
    """The ``k`` best (score, id) of each slot: higher scores first, then smaller ids."""

    def __init__(self, slots: int, k: int):
        self.k, self.slot, self.score, self.id = k, *(np.zeros(0, np.int64) for _ in range(3))
        self.least = np.full(slots, -np.inf)  #: what a newcomer must reach

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        slot, score, ids = (np.concatenate(x) for x in ((self.slot, slot), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        place = np.arange(len(slot)) - np.searchsorted(slot, slot)
        keep = place < self.k
        self.slot, self.score, self.id = slot[keep], score[keep], ids[keep]
        full = place[keep] == self.k - 1
        self.least[self.slot[full]] = self.score[full]


def _tiles(frames: Iterator[pd.DataFrame], anchors: dict[int, Anchors]) -> Iterator[tuple[int, Rows]]:
    for f in frames:
        for dim, same in f.groupby("dim"):
            if dim in anchors:
                n = max(64, TILE // len(anchors[dim].id))
                for lo in range(0, len(same), n):
                    yield dim, Rows(same.iloc[lo: lo + n], dim)


def _positives(frames: Iterator[pd.DataFrame], sent: Broadcast, k: int) -> Iterator[pd.DataFrame]:
    """The best rows of the anchors' own labels among one task's rows."""
    anchors = {dim: Anchors(*x) for dim, x in sent.value.items()}
    best = {dim: Best(len(a.id), k) for dim, a in anchors.items()}
    same = {(dim, label): (w := np.flatnonzero(a.label == label), Anchors(a.id[w], a.label[w], a.z[w]))
            for dim, a in anchors.items() for label in np.unique(a.label).tolist()}
    for dim, rows in _tiles(frames, anchors):
        held = best[dim]
        for label in np.unique(rows.label).tolist():
            if (dim, label) in same:
                mine, few = same[dim, label]
                some, least = _pick(rows, rows.label == label), held.least[mine]
                row, col, score = few.scored(some, some.id[:, None] != few.id, lambda low, high, c, least=least: high >= least[c])
                held.add(mine[col], score, some.id[row])
    for dim, held in best.items():
        yield pd.DataFrame({"anchor_id": anchors[dim].id[held.slot], "score": held.score, "positive_id": held.id})


def _pick(rows: Rows, which: np.ndarray) -> Rows:
    some = object.__new__(Rows)
    some.__dict__ = {name: x[which] for name, x in rows.__dict__.items()}
    return some


def _negatives(frames: Iterator[pd.DataFrame], sent: Broadcast, positives: Broadcast, floor: int, k: int) -> Iterator[pd.DataFrame]:
    """The best rows of other labels between each positive's floor and its score among one task's rows."""
    anchors = {dim: Anchors(*x) for dim, x in sent.value.items()}
    best, of = {}, {}
    for dim, a in anchors.items():
        own = [positives.value.get(i, []) for i in a.id.tolist()]
        width = max(map(len, own), default=0)
        top = np.array([[s for _, s in x] + [-1] * (width - len(x)) for x in own], np.int64).reshape(len(own), width)
        name = np.array([[i for i, _ in x] + [0] * (width - len(x)) for x in own], np.int64).reshape(len(own), width)
        best[dim], of[dim] = Best(top.size, k), (top, name)
    for dim, rows in _tiles(frames, anchors):
        a, held, (top, _) = anchors[dim], best[dim], of[dim]
        width = top.shape[1]
        # a positive below 0 has no room under it: -1 closes its window, as it does for missing ones
        low = np.where(top >= 0, np.maximum(top * (floor / 100) * (1 - 1e-12), held.least.reshape(top.shape)), np.inf)

        def wanted(lowest, highest, c, top=top, low=low, width=width):
            some = np.zeros(highest.shape, bool)
            for p in range(width):
                some |= (highest >= low[c, p]) & (lowest <= top[c, p])
            return some

        row, col, score = a.scored(rows, rows.label[:, None] != a.label, wanted)
        for p in range(width):
            bound = top[col, p]
            fits = (bound >= 0) & (floor * bound <= 100 * score) & (score <= bound)
            held.add(col[fits] * width + p, score[fits], rows.id[row[fits]])
    for dim, held in best.items():
        top, name = of[dim]
        if top.size:
            yield pd.DataFrame({
                "anchor_id": np.repeat(anchors[dim].id, top.shape[1])[held.slot], "positive_id": name.ravel()[held.slot],
                "negative_id": held.id, "positive_score": top.ravel()[held.slot], "negative_score": held.score})


def _coded(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        for dim, same in f.groupby("dim"):
            for lo in range(0, len(same), 4096):
                some = same.iloc[lo: lo + 4096]
                z = np.array([list(x) for x in some.z], np.int64).reshape(len(some), dim)
                codes, aligned, length = encode(z)
                yield some.assign(z=[x.tobytes() for x in z], codes=[x.tobytes() for x in codes],
                                  aligned=[x.tobytes() for x in aligned], length=length)


def build_index(rows: DataFrame, path: str) -> DataFrame:
    """Integer vectors with codes, alignments and lengths, written to ``path``."""
    whole = rows.select("vec_id", F.col("label").cast("long").alias("label"), "embedding").where(
        "vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").where(
        F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    z = F.transform("embedding", lambda x: F.floor(SCALE * x.cast("double")).cast("long"))
    one = whole.select("vec_id", F.struct("label", z.alias("z")).alias("r")).groupBy("vec_id").agg(F.min("r").alias("r"))
    (one.select("vec_id", "r.label", F.size("r.z").alias("dim"), "r.z")
     .mapInPandas(_coded, "vec_id long, label long, dim int, z binary, codes binary, aligned binary, length double")
     .write.mode("overwrite").parquet(path))
    return rows.sparkSession.read.parquet(path)


def _first(found: DataFrame, by: list[str], score: str, name: str, k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc(score), name)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(rows: DataFrame, every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES,
         floor: int = FLOOR, block: int = BLOCK) -> DataFrame:
    """Hard negatives (``FOUND``) of every anchor among all rows (vec_id, label, embedding)."""
    spark = rows.sparkSession
    root = shared_dir(spark, f"hard-negatives-{uuid.uuid4().hex}")
    index = build_index(rows, f"{root}/index")
    anchors = index.where(F.col("vec_id") % every == 0)
    n, dim = anchors.agg(F.count("*"), F.max("dim")).first()
    size = max(1, block // max(dim or 1, 1))
    blocks = -(-2 * n // size)  # half full on average, so that no block of hashed ids comes near ``size``
    spark.createDataFrame([], FOUND).write.mode("overwrite").parquet(f"{root}/found/block=-1")
    for b in range(blocks):
        own = anchors.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).select("vec_id", "label", "dim", "z").toPandas()
        sent = spark.sparkContext.broadcast({
            int(d): (x.vec_id.to_numpy(np.int64), x.label.to_numpy(np.int64), np.frombuffer(b"".join(x.z), np.int64).reshape(len(x), d))
            for d, x in own.groupby("dim")})
        near = index.mapInPandas(partial(_positives, sent=sent, k=positives), "anchor_id long, score long, positive_id long")
        held: dict[int, list] = {}
        for r in _first(near, ["anchor_id"], "score", "positive_id", positives).orderBy("anchor_id", "rank").collect():
            held.setdefault(r.anchor_id, []).append((r.positive_id, r.score))
        told = spark.sparkContext.broadcast(held)  # at most ``positives`` of each anchor of the block
        below = index.mapInPandas(
            partial(_negatives, sent=sent, positives=told, floor=floor, k=negatives),
            "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long")
        (_first(below, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives)
         .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
         .write.mode("overwrite").parquet(f"{root}/found/block={b}"))
        sent.unpersist()
        told.unpersist()
    return spark.read.schema(FOUND).parquet(f"{root}/found").drop("block")


def with_moved_labels(rows: DataFrame, every: int = 7, labels: int = 10) -> DataFrame:
    """The rows with the label of every seventh id moved on by one."""
    moved = F.when(F.col("vec_id") % every == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
    return rows.withColumn("label", moved)
