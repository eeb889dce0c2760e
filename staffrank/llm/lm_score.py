"""LM scoring: cross-entropy difference of two matched bigram models with one vocabulary.

The *target* model counts the documents that a label table marks as good; the *background* model
counts all documents.  Both use the words that occur ``MIN_COUNT`` times or more in the target (all
others are one unknown word), the same bigrams and the same smoothing, so a document's loss under
one can be set against its loss under the other.  Score: mean over its words of target loss minus
background loss, in bits; lower is closer to the target.

Vocabulary and counts are exact, cover every document and grow with the corpus, so they are never
gathered: documents are dealt into shards of a few MB, and a shard asks for what it needs.

1. *words*: each shard sends its distinct word hashes and their target counts, dealt into buckets by
   leading bits; each bucket answers with a bit for each word of a shard, set for the vocabulary,
   and how many vocabulary words it has;
2. *counts*: each shard sends its distinct bigrams, contexts and words with counts under both
   models; each bucket adds up and answers with the totals, in the order that the shard sent;
3. *score*: each shard scores its documents.

A very frequent word or bigram is one entry per shard, whatever its count.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staffrank.llm.words import WordTable, mix64

MIN_COUNT = 2            # target occurrences of a vocabulary word
MASS = 16.0              # weight of the word distribution in a bigram's estimate
SHARD_BYTES = 4 << 20
BUCKET_ENTRIES = 1 << 20

_UNKNOWN, _START, _TOTAL, _VOCABULARY = (np.uint64(k) for k in range(1, 5))
_ASK = "bucket int, shard int, kind int, entries binary, target binary, background binary"
_ANSWER = "shard int, kind int, bucket int, entries binary, target binary, background binary, vocabulary long"
RESULT = "doc_id long, n_tokens long, target_loss double, background_loss double, score double"


def _planes(x: np.ndarray) -> bytes:
    """Values byte by byte, all lowest bytes first: zero bytes lie together and compress away."""
    return x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()


def _from_planes(raw: bytes, kind=np.uint64) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, dtype=np.uint8).reshape(size, -1).T).view(kind).ravel()


def _squeeze(counts: np.ndarray) -> bytes:
    """Counts are mostly small: a light entropy code takes them to a few bits each."""
    return zlib.compress(_planes(counts), 1)


def _pack(entries: np.ndarray) -> bytes:
    """Sorted entries as differences: five byte planes of noise, then the three high ones squeezed."""
    planes, cut = _planes(np.diff(entries, prepend=np.uint64(0))), 5 * len(entries)
    return planes[:cut] + zlib.compress(planes[cut:], 1) + len(entries).to_bytes(4, "little")


def _unpack(raw: bytes) -> np.ndarray:
    cut = 5 * int.from_bytes(raw[-4:], "little")
    return np.cumsum(_from_planes(raw[:cut] + zlib.decompress(raw[cut:-4])), dtype=np.uint64)


def _ranges(entries: np.ndarray, bits: int):
    """(bucket, lo, hi) of sorted entries, for the buckets that have some: never more rows than entries."""
    bucket = (entries >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(entries), np.int64)
    edge = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(entries)]
    return [(int(bucket[i]), i, j) for i, j in zip(edge, edge[1:]) if j > i]


def _asks(shard: int, kind: int, entries: np.ndarray, target: np.ndarray, background: np.ndarray, bits: int) -> pd.DataFrame:
    count = lambda x: _squeeze(x.astype(np.uint32))
    rows = [(b, shard, kind, _pack(entries[i:j]), count(target[i:j]), count(background[i:j])) for b, i, j in _ranges(entries, bits)]
    return pd.DataFrame(rows, columns=["bucket", "shard", "kind", "entries", "target", "background"])


def _read(pdf: pd.DataFrame) -> tuple[pd.DataFrame, WordTable, np.ndarray]:
    """A shard's documents, their words, and for each word whether its document is a target."""
    good = set(pdf.loc[~pdf["is_doc"], "doc_id"].tolist())
    docs = pdf[pdf["is_doc"]]
    table = WordTable(docs["text"].tolist())
    chosen = np.fromiter((i in good for i in docs["doc_id"].tolist()), dtype=bool, count=len(docs))
    return docs, table, chosen[table.doc]


def _ask_words(bits: int):
    def ask(key, pdf: pd.DataFrame) -> pd.DataFrame:
        _, table, target = _read(pdf)
        words, where = np.unique(table.hash, return_inverse=True)
        counts = np.bincount(where[target], minlength=len(words))
        return _asks(key[0], 0, words, counts, np.zeros(len(words)), bits)

    return ask


def _answer(min_count: int):
    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        """One bucket of one kind.  Words: which of each shard's are in the vocabulary, and to one
        of the shards how many are.  Counts: the sums of the entries of each shard, in its order."""
        words = pdf["kind"].iloc[0] == 0
        lists = [_unpack(x) for x in pdf["entries"]]
        entries, where = np.unique(np.concatenate(lists), return_inverse=True)
        add = lambda c: np.bincount(where, np.concatenate([_from_planes(zlib.decompress(x), np.uint32) for x in pdf[c]]), minlength=len(entries))
        target, background = add("target"), add("background")
        known = target >= min_count
        cut = np.cumsum([len(x) for x in lists])[:-1]
        rows, asking = [], sorted(set(pdf["shard"]))
        teller = asking[int(pdf["bucket"].iloc[0]) % len(asking)]
        for shard, bucket, mine, at in zip(pdf["shard"], pdf["bucket"], lists, np.split(where, cut), strict=True):
            if words:
                rows.append((shard, 0, bucket, len(mine).to_bytes(4, "little") + np.packbits(known[at]).tobytes(), b"", b"", int(known.sum()) if shard == teller else 0))
            else:
                rows.append((shard, 1, bucket, b"", _squeeze(target[at].astype(np.uint64)), _squeeze(background[at].astype(np.uint64)), 0))
        return pd.DataFrame(rows, columns=["shard", "kind", "bucket", "entries", "target", "background", "vocabulary"])

    return answer


def _entries(table: WordTable, told: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entry values of each word's bigram, context and own count, after the vocabulary."""
    told = told[told["kind"] == 0].sort_values("bucket")  # buckets in order are words in order
    marks = [np.unpackbits(np.frombuffer(x, dtype=np.uint8, offset=4), count=int.from_bytes(x[:4], "little")) for x in told["entries"]]
    known = np.concatenate(marks or [np.zeros(0, np.uint8)]).astype(bool)
    token = np.where(known[np.unique(table.hash, return_inverse=True)[1]], table.hash, _UNKNOWN)
    before = np.roll(token, 1)
    before[table.first[table.n_words > 0]] = _START
    a, b = mix64(before + np.uint64(0x632BE59BD9B4E019)), mix64(token + np.uint64(0xD1B54A32D192ED03))
    return mix64(a * np.uint64(3) + b), a, b


def _distinct(table: WordTable, told: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct entries, and the places in them of all bigrams, contexts, words and, last, the
    total and the size of the vocabulary."""
    entries, where = np.unique(np.concatenate((*_entries(table, told), [_TOTAL, _VOCABULARY])), return_inverse=True)
    return entries, where


def _ask_counts(bits: int):
    def ask(key, pdf: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        _, table, target = _read(pdf)
        entries, where = _distinct(table, told)
        counts = np.bincount(where[:-2], minlength=len(entries))
        chosen = np.bincount(where[:-2][np.tile(target, 3)], minlength=len(entries))
        counts[where[-2]], chosen[where[-2]] = len(target), int(target.sum())
        counts[where[-1]] = chosen[where[-1]] = int(told["vocabulary"].sum())
        return _asks(key[0], 1, entries, chosen, counts, bits)

    return ask


def _counts(told: pd.DataFrame, model: str) -> np.ndarray:
    """Totals of the shard's entries: buckets in order are entries in order."""
    told = told[told["kind"] == 1].sort_values("bucket")
    return np.concatenate([_from_planes(zlib.decompress(x)) for x in told[model]]).astype(np.float64)


def _score(mass: float):
    def score(key, pdf: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        docs, table, _ = _read(pdf)
        _, where = _distinct(table, told)
        n = len(table.hash)
        loss = {}
        for model in ("target", "background"):
            count = _counts(told, model)[where]
            base = (count[2 * n: 3 * n] + 1) / (count[3 * n] + count[3 * n + 1] + 1)
            p = (count[:n] + mass * base) / (count[n: 2 * n] + mass)
            loss[model] = np.bincount(table.doc, -np.log2(p), minlength=len(docs))
        with np.errstate(invalid="ignore", divide="ignore"):
            t, b = (np.where(table.n_words > 0, loss[m] / table.n_words, np.nan) for m in ("target", "background"))
        out = pd.DataFrame({"doc_id": docs["doc_id"].astype("Int64").to_numpy(dtype=object, na_value=None), "n_tokens": table.n_words, "target_loss": t, "background_loss": b, "score": t - b})
        return out.astype({"target_loss": "Float64", "background_loss": "Float64", "score": "Float64"})

    return score


def cross_entropy_difference(docs: DataFrame, good: DataFrame, min_count: int = MIN_COUNT, mass: float = MASS,
                             shard_bytes: int = SHARD_BYTES, bucket_entries: int = BUCKET_ENTRIES) -> DataFrame:
    """Score every row of ``docs`` (doc_id, text) with the documents whose ids are in ``good``
    (doc_id) as target.

    Returns doc_id, n_tokens, target_loss, background_loss and score per input row; other columns
    are ignored.  Defined cases: a text without words (null, empty) has no losses and no score;
    repeated ids in ``good`` count once, ids without a document not at all; rows that repeat a
    ``doc_id`` are each counted and scored; a null ``doc_id`` is background only; with no target
    every word is unknown; an empty table gives an empty table.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.lit(True).alias("is_doc"))
    good = good.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"), F.lit(False).alias("is_doc")).where("doc_id IS NOT NULL").distinct()
    size = docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 16)).first()[0] or 0
    shards = max(1, -(-size // shard_bytes))
    bits = max(0, (max(1, size // 8) // bucket_entries).bit_length())
    shard = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id"), F.xxhash64("text"))), F.lit(shards)).cast("int")
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = docs.unionByName(good).withColumn("shard", shard).repartition(tasks, "shard")
    of_shard = dealt.groupBy("shard")
    words = of_shard.applyInPandas(_ask_words(bits), _ASK).groupBy("bucket").applyInPandas(_answer(min_count), _ANSWER)
    asked = of_shard.cogroup(words.groupBy("shard")).applyInPandas(_ask_counts(bits), _ASK)
    counts = asked.groupBy("bucket").applyInPandas(_answer(min_count), _ANSWER)
    return of_shard.cogroup(words.unionByName(counts).groupBy("shard")).applyInPandas(_score(mass), RESULT)
