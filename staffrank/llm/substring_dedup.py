"""Substring dedup: Rabin-Karp hashes of every fixed-length token window, counted in Spark.

The documents are dealt into *shards*: consecutive ranges of ``doc_id`` of a few MB of text each, cut
at quantiles of the ids weighted by bytes.
One job runs three steps on them:

1. **emit** (per shard): hash every window of ``width`` words, keep each hash once, and deal the
   sorted hashes by their leading bits into *buckets* (one binary value per shard and bucket);
2. **count** (per bucket): in how many shards does each hash occur?  The lowest shard that has a
   hash holds its first document; every other shard is told that the hash is a repeat;
3. **remove** (per shard): a window is a repeat if step 2 says so, or if a smaller ``doc_id`` of the
   same shard has it.  Overlapping and touching repeated windows merge into maximal intervals,
   and the words outside of them are kept.

Because shards are ranges of ``doc_id``, the exchange carries 8 bytes per window and no ids.  A very
common passage costs one entry per shard that has it, never one per document, and no task sees more
than one shard of text or one bucket of hashes.
"""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staffrank.llm.words import WordTable, rolling_hash
from staffrank.session import ensure_checkpoint_dir

WIDTH = 13
SHARD_BYTES = 4 << 20
BUCKET_HASHES = 1 << 20
FAN = 4096       # shards of one group of ranges
_CELL = 1 << 14  # numbers kept for the ranges of a group: its shards, and three for each id with many rows
_SUB = 20

RESULT = ("doc_id long, n_words long, n_removed long, "
          "intervals array<struct<start:int,stop:int>>, kept_text string")


def _place(borders: str, column: str = "doc_id") -> Column:
    """How many of the sorted borders lie under the column: a binary search."""
    steps = ", ".join(str(1 << k) for k in range(_CELL.bit_length() - 2, -1, -1))
    return F.expr(f"aggregate(array({steps}), 0, (at, step) -> IF(coalesce(get({borders}, at + step - 1) < {column}, false), at + step, at))")


def range_shards(docs: DataFrame, shard_bytes: int = SHARD_BYTES, fan: int = FAN) -> tuple[DataFrame, int]:
    """Add ``shard``: the number of a ``doc_id`` range of about ``shard_bytes`` of text.

    The borders are quantiles of ``doc_id`` weighted by bytes, however the ids are spread: first of
    groups of up to ``fan`` shards, then of the shards of each group (8 bytes a shard: this table is
    broadcast).  An id whose rows alone fill several shards is a range of its own, dealt by the text
    over numbers that share all but their low ``_SUB`` bits; its rows are not compared with each
    other.  Rows without an id get negative shards by a hash of their text; they are never compared.
    Returns the table and the bytes of text.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    sized = docs.where("doc_id IS NOT NULL").select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("bytes"))
    total = sized.agg(F.sum("bytes")).first()[0] or 0
    n = max(2, -(-total // shard_bytes))
    tops = -(-n // fan)
    fan = max(2, -(-n // tops))
    # a text counts once for each started unit
    units = sized.select("doc_id", F.explode(F.expr(f"sequence(0L, bytes DIV {max(1, min(1024, shard_bytes // 8))})")))
    cuts = lambda parts: F.percentile_approx("doc_id", [k / parts for k in range(1, parts)], 16 * parts)
    top_borders = json.dumps(list(units.agg(cuts(tops)).first()[0] or []) if tops > 1 else [])
    top = lambda column: _place(f"from_json('{top_borders}', 'array<bigint>')", column)
    heavy = (sized.groupBy("doc_id").agg(F.sum("bytes").alias("bytes"), F.count("*").alias("rows"))
             .where((F.col("rows") > 1) & (F.col("bytes") > 4 * shard_bytes))  # fewer than the shards
             .select(F.col("doc_id").alias("heavy_id"), F.ceil(F.col("bytes") / shard_bytes).alias("subs")).checkpoint())
    own = heavy.select(top("heavy_id").alias("top"), F.explode(F.expr("array(try_subtract(heavy_id, 1L), heavy_id)")).alias("border"))
    cells = units.groupBy(top("doc_id").alias("top")).agg(cuts(fan).alias("borders"))
    cells = cells.join(own.groupBy("top").agg(F.collect_list("border").alias("own")), "top", "left").select(
        F.col("top").alias("of_top"), F.array_sort(F.concat("borders", F.coalesce("own", F.array().cast("array<bigint>")))).alias("borders")).checkpoint()
    salt = F.pmod(F.xxhash64("text"), F.lit(64))
    rows = docs.withColumn("top", top("doc_id"))
    rows = rows.join(F.broadcast(cells), F.col("top") == F.col("of_top"), "left").join(F.broadcast(heavy), F.col("doc_id") == F.col("heavy_id"), "left")
    number = F.shiftleft(F.col("top").cast("long") * _CELL + _place("borders"), _SUB) + F.coalesce(F.pmod(F.xxhash64("text"), F.col("subs")), F.lit(0))
    return rows.select(*docs.columns, F.when(F.col("doc_id").isNull(), -1 - salt).otherwise(number).alias("shard")), total


def _windows(pdf: pd.DataFrame, width: int):
    """Words of the rows (in doc_id order), window hashes, and the word at which each window starts."""
    table = WordTable(pdf["text"].tolist())
    hashes = rolling_hash(table.hash, width)
    start = np.flatnonzero(table.doc[: len(hashes)] == table.doc[width - 1:]) if len(hashes) else np.zeros(0, np.int64)
    return table, hashes[start], start


def _emitter(width: int, bits: int):
    def emit(key, pdf: pd.DataFrame) -> pd.DataFrame:
        if key[0] < 0:
            return pd.DataFrame({"bucket": [], "shard": [], "hashes": []})
        _, hashes, _ = _windows(pdf, width)
        hashes = np.unique(hashes)
        bucket = (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)
        cut = np.flatnonzero(np.diff(bucket)) + 1
        lows, highs = np.concatenate(([0], cut)), np.concatenate((cut, [len(hashes)]))
        rows = [(int(bucket[a]), key[0], hashes[a:b].tobytes()) for a, b in zip(lows, highs, strict=True) if b > a]
        return pd.DataFrame(rows, columns=["bucket", "shard", "hashes"])

    return emit


def _count(pdf: pd.DataFrame) -> pd.DataFrame:
    """Hashes of one bucket -> for each shard the hashes that a lower shard also has."""
    pdf = pdf.sort_values("shard")
    lists = [np.frombuffer(b, dtype=np.uint64) for b in pdf["hashes"]]
    shard = np.repeat(pdf["shard"].to_numpy(), [len(x) for x in lists])
    hashes = np.concatenate(lists)
    order = np.argsort(hashes, kind="stable")  # equal hashes stay in shard order
    new = np.concatenate(([True], hashes[order[1:]] != hashes[order[:-1]]))
    ranges = shard[order] >> _SUB
    again = order[ranges > ranges[np.flatnonzero(new)][np.cumsum(new) - 1]]  # a lower range has them
    again = again[np.argsort(shard[again], kind="stable")]
    where, repeats = shard[again], hashes[again]
    cut = np.flatnonzero(np.diff(where)) + 1
    lows, highs = np.concatenate(([0], cut)), np.concatenate((cut, [len(where)]))
    rows = [(int(where[a]), repeats[a:b].tobytes()) for a, b in zip(lows, highs, strict=True) if b > a]
    return pd.DataFrame(rows, columns=["shard", "repeats"])


def _remover(width: int):
    def remove(key, pdf: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("doc_id", kind="stable").reset_index(drop=True)
        table, hashes, start = _windows(pdf, width)
        hit = np.zeros(len(hashes), dtype=bool)
        if key[0] >= 0 and len(hashes):
            repeats = np.sort(np.concatenate([np.frombuffer(b, dtype=np.uint64) for b in told["repeats"]] or [np.zeros(0, np.uint64)]))
            if len(repeats):
                at = np.minimum(np.searchsorted(repeats, hashes), len(repeats) - 1)
                hit = repeats[at] == hashes
            ids = pdf["doc_id"].to_numpy(dtype=np.int64)[table.doc[start]]
            order = np.argsort(hashes, kind="stable")
            new = np.concatenate(([True], hashes[order[1:]] != hashes[order[:-1]]))
            smallest = ids[order][np.flatnonzero(new)][np.cumsum(new) - 1]
            hit[order] |= ids[order] > smallest
        n_all = len(table.hash) + 1
        cover = np.bincount(start[hit], minlength=n_all) - np.bincount(start[hit] + width, minlength=n_all)
        gone = np.cumsum(cover[:-1]) > 0
        removed = np.bincount(table.doc[gone], minlength=len(pdf))
        rows = []
        for i, (doc_id, text) in enumerate(zip(pdf["doc_id"], pdf["text"], strict=True)):
            n, lo = int(table.n_words[i]), int(table.first[i])
            if removed[i]:
                mask = gone[lo: lo + n]
                edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
                cuts = [{"start": int(a), "stop": int(b)} for a, b in zip(edge[::2], edge[1::2], strict=True)]
                kept = b" ".join(w for w, x in zip(table.words(lo, lo + n), mask.tolist(), strict=True) if not x)
            else:
                cuts, kept = [], b" ".join((text or "").encode("utf-8").split())
            rows.append((None if doc_id is None or doc_id != doc_id else int(doc_id), n, int(removed[i]), cuts, kept.decode("utf-8")))
        out = pd.DataFrame(rows, columns=["doc_id", "n_words", "n_removed", "intervals", "kept_text"])
        out["doc_id"] = out["doc_id"].astype("Int64")
        return out

    return remove


def remove_repeats(docs: DataFrame, width: int = WIDTH, shard_bytes: int = SHARD_BYTES,
                   bucket_hashes: int = BUCKET_HASHES) -> DataFrame:
    """Remove every word that lies in a window of ``width`` words which also starts in a document
    with a smaller ``doc_id``.  ``docs`` needs ``doc_id`` (integer) and ``text``; other columns are
    ignored, whatever their names.

    Returns one row per input row: ``doc_id``, ``n_words``, ``n_removed``, ``intervals`` (maximal
    removed word ranges, stop exclusive) and ``kept_text`` (kept words joined by one space).

    Defined cases: a null or empty text has no words; a text of fewer than ``width`` words has no
    window and stays whole; rows that repeat a ``doc_id`` are not smaller than each other and stay;
    a null ``doc_id`` compares with nothing, so its row stays whole and removes nothing; an empty
    table gives an empty table.
    """
    rows, size = range_shards(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), shard_bytes)
    bits = max(0, (max(1, size // 6) // bucket_hashes).bit_length())
    spark = docs.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    dealt = rows.repartition(tasks, "shard")
    hashes = dealt.groupBy("shard").applyInPandas(_emitter(width, bits), "bucket int, shard long, hashes binary")
    repeats = hashes.groupBy("bucket").applyInPandas(_count, "shard long, repeats binary")
    return dealt.groupBy("shard").cogroup(repeats.groupBy("shard")).applyInPandas(_remover(width), RESULT)
