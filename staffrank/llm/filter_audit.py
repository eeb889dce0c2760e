"""How five document filters interact, kept by a stream that takes earlier verdicts back.

Filters (a document fails ``A`` .. ``E``): fewer than 200 words; fewer than half of the words
distinct; more than 2 % of the code points in ``[A-Z]``; any of ``#$%&*|``; the text of a document
with a smaller ``doc_id``.  A to D follow from the text alone.  E depends on documents that may
arrive later, so the audit is a Structured Streaming job over the files of the table:

* a micro-batch reduces every text to a digest, its mask of failed filters and its labels;
* each task keeps the smallest id of a text as the only candidate and counts the others, which
  surely fail E, at once: a group of copies reaches the keyed state as one row for each task;
* the state of a text holds its smallest id so far and what was counted for it.  A smaller id
  retracts that count (-1 without E, +1 with E) and takes its place.  Texts are dealt into buckets of
  a few hundred by their digest, so that one call settles a bucket's texts together;
* the micro-batch's changes, summed by part, mask and labels, are one folder of the counters.  A
  repeated micro-batch overwrites its own folder, so each change counts once.

The counters (at most 128 rows for each part) give the report of all 120 filter orders.

Null text: empty.  Null source: part ``''``.  A row without ``doc_id`` is counted, has no labels,
never fails E and makes no other row fail it.  Rows that share the smallest ``doc_id`` and the text
all pass E.  Repeated ``labels`` rows: a label holds if any row has it.  An empty table gives no
rows.  Other columns are not read.  Texts are told apart by SHA-256.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from hashlib import sha256
from itertools import permutations

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from staffrank.session import shared_dir

FILTERS = "ABCDE"
COPY = 16  #: the bit of E
#: micro-batches that a whole table is dealt into: each reads the labels once
ROUNDS = 4
TEXTS = 512  #: of one bucket of the state, on average
LABELS = ["good", "toxic"]
CHANGE = "part string, mask int, good boolean, toxic boolean, n long"


_CAPITALS = bytes(range(0x41, 0x5B))
_LATER = bytes(range(0x80, 0xC0))  # bytes of a UTF-8 character after its first one


def failed_by_text(text: bytes) -> int:
    """Bits 1, 2, 4 and 8 for the filters A to D, of a text in UTF-8."""
    words = text.split()  # bytes split at \x20 and \x09-\x0D only
    n, capitals = len(words), len(text) - len(text.translate(None, _CAPITALS))
    tests = (n < 200, 100 * len(set(words)) < 50 * n, 100 * capitals > 2 * len(text.translate(None, _LATER)),
             len(text.translate(None, b"#$%&*|")) < len(text))
    return sum(1 << i for i, t in enumerate(tests) if t)


def _reduced(texts: pd.Series) -> pd.DataFrame:
    """Digest and mask of each text."""
    return pd.DataFrame({"key": [sha256(t).hexdigest() for t in texts], "mask": [failed_by_text(t) for t in texts]})


def _candidates(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One task's rows: the smallest id of each text by its key, all other rows as plain counts.

    Counts have a key of the task's own, so the counts of one task stay together and those of
    different tasks apart.
    """
    own, by = f"#{TaskContext.get().partitionId()}", ["part", "mask", *LABELS]
    held, sure = None, []
    for f in frames:
        alone = f.doc_id.isna()
        sure.append(f[alone].groupby(by, as_index=False).n.sum())
        f = f[~alone]
        f = f if held is None else pd.concat([held, f], ignore_index=True)
        first = f.doc_id == f.groupby("key").doc_id.transform("min")
        late = f[~first]
        sure.append(late.assign(mask=late["mask"] | COPY).groupby(by, as_index=False).n.sum())
        held = f[first].groupby(["key", "doc_id", *by], as_index=False).n.sum()
        sure = [pd.concat(sure).groupby(by, as_index=False).n.sum()]
    if held is not None:
        yield held[["key", "doc_id", *by, "n"]]
        yield sure[0].assign(key=own, doc_id=pd.array([None] * len(sure[0]), dtype="Int64"))[["key", "doc_id", *by, "n"]]


def _packed(held: pd.DataFrame) -> bytes:
    table, out = pa.Table.from_pandas(held, preserve_index=False), pa.BufferOutputStream()
    with pa.ipc.new_stream(out, table.schema) as w:
        w.write_table(table)
    return out.getvalue().to_pybytes()


def _settle(bucket: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Changes of the counters by the new candidates for the texts of one bucket."""
    came, by = pd.concat(list(frames)).drop(columns="bucket"), ["part", "mask", *LABELS]
    if bucket[0].startswith("#"):
        yield came[[*by, "n"]]
        return
    came = came.assign(doc_id=came.doc_id.astype("int64"), new=True)
    if state.exists:
        held = pa.ipc.open_stream(state.get[0]).read_pandas()
        came = pd.concat([held.assign(new=False), came[[*held.columns, "new"]]], ignore_index=True)
    first = came.doc_id == came.groupby("key").doc_id.transform("min")
    copy, back = came[~first], came[~first & ~came.new]
    yield pd.concat([came[first & came.new], copy.assign(mask=copy["mask"] | COPY), back.assign(n=-back.n)])[[*by, "n"]]
    state.update((_packed(came[first].groupby(["key", "doc_id", *by], as_index=False).n.sum()),))


def read_documents(spark: SparkSession, path: str, rounds: int = ROUNDS) -> DataFrame:
    """The table's files as a stream of about ``rounds`` micro-batches; one file or a folder."""
    table = spark.read.parquet(path)
    files = -(-len(table.inputFiles()) // rounds)
    return (spark.readStream.schema(table.schema).option("maxFilesPerTrigger", max(1, files))
            .parquet(path.rstrip("/") + "*"))


def count_masks(stream: DataFrame, labels: DataFrame, root: str, buckets: int) -> DataFrame:
    """Runs the stream to its end; rows (part, mask, good, toxic, n): documents by failed filters.

    The state of the texts is kept in ``buckets`` groups.  ``root`` is a shared folder: the stream's
    checkpoint and counters lie there, and a call with the same folder and number of buckets goes on
    where the last one ended, with the files that are new since.
    """
    spark = stream.sparkSession
    known = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")).withColumn("salt", F.lit(0))
    reduced = F.pandas_udf(_reduced, "key string, mask int")
    texts = stream.select("doc_id", F.coalesce("source", F.lit("")).alias("part"),
                          reduced(F.coalesce("text", F.lit("")).cast("binary")).alias("t"))
    # rows without an id match no label; the salt deals them out over the join's tasks
    facts = texts.select(
        "doc_id", "part", "t.key", "t.mask",
        F.when(F.col("doc_id").isNull(), F.spark_partition_id() + F.crc32("t.key") % 1000).otherwise(0).cast("int").alias("salt"))
    told = facts.join(known, ["doc_id", "salt"], "left").select(
        "key", "doc_id", "part", "mask", *[F.coalesce(c, F.lit(False)).alias(c) for c in LABELS], F.lit(1).cast("long").alias("n"))
    row = "key string, doc_id long, " + CHANGE
    bucket = F.when(F.col("key").startswith("#"), F.col("key")).otherwise(F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("string"))
    changes = told.mapInPandas(_candidates, row).withColumn("bucket", bucket).groupBy("bucket").applyInPandasWithState(
        _settle, CHANGE, "held binary", "update", GroupStateTimeout.NoTimeout)
    by = ["part", "mask", *LABELS]

    def write(batch: DataFrame, number: int) -> None:
        batch.groupBy(*by).agg(F.sum("n").alias("n")).write.mode("overwrite").parquet(f"{root}/counters/batch={number}")

    spark.createDataFrame([], CHANGE).write.mode("overwrite").parquet(f"{root}/counters/batch=-1")
    run = (changes.writeStream.outputMode("update").option("checkpointLocation", f"{root}/stream")
           .foreachBatch(write).trigger(availableNow=True).start())
    run.awaitTermination()
    return spark.read.schema(CHANGE).parquet(f"{root}/counters").groupBy(*by).agg(F.sum("n").alias("n")).where("n <> 0")


def report(counters: DataFrame) -> DataFrame:
    """Rows (part, filter_order, step) of the counters: what each filter of each order does."""
    steps = []
    for order in permutations(range(len(FILTERS))):
        before = 0
        for place, i in enumerate(order):
            steps.append({"filter_order": "".join(FILTERS[k] for k in order), "step": place + 1, "bit": 1 << i, "before": before})
            before |= 1 << i
    masks = counters.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), *[F.sum(F.when(F.col(c), F.col("n")).otherwise(0)).alias(c) for c in LABELS])
    parts = masks.groupBy("part").agg(F.collect_list(F.struct("mask", "n", *LABELS)).alias("m"))  # at most 32 masks
    listed = F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order string, step int, bit int, before int>>")
    cells = parts.select("part", "m", F.explode(listed).alias("s")).select("part", "m", "s.*")

    def total(test: str, value: str = "x.n") -> F.Column:
        return F.expr(f"aggregate(m, 0L, (a, x) -> a + IF({test}, {value}, 0L))")

    here = "x.mask & before = 0 AND x.mask & bit <> 0"
    return cells.select(
        "part", "filter_order", "step",
        total("x.mask & (before | bit) = 0").alias("kept"),
        total(here).alias("removed"),
        total("x.mask & before <> 0 AND x.mask & bit <> 0").alias("redundant"),
        total("x.mask = bit").alias("unique_fails"),
        total(here, "x.good").alias("good_lost"),
        total(here, "x.toxic").alias("toxic_lost"),
        # of a document that fails k filters each is the first in 120 / k orders
        total("x.mask & bit <> 0", "x.n * (120 DIV bit_count(x.mask))").alias("shapley"))


def audit(spark: SparkSession, path: str, labels: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """The report of all documents in the Parquet files at ``path``."""
    root = shared_dir(spark, f"filter-audit-{uuid.uuid4().hex}")
    buckets = 1 + spark.read.parquet(path).count() // TEXTS
    return report(count_masks(read_documents(spark, path, rounds), labels, root, buckets))
