"""Corpus pipeline: five of the training-data operators in a row over ``documents``.

Each stage takes (spark, docs, sf_dir) and works on every row its predecessor kept; its result is
written as Parquet and read again as the next stage's ``docs``.  All but the last return the columns
of ``documents``.  A lost executor costs the tasks of one stage: earlier stages are files.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staffrank.llm.bpe import encode_documents
from staffrank.llm.decontaminate import with_hits
from staffrank.llm.line_dedup import remove_boilerplate
from staffrank.llm.quality import judge
from staffrank.llm.simhash import near_duplicates, with_fingerprint
from staffrank.llm.words import fresh
from staffrank.session import shared_dir

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return judge(docs).where("kept").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without cross-site boilerplate lines; ``n_chars`` follows the text."""
    kept = remove_boilerplate(docs).select(*docs.columns)
    return kept.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else kept


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest ``doc_id`` of each near-duplicate group.

    Of several rows with this id the first in the order of their columns stays.  Rows without an id
    never name a group, so of these only groups that have no other rows stay, one row for each text.
    """
    groups = near_duplicates(docs).checkpoint()
    first = groups.where("doc_id = component_id").groupBy("doc_id").agg(F.count("*").alias("rows"))
    stays = docs.join(first.where("rows = 1").select("doc_id"), "doc_id", "left_semi")
    again = docs.join(first.where("rows > 1").select("doc_id"), "doc_id", "left_semi")
    again = again.groupBy("doc_id").agg(F.min(F.struct(*docs.columns)).alias("row")).select("row.*")
    kept = stays.unionByName(again)
    if not groups.where("component_id IS NULL").isEmpty():
        out, named = fresh("_fp", docs.columns), fresh("_hex", docs.columns)
        lone = with_fingerprint(docs.where("doc_id IS NULL"), out)
        lone = lone.join(groups.where("component_id IS NULL").select(F.col("fingerprint").alias(named)).distinct(),
                         F.lower(F.lpad(F.hex(out), 16, "0")) == F.col(named), "left_semi")
        kept = kept.unionByName(lone.select(*docs.columns).dropDuplicates())
    return kept.select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    out = fresh("_hit", docs.columns)
    hits = with_hits(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), out)
    return hits.where(f"NOT {out}.contaminated").select(*docs.columns)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of the bytes they decode to."""
    coded = encode_documents(docs.select("doc_id", "text", "lang", "source"), RANKS, public_tokenizers.PATTERN, "_bpe")
    return coded.select(
        "doc_id", "lang", "source", F.size("_bpe.ids").cast("long").alias("n_tokens"), F.col("_bpe.ids").alias("ids"),
        F.sha2(F.array_join(F.col("_bpe.ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("_bpe.decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", simhash_dedup),
    ("benchmark decontamination", decontaminate),
    ("byte-level BPE", byte_bpe),
]

#: SQL expresses neither fingerprint links nor byte pair encoding; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table, through files in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = shared_dir(spark, f"corpus-pipeline-{uuid.uuid4().hex}")
    for number, (_, stage) in enumerate(STAGES[:-1]):
        path = f"{base}/stage-{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
