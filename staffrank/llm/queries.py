"""The registered queries of the training-data operators: thin calls on whole tables.

Each query applies one operator with its production parameters and derives the digest columns of
its result from the operator's real outputs (texts, spans, items).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(fn: QueryFn) -> QueryFn:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def queries() -> dict[str, QueryFn]:
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    return dict(ORACLES)


@register
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from staffrank.llm.substring_dedup import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", F.col("n_removed").cast("long").alias("n_removed"),
        F.sha2("kept_text", 256).alias("kept_sha256"), F.size("intervals").alias("n_intervals"))


@register
def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from staffrank.llm.decontaminate import with_hits

    found = with_hits(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"), "hit")
    return found.select(
        "doc_id", "hit.n_words", "hit.n_hit", F.size("hit.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit.items", ","), 256).alias("items_sha256"), "hit.contaminated")


@register
def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from staffrank.llm.bpe import encode_documents

    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = encode_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), ranks, public_tokenizers.PATTERN, "bpe")
    return coded.select(
        "doc_id", F.size("bpe.ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("bpe.ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("bpe.decoded", 256).alias("decoded_sha256"))


@register
def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from staffrank.llm.simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


@register
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from staffrank.llm.quality import judge

    return judge(table(spark, sf_dir, "documents").select("doc_id", "text", "lang")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("char_distance", 6).alias("char_distance"), F.round("word_distance", 6).alias("word_distance"))


@register
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from staffrank.llm.line_dedup import remove_boilerplate

    kept = remove_boilerplate(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


ORACLES["op8_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, source, unnest(list_zip(string_split(text, chr(10)), range(len(string_split(text, chr(10)))))) AS l
  FROM documents),
worded AS (SELECT doc_id, source, l[1] AS line, l[2] AS place, regexp_matches(l[1], '[^\x20\x09-\x0D]') AS word FROM lines),
spread AS (SELECT line, min(doc_id) AS first_id FROM worded WHERE word GROUP BY line HAVING count(DISTINCT source) >= 10),
marked AS (
  SELECT w.doc_id, w.line, w.place, w.word, s.line IS NOT NULL AND w.doc_id IS DISTINCT FROM s.first_id AS lost
  FROM worded w LEFT JOIN spread s ON w.word AND w.line = s.line)
SELECT doc_id, sum(word::INT)::BIGINT AS n_lines, sum(lost::INT)::BIGINT AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@register
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from staffrank.llm.url_filter import judge_urls

    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url")).select(
        "page_id", "host", "path", "rule", "verdict", F.round("score", 6).alias("score"))


@register
def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    from staffrank.llm.lm_score import cross_entropy_difference

    good = table(spark, sf_dir, "labels").where("quality = 1 AND toxic = 0")
    scored = cross_entropy_difference(table(spark, sf_dir, "documents"), good)
    return scored.select("doc_id", "n_tokens", *[F.round(c, 6).alias(c) for c in ("target_loss", "background_loss", "score")])


@register
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from staffrank.llm.licenses import scan

    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "n_paragraphs", F.size("notices").cast("long").alias("n_notices"),
        F.array_join("families", ",").alias("families"),
        F.array_join(F.transform("notices", lambda n: F.concat_ws(":", n["paragraph"], n["family"])), ",").alias("notices"))


@register
def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from staffrank.llm.html_text import extract_text

    return extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@register
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from staffrank.llm.filter_audit import audit

    return audit(spark, f"{sf_dir}/documents.parquet", table(spark, sf_dir, "labels"))


ORACLES["op13_filter_audit"] = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
known AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
judged AS (
  SELECT part, (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
         + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t))::INT
         + 8 * regexp_matches(t, '[#$%&*|]')::INT
         + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), FALSE)::INT AS mask,
         coalesce(good, FALSE) AS good, coalesce(toxic, FALSE) AS toxic
  FROM texts LEFT JOIN known USING (doc_id)),
counted AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM judged GROUP BY ALL),
letters AS (SELECT substr('ABCDE', i::INT, 1) AS letter, 1 << (i::INT - 1) AS bit FROM range(1, 6) r(i)),
orders AS (
  SELECT '' AS filter_order, 0 AS used UNION ALL
  SELECT filter_order || letter, used + bit FROM orders JOIN letters ON used & bit = 0),
steps AS (
  SELECT filter_order, i::INT AS step, bit,
         (SELECT coalesce(sum(b.bit), 0) FROM letters b WHERE strpos(filter_order, b.letter) < i)::INT AS before
  FROM orders, range(1, 6) r(i), letters WHERE length(filter_order) = 5 AND substr(filter_order, i::INT, 1) = letter),
cells AS (
  SELECT part, filter_order, step, bit, sum(n) FILTER (mask & (before | bit) = 0) AS kept,
         sum(n) FILTER (mask & before = 0 AND mask & bit <> 0) AS removed,
         sum(n) FILTER (mask & before <> 0 AND mask & bit <> 0) AS redundant, sum(n) FILTER (mask = bit) AS unique_fails,
         sum(good) FILTER (mask & before = 0 AND mask & bit <> 0) AS good_lost,
         sum(toxic) FILTER (mask & before = 0 AND mask & bit <> 0) AS toxic_lost
  FROM counted, steps GROUP BY ALL)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
       coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       coalesce(sum(removed) OVER (PARTITION BY part, bit), 0)::BIGINT AS shapley
FROM cells
"""


@register
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from staffrank.llm.hard_negatives import mine, with_moved_labels

    return mine(with_moved_labels(table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")))


ORACLES["op12_hard_negatives"] = """
WITH valid AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS z
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, b.vec_id, b.label, list_dot_product(a.z, b.z)::BIGINT AS score
  FROM valid a JOIN valid b ON a.vec_id % 100 = 0 AND len(a.z) = len(b.z)),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored
  WHERE label = anchor_label AND vec_id <> anchor_id
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER place)::INT AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE label <> anchor_label AND 80 * positive_score <= 100 * score AND score <= positive_score
WINDOW place AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY rank <= 5
"""


@register
def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from staffrank.llm.language_id import identify

    found = identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return found.select("doc_id", "held_out", F.col("language.lang").alias("lang_pred"), F.round("language.score", 6).alias("score"))
