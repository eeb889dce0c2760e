"""Ranking (H1-H5). All ranks are per-shift windows over at most ``limit`` candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staffrank.functions.expressions import epoch_seconds
from staffrank.operators.features import only


def rank_by_score(cands: DataFrame, scored: DataFrame) -> DataFrame:
    """H1: order by score desc; ties keep candidate order; users without a score get 0.0 and
    follow the scored ones at equal score. Adds ``known``, ``score``, ``rank``."""
    s = scored.select("shift_id", "user_id", F.col("score").cast("double").alias("_s"))
    x = (cands.join(s.hint("shuffle_hash"), ["shift_id", "user_id"], "left")
         .withColumn("known", F.col("_s").isNotNull())
         .withColumn("score", F.coalesce(F.col("_s"), F.lit(0.0))).drop("_s"))
    w = Window.partitionBy("shift_id").orderBy(F.col("score").desc(), F.col("known").desc(),
                                               F.col("cand_rank").asc())
    return x.withColumn("rank", F.row_number().over(w))


def rerank(ranked: DataFrame, shifts: DataFrame, pair_hist: DataFrame, sleepers: DataFrame,
           apply_exists: bool | None = None, among: DataFrame | None = None) -> DataFrame:
    """H2: three-tier rerank of a scored list ``(shift_id, user_id, score, rank)``.

    tier 0: applied to this very shift, by days since the last apply (floored at 0) asc;
    tier 1: sleepers, by ``finish_rate`` desc; tier 2: the rest. Then score desc, prior rank.
    Skipped (prior order kept) when the shift id is empty, its start is null, or no APPLY
    exists anywhere in the history (``apply_exists``; computed as one scalar when not given).
    ``among``: the users that the list may name, when they are known and few.
    """
    st = shifts.select(F.col("id").alias("shift_id"), "start_at")
    ph = pair_hist.select("shift_id", "user_id", "last_apply_ts").where(
        F.col("last_apply_ts").isNotNull())
    sl = sleepers.select("user_id", F.col("finish_rate").alias("_sleep_fr"))
    if apply_exists is None:
        apply_exists = ph.limit(1).count() > 0
    if among is not None:
        ph, sl = only(ph, among, False), only(sl, among)
    x = ranked.join(st.hint("shuffle_hash"), "shift_id", "left").join(
        ph.hint("shuffle_hash"), ["shift_id", "user_id"], "left").join(sl, "user_id", "left")
    days = F.greatest(F.lit(0.0), (epoch_seconds("start_at") - epoch_seconds("last_apply_ts"))
                      / 86400.0)
    tier = (F.when(F.col("last_apply_ts").isNotNull(), 0)
            .when(F.col("_sleep_fr").isNotNull(), 1).otherwise(2))
    key = (F.when(F.col("last_apply_ts").isNotNull(), days)
           .when(F.col("_sleep_fr").isNotNull(), -F.col("_sleep_fr")).otherwise(0.0))
    active = (F.col("shift_id").isNotNull() & (F.col("shift_id") != "")
              & F.col("start_at").isNotNull())
    active = active & F.lit(bool(apply_exists))
    x = x.withColumn("_active", active).withColumn("_tier", F.when(active, tier).otherwise(2)) \
         .withColumn("_key", F.when(active, key).otherwise(0.0)) \
         .withColumn("_negscore", F.when(active, -F.col("score")).otherwise(0.0))
    w = Window.partitionBy("shift_id").orderBy("_tier", "_key", "_negscore", "rank")
    return (x.withColumn("rank", F.row_number().over(w))
            .drop("_tier", "_key", "_negscore", "_active", "_sleep_fr", "start_at",
                  "last_apply_ts"))


def top_n(ranked: DataFrame, n: int = 10, rank_col: str = "rank") -> DataFrame:
    """H3: keep ranks 1..n (1 <= n <= 100)."""
    if not 1 <= n <= 100:
        raise ValueError("n must be within 1..100")
    return ranked.where(F.col(rank_col) <= n)


def activity_recommend(cands: DataFrame, n: int = 10) -> DataFrame:
    """H4: untrained fallback: the candidates in activity order, top n."""
    return top_n(cands.withColumnRenamed("cand_rank", "rank"), n)


def rank_score(top: DataFrame, rank_col: str = "rank") -> DataFrame:
    """H5: score = 1 - (rank - 1) / max(1, n), n = length of the shift's returned list."""
    n = F.count(F.lit(1)).over(Window.partitionBy("shift_id"))
    return top.withColumn("score", F.lit(1.0) - (F.col(rank_col) - 1) / F.greatest(F.lit(1), n))


def heuristic_score(features: DataFrame) -> DataFrame:
    """A deterministic stand-in score for exact ranking checks: apply rate + location match."""
    return features.withColumn("score", F.col("user_apply_rate") + F.col("location_match"))
