"""Registered queries: ranking (H1-H5). H6 (model-scored batch recommend) lives in q_models."""

from __future__ import annotations

from pyspark.sql import functions as F

from staffrank.operators import candidates as C
from staffrank.operators import features as E
from staffrank.operators import history as D
from staffrank.operators import ranking as H
from staffrank.operators import splits as S
from staffrank.plans.derived import with_unscored
from staffrank.plans.flagship import SPLIT_T
from staffrank.plans.q_history import feature_blocks
from staffrank.plans.registry import register
from staffrank.plans.sqlkit import ADAPTER, SPLIT, activity_sql, candidates_sql, split_sql, with_

# Fixed value: an early split whose history has sleepers and applies to later shifts.
RERANK_T = "2024-01-08 00:00:00"


def scored_candidates(d, t: str):
    """C4 candidates of the validation shifts at ``t``, the 26 features from the history up to
    ``t``, the heuristic score; derived candidates are unknown to the scorer.  Also the state and
    the users that the candidates name."""
    sp = S.date_split(d.shifts, d.events, t)
    state = E.build_state(d.users, d.shifts, sp.train_events)
    act = C.user_activity(d.users, sp.train_events)
    lists = C.location_lists(sp.val_shifts, act).checkpoint()
    cands = C.candidates(sp.val_shifts, act, lists=lists)
    feats = E.pair_features(cands, d.shifts, state, C.listed_users(lists))
    scored = H.heuristic_score(feats).select("shift_id", "user_id", "score")
    return with_unscored(cands), scored, state, C.listed_users(with_unscored(lists))


RANK_SQL = """,
scored AS (SELECT shift_id, user_id, user_apply_rate + location_match AS score FROM feat),
cands_u AS (SELECT shift_id, user_id, cand_rank FROM cands UNION ALL
            SELECT shift_id, 'u' || user_id, cand_rank + 1000 FROM cands WHERE cand_rank % 5 = 0),
ranked AS (
  SELECT c.shift_id, c.user_id, c.cand_rank, s.score IS NOT NULL AS known,
         COALESCE(s.score, 0.0) AS score,
         row_number() OVER (PARTITION BY c.shift_id
                            ORDER BY COALESCE(s.score, 0.0) DESC, s.score IS NOT NULL DESC, c.cand_rank) AS rank
  FROM cands_u c LEFT JOIN scored s ON s.shift_id = c.shift_id AND s.user_id = c.user_id)"""


@register("h1_rank_by_score", with_(*feature_blocks()) + RANK_SQL + """
SELECT shift_id, user_id, cand_rank, known, round(score, 6) AS score, rank FROM ranked""")
def h1(d):
    cands, scored, _, _ = scored_candidates(d, SPLIT_T)
    return H.rank_by_score(cands, scored).select("shift_id", "user_id", "cand_rank", "known",
                                                 "score", "rank")


RERANK_SQL = """,
phx AS (SELECT user_id, shift_id, last_apply_ts FROM ph WHERE last_apply_ts IS NOT NULL),
sl AS (SELECT user_id, finish_rate FROM hist WHERE total_applies = 0 AND finish_rate > 0),
rr AS (
  SELECT r.*, s.start_at, p.last_apply_ts, sl.finish_rate AS sfr,
         (r.shift_id IS NOT NULL AND r.shift_id <> '' AND s.start_at IS NOT NULL
          AND (SELECT count(*) FROM phx) > 0) AS active
  FROM ranked r LEFT JOIN shifts s ON s.id = r.shift_id
  LEFT JOIN phx p ON p.user_id = r.user_id AND p.shift_id = r.shift_id
  LEFT JOIN sl ON sl.user_id = r.user_id),
rr2 AS (
  SELECT *,
    CASE WHEN NOT active THEN 2 WHEN last_apply_ts IS NOT NULL THEN 0 WHEN sfr IS NOT NULL THEN 1 ELSE 2 END AS tier,
    CASE WHEN NOT active THEN 0.0
         WHEN last_apply_ts IS NOT NULL THEN greatest(0.0, (epoch(start_at) - epoch(last_apply_ts)) / 86400.0)
         WHEN sfr IS NOT NULL THEN -sfr ELSE 0.0 END AS k,
    CASE WHEN NOT active THEN 0.0 ELSE -score END AS ns
  FROM rr),
reranked AS (
  SELECT shift_id, user_id, score, rank AS prior_rank,
         row_number() OVER (PARTITION BY shift_id ORDER BY tier, k, ns, rank) AS rank
  FROM rr2)"""


def reranked(d):
    cands, scored, state, users = scored_candidates(d, RERANK_T)
    ranked = H.rank_by_score(cands, scored)
    return H.rerank(ranked.withColumn("prior_rank", F.col("rank")), d.shifts, state.pairs,
                    state.sleepers, among=users)


_RR_BLOCKS = feature_blocks(split_sql(f"TIMESTAMP '{RERANK_T}'"))


@register("h2_rerank", with_(*_RR_BLOCKS) + RANK_SQL + RERANK_SQL + """
SELECT shift_id, user_id, round(score, 6) AS score, prior_rank, rank FROM reranked""")
def h2(d):
    """Three-tier rerank at the early split (tier 0: applied to this shift, tier 1: sleepers)."""
    return reranked(d).select("shift_id", "user_id", "score", "prior_rank", "rank")


@register("h3_top_n", with_(*_RR_BLOCKS) + RANK_SQL + RERANK_SQL + """
SELECT shift_id, user_id, rank FROM reranked WHERE rank <= 10""")
def h3(d):
    return H.top_n(reranked(d), 10).select("shift_id", "user_id", "rank")


@register("h4_activity_recommend", with_(ADAPTER, SPLIT, activity_sql("tr_e"), candidates_sql("va_s")) + """
SELECT shift_id, user_id, cand_rank AS rank FROM cands WHERE cand_rank <= 10""")
def h4(d):
    sp = S.date_split(d.shifts, d.events, SPLIT_T)
    cands = C.candidates(sp.val_shifts, C.user_activity(d.users, sp.train_events))
    return H.activity_recommend(cands, 10).select("shift_id", "user_id", "rank")


@register("h5_rank_score", with_(ADAPTER, SPLIT, activity_sql("tr_e"), candidates_sql("va_s")) + """
SELECT shift_id, user_id, cand_rank AS rank,
       round(1.0 - (cand_rank - 1) / greatest(1, count(*) OVER (PARTITION BY shift_id)), 6) AS score
FROM cands WHERE cand_rank <= 10""")
def h5(d):
    sp = S.date_split(d.shifts, d.events, SPLIT_T)
    cands = C.candidates(sp.val_shifts, C.user_activity(d.users, sp.train_events))
    return H.rank_score(H.activity_recommend(cands, 10)).select("shift_id", "user_id", "rank",
                                                                 "score")


@register("d10_sleepers_rerank_input", with_(*_RR_BLOCKS) + """
SELECT user_id, round(finish_rate, 6) AS finish_rate FROM hist
WHERE total_applies = 0 AND finish_rate > 0""")
def d10r(d):
    """Sleepers of the rerank history (input of the tier-1 order)."""
    sp = S.date_split(d.shifts, d.events, RERANK_T)
    return D.sleepers(D.user_history(sp.train_events, d.shifts)).select("user_id", "finish_rate")
