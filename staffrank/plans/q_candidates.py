"""Registered queries: candidate generation."""

from __future__ import annotations

from staffrank.operators import candidates as C
from staffrank.plans.registry import register
from staffrank.plans.sqlkit import ADAPTER, activity_sql, candidates_sql, with_


@register("c1_user_activity", with_(ADAPTER, activity_sql("ev")) + """
SELECT user_id, location_id, n_events FROM act""")
def c1(d):
    return C.user_activity(d.users, d.events).select("user_id", "location_id", "n_events")


@register("c2_location_rank", with_(ADAPTER, activity_sql("ev")) + """
SELECT location_id, user_id, n_events,
       row_number() OVER (PARTITION BY location_id ORDER BY n_events DESC, user_id) AS loc_rank
FROM act""")
def c2(d):
    """Uncapped per-location rank (every user of every location)."""
    return C.location_rank(C.user_activity(d.users, d.events)).select(
        "location_id", "user_id", "n_events", "loc_rank")


@register("c3_global_top", with_(ADAPTER, activity_sql("ev")) + """
SELECT user_id, n_events, row_number() OVER (ORDER BY n_events DESC, user_id) AS global_rank
FROM act ORDER BY n_events DESC, user_id LIMIT 549""")
def c3(d):
    """The global top list the fallback needs (extra + min_local - 1 = 549 rows)."""
    return C.global_top(C.user_activity(d.users, d.events), 549).select(
        "user_id", "n_events", "global_rank")


@register("c4_candidates", with_(ADAPTER, activity_sql("ev"), candidates_sql("shifts")) + """
SELECT shift_id, user_id, cand_rank FROM cands""")
def c4(d):
    """Candidates for all 100 shifts from the full history (both branches at sf0.01)."""
    return C.candidates(d.shifts, C.user_activity(d.users, d.events))


_ELIGIBLE = """
act_e AS (
  SELECT u.id AS user_id, u.location_id, u.has_mk, count(e.id) AS n_events
  FROM users u LEFT JOIN ev e ON e.user_id = u.id GROUP BY u.id, u.location_id, u.has_mk),
elig AS (
  SELECT shift_id, user_id, cand_rank FROM (
    SELECT s.id AS shift_id, a.user_id,
           row_number() OVER (PARTITION BY s.id ORDER BY a.n_events DESC, a.user_id) AS cand_rank
    FROM shifts s JOIN act_e a ON a.location_id = s.location_id
    WHERE NOT COALESCE(s.need_mk, FALSE) OR a.has_mk = TRUE) q
  WHERE cand_rank <= 10)"""


@register("c5_eligible_top", with_(ADAPTER, _ELIGIBLE) + """
SELECT shift_id, user_id, cand_rank FROM elig""")
def c5(d):
    """Same location, certificate when the shift needs it, top 10 by event count."""
    return C.eligible_top(d.shifts, d.users, d.events, 10)


_FALLBACK = """
act_f AS (
  SELECT u.id AS user_id, count(e.id) AS n_events
  FROM users u LEFT JOIN ev e ON e.user_id = u.id GROUP BY u.id),
gtop AS (SELECT user_id, row_number() OVER (ORDER BY n_events DESC, user_id) AS cand_rank FROM act_f),
fb AS (SELECT s.id AS shift_id, g.user_id, g.cand_rank FROM shifts s JOIN gtop g ON g.cand_rank <= 10)"""


@register("c6_fallback_top", with_(ADAPTER, _FALLBACK) + """
SELECT shift_id, user_id, cand_rank FROM fb""")
def c6(d):
    """Global top 10 by event count offered to every shift."""
    return C.fallback_top(d.shifts, d.users, d.events, 10)


@register("c7_candidate_cascade", with_(
    ADAPTER, activity_sql("ev"), candidates_sql("shifts"), _ELIGIBLE, _FALLBACK) + """
SELECT shift_id, user_id, cand_rank, source FROM (
  SELECT shift_id, user_id, cand_rank, 'location_cache' AS source FROM cands
  UNION ALL
  SELECT shift_id, user_id, cand_rank, 'eligible' FROM elig
  WHERE shift_id NOT IN (SELECT shift_id FROM cands)
  UNION ALL
  SELECT shift_id, user_id, cand_rank, 'global' FROM fb
  WHERE shift_id NOT IN (SELECT shift_id FROM cands) AND shift_id NOT IN (SELECT shift_id FROM elig)) q""")
def c7(d):
    """Source cascade: the location cache first, then the eligible store query, then the
    global fallback (every shift is served by the first source that yields candidates)."""
    act = C.user_activity(d.users, d.events)
    return C.candidate_cascade(d.shifts, d.users, d.events, act, limit=300, store_limit=10)
