"""Registered queries: histories (D1-D11) and pair features."""

from __future__ import annotations

from pyspark.sql import functions as F

from staffrank.operators import candidates as C
from staffrank.operators import features as E
from staffrank.operators import history as D
from staffrank.operators import splits as S
from staffrank.plans.derived import with_timeless, with_unpaid, with_unwanted
from staffrank.plans.flagship import SPLIT_T
from staffrank.plans.registry import register
from staffrank.plans.sqlkit import ADAPTER, SPLIT, TIMELESS, UNPAID, UNWANTED, activity_sql, candidates_sql, with_

# Fixed value: the early cut-off at which the test data has sleepers.
SLEEPER_T = "2024-01-08 00:00:00"


def hist_sql(src: str, suffix: str = "") -> str:
    """CTEs evs{suffix}, uh{suffix}: events joined to shifts, per-user history."""
    return f"""
evs{suffix} AS (
  SELECT e.*, s.employer_id, s.workplace_id, s.reward, s.location_id AS shift_location, s.task_type
  FROM {src} e LEFT JOIN shifts s ON s.id = e.shift_id),
uh{suffix} AS (
  SELECT user_id,
    CAST(count(*) FILTER (WHERE interaction = 'APPLY') AS BIGINT) AS total_applies,
    CAST(count(*) FILTER (WHERE interaction = 'VIEW') AS BIGINT) AS total_views,
    CAST(count(*) FILTER (WHERE interaction = 'FINISHED') AS BIGINT) AS total_finishes,
    CAST(count(*) FILTER (WHERE interaction = 'USER_CANCEL') AS BIGINT) AS total_cancels,
    CAST(count(*) AS BIGINT) AS total_events,
    count(DISTINCT CAST(ts AS DATE)) AS n_days,
    avg(reward) FILTER (WHERE interaction = 'APPLY') AS avg_r
  FROM evs{suffix} WHERE user_id IS NOT NULL GROUP BY user_id),
hist{suffix} AS (
  SELECT user_id, total_applies, total_views, total_finishes, total_cancels, total_events,
    total_applies / greatest(1, total_events) AS apply_rate,
    total_finishes / greatest(1, total_applies) AS finish_rate,
    total_cancels / greatest(1, total_applies) AS cancel_rate,
    CAST(CASE WHEN n_days = 0 THEN 1 ELSE n_days END AS BIGINT) AS active_days,
    CASE WHEN total_applies = 0 THEN 0.0 ELSE avg_r END AS avg_reward
  FROM uh{suffix})"""


def _r(cols: list[str]) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in cols)


@register("d1_user_history", with_(ADAPTER, hist_sql("ev")) + f"""
SELECT user_id, total_applies, total_views, total_finishes, total_cancels, total_events,
  {_r(["apply_rate", "finish_rate", "cancel_rate"])}, active_days, round(avg_reward, 6) AS avg_reward
FROM hist""")
def d1(d):
    return D.user_history(d.events, d.shifts)


@register("d2_active_days", with_(ADAPTER, TIMELESS, hist_sql("ev_t")) + """
SELECT user_id, active_days FROM hist""")
def d2(d):
    """Distinct UTC event dates per user; derived users without any time have 1."""
    return D.user_history(with_timeless(d.events), d.shifts).select("user_id", "active_days")


@register("d3_user_employer", with_(ADAPTER) + """
SELECT DISTINCT e.user_id, s.employer_id FROM ev e JOIN shifts s ON s.id = e.shift_id
WHERE e.interaction = 'APPLY' AND e.user_id IS NOT NULL AND s.employer_id IS NOT NULL""")
def d3(d):
    return D.user_employer(d.events, d.shifts)


@register("d3_user_workplace", with_(ADAPTER) + """
SELECT DISTINCT e.user_id, s.workplace_id FROM ev e JOIN shifts s ON s.id = e.shift_id
WHERE e.interaction = 'APPLY' AND e.user_id IS NOT NULL AND s.workplace_id IS NOT NULL""")
def d3w(d):
    return D.user_workplace(d.events, d.shifts)


@register("d4_avg_reward", with_(ADAPTER, UNPAID, hist_sql("ev_n").replace("LEFT JOIN shifts s", "LEFT JOIN shifts_n s")) + """
SELECT user_id, total_applies, round(avg_reward, 6) AS avg_reward FROM hist""")
def d4(d):
    """Mean reward over applied shifts; derived users who never applied have 0.0, those of shifts with
    unknown rewards only have null."""
    e, s = with_unpaid(d.events, d.shifts)
    return D.user_history(e, s).select("user_id", "total_applies", "avg_reward")


@register("d5_user_location_cnt", with_(ADAPTER) + """
SELECT e.user_id, s.location_id, CAST(count(*) AS BIGINT) AS applies
FROM ev e JOIN shifts s ON s.id = e.shift_id
WHERE e.interaction = 'APPLY' AND e.user_id IS NOT NULL AND s.location_id IS NOT NULL
GROUP BY e.user_id, s.location_id""")
def d5(d):
    return D.user_location_cnt(d.events, d.shifts)


@register("d6_user_task_cnt", with_(ADAPTER) + """
SELECT e.user_id, s.task_type, CAST(count(*) AS BIGINT) AS applies
FROM ev e JOIN shifts s ON s.id = e.shift_id
WHERE e.interaction = 'APPLY' AND e.user_id IS NOT NULL AND s.task_type IS NOT NULL
GROUP BY e.user_id, s.task_type""")
def d6(d):
    return D.user_task_cnt(d.events, d.shifts)


@register("d7_employer_fill", with_(ADAPTER, UNWANTED) + """
SELECT employer_id, applies, events,
       round(CASE WHEN applies = 0 THEN NULL ELSE applies / greatest(1, events) END, 6) AS fill_rate
FROM (SELECT s.employer_id,
        CAST(count(*) FILTER (WHERE e.interaction = 'APPLY') AS BIGINT) AS applies,
        CAST(count(*) AS BIGINT) AS events
      FROM ev_w e JOIN shifts_w s ON s.id = e.shift_id
      WHERE s.employer_id IS NOT NULL GROUP BY s.employer_id) q""")
def d7(d):
    """Employer fill rate; derived employers, seen but without applies, have null."""
    return D.employer_fill(*with_unwanted(d.events, d.shifts))


_PAIR_SQL = """
ph AS (
  SELECT user_id, shift_id,
    CAST(count(*) FILTER (WHERE interaction = 'APPLY') AS BIGINT) AS apply_count,
    CAST(count(*) FILTER (WHERE interaction = 'FINISHED') AS BIGINT) AS finish_count,
    CAST(count(*) FILTER (WHERE interaction = 'USER_CANCEL') AS BIGINT) AS cancel_count,
    max(ts) FILTER (WHERE interaction = 'APPLY') AS last_apply_ts
  FROM {src} WHERE interaction IN ('APPLY', 'FINISHED', 'USER_CANCEL')
    AND user_id IS NOT NULL AND shift_id IS NOT NULL
  GROUP BY user_id, shift_id)"""


@register("d8_pair_history", with_(ADAPTER, _PAIR_SQL.format(src="ev")) + """
SELECT user_id, shift_id, apply_count, finish_count, cancel_count FROM ph""")
def d8(d):
    return D.pair_history(d.events).drop("last_apply_ts")


@register("d9_last_apply", with_(ADAPTER, _PAIR_SQL.format(src="ev")) + """
SELECT user_id, shift_id, strftime(last_apply_ts, '%Y-%m-%d %H:%M:%S.%f') AS last_apply_ts FROM ph
WHERE last_apply_ts IS NOT NULL""")
def d9(d):
    return (D.pair_history(d.events).where(F.col("last_apply_ts").isNotNull())
            .select("user_id", "shift_id", "last_apply_ts"))


@register("d10_sleepers", with_(ADAPTER, hist_sql(
    "(SELECT * FROM ev WHERE ts < TIMESTAMP '2024-01-08 00:00:00')")) + """
SELECT user_id, round(finish_rate, 6) AS finish_rate, total_finishes FROM hist
WHERE total_applies = 0 AND finish_rate > 0""")
def d10(d):
    """Sleepers in the history before 2024-01-08 (the full history has none)."""
    e = d.events.where(F.col("ts") < F.expr(f"timestamp_ntz'{SLEEPER_T}'"))
    return D.sleepers(D.user_history(e, d.shifts))


_PROFILE_SQL = """
prof AS (
  SELECT u.id AS user_id, u.location_id, COALESCE(CAST(u.has_mk AS INTEGER), 0) AS user_has_mk,
    CASE WHEN h.user_id IS NULL THEN 0.0 ELSE h.apply_rate END AS apply_rate,
    CASE WHEN h.user_id IS NULL THEN 0.0 ELSE h.finish_rate END AS finish_rate,
    CASE WHEN h.user_id IS NULL THEN 0.0 ELSE h.cancel_rate END AS cancel_rate,
    CASE WHEN h.user_id IS NULL THEN 0 ELSE h.total_applies END AS total_applies,
    CASE WHEN h.user_id IS NULL THEN 0 ELSE h.total_views END AS total_views,
    CASE WHEN h.user_id IS NULL THEN 0 ELSE h.active_days END AS active_days,
    CASE WHEN h.user_id IS NULL THEN 0.0 ELSE h.avg_reward END AS avg_reward
  FROM users u LEFT JOIN hist h ON h.user_id = u.id)"""


@register("d11_user_profile", with_(ADAPTER, SPLIT, hist_sql("tr_e"), _PROFILE_SQL) + f"""
SELECT user_id, location_id, CAST(user_has_mk AS BIGINT) AS user_has_mk,
  {_r(["apply_rate", "finish_rate", "cancel_rate"])},
  CAST(total_applies AS BIGINT) AS total_applies, CAST(total_views AS BIGINT) AS total_views,
  CAST(active_days AS BIGINT) AS active_days, round(avg_reward, 6) AS avg_reward
FROM prof""")
def d11(d):
    """Scoring profile of every user from the history up to the split time."""
    tr = S.date_split(d.shifts, d.events, SPLIT_T).train_events
    return D.user_profile(d.users, D.user_history(tr, d.shifts))


def feature_sql(pairs: str = "cands", extra: list[str] | None = None) -> str:
    """CTEs building ``feat``: the 26 features for the pair table ``pairs`` (needs evs, prof, ph)."""
    cols = "".join(f"p.{c}, " for c in (extra if extra is not None else ["cand_rank"]))
    return _FEATURE_SQL.replace("{pairs}", pairs).replace("{extra}", cols)


_FEATURE_SQL = """
uloc AS (SELECT user_id, shift_location AS loc, count(*) AS n FROM evs
         WHERE interaction = 'APPLY' AND user_id IS NOT NULL AND shift_location IS NOT NULL GROUP BY ALL),
utask AS (SELECT user_id, task_type, count(*) AS n FROM evs
          WHERE interaction = 'APPLY' AND user_id IS NOT NULL AND task_type IS NOT NULL GROUP BY ALL),
uemp AS (SELECT DISTINCT user_id, employer_id FROM evs
         WHERE interaction = 'APPLY' AND user_id IS NOT NULL AND employer_id IS NOT NULL),
uwp AS (SELECT DISTINCT user_id, workplace_id FROM evs
        WHERE interaction = 'APPLY' AND user_id IS NOT NULL AND workplace_id IS NOT NULL),
emp AS (SELECT employer_id, CASE WHEN a = 0 THEN NULL ELSE a / greatest(1, n) END AS fill FROM (
          SELECT employer_id, count(*) FILTER (WHERE interaction = 'APPLY') AS a, count(*) AS n
          FROM evs WHERE employer_id IS NOT NULL GROUP BY employer_id) q),
feat AS (
  SELECT p.shift_id, p.user_id, {extra}pr.user_id IS NOT NULL AS known_user,
    COALESCE(pr.apply_rate, 0.0) AS user_apply_rate,
    COALESCE(pr.finish_rate, 0.0) AS user_finish_rate,
    COALESCE(pr.cancel_rate, 0.0) AS user_cancel_rate,
    COALESCE(CAST(pr.total_applies AS DOUBLE), 0.0) AS user_total_applies,
    COALESCE(CAST(pr.total_views AS DOUBLE), 0.0) AS user_total_views,
    COALESCE(CAST(pr.active_days AS DOUBLE), 0.0) AS user_active_days,
    COALESCE(CAST(pr.user_has_mk AS DOUBLE), 0.0) AS user_has_mk,
    COALESCE(CAST(ul.n AS DOUBLE), 0.0) AS user_location_applies,
    COALESCE(CAST(ut.n AS DOUBLE), 0.0) AS user_task_type_applies,
    COALESCE(CAST(hour(s.start_at) AS DOUBLE), 12.0) AS shift_hour,
    COALESCE(CAST(isodow(s.start_at) - 1 AS DOUBLE), 0.0) AS shift_dayofweek,
    COALESCE(CAST(s.hours AS DOUBLE), 8.0) AS shift_hours,
    COALESCE(s.reward, 0.0) AS shift_reward,
    COALESCE(CAST(s.capacity AS DOUBLE), 1.0) AS shift_capacity,
    COALESCE(CAST(CAST(s.need_mk AS INTEGER) AS DOUBLE), 0.0) AS shift_need_mk,
    COALESCE(CAST(CAST(s.id_differential AS INTEGER) AS DOUBLE), 0.0) AS shift_id_differential,
    CASE WHEN COALESCE(pr.location_id, '') = COALESCE(s.location_id, '') THEN 1.0 ELSE 0.0 END AS location_match,
    CASE WHEN NOT COALESCE(s.need_mk, FALSE) OR COALESCE(pr.user_has_mk, 0) = 1 THEN 1.0 ELSE 0.0 END AS mk_compatible,
    CASE WHEN ue.user_id IS NULL THEN 0.0 ELSE 1.0 END AS user_worked_with_employer,
    CASE WHEN uw.user_id IS NULL THEN 0.0 ELSE 1.0 END AS user_worked_at_workplace,
    CASE WHEN em.employer_id IS NULL THEN 0.0 ELSE em.fill END AS employer_avg_fill_rate,
    CASE WHEN COALESCE(pr.avg_reward > 0, FALSE)
         THEN COALESCE(s.reward, 0.0) / greatest(1.0, pr.avg_reward) ELSE 1.0 END AS user_reward_vs_avg,
    COALESCE(CAST(ph.apply_count AS DOUBLE), 0.0) AS user_shift_apply_count,
    COALESCE(CAST(ph.finish_count AS DOUBLE), 0.0) AS user_shift_finish_count,
    COALESCE(CAST(ph.cancel_count AS DOUBLE), 0.0) AS user_shift_cancel_count,
    CASE WHEN ph.last_apply_ts IS NOT NULL AND s.start_at IS NOT NULL
         THEN greatest(0.0, (epoch(s.start_at) - epoch(ph.last_apply_ts)) / 86400.0)
         ELSE 9999.0 END AS user_shift_apply_recency_days
  FROM {pairs} p
  LEFT JOIN shifts s ON s.id = p.shift_id
  LEFT JOIN prof pr ON pr.user_id = p.user_id
  LEFT JOIN uloc ul ON ul.user_id = p.user_id AND ul.loc = s.location_id
  LEFT JOIN utask ut ON ut.user_id = p.user_id AND ut.task_type = s.task_type
  LEFT JOIN uemp ue ON ue.user_id = p.user_id AND ue.employer_id = s.employer_id
  LEFT JOIN uwp uw ON uw.user_id = p.user_id AND uw.workplace_id = s.workplace_id
  LEFT JOIN emp em ON em.employer_id = s.employer_id
  LEFT JOIN ph ON ph.user_id = p.user_id AND ph.shift_id = p.shift_id)"""

def feature_blocks(split_block: str = SPLIT) -> tuple:
    """All CTEs up to ``feat`` for the validation candidates of a date split."""
    return (ADAPTER, split_block, hist_sql("tr_e"), _PROFILE_SQL, _PAIR_SQL.format(src="tr_e"),
            activity_sql("tr_e"), candidates_sql("va_s"), feature_sql())


FEATURE_SQL_BLOCKS = feature_blocks()


@register("e1_pair_features", with_(*FEATURE_SQL_BLOCKS) + f"""
SELECT shift_id, user_id, cand_rank, known_user, {_r(E.FEATURES)} FROM feat""")
def e1(d):
    """The 26 features for every candidate (C4, limit 300) of every validation shift, with the
    state built from the history up to the split time."""
    sp = S.date_split(d.shifts, d.events, SPLIT_T)
    state = E.build_state(d.users, d.shifts, sp.train_events)
    act = C.user_activity(d.users, sp.train_events)
    lists = C.location_lists(sp.val_shifts, act).checkpoint()
    cands = C.candidates(sp.val_shifts, act, lists=lists)
    return E.pair_features(cands, d.shifts, state, C.listed_users(lists))
