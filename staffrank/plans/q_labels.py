"""Registered queries: labels, training frames and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from staffrank.operators import features as E
from staffrank.operators import labels as L
from staffrank.operators import splits as S
from staffrank.plans.derived import with_orphans
from staffrank.plans.flagship import SPLIT_T
from staffrank.plans.q_history import _PAIR_SQL, _PROFILE_SQL, _r, feature_sql, hist_sql
from staffrank.plans.registry import register
from staffrank.plans.sqlkit import ADAPTER, ORPHANS, SPLIT, with_

# Fixed value: validation window of the rolling cut-off split used on the test data.
CV_DAYS = 14

LABEL_SQL = """
canc AS (SELECT DISTINCT shift_id FROM ev WHERE interaction = 'SYSTEM_CANCEL' AND shift_id IS NOT NULL),
pos AS (
  SELECT DISTINCT e.user_id, e.shift_id FROM ev e LEFT JOIN shifts s ON s.id = e.shift_id
  WHERE e.interaction = 'APPLY' AND e.shift_id NOT IN (SELECT shift_id FROM canc)
    AND (s.start_at IS NULL OR e.ts IS NULL OR e.ts <= s.start_at)),
negs AS (
  SELECT DISTINCT user_id, shift_id FROM ev WHERE interaction IN ('VIEW', 'USER_CANCEL')
  EXCEPT SELECT user_id, shift_id FROM pos),
capn AS (
  SELECT user_id, shift_id FROM (
    SELECT user_id, shift_id, row_number() OVER (
             ORDER BY md5(concat_ws('|', user_id, shift_id, '42')), user_id, shift_id) AS r
    FROM negs) q
  WHERE r <= (SELECT 5 * count(*) FROM pos)),
lab AS (SELECT user_id, shift_id, 1 AS label FROM pos UNION ALL SELECT user_id, shift_id, 0 FROM capn)"""


@register("f1_cancelled_shifts", with_(ADAPTER, LABEL_SQL) + " SELECT shift_id FROM canc")
def f1(d):
    return L.cancelled_shifts(d.events)


@register("f2_positives", with_(ADAPTER, LABEL_SQL) + " SELECT user_id, shift_id FROM pos")
def f2(d):
    return L.positives(d.events, d.shifts)


@register("f3_negatives", with_(ADAPTER, LABEL_SQL) + " SELECT user_id, shift_id FROM negs")
def f3(d):
    return L.negatives(d.events, L.positives(d.events, d.shifts))


@register("f4_cap_negatives", with_(ADAPTER, LABEL_SQL.replace("5 * count(*)", "count(*) / 2")) + """
SELECT user_id, shift_id FROM capn""")
def f4(d):
    """Seeded negative cap; ratio 0.5 so the cap binds on the test data (5 x would keep all)."""
    pos = L.positives(d.events, d.shifts)
    neg = L.negatives(d.events, pos)
    return L.cap_negatives(neg, pos, ratio=0.5)


@register("f5_training_frame", with_(
    ADAPTER, LABEL_SQL, hist_sql("ev"), _PROFILE_SQL, _PAIR_SQL.format(src="ev"),
    feature_sql("(SELECT l.* FROM lab l WHERE l.shift_id IN (SELECT id FROM shifts))", ["label"])) + f"""
SELECT shift_id, user_id, label, known_user, {_r(E.FEATURES)} FROM feat""")
def f5(d):
    """Labelled pairs (positives + capped negatives) with the 26 features over the full history
    (the reference's leaky form); pairs whose shift is unknown are dropped."""
    lab = L.labelled_pairs(d.events, d.shifts)
    lab = lab.join(d.shifts.select(F.col("id").alias("shift_id")), "shift_id", "left_semi")
    state = E.build_state(d.users, d.shifts, d.events)
    return E.pair_features(lab.select("shift_id", "user_id", "label"), d.shifts, state)


@register("f5_orphan_pairs", with_(ADAPTER, ORPHANS, LABEL_SQL.replace("FROM ev ", "FROM ev_o ")) + """
SELECT CAST(count(*) AS BIGINT) AS orphan_pairs,
       CAST(count(*) FILTER (WHERE label = 1) AS BIGINT) AS orphan_positives
FROM lab WHERE shift_id NOT IN (SELECT id FROM shifts)""")
def f5o(d):
    """Count of labelled pairs dropped for an unknown shift: all events and derived ones of such shifts."""
    lab = L.labelled_pairs(with_orphans(d.events), d.shifts)
    orphan = lab.join(d.shifts.select(F.col("id").alias("shift_id")), "shift_id", "left_anti")
    return orphan.agg(F.count(F.lit(1)).alias("orphan_pairs"),
                      F.count_if(F.col("label") == 1).alias("orphan_positives"))


@register("f6_class_weight", with_(ADAPTER, LABEL_SQL) + """
SELECT round(count(*) FILTER (WHERE label = 0) / greatest(1, count(*) FILTER (WHERE label = 1)), 6)
       AS pos_weight FROM lab""")
def f6(d):
    return L.class_weight(L.labelled_pairs(d.events, d.shifts))


@register("f7_stratified_split", with_(ADAPTER, LABEL_SQL) + """,
keyed AS (SELECT *, md5(concat_ws('|', user_id, shift_id, '42')) AS h,
                 count(*) OVER (PARTITION BY label) AS nl FROM lab)
SELECT user_id, shift_id, CAST(label AS BIGINT) AS label,
       CASE WHEN row_number() OVER (PARTITION BY label ORDER BY h, user_id, shift_id)
                 <= ceil(nl * 0.15) THEN 'test' ELSE 'train' END AS side
FROM keyed""")
def f7(d):
    return L.stratified_split(L.labelled_pairs(d.events, d.shifts), 0.15, 42).select(
        "user_id", "shift_id", "label", "side")


PAIRS_SQL = """
pc AS (
  SELECT e.user_id, e.shift_id, min(e.ts) AS first_ts,
    CAST(count(*) FILTER (WHERE e.interaction = 'VIEW') AS BIGINT) AS n_view,
    CAST(count(*) FILTER (WHERE e.interaction = 'APPLY') AS BIGINT) AS n_apply,
    CAST(count(*) FILTER (WHERE e.interaction = 'FINISHED') AS BIGINT) AS n_finished,
    CAST(count(*) FILTER (WHERE e.interaction = 'USER_CANCEL') AS BIGINT) AS n_user_cancel,
    CAST(count(*) FILTER (WHERE e.interaction = 'SYSTEM_CANCEL') AS BIGINT) AS n_system_cancel
  FROM ev e JOIN shifts s ON s.id = e.shift_id WHERE e.ts <= s.start_at
  GROUP BY e.user_id, e.shift_id),
pct AS (SELECT *, CAST(CASE WHEN n_apply + n_finished > 0 THEN 1 ELSE 0 END AS BIGINT) AS target FROM pc)"""


@register("f8_pair_counts", with_(ADAPTER, PAIRS_SQL) + """
SELECT user_id, shift_id, strftime(first_ts, '%Y-%m-%d %H:%M:%S.%f') AS first_ts, n_view, n_apply,
       n_finished, n_user_cancel, n_system_cancel, target FROM pct""")
def f8(d):
    return L.pair_counts(d.events, d.shifts)


@register("f9_pair_target", with_(ADAPTER, PAIRS_SQL) + """
SELECT target, CAST(count(*) AS BIGINT) AS pairs FROM pct GROUP BY target""")
def f9(d):
    return L.pair_counts(d.events, d.shifts).groupBy("target").agg(F.count(F.lit(1)).alias("pairs"))


@register("f10_user_loo", with_(ADAPTER, PAIRS_SQL) + """
SELECT user_id, shift_id,
  CAST(sum(n_view) OVER (PARTITION BY user_id) - n_view AS BIGINT) AS user_views_loo,
  CAST(sum(n_apply) OVER (PARTITION BY user_id) - n_apply AS BIGINT) AS user_applies_loo,
  CAST(sum(n_finished) OVER (PARTITION BY user_id) - n_finished AS BIGINT) AS user_finished_loo
FROM pct""")
def f10(d):
    return L.user_loo(L.pair_counts(d.events, d.shifts)).select(
        "user_id", "shift_id", "user_views_loo", "user_applies_loo", "user_finished_loo")


@register("f11_pair_attrs", with_(ADAPTER, PAIRS_SQL) + """
SELECT p.user_id, p.shift_id, s.location_id AS shift_location, s.task_type, s.employer_id,
  s.workplace_id, u.location_id AS user_location, u.has_mk, s.need_mk, CAST(s.capacity AS BIGINT) AS capacity,
  CAST(CASE WHEN u.location_id = s.location_id THEN 1 ELSE 0 END AS BIGINT) AS location_match,
  CAST(CASE WHEN s.need_mk = u.has_mk THEN 1 ELSE 0 END AS BIGINT) AS need_mk_match
FROM pct p JOIN shifts s ON s.id = p.shift_id JOIN users u ON u.id = p.user_id""")
def f11(d):
    return L.pair_attrs(L.pair_counts(d.events, d.shifts), d.shifts, d.users).select(
        "user_id", "shift_id", "shift_location", "task_type", "employer_id", "workplace_id",
        "user_location", "has_mk", "need_mk", "capacity", "location_match", "need_mk_match")


@register("f12_finished_affinity", with_(ADAPTER, PAIRS_SQL) + """,
fin AS (SELECT e.user_id, s.employer_id, s.workplace_id FROM ev e JOIN shifts s ON s.id = e.shift_id
        WHERE e.interaction = 'FINISHED' AND e.ts <= s.start_at),
be AS (SELECT user_id, employer_id, count(*) AS n FROM fin GROUP BY ALL),
bw AS (SELECT user_id, workplace_id, count(*) AS n FROM fin GROUP BY ALL)
SELECT p.user_id, p.shift_id, CAST(COALESCE(be.n, 0) AS BIGINT) AS user_employer_finished,
       CAST(COALESCE(bw.n, 0) AS BIGINT) AS user_workplace_finished
FROM pct p LEFT JOIN shifts s ON s.id = p.shift_id
LEFT JOIN be ON be.user_id = p.user_id AND be.employer_id = s.employer_id
LEFT JOIN bw ON bw.user_id = p.user_id AND bw.workplace_id = s.workplace_id""")
def f12(d):
    return L.finished_affinity(L.pair_counts(d.events, d.shifts), d.events, d.shifts).select(
        "user_id", "shift_id", "user_employer_finished", "user_workplace_finished")


@register("f13_unique_time_split", with_(ADAPTER, PAIRS_SQL) + """,
fr AS (SELECT p.user_id, p.shift_id, s.start_at FROM pct p JOIN shifts s ON s.id = p.shift_id),
ut AS (SELECT start_at, row_number() OVER (ORDER BY start_at) - 1 AS i
       FROM (SELECT DISTINCT start_at FROM fr WHERE start_at IS NOT NULL) q),
nb AS (SELECT count(*) AS n FROM ut),
border AS (SELECT start_at AS b FROM ut, nb
           WHERE i = least(greatest(1, CAST(floor(n * 0.8) AS BIGINT)), n - 1))
SELECT user_id, shift_id, CASE WHEN start_at < (SELECT b FROM border) THEN 'train' ELSE 'test' END AS side
FROM fr WHERE start_at IS NOT NULL""")
def f13(d):
    """80/20 split of the pair frame at the sorted unique start times."""
    fr = L.pair_counts(d.events, d.shifts).join(
        d.shifts.select(F.col("id").alias("shift_id"), "start_at"), "shift_id")
    border = S.unique_time_border(fr, 0.2)
    return S.split_side(fr, border).select("user_id", "shift_id", "side")


@register("f14_cutoff_split", with_(ADAPTER) + f"""
SELECT id, CASE WHEN ts < (SELECT max(ts) FROM ev) - INTERVAL {CV_DAYS} DAY THEN 'train'
                WHEN ts >= (SELECT max(ts) FROM ev) - INTERVAL {CV_DAYS} DAY THEN 'val' END AS side
FROM ev""")
def f14(d):
    tr, va, _ = S.cutoff_split(d.events, CV_DAYS)
    return (tr.select("id", F.lit("train").alias("side"))
            .unionByName(va.select("id", F.lit("val").alias("side"))))


@register("f15_date_split", with_(ADAPTER, SPLIT) + """
SELECT 'train_shift' AS part, id FROM tr_s UNION ALL SELECT 'val_shift', id FROM va_s
UNION ALL SELECT 'train_event', id FROM tr_e UNION ALL SELECT 'val_event', id FROM va_e""")
def f15(d):
    sp = S.date_split(d.shifts, d.events, SPLIT_T)
    return (sp.train_shifts.select(F.lit("train_shift").alias("part"), "id")
            .unionByName(sp.val_shifts.select(F.lit("val_shift").alias("part"), "id"))
            .unionByName(sp.train_events.select(F.lit("train_event").alias("part"), "id"))
            .unionByName(sp.val_events.select(F.lit("val_event").alias("part"), "id")))


@register("f16_ground_truth", with_(ADAPTER, SPLIT) + """
SELECT user_id, shift_id, CAST(date AS VARCHAR) AS date FROM truth""")
def f16(d):
    return S.ground_truth(d.events, S.date_split(d.shifts, d.events, SPLIT_T).val_shifts)


@register("f17_cv_truth", with_(ADAPTER) + f""",
va AS (SELECT * FROM ev WHERE ts >= (SELECT max(ts) FROM ev) - INTERVAL {CV_DAYS} DAY),
t AS (SELECT DISTINCT user_id, shift_id FROM va WHERE interaction = 'APPLY')
SELECT user_id, shift_id, CAST(s.id IS NOT NULL AS BIGINT) AS shift_known
FROM t LEFT JOIN shifts s ON s.id = t.shift_id""")
def f17(d):
    _, va, _ = S.cutoff_split(d.events, CV_DAYS)
    truth, vs = S.cv_truth(va, d.shifts)
    return truth.join(vs.select(F.col("id").alias("shift_id"), F.lit(1).alias("shift_known")),
                      "shift_id", "left").select(
        "user_id", "shift_id", F.coalesce(F.col("shift_known"), F.lit(0)).alias("shift_known"))


@register("f18_split_audit", with_(ADAPTER, SPLIT) + """,
rng AS (SELECT min(CAST(start_at AS DATE)) AS dmin, max(CAST(start_at AS DATE)) AS dmax FROM va_s),
fa AS (SELECT user_id, shift_id, min(ts) AS first_ts FROM ev WHERE interaction = 'APPLY' GROUP BY ALL)
SELECT 'date_out_of_range' AS "check", CAST(count(*) AS BIGINT) AS n, count(*) = 0 AS ok
  FROM truth, rng WHERE truth.date < rng.dmin OR truth.date > rng.dmax
UNION ALL SELECT 'date_not_start_date', CAST(count(*) AS BIGINT), count(*) = 0
  FROM truth t LEFT JOIN va_s s ON s.id = t.shift_id
  WHERE s.start_at IS NULL OR t.date <> CAST(s.start_at AS DATE)
UNION ALL SELECT 'late_apply', CAST(count(*) AS BIGINT), count(*) = 0
  FROM truth t LEFT JOIN fa ON fa.user_id = t.user_id AND fa.shift_id = t.shift_id
  LEFT JOIN va_s s ON s.id = t.shift_id WHERE fa.first_ts > s.start_at
UNION ALL SELECT 'train_event_after_split', CAST(count(*) AS BIGINT), count(*) = 0
  FROM tr_e WHERE ts > TIMESTAMP '2024-01-16 00:00:00'
UNION ALL SELECT 'truth_shift_not_in_val', CAST(count(*) AS BIGINT), count(*) = 0
  FROM (SELECT DISTINCT shift_id FROM truth) t WHERE shift_id NOT IN (SELECT id FROM va_s)""")
def f18(d):
    sp = S.date_split(d.shifts, d.events, SPLIT_T)
    truth = S.ground_truth(d.events, sp.val_shifts)
    return S.split_audit(truth, sp.val_shifts, sp.train_events, d.events, SPLIT_T)
