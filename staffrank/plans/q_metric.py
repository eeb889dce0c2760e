"""Registered queries: evaluation (I1-I8, I10). The flagship is ``i5_target_metric``."""

from __future__ import annotations

from pyspark.sql import functions as F

from staffrank.operators import backtest as BT
from staffrank.operators import metric as M
from staffrank.operators import splits as S
from staffrank.plans.flagship import SPLIT_T, activity_frame
from staffrank.plans.registry import register
from staffrank.plans.sqlkit import (ADAPTER, METRIC_ROW, SPLIT, activity_sql, candidates_sql,
                                   metric_sql, with_)

FRAME_SQL = """,
top AS (SELECT shift_id, user_id, cand_rank AS rank FROM cands WHERE cand_rank <= 10),
scored AS (SELECT *, 1.0 - (rank - 1) / greatest(1, count(*) OVER (PARTITION BY shift_id)) AS score FROM top),
mf AS (
  SELECT t.shift_id, t.user_id, t.rank, t.score, s.start_at, s.capacity,
         CASE WHEN tr.user_id IS NULL THEN 0 ELSE 1 END AS target
  FROM scored t LEFT JOIN va_s s ON s.id = t.shift_id
  LEFT JOIN truth tr ON tr.shift_id = t.shift_id AND tr.user_id = t.user_id
                     AND tr.date = CAST(s.start_at AS DATE))"""

FLAGSHIP_BLOCKS = (ADAPTER, SPLIT, activity_sql("tr_e"), candidates_sql("va_s"))
FLAGSHIP_SQL = with_(*FLAGSHIP_BLOCKS) + FRAME_SQL + "," + metric_sql("mf").strip("\n") + METRIC_ROW


@register("i1_label", with_(*FLAGSHIP_BLOCKS) + FRAME_SQL + """
SELECT shift_id, user_id, CAST(rank AS BIGINT) AS rank, round(score, 6) AS score,
       strftime(start_at, '%Y-%m-%d %H:%M:%S.%f') AS start_at, CAST(capacity AS BIGINT) AS capacity,
       CAST(target AS BIGINT) AS target FROM mf""")
def i1(d):
    return activity_frame(d)


@register("i2_metric_frame", with_(*FLAGSHIP_BLOCKS) + FRAME_SQL + "," + metric_sql("mf").strip("\n") + """
SELECT shift_id, CAST(eval_date AS VARCHAR) AS eval_date, CAST(capacity AS BIGINT) AS capacity,
       CAST(target AS BIGINT) AS target, round(score, 6) AS score FROM mf2""")
def i2(d):
    return M.metric_frame(activity_frame(d)).select("shift_id", "eval_date", "capacity", "target",
                                                    "score")


@register("i3_metric_pool", with_(*FLAGSHIP_BLOCKS) + FRAME_SQL + "," + metric_sql("mf").strip("\n") + """
SELECT shift_id, CAST(eval_date AS VARCHAR) AS eval_date, CAST(capacity AS BIGINT) AS capacity,
       CAST(target AS BIGINT) AS target, round(score, 6) AS score, CAST(pos AS BIGINT) AS pos
FROM mpool2""")
def i3(d):
    return M.metric_pool(M.metric_frame(activity_frame(d))).select(
        "shift_id", "eval_date", "capacity", "target", "score", "pos")


@register("i4_partial_auc", with_(*FLAGSHIP_BLOCKS) + FRAME_SQL + "," + metric_sql("mf").strip("\n") + """
SELECT shift_id, CAST(eval_date AS VARCHAR) AS eval_date, CAST(capacity AS BIGINT) AS capacity,
       round(shift_metric, 6) AS shift_metric FROM sm""")
def i4(d):
    return M.shift_metrics(activity_frame(d))


@register("i5_target_metric", FLAGSHIP_SQL)
def i5(d):
    """Flagship: activity-ranked top-10 per validation shift, scored with the regulation metric."""
    return M.target_metric(activity_frame(d))


@register("i5_group_metrics", with_(*FLAGSHIP_BLOCKS) + FRAME_SQL + "," + metric_sql("mf").strip("\n") + """
SELECT CAST(eval_date AS VARCHAR) AS eval_date, CAST(capacity AS BIGINT) AS capacity,
       round(group_metric, 6) AS group_metric FROM gm""")
def i5g(d):
    return M.group_metrics(M.shift_metrics(activity_frame(d)))


@register("i5_day_metrics", with_(*FLAGSHIP_BLOCKS) + FRAME_SQL + "," + metric_sql("mf").strip("\n") + """
SELECT CAST(eval_date AS VARCHAR) AS eval_date, round(day_metric, 6) AS day_metric,
       CAST(n_groups AS BIGINT) AS n_groups FROM dm""")
def i5d(d):
    return M.day_metrics(M.group_metrics(M.shift_metrics(activity_frame(d))))


# ------------------------------------------------------------------ I8 / I6 daily backtest

BACKTEST_SQL = with_(ADAPTER, SPLIT) + """,
days AS (SELECT DISTINCT date AS d FROM truth),
tr_cnt AS (SELECT user_id, count(*) AS n FROM tr_e WHERE user_id IS NOT NULL GROUP BY user_id),
dc AS (SELECT user_id, CAST(ts AS DATE) AS d, count(*) AS n FROM va_e
       WHERE user_id IS NOT NULL AND CAST(ts AS DATE) IN (SELECT d FROM days) GROUP BY ALL),
prior_days AS (SELECT d2.d AS day, dc.user_id, sum(dc.n) AS n FROM days d2 JOIN dc ON dc.d < d2.d
           GROUP BY ALL),
as_of_counts AS (
  SELECT days.d AS day, u.id AS user_id, u.location_id,
         COALESCE(t.n, 0) + COALESCE(b.n, 0) AS n_events
  FROM days CROSS JOIN users u LEFT JOIN tr_cnt t ON t.user_id = u.id
  LEFT JOIN prior_days b ON b.day = days.d AND b.user_id = u.id),
dsh AS (SELECT s.*, CAST(s.start_at AS DATE) AS day FROM va_s s
        WHERE CAST(s.start_at AS DATE) IN (SELECT d FROM days)),
loc AS (SELECT day, location_id, user_id,
          row_number() OVER (PARTITION BY day, location_id ORDER BY n_events DESC, user_id) AS r FROM as_of_counts),
sizes AS (SELECT day, location_id, count(*) AS n FROM as_of_counts GROUP BY ALL),
gtop_d AS (SELECT day, user_id, location_id,
           row_number() OVER (PARTITION BY day ORDER BY n_events DESC, user_id) AS g FROM as_of_counts),
small AS (SELECT s.day, s.id AS shift_id, s.location_id, COALESCE(z.n, 0) AS n FROM dsh s
          LEFT JOIN sizes z ON z.day = s.day AND z.location_id = s.location_id WHERE COALESCE(z.n, 0) < 50),
ext AS (SELECT shift_id, user_id, n + x AS cand_rank FROM (
          SELECT sm.shift_id, sm.n, g.user_id,
                 row_number() OVER (PARTITION BY sm.shift_id ORDER BY g.g) AS x
          FROM small sm JOIN gtop_d g ON g.day = sm.day
            AND (g.location_id IS NULL OR g.location_id <> sm.location_id)) q WHERE x <= 500),
cands AS (SELECT * FROM (
    SELECT s.id AS shift_id, l.user_id, l.r AS cand_rank FROM dsh s
    JOIN loc l ON l.day = s.day AND l.location_id = s.location_id
    UNION ALL SELECT * FROM ext) q WHERE cand_rank <= 300)""" + FRAME_SQL + "," + \
    metric_sql("mf").strip("\n") + """,
drows AS (
  SELECT CAST(days.d AS VARCHAR) AS eval_date, round(COALESCE(dm.day_metric, 0.0), 6) AS target_metric,
         CAST(COALESCE(dm.n_groups, 0) AS BIGINT) AS evaluated_groups,
         CAST((SELECT count(DISTINCT shift_id) FROM sm WHERE sm.eval_date = days.d) AS BIGINT) AS evaluated_shifts
  FROM days LEFT JOIN dm ON dm.eval_date = days.d)"""


@register("i8_backtest", BACKTEST_SQL + """
SELECT eval_date, target_metric, evaluated_groups, evaluated_shifts FROM drows""")
def i8(d):
    """Daily activity backtest: each truth day scored from the state known before it (training
    events plus the earlier evaluated days), as one plan with day-wise as-of counts."""
    return BT.activity_backtest_asof(d.users, d.shifts, d.events, SPLIT_T)


@register("i8_backtest_day_loop", BACKTEST_SQL + """
SELECT eval_date, target_metric, evaluated_groups, evaluated_shifts FROM drows""")
def i8l(d):
    """The same backtest as a loop of independent per-day jobs over checkpointed inputs (the
    form a model-based backtest uses, where each day re-trains)."""
    return BT.activity_backtest(d.users, d.shifts, d.events, SPLIT_T)


@register("i6_backtest_overall", BACKTEST_SQL + """
SELECT round(COALESCE(avg(target_metric), 0.0), 6) AS overall_metric,
       CAST(count(*) AS BIGINT) AS reported_days,
       CAST(count(*) FILTER (WHERE evaluated_groups > 0) AS BIGINT) AS evaluable_days
FROM (SELECT eval_date, COALESCE(dm.day_metric, 0.0) AS target_metric,
             COALESCE(dm.n_groups, 0) AS evaluated_groups
      FROM days LEFT JOIN dm ON dm.eval_date = days.d) q""")
def i6(d):
    """Backtest overall: mean of day metrics where an unevaluable day counts as 0."""
    return BT.backtest_overall(BT.activity_backtest_asof(d.users, d.shifts, d.events, SPLIT_T))


@register("i7_day_slices", with_(ADAPTER, SPLIT) + """,
days AS (SELECT DISTINCT CAST(start_at AS DATE) AS d FROM va_s)
SELECT CAST(d AS VARCHAR) AS day,
  CAST((SELECT count(*) FROM va_s WHERE CAST(start_at AS DATE) = d) AS BIGINT) AS n_shifts,
  CAST((SELECT count(*) FROM truth WHERE date = d) AS BIGINT) AS n_truth,
  CAST((SELECT count(*) FROM va_e WHERE CAST(ts AS DATE) = d) AS BIGINT) AS n_events
FROM days""")
def i7(d):
    """Per validation day: shifts by start date, truth pairs by date, events by ts date."""
    sp = S.date_split(d.shifts, d.events, SPLIT_T)
    truth = S.ground_truth(d.events, sp.val_shifts)
    sh = sp.val_shifts.groupBy(F.to_date("start_at").alias("day")).agg(
        F.count(F.lit(1)).alias("n_shifts"))
    tr = truth.groupBy(F.col("date").alias("day")).agg(F.count(F.lit(1)).alias("n_truth"))
    ev = sp.val_events.groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n_events"))
    out = sh.join(tr, "day", "left").join(ev, "day", "left")
    return out.select("day", "n_shifts", F.coalesce("n_truth", F.lit(0)).alias("n_truth"),
                      F.coalesce("n_events", F.lit(0)).alias("n_events"))


# ------------------------------------------------------------------ I10 latency roll-up

def request_log(d):
    """A request log derived from the raw event stream: one call per event, latency from the
    event value (ms), status 500 for error events, else 200."""
    raw = d.users.sparkSession.read.parquet(f"{d.sf_dir.rstrip('/')}/events.parquet")
    return raw.select(F.col("event_id").cast("string").alias("request_id"),
                      F.to_date("ts").alias("day"), F.col("ts").alias("started_at"),
                      F.col("value").cast("double").alias("latency_ms"),
                      F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status_code"))


LOG_SQL = """
log AS (SELECT CAST(event_id AS VARCHAR) AS request_id, CAST(ts AS DATE) AS day, ts AS started_at,
               CAST(value AS DOUBLE) AS latency_ms,
               CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status_code FROM events)"""


@register("i10_latency_summary", with_(LOG_SQL) + """
SELECT CAST(day AS VARCHAR) AS day,
  round(COALESCE(quantile_cont(latency_ms, 0.5) FILTER (WHERE status_code = 200), 0.0), 6) AS p50_ms,
  round(COALESCE(quantile_cont(latency_ms, 0.8) FILTER (WHERE status_code = 200), 0.0), 6) AS p80_ms,
  round(COALESCE(quantile_cont(latency_ms, 0.95) FILTER (WHERE status_code = 200), 0.0), 6) AS p95_ms,
  CAST(count(*) AS BIGINT) AS calls,
  CAST(count(*) FILTER (WHERE status_code = 200) AS BIGINT) AS ok_calls,
  CAST(count(*) FILTER (WHERE status_code <> 200 OR status_code IS NULL) AS BIGINT) AS failed_calls,
  round(CASE WHEN epoch(max(started_at)) - epoch(min(started_at)) > 0
             THEN count(*) * 60.0 / (epoch(max(started_at)) - epoch(min(started_at)))
             ELSE CAST(count(*) AS DOUBLE) END, 6) AS calls_per_min
FROM log GROUP BY day""")
def i10(d):
    """Per-day latency percentiles (exact, interpolated), call rate and ok / failed counts."""
    return M.latency_summary(request_log(d), by=["day"])
