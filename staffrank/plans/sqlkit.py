"""Oracle-side SQL (DuckDB dialect) for the correctness gate.

The oracle re-derives the domain tables from the raw test tables with the same mapping as
``staffrank.sources.tables`` (independent SQL text, not generated from the Spark plan) and
then states every operator in plain SQL. Outputs use the same canonical encodings as the
Spark side: timestamps and dates as text, doubles rounded to 6 digits, counts as BIGINT.
"""

from __future__ import annotations

ADAPTER = """
users AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id,
         'loc_' || CAST(c_nationkey AS VARCHAR) AS location_id,
         c_mktsegment = 'MACHINERY' AS is_strict_location,
         c_acctbal >= 5000 AS has_mk
  FROM customer),
shifts AS (
  SELECT 's_' || CAST(p_partkey AS VARCHAR) AS id,
         TIMESTAMP '2024-01-05 06:00:00' + to_days(CAST(p_partkey % 25 AS INTEGER))
           + to_hours(CAST(p_partkey % 12 AS INTEGER)) AS start_at,
         'loc_' || CAST(p_partkey % 25 AS VARCHAR) AS location_id,
         p_type AS task_type, p_brand AS employer_id,
         'w_' || CAST(p_partkey % 40 AS VARCHAR) AS workplace_id,
         p_size % 3 = 0 AS need_mk, p_size % 2 = 0 AS id_differential,
         CAST(4 + p_size % 9 AS INTEGER) AS hours, CAST(p_retailprice AS DOUBLE) AS reward,
         CAST(1 + p_partkey % 12 AS INTEGER) AS capacity
  FROM part),
ev_k AS (
  SELECT *, TRY_CAST(regexp_extract(props, '"k":\\s*(\\d+)', 1) AS INTEGER) AS k FROM events),
ev AS (
  SELECT CAST(event_id AS VARCHAR) AS id, 's_' || CAST(k AS VARCHAR) AS shift_id,
         CAST(user_id AS VARCHAR) AS user_id,
         CASE WHEN event_type = 'click' THEN 'APPLY'
              WHEN event_type = 'purchase' THEN 'FINISHED'
              WHEN event_type = 'signup' THEN 'USER_CANCEL'
              WHEN event_type = 'error' AND k % 10 = 0 THEN 'SYSTEM_CANCEL'
              ELSE 'VIEW' END AS interaction,
         CAST(ts AS TIMESTAMP) AS ts
  FROM ev_k)"""

# Derived rows beside all real ones, for cases that the tables lack; ``plans.derived`` is the Spark twin.
ORPHANS = """
ev_o AS (SELECT * FROM ev UNION ALL
  SELECT 'o' || id, 'gone_' || shift_id, user_id, interaction, ts FROM ev WHERE CAST(id AS BIGINT) % 10 = 0)"""
TIMELESS = """
ev_t AS (SELECT * FROM ev UNION ALL
  SELECT 't' || id, shift_id, 't' || user_id, interaction, CAST(NULL AS TIMESTAMP) FROM ev WHERE CAST(id AS BIGINT) % 4 = 0)"""
UNPAID = """
shifts_n AS (SELECT * FROM shifts UNION ALL
  SELECT 'n' || id, start_at, location_id, task_type, employer_id, workplace_id, need_mk, id_differential, hours,
         CAST(NULL AS DOUBLE), capacity FROM shifts),
ev_n AS (SELECT * FROM ev UNION ALL
  SELECT 'n' || id, 'n' || shift_id, 'n' || user_id, interaction, ts FROM ev WHERE CAST(id AS BIGINT) % 4 = 0 UNION ALL
  SELECT 'v' || id, shift_id, 'v' || user_id, interaction, ts FROM ev WHERE interaction <> 'APPLY' AND CAST(id AS BIGINT) % 4 = 1)"""
UNWANTED = """
shifts_w AS (SELECT * FROM shifts UNION ALL
  SELECT 'w' || id, start_at, location_id, task_type, 'w' || employer_id, workplace_id, need_mk, id_differential, hours,
         reward, capacity FROM shifts),
ev_w AS (SELECT * FROM ev UNION ALL
  SELECT 'w' || id, 'w' || shift_id, user_id, interaction, ts FROM ev WHERE interaction <> 'APPLY' AND CAST(id AS BIGINT) % 4 = 0)"""

SPLIT_T = "TIMESTAMP '2024-01-16 00:00:00'"


def split_sql(t: str = SPLIT_T) -> str:
    """CTEs tr_e, tr_s, va_s, va_e, canc, truth for the date split at ``t`` (SQL literal)."""
    return f"""
tr_e AS (SELECT * FROM ev WHERE ts <= {t}),
tr_s AS (SELECT * FROM shifts WHERE start_at <= {t}),
va_s AS (SELECT * FROM shifts WHERE start_at > {t}),
va_e AS (SELECT * FROM ev WHERE ts > {t} AND shift_id IN (SELECT id FROM va_s)),
canc AS (SELECT DISTINCT shift_id FROM ev
         WHERE interaction = 'SYSTEM_CANCEL' AND shift_id IS NOT NULL),
truth AS (
  SELECT DISTINCT e.user_id, e.shift_id, CAST(s.start_at AS DATE) AS date
  FROM ev e JOIN va_s s ON s.id = e.shift_id
  WHERE e.interaction = 'APPLY' AND e.shift_id NOT IN (SELECT shift_id FROM canc)
    AND e.ts <= s.start_at)"""


SPLIT = split_sql()


def activity_sql(events_cte: str, name: str = "act") -> str:
    return f"""
{name} AS (
  SELECT u.id AS user_id, u.location_id, u.is_strict_location, u.has_mk,
         CAST(COALESCE(c.n, 0) AS BIGINT) AS n_events
  FROM users u LEFT JOIN (SELECT user_id, count(*) AS n FROM {events_cte}
                          WHERE user_id IS NOT NULL GROUP BY user_id) c ON c.user_id = u.id)"""


def candidates_sql(shifts_cte: str, act: str = "act", limit: int = 300, min_local: int = 50,
                   extra: int = 500, name: str = "cands") -> str:
    return f"""
{name}_loc AS (
  SELECT location_id, user_id,
         row_number() OVER (PARTITION BY location_id ORDER BY n_events DESC, user_id) AS r
  FROM {act}),
{name}_sizes AS (SELECT location_id, count(*) AS n FROM {act} GROUP BY location_id),
{name}_glob AS (
  SELECT user_id, location_id, row_number() OVER (ORDER BY n_events DESC, user_id) AS g
  FROM {act}),
{name}_small AS (
  SELECT s.id AS shift_id, s.location_id, COALESCE(z.n, 0) AS n
  FROM {shifts_cte} s LEFT JOIN {name}_sizes z ON z.location_id = s.location_id
  WHERE COALESCE(z.n, 0) < {min_local}),
{name}_ext AS (
  SELECT shift_id, user_id, n + x AS cand_rank FROM (
    SELECT sm.shift_id, sm.n, g.user_id,
           row_number() OVER (PARTITION BY sm.shift_id ORDER BY g.g) AS x
    FROM {name}_small sm JOIN {name}_glob g
      ON g.location_id IS NULL OR g.location_id <> sm.location_id) q
  WHERE x <= {extra}),
{name} AS (
  SELECT * FROM (
    SELECT s.id AS shift_id, l.user_id, l.r AS cand_rank
    FROM {shifts_cte} s JOIN {name}_loc l ON l.location_id = s.location_id
    UNION ALL SELECT shift_id, user_id, cand_rank FROM {name}_ext) q
  WHERE cand_rank <= {limit})"""


def metric_sql(frame_cte: str, tie: str | None = None) -> str:
    """CTEs mf2 .. dm computing the regulation metric over ``frame_cte``
    (shift_id, start_at, capacity, target, score)."""
    order = "score DESC" + (f", {tie}" if tie else "")
    tie_col = f", {tie}" if tie else ""
    return f"""
mf2 AS (
  SELECT shift_id, CAST(start_at AS DATE) AS eval_date,
         greatest(1, CAST(capacity AS INTEGER)) AS capacity,
         CAST(target AS INTEGER) AS target, CAST(score AS DOUBLE) AS score{tie_col}
  FROM {frame_cte}
  WHERE start_at IS NOT NULL AND capacity IS NOT NULL AND target IS NOT NULL AND score IS NOT NULL),
mpool AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY eval_date, capacity, shift_id ORDER BY {order}) AS pos
    FROM mf2) q WHERE pos <= least(10, capacity)),
mpool2 AS (
  SELECT * FROM (
    SELECT *, sum(target) OVER (PARTITION BY eval_date, capacity, shift_id) AS pn,
              count(*) OVER (PARTITION BY eval_date, capacity, shift_id) AS n
    FROM mpool) q WHERE pn > 0 AND pn < n),
mpts AS (
  SELECT eval_date, capacity, shift_id, score,
         sum(target) AS tp_d, sum(1 - target) AS fp_d
  FROM mpool2 GROUP BY eval_date, capacity, shift_id, score),
mcum AS (
  SELECT *,
    sum(tp_d) OVER (PARTITION BY eval_date, capacity, shift_id) AS PP,
    sum(fp_d) OVER (PARTITION BY eval_date, capacity, shift_id) AS NN,
    sum(tp_d) OVER (PARTITION BY eval_date, capacity, shift_id ORDER BY score DESC
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
    sum(fp_d) OVER (PARTITION BY eval_date, capacity, shift_id ORDER BY score DESC
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp,
    least(1.0, capacity / 10.0) AS m
  FROM mpts),
mseg AS (
  SELECT *, fp / NN AS x1, tp / PP AS y1, (fp - fp_d) / NN AS x0, (tp - tp_d) / PP AS y0
  FROM mcum),
marea AS (
  SELECT eval_date, capacity, shift_id,
    sum(CASE WHEN x0 >= m THEN 0.0
             ELSE (least(x1, m) - x0) * (y0 + CASE WHEN x1 <= m THEN y1
                                               ELSE y0 + (y1 - y0) * (m - x0) / (x1 - x0) END) / 2.0
        END) AS pauc,
    max(m) AS m
  FROM mseg GROUP BY eval_date, capacity, shift_id),
sm AS (
  SELECT eval_date, capacity, shift_id,
         0.5 * (1 + (pauc - 0.5 * m * m) / (m - 0.5 * m * m)) AS shift_metric
  FROM marea),
gm AS (SELECT eval_date, capacity, avg(shift_metric) AS group_metric FROM sm
       GROUP BY eval_date, capacity),
dm AS (SELECT eval_date, avg(group_metric) AS day_metric, count(*) AS n_groups FROM gm
       GROUP BY eval_date)"""


METRIC_ROW = """
SELECT round(COALESCE((SELECT avg(day_metric) FROM dm), 0.0), 6) AS target_metric,
       CAST((SELECT count(*) FROM dm) AS BIGINT) AS evaluated_days,
       CAST(COALESCE((SELECT sum(n_groups) FROM dm), 0) AS BIGINT) AS evaluated_groups,
       CAST((SELECT count(DISTINCT shift_id) FROM sm) AS BIGINT) AS evaluated_shifts"""


def with_(*parts: str) -> str:
    """Join CTE blocks into one WITH clause."""
    return "WITH " + ",".join(p.strip("\n") for p in parts if p.strip())


def ts_text(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%f')"


def date_text(expr: str) -> str:
    return f"CAST(CAST({expr} AS DATE) AS VARCHAR)"
