"""Registered queries: sources, sinks, contract and store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staffrank.functions.expressions import to_bool, to_num, to_utc, to_uuid
from staffrank.operators import contract as B
from staffrank.operators import splits as S
from staffrank.operators import store as ST
from staffrank.plans.flagship import SPLIT_T
from staffrank.plans.q_metric import FLAGSHIP_SQL
from staffrank.plans.registry import register, register_raw
from staffrank.plans.sqlkit import ADAPTER, SPLIT, with_
from staffrank.session import shared_dir
from staffrank.sources import tables as TB


def _as_text(df: DataFrame) -> DataFrame:
    """Every column as text: what a CSV export of the table would carry."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


# --------------------------------------------------------------------------- A1-A4 readers

def _exported(df: DataFrame, name: str) -> str:
    """The table as CSV files, as they come from several hands: a part in contract order, a part with the
    columns in reverse and one more, and copies of some rows as lines with a field too many."""
    path, text, half = _scratch(df.sparkSession, name), _as_text(df), F.crc32(F.col(df.columns[0])) % 2
    text.where(half == 0).write.option("header", True).csv(f"{path}/first")
    text.where(half == 1).select(*reversed(df.columns), F.lit("x").alias("note")).write.option("header", True).csv(f"{path}/second")
    torn = text.where(F.crc32(F.col(df.columns[0])) % 10 == 0).withColumn(df.columns[1], F.concat(F.col(df.columns[1]), F.lit(",torn")))
    torn.write.option("header", True).option("quote", "\0").csv(f"{path}/third")
    return f"{path}/*"


@register("a1_read_users", with_(ADAPTER) + " SELECT id, location_id, is_strict_location, has_mk FROM users")
def a1(d):
    """Users from CSV files with drifting headers and torn lines."""
    return TB.read_checked(d.users.sparkSession, _exported(d.users, "users"), "users").rows


@register("a2_read_shifts", with_(ADAPTER) + """
SELECT id, strftime(start_at, '%Y-%m-%d %H:%M:%S.%f') AS start_at, location_id, task_type,
       employer_id, workplace_id, need_mk, id_differential, CAST(hours AS BIGINT) AS hours,
       round(reward, 6) AS reward, CAST(capacity AS BIGINT) AS capacity FROM shifts""")
def a2(d):
    """Shifts from CSV files with drifting headers and torn lines."""
    return TB.read_checked(d.users.sparkSession, _exported(d.shifts, "shifts"), "shifts").rows


@register("a3_read_events", with_(ADAPTER) + """
SELECT id, shift_id, user_id, interaction, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM ev""")
def a3(d):
    """Events from CSV files with drifting headers and torn lines."""
    return TB.read_checked(d.users.sparkSession, _exported(d.events, "events"), "events").rows


@register("a4_read_apply", with_(ADAPTER, SPLIT) + """
SELECT user_id, shift_id, CAST(date AS VARCHAR) AS date FROM truth""")
def a4(d):
    """Ground truth from CSV files with drifting headers and torn lines."""
    truth = S.ground_truth(d.events, S.date_split(d.shifts, d.events, SPLIT_T).val_shifts)
    return TB.read_checked(d.users.sparkSession, _exported(truth, "apply"), "apply").rows


@register("a3_read_report", with_(ADAPTER) + """
SELECT CAST((SELECT count(*) FROM ev) AS BIGINT) AS rows, TRUE AS some_rejected, TRUE AS all_rejected_torn,
       'moved,note' AS drift""")
def a3r(d):
    """What the reader of events reports: rows, rejected lines and headers that drifted."""
    r = TB.read_checked(d.users.sparkSession, _exported(d.events, "events"), "events")
    n = r.rows.agg(F.count("*").alias("rows"))
    torn = F.col("line").contains(",torn")
    lost = r.rejected.agg((F.count("*") > 0).alias("some_rejected"), (F.count_if(torn) == F.count("*")).alias("all_rejected_torn"))
    drift = r.drift.select(F.concat_ws(",", F.when(F.col("moved"), "moved"), F.array_join("missing", ","), F.array_join("extra", ",")).alias("d"))
    drift = drift.select(F.regexp_replace("d", ",,", ",").alias("d")).agg(F.array_join(F.array_sort(F.collect_set("d")), ";").alias("drift"))
    one = [x.withColumn("k", F.lit(1)) for x in (n, lost, drift)]
    return one[0].join(one[1], "k").join(one[2], "k").drop("k")


def _scratch(spark: SparkSession, name: str) -> str:
    import uuid
    return shared_dir(spark, f"staffrank-{name}-{uuid.uuid4().hex[:8]}")


@register_raw("a5_write_tables", with_(ADAPTER) + """
SELECT 'users' AS table_name, CAST(count(*) AS BIGINT) AS rows FROM users
UNION ALL SELECT 'shifts', CAST(count(*) AS BIGINT) FROM shifts
UNION ALL SELECT 'events', CAST(count(*) AS BIGINT) FROM ev""")
def a5(spark, sf_dir):
    """Persist the three base tables (events partitioned by date), read them back, count."""
    d = TB.testdata_domain(spark, sf_dir)
    base = _scratch(spark, "tables")
    paths = {n: ST.write_table(df, base, n) for n, df in
             (("users", d.users), ("shifts", d.shifts), ("events", d.events))}
    return ST.table_counts(**{n: spark.read.parquet(p) for n, p in paths.items()})


@register_raw("a6_write_split", with_(ADAPTER, SPLIT) + """
SELECT 'train_shifts' AS part, CAST(count(*) AS BIGINT) AS rows FROM tr_s
UNION ALL SELECT 'val_shifts', CAST(count(*) AS BIGINT) FROM va_s
UNION ALL SELECT 'train_events', CAST(count(*) AS BIGINT) FROM tr_e
UNION ALL SELECT 'val_events', CAST(count(*) AS BIGINT) FROM va_e
UNION ALL SELECT 'apply', CAST(count(*) AS BIGINT) FROM truth
UNION ALL SELECT 'users', CAST(count(*) AS BIGINT) FROM users""")
def a6(spark, sf_dir):
    """Write the date split (CSV, as the split script does) and count what was written."""
    d = TB.testdata_domain(spark, sf_dir)
    sp = S.date_split(d.shifts, d.events, SPLIT_T)
    parts = {"train_shifts": sp.train_shifts, "val_shifts": sp.val_shifts,
             "train_events": sp.train_events, "val_events": sp.val_events,
             "apply": S.ground_truth(d.events, sp.val_shifts), "users": d.users}
    base = _scratch(spark, "split")
    ST.write_split(parts, base, fmt="csv")
    out = None
    for name in parts:
        c = (spark.read.option("header", True).csv(f"{base}/{name}")
             .agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("part"), "rows"))
        out = c if out is None else out.unionByName(c)
    return out


@register_raw("a7_write_run", FLAGSHIP_SQL)
def a7(spark, sf_dir):
    """Persist a run record (config, contract checks, metric) and read it back."""
    from staffrank.plans.flagship import activity_metric
    d = TB.testdata_domain(spark, sf_dir)
    checks = B.contract_check(d.events, TB.REQUIRED["events"], "events")
    path = ST.write_run(spark, _scratch(spark, "runs"), "run-activity",
                        config={"split": SPLIT_T, "limit": 300, "top": 10},
                        contract=checks, metric=activity_metric(d))
    return spark.read.json(f"{path}/metric")


# --------------------------------------------------------------------------- B1-B9 contract

def _null_sql(table: str, cols: list[str], src: str) -> str:
    parts = [f"SELECT '{table}' AS table_name, '{c}' AS column_name, "
             f"CAST(count(*) AS BIGINT) AS rows, CAST(count(*) - count({c}) AS BIGINT) AS nulls FROM {src}"
             for c in cols]
    return " UNION ALL ".join(parts)


@register("b1_contract_check", with_(ADAPTER) + " " + " UNION ALL ".join([
    _null_sql("users", TB.REQUIRED["users"], "users"),
    _null_sql("shifts", TB.REQUIRED["shifts"], "shifts"),
    _null_sql("events", TB.REQUIRED["events"], "ev")]))
def b1(d):
    return (B.contract_check(d.users, TB.REQUIRED["users"], "users")
            .unionByName(B.contract_check(d.shifts, TB.REQUIRED["shifts"], "shifts"))
            .unionByName(B.contract_check(d.events, TB.REQUIRED["events"], "events")))


@register("b2_to_bool", with_(ADAPTER) + """,
src AS (SELECT id,
   CASE WHEN ((CAST(floor(c_acctbal) AS BIGINT) % 7) + 7) % 7 = 0 THEN ' Yes ' WHEN ((CAST(floor(c_acctbal) AS BIGINT) % 7) + 7) % 7 = 1 THEN 'NO'
        WHEN ((CAST(floor(c_acctbal) AS BIGINT) % 7) + 7) % 7 = 2 THEN '1' WHEN ((CAST(floor(c_acctbal) AS BIGINT) % 7) + 7) % 7 = 3 THEN '0'
        WHEN ((CAST(floor(c_acctbal) AS BIGINT) % 7) + 7) % 7 = 4 THEN 'TRUE' WHEN ((CAST(floor(c_acctbal) AS BIGINT) % 7) + 7) % 7 = 5 THEN 'false'
        ELSE 'maybe' END AS raw
   FROM users JOIN customer ON CAST(c_custkey AS VARCHAR) = users.id)
SELECT id, raw,
  CASE WHEN lower(trim(raw)) IN ('true', '1', 'yes') THEN TRUE
       WHEN lower(trim(raw)) IN ('false', '0', 'no') THEN FALSE END AS value
FROM src""")
def b2(d):
    """Boolean normalisation over text flags derived from the customer balance."""
    spark = d.users.sparkSession
    c = TB.read_raw(spark, _sf(d), "customer")
    k = F.pmod(F.floor("c_acctbal").cast("bigint"), F.lit(7))
    raw = (F.when(k == 0, " Yes ").when(k == 1, "NO").when(k == 2, "1").when(k == 3, "0")
           .when(k == 4, "TRUE").when(k == 5, "false").otherwise("maybe"))
    src = c.select(F.col("c_custkey").cast("string").alias("id"), raw.alias("raw"))
    return src.select("id", "raw", to_bool("raw").alias("value"))


def _sf(d) -> str:
    return d.sf_dir


@register("b3_to_num", with_(ADAPTER) + """
SELECT id, round(TRY_CAST(txt AS DOUBLE), 6) AS reward_num FROM (
  SELECT id, CASE WHEN CAST(capacity AS BIGINT) % 4 = 0 THEN 'n/a'
                  ELSE CAST(round(reward, 2) AS VARCHAR) END AS txt FROM shifts) q""")
def b3(d):
    """Numeric coercion: rewards as text, every fourth capacity class garbled; bad text -> null."""
    txt = F.when(F.col("capacity") % 4 == 0, F.lit("n/a")).otherwise(
        F.round("reward", 2).cast("string"))
    return d.shifts.select("id", to_num(txt).alias("reward_num"))


@register("b4_to_utc", with_(ADAPTER) + """
SELECT id, strftime(CASE WHEN k % 5 = 0 THEN NULL ELSE ts END, '%Y-%m-%d %H:%M:%S.%f') AS ts_utc FROM (
  SELECT CAST(event_id AS VARCHAR) AS id, CAST(ts AS TIMESTAMP) AS ts,
         TRY_CAST(regexp_extract(props, '"k":\\s*(\\d+)', 1) AS INTEGER) AS k FROM events) q""")
def b4(d):
    """Timestamp coercion: ISO text with a +03:00 offset, 'Z' suffix or none; every fifth k
    garbled. All parse to the same UTC wall clock; garbage -> null."""
    spark = d.users.sparkSession
    e = TB.read_raw(spark, _sf(d), "events")
    k = F.expr("try_cast(get_json_object(props, '$.k') AS INT)")
    local = F.date_format(F.col("ts") + F.expr("INTERVAL 3 HOURS"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    txt = (F.when(k % 5 == 0, F.lit("not a time"))
           .when(k % 3 == 0, F.concat(local, F.lit("+03:00")))
           .when(k % 3 == 1, F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")))
           .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")))
    return e.select(F.col("event_id").cast("string").alias("id"), to_utc(txt).alias("ts_utc"))


@register("b5_valid_interactions", with_(ADAPTER) + """
SELECT upper(x) AS interaction, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT CASE WHEN event_type = 'view' THEN lower(interaction) ELSE interaction END AS x FROM ev
  JOIN (SELECT CAST(event_id AS VARCHAR) AS eid, event_type FROM events) r ON r.eid = ev.id
  UNION ALL SELECT 'bogus' FROM events WHERE event_type = 'error') q
WHERE upper(x) IN ('VIEW', 'APPLY', 'FINISHED', 'USER_CANCEL', 'SYSTEM_CANCEL')
GROUP BY upper(x)""")
def b5(d):
    """Lower-cased spellings are repaired, unknown kinds dropped; counted per kind."""
    spark = d.users.sparkSession
    raw = TB.read_raw(spark, _sf(d), "events").select(F.col("event_id").cast("string").alias("id"),
                                                      "event_type")
    e = d.events.join(raw, "id").select(
        F.when(F.col("event_type") == "view", F.lower("interaction")).otherwise(F.col("interaction"))
        .alias("interaction"))
    bogus = raw.where(F.col("event_type") == "error").select(F.lit("bogus").alias("interaction"))
    return (B.valid_interactions(e.unionByName(bogus))
            .groupBy("interaction").agg(F.count(F.lit(1)).alias("n")))


@register("b6_clean_first_wins", with_(ADAPTER) + """,
rep AS (SELECT CAST(event_id % 7000 AS VARCHAR) AS id, event_id AS seq, shift_id, user_id,
               interaction, ts
        FROM ev JOIN (SELECT event_id, CAST(event_id AS VARCHAR) AS sid FROM events) r ON r.sid = ev.id)
SELECT id, shift_id, user_id, interaction, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq) AS rn FROM rep
  WHERE id IS NOT NULL AND shift_id IS NOT NULL AND user_id IS NOT NULL
    AND interaction IS NOT NULL AND ts IS NOT NULL) q WHERE rn = 1""")
def b6(d):
    """Repeated event ids (event_id % 7000): drop null critical columns, keep the first by
    load order (the raw event id)."""
    e = (d.events.withColumn("seq", F.col("id").cast("bigint"))
         .withColumn("id", (F.col("seq") % 7000).cast("string")))
    return B.clean(e, B.CRITICAL["events"], "id", ["seq"]).drop("seq")


@register("b7_post_clean_counts", with_(ADAPTER) + """
SELECT 'users' AS table_name, CAST(count(*) AS BIGINT) AS rows FROM (
  SELECT DISTINCT id FROM users WHERE id IS NOT NULL AND location_id IS NOT NULL
    AND has_mk IS NOT NULL AND is_strict_location IS NOT NULL) a
UNION ALL SELECT 'shifts', CAST(count(DISTINCT id) AS BIGINT) FROM shifts
  WHERE id IS NOT NULL AND start_at IS NOT NULL AND location_id IS NOT NULL AND need_mk IS NOT NULL
    AND id_differential IS NOT NULL AND hours IS NOT NULL AND reward IS NOT NULL AND capacity IS NOT NULL
UNION ALL SELECT 'events', CAST(count(DISTINCT id) AS BIGINT) FROM ev
  WHERE id IS NOT NULL AND shift_id IS NOT NULL AND user_id IS NOT NULL AND interaction IS NOT NULL
    AND ts IS NOT NULL""")
def b7(d):
    return B.post_clean_counts(
        users=B.clean(d.users, B.CRITICAL["users"], "id", ["id"]),
        shifts=B.clean(d.shifts, B.CRITICAL["shifts"], "id", ["id"]),
        events=B.clean(d.events, B.CRITICAL["events"], "id", ["id"]))


_UUID_SQL = "regexp_full_match(id, '[0-9a-fA-F]{8}-?[0-9a-fA-F]{4}-?[0-9a-fA-F]{4}-?[0-9a-fA-F]{4}-?[0-9a-fA-F]{12}')"


@register("b8_validate_events", with_(ADAPTER) + f"""
SELECT CAST(count(*) AS BIGINT) AS rows,
  CAST(count(*) FILTER (WHERE ok) AS BIGINT) AS accepted,
  CAST(count(*) FILTER (WHERE NOT ok) AS BIGINT) AS rejected,
  CAST(count(*) FILTER (WHERE NOT r1) AS BIGINT) AS id_uuid,
  CAST(count(*) FILTER (WHERE NOT r2) AS BIGINT) AS shift_id_nonempty,
  CAST(count(*) FILTER (WHERE NOT r3) AS BIGINT) AS user_id_nonempty,
  CAST(count(*) FILTER (WHERE NOT r4) AS BIGINT) AS interaction_valid,
  CAST(count(*) FILTER (WHERE NOT r5) AS BIGINT) AS ts_valid
FROM (SELECT *, r1 AND r2 AND r3 AND r4 AND r5 AS ok FROM (
  SELECT COALESCE({_UUID_SQL}, FALSE) AS r1,
         COALESCE(length(shift_id) > 0, FALSE) AS r2, COALESCE(length(user_id) > 0, FALSE) AS r3,
         COALESCE(interaction IN ('VIEW','APPLY','FINISHED','USER_CANCEL','SYSTEM_CANCEL'), FALSE) AS r4,
         ts IS NOT NULL AS r5
  FROM (SELECT CASE WHEN CAST(id AS BIGINT) % 2 = 0 THEN
                 substr(md5(id), 1, 8) || '-' || substr(md5(id), 9, 4) || '-' || substr(md5(id), 13, 4)
                 || '-' || substr(md5(id), 17, 4) || '-' || substr(md5(id), 21, 12)
               ELSE id END AS id, shift_id, user_id, interaction, ts FROM ev) a) b) c""")
def b8(d):
    """Row contract over events whose even ids were re-keyed to UUID text: odd numeric ids fail
    the UUID rule; a per-rule violation report."""
    h = F.md5("id")
    uid = F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                      F.substring(h, 17, 4), F.substring(h, 21, 12))
    e = d.events.withColumn("id", F.when(F.col("id").cast("bigint") % 2 == 0, uid)
                            .otherwise(F.col("id")))
    return B.violation_summary(e, "events")


@register("b8_validate_shifts", with_(ADAPTER) + """
SELECT id, array_to_string(list_sort(list_filter([
    CASE WHEN NOT COALESCE(length(id) > 0, FALSE) THEN 'id_nonempty' END,
    CASE WHEN NOT COALESCE(length(location_id) > 0, FALSE) THEN 'location_id_nonempty' END,
    CASE WHEN NOT COALESCE(length(task_type) > 0, FALSE) THEN 'task_type_nonempty' END,
    CASE WHEN NOT COALESCE(length(employer_id) > 0, FALSE) THEN 'employer_id_nonempty' END,
    CASE WHEN NOT COALESCE(length(workplace_id) > 0, FALSE) THEN 'workplace_id_nonempty' END,
    CASE WHEN start_at IS NULL THEN 'start_at_valid' END,
    CASE WHEN need_mk IS NULL THEN 'need_mk_is_bool' END,
    CASE WHEN id_differential IS NULL THEN 'id_differential_is_bool' END,
    CASE WHEN NOT COALESCE(hours > 0, FALSE) THEN 'hours_positive' END,
    CASE WHEN NOT COALESCE(reward >= 0, FALSE) THEN 'reward_nonnegative' END,
    CASE WHEN NOT COALESCE(capacity > 0, FALSE) THEN 'capacity_positive' END], lambda x: x IS NOT NULL)), ',')
  AS violations
FROM (SELECT id, start_at, location_id, task_type, employer_id, workplace_id, need_mk, id_differential,
        hours - CASE WHEN capacity = 3 THEN hours ELSE 0 END AS hours,
        CASE WHEN capacity = 5 THEN -1.0 ELSE reward END AS reward,
        CASE WHEN capacity = 7 THEN 0 ELSE capacity END AS capacity FROM shifts) s
WHERE len(list_filter([
    NOT COALESCE(hours > 0, FALSE), NOT COALESCE(reward >= 0, FALSE),
    NOT COALESCE(capacity > 0, FALSE)], lambda x: x)) > 0""")
def b8s(d):
    """Rejected rows of a shift batch with broken hours / reward / capacity, rule names listed."""
    s = (d.shifts.withColumn("hours", F.when(F.col("capacity") == 3, F.lit(0)).otherwise(F.col("hours")))
         .withColumn("reward", F.when(F.col("capacity") == 5, F.lit(-1.0)).otherwise(F.col("reward")))
         .withColumn("capacity", F.when(F.col("capacity") == 7, F.lit(0)).otherwise(F.col("capacity"))))
    _, rejected = B.validate(s, "shifts", mode="row")
    return rejected.select("id", F.array_join(F.array_sort("violations"), ",").alias("violations"))


@register("b8_validate_batch", with_(ADAPTER) + """
SELECT 'good' AS batch, CAST(count(*) AS BIGINT) AS rows, CAST(0 AS BIGINT) AS bad_rows, TRUE AS stored,
       CAST(count(*) AS BIGINT) AS rows_in_store, CAST(0 AS BIGINT) AS rows_rejected FROM shifts
UNION ALL SELECT 'bad', count(*), count(*) FILTER (WHERE capacity = 7), FALSE, 0, count(*) FROM shifts""")
def b8b(d):
    """Two uploads of the shifts, all or nothing: one is whole, in the other some capacities are 0."""
    spark = d.users.sparkSession
    target = f"{_scratch(spark, 'batches')}/shifts"
    bad = d.shifts.withColumn("capacity", F.when(F.col("capacity") == 7, F.lit(0)).otherwise(F.col("capacity")))
    told = spark.createDataFrame([B.commit_batch(df, "shifts", target, name) for name, df in (("good", d.shifts), ("bad", bad))],
                                 "batch string, rows long, bad_rows long, stored boolean")
    for path, name in ((target, "rows_in_store"), (f"{target}-rejected", "rows_rejected")):
        told = told.join(spark.read.parquet(path).groupBy("batch").agg(F.count("*").alias(name)), "batch", "left")
    return told.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("rows_in_store", "rows_rejected")})


@register("b9_to_uuid", with_(ADAPTER) + """
SELECT raw_id, substr(v, 1, 8) || '-' || substr(v, 9, 4) || '-' || substr(v, 13, 4) || '-'
       || substr(v, 17, 4) || '-' || substr(v, 21, 12) AS uuid FROM (
  SELECT raw_id, substr(h, 1, 12) || '5' || substr(h, 14, 3)
         || translate(substr(h, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || substr(h, 18, 15) AS v
  FROM (SELECT id AS raw_id, sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode(id)) AS h
        FROM ev) a) b""")
def b9(d):
    """Event ids to UUID text (all numeric, so all name-based v5 in the DNS namespace)."""
    return d.events.select(F.col("id").alias("raw_id"), to_uuid("id").alias("uuid"))


# --------------------------------------------------------------------------- B10-B15 store

@register("b10_upsert_users", with_(ADAPTER) + """,
batch AS (SELECT id, 'loc_moved' AS location_id, NOT is_strict_location AS is_strict_location, has_mk
          FROM users WHERE CAST(id AS BIGINT) % 3 = 0),
allr AS (SELECT *, 0 AS src FROM users UNION ALL SELECT *, 1 FROM batch)
SELECT id, location_id, is_strict_location, has_mk FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY src DESC) AS rn FROM allr) q WHERE rn = 1""")
def b10(d):
    """Every third user moves location and flips the strict flag: last write wins by id."""
    batch = (d.users.where(F.col("id").cast("bigint") % 3 == 0)
             .withColumn("location_id", F.lit("loc_moved"))
             .withColumn("is_strict_location", ~F.col("is_strict_location")))
    return ST.upsert(d.users, batch, "id")


@register("b11_upsert_shifts", with_(ADAPTER) + """,
batch AS (SELECT id, start_at + INTERVAL 1 DAY AS start_at, location_id, task_type, employer_id,
                 workplace_id, need_mk, id_differential, hours, reward * 2 AS reward, capacity
          FROM shifts WHERE capacity % 2 = 0),
allr AS (SELECT *, 0 AS src FROM shifts UNION ALL SELECT *, 1 FROM batch)
SELECT id, strftime(start_at, '%Y-%m-%d %H:%M:%S.%f') AS start_at, location_id, task_type,
  employer_id, workplace_id, need_mk, id_differential, CAST(hours AS BIGINT) AS hours,
  round(reward, 6) AS reward, CAST(capacity AS BIGINT) AS capacity FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY src DESC) AS rn FROM allr) q WHERE rn = 1""")
def b11(d):
    batch = (d.shifts.where(F.col("capacity") % 2 == 0)
             .withColumn("start_at", F.col("start_at") + F.expr("INTERVAL 1 DAY"))
             .withColumn("reward", F.col("reward") * 2))
    return ST.upsert(d.shifts, batch, "id")


@register("b12_upsert_events", with_(ADAPTER) + """,
rep AS (SELECT CAST(CAST(id AS BIGINT) % 7000 AS VARCHAR) AS id, CAST(id AS BIGINT) AS seq, shift_id,
               user_id, interaction, ts FROM ev)
SELECT id, shift_id, user_id, interaction, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS rn FROM rep) q WHERE rn = 1""")
def b12(d):
    """Insert-or-replace by id into an empty store: with repeated ids the last row wins."""
    e = (d.events.withColumn("seq", F.col("id").cast("bigint"))
         .withColumn("id", (F.col("seq") % 7000).cast("string")))
    empty = d.events.limit(0)
    return ST.upsert(empty, e, "id", batch_order=["seq"])


@register("b13_accepted", with_(ADAPTER) + """
SELECT CAST(count(*) AS BIGINT) AS accepted, CAST(count(DISTINCT CAST(id AS BIGINT) % 7000) AS BIGINT) AS stored
FROM ev""")
def b13(d):
    """Accepted count is the batch size, stored rows the distinct keys."""
    e = d.events.withColumn("id", (F.col("id").cast("bigint") % 7000).cast("string"))
    return e.agg(F.count(F.lit(1)).alias("accepted"), F.count_distinct("id").alias("stored"))


@register("b14_table_counts", with_(ADAPTER) + """
SELECT 'user_stat' AS table_name, CAST(count(*) AS BIGINT) AS rows FROM users
UNION ALL SELECT 'shift_stat', CAST(count(*) AS BIGINT) FROM shifts
UNION ALL SELECT 'event_stat', CAST(count(*) AS BIGINT) FROM ev""")
def b14(d):
    return ST.table_counts(user_stat=d.users, shift_stat=d.shifts, event_stat=d.events)


@register("b15_users_by_ids", with_(ADAPTER) + """
SELECT id, location_id, is_strict_location, has_mk FROM users
WHERE id IN (SELECT user_id FROM ev WHERE interaction = 'APPLY')""")
def b15(d):
    """Attributes of every user that applied somewhere."""
    ids = d.events.where(F.col("interaction") == "APPLY").select("user_id")
    return ST.users_by_ids(d.users, ids)
