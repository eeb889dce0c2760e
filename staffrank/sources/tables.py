"""Domain schemas, typed readers (A1-A4) and the adapter over the driver's test tables.

Domain tables (all ids are STRING, all times TIMESTAMP_NTZ holding UTC wall-clock time):

* users  (id, location_id, is_strict_location, has_mk)
* shifts (id, start_at, location_id, task_type, employer_id, workplace_id, need_mk,
          id_differential, hours, reward, capacity)
* events (id, shift_id, user_id, interaction, ts)
* apply  (user_id, shift_id, date)
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staffrank.functions.expressions import to_bool, to_date_or_null, to_num, to_utc
from staffrank.session import ensure_utc

USERS_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("location_id", T.StringType()),
    T.StructField("is_strict_location", T.BooleanType()),
    T.StructField("has_mk", T.BooleanType()),
])
SHIFTS_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("start_at", T.TimestampNTZType()),
    T.StructField("location_id", T.StringType()),
    T.StructField("task_type", T.StringType()),
    T.StructField("employer_id", T.StringType()),
    T.StructField("workplace_id", T.StringType()),
    T.StructField("need_mk", T.BooleanType()),
    T.StructField("id_differential", T.BooleanType()),
    T.StructField("hours", T.IntegerType()),
    T.StructField("reward", T.DoubleType()),
    T.StructField("capacity", T.IntegerType()),
])
EVENTS_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("shift_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("interaction", T.StringType()),
    T.StructField("ts", T.TimestampNTZType()),
])
APPLY_SCHEMA = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("shift_id", T.StringType()),
    T.StructField("date", T.DateType()),
])

# Required columns per table (contract).
REQUIRED = {
    "users": ["location_id", "is_strict_location", "id", "has_mk"],
    "shifts": ["id", "start_at", "location_id", "task_type", "employer_id", "workplace_id", "need_mk",
               "id_differential", "hours", "reward", "capacity"],
    "events": ["id", "shift_id", "user_id", "interaction", "ts"],
    "apply": ["user_id", "shift_id", "date"],
}

RAW_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
              "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def read_raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------------------------------------
# Typed readers over text files (CSV) or Parquet: every column arrives as text or native type and
# is coerced with the contract expressions; unparsable values become null.
# ---------------------------------------------------------------------------------------------

BROKEN = "_broken"  #: the text of a line that does not have its file's number of fields


@dataclass(frozen=True)
class Reading:
    """What lies at a path: typed rows, the lines that could not be split into fields (file, line), and
    one row for each file whose header is not the contract's (file, missing, extra, moved)."""
    rows: DataFrame
    rejected: DataFrame
    drift: DataFrame


def _load(spark: SparkSession, path: str, fmt: str | None) -> DataFrame:
    fmt = fmt or ("csv" if path.endswith(".csv") else "parquet")
    if fmt == "csv":
        # no inference: everything as text, coercion below is explicit
        return spark.read.option("header", True).option("inferSchema", False).csv(path)
    return spark.read.format(fmt).load(path)


def csv_headers(spark: SparkSession, path: str, table: str) -> DataFrame:
    """(file, header) of the CSV files at ``path``: the first line of each that names at least half of the
    table's required columns."""
    names = F.transform(F.split("value", ","), lambda c: F.trim(F.translate(c, '"', "")))
    named = F.size(F.array_intersect(names, F.array(*[F.lit(c) for c in REQUIRED[table]])))
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"))
    return (lines.where((F.col("at") == 0) & (2 * named >= len(REQUIRED[table])))
            .groupBy("file").agg(F.first("value").alias("value")).select("file", names.alias("header")))


def read_checked(spark: SparkSession, path: str, table: str) -> Reading:
    """All CSV files below ``path``, each read by its own header.

    Columns are matched by name, so files with moved, missing or extra columns are read together: a missing
    required column is null, extra ones are left out, and the drift is reported.  A line with another
    number of fields than its header is rejected with its text, not guessed.  Files are grouped by their
    header, and headers are few: this list is all that the driver sees besides file names.
    """
    ensure_utc(spark)
    want = REQUIRED[table]
    found = csv_headers(spark, path, table).persist()
    parts, broken = [], []
    for (header,) in found.select("header").distinct().orderBy(F.array_join("header", ",")).collect():
        files = [r.file for r in found.where(F.col("header") == F.array(*[F.lit(c) for c in header])).select("file").collect()]
        schema = ", ".join(f"`{c}` string" for c in header) + f", {BROKEN} string"
        df = (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", BROKEN)
              .option("columnPruning", False)  # else fields that nobody asks for are not counted
              .csv(files))
        some = F.coalesce(*header, F.lit("")) >= ""  # always true; the reader refuses a query of broken lines alone
        whole = df.where(F.col(BROKEN).isNull() & some)
        parts.append(whole.select(*[F.col(c) if c in header else F.lit(None).cast("string").alias(c) for c in want]))
        broken.append(df.where(F.col(BROKEN).isNotNull() & some).select(F.col("_metadata.file_path").alias("file"), F.col(BROKEN).alias("line")))
    lits = F.array(*[F.lit(c) for c in want])
    drift = found.select("file", F.array_except(lits, "header").alias("missing"), F.array_except("header", lits).alias("extra"),
                         (F.array_intersect("header", lits) != F.array_intersect(lits, "header")).alias("moved"))
    drift = drift.where((F.size("missing") > 0) | (F.size("extra") > 0) | F.col("moved"))
    rows, lost = spark.createDataFrame([], ", ".join(f"{c} string" for c in want)), spark.createDataFrame([], "file string, line string")
    for p, q in zip(parts, broken, strict=True):
        rows, lost = rows.unionByName(p), lost.unionByName(q)
    return Reading(COERCE[table](rows), lost, drift)


def _missing(df: DataFrame, table: str) -> None:
    missing = sorted(set(REQUIRED[table]) - set(df.columns))
    if missing:
        raise ValueError(f"{table}: missing required columns {missing}")


def coerce_users(df: DataFrame) -> DataFrame:
    _missing(df, "users")
    return df.select(F.col("id").cast("string").alias("id"),
                     F.col("location_id").cast("string").alias("location_id"),
                     to_bool("is_strict_location").alias("is_strict_location"),
                     to_bool("has_mk").alias("has_mk"))


def coerce_shifts(df: DataFrame) -> DataFrame:
    _missing(df, "shifts")
    return df.select(
        F.col("id").cast("string").alias("id"),
        to_utc("start_at").alias("start_at"),
        *[F.col(c).cast("string").alias(c) for c in ("location_id", "task_type", "employer_id",
                                                     "workplace_id")],
        to_bool("need_mk").alias("need_mk"),
        to_bool("id_differential").alias("id_differential"),
        to_num(F.col("hours").cast("string"), "double").cast("int").alias("hours"),
        to_num(F.col("reward").cast("string"), "double").alias("reward"),
        to_num(F.col("capacity").cast("string"), "double").cast("int").alias("capacity"))


def coerce_events(df: DataFrame) -> DataFrame:
    _missing(df, "events")
    return df.select(*[F.col(c).cast("string").alias(c) for c in ("id", "shift_id", "user_id")],
                     F.upper(F.trim(F.col("interaction").cast("string"))).alias("interaction"),
                     to_utc("ts").alias("ts"))


def coerce_apply(df: DataFrame) -> DataFrame:
    _missing(df, "apply")
    return df.select(F.col("user_id").cast("string").alias("user_id"),
                     F.col("shift_id").cast("string").alias("shift_id"),
                     to_date_or_null(F.col("date").cast("string")).alias("date"))


COERCE = {"users": coerce_users, "shifts": coerce_shifts, "events": coerce_events, "apply": coerce_apply}


def read_users(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """A1"""
    ensure_utc(spark)
    return coerce_users(_load(spark, path, fmt))


def read_shifts(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """A2"""
    ensure_utc(spark)
    return coerce_shifts(_load(spark, path, fmt))


def read_events(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """A3"""
    ensure_utc(spark)
    return coerce_events(_load(spark, path, fmt))


def read_apply(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """A4"""
    ensure_utc(spark)
    return coerce_apply(_load(spark, path, fmt))


# ---------------------------------------------------------------------------------------------
# Adapter: the driver's TPC-H-like tables mapped onto the domain (see FIXTURES.md section 3).
# ---------------------------------------------------------------------------------------------

# Fixed values of the mapping.
SHIFT_EPOCH = "2024-01-05 06:00:00"
EVENT_TYPE_TO_INTERACTION = {"click": "APPLY", "purchase": "FINISHED", "signup": "USER_CANCEL"}


def testdata_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_raw(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").cast("string").alias("id"),
        F.concat(F.lit("loc_"), F.col("c_nationkey").cast("string")).alias("location_id"),
        (F.col("c_mktsegment") == "MACHINERY").alias("is_strict_location"),
        (F.col("c_acctbal") >= 5000).alias("has_mk"))


def testdata_shifts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shifts from every row of ``part``."""
    p = read_raw(spark, sf_dir, "part")
    start = F.expr(f"timestamp_ntz'{SHIFT_EPOCH}' + make_dt_interval("
                   "CAST(p_partkey % 25 AS INT), CAST(p_partkey % 12 AS INT), 0, 0)")
    return p.select(
        F.concat(F.lit("s_"), F.col("p_partkey").cast("string")).alias("id"),
        start.alias("start_at"),
        F.concat(F.lit("loc_"), (F.col("p_partkey") % 25).cast("string")).alias("location_id"),
        F.col("p_type").alias("task_type"),
        F.col("p_brand").alias("employer_id"),
        F.concat(F.lit("w_"), (F.col("p_partkey") % 40).cast("string")).alias("workplace_id"),
        (F.col("p_size") % 3 == 0).alias("need_mk"),
        (F.col("p_size") % 2 == 0).alias("id_differential"),
        (F.lit(4) + F.col("p_size") % 9).cast("int").alias("hours"),
        F.col("p_retailprice").cast("double").alias("reward"),
        (F.lit(1) + F.col("p_partkey") % 12).cast("int").alias("capacity"))


def testdata_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_raw(spark, sf_dir, "events")
    k = F.expr("try_cast(get_json_object(props, '$.k') AS INT)")
    et = F.col("event_type")
    interaction = (F.when(et == "click", "APPLY").when(et == "purchase", "FINISHED")
                   .when(et == "signup", "USER_CANCEL")
                   .when((et == "error") & (k % 10 == 0), "SYSTEM_CANCEL").otherwise("VIEW"))
    return e.select(
        F.col("event_id").cast("string").alias("id"),
        F.concat(F.lit("s_"), k.cast("string")).alias("shift_id"),
        F.col("user_id").cast("string").alias("user_id"),
        interaction.alias("interaction"),
        F.col("ts").cast("timestamp_ntz").alias("ts"))


@dataclass(frozen=True)
class Domain:
    users: DataFrame
    shifts: DataFrame
    events: DataFrame
    sf_dir: str = ""


def testdata_domain(spark: SparkSession, sf_dir: str) -> Domain:
    ensure_utc(spark)
    return Domain(testdata_users(spark, sf_dir), testdata_shifts(spark, sf_dir),
                  testdata_events(spark, sf_dir), sf_dir)
