"""Contract checks, cleaning and row validation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staffrank.functions.expressions import INTERACTIONS, to_uuid

UUID_RE = "^[0-9a-fA-F]{8}-?[0-9a-fA-F]{4}-?[0-9a-fA-F]{4}-?[0-9a-fA-F]{4}-?[0-9a-fA-F]{12}$"

# Columns that must be set for a row to survive cleaning.
CRITICAL = {
    "users": ["id", "location_id", "has_mk", "is_strict_location"],
    "shifts": ["id", "start_at", "location_id", "need_mk", "id_differential", "hours", "reward",
               "capacity"],
    "events": ["id", "shift_id", "user_id", "interaction", "ts"],
}


def contract_check(df: DataFrame, required: list[str], table: str = "table") -> DataFrame:
    """B1: error naming missing columns; else one row per required column with the table's row
    count and that column's null count (a single aggregate pass, then unpivot)."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"{table}: missing required columns: {missing}")
    aggs = [F.count(F.lit(1)).alias("__rows")] + [
        F.count_if(F.col(c).isNull()).alias(f"n_{i}") for i, c in enumerate(required)]
    one = df.agg(*aggs)
    stack = ", ".join(f"'{c}', n_{i}" for i, c in enumerate(required))
    return one.selectExpr(f"'{table}' AS table_name", "__rows AS rows",
                          f"stack({len(required)}, {stack}) AS (column_name, nulls)").select(
        "table_name", "column_name", F.col("rows").cast("bigint").alias("rows"),
        F.col("nulls").cast("bigint").alias("nulls"))


def valid_interactions(events: DataFrame) -> DataFrame:
    """Upper-case ``interaction`` and keep the five valid values."""
    e = events.withColumn("interaction", F.upper(F.col("interaction")))
    return e.where(F.col("interaction").isin(INTERACTIONS))


def clean(df: DataFrame, critical: list[str], key: str = "id", order_cols: list[str] | None = None
          ) -> DataFrame:
    """Drop rows with a null critical column, then keep the first row per ``key``.

    "First" is the input order given by ``order_cols`` (e.g. a load sequence); without it the
    file order captured by ``monotonically_increasing_id`` right after the scan is used. The
    choice is a partially aggregated ``min`` per key (skew-safe), not a per-key window sort.
    """
    from staffrank.operators.store import pick_per_key
    d = df.dropna(subset=critical)
    tmp = None
    if not order_cols:
        tmp = "__seq"
        d = d.withColumn(tmp, F.monotonically_increasing_id())
        order_cols = [tmp]
    out = pick_per_key(d, [key], order_cols, newest=False).select(*d.columns)
    return out.drop(tmp) if tmp else out


def post_clean_counts(**tables: DataFrame) -> DataFrame:
    """(table_name, rows) for every given table."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _nonempty(c: str):
    return F.col(c).isNotNull() & (F.length(F.col(c)) > 0)


def rules(table: str) -> dict:
    """Row rules of the contract; each maps a rule name to a boolean 'ok' column."""
    if table == "users":
        return {"id_nonempty": _nonempty("id"), "location_nonempty": _nonempty("location_id"),
                "strict_is_bool": F.col("is_strict_location").isNotNull(),
                "has_mk_is_bool": F.col("has_mk").isNotNull()}
    if table == "shifts":
        r = {f"{c}_nonempty": _nonempty(c) for c in
             ("id", "location_id", "task_type", "employer_id", "workplace_id")}
        r.update({"start_at_valid": F.col("start_at").isNotNull(),
                  "need_mk_is_bool": F.col("need_mk").isNotNull(),
                  "id_differential_is_bool": F.col("id_differential").isNotNull(),
                  "hours_positive": F.coalesce(F.col("hours") > 0, F.lit(False)),
                  "reward_nonnegative": F.coalesce(F.col("reward") >= 0, F.lit(False)),
                  "capacity_positive": F.coalesce(F.col("capacity") > 0, F.lit(False))})
        return r
    if table == "events":
        return {"id_uuid": F.coalesce(F.col("id").rlike(UUID_RE), F.lit(False)),
                "shift_id_nonempty": _nonempty("shift_id"),
                "user_id_nonempty": _nonempty("user_id"),
                "interaction_valid": F.coalesce(F.col("interaction").isin(INTERACTIONS), F.lit(False)),
                "ts_valid": F.col("ts").isNotNull()}
    raise ValueError(f"unknown table {table}")


def with_violations(df: DataFrame, table: str) -> DataFrame:
    """Adds ``violations``: array of the names of the rules the row breaks (empty when valid)."""
    rs = rules(table)
    arr = F.array_compact(F.array(*[F.when(~ok, F.lit(name)) for name, ok in rs.items()]))
    return df.withColumn("violations", arr)


def validate(df: DataFrame, table: str, mode: str = "row") -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected). ``mode='row'`` rejects failing rows; ``mode='batch'`` rejects
    the whole batch when any row fails (the service's all-or-nothing upload)."""
    v = with_violations(df, table)
    bad = F.size("violations") > 0
    if mode == "row":
        return v.where(~bad).drop("violations"), v.where(bad)
    if mode != "batch":
        raise ValueError("mode must be 'row' or 'batch'")
    if v.where(bad).isEmpty():
        return v.drop("violations"), v.limit(0)
    return v.limit(0).drop("violations"), v


def commit_batch(df: DataFrame, table: str, target: str, batch: str) -> dict:
    """B8 in batch mode: the rows of a batch are stored all together or not at all.

    The batch is evaluated once, into a staged folder that no reader of ``target`` sees; then the folder
    is renamed, which is one step on a shared file system: to ``target/batch=<batch>`` if no row breaks
    a rule, else to ``target-rejected/batch=<batch>``, where the rows keep the names of the broken rules.
    A repeated batch replaces itself.  Returns the number of rows, of bad rows and whether it was stored."""
    spark = df.sparkSession
    path, fs = _file_system(spark, target)
    staged = f"{target}/_staged-{batch}"
    with_violations(df, table).write.mode("overwrite").parquet(staged)
    n, bad = spark.read.parquet(staged).agg(F.count("*"), F.count_if(F.size("violations") > 0)).first()
    end = f"{target}/batch={batch}" if not bad else f"{target}-rejected/batch={batch}"
    for old in (f"{target}/batch={batch}", f"{target}-rejected/batch={batch}"):
        fs.delete(path(old), True)
    fs.mkdirs(path(end).getParent())
    if not fs.rename(path(staged), path(end)):
        raise OSError(f"could not rename {staged} to {end}")
    return {"batch": batch, "rows": n, "bad_rows": bad, "stored": not bad}


def _file_system(spark, where: str):
    """Hadoop's path class and the file system of a folder."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return path, path(where).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def violation_summary(df: DataFrame, table: str) -> DataFrame:
    """B8 report: rows, accepted, rejected and one count per rule (one aggregate pass)."""
    rs = rules(table)
    v = with_violations(df, table)
    aggs = [F.count(F.lit(1)).alias("rows"), F.count_if(F.size("violations") == 0).alias("accepted"),
            F.count_if(F.size("violations") > 0).alias("rejected")]
    aggs += [F.count_if(~ok).alias(name) for name, ok in rs.items()]
    return v.agg(*aggs)
