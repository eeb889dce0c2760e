"""Exact order statistics from value counts, without gathering a group or a value in one task.

Rows are counted first: (group, column, value) -> n, with map-side combination, so a value that
most rows share becomes one row.  The distinct values are split by ranges over the tasks; a running
sum inside each slice plus the slice's offset tells how many rows of the group lie below a value.
Each requested position is then read off the value whose rows cover it, and neighbouring order
statistics are interpolated: ``v[lo] + (v[hi] - v[lo]) * (p * (n - 1) - lo)``, the numpy / DuckDB
``quantile_cont`` rule.  All columns of a frame go through one pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staffrank.session import ensure_checkpoint_dir


def with_running(df: DataFrame, by: list[str], order: list[Column], sums: dict[str, str], total: dict[str, str] | None = None) -> DataFrame:
    """Adds running sums over the rows before the current one, per ``by`` group in ``order``
    (``sums``: new column -> summed column) and group totals (``total``).

    The rows are split by ranges of (by, order), so a large group spans many tasks; the checkpoint in
    the shared folder pins the split.  Offsets of the slices come from one row for each slice and group.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    total = total or {}
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.repartitionByRange(n, *by, *order).withColumn("_slice", F.spark_partition_id()).checkpoint()
    slices = rows.groupBy("_slice", *by).agg(
        *[F.sum(c).alias(f"_sum_{out}") for out, c in (sums | total).items()])
    before = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.select(F.col("_slice").alias("_of_slice"), *[F.col(c).alias(f"_by_{c}") for c in by],
                            *[F.coalesce(F.sum(f"_sum_{out}").over(before), F.lit(0)).alias(f"_off_{out}") for out in sums],
                            *[F.sum(f"_sum_{out}").over(Window.partitionBy(*by)).alias(out) for out in total])
    inside = Window.partitionBy("_slice", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    told = rows.join(offsets, [F.col("_slice") == F.col("_of_slice"), *[F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by]])
    return told.select(*df.columns, *[(F.col(f"_off_{out}") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(out)
                                      for out, c in sums.items()], *total)


def value_table(df: DataFrame, cols: list[str], by: list[str]) -> DataFrame:
    """(by, _col, _v, _n, _below, _of): how often each value occurs, how many smaller ones its group
    has and how many in all.  Nulls are left out."""
    long = F.explode(F.array(*[F.struct(F.lit(c).alias("_col"), F.col(c).cast("double").alias("_v")) for c in cols]))
    counts = (df.select(*by, long.alias("_x")).select(*by, "_x.*").where("_v IS NOT NULL")
              .groupBy(*by, "_col", "_v").agg(F.count("*").alias("_n")))
    return with_running(counts, [*by, "_col"], [F.col("_v")], {"_below": "_n"}, {"_of": "_n"})


def pick(values: DataFrame, pcts: list[float], by: list[str], names: list[str]) -> DataFrame:
    """One row for each ``by`` group and column of a value table, a column for each percentile."""
    at, low, high = [], [], []
    for i, p in enumerate(pcts):
        x = F.lit(float(p)) * (F.col("_of") - 1)
        at.append((x - F.floor(x)).alias(f"_f{i}"))
        for side, rank in ((low, F.floor(x)), (high, F.ceil(x))):
            here = (F.col("_below") <= rank) & (rank < F.col("_below") + F.col("_n"))
            side.append(F.max(F.when(here, F.col("_v"))).alias(f"_{'lo' if side is low else 'hi'}{i}"))
    found = values.groupBy(*by, "_col").agg(*low, *high, *[F.max(f).alias(f"_f{i}") for i, f in enumerate(at)])
    return found.select(*by, "_col", *[
        (F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_f{i}")).alias(n) for i, n in enumerate(names)])


def exact_percentiles(df: DataFrame, col: str, pcts: list[float], by: list[str] | None = None,
                      names: list[str] | None = None) -> DataFrame:
    """One row per ``by`` group (one row overall without ``by``) with a column per percentile
    (named ``names`` or ``p<100*p>``); groups without values are absent."""
    by = by or []
    names = names or [f"p{int(round(p * 100)):02d}" for p in pcts]
    return pick(value_table(df, [col], by), pcts, by, names).drop("_col")


def exact_medians(df: DataFrame, cols: dict[str, str], by: list[str]) -> DataFrame:
    """Medians of several columns (``cols``: column -> output name) per group, in one pass."""
    found = pick(value_table(df, list(cols), by), [0.5], by, ["_q"])
    return found.groupBy(*by).agg(*[F.max(F.when(F.col("_col") == c, F.col("_q"))).alias(n) for c, n in cols.items()])


def describe(df: DataFrame, cols: list[str], pcts: list[float], names: list[str]) -> DataFrame:
    """count, mean, sample standard deviation, min, percentiles and max of each column.

    All come from the one value table, so the frame is built once; a column without values keeps its
    row.
    """
    values = value_table(df, cols, [])
    n, v = F.col("_n"), F.col("_v")
    sums = values.groupBy("_col").agg(F.sum(n).alias("count"), (F.sum(v * n) / F.sum(n)).alias("mean"),
                                      F.min(v).alias("min"), F.max(v).alias("max"))
    spread = values.join(F.broadcast(sums), "_col").groupBy("_col").agg(  # one row for each column
        F.sqrt(F.sum(n * (v - F.col("mean")) * (v - F.col("mean"))) / F.nullif(F.sum(n) - 1, F.lit(0))).alias("std"))
    all_cols = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in cols])).alias("_col"))
    told = all_cols.join(sums, "_col", "left").join(spread, "_col", "left").join(pick(values, pcts, [], names), "_col", "left")
    return told.select(F.col("_col").alias("column_name"), F.coalesce("count", F.lit(0)).alias("count"), "mean", "std", "min",
                       *names, "max")
