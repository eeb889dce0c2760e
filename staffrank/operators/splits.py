"""Time splits and ground truth.

Split borders are scalars (one aggregate each); the frames themselves are only filtered, so a
split never moves data through the driver.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staffrank.operators.labels import cancelled_shifts


def unique_time_border(frame: DataFrame, test_ratio: float = 0.2, col: str = "start_at"):
    """F13 border: the sorted distinct start times, index max(1, floor(n(1-r))) capped at n-1.

    The idx-th distinct time is found without a global window: distinct times are counted per
    hour bucket (one aggregate, one row per hour), a running sum over those buckets locates the
    hour holding position idx, and only that hour's distinct times are ranked.
    """
    times = frame.where(F.col(col).isNotNull()).select(col).distinct()
    hour = F.floor(F.unix_micros(F.col(col).cast("timestamp")) / F.lit(3_600_000_000)).alias("_hr")
    per_hour = times.groupBy(hour).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_hr").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = per_hour.withColumn("_cum", F.sum("_n").over(w)).withColumn("_before", F.col("_cum") - F.col("_n"))
    tot = cum.agg(F.sum("_n")).first()[0] or 0
    n = int(tot)
    if n == 0:
        raise ValueError(f"no row has a value in {col}: nothing to split")
    if n < 2:
        raise ValueError(f"{col} has one distinct value: a time split needs two")
    idx = min(max(1, int(n * (1 - test_ratio))), n - 1)  # 0-based index
    hb = cum.where((F.col("_before") <= idx) & (F.col("_cum") > idx)).select("_hr", "_before").first()
    in_hour = times.where(F.floor(F.unix_micros(F.col(col).cast("timestamp")) / F.lit(3_600_000_000))
                          == F.lit(hb["_hr"]))
    border = (in_hour.withColumn("_i", F.row_number().over(Window.orderBy(col)) - 1 + F.lit(hb["_before"]))
              .where(F.col("_i") == idx).select(col).first()[0])
    return border


def unique_time_split(frame: DataFrame, test_ratio: float = 0.2, col: str = "start_at"):
    """(train, test) = (< border, >= border); errors when a side is empty."""
    border = unique_time_border(frame, test_ratio, col)
    b = F.lit(border).cast(frame.schema[col].dataType)
    train, test = frame.where(F.col(col) < b), frame.where(F.col(col) >= b)
    if train.limit(1).count() == 0 or test.limit(1).count() == 0:
        raise ValueError(f"all rows lie on one side of {border}")
    return train, test


def split_side(frame: DataFrame, border, col: str = "start_at") -> DataFrame:
    """F13 as one frame: adds ``side`` ('train' below the border, 'test' from it on)."""
    b = F.lit(border).cast(frame.schema[col].dataType)
    return frame.where(F.col(col).isNotNull()).withColumn(
        "side", F.when(F.col(col) < b, "train").otherwise("test"))


def cutoff_split(events: DataFrame, val_days: int = 30):
    """cutoff = max(ts) - val_days; train ts < cutoff, val ts >= cutoff."""
    max_ts = events.agg(F.max("ts")).first()[0]
    if max_ts is None:
        return events.limit(0), events.limit(0), None
    cutoff = max_ts - dt.timedelta(days=val_days)
    c = F.lit(cutoff).cast("timestamp_ntz")
    return events.where(F.col("ts") < c), events.where(F.col("ts") >= c), cutoff


@dataclass(frozen=True)
class DateSplit:
    train_shifts: DataFrame
    val_shifts: DataFrame
    train_events: DataFrame
    val_events: DataFrame


def date_split(shifts: DataFrame, events: DataFrame, t) -> DateSplit:
    """shifts <= T / > T; train events ts <= T; val events ts > T and shift in val shifts."""
    tt = F.lit(t).cast("timestamp_ntz") if not isinstance(t, str) else F.expr(
        f"timestamp_ntz'{t}'")
    tr_s = shifts.where(F.col("start_at") <= tt)
    va_s = shifts.where(F.col("start_at") > tt)
    tr_e = events.where(F.col("ts") <= tt)
    va_e = (events.where(F.col("ts") > tt)
            .join(va_s.select(F.col("id").alias("shift_id")), "shift_id", "left_semi"))
    return DateSplit(tr_s, va_s, tr_e, va_e)


def ground_truth(events: DataFrame, val_shifts: DataFrame) -> DataFrame:
    """F16: APPLY on val shifts, shift without SYSTEM_CANCEL over all events, ts <= start,
    distinct pair, date = UTC date of the shift start.

    One scan of the events: APPLY and SYSTEM_CANCEL rows of the val shifts feed a GROUPING SETS
    aggregate over (shift, user) and (shift); pairs with an in-time APPLY minus cancelled
    shifts (an anti join of two aggregated tables, not a window over a shift's events).
    """
    vs = val_shifts.select(F.col("id").alias("shift_id"), "start_at")
    it = F.col("interaction")
    e = events.where(it.isin("APPLY", "SYSTEM_CANCEL")).join(vs, "shift_id")
    g = e.groupingSets([["shift_id", "user_id"], ["shift_id"]], "shift_id", "user_id").agg(
        F.grouping_id().alias("_gid"),
        F.count_if((it == "APPLY") & (F.col("ts") <= F.col("start_at"))).alias("_ok"),
        F.count_if(it == "SYSTEM_CANCEL").alias("_cancel"),
        F.max("start_at").alias("start_at"))
    pairs = g.where((F.col("_gid") == 0) & (F.col("_ok") > 0))
    cancelled = g.where((F.col("_gid") == 1) & (F.col("_cancel") > 0)).select("shift_id")
    return (pairs.join(cancelled, "shift_id", "left_anti")
            .select("user_id", "shift_id", F.to_date("start_at").alias("date")))


def cv_truth(val_events: DataFrame, shifts: DataFrame):
    """distinct APPLY pairs in the val window (no cancel or late filter); val shifts are the
    shifts appearing in it."""
    truth = (val_events.where(F.col("interaction") == "APPLY")
             .select("user_id", "shift_id").distinct())
    vs = shifts.join(truth.select(F.col("shift_id").alias("id")).distinct(), "id", "left_semi")
    return truth, vs


def split_audit(apply: DataFrame, val_shifts: DataFrame, train_events: DataFrame,
                events: DataFrame, t) -> DataFrame:
    """one row per check with its violation count and ``ok`` flag.

    checks: truth dates outside the val shift date range, truth date != start date, late applies
    (truth pair whose APPLY events all come after the start), train events after T, truth
    shifts not among the val shifts.
    """
    tt = F.expr(f"timestamp_ntz'{t}'") if isinstance(t, str) else F.lit(t).cast("timestamp_ntz")
    vs = val_shifts.select(F.col("id").alias("shift_id"), "start_at")
    rng = vs.agg(F.min(F.to_date("start_at")).alias("dmin"),
                 F.max(F.to_date("start_at")).alias("dmax")).first()  # two scalars
    dmin, dmax = F.lit(rng["dmin"]).cast("date"), F.lit(rng["dmax"]).cast("date")
    out_of_range = (apply.where((F.col("date") < dmin) | (F.col("date") > dmax)
                                | F.lit(rng["dmin"] is None))
                    .agg(F.count(F.lit(1)).alias("n")).withColumn("check", F.lit("date_out_of_range")))
    j = apply.join(vs, "shift_id", "left")
    date_mismatch = (j.where(F.col("start_at").isNull() | (F.col("date") != F.to_date("start_at")))
                     .agg(F.count(F.lit(1)).alias("n")).withColumn("check", F.lit("date_not_start_date")))
    first_apply = (events.where(F.col("interaction") == "APPLY")
                   .groupBy("user_id", "shift_id").agg(F.min("ts").alias("first_ts")))
    late = (apply.join(first_apply, ["user_id", "shift_id"], "left").join(vs, "shift_id", "left")
            .where(F.col("first_ts") > F.col("start_at"))
            .agg(F.count(F.lit(1)).alias("n")).withColumn("check", F.lit("late_apply")))
    leaked = (train_events.where(F.col("ts") > tt).agg(F.count(F.lit(1)).alias("n"))
              .withColumn("check", F.lit("train_event_after_split")))
    unknown = (apply.select("shift_id").distinct().join(vs, "shift_id", "left_anti")
               .agg(F.count(F.lit(1)).alias("n")).withColumn("check", F.lit("truth_shift_not_in_val")))
    res = out_of_range.unionByName(date_mismatch).unionByName(late).unionByName(leaked).unionByName(unknown)
    return res.select("check", F.col("n").cast("bigint").alias("n"), (F.col("n") == 0).alias("ok"))
