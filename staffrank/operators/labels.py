"""Labels and training frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staffrank.operators.select import flag_smallest, smallest_k
from staffrank.session import ensure_checkpoint_dir


def cancelled_shifts(events: DataFrame) -> DataFrame:
    """shifts with any SYSTEM_CANCEL."""
    return (events.where((F.col("interaction") == "SYSTEM_CANCEL") & F.col("shift_id").isNotNull())
            .select("shift_id").distinct())


def pair_table(events: DataFrame, shifts: DataFrame) -> DataFrame:
    """What the labels need of every (user, shift) pair.

    APPLY, VIEW and cancel rows feed one GROUPING SETS aggregate over (user, shift) and (shift);
    cancelled shifts leave by a join of its two results.  ``positive`` (F2): an APPLY at or
    before the start (kept when either time is null) of a shift without SYSTEM_CANCEL.  ``seen``: a
    VIEW or USER_CANCEL."""
    st = shifts.select(F.col("id").alias("shift_id"), "start_at")
    it = F.col("interaction")
    e = events.where(it.isin("APPLY", "VIEW", "USER_CANCEL", "SYSTEM_CANCEL")).join(st, "shift_id", "left")
    in_time = F.col("start_at").isNull() | F.col("ts").isNull() | (F.col("ts") <= F.col("start_at"))
    g = e.groupingSets([["user_id", "shift_id"], ["shift_id"]], "user_id", "shift_id").agg(
        F.grouping_id().alias("_gid"), F.count_if((it == "APPLY") & in_time).alias("_applied"),
        F.count_if(it.isin("VIEW", "USER_CANCEL")).alias("_seen"),
        F.count_if(it == "SYSTEM_CANCEL").alias("_cancelled"))
    cancelled = g.where((F.col("_gid") != 0) & (F.col("_cancelled") > 0)).select("shift_id", F.lit(True).alias("_off"))
    return g.where(F.col("_gid") == 0).join(cancelled, "shift_id", "left").select(
        "user_id", "shift_id", ((F.col("_applied") > 0) & F.col("_off").isNull()).alias("positive"),
        (F.col("_seen") > 0).alias("seen"))


def positives(events: DataFrame, shifts: DataFrame) -> DataFrame:
    """distinct (user, shift) with APPLY at or before start (kept when either time is null),
    shift not cancelled."""
    return pair_table(events, shifts).where("positive").select("user_id", "shift_id")


def negatives(events: DataFrame, pos: DataFrame) -> DataFrame:
    """distinct pairs with VIEW or USER_CANCEL that are not positives."""
    n = (events.where(F.col("interaction").isin("VIEW", "USER_CANCEL"))
         .select("user_id", "shift_id").distinct())
    return n.join(pos.select("user_id", "shift_id"), ["user_id", "shift_id"], "left_anti")


def sample_key(seed: int = 42):
    """Partition-independent pseudo-random order of a pair: md5 of 'user|shift|seed'."""
    return F.md5(F.concat_ws("|", F.col("user_id"), F.col("shift_id"), F.lit(str(seed))))


def cap_negatives(neg: DataFrame, pos: DataFrame, ratio: float = 5, seed: int = 42) -> DataFrame:
    """at most ``ratio`` x positives negatives, a reproducible seeded choice: the pairs with
    the smallest ``md5(user|shift|seed)`` keys (exact distributed selection, no single task)."""
    k = int(pos.count() * ratio)
    if k <= 0:
        return neg.limit(0)
    keyed = neg.withColumn("_h", sample_key(seed))
    return smallest_k(keyed, "_h", int(k), ties=["user_id", "shift_id"]).drop("_h")


def stratified_split(frame: DataFrame, test_ratio: float = 0.15, seed: int = 42) -> DataFrame:
    """per label, the ceil(test_ratio * n_label) pairs with the smallest hash go to 'test',
    the rest to 'train' (adds ``side``). Two passes: a bucket histogram, then the flagging."""
    keyed = frame.withColumn("_h", sample_key(seed))
    flagged = flag_smallest(keyed, "_h", ratio=test_ratio, ties=["user_id", "shift_id"],
                            group=["label"], out="_test")
    return (flagged.withColumn("side", F.when(F.col("_test"), "test").otherwise("train"))
            .drop("_h", "_test"))


def labelled_pairs(events: DataFrame, shifts: DataFrame, ratio: int = 5, seed: int = 42) -> DataFrame:
    """F2 + F4: (user_id, shift_id, label).

    The pair table is written once to the shared checkpoint folder; counting the positives, choosing
    the negatives and whatever the caller does with the result read it there and not the events."""
    ensure_checkpoint_dir(events.sparkSession)
    table = pair_table(events, shifts).where("positive OR seen").checkpoint()
    pos = table.where("positive").select("user_id", "shift_id")
    # a pair with a null key equals no other pair, so a positive does not take it out of the negatives
    neg = table.where("seen AND (NOT positive OR user_id IS NULL OR shift_id IS NULL)").select("user_id", "shift_id")
    return (pos.withColumn("label", F.lit(1))
            .unionByName(cap_negatives(neg, pos, ratio, seed).withColumn("label", F.lit(0))))


def class_weight(frame: DataFrame) -> DataFrame:
    """positive class weight = negatives / max(1, positives) (one row)."""
    return frame.agg(
        (F.count_if(F.col("label") == 0) / F.greatest(F.lit(1), F.count_if(F.col("label") == 1)))
        .alias("pos_weight"))


def pair_counts(events: DataFrame, shifts: DataFrame, include_attrs: bool = False) -> DataFrame:
    """F8 + F9: inner join events-shifts, keep ts <= start_at; per (user, shift) the first ts,
    the five interaction counts and ``target`` = (apply + finished) > 0."""
    st = shifts.select(F.col("id").alias("shift_id"), "start_at")
    e = events.join(st, "shift_id").where(F.col("ts") <= F.col("start_at"))
    it = F.col("interaction")
    out = (e.groupBy("user_id", "shift_id")
           .agg(F.min("ts").alias("first_ts"),
                F.count_if(it == "VIEW").alias("n_view"),
                F.count_if(it == "APPLY").alias("n_apply"),
                F.count_if(it == "FINISHED").alias("n_finished"),
                F.count_if(it == "USER_CANCEL").alias("n_user_cancel"),
                F.count_if(it == "SYSTEM_CANCEL").alias("n_system_cancel")))
    return out.withColumn("target", ((F.col("n_apply") + F.col("n_finished")) > 0).cast("int"))


def user_loo(pairs: DataFrame) -> DataFrame:
    """leave-one-out user totals (views, applies, finished) over all other pairs.

    Per-user totals come from a partial (map-side) aggregation and are joined back on
    ``user_id``: a hot user costs one row on the totals side, and AQE splits its pair rows,
    where a window over ``user_id`` would sort all of them inside one task.
    """
    tot = pairs.groupBy("user_id").agg(F.sum("n_view").alias("_v"), F.sum("n_apply").alias("_a"),
                                       F.sum("n_finished").alias("_f"))
    return (pairs.join(tot, "user_id")
            .withColumn("user_views_loo", F.col("_v") - F.col("n_view"))
            .withColumn("user_applies_loo", F.col("_a") - F.col("n_apply"))
            .withColumn("user_finished_loo", F.col("_f") - F.col("n_finished"))
            .drop("_v", "_a", "_f"))


def pair_attrs(pairs: DataFrame, shifts: DataFrame, users: DataFrame) -> DataFrame:
    """shift and user attributes (inner joins), ``location_match``, ``need_mk_match``."""
    s = shifts.select(F.col("id").alias("shift_id"), "start_at", F.col("location_id").alias("shift_location"),
                      "task_type", "employer_id", "workplace_id", "need_mk", "id_differential",
                      "hours", "reward", "capacity")
    u = users.select(F.col("id").alias("user_id"), F.col("location_id").alias("user_location"),
                     "is_strict_location", "has_mk")
    x = pairs.join(s, "shift_id").join(u, "user_id")
    return (x.withColumn("location_match", (F.col("user_location") == F.col("shift_location")).cast("int"))
            .withColumn("need_mk_match", (F.col("need_mk") == F.col("has_mk")).cast("int")))


def finished_affinity(pairs: DataFrame, events: DataFrame, shifts: DataFrame) -> DataFrame:
    """FINISHED counts per (user, employer) and (user, workplace) over leak-filtered events
    (ts <= start), attached to the pairs with 0 default."""
    st = shifts.select(F.col("id").alias("shift_id"), "start_at", "employer_id", "workplace_id")
    fin = (events.where(F.col("interaction") == "FINISHED").join(st, "shift_id")
           .where(F.col("ts") <= F.col("start_at")))
    by_emp = fin.groupBy("user_id", "employer_id").agg(F.count(F.lit(1)).alias("user_employer_finished"))
    by_wp = fin.groupBy("user_id", "workplace_id").agg(F.count(F.lit(1)).alias("user_workplace_finished"))
    p = pairs.join(st.select("shift_id", "employer_id", "workplace_id"), "shift_id", "left")
    return (p.join(by_emp, ["user_id", "employer_id"], "left")
            .join(by_wp, ["user_id", "workplace_id"], "left")
            .withColumn("user_employer_finished", F.coalesce("user_employer_finished", F.lit(0)))
            .withColumn("user_workplace_finished", F.coalesce("user_workplace_finished", F.lit(0))))


def baseline_frame(events: DataFrame, shifts: DataFrame, users: DataFrame) -> DataFrame:
    """F8-F12 assembled as the baseline model's training frame (one row per pair)."""
    pc = pair_counts(events, shifts)
    x = user_loo(pc)
    x = pair_attrs(x, shifts, users)
    fa = finished_affinity(pc.select("user_id", "shift_id"), events, shifts).drop(
        "employer_id", "workplace_id")
    x = x.join(fa, ["user_id", "shift_id"], "left")
    return x.select(
        "user_id", "shift_id", "start_at", "capacity", "target", "task_type", "hours", "reward",
        "location_match", "need_mk_match", "has_mk", "is_strict_location", "need_mk", "id_differential",
        F.col("n_view").alias("view_cnt"), F.col("n_user_cancel").alias("user_cancel_cnt"),
        F.col("n_system_cancel").alias("system_cancel_cnt"),
        F.col("user_views_loo").alias("user_hist_views"),
        F.col("user_applies_loo").alias("user_hist_applies"),
        F.col("user_finished_loo").alias("user_hist_finished"),
        F.coalesce("user_employer_finished", F.lit(0)).alias("user_finished_employer"),
        F.coalesce("user_workplace_finished", F.lit(0)).alias("user_finished_workplace"))
