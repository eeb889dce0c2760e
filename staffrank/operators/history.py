"""History aggregates.

Events are read once per history: one conditional aggregation per key (user, pair, employer),
all with map-side partial aggregation, so a hot user or employer never ships raw rows.
Set- and dict-valued state stays long-form (one row per user x employer / location / task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def _it():
    return F.col("interaction")


def events_with_shift(events: DataFrame, shifts: DataFrame) -> DataFrame:
    """Events left-joined to the shift attributes the histories need."""
    s = shifts.select(F.col("id").alias("shift_id"), "employer_id", "workplace_id", "reward",
                      F.col("location_id").alias("shift_location"), "task_type")
    return events.join(s, "shift_id", "left")


def user_history(events: DataFrame, shifts: DataFrame) -> DataFrame:
    """D1 + D2 + D4: one row per user seen in events.

    applies, views, finishes, cancels, total; apply_rate = applies / max(1, total);
    finish_rate / cancel_rate = finishes / cancels over max(1, applies); active_days = distinct
    UTC dates of ts (1 when every ts is null); avg_reward over applied shifts (0.0 without
    applies, null when all those rewards are unknown).
    """
    ev = events_with_shift(events.where(F.col("user_id").isNotNull()), shifts)
    is_apply = _it() == "APPLY"
    h = ev.groupBy("user_id").agg(
        F.count_if(is_apply).alias("total_applies"),
        F.count_if(_it() == "VIEW").alias("total_views"),
        F.count_if(_it() == "FINISHED").alias("total_finishes"),
        F.count_if(_it() == "USER_CANCEL").alias("total_cancels"),
        F.count(F.lit(1)).alias("total_events"),
        F.count_distinct(F.to_date("ts")).alias("_days"),
        F.avg(F.when(is_apply, F.col("reward"))).alias("_avg_reward"))
    one = F.greatest(F.lit(1), F.col("total_applies"))
    return h.select(
        "user_id", "total_applies", "total_views", "total_finishes", "total_cancels",
        "total_events",
        (F.col("total_applies") / F.greatest(F.lit(1), F.col("total_events"))).alias("apply_rate"),
        (F.col("total_finishes") / one).alias("finish_rate"),
        (F.col("total_cancels") / one).alias("cancel_rate"),
        F.when(F.col("_days") == 0, F.lit(1)).otherwise(F.col("_days")).cast("bigint")
        .alias("active_days"),
        F.when(F.col("total_applies") == 0, F.lit(0.0)).otherwise(F.col("_avg_reward"))
        .alias("avg_reward"))


def _applied(events: DataFrame, shifts: DataFrame) -> DataFrame:
    return events_with_shift(events.where((_it() == "APPLY") & F.col("user_id").isNotNull()), shifts)


def user_employer(events: DataFrame, shifts: DataFrame) -> DataFrame:
    """D3: distinct (user_id, employer_id) the user applied to."""
    return (_applied(events, shifts).where(F.col("employer_id").isNotNull())
            .select("user_id", "employer_id").distinct())


def user_workplace(events: DataFrame, shifts: DataFrame) -> DataFrame:
    """D3: distinct (user_id, workplace_id) the user applied to."""
    return (_applied(events, shifts).where(F.col("workplace_id").isNotNull())
            .select("user_id", "workplace_id").distinct())


def user_location_cnt(events: DataFrame, shifts: DataFrame) -> DataFrame:
    """Applies per (user, shift location)."""
    return (_applied(events, shifts).where(F.col("shift_location").isNotNull())
            .groupBy("user_id", F.col("shift_location").alias("location_id"))
            .agg(F.count(F.lit(1)).alias("applies")))


def user_task_cnt(events: DataFrame, shifts: DataFrame) -> DataFrame:
    """Applies per (user, task type)."""
    return (_applied(events, shifts).where(F.col("task_type").isNotNull())
            .groupBy("user_id", "task_type").agg(F.count(F.lit(1)).alias("applies")))


def as_map(long_df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Optional per-user map view of a long table (bounded by the user's distinct keys)."""
    return long_df.groupBy("user_id").agg(
        F.map_from_entries(F.collect_list(F.struct(F.col(key), F.col(value)))).alias(name))


def employer_fill(events: DataFrame, shifts: DataFrame) -> DataFrame:
    """Per employer seen in events: APPLY events / all events; null when it has no APPLY."""
    ev = events_with_shift(events, shifts).where(F.col("employer_id").isNotNull())
    g = ev.groupBy("employer_id").agg(F.count_if(_it() == "APPLY").alias("applies"),
                                      F.count(F.lit(1)).alias("events"))
    return g.select("employer_id", "applies", "events",
                    (F.nullif(F.col("applies"), F.lit(0)) / F.greatest(F.lit(1), F.col("events")))
                    .alias("fill_rate"))


def pair_history(events: DataFrame) -> DataFrame:
    """D8 + D9: per (user, shift) with any APPLY / FINISHED / USER_CANCEL: the three counts and
    the last APPLY time (null times ignored)."""
    e = events.where(_it().isin("APPLY", "FINISHED", "USER_CANCEL")
                     & F.col("user_id").isNotNull() & F.col("shift_id").isNotNull())
    return e.groupBy("user_id", "shift_id").agg(
        F.count_if(_it() == "APPLY").alias("apply_count"),
        F.count_if(_it() == "FINISHED").alias("finish_count"),
        F.count_if(_it() == "USER_CANCEL").alias("cancel_count"),
        F.max(F.when(_it() == "APPLY", F.col("ts"))).alias("last_apply_ts"))


def sleepers(hist: DataFrame) -> DataFrame:
    """Users with no APPLY and at least one FINISHED (their finish_rate is that count)."""
    return (hist.where((F.col("total_applies") == 0) & (F.col("finish_rate") > 0))
            .select("user_id", "finish_rate", "total_finishes"))


def user_profile(users: DataFrame, hist: DataFrame) -> DataFrame:
    """Every user with D1-D4 (zeros when unseen), has_mk as 0/1 and location."""
    u = users.select(F.col("id").alias("user_id"), "location_id",
                     F.coalesce(F.col("has_mk").cast("int"), F.lit(0)).alias("user_has_mk"))
    h = hist.select("user_id", "apply_rate", "finish_rate", "cancel_rate", "total_applies",
                    "total_views", "active_days", "avg_reward")
    p = u.join(h.withColumn("_seen", F.lit(True)), "user_id", "left")
    zero = {"apply_rate": 0.0, "finish_rate": 0.0, "cancel_rate": 0.0, "total_applies": 0,
            "total_views": 0, "active_days": 0, "avg_reward": 0.0}
    # unseen users get zeros; a seen user's avg_reward stays as computed (null possible)
    return p.select("user_id", "location_id", "user_has_mk", *[
        F.when(F.col("_seen").isNull(), F.lit(z)).otherwise(F.col(c)).alias(c)
        for c, z in zero.items()])


# ---------------------------------------------------------------------------------------------
# One-pass state: every history above from a single scan of the events (GROUPING SETS).
# ---------------------------------------------------------------------------------------------

_FACT_KEYS = ["user_id", "shift_location", "task_type", "employer_id", "workplace_id", "shift_id",
              "day"]
# The grouping sets of the one-pass history aggregate.
_FACT_SETS = {
    "user": ["user_id"],
    "user_day": ["user_id", "day"],
    "user_location": ["user_id", "shift_location"],
    "user_task": ["user_id", "task_type"],
    "user_employer": ["user_id", "employer_id"],
    "user_workplace": ["user_id", "workplace_id"],
    "employer": ["employer_id"],
    "pair": ["user_id", "shift_id"],
}


def _gid(cols: list[str]) -> int:
    n = len(_FACT_KEYS)
    return sum(1 << (n - 1 - i) for i, c in enumerate(_FACT_KEYS) if c not in cols)


def history_facts(events: DataFrame, shifts: DataFrame) -> DataFrame:
    """All per-key counts the histories need, in one scan + one shuffle: a GROUPING SETS
    aggregate (Expand, then partial aggregation on the map side) tagged with the set name."""
    ev = events_with_shift(events, shifts).withColumn("day", F.to_date("ts"))
    it = _it()
    is_apply = it == "APPLY"
    g = ev.groupingSets([list(v) for v in _FACT_SETS.values()], *_FACT_KEYS).agg(
        F.grouping_id().alias("_gid"),
        F.count_if(is_apply).alias("n_apply"), F.count_if(it == "VIEW").alias("n_view"),
        F.count_if(it == "FINISHED").alias("n_finish"), F.count_if(it == "USER_CANCEL").alias("n_cancel"),
        F.count(F.lit(1)).alias("n_total"),
        F.sum(F.when(is_apply, F.col("reward"))).alias("reward_sum"),
        F.count(F.when(is_apply, F.col("reward"))).alias("reward_n"),
        F.max(F.when(is_apply, F.col("ts"))).alias("last_apply_ts"))
    label = F.lit(None).cast("string")
    for name, cols in _FACT_SETS.items():
        label = F.when(F.col("_gid") == _gid(cols), F.lit(name)).otherwise(label)
    return g.withColumn("fact", label).drop("_gid")


_FACT_COUNTS = ["n_apply", "n_view", "n_finish", "n_cancel", "n_total", "reward_sum", "reward_n"]
# The grouping sets whose keys come from the event's shift.
_SHIFT_FACTS = ["user_location", "user_task", "user_employer", "user_workplace", "employer"]


def merge_facts(a: DataFrame, b: DataFrame) -> DataFrame:
    """Facts of two disjoint sets of events together: counts and sums add up, the last apply is the later one."""
    return (a.unionByName(b).groupBy("fact", *_FACT_KEYS)
            .agg(*[F.sum(c).alias(c) for c in _FACT_COUNTS], F.max("last_apply_ts").alias("last_apply_ts")))


def late_facts(events: DataFrame, shifts: DataFrame) -> DataFrame:
    """What events that were counted before their shift was known add when ``shifts`` come: the facts by
    the shift's attributes, and the rewards of their users.  Merged with the older facts this gives the
    facts of all events with all shifts."""
    known = events.join(shifts.select(F.col("id").alias("shift_id")), "shift_id", "left_semi")
    f = history_facts(known, shifts)
    mine = f.where(F.col("fact").isin(_SHIFT_FACTS))
    rewards = f.where(F.col("fact") == "user").select(
        *[F.lit(0).cast("long").alias(c) if c.startswith("n_") else
          F.lit(None).cast("timestamp_ntz").alias(c) if c == "last_apply_ts" else c for c in f.columns])
    return mine.unionByName(rewards)


def _facts(facts: DataFrame, name: str) -> DataFrame:
    f = facts.where(F.col("fact") == name)
    for c in _FACT_SETS[name]:
        f = f.where(F.col(c).isNotNull())
    return f


def history_from_facts(facts: DataFrame) -> DataFrame:
    """D1 + D2 + D4 from the one-pass facts."""
    days = _facts(facts, "user_day").groupBy("user_id").agg(F.count(F.lit(1)).alias("_days"))
    u = _facts(facts, "user").join(days, "user_id", "left")
    one = F.greatest(F.lit(1), F.col("n_apply"))
    return u.select(
        "user_id", F.col("n_apply").alias("total_applies"), F.col("n_view").alias("total_views"),
        F.col("n_finish").alias("total_finishes"), F.col("n_cancel").alias("total_cancels"),
        F.col("n_total").alias("total_events"),
        (F.col("n_apply") / F.greatest(F.lit(1), F.col("n_total"))).alias("apply_rate"),
        (F.col("n_finish") / one).alias("finish_rate"), (F.col("n_cancel") / one).alias("cancel_rate"),
        F.coalesce(F.col("_days"), F.lit(1)).cast("bigint").alias("active_days"),
        F.when(F.col("n_apply") == 0, F.lit(0.0))
        .otherwise(F.col("reward_sum") / F.nullif(F.col("reward_n"), F.lit(0))).alias("avg_reward"))


def long_tables_from_facts(facts: DataFrame) -> dict:
    """D3, D5, D6, D7, D8 + D9 from the one-pass facts."""
    applied = F.col("n_apply") > 0
    return {
        "user_location": _facts(facts, "user_location").where(applied).select(
            "user_id", F.col("shift_location").alias("location_id"), F.col("n_apply").alias("applies")),
        "user_task": _facts(facts, "user_task").where(applied).select(
            "user_id", "task_type", F.col("n_apply").alias("applies")),
        "user_employer": _facts(facts, "user_employer").where(applied).select("user_id", "employer_id"),
        "user_workplace": _facts(facts, "user_workplace").where(applied).select("user_id", "workplace_id"),
        "employer": _facts(facts, "employer").select(
            "employer_id", F.col("n_apply").alias("applies"), F.col("n_total").alias("events"),
            (F.nullif(F.col("n_apply"), F.lit(0)) / F.greatest(F.lit(1), F.col("n_total"))).alias("fill_rate")),
        "pairs": _facts(facts, "pair").where(
            F.col("n_apply") + F.col("n_finish") + F.col("n_cancel") > 0).select(
            "user_id", "shift_id", F.col("n_apply").alias("apply_count"),
            F.col("n_finish").alias("finish_count"), F.col("n_cancel").alias("cancel_count"),
            "last_apply_ts"),
    }
