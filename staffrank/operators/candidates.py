"""Candidate generation.

Scale notes
* Activity is one partial-aggregated count per user (map-side combine), joined to users on
  ``user_id`` (sort-merge or AQE broadcast, chosen at run time).
* Every capped rank is written as ``row_number() <= k``; Spark inserts a partial
  ``WindowGroupLimit`` before the exchange, so a hot location ships at most ``k`` rows per map
  task instead of all its users.
* The cross-location fallback never pairs shifts with all users: the global top list is bounded
  by the parameters (``extra + min_local - 1`` rows), each fallback location explodes exactly that
  many slot numbers and equi-joins them to the list by rank (broadcast hash join of a table
  whose size is fixed by parameters, not by data).
* Lists are worked out per location and met by the shifts only at the end (``candidates``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staffrank.session import by_shift, ensure_checkpoint_dir

# Pairs of one task (rank and rerank sort them twice and hold a hashed copy of their scores,
# all in memory and without a spill), and the most list entries sent to every task; longer lists meet the
# shifts by a shuffle of both.
PAIRS_OF_TASK = 1 << 18
SMALL_LISTS = 1 << 19


def user_activity(users: DataFrame, events: DataFrame, count_col: str | None = None) -> DataFrame:
    """(user_id, location_id, is_strict_location, has_mk, n_events); 0 without events.

    ``count_col`` counts only events where that column is set (the store's ``COUNT(e.id)``).
    """
    counted = F.count(F.col(count_col)) if count_col else F.count(F.lit(1))
    counts = (events.where(F.col("user_id").isNotNull())
              .groupBy("user_id").agg(counted.alias("n_events")))
    u = users.select(F.col("id").alias("user_id"), "location_id", "is_strict_location", "has_mk")
    return (u.join(counts, "user_id", "left")
            .withColumn("n_events", F.coalesce(F.col("n_events"), F.lit(0)).cast("bigint")))


def _activity_order():
    return [F.col("n_events").desc(), F.col("user_id").asc()]


def location_rank(activity: DataFrame, limit: int | None = None, by: list[str] | None = None
                  ) -> DataFrame:
    """Rank inside the location by activity desc, user id asc; optional cap.

    Capped: ``row_number() <= limit`` (partial window group limit before the shuffle).
    Uncapped: a skew-safe distributed rank (a hot location is split across range partitions).
    ``by``: extra partition keys (for instance the day of an as-of state).
    """
    by = by or []
    if limit is None and not by:
        return rank_within(activity, "location_id", _activity_order(), "loc_rank")
    w = Window.partitionBy(*by, "location_id").orderBy(*_activity_order())
    ranked = activity.withColumn("loc_rank", F.row_number().over(w))
    return ranked.where(F.col("loc_rank") <= limit) if limit is not None else ranked


def rank_within(df: DataFrame, group: str, order: list, out: str) -> DataFrame:
    """``row_number() over (partition by group order by order)`` without one task per group.

    Range-partition by (group, order...) so a group holding a third of the rows spans many
    partitions; checkpoint (shared folder) to pin that partitioning; count rows per
    (partition, group); a running sum of those counts over the partitions gives each
    (partition, group) slice its offset; the final number is offset + the row's number inside
    its slice (a window over (partition, group), bounded by the partition size).
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    r = (df.repartitionByRange(n, F.col(group), *order)
         .withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True))
    counts = r.groupBy("_pid", group).agg(F.count(F.lit(1)).alias("_n"))
    wo = Window.partitionBy(group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.withColumn("_off", F.coalesce(F.sum("_n").over(wo), F.lit(0))).drop("_n")
    wl = Window.partitionBy("_pid", group).orderBy(*order)
    j = r.join(offs, ["_pid", group])
    return j.withColumn(out, (F.col("_off") + F.row_number().over(wl)).cast("bigint")).drop("_pid", "_off")


def global_top(activity: DataFrame, k: int, by: list[str] | None = None) -> DataFrame:
    """The k most active users with their global rank (top-k first, rank on <= k rows);
    with ``by``, the top k of every ``by`` group (window group limit per group)."""
    if by:
        w = Window.partitionBy(*by).orderBy(*_activity_order())
        return activity.withColumn("global_rank", F.row_number().over(w)).where(
            F.col("global_rank") <= k)
    top = activity.orderBy(*_activity_order()).limit(k)
    return top.withColumn("global_rank", F.row_number().over(Window.orderBy(*_activity_order())))


def location_sizes(activity: DataFrame, by: list[str] | None = None) -> DataFrame:
    return activity.groupBy(*(by or []), "location_id").agg(F.count(F.lit(1)).alias("loc_users"))


def location_lists(shifts: DataFrame, activity: DataFrame, limit: int = 300, min_local: int = 50,
                   extra: int = 500, by: list[str] | None = None) -> DataFrame:
    """The C4 list of every location that a shift names: (by, location_id, user_id, cand_rank).

    All shifts of a location share one list of at most ``limit`` users, so ranks and fallbacks are
    worked out per location, not per shift.
    """
    by = by or []
    local = (location_rank(activity.where(F.col("location_id").isNotNull()), limit, by)
             .select(*by, "location_id", "user_id", F.col("loc_rank").alias("cand_rank")))
    named = shifts.select(*by, "location_id").distinct()
    lists = local.join(named, [*by, "location_id"], "left_semi")
    if extra <= 0 or min_local <= 0:
        return lists
    sizes = location_sizes(activity, by)
    small = (named.join(sizes, [*by, "location_id"], "left")
             .withColumn("loc_users", F.coalesce(F.col("loc_users"), F.lit(0)))
             .where(F.col("loc_users") < min_local))
    pool = extra + min_local - 1  # enough: fewer than min_local of them can be local
    gtop = (global_top(activity, pool, by)
            .select(*by, F.col("global_rank").alias("slot"), F.col("user_id").alias("g_user"),
                    F.col("location_id").alias("g_loc")))
    if not by:
        gtop = F.broadcast(gtop)  # bounded by the parameters: pool rows
    slots = small.select("location_id", "loc_users", *by,
                         F.explode(F.sequence(F.lit(1), F.lit(pool))).alias("slot"))
    ext = (slots.join(gtop, [*by, "slot"])
           .where(F.col("g_loc").isNull() | (F.col("g_loc") != F.col("location_id")))
           .withColumn("x", F.row_number().over(Window.partitionBy(*by, "location_id").orderBy("slot")))
           .where(F.col("x") <= extra)
           .select(*by, "location_id", F.col("g_user").alias("user_id"),
                   (F.col("loc_users") + F.col("x")).alias("cand_rank")))
    return lists.unionByName(ext).where(F.col("cand_rank") <= limit)


def listed_users(lists: DataFrame) -> DataFrame:
    """The users of candidate lists, once each: (user_id)."""
    return lists.select("user_id").distinct().checkpoint()


def candidates(shifts: DataFrame, activity: DataFrame, limit: int = 300, min_local: int = 50,
               extra: int = 500, by: list[str] | None = None, lists: DataFrame | None = None) -> DataFrame:
    """C4: (shift_id, user_id, cand_rank) for every shift.

    Users of the shift's location in activity order; when the location has fewer than
    ``min_local`` users, the first ``extra`` globally ranked users from other locations are
    appended; the list is cut to ``limit``. ``by``: keys shared by shifts and activity that
    select which activity state a shift sees (e.g. the day of an as-of backtest).  ``lists``:
    the ``location_lists`` of the same arguments, when the caller needs them as well.

    The shifts, not the pairs, are shuffled by ``shift_id``, into as many tasks as their pairs need;
    joins and windows by ``shift_id`` on top of it then move no pair.
    """
    by = by or []
    spark = shifts.sparkSession
    by_shift(spark)
    ensure_checkpoint_dir(spark)
    lists = location_lists(shifts, activity, limit, min_local, extra, by) if lists is None else lists
    s = shifts.select(F.col("id").alias("shift_id"), "location_id", *by).checkpoint()
    packed = lists.groupBy(*by, "location_id").agg(
        F.collect_list(F.struct("user_id", "cand_rank")).alias("_list"))  # at most ``limit`` entries
    n = s.agg(F.count("*").alias("shifts"), F.count_distinct(F.struct(*by, "location_id")).alias("lists")).first()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n["shifts"] * limit // PAIRS_OF_TASK))
    if n["lists"] * limit <= SMALL_LISTS:
        packed = F.broadcast(packed)
    s = s.repartition(parts, "shift_id")
    same = [F.col(f"s.{c}").eqNullSafe(F.col(f"l.{c}")) for c in [*by, "location_id"]]
    return (s.alias("s").join(packed.alias("l"), same)
            .select("shift_id", F.explode("_list").alias("_c")).select("shift_id", "_c.user_id", "_c.cand_rank"))


def eligible_top(shifts: DataFrame, users: DataFrame, events: DataFrame, limit: int) -> DataFrame:
    """Same location and certificate when required, by event count desc, top ``limit``."""
    act = user_activity(users, events, count_col="id")
    s = shifts.select(F.col("id").alias("shift_id"), "location_id", "need_mk")
    # cap per location before pairing: a shift needing the certificate only sees has_mk users,
    # so two capped lists (each with its own partial window group limit) and each shift takes one
    need = F.coalesce(F.col("need_mk"), F.lit(False))
    w = Window.partitionBy("location_id").orderBy(*_activity_order())
    top_all = (act.withColumn("cand_rank", F.row_number().over(w)).where(F.col("cand_rank") <= limit)
               .select("location_id", "user_id", "cand_rank", F.lit(False).alias("mk_list")))
    top_mk = (act.where(F.col("has_mk") == True)  # noqa: E712
              .withColumn("cand_rank", F.row_number().over(w)).where(F.col("cand_rank") <= limit)
              .select("location_id", "user_id", "cand_rank", F.lit(True).alias("mk_list")))
    lists = top_all.unionByName(top_mk)
    j = s.withColumn("mk_list", need).join(lists, ["location_id", "mk_list"])
    return j.select("shift_id", "user_id", "cand_rank")


def fallback_top(shifts: DataFrame, users: DataFrame, events: DataFrame, limit: int) -> DataFrame:
    """The global top ``limit`` users by event count, offered to every shift.

    The top list is bounded by ``limit``; each shift explodes ``limit`` slots and equi-joins them.
    """
    g = F.broadcast(global_top(user_activity(users, events, count_col="id"), limit)
                    .select(F.col("global_rank").alias("cand_rank"), "user_id"))
    s = shifts.select(F.col("id").alias("shift_id"),
                      F.explode(F.sequence(F.lit(1), F.lit(limit))).alias("cand_rank"))
    return s.join(g, "cand_rank").select("shift_id", "user_id", "cand_rank")


def _unpeopled(shifts: DataFrame, users: DataFrame) -> DataFrame:
    """The shifts of locations without users."""
    peopled = users.where(F.col("location_id").isNotNull()).select("location_id").distinct()
    return shifts.join(peopled, "location_id", "left_anti").select(*shifts.columns)


def cascade_users(shifts: DataFrame, users: DataFrame, events: DataFrame, lists: DataFrame,
                  store_limit: int = 10) -> DataFrame:
    """The users that ``candidate_cascade`` over these ``lists`` may name, once each: (user_id)."""
    rest = _unpeopled(shifts, users)
    if rest.isEmpty():
        return listed_users(lists)
    near = eligible_top(rest, users, events, store_limit).select("user_id")
    top = global_top(user_activity(users, events, count_col="id"), store_limit).select("user_id")
    return listed_users(lists.select("user_id").unionByName(near).unionByName(top))


def candidate_cascade(shifts: DataFrame, users: DataFrame, events: DataFrame, activity: DataFrame,
                      limit: int = 300, store_limit: int = 10, lists: DataFrame | None = None) -> DataFrame:
    """Per shift the first non-empty source of C4 (``limit``), C5 and C6 (``store_limit``,
    the request size); tagged with ``source``.

    Sizes decide first: a shift whose location has users has C4 candidates.  Only the shifts of other
    locations, usually none, are followed through the sources, so the events are not read for lists
    that no shift takes."""
    c4 = candidates(shifts, activity, limit, lists=lists).withColumn("source", F.lit("location_cache"))
    rest = _unpeopled(shifts, users)
    if rest.isEmpty():
        return c4
    have4 = (candidates(rest, activity, limit).select("shift_id").distinct())
    c5 = eligible_top(rest, users, events, store_limit).withColumn("source", F.lit("eligible"))
    c6 = fallback_top(rest, users, events, store_limit).withColumn("source", F.lit("global"))
    c5 = c5.join(have4, "shift_id", "left_anti")
    have45 = have4.unionByName(c5.select("shift_id").distinct())
    c6 = c6.join(have45, "shift_id", "left_anti")
    return c4.unionByName(c5).unionByName(c6)
