"""Plan guards for scale: no cartesian or nested-loop joins, filters and projections reach the
Parquet scan, capped ranks use the partial window group limit."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL

QUERIES = E.queries()
BACKTEST_T = "2024-01-28 00:00:00"  # two days of truth follow
# queries whose DataFrame is built lazily (no action while building)
LAZY = sorted(n for n in QUERIES if n[0] in "cdehj" and n not in ("j2_schema_diff",)
              or n.startswith(("i1", "i2", "i3", "i4", "i5", "i7", "i10", "b", "f1_", "f2", "f3",
                               "f8", "f9", "f10", "f11", "f12", "f15", "f16", "f18")))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cartesian_or_nested_loop(spark, name):
    p = plan(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p


def test_filter_and_projection_pushdown(spark):
    p = plan(QUERIES["f15_date_split"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(ts), LessThanOrEqual(ts," in p or "LessThanOrEqual(ts" in p
    p = plan(QUERIES["c1_user_activity"](spark, SF_SMALL))
    scans = [line for line in p.splitlines() if "events.parquet" in line or "ReadSchema" in line]
    assert all("value" not in s and "props" not in s for s in scans if "user_id" in s)


def test_capped_rank_uses_window_group_limit(spark):
    assert "WindowGroupLimit" in plan(QUERIES["c4_candidates"](spark, SF_SMALL))


def test_fallback_list_is_broadcast_equi_join(spark):
    p = plan(QUERIES["c4_candidates"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in p and "TakeOrderedAndProject" in p


def test_history_state_scans_events_once(spark):
    from staffrank.operators import history as D
    from staffrank.sources.tables import testdata_domain as load_domain
    d = load_domain(spark, SF_SMALL)
    p = plan(D.history_facts(d.events, d.shifts))
    assert p.count("events.parquet") == 1
    assert "Expand" in p


def test_labels_scan_events_for_the_pair_table_only(spark):
    from staffrank.operators import labels as L
    from staffrank.sources.tables import testdata_domain as load_domain
    d = load_domain(spark, SF_SMALL)
    assert plan(L.pair_table(d.events, d.shifts)).count("events.parquet") <= 2  # pairs, cancelled shifts
    # the split and the choice of negatives read the written pair table
    assert "events.parquet" not in plan(L.stratified_split(L.labelled_pairs(d.events, d.shifts)))


def test_state_tables_scan_their_own_facts(spark):
    from staffrank.operators import features as E26
    from staffrank.sources.tables import testdata_domain as load_domain
    d = load_domain(spark, SF_SMALL)
    state = E26.build_state(d.users, d.shifts, d.events)
    p = plan(state.user_location)
    assert "user_location" in p[p.index("PartitionFilters"):] and "events.parquet" not in p
    assert "employer_id" not in p[p.index("ReadSchema"):]


def test_describe_counts_values_in_one_pass(spark):
    p = plan(QUERIES["j25_describe"](spark, SF_SMALL))
    assert p.count("Exchange") <= 20 and "events.parquet" not in p


def test_candidates_move_shifts_and_not_pairs(spark):
    """The lists of locations meet shifts that are spread over all tasks; nothing is shuffled after it."""
    p = plan(QUERIES["c4_candidates"](spark, SF_SMALL))
    assert "REPARTITION_BY_NUM" in p and "Exchange" not in p[: p.index("explode(_list")]


def test_cascade_moves_shifts_and_not_pairs(spark):
    p = plan(QUERIES["c7_candidate_cascade"](spark, SF_SMALL))
    assert "REPARTITION_BY_NUM" in p and "Exchange" not in p[: p.index("explode(_list")]


def test_many_lists_meet_shifts_by_a_shuffle(spark, monkeypatch):
    from staffrank.operators import candidates as C
    from staffrank.sources.tables import testdata_domain as load_domain
    d = load_domain(spark, SF_SMALL)
    act = C.user_activity(d.users, d.events)
    few = C.candidates(d.shifts, act)
    monkeypatch.setattr(C, "SMALL_LISTS", 0)
    many = C.candidates(d.shifts, act)
    assert few.exceptAll(many).isEmpty() and many.exceptAll(few).isEmpty() and not few.isEmpty()


def test_target_rates_build_the_pairs_once(spark):
    p = plan(QUERIES["j23_target_rate"](spark, SF_SMALL))
    assert p.count("events.parquet") <= 1 and p.count("Expand") == 1


def test_pairs_broadcast_no_table(spark):
    assert "BroadcastExchange" not in plan(QUERIES["j23_target_rate"](spark, SF_SMALL))


def pair_exchanges(p: str) -> int:
    """Shuffles and sort-merge joins above the step that pairs shifts with candidates."""
    head = p[: p.index("explode(_list")]
    return sum(s in line for line in head.splitlines() for s in ("Exchange hashpartitioning(user_id", "Exchange hashpartitioning(employer_id", "SortMergeJoin"))


@pytest.mark.parametrize("name", ["e1_pair_features", "h1_rank_by_score", "h2_rerank", "h3_top_n"])
def test_candidate_pairs_stay_with_their_shift(spark, name):
    p = plan(QUERIES[name](spark, SF_SMALL))
    assert "explode(_list" in p and pair_exchanges(p) == 0
    assert p.count("REPARTITION_BY_NUM") == (1 if name[0] == "e" else 2)


def test_tasks_of_candidate_pairs_fit_their_share_of_memory(spark):
    """3,000 shifts of 300 candidates each: no task sorts more than a quarter of a million pairs or so."""
    from staffrank.operators import candidates as C
    act = spark.range(300).select(F.col("id").cast("string").alias("user_id"), F.lit("a").alias("location_id"), F.lit(1).alias("n_events"))
    shifts = spark.range(3000).select(F.col("id").cast("string"), F.lit("a").alias("location_id"))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        pairs = C.candidates(shifts, act)
        sizes = [r.n for r in pairs.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert sum(sizes) == 900_000 and max(sizes) < 300_000


def test_features_of_listed_users_equal_those_of_all(spark, monkeypatch):
    from staffrank.operators import candidates as C
    from staffrank.operators import features as E26
    from staffrank.sources.tables import testdata_domain as load_domain
    d = load_domain(spark, SF_SMALL)
    state = E26.build_state(d.users, d.shifts, d.events)
    act = C.user_activity(d.users, d.events)
    lists = C.location_lists(d.shifts, act).checkpoint()
    cands = C.candidates(d.shifts, act, lists=lists).checkpoint()
    users = C.listed_users(lists)
    want = E26.pair_features(cands, d.shifts, state)
    got = E26.pair_features(cands, d.shifts, state, users)
    assert want.exceptAll(got).isEmpty() and got.exceptAll(want).isEmpty() and not got.isEmpty()
    monkeypatch.setattr(E26, "SMALL_LISTS", 0)
    got = E26.pair_features(cands, d.shifts, state, users)
    assert want.exceptAll(got).isEmpty() and got.exceptAll(want).isEmpty()


def test_rerank_of_listed_users_equals_that_of_all(spark):
    """The first places of a list whose users have sleepers and applies, derived users included."""
    from staffrank.operators import ranking as H
    from staffrank.plans import q_ranking as Q
    from staffrank.sources.tables import testdata_domain as load_domain
    d = load_domain(spark, SF_SMALL)
    cands, scored, state, users = Q.scored_candidates(d, Q.RERANK_T)
    ranked = H.rank_by_score(cands, scored).checkpoint()
    want = H.rerank(ranked, d.shifts, state.pairs, state.sleepers).checkpoint()
    got = H.rerank(ranked, d.shifts, state.pairs, state.sleepers, among=users).checkpoint()
    assert got.count() == cands.count() and want.exceptAll(got).isEmpty() and got.exceptAll(want).isEmpty()
    assert cands.join(users, "user_id", "left_anti").isEmpty()


def test_scored_pairs_stay_with_their_shift(spark):
    p = plan(QUERIES["g4_score"](spark, SF_SMALL))
    assert "explode(_list" in p and pair_exchanges(p) == 0


def test_recommended_pairs_stay_with_their_shift(spark, monkeypatch):
    """The boosted form as well: pairs meet features, scores and rerank without a shuffle of their own."""
    from staffrank.operators import boosting as B
    monkeypatch.setattr(B, "fit", lambda frame, features, *rest, **more: B.BoostedTrees(features, [[] for _ in features], 0.0, [B.Tree()]))
    p = plan(QUERIES["h6_recommend"](spark, SF_SMALL))
    assert "explode(_list" in p and pair_exchanges(p) == 0


def test_backtest_makes_the_next_days_frame_beside_the_training(spark, monkeypatch):
    """A fit does not hold up the loading of the next day, and a day's pairs stay with their shift."""
    from threading import Semaphore

    from staffrank.operators import backtest as BT
    from staffrank.sources.tables import testdata_domain as load_domain
    d, begun, plans, fits = load_domain(spark, SF_SMALL), Semaphore(0), [], []
    pairs, top = BT.L.labelled_pairs, BT.H.top_n
    days = BT.eval_days(BT.S.ground_truth(d.events, BT.S.date_split(d.shifts, d.events, BACKTEST_T).val_shifts))

    def fit(frame, features, **more):
        assert begun.acquire(timeout=60)  # this frame's pairs
        fits.append(len(fits) + 1 == len(days) or begun.acquire(timeout=60))  # the next one's
        begun.release()
        return BT.BoostedTrees(features, [[] for _ in features], 0.0, [BT.boosting.Tree()])

    monkeypatch.setattr(BT.L, "labelled_pairs", lambda *a: (begun.release(), pairs(*a))[1])
    monkeypatch.setattr(BT.H, "top_n", lambda ranked, n: (plans.append(plan(ranked)), top(ranked, n))[1])
    monkeypatch.setattr(BT.boosting, "fit", fit)
    rows = BT.model_backtest(d.users, d.shifts, d.events, BACKTEST_T).collect()
    assert [r.eval_date for r in rows] == days and len(days) > 1
    assert all(fits) and len(fits) == len(plans) == len(days)
    assert all("explode(_list" in p and pair_exchanges(p) == 0 for p in plans)


def test_backtest_makes_two_frames_ahead_of_the_training(spark, monkeypatch):
    """A fit does not hold up the frames of the two days after it."""
    from threading import Semaphore

    from staffrank.operators import backtest as BT
    from staffrank.sources.tables import testdata_domain as load_domain
    d, begun, fits = load_domain(spark, SF_SMALL), Semaphore(0), []
    pairs, split = BT.L.labelled_pairs, "2024-01-26 23:59:59"
    days = BT.eval_days(BT.S.ground_truth(d.events, BT.S.date_split(d.shifts, d.events, split).val_shifts))
    assert len(days) >= 3

    def fit(frame, features, **more):
        if not fits:
            fits.append(all(begun.acquire(timeout=60) for _ in range(3)))
        return BT.BoostedTrees(features, [[] for _ in features], 0.0, [BT.boosting.Tree()])

    monkeypatch.setattr(BT.L, "labelled_pairs", lambda *a: (begun.release(), pairs(*a))[1])
    monkeypatch.setattr(BT.boosting, "fit", fit)
    assert BT.model_backtest(d.users, d.shifts, d.events, split).count() == len(days)
    assert fits == [True]
