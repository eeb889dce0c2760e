"""Invariants and scale-path equivalences."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from staffrank.operators import candidates as C
from staffrank.operators import labels as L
from staffrank.operators import models as G
from staffrank.operators.select import flag_smallest, smallest_k
from staffrank.sources.tables import testdata_domain as load_domain

Q = E.queries()
SF = "/root/testdata/sf0.01"


def test_candidate_invariants(spark):
    c = Q["c4_candidates"](spark, SF)
    per = c.groupBy("shift_id").agg(F.count(F.lit(1)).alias("n"), F.max("cand_rank").alias("mx"),
                                    F.count_distinct("user_id").alias("u"))
    bad = per.where((F.col("n") > 300) | (F.col("mx") != F.col("n")) | (F.col("u") != F.col("n")))
    assert bad.count() == 0
    assert per.count() == load_domain(spark, SF).shifts.count()


def test_positives_and_negatives_disjoint(spark):
    d = load_domain(spark, SF)
    pos = L.positives(d.events, d.shifts)
    neg = L.negatives(d.events, pos)
    assert pos.join(neg, ["user_id", "shift_id"]).count() == 0


def test_no_train_event_after_cutoff(spark):
    d = load_domain(spark, SF)
    from staffrank.operators.splits import cutoff_split
    tr, va, cut = cutoff_split(d.events, 14)
    assert tr.where(F.col("ts") >= F.lit(cut)).count() == 0
    assert tr.count() + va.count() == d.events.where(F.col("ts").isNotNull()).count()


def test_rerank_moves_tier_rows(spark):
    rr = Q["h2_rerank"](spark, SF)
    assert rr.where(F.col("rank") != F.col("prior_rank")).count() > 0
    per = rr.groupBy("shift_id").agg(F.count(F.lit(1)).alias("n"), F.max("rank").alias("mx"))
    assert per.where(F.col("n") != F.col("mx")).count() == 0


def test_rank_within_hot_group_equals_window(spark):
    # one group holds most rows: the distributed rank must equal a per-group row_number
    df = spark.range(0, 5000).select(
        F.when(F.col("id") % 10 < 7, F.lit("hot")).otherwise(F.concat(F.lit("g"), (F.col("id") % 3).cast("string")))
        .alias("location_id"), F.col("id").cast("string").alias("user_id"),
        (F.col("id") * 7919 % 101).alias("n_events"))
    got = C.rank_within(df, "location_id", [F.col("n_events").desc(), F.col("user_id")], "r")
    w = Window.partitionBy("location_id").orderBy(F.col("n_events").desc(), F.col("user_id"))
    want = df.withColumn("r", F.row_number().over(w))
    assert got.select("user_id", "r").exceptAll(want.select("user_id", "r")).count() == 0
    assert got.count() == 5000


def test_exact_selection_equals_sort_limit(spark):
    df = spark.range(0, 20000).select(F.col("id").cast("string").alias("user_id"),
                                      F.lit("s").alias("shift_id"),
                                      (F.col("id") % 2).alias("label"))
    keyed = df.withColumn("_h", L.sample_key(42))
    got = smallest_k(keyed, "_h", 777, ties=["user_id", "shift_id"]).select("user_id")
    want = keyed.orderBy("_h", "user_id", "shift_id").limit(777).select("user_id")
    assert got.exceptAll(want).count() == 0 and got.count() == 777
    fl = flag_smallest(keyed, "_h", ratio=0.15, group=["label"], out="sel")
    per = fl.groupBy("label").agg(F.count_if("sel").alias("k"), F.count(F.lit(1)).alias("n")).collect()
    assert all(r.k == -(-r.n * 15 // 100) for r in per)


@pytest.mark.parametrize("name", ["g1_fit_gbt", "g2_fit_lr"])
def test_models_rank_better_than_chance(spark, name):
    scored = Q[name](spark, SF_SMALL)
    assert scored.where((F.col("score") < 0) | (F.col("score") > 1)).count() == 0
    assert G.auc(scored) > 0.5


def test_exact_percentiles_equal_builtin(spark):
    from staffrank.operators.quantiles import exact_percentiles
    df = spark.range(0, 5000).select((F.col("id") % 3).alias("g"), (F.rand(7) * 100).alias("x"))
    ps = [0.01, 0.5, 0.8, 0.95, 1.0]
    got = {r.g: r for r in exact_percentiles(df, "x", ps, by=["g"]).collect()}
    want = {r.g: r for r in df.groupBy("g").agg(
        *[F.percentile("x", p).alias(f"p{int(round(p * 100)):02d}") for p in ps]).collect()}
    assert set(got) == set(want)
    for g, r in want.items():
        assert all(abs(got[g][k] - r[k]) < 1e-9 for k in r.asDict() if k != "g")


def test_percentiles_of_a_value_that_most_rows_share(spark):
    from staffrank.operators import quantiles as Q
    df = spark.range(0, 20000, numPartitions=8).select(
        F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(7).cast("double").alias("x"),
        F.lit(None).cast("double").alias("never"), (F.col("id") % 2 == 0).alias("g"),
        F.when(F.col("id") == 5, F.lit(None)).otherwise(F.col("id") % 3).alias("y"))
    # nine tenths of the rows are one row of the value table, so no task ranks them
    assert Q.value_table(df, ["x"], []).count() == 2001
    got = {r.column_name: r for r in Q.describe(df, ["x", "y", "never"], [0.0, 0.5, 0.95, 1.0], ["a", "b", "c", "d"]).collect()}
    want = df.agg(*[F.percentile(c, p).alias(f"{c}{p}") for c in ("x", "y") for p in (0.0, 0.5, 0.95, 1.0)],
                  *[f(c).alias(f"{f.__name__}_{c}") for c in ("x", "y") for f in (F.count, F.avg, F.stddev_samp)]).first()
    for c in ("x", "y"):
        r = got[c]
        assert [r.a, r.b, r.c, r.d] == [want[f"{c}{p}"] for p in (0.0, 0.5, 0.95, 1.0)] and (r.min, r.max) == (r.a, r.d)
        assert r["count"] == want[f"count_{c}"]
        assert abs(r["mean"] - want[f"avg_{c}"]) < 1e-9 and abs(r["std"] - want[f"stddev_samp_{c}"]) < 1e-9
    assert got["never"]["count"] == 0 and got["never"].b is None
    med = {(r.g, r.p, r.q) for r in Q.exact_medians(df, {"x": "p", "y": "q"}, ["g"]).collect()}
    assert med == {(r.g, r.p, r.q) for r in df.groupBy("g").agg(F.percentile("x", 0.5).alias("p"), F.percentile("y", 0.5).alias("q")).collect()}


def test_cascade_reads_no_further_source_when_all_locations_have_users(spark):
    users = spark.createDataFrame([(str(i), "a", False, i % 2 == 0) for i in range(60)] + [("x", "b", False, True)],
                                  "id string, location_id string, is_strict_location boolean, has_mk boolean")
    events = spark.createDataFrame([("e1", "s1", "3"), ("e2", "s1", "3"), ("e3", "s1", "x")], "id string, shift_id string, user_id string")
    shifts = lambda *rows: spark.createDataFrame(rows, "id string, location_id string, need_mk boolean")
    act = C.user_activity(users, events)
    near = C.candidate_cascade(shifts(("s1", "a", True), ("s2", "b", None)), users, events, act, 10, 2)
    assert "eligible" not in near._jdf.queryExecution().analyzed().toString()
    far = C.candidate_cascade(shifts(("s1", "a", True), ("s3", "nowhere", True), ("s4", None, True)), users, events, act, 10, 2)
    got = {(r.shift_id, r.source): r.n for r in far.groupBy("shift_id", "source").agg(F.count("*").alias("n")).collect()}
    assert got[("s1", "location_cache")] == 10 and got[("s3", "location_cache")] == 10
    assert len({s for s, _ in got}) == len(got)  # one source a shift
    for mine, cands in ((shifts(("s1", "a", True)), near), (shifts(("s1", "a", True), ("s3", "nowhere", True), ("s4", None, True)), far)):
        named = C.cascade_users(mine, users, events, C.location_lists(mine, act, 10), 2)
        assert cands.where("shift_id <> 's2'").join(named, "user_id", "left_anti").isEmpty()
