"""Hand-computed cases (FIXTURES.md section 2)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from staffrank.functions.expressions import to_bool, to_uuid
from staffrank.operators import contract as B
from staffrank.operators import history as D
from staffrank.operators import labels as L
from staffrank.operators import metric as M
from staffrank.operators import splits as S
from staffrank.operators import candidates as C
from staffrank.operators import ranking as H
from staffrank.sources.tables import EVENTS_SCHEMA, SHIFTS_SCHEMA, USERS_SCHEMA, Domain


def ts(s):
    return dt.datetime.fromisoformat(s)


@pytest.fixture(scope="module")
def smoke(spark):
    users = spark.createDataFrame([("u1", "loc-1", True, True), ("u2", "loc-2", False, False),
                                   ("u3", "loc-1", False, True)], USERS_SCHEMA)
    shifts = spark.createDataFrame([
        ("s1", ts("2026-01-10T08:00"), "loc-1", "picker", "e1", "w1", True, False, 8, 1200.0, 2),
        ("s2", ts("2026-01-20T08:00"), "loc-2", "loader", "e2", "w2", False, False, 6, 900.0, 1),
        ("s3", ts("2026-02-05T08:00"), "loc-1", "picker", "e1", "w1", True, True, 10, 1500.0, 3)],
        SHIFTS_SCHEMA)
    events = spark.createDataFrame([
        ("ev1", "s1", "u1", "VIEW", ts("2026-01-08T10:00")),
        ("ev2", "s1", "u1", "APPLY", ts("2026-01-09T10:00")),
        ("ev3", "s2", "u2", "VIEW", ts("2026-01-19T10:00")),
        ("ev4", "s2", "u3", "VIEW", ts("2026-01-18T10:00")),
        ("ev5", "s3", "u1", "VIEW", ts("2026-02-03T10:00")),
        ("ev6", "s3", "u1", "FINISHED", ts("2026-02-04T10:00")),
        ("ev7", "s3", "u2", "VIEW", ts("2026-02-01T10:00"))], EVENTS_SCHEMA)
    return Domain(users, shifts, events)


def test_pairs_targets_and_split(smoke):
    pc = L.pair_counts(smoke.events, smoke.shifts)
    got = {(r.user_id, r.shift_id): r.target for r in pc.collect()}
    assert len(got) == 5
    assert got == {("u1", "s1"): 1, ("u2", "s2"): 0, ("u3", "s2"): 0, ("u1", "s3"): 1, ("u2", "s3"): 0}
    fr = pc.join(smoke.shifts.select(F.col("id").alias("shift_id"), "start_at"), "shift_id")
    train, test = S.unique_time_split(fr, 0.2)
    assert (train.count(), test.count()) == (3, 2)
    assert S.unique_time_border(fr, 0.2) == ts("2026-02-05T08:00")
    loo = {(r.user_id, r.shift_id): r for r in L.user_loo(pc).collect()}[("u1", "s1")]
    assert (loo.user_views_loo, loo.user_applies_loo, loo.user_finished_loo) == (1, 0, 1)


def test_history_and_labels(smoke):
    h = {r.user_id: r for r in D.user_history(smoke.events, smoke.shifts).collect()}["u1"]
    assert (h.total_applies, h.total_finishes, h.total_views, h.active_days) == (1, 1, 2, 4)
    assert h.apply_rate == pytest.approx(0.25) and h.finish_rate == pytest.approx(1.0)
    pos = L.positives(smoke.events, smoke.shifts)
    assert {(r.user_id, r.shift_id) for r in pos.collect()} == {("u1", "s1")}
    neg = L.negatives(smoke.events, pos)
    assert {(r.user_id, r.shift_id) for r in neg.collect()} == {
        ("u2", "s2"), ("u3", "s2"), ("u1", "s3"), ("u2", "s3")}
    emp = {r.employer_id: r.fill_rate for r in D.employer_fill(smoke.events, smoke.shifts).collect()}
    assert emp["e1"] == pytest.approx(0.2) and emp["e2"] is None


def test_metric_smoke(spark):
    rows = [("s1", ts("2026-03-01T08:00"), 2, 1, .9), ("s1", ts("2026-03-01T08:00"), 2, 0, .8),
            ("s1", ts("2026-03-01T08:00"), 2, 0, .2), ("s2", ts("2026-03-01T09:00"), 1, 1, .6),
            ("s2", ts("2026-03-01T09:00"), 1, 0, .1), ("s3", ts("2026-03-02T08:00"), 2, 1, .7),
            ("s3", ts("2026-03-02T08:00"), 2, 0, .6), ("s3", ts("2026-03-02T08:00"), 2, 0, .2)]
    df = spark.createDataFrame(rows, "shift_id string, start_at timestamp_ntz, capacity int, "
                                     "target int, score double")
    r = M.target_metric(df).first()
    assert (r.target_metric, r.evaluated_days, r.evaluated_groups, r.evaluated_shifts) == (1.0, 2, 2, 2)
    empty = M.target_metric(df.limit(0)).first()
    assert (empty.target_metric, empty.evaluated_days) == (0.0, 0)


@pytest.mark.parametrize("targets,m,expected", [
    ([1, 0], 0.2, 1.0), ([0, 1], 0.2, 0.4444444444444444), ([0, 1, 1], 0.3, 0.4117647058823529)])
def test_partial_auc_values(spark, targets, m, expected):
    cap = int(round(m * 10))
    rows = [("s", dt.date(2026, 3, 1), cap, t, float(len(targets) - i)) for i, t in enumerate(targets)]
    pool = spark.createDataFrame(rows, "shift_id string, eval_date date, capacity int, target int, score double")
    assert M.partial_auc(pool).first().shift_metric == pytest.approx(expected, abs=1e-12)


def test_uuid_normalisation(spark):
    df = spark.createDataFrame([("ev1",), ("1000",), ("привет",),
                                ("{1B00A6C8-24E9-5B0D-AE18-3AF3FFF5FF34}",),
                                ("urn:uuid:1b00a6c824e95b0dae183af3fff5ff34",)], "x string")
    got = [r.u for r in df.select(to_uuid("x").alias("u")).collect()]
    assert got == ["1b00a6c8-24e9-5b0d-ae18-3af3fff5ff34", "92420e25-bed4-58aa-9b65-c7c94c500448",
                   "43eec7ca-0ff7-5d77-9faa-6955bd8e6dc9", "1b00a6c8-24e9-5b0d-ae18-3af3fff5ff34",
                   "1b00a6c8-24e9-5b0d-ae18-3af3fff5ff34"]


def test_contract_cases(spark):
    b = spark.createDataFrame([("TRUE",), (" yes ",), ("0",), ("maybe",)], "x string")
    assert [r.v for r in b.select(to_bool("x").alias("v")).collect()] == [True, True, False, None]
    shifts = spark.createDataFrame([
        ("", ts("2026-01-10T08:00"), "l", "t", "e", "w", True, False, 0, -1.0, 0)], SHIFTS_SCHEMA)
    _, rej = B.validate(shifts, "shifts")
    v = set(rej.first().violations)
    assert {"id_nonempty", "hours_positive", "reward_nonnegative", "capacity_positive"} <= v
    ev = spark.createDataFrame([("not-a-uuid", "s", "u", "JUMP", None)], EVENTS_SCHEMA)
    _, rej = B.validate(ev, "events")
    assert {"id_uuid", "interaction_valid", "ts_valid"} <= set(rej.first().violations)
    acc, rej = B.validate(ev.unionByName(ev), "events", mode="batch")
    assert acc.count() == 0 and rej.count() == 2
    rep = spark.createDataFrame([("a", "s", "u", "VIEW", ts("2026-01-01T00:00"), 1),
                                 ("a", "s", "u", "APPLY", ts("2026-01-01T00:00"), 2)],
                                "id string, shift_id string, user_id string, interaction string, "
                                "ts timestamp_ntz, seq int")
    first = B.clean(rep, B.CRITICAL["events"], "id", ["seq"]).first().interaction
    from staffrank.operators.store import upsert
    last = upsert(rep.limit(0), rep, "id", batch_order=["seq"]).first().interaction
    assert (first, last) == ("VIEW", "APPLY")


def test_service_contract_case(spark):
    users = spark.createDataFrame([("u1", "loc-1", False, True)], USERS_SCHEMA)
    shifts = spark.createDataFrame([("s1", ts("2026-01-10T08:00"), "loc-1", "t", "e", "w", True, False, 8,
                                     100.0, 1)], SHIFTS_SCHEMA)
    events = spark.createDataFrame([("e1", "s1", "u1", "VIEW", ts("2026-01-09T08:00"))], EVENTS_SCHEMA)
    cands = C.candidates(shifts, C.user_activity(users, events))
    top = H.activity_recommend(cands, 10)
    assert [r.user_id for r in top.orderBy("rank").collect()] == ["u1"]
