"""Flagship chain: activity ranking -> candidates -> top-10 -> rank score -> truth -> metric.

"Activity-ranked top-10 per validation shift, scored with the regulation metric":
history = events at or before T (F15), C1 -> C4 (limit 300, fallback below 50 users) over the
validation shifts, H4 top 10, H5 rank score, F16 truth, I1 label, I2-I5 metric.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from staffrank.operators import candidates as C
from staffrank.operators import metric as M
from staffrank.operators import ranking as H
from staffrank.operators import splits as S
from staffrank.sources.tables import Domain

# The validation split used with the test-data mapping.
SPLIT_T = "2024-01-16 00:00:00"
CANDIDATE_LIMIT = 300
MIN_LOCAL = 50
EXTRA = 500
TOP_N = 10


def activity_frame(d: Domain, t: str = SPLIT_T, limit: int = CANDIDATE_LIMIT,
                   top: int = TOP_N) -> DataFrame:
    """Labelled metric frame (shift_id, user_id, rank, score, start_at, capacity, target)."""
    sp = S.date_split(d.shifts, d.events, t)
    act = C.user_activity(d.users, sp.train_events)
    cands = C.candidates(sp.val_shifts, act, limit, MIN_LOCAL, EXTRA)
    topn = H.rank_score(H.activity_recommend(cands, top))
    truth = S.ground_truth(d.events, sp.val_shifts)
    return M.label(topn.select("shift_id", "user_id", "rank", "score"), truth, sp.val_shifts)


def activity_metric(d: Domain, t: str = SPLIT_T) -> DataFrame:
    """One row: target_metric, evaluated_days, evaluated_groups, evaluated_shifts."""
    return M.target_metric(activity_frame(d, t))
