"""Derived rows beside all real ones, for cases that the given tables lack (``sqlkit`` has the SQL twins)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _marked(df: DataFrame, mark: str, *columns: str) -> DataFrame:
    return df.withColumns({c: F.concat(F.lit(mark), F.col(c)) for c in columns})


def _nth(events: DataFrame, n: int, rest: int = 0) -> DataFrame:
    return events.where(F.col("id").cast("bigint") % n == rest)


def with_orphans(events: DataFrame) -> DataFrame:
    """Also a copy of every tenth event, of a shift that no table has."""
    return events.unionByName(_marked(_marked(_nth(events, 10), "o", "id"), "gone_", "shift_id"))


def with_timeless(events: DataFrame) -> DataFrame:
    """Also users whose events have no times."""
    return events.unionByName(_marked(_nth(events, 4), "t", "id", "user_id").withColumn("ts", F.lit(None).cast("timestamp_ntz")))


def with_unpaid(events: DataFrame, shifts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Also users of shifts with unknown rewards only, and users who never applied."""
    free = _marked(shifts, "n", "id").withColumn("reward", F.lit(None).cast("double"))
    idle = _nth(events, 4, 1).where("interaction <> 'APPLY'")
    return (events.unionByName(_marked(_nth(events, 4), "n", "id", "shift_id", "user_id"))
            .unionByName(_marked(idle, "v", "id", "user_id")), shifts.unionByName(free))


def with_unwanted(events: DataFrame, shifts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Also employers whose shifts were seen but never applied to."""
    seen = _nth(events, 4).where("interaction <> 'APPLY'")
    return (events.unionByName(_marked(seen, "w", "id", "shift_id")),
            shifts.unionByName(_marked(shifts, "w", "id", "employer_id")))


def with_unscored(cands: DataFrame) -> DataFrame:
    """Also candidates whom no table knows, behind the real ones."""
    twice = F.explode(F.when(F.col("cand_rank") % 5 == 0, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False))))
    new = F.col("_new")
    return cands.withColumn("_new", twice).withColumns({
        "user_id": F.when(new, F.concat(F.lit("u"), F.col("user_id"))).otherwise(F.col("user_id")),
        "cand_rank": F.when(new, F.col("cand_rank") + 1000).otherwise(F.col("cand_rank"))}).drop("_new")
