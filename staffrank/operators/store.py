"""Table store: last-write-wins upserts, counts, look-ups (B10-B15) and sinks.

Upserts rewrite a snapshot: ``base UNION batch`` reduced per key to the newest row by ingest
sequence, with a partially aggregated ``max`` (skew-safe for hot keys).
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def pick_per_key(df: DataFrame, keys: list[str], order: list[str], newest: bool) -> DataFrame:
    """One row per key: the row with the largest (``newest``) or smallest ``order`` values,
    ties broken by the whole row, so the choice is deterministic.

    Written as ``max`` / ``min`` of a struct, an aggregate with map-side partial aggregation:
    a key holding a third of all rows leaves one candidate per map task instead of sending all
    its rows to one sorting task, as ``row_number() over (partition by key)`` would.
    """
    cols = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                      F.struct(*[F.col(c) for c in cols]).alias("_row"))
    best = F.max(packed) if newest else F.min(packed)
    out = df.groupBy(*keys).agg(best.alias("_p"))
    return out.select(*keys, *[F.col(f"_p._row.{c}").alias(c) for c in cols])


def upsert(base: DataFrame, batch: DataFrame, key: list[str] | str = "id",
           batch_order: list[str] | None = None) -> DataFrame:
    """Last write wins per ``key``; every non-key column is replaced.

    Inside one batch, later rows (by ``batch_order``) win over earlier ones, as a sequence of
    single-row statements would.
    """
    keys = [key] if isinstance(key, str) else list(key)
    cols = base.columns
    extra = [c for c in (batch_order or []) if c not in cols]
    b0 = base.select(*cols, *[F.lit(None).cast(batch.schema[c].dataType).alias(c) for c in extra]
                     ).withColumn("__src", F.lit(0))
    b1 = batch.select(*cols, *extra).withColumn("__src", F.lit(1))
    order = ["__src"] + list(batch_order or [])
    return pick_per_key(b0.unionByName(b1), keys, order, newest=True).select(*cols)


def accepted(batch: DataFrame) -> int:
    """Accepted count = batch rows (not distinct keys)."""
    return batch.count()


def table_counts(**tables: DataFrame) -> DataFrame:
    """(table_name, rows)."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table_name"), "rows")
             for n, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def users_by_ids(users: DataFrame, ids: DataFrame, id_col: str = "user_id") -> DataFrame:
    """Attributes of the users named in ``ids`` (semi join; duplicates in ids ignored)."""
    return users.join(ids.select(F.col(id_col).alias("id")), "id", "left_semi")


# ------------------------------------------------------------------------------------ sinks

def write_table(df: DataFrame, path: str, name: str, mode: str = "overwrite") -> str:
    """A5: persist a base table as Parquet; events are partitioned by event date so day slices
    and time splits prune files."""
    out = f"{path.rstrip('/')}/{name}"
    w = df.write.mode(mode)
    if name == "events" and "ts" in df.columns:
        df = df.withColumn("event_date", F.to_date("ts"))
        w = df.write.mode(mode).partitionBy("event_date")
    w.parquet(out)
    return out


def write_split(parts: dict[str, DataFrame], path: str, fmt: str = "parquet") -> list[str]:
    """Write the split outputs (train/val shifts and events, apply, users)."""
    outs = []
    for name, df in parts.items():
        out = f"{path.rstrip('/')}/{name}"
        wr = df.write.mode("overwrite")
        if fmt == "csv":
            wr.option("header", True).csv(out)
        else:
            wr.parquet(out)
        outs.append(out)
    return outs


def write_run(spark: SparkSession, path: str, run_id: str, **results) -> str:
    """Persist run metrics / feature schema / config / checks as small JSON tables.

    Values are small dicts or lists (a handful of rows); DataFrames are written as they are.
    """
    out = f"{path.rstrip('/')}/{run_id}"
    for name, val in results.items():
        if isinstance(val, DataFrame):
            val.coalesce(1).write.mode("overwrite").json(f"{out}/{name}")
            continue
        rows = val if isinstance(val, list) else [val]
        df = spark.createDataFrame([(json.dumps(r, default=str, sort_keys=True),) for r in rows],
                                   "value string")
        df.coalesce(1).write.mode("overwrite").text(f"{out}/{name}")
    return out
