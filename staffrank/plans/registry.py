"""Query registry: one entry per operator of the blueprint, each with a Spark callable
``(spark, sf_dir) -> DataFrame`` and, when the operator is SQL-expressible, a DuckDB oracle."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from staffrank.sources.tables import Domain, testdata_domain

QueryFn = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Callable[[Domain], DataFrame]) -> Callable[[Domain], DataFrame]:
        if name in _QUERIES:
            raise KeyError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return canon(fn(testdata_domain(spark, sf_dir)))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        _QUERIES[name] = run
        if sql is not None:
            _ORACLES[name] = sql
        return fn
    return deco


def register_raw(name: str, sql: str | None = None):
    """For queries that need the session or raw tables, not only the domain view."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise KeyError(f"duplicate query {name}")
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return canon(fn(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        _QUERIES[name] = run
        if sql is not None:
            _ORACLES[name] = sql
        return fn
    return deco


@lru_cache(maxsize=1)
def _load_all() -> None:
    # importing the modules fills the registry
    from staffrank.plans import (  # noqa: F401
        q_sources, q_candidates, q_history, q_labels, q_ranking, q_metric, q_profile, q_models,
        q_streaming)


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    _load_all()
    return dict(_ORACLES)


def canon(df: DataFrame) -> DataFrame:
    """Canonical result encoding shared with the oracle: timestamps and dates as text, floating
    values rounded to 6 digits, integral values as BIGINT."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    from staffrank.functions.expressions import fmt_date, fmt_ts

    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = fmt_ts(c)
        elif isinstance(t, T.DateType):
            c = fmt_date(c)
        elif isinstance(t, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = F.round(c.cast("double"), 6)
        elif isinstance(t, (T.IntegerType, T.ShortType, T.ByteType, T.LongType)):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(*cols)
