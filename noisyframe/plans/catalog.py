"""Registered queries: one per operator, each with its DuckDB oracle when SQL can say it.

Every query reads the driver tables at ``sf_dir`` (whole tables, no id subsets)
and returns a DataFrame whose computed columns are aliased to the names used by
the oracle SQL.  Doubles are rounded to 6 places on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import sqlparts as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _load_all() -> None:
    # importing the modules registers their queries
    from . import q_labels, q_features, q_sampling, q_latent, q_learning, q_rates, q_noisy, q_multi, q_engine, q_classes  # noqa: F401


def queries() -> dict:
    _load_all()
    return dict(QUERIES)


def oracle_sql() -> dict:
    _load_all()
    return dict(ORACLE)


__all__ = ["register", "queries", "oracle_sql", "S"]
