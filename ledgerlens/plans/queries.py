"""Registry of named queries: name -> (Tables -> DataFrame) plus its oracle SQL.

Each query reads the given test tables through ``Tables`` (whole tables, no
row caps) and returns a lazy DataFrame.  ``oracle`` is the DuckDB SQL that must
give the same rows; ``None`` marks queries that are checked rows-only (model
training, clustering) and by unit tests instead.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.plans.tables import Tables


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    oracle: str | None


REGISTRY: dict[str, Query] = {}


def register(name: str, oracle: str | None):
    def deco(fn: Callable[[Tables], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, oracle)
        return fn
    return deco


def _load_all() -> None:
    # importing the modules fills REGISTRY
    from ledgerlens.plans import q_cases, q_classes, q_graph, q_ml, q_profile  # noqa: F401
    from ledgerlens.plans import q_sources, q_temporal, q_wallets, q_metrics  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()
    return {name: (lambda spark, sf_dir, q=q: q.build(Tables(spark, sf_dir)))
            for name, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {name: q.oracle for name, q in REGISTRY.items() if q.oracle is not None}
