"""Registered queries over the driver tables, each with its DuckDB oracle.

Every query reads whole tables (no id subsets, no row caps) and exercises
one group of warehouse operators; the oracle is independent SQL computing
the same result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def _load_all() -> None:
    # Importing the modules fills the registry.
    from . import (q_marts, q_clean, q_load, q_model, q_resolve, q_audit, q_assembly,  # noqa: F401
                   q_incremental)  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()
    return dict(sorted(QUERIES.items()))


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(sorted(ORACLES.items()))
