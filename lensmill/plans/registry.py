"""Query registry: a name, a Spark plan, and the SQL that gives the same rows."""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

_FOUND: dict[str, Query] = {}
MODULES: tuple[str, ...] = ("q_text", "q_rules", "q_scores", "q_stats", "q_relate", "q_vectors", "q_io")


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


def query(name: str, sql: str | None = None):
    """Register the decorated function as query ``name``."""

    def add(f: Callable[[SparkSession, str], DataFrame]):
        if name in _FOUND:
            raise ValueError(f"{name} is registered twice")
        _FOUND[name] = Query(name, f, sql)
        return f

    return add


def load() -> dict[str, Query]:
    for m in MODULES:
        importlib.import_module(f"lensmill.plans.{m}")
    return _FOUND
