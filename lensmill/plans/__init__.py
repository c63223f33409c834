"""Registered queries: each a Spark plan and, where SQL can express it, the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lensmill.plans import registry


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: q.run for name, q in registry.load().items()}


def oracle_sql() -> dict[str, str]:
    return {name: q.sql for name, q in registry.load().items() if q.sql}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.load()["score_pipeline"].run(spark, sf_dir)
