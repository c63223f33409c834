"""Deterministic sampling and splitting by hash order: the same rows on every run, whatever the partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lensmill.functions.text import hash_bucket, order_hash
from lensmill.operators import ranking


def in_order(key: str, seed: int = 42) -> Column:
    return order_hash(F.col(key), seed)


def stratified_split(df: DataFrame, stratum: str, key: str, ratios: Sequence[float] = (0.8, 0.1, 0.1), seed: int = 42) -> DataFrame:
    """Adds ``split``: in each stratum the first int(n * train) rows in hash order, up to int(n * (train + val)), and the rest.

    No task holds a stratum: its rows are numbered by buckets of the hash.
    """
    if abs(sum(ratios) - 1) > 0.01:
        raise ValueError("ratios must sum to 1")
    k, n, s = (ranking.fresh([*df.columns, "split"], c) for c in ("k", "n", "s"))
    sizes = df.groupBy(F.col(stratum).alias(s)).agg(F.count("*").alias(n))
    placed = ranking.by_hash_order(df, in_order(key, seed), [stratum], k).join(F.broadcast(sizes), F.col(stratum).eqNullSafe(F.col(s)))
    train, upto = F.floor(F.col(n) * F.lit(ratios[0])), F.floor(F.col(n) * (F.lit(ratios[0]) + F.lit(ratios[1])))
    return placed.withColumn("split", F.when(F.col(k) < train, "train").when(F.col(k) < upto, "val").otherwise("test")).drop(k, n, s)


def hash_holdout(key: Column, fraction: float) -> Column:
    """Whether a row is held out: decided by the row alone, with no shuffle."""
    return hash_bucket(key) < int(fraction * 10000)


def random_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows in hash order (a top-k, which keeps n rows a task)."""
    return df.orderBy(in_order(key, seed)).limit(n)


def per_group(df: DataFrame, group: Sequence[str], key: str, quota: Column | int, seed: int = 42) -> DataFrame:
    """Up to ``quota`` rows of each group in hash order; ``_k`` is the place of a row in its group."""
    k = F.row_number().over(Window.partitionBy(*group).orderBy(in_order(key, seed)))
    return df.withColumn("_k", k).filter(F.col("_k") <= quota)


def batches(df: DataFrame, key: str, size: int, seed: int = 42) -> DataFrame:
    """Adds ``batch``, ``size`` rows each in hash order; rows are numbered by buckets of the hash."""
    k = ranking.fresh([*df.columns, "batch"], "k")
    return ranking.by_hash_order(df, in_order(key, seed), [], k).withColumn("batch", F.floor(F.col(k) / size)).drop(k)


def round_robin(df: DataFrame, group: str, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows, one of each group in turn."""
    k = F.row_number().over(Window.partitionBy(group).orderBy(in_order(key, seed)))
    return df.withColumn("_k", k).orderBy("_k", group).limit(n)
