"""Ranks over a whole table without one task that holds it.

Rows fall into buckets of a column by its approximate quantiles, or of a hash by its first digits. Buckets are counted,
running totals over the few buckets give each one's start, and rows are ranked within their bucket only. For ranks with
ties rows are first counted by value, so a value that a third of all rows share is one row.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_BUCKET = 500_000
MOST_BUCKETS = 256


def fresh(columns: Sequence[str], name: str) -> str:
    """``name``, with lines appended until it is none of ``columns``."""
    used = {c.lower() for c in columns}
    while name.lower() in used:
        name += "_"
    return name


def by_quantile(df: DataFrame, column: str, buckets: int | None = None) -> Column:
    """The bucket of a row: how many of the column's approximate quantiles it reaches. The driver gets these only."""
    n = buckets or min(MOST_BUCKETS, 1 + df.count() // ROWS_PER_BUCKET)
    cuts = sorted(set(df.approxQuantile(column, [k / n for k in range(1, n)], 0.1 / n))) if n > 1 else []
    return reduce(lambda a, b: a + b, ((F.col(column) >= c).cast("int") for c in cuts), F.lit(0))


def numbered(rows: DataFrame, group: Sequence[str], bucket: str, order: Sequence[Column | str], name: str) -> DataFrame:
    """``rows`` with their number (from 0) within ``group``, in order of (bucket, order)."""
    n, start = fresh([*rows.columns, name], "n"), fresh([*rows.columns, name], "start")
    before = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    at = Window.partitionBy(*group, bucket).orderBy(*order)
    starts = rows.groupBy(*group, bucket).agg(F.count("*").alias(n)).withColumn(start, F.coalesce(F.sum(n).over(before), F.lit(0))).drop(n)
    keys = [*group, bucket]
    on = reduce(lambda a, b: a & b, (F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys))
    joined = rows.alias("l").join(starts.alias("r"), on).select("l.*", f"r.{start}")
    return joined.withColumn(name, F.col(start) + F.row_number().over(at) - 1).drop(start)


def row_numbers(df: DataFrame, column: str, ties: Sequence[str], name: str = "row", buckets: int | None = None) -> DataFrame:
    """Adds the number (from 0) of each row in order of (column, ties). ``ties`` should tell rows apart."""
    b = fresh([*df.columns, name], "bucket")
    return numbered(df.withColumn(b, by_quantile(df, column, buckets)), [], b, [column, *ties], name).drop(b)


def by_hash_order(df: DataFrame, key: Column, group: Sequence[str], name: str, digits: int = 3) -> DataFrame:
    """Adds the number (from 0) of each row within ``group`` in order of a hex digest ``key``: buckets by its first digits."""
    h, b = fresh([*df.columns, name], "h"), fresh([*df.columns, name], "bucket")
    rows = df.withColumn(h, key).withColumn(b, F.substring(h, 1, digits))
    return numbered(rows, group, b, [h], name).drop(h, b)


def value_places(df: DataFrame, column: str, buckets: int | None = None) -> DataFrame:
    """One row for each value: the value, ``n`` rows that have it, ``before`` rows with smaller ones, ``total``. No nulls."""
    values = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    values = values.withColumn("bucket", by_quantile(values, "value", buckets))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = values.groupBy("bucket").agg(F.sum("n").alias("m"))  # at most MOST_BUCKETS rows from here on
    starts = totals.withColumns({"start": F.coalesce(F.sum("m").over(before), F.lit(0)), "total": F.sum("m").over(Window.partitionBy(F.lit(0)))})
    inner = Window.partitionBy("bucket").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    placed = values.join(F.broadcast(starts), "bucket")
    return placed.select("value", "n", (F.col("start") + F.coalesce(F.sum("n").over(inner), F.lit(0))).alias("before"), "total")


def _placed(df: DataFrame, column: str, name: str, value: Column, buckets: int | None) -> DataFrame:
    v = fresh([*df.columns, name], "value")
    places = value_places(df, column, buckets).select(F.col("value").alias(v), value.alias(name))
    return df.join(places, F.col(column) == F.col(v), "left").drop(v)


def avg_rank(df: DataFrame, column: str, name: str = "avg_rank", buckets: int | None = None) -> DataFrame:
    """Adds the rank (from 1) of ``column``; equal values share the mean of their ranks, nulls have none."""
    return _placed(df, column, name, (F.col("before") + (F.col("n") + 1) / 2.0).cast("double"), buckets)


def ecdf(df: DataFrame, column: str, name: str = "ecdf", buckets: int | None = None) -> DataFrame:
    """Adds the share of rows with a value up to this one; nulls count for nothing and have none."""
    return _placed(df, column, name, (F.col("before") + F.col("n")) / F.col("total"), buckets)


def slices(df: DataFrame, column: str, ties: Sequence[str], k: int, name: str = "slice", buckets: int | None = None) -> DataFrame:
    """Adds the slice (0 to k - 1) of each row: its number in order times k over the rows, rounded down."""
    row, n = fresh([*df.columns, name], "row"), df.count()
    return row_numbers(df, column, ties, row, buckets).withColumn(name, F.floor(F.col(row) * k / F.lit(max(n, 1)))).drop(row)


def values_at(df: DataFrame, column: str, shares: Sequence[float], buckets: int | None = None) -> list:
    """The sorted column's values at floor(n * share), the last one for 1; [] for an empty column."""
    places = value_places(df, column, buckets)
    n = df.filter(F.col(column).isNotNull()).count()
    at = [min(int(n * s), n - 1) for s in shares]
    wanted = F.array(*(F.lit(a) for a in at))
    hits = places.filter(F.exists(wanted, lambda a: (a >= F.col("before")) & (a < F.col("before") + F.col("n")))).collect() if n else []
    return [next(r["value"] for r in hits if r["before"] <= a < r["before"] + r["n"]) for a in at] if n else []


def top_n(df: DataFrame, order: Sequence[Column], n: int, name: str = "k") -> DataFrame:
    """The first ``n`` rows with their place (from 1): a top-k keeps n rows a task, and only those n are numbered."""
    return df.orderBy(*order).limit(n).withColumn(name, F.row_number().over(Window.orderBy(*order)))
