"""Vector math on array columns: no Python, no explosion of the data where a row is enough."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lensmill.operators.relate import dot


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def unit(a: Column) -> Column:
    n = norm(a)
    return F.transform(a, lambda x: x.cast("double") / F.nullif(n, F.lit(0.0)))


def centroid(df: DataFrame, vec: str, dims: int) -> DataFrame:
    """One row with the unit-length mean: one aggregation of ``dims`` averages, with partial sums before the shuffle."""
    mean = F.array(*(F.avg(F.get(F.col(vec), F.lit(i)).cast("double")) for i in range(dims)))
    return df.agg(mean.alias("m")).select(unit(F.col("m")).alias("centroid"))


def with_cosine(df: DataFrame, vec: str, center: DataFrame, into: str = "sim") -> DataFrame:
    """Cosine of unit vectors to a centroid: one row, sent to every executor."""
    return df.join(F.broadcast(center.select(F.col("centroid").alias("_c")))).withColumn(into, dot(F.col(vec), F.col("_c"))).drop("_c")


def standardize(v: Column, mean: Column, std: Column) -> Column:
    return F.zip_with(F.zip_with(v, mean, lambda a, b: a.cast("double") - b), std, lambda a, b: a / F.nullif(b, F.lit(0.0)))


def pooled(chunks: Column, strategy: str) -> Column:
    """Pool an ordered array of vectors: mean, max, min, mean_max, first_last, weighted_position, mean_std, all_concat ..."""
    n = F.size(chunks)
    first, last, middle = F.get(chunks, F.lit(0)), F.get(chunks, n - 1), F.get(chunks, F.floor(n / 2).cast("int"))
    zero = F.transform(first, lambda x: x.cast("double") * 0)

    def fold(f, start=zero):
        return F.aggregate(chunks, start, lambda a, c: F.zip_with(a, c, f))

    add = lambda a, x: a + x.cast("double")
    mean = F.transform(fold(add), lambda x: x / n)
    double = F.transform(first, lambda x: x.cast("double"))
    top, low = fold(lambda a, x: F.greatest(a, x.cast("double")), double), fold(lambda a, x: F.least(a, x.cast("double")), double)
    square = F.aggregate(chunks, zero, lambda a, c: F.zip_with(a, c, lambda s, x: s + x.cast("double") * x.cast("double")))
    std = F.zip_with(square, mean, lambda s, m: F.sqrt(F.greatest(s / n - m * m, F.lit(0.0))))
    weights = n * (n + 1) / F.lit(2.0)
    falling = F.transform(F.aggregate(F.transform(chunks, lambda c, i: F.struct(c.alias("c"), (n - i).alias("w"))), zero, lambda a, p: F.zip_with(a, p["c"], lambda s, x: s + x.cast("double") * p["w"])), lambda x: x / weights)
    by_norm = F.slice(F.transform(F.reverse(F.sort_array(F.transform(chunks, lambda c, i: F.struct(norm(c).alias("k"), (-i).alias("i"), c.alias("c"))))), lambda s: s["c"]), 1, 2)
    cast = lambda a: F.transform(a, lambda x: x.cast("double"))

    def percentile(p: float) -> Column:
        """Of each dimension over the chunks, linear between neighbours."""
        at = (n - 1) * F.lit(p)
        lo = F.floor(at).cast("int")

        def one(s: Column) -> Column:
            return F.get(s, lo) + (F.get(s, F.least(lo + 1, n - 1)) - F.get(s, lo)) * (at - lo)

        return F.transform(first, lambda _, i: F.get(F.transform(F.array(F.array_sort(F.transform(chunks, lambda c: F.get(c, i).cast("double")))), one), F.lit(0)))

    forms = {
        "mean": mean, "max": top, "min": low, "mean_max": F.concat(mean, top), "min_max": F.concat(low, top), "first_last": F.concat(cast(first), cast(last)),
        "first_middle_last": F.concat(cast(first), cast(middle), cast(last)), "weighted_position": falling, "mean_std": F.concat(mean, std),
        "top2_norm": F.concat(cast(F.get(by_norm, F.lit(0))), cast(F.coalesce(F.get(by_norm, F.lit(1)), F.get(by_norm, F.lit(0))))), "all_concat": F.concat(mean, top, low, std), "percentile_25_75": F.concat(percentile(0.25), percentile(0.75)),
    }
    return forms[strategy]


STRATEGIES = ("mean", "max", "min", "mean_max", "min_max", "first_last", "first_middle_last", "weighted_position", "mean_std", "top2_norm", "all_concat", "percentile_25_75")


def chunk_score(chunk: Column, mean: Column, position: Column, method: str) -> Column:
    """Importance of a chunk: norm, variance, distance to the document's mean, or its place."""
    n = F.size(chunk)
    avg = F.aggregate(chunk, F.lit(0.0), lambda a, x: a + x.cast("double")) / n
    return {
        "norm": norm(chunk),
        "variance": dot(chunk, chunk) / n - avg * avg,
        "centroid": -norm(F.zip_with(chunk, mean, lambda a, b: a.cast("double") - b)),
        "first": -position.cast("double"),
    }[method]


def mlp(layers: Sequence[tuple[np.ndarray, np.ndarray]]):
    """An Arrow UDF: ReLU between the layers, none after the last. Weights travel with the task, once."""

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def forward(v: pd.Series) -> pd.Series:
        x = np.stack(v.to_numpy()).astype(float)
        for i, (w, b) in enumerate(layers):
            x = x @ w + b
            if i + 1 < len(layers):
                x = np.maximum(x, 0)
        return pd.Series(list(x))

    return forward


def pca(df: DataFrame, columns: Sequence[str]) -> list[tuple[int, float, float, int]]:
    """(component, share of variance, cumulative share, components for 95 %): one aggregation, then a small matrix on the driver."""
    k = len(columns)
    cells = [F.corr(a, b).alias(f"c{i}_{j}") for i, a in enumerate(columns) for j, b in enumerate(columns) if i <= j]
    row = df.agg(*cells).first()
    m = np.array([[row[f"c{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)])
    e = np.sort(np.linalg.eigvalsh(m))[::-1]
    share = e / e.sum()
    cum = np.cumsum(share)
    return [(i, float(share[i]), float(cum[i]), int(np.searchsorted(cum, 0.95) + 1)) for i in range(k)]
