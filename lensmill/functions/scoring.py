"""Score math: clamp, weighted average, gatekeeper, tiers, lookup-table interpolation, calibration, normalization."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Scoring:
    """How a package turns dimension scores into a tier."""

    name: str
    version: int
    weights: tuple[float, ...]
    gate: int | None = None  # position of the gatekeeper dimension
    gate_min: float = 3.0
    gate_cap: float = 3.0
    tiers: tuple[tuple[str, float], ...] = (("high", 7.0), ("medium", 4.0), ("low", 0.0))

    def problems(self) -> list[str]:
        """Driver-side check before use: weights sum to one, tiers fall, the gate is a dimension."""
        out = []
        if abs(sum(self.weights) - 1) > 0.01:
            out.append(f"weights sum to {sum(self.weights):.3f}")
        if [t for _, t in self.tiers] != sorted((t for _, t in self.tiers), reverse=True):
            out.append("tiers are not in falling order")
        if self.gate is not None and not 0 <= self.gate < len(self.weights):
            out.append("the gate is no dimension")
        return out


# Weights, gate and thresholds of the deployed scorers, which results must match.
DEPLOYED = (
    Scoring("uplifting", 7, (0.30, 0.20, 0.15, 0.10, 0.10, 0.15), 2, 3.0, 3.0),
    Scoring("belonging", 1, (0.25, 0.25, 0.10, 0.15, 0.15, 0.10), 1, 3.0, 3.42),
    Scoring("nature_recovery", 4, (0.25, 0.20, 0.20, 0.15, 0.10, 0.10), 0, 3.0, 3.5, (("high", 7.0), ("medium", 3.75), ("low", 0.0))),
    Scoring("sustainability_technology", 3, (0.15, 0.15, 0.20, 0.30, 0.10, 0.10), 0, 3.0, 2.2),
    Scoring("investment_risk", 6, (0.20, 0.25, 0.15, 0.15, 0.15, 0.10), 3, 4.0, 2.9),
    Scoring("cultural_discovery", 5, (0.25, 0.20, 0.25, 0.15, 0.15), 2, 3.0, 4.0),
    Scoring("foresight", 1, (0.25, 0.20, 0.20, 0.15, 0.10, 0.10), 3, 3.0, 3.0),
)


def clamp(c: Column, lo: float = 0.0, hi: float = 10.0) -> Column:
    """NaN, which sorts above every number, becomes ``hi``."""
    return F.greatest(F.lit(lo), F.least(F.lit(hi), c))


def weighted_average(dims: Sequence[Column], weights: Sequence[float]) -> Column:
    """Left to right, so that results do not depend on the plan."""
    return reduce(lambda a, b: a + b, (d * F.lit(float(w)) for d, w in zip(dims, weights, strict=True)))


def gated(wa: Column, gate: Column, low: float, cap: float) -> tuple[Column, Column]:
    """(average, whether the gatekeeper was applied): strictly below the minimum, the average stops at the cap."""
    hit = (gate < low) & (wa > cap)
    return F.when(hit, F.lit(cap)).otherwise(wa), hit


def tier(wa: Column, tiers: Sequence[tuple[str, float]], fallback: str = "low") -> Column:
    return reduce(lambda out, t: out.when(wa >= t[1], t[0]), tiers[1:], F.when(wa >= tiers[0][1], tiers[0][0])).otherwise(fallback)


def interpolate(v: Column, xs: Sequence[float], ys: Sequence[float]) -> Column:
    """Linear between the points, constant beyond them. The points are literals of the expression, so nothing is joined."""
    x, y, n = F.array(*map(F.lit, map(float, xs))), F.array(*map(F.lit, map(float, ys))), len(xs)
    j = F.greatest(F.lit(1), F.least(F.size(F.filter(x, lambda e: e <= v)), F.lit(n - 1)))
    x0, x1, y0, y1 = F.get(x, j - 1), F.get(x, j), F.get(y, j - 1), F.get(y, j)
    inside = y0 + (v - x0) * (y1 - y0) / F.nullif(x1 - x0, F.lit(0.0))
    return F.when(v <= float(xs[0]), F.lit(float(ys[0]))).when(v >= float(xs[-1]), F.lit(float(ys[-1]))).otherwise(inside)


def calibrate(v: Column, xs: Sequence[float], ys: Sequence[float]) -> Column:
    """Interpolation; what is no finite number becomes 0."""
    finite = ~F.isnan(v) & (F.abs(v) != float("inf"))
    return F.when(finite, interpolate(v, xs, ys)).otherwise(F.lit(0.0))


def fit_calibration(df: DataFrame, label: str, feature: str):
    """(boundaries, predictions) of an isotonic fit, without interior points on a flat stretch."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import IsotonicRegression

    rows = VectorAssembler(inputCols=[feature], outputCol="_f").transform(df.select(label, feature))
    m = IsotonicRegression(featuresCol="_f", labelCol=label).fit(rows)
    xs, ys = list(m.boundaries), list(m.predictions)
    keep = [i for i in range(len(xs)) if i in (0, len(xs) - 1) or ys[i] != ys[i - 1] or ys[i] != ys[i + 1]]
    return [float(xs[i]) for i in keep], [float(ys[i]) for i in keep]


def fit_normalization(df: DataFrame, column: str, points: int = 200, anchor: float | None = None) -> DataFrame:
    """The lookup table (k, x, y): share of rows at or below x, times 10, on an even grid of the observed range.

    Each row is counted once, at the first grid point that is not below it (partial aggregation), and a running sum over
    the ``points`` counts gives the shares; nothing is crossed with the data.
    """
    v = df.select(F.col(column).cast("double").alias("v")).filter(~F.isnan("v") & F.col("v").isNotNull())
    span = v.agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("*").alias("n"))
    from pyspark.sql import Window

    step = (F.col("hi") - F.col("lo")) / (points - 1)
    grid = span.select(F.posexplode(F.sequence(F.lit(0), F.lit(points - 1))).alias("k", "_"), "lo", "hi", "n").select("k", F.when(F.col("k") == points - 1, F.col("hi")).otherwise(F.col("lo") + F.col("k") * step).alias("x"), "n")
    at = F.when(F.col("hi") == F.col("lo"), 0).otherwise(F.ceil((F.col("v") - F.col("lo")) / step)).cast("int")
    near = v.join(F.broadcast(span)).withColumn("k", F.greatest(F.lit(0), F.least(at, F.lit(points - 1))))
    # rounding may be off by one point: decide by comparing with the grid's own numbers
    point = lambda k: F.when(k == points - 1, F.col("hi")).otherwise(F.col("lo") + k * step)
    near = near.withColumn("k", F.when((F.col("k") > 0) & (F.col("v") <= point(F.col("k") - 1)), F.col("k") - 1).when(F.col("v") > point(F.col("k")), F.col("k") + 1).otherwise(F.col("k")))
    counts = near.groupBy("k").agg(F.count("*").alias("c"))
    w = Window.partitionBy(F.lit(0)).orderBy("k")
    out = grid.join(counts, "k", "left").withColumn("y", F.sum(F.coalesce("c", F.lit(0))).over(w) / F.col("n") * 10)
    table = out.select(F.col("k").cast("bigint").alias("k"), F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))
    if anchor is not None:
        first = df.sparkSession.createDataFrame([(-1, float(anchor), 0.0)], "k bigint, x double, y double")
        table = first.unionByName(table)
    return table


def proportional_cap(labels: Column, wa: Column, target: float = 2.0) -> Column:
    """Scale all labels so that the average comes down to ``target``; averages at or below it stay."""
    return F.when(wa > target, F.transform(labels, lambda x: F.bround(x * (F.lit(target) / wa), 2))).otherwise(labels)


def score(df: DataFrame, dims: Sequence[str], s: Scoring) -> DataFrame:
    """Adds weighted_average, gatekeeper_applied and tier: one projection, no shuffle."""
    clamped = [clamp(F.col(d)) for d in dims]
    wa = weighted_average(clamped, s.weights)
    if s.gate is None:
        out, hit = wa, F.lit(False)
    else:
        out, hit = gated(wa, clamped[s.gate], s.gate_min, s.gate_cap)
    made = df.withColumns({"weighted_average": out, "gatekeeper_applied": hit})
    return made.withColumn("tier", tier(F.col("weighted_average"), s.tiers))


#: The result of a row that a prefilter rejects: every field is there, and says nothing.
EMPTY_RESULT = "struct<scores:array<double>,weighted_average:double,tier:string,tier_description:string,gatekeeper_applied:boolean,passed_prefilter:boolean,prefilter_reason:string>"


def empty_result(reason: Column) -> Column:
    """``EMPTY_RESULT`` for a row rejected for ``reason``; null for a row that is not."""
    null = lambda t: F.lit(None).cast(t)
    return F.when(
        reason.isNotNull(),
        F.struct(
            null("array<double>").alias("scores"), null("double").alias("weighted_average"), null("string").alias("tier"), null("string").alias("tier_description"),
            F.lit(False).alias("gatekeeper_applied"), F.lit(False).alias("passed_prefilter"), reason.alias("prefilter_reason"),
        ).cast(EMPTY_RESULT),
    )
