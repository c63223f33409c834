"""Summaries of scored rows: strata, distributions, votes, lenses. ``by`` are grouping columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def stratum_pct(df: DataFrame, stratum: Column, name: str) -> DataFrame:
    """Rows and percent of all for each stratum; only strata are added up, not rows."""
    counts = df.groupBy(stratum.alias(name)).agg(F.count("*").alias("n"))
    return counts.withColumn("pct", 100.0 * F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(0))))


def dim_stats(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Range, mean and sample deviation (0 for a single row)."""
    sd = F.coalesce(F.stddev_samp(value), F.lit(0.0))
    return df.groupBy(*by).agg(F.min(value).alias("lo"), F.max(value).alias("hi"), F.avg(value).alias("mean"), sd.alias("sd"))


def modal_stats(df: DataFrame, value: str, by: str, width: float = 0.5) -> DataFrame:
    """Mean, population deviation, and the fullest bin of a width (the lowest of equals) with its share."""
    bins = df.groupBy(by, (F.floor(F.col(value) / width) * width).alias("bin")).agg(F.count(value).alias("c"))
    modal = bins.groupBy(by).agg(F.max_by(F.struct("bin", "c"), F.struct("c", -F.col("bin"))).alias("m"), F.sum("c").alias("n"))
    stats = df.groupBy(by).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("sd"))
    return stats.join(modal, by).select(by, "mean", "sd", F.col("m.bin").alias("modal_bin"), (F.col("m.c").cast("double") / F.col("n")).alias("modal_share"))


def histogram(df: DataFrame, value: str, width: float) -> DataFrame:
    return df.groupBy(F.floor(F.col(value) / width).alias("bin")).agg(F.count("*").alias("n"))


def majority(df: DataFrame, key: str, votes: Sequence[Column], quorum: int = 3) -> DataFrame:
    """block or keep by a quorum of the votes that were cast, else split. A null vote counts for neither."""
    cells = F.array(*votes)
    yes, no = F.size(F.filter(cells, lambda v: v)), F.size(F.filter(cells, lambda v: ~v))
    return df.select(key, F.when(yes >= quorum, "block").when(no >= quorum, "keep").otherwise("split").alias("verdict"), yes.alias("yes"), (yes + no).alias("n"))


def consensus(df: DataFrame, key: str, scores: Sequence[Column]) -> DataFrame:
    """The median of a row's scores."""
    s = F.array_sort(F.filter(F.array(*scores), lambda x: x.isNotNull()))
    n = F.size(s)
    mid = lambda i: F.get(s, i.cast("int"))
    return df.select(key, ((mid(F.floor((n - 1) / 2)) + mid(F.floor(n / 2))) / 2).alias("consensus"))


def flag_rates(df: DataFrame, flags: Mapping[str, Column], by: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(*((F.count_if(c).cast("double") / F.count("*")).alias(n) for n, c in flags.items()))


def lens_summary(df: DataFrame, score: str, medium: float, high: float, by: Sequence[str]) -> DataFrame:
    m, h = F.count_if(F.col(score) >= medium), F.count_if(F.col(score) >= high)
    return df.groupBy(*by).agg(F.count("*").alias("n"), m.alias("medium"), h.alias("high"), (100.0 * m / F.count("*")).alias("medium_pct"))


def overlap_matrix(df: DataFrame, lenses: Mapping[str, Column], threshold: float) -> DataFrame:
    """For every two lenses: rows that both let through, and their percent of the first's. One pass, no self-join."""
    names = list(lenses)
    at = {n: lenses[n] >= threshold for n in names}
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
    both = lambda a, b: F.count_if(at[a] & at[b])
    cells = F.array(*(F.struct(F.lit(a).alias("la"), F.lit(b).alias("lb"), both(a, b).alias("n"), F.try_divide(100.0 * both(a, b), F.count_if(at[a])).alias("pct_a")) for a, b in pairs))
    return df.agg(cells.alias("p")).select(F.explode("p").alias("p")).select("p.*")


def exclusivity(df: DataFrame, lenses: Mapping[str, Column], threshold: float) -> DataFrame:
    """For each lens: rows that only it lets through, and all that it does."""
    at = {n: F.coalesce((c >= threshold).cast("int"), F.lit(0)) for n, c in lenses.items()}
    k = sum(list(at.values())[1:], list(at.values())[0])
    cells = F.array(*(F.struct(F.lit(n).alias("lens"), F.count_if((c == 1) & (k == 1)).alias("exclusive"), F.count_if(c == 1).alias("n")) for n, c in at.items()))
    return df.agg(cells.alias("p")).select(F.explode("p").alias("p")).select("p.*")


def combinations(df: DataFrame, lenses: Mapping[str, Column], threshold: float) -> DataFrame:
    """Rows for each combination of lenses that let them through."""
    combo = F.concat(*(F.when(c >= threshold, n).otherwise("") for n, c in lenses.items()))
    return df.groupBy(combo.alias("combo")).agg(F.count("*").alias("n"))


def false_positives(df: DataFrame, score: str, negative: Column, grid: Sequence[float], by: Sequence[str]) -> DataFrame:
    """For each group and threshold the negatives at or above it."""
    from lensmill.operators.metrics import sweep

    return sweep(df, score, grid, {"neg": negative}, by).select(*by, "th", F.col("neg_at").alias("fp"))


def index_quantiles(df: DataFrame, value: str, buckets: int | None = None) -> DataFrame:
    """The sorted column's values at the first, quarter, half, three-quarter and last index. No task sorts the column."""
    from lensmill.operators.ranking import values_at

    names, shares = ("lo", "p25", "p50", "p75", "hi"), (0.0, 0.25, 0.5, 0.75, 1.0)
    got = values_at(df, value, shares, buckets) or [None] * 5
    return df.sparkSession.createDataFrame([tuple(got)], ", ".join(f"{n} double" for n in names))
