"""Checks of training data: findings as rows (check, severity, n), and the verdict over them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ISSUE, WARNING = "issue", "warning"


def missing(df: DataFrame, fields: Mapping[str, str]) -> DataFrame:
    """Rows that lack each field, by the name of the count, and all rows."""
    return df.agg(*(F.count_if(F.col(c).isNull()).alias(n) for n, c in fields.items()), F.count("*").alias("n"))


def split_share(df: DataFrame, split: str, expected: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Each split's rows and percent, and whether it is within its (percent, tolerance)."""
    counts = df.groupBy(split).agg(F.count("*").alias("n"))
    pct = 100.0 * F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(0)))
    ok = F.lit(False)
    for name, (share, tolerance) in expected.items():
        ok = F.when(F.col(split) == name, F.abs(F.col("pct") - share) <= tolerance).otherwise(ok)
    return counts.withColumn("pct", pct).withColumn("ok", ok)


def label_problems(df: DataFrame, label: str, lo: float = 0.0, hi: float = 10.0) -> DataFrame:
    c = F.col(label)
    return df.agg(F.count_if((c < lo) | ((c > hi) & ~F.isnan(c))).alias("out_of_range"), F.count_if(c.isNull() | F.isnan(c)).alias("missing"), F.count_if(c == 0).alias("zero"))


def blank(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Rows whose text is there but blank, for each column."""
    return df.agg(*(F.count_if(F.trim(c) == "").alias(n) for n, c in columns.items()))


def complete_scores(df: DataFrame, dims: Sequence[str]) -> DataFrame:
    whole = F.lit(True)
    for d in dims:
        whole = whole & F.col(d).isNotNull()
    return df.agg(F.count_if(whole).alias("complete"), F.count("*").alias("n"))


def same_dimensions(df: DataFrame, names: str, config: Sequence[str] | None = None) -> DataFrame:
    """How many lists of dimension names the rows have, and whether it is one, that of the configuration."""
    n = F.count_distinct(names)
    same = (n == 1) & (F.bool_and(F.col(names) == F.array(*map(F.lit, config))) if config is not None else F.lit(True))
    return df.agg(n.alias("distinct_names"), same.alias("consistent"))


def findings(df: DataFrame, checks: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """One row a check (check_name, severity, n): rows for which its condition holds. One pass over the table."""
    cells = F.array(*(F.struct(F.lit(n).alias("check_name"), F.lit(s).alias("severity"), F.count_if(c).alias("n")) for n, s, c in checks))
    return df.agg(cells.alias("p")).select(F.explode("p").alias("p")).select("p.*")


def verdict(found: DataFrame) -> DataFrame:
    """Issues fail, warnings pass."""
    issues, warnings = (F.count_if((F.col("severity") == s) & (F.col("n") > 0)) for s in (ISSUE, WARNING))
    return found.agg(issues.alias("issues"), warnings.alias("warnings"), (issues == 0).alias("passed"))


def hard_verify(df: DataFrame, text: str, key: str, probes: DataFrame, least: int = 300) -> DataFrame:
    """What must be nothing after filtering: short or blank rows, and rows of the probe set."""
    probe = probes.select(F.col(key).alias("probe_")).distinct()
    rows = df.join(probe, F.col(key) == F.col("probe_"), "left")
    return rows.agg(F.count_if(F.length(text) < least).alias("short"), F.count_if(F.trim(text) == "").alias("empty"), F.count_if(F.col("probe_").isNotNull()).alias("probes"), F.count("*").alias("n"))
