"""Queries checked by SQL over the views. Their plan is an operator of ``stat_plans`` where there is one, else the same text
for Catalyst; views are Spark DataFrames."""

from __future__ import annotations

import re
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lensmill.plans import views as V
from lensmill.plans.registry import query
from lensmill.plans.stat_plans import PLANS

TABLES = ("documents", "embeddings", "events", "pages", "labels", "benchmark", "conversations", "lineitem", "orders", "customer", "nation", "region", "part", "supplier")
BUILT = {"articles": V.articles, "scores": V.scores, "wa": V.with_wa, "long": V.long_scores}
CTES = {"articles": (V.ARTICLES,), "scores": (V.SCORES,), "wa": (V.SCORES, V.WA), "long": (V.SCORES, V.LONG)}


@cache
def _names(body: str) -> tuple[str, ...]:
    return tuple(dict.fromkeys(re.findall(r"\{(\w+)\}", body)))


def to_spark(body: str) -> str:
    # a number with a point is a double, not a decimal
    return re.sub(r"(?<![\w.])(\d+\.\d+)(?![\w.])", r"\1D", re.sub(r"\bsha256\((.*?)\)", r"sha2(\1, 256)", re.sub(r"\bPCT\(", "percentile(", body)))


def to_sql(body: str) -> str:
    ctes: list[str] = []
    for n in _names(body):
        ctes += [c for c in CTES.get(n, ()) if c not in ctes]
    text = re.sub(r"\{(\w+)\}", r"\1", re.sub(r"\bPCT\(", "quantile_cont(", body)).strip()
    if not ctes:
        return text
    return "WITH " + ",\n".join(ctes) + (",\n" + text[4:] if text[:4].upper() == "WITH" else "\n" + text)


def run(spark: SparkSession, d: str, body: str) -> DataFrame:
    frames = {n: BUILT[n](spark, d) if n in BUILT else V.table(spark, d, n) for n in _names(body)}
    return spark.sql(to_spark(body), **frames)


class Frames:
    """The views and tables of one folder by name."""

    def __init__(self, spark: SparkSession, d: str):
        self.spark, self.d = spark, d

    def __getattr__(self, name: str) -> DataFrame:
        return BUILT[name](self.spark, self.d) if name in BUILT else V.table(self.spark, self.d, name)


def rounded(df: DataFrame) -> DataFrame:
    return df.select(*(F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))


def portable(name: str, body: str) -> None:
    plan = PLANS.get(name)
    query(name, to_sql(body))((lambda spark, d: rounded(plan(Frames(spark, d)))) if plan else (lambda spark, d: run(spark, d, body)))
