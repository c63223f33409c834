"""The views that queries read: articles and scores over the stand-in tables, in Spark and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DIMS = 6
WEIGHTS = (0.25, 0.20, 0.20, 0.15, 0.10, 0.10)


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def articles(spark: SparkSession, d: str) -> DataFrame:
    doc = table(spark, d, "documents")
    return doc.select(
        F.col("doc_id").alias("id"),
        F.split_part("text", F.lit("."), F.lit(1)).alias("title"),
        F.col("text").alias("content"),
        F.concat(F.lit("https://"), "source", F.lit(".example/"), F.col("doc_id").cast("string")).alias("url"),
        "source",
        F.col("lang").alias("language"),
        "n_chars",
    )


def scores(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    at = lambda i: F.element_at("embedding", i).cast("double")
    clamp = lambda x: F.greatest(F.lit(0.0), F.least(F.lit(10.0), x))
    base = lambda i: F.lit(5.0) + F.lit(16.0) * at(i + 1)
    student = [clamp(base(i)).alias(f"s{i}") for i in range(DIMS)]
    oracle = [clamp(base(i) + F.lit(4.0) * at(i + 7)).alias(f"o{i}") for i in range(DIMS)]
    return e.select(F.col("vec_id").alias("id"), F.col("label").alias("lens"), *student, *oracle)


ARTICLES = """articles AS (
  SELECT doc_id AS id, split_part(text, '.', 1) AS title, text AS content,
         'https://' || source || '.example/' || CAST(doc_id AS VARCHAR) AS url, source, lang AS language, n_chars
  FROM documents)"""

_E = "CAST(list_extract(embedding, {}) AS DOUBLE)"
_CLAMP = "greatest(CAST(0 AS DOUBLE), least(CAST(10 AS DOUBLE), {}))"
_S = [_CLAMP.format(f"CAST(5 AS DOUBLE) + CAST(16 AS DOUBLE) * {_E.format(i + 1)}") + f" AS s{i}" for i in range(DIMS)]
_O = [_CLAMP.format(f"CAST(5 AS DOUBLE) + CAST(16 AS DOUBLE) * {_E.format(i + 1)} + CAST(4 AS DOUBLE) * {_E.format(i + 7)}") + f" AS o{i}" for i in range(DIMS)]
SCORES = f"scores AS (SELECT vec_id AS id, label AS lens, {', '.join(_S + _O)} FROM embeddings)"

#: Weighted averages of student and oracle, as SQL terms over ``scores``.
WA_S = " + ".join(f"s{i} * CAST({w} AS DOUBLE)" for i, w in enumerate(WEIGHTS))
WA_O = " + ".join(f"o{i} * CAST({w} AS DOUBLE)" for i, w in enumerate(WEIGHTS))
WA = f"wa AS (SELECT *, {WA_S} AS ws, {WA_O} AS wo FROM scores)"


def weighted(prefix: str, weights=WEIGHTS):
    """Left-to-right sum, as SQL does it."""
    out = F.col(f"{prefix}0") * F.lit(weights[0])
    for i, w in enumerate(weights[1:], 1):
        out = out + F.col(f"{prefix}{i}") * F.lit(w)
    return out


def with_wa(spark: SparkSession, d: str) -> DataFrame:
    return scores(spark, d).withColumns({"ws": weighted("s"), "wo": weighted("o")})


def long_scores(spark: SparkSession, d: str) -> DataFrame:
    """One row per id and dimension: id, lens, dim, pred, label."""
    s = scores(spark, d)
    rows = F.explode(F.array(*(F.struct(F.lit(i).alias("dim"), F.col(f"s{i}").alias("pred"), F.col(f"o{i}").alias("label")) for i in range(DIMS))))
    return s.select("id", "lens", rows.alias("r")).select("id", "lens", "r.*")


LONG = "long AS (" + " UNION ALL ".join(f"SELECT id, lens, {i} AS dim, s{i} AS pred, o{i} AS label FROM scores" for i in range(DIMS)) + ")"


def q(body: str, *ctes: str) -> str:
    return ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + body


def r6(c):
    return F.round(c, 6)


def big(c):
    return c.cast("bigint")
