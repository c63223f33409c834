"""Operator 8: mixing sources to target weights along a time-varying curriculum.

Targets. Each source gets its weight's share of the token budget; a target stops at ``max_repeats`` times its source's
size and the excess goes to the others by weight, until none is above. That is water-filling: with the caps sorted by
cap/weight, the level is found from running sums, with no loop.

Curriculum. A source has a schedule: knots of relative weight over training time 0..1, linear in between and scaled so
that its integral is the source's target. Cumulative demand D(t) is then a piecewise quadratic. A document whose pass
starts at offset c of its source's stream is due when D(t) = c, which is inverted in closed form on the right segment.
The rows, range-sorted by that position, are the training order.

Order within a source is by md5 of seed and doc_id, so reruns agree. The offset is a running sum that no single task
computes: rows fall into buckets by hash prefix, bucket totals are summed (partial aggregation first), running totals
over the few buckets of a source give each bucket's start, and rows are summed within their bucket only. A source with
a third of all rows therefore spreads over all its buckets; their number grows with the row count.

A pass of a document is taken if its middle lies within the target: whole documents only, the error of a source is at
most half a document, and with targets up to ``max_repeats`` times the size no document exceeds that many passes.

Defined results: null or blank texts have size 0 and are taken 0 times; a source with no words has target 0; null
sources form the last source; repeated rows are told apart by (doc_id, text hash) and otherwise tie harmlessly: equal
rows are interchangeable. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lensmill.llm.common import WORD, fresh, let, materialize, text_or_empty

WEIGHTS = (5.0, 2.0, 1.0)
MAX_REPEATS = 3
#: Knots (time, relative weight) by source rank, repeating: easing off, ramping up, steady. Only the shape counts.
SCHEDULES = (
    ((0.0, 3.0), (0.5, 2.0), (1.0, 1.0)),
    ((0.0, 1.0), (0.25, 1.0), (1.0, 3.0)),
    ((0.0, 1.0), (1.0, 1.0)),
)
#: Buckets of a source: enough of them that a hot source spreads over all tasks, more as the rows grow.
MIN_BUCKETS, ROWS_PER_BUCKET = 256, 8_192


def word_count(text: str | Column) -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("bigint")


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, budget: float = 1.0, max_repeats: float = MAX_REPEATS) -> DataFrame:
    """``sizes``: one row per source (source, source_size). Adds rank, weight and target.

    Sources come in code point order, null last. ``budget`` is a share of all sizes, at most ``max_repeats``.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    everything = Window.partitionBy(F.lit(0))
    ws = F.array(*map(F.lit, map(float, weights)))
    ranked = sizes.withColumn("rank", F.row_number().over(order) - 1).withColumn("weight", F.get(ws, F.col("rank") % len(weights)))
    capped = ranked.withColumns({"cap": F.col("source_size") * F.lit(float(max_repeats)), "total": F.sum("source_size").over(everything) * F.lit(float(budget))})
    by_level = Window.partitionBy(F.lit(0)).orderBy(F.col("cap") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(F.lit(0)).orderBy(F.col("cap") / F.col("weight"), "rank").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    # the level if every source before this one (in order of cap/weight) stands at its cap and none from here on
    levelled = capped.withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(by_level), F.lit(0.0))) / F.sum("weight").over(after))
    # water level: the first such level that does not exceed the source's own
    fits = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), F.col("rank"), F.col("level")))
    water = F.min(fits).over(everything)["level"]
    return levelled.withColumn("water", water).select(
        "source", "rank", "weight", "source_size",
        F.least(F.col("cap"), F.coalesce(F.col("water") * F.col("weight"), F.col("cap"))).alias("target"),
    )


def _segments(knots: Sequence[tuple[float, float]]) -> list[tuple[float, float, float, float, float]]:
    """(start, width, weight at start, weight at end, area before) of each segment, scaled to a total area of 1."""
    area = sum((t1 - t0) * (a + b) / 2 for (t0, a), (t1, b) in zip(knots, knots[1:], strict=False))
    out, before = [], 0.0
    for (t0, a), (t1, b) in zip(knots, knots[1:], strict=False):
        out.append((t0, t1 - t0, a / area, b / area, before))
        before += (t1 - t0) * (a + b) / 2 / area
    return out


def position(share: Column, rank: Column, schedules: Sequence[Sequence[tuple[float, float]]] = SCHEDULES) -> Column:
    """The time at which a source's cumulative demand reaches ``share`` (0..1) of its target."""

    def solve(s: Column, knots: Sequence[tuple[float, float]]) -> Column:
        out = None
        for start, width, a, b, before in reversed(_segments(knots)):
            rest = s - F.lit(before)
            # area a*x + (b-a)/(2*width)*x^2 = rest, in the form that has no cancellation and allows a = b
            root = F.lit(2.0) * rest / (F.lit(a) + F.sqrt(F.greatest(F.lit(a * a) + F.lit(2 * (b - a) / width) * rest, F.lit(0.0))))
            t = F.least(F.lit(start) + F.coalesce(root, F.lit(0.0)), F.lit(start + width))
            out = t if out is None else F.when(s < F.lit(out_from), t).otherwise(out)
            out_from = before
        return out

    out = solve(share, schedules[-1])
    for k in range(len(schedules) - 1):
        out = F.when(rank % len(schedules) == k, solve(share, schedules[k])).otherwise(out)
    return out


def order_key(doc_id: str, text: str) -> Column:
    """Where a document stands in its source: the same on every run. Without a doc_id, by the hash of its text."""
    own = F.coalesce(F.col(doc_id).cast("string"), F.concat(F.lit("text|"), F.xxhash64(F.col(text)).cast("string")))
    return F.md5(F.concat(F.lit("mix-1|"), own))


def sized(docs: DataFrame, text: str = "text") -> DataFrame:
    """Narrow rows (doc_id, source, size, order key) of a corpus, written once: texts are read and counted once."""
    rows = docs.select("doc_id", "source", word_count(text).alias("size"), order_key("doc_id", text).alias("_key"), F.xxhash64(F.col(text)).alias("twin"))
    return materialize(rows, "curriculum")


def mix(rows: DataFrame, weights: Sequence[float] = WEIGHTS, schedules=SCHEDULES, budget: float = 1.0, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``rows`` of ``sized`` with source_size, target, passes, taken and ``positions`` (one for each pass taken)."""
    buckets = max(MIN_BUCKETS, rows.count() // ROWS_PER_BUCKET)
    digits = (buckets.bit_length() + 2) // 4  # of the key, in hex: so many buckets or up to 16 times as many
    extra = [c for c in rows.columns if c not in ("doc_id", "source", "size", "_key", "twin")]
    rows = rows.withColumn("bucket", F.conv(F.substring("_key", 1, digits), 16, 10).cast("bigint"))
    totals = rows.groupBy("source", "bucket").agg(F.sum("size").alias("in_bucket"))
    sources = targets(totals.groupBy("source").agg(F.sum("in_bucket").alias("source_size")), weights, budget, max_repeats)
    running = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.withColumn("start", F.coalesce(F.sum("in_bucket").over(running), F.lit(0))).drop("in_bucket")
    starts = starts.alias("b").join(sources.alias("s"), F.col("b.source").eqNullSafe(F.col("s.source"))).select(
        F.col("b.source").alias("b_source"), F.col("b.bucket").alias("b_bucket"), "start", "rank", "source_size", "target"
    )
    joined = rows.join(starts, rows.source.eqNullSafe(starts.b_source) & (rows.bucket == starts.b_bucket)).drop("b_source", "b_bucket")
    before = Window.partitionBy("source", "bucket").orderBy("_key", "doc_id", "size", "twin", *extra).rowsBetween(Window.unboundedPreceding, -1)
    placed = joined.withColumn("offset", F.col("start") + F.coalesce(F.sum("size").over(before), F.lit(0)))
    middle = lambda p: F.col("offset") + p * F.col("source_size") + F.col("size") / F.lit(2.0)
    passes = F.when(F.col("size") > 0, F.filter(F.array(*[F.lit(p).cast("bigint") for p in range(max_repeats)]), lambda p: middle(p) <= F.col("target"))).otherwise(F.array().cast("array<bigint>"))
    spots = F.transform(passes, lambda p: position((F.col("offset") + p * F.col("source_size")) / F.col("target"), F.col("rank"), schedules))
    return placed.withColumn("positions", let(spots, lambda x: x)).select(
        "doc_id", "source", "_key", "twin", *extra, "size", "source_size", "target", (F.size("positions") * F.col("size")).cast("bigint").alias("taken"), "positions"
    )


def schedule(mixed: DataFrame) -> DataFrame:
    """One row for each pass taken, range-sorted by training position."""
    return mixed.select("*", F.posexplode("positions").alias("repeat", "position")).drop("positions").orderBy("position", "doc_id")


def take(docs: DataFrame) -> DataFrame:
    """Pipeline form: the documents in training order, a document as often as the mix takes it; not taken ones go.

    The rows are written once with a number of their own, so each row, repeated or not, gets the passes that were
    counted for it, and columns of any name are kept. Rows that are alike but for other columns are told apart by the
    hash of all of them.
    """
    row, whole, spots, at = (fresh(docs.columns, n) for n in ("row", "whole", "positions", "position"))
    numbered = docs.withColumns({row: F.monotonically_increasing_id(), whole: F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns))})
    stored = materialize(numbered, "rows")
    rows = stored.select("doc_id", "source", word_count("text").alias("size"), order_key("doc_id", "text").alias("_key"), F.xxhash64("text").alias("twin"), F.col(whole).alias("whole"), F.col(row).alias("row"))
    due = mix(materialize(rows, "curriculum")).filter(F.size("positions") > 0).select(F.col("row").alias(row), F.col("positions").alias(spots))
    taken = stored.join(due, row).select(*(f"`{c}`" for c in docs.columns), F.explode(spots).alias(at))
    return taken.orderBy(at, "doc_id").drop(at)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lensmill.llm.common import table

    mixed = mix(sized(table(spark, sf_dir, "documents")))
    first = F.coalesce(F.floor(F.get("positions", F.lit(0)) * F.lit(1e9)).cast("bigint"), F.lit(-1))
    out = mixed.select("doc_id", "size", "source_size", "target", "taken", F.size("positions").cast("bigint").alias("passes"), first.alias("first_position_ppb"))
    # a document that isn't taken has position -1
    return out.orderBy("first_position_ppb", "doc_id")


def _sql() -> str:
    def solve(s: str, knots) -> str:
        out, out_from = None, 0.0
        for start, width, a, b, before in reversed(_segments(knots)):
            rest = f"({s} - {before!r}::DOUBLE)"
            root = f"2.0::DOUBLE * {rest} / ({a!r}::DOUBLE + sqrt(greatest({a * a!r}::DOUBLE + {2 * (b - a) / width!r}::DOUBLE * {rest}, 0.0::DOUBLE)))"
            t = f"least({start!r}::DOUBLE + {root}, {start + width!r}::DOUBLE)"
            out = t if out is None else f"CASE WHEN {s} < {out_from!r}::DOUBLE THEN {t} ELSE {out} END"
            out_from = before
        return out

    spot = "CASE " + " ".join(f"WHEN rank % {len(SCHEDULES)} = {k} THEN {solve('share', x)}" for k, x in enumerate(SCHEDULES)) + " END"
    ws = ", ".join(f"{w!r}::DOUBLE" for w in WEIGHTS)
    return rf"""
WITH d AS (
  SELECT doc_id, source, text, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('mix-1|' || doc_id) AS key FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), r AS (
  SELECT *, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS rank FROM s
), c AS (
  SELECT *, ([{ws}])[1 + rank % {len(WEIGHTS)}] AS weight, source_size * {float(MAX_REPEATS)!r}::DOUBLE AS cap,
         sum(source_size) OVER () * 1.0::DOUBLE AS total FROM r
), l AS (
  SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
         / sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM c
), w AS (
  SELECT level AS water FROM l WHERE level * weight <= cap ORDER BY cap / weight, rank LIMIT 1
), t AS (
  SELECT source, rank, source_size, least(cap, coalesce((SELECT water FROM w) * weight, cap)) AS target FROM l
), p AS (
  SELECT d.doc_id, d.size, t.rank, t.source_size, t.target,
         CAST(coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS off
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), q AS (
  SELECT *, CASE WHEN size > 0 THEN (SELECT count(*) FROM (SELECT unnest(range({MAX_REPEATS})) AS k) WHERE off + k * source_size + size / 2.0::DOUBLE <= target) ELSE 0 END AS passes,
         CASE WHEN target > 0 THEN off / target END AS share FROM p
)
SELECT doc_id, size, source_size, target, CAST(passes * size AS BIGINT) AS taken, CAST(passes AS BIGINT) AS passes,
       CASE WHEN passes > 0 THEN CAST(floor(({spot}) * 1e9::DOUBLE) AS BIGINT) ELSE -1 END AS first_position_ppb
FROM q
"""


SQL = _sql()
