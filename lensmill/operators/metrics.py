"""Evaluation metrics over any columns: errors, rank and class metrics, threshold sweeps, gates.

``by`` are grouping columns (none: one row for the table). Rows with a null in a column that a metric reads are left out
of it. Sweeps place each row on the grid once and add up over the grid; ranks never meet in one task.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lensmill.operators import ranking

By = Sequence[str]


def _agg(df: DataFrame, by: By, *aggs: Column) -> DataFrame:
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def _both(df: DataFrame, *columns: str) -> DataFrame:
    return df.dropna(subset=list(columns))


def count_if(c: Column) -> Column:
    return F.count_if(c).cast("bigint")


def ratio(a: Column, b: Column, empty: float | None = 0.0) -> Column:
    """Rows with ``a`` over rows with ``b``; ``empty`` where there is no ``b``."""
    share = F.try_divide(F.count_if(a).cast("double"), F.count_if(b))
    return share if empty is None else F.coalesce(share, F.lit(empty))


def share(a: Column) -> Column:
    return F.try_divide(F.count_if(a).cast("double"), F.count("*"))


def band(c: Column, edges: Sequence[float] = (2, 4, 6, 8), top: int = 10) -> Column:
    """Which band a score lies in: ``0-2`` and so on."""
    names = [f"{a}-{b}" for a, b in zip((0, *edges), (*edges, top), strict=True)]
    out = F.lit(names[-1])
    for e, n in reversed(list(zip(edges, names, strict=False))):
        out = F.when(c < e, n).otherwise(out)
    return F.when(c.isNotNull(), out)


def tier(c: Column, tiers: Sequence[tuple[str, float | None]]) -> Column:
    """The first of (name, threshold), falling, that the score reaches; a threshold of None takes the rest."""
    out = F.lit(None).cast("string")
    for name, th in reversed(tiers):
        out = F.lit(name) if th is None else F.when(c >= th, name).otherwise(out)
    return out


# -- errors

def error(pred: str, label: str) -> Column:
    return F.col(pred) - F.col(label)


def mae_rmse(df: DataFrame, pred: str, label: str, by: By = ()) -> DataFrame:
    e = error(pred, label)
    return _agg(df, by, F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"))


def mae_by_band(df: DataFrame, pred: str, label: str) -> DataFrame:
    e = error(pred, label)
    return _both(df, pred, label).groupBy(band(F.col(label)).alias("band")).agg(F.count("*").alias("n"), F.avg(F.abs(e)).alias("mae"))


def error_by_range(df: DataFrame, pred: str, label: str) -> DataFrame:
    e = error(pred, label)
    return _both(df, pred, label).groupBy(band(F.col(label)).alias("band")).agg(F.count("*").alias("n"), F.avg(e).alias("mean_error"), F.avg(F.abs(e)).alias("mae"), F.stddev_pop(e).alias("sd"))


def bias(df: DataFrame, pred: str, label: str, by: By = ()) -> DataFrame:
    e = error(pred, label)
    return _agg(df, by, F.avg(e).alias("mean"), F.median(e).alias("median"), F.stddev_pop(e).alias("sd"))


def moments(df: DataFrame, pred: str, label: str, by: By = ()) -> DataFrame:
    """Population skewness, excess kurtosis, 5 and 95 % quantiles of the error."""
    e = error(pred, label)
    return _agg(df, by, F.skewness(e).alias("skewness"), F.kurtosis(e).alias("kurtosis"), F.percentile(e, F.lit(0.05)).alias("p5"), F.percentile(e, F.lit(0.95)).alias("p95"))


def error_summary(df: DataFrame, pred: str, label: str, baseline: float, by: By = ()) -> DataFrame:
    e = F.abs(error(pred, label))
    quantiles = [F.percentile(e, F.lit(p)).alias(n) for n, p in (("median", 0.5), ("q25", 0.25), ("q75", 0.75))]
    return _agg(df, by, *quantiles, (F.avg(e) - baseline).alias("gap"))


def within(df: DataFrame, pred: str, label: str, bounds: Mapping[str, float], by: By = ()) -> DataFrame:
    """For each name and bound the share of rows whose error is at most that."""
    return _agg(_both(df, pred, label), by, *(share(F.abs(error(pred, label)) <= b).alias(n) for n, b in bounds.items()))


# -- correlation and rank

def corr(a: str | Column, b: str | Column) -> Column:
    """Pearson's r as an aggregate; null without variance, where the built-in one may fail."""
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def pearson(df: DataFrame, a: str, b: str, by: By = (), least: int = 2) -> DataFrame:
    """r; null with fewer than ``least`` rows or without variance."""
    r = F.when(F.count("*") >= least, corr(a, b))
    return _agg(_both(df, a, b), by, r.alias("r"))


def spearman(df: DataFrame, a: str, b: str, name: str = "rho", buckets: int | None = None) -> DataFrame:
    """Correlation of the ranks, ties sharing theirs; 0 with fewer than two rows or without variance."""
    rows = _both(df, a, b).select(F.col(a).alias("a"), F.col(b).alias("b"))
    ranked = ranking.avg_rank(ranking.avg_rank(rows, "a", "ra", buckets), "b", "rb", buckets)
    return ranked.agg(F.coalesce(corr("ra", "rb"), F.lit(0.0)).alias(name))


def correlations(df: DataFrame, columns: Mapping[int, Column], redundant: float | None = None) -> DataFrame:
    """r of every two columns, (a, b, r) and whether it is beyond ``redundant``: one pass over the table."""
    pairs = [(i, j) for i in columns for j in columns if i < j]
    one = F.array(*(F.struct(F.lit(i).alias("a"), F.lit(j).alias("b"), corr(columns[i], columns[j]).alias("r")) for i, j in pairs))
    out = df.agg(one.alias("p")).select(F.explode("p").alias("p")).select("p.*")
    return out if redundant is None else out.withColumn("redundant", F.abs("r") > redundant)


def slope(df: DataFrame, x: str, y: str, by: By = ()) -> DataFrame:
    return _agg(_both(df, x, y), by, corr(x, y).alias("r"), F.try_divide(F.covar_pop(x, y), F.var_pop(x)).alias("slope"))


def mann_whitney(df: DataFrame, value: str, first: Column, buckets: int | None = None) -> DataFrame:
    """U of the rows with ``first`` against the others, and the two-sided p-value of its normal approximation with ties."""
    rows = df.select(F.col(value).alias("v"), first.alias("f")).dropna()
    places = ranking.value_places(rows, "v", buckets)
    ranked = ranking.avg_rank(rows, "v", "r", buckets)
    ties = places.agg(F.sum(F.col("n").cast("double") * (F.col("n") * F.col("n") - 1)).alias("ties"))
    s = ranked.agg(F.sum(F.when(F.col("f"), F.col("r")).otherwise(0.0)).alias("ranks"), F.count_if("f").alias("n1"), F.count_if(~F.col("f")).alias("n2")).crossJoin(F.broadcast(ties))
    n = F.col("n1") + F.col("n2")
    u = F.col("ranks") - F.col("n1") * (F.col("n1") + 1) / 2.0
    var = F.col("n1") * F.col("n2") / 12.0 * (n + 1 - F.try_divide(F.col("ties"), n.cast("double") * (n - 1)))
    z = F.greatest(F.abs(u - F.col("n1") * F.col("n2") / 2.0) - 0.5, F.lit(0.0)) / F.sqrt(var)
    return s.select(u.alias("u"), F.when(var > 0, erfc(z / math.sqrt(2))).alias("p"))


def erfc(x: Column) -> Column:
    """The complementary error function for x >= 0, to about 1e-7 (a rational approximation of Abramowitz and Stegun)."""
    c = (0.0705230784, 0.0422820123, 0.0092705272, 0.0001520143, 0.0002765672, 0.0000430638)
    poly = F.lit(1.0)
    for i, a in enumerate(c, 1):
        poly = poly + F.lit(a) * F.pow(x, F.lit(i))
    return F.pow(poly, F.lit(-16.0))


# -- top-k

def _tops(df: DataFrame, key: str, pred: str, label: str, most: int) -> tuple[DataFrame, DataFrame]:
    rows = _both(df, pred, label).select(F.col(key).alias("id"), F.col(pred).alias("p"), F.col(label).alias("l"))
    return ranking.top_n(rows, [F.desc("p"), F.col("id")], most, "rp"), ranking.top_n(rows, [F.desc("l"), F.col("id")], most, "rt")


def _ks(spark, ks: Sequence[int]) -> DataFrame:
    return F.broadcast(spark.createDataFrame([(int(k),) for k in ks], "k bigint"))


def recall_at_k(df: DataFrame, key: str, pred: str, label: str, ks: Sequence[int]) -> DataFrame:
    """Of the k best by label, the share among the k best by prediction. Only the largest k rows of either are kept."""
    p, t = _tops(df, key, pred, label, max(ks))
    both = t.select("id", "rt").join(p.select("id", "rp"), "id", "left")
    per = both.join(_ks(df.sparkSession, ks), F.col("rt") <= F.col("k"))
    return per.groupBy("k").agg((F.count_if(F.col("rp") <= F.col("k")).cast("double") / F.count("*")).alias("recall"))


def ndcg(df: DataFrame, key: str, pred: str, gain: str, ks: Sequence[int]) -> DataFrame:
    p, t = _tops(df, key, pred, gain, max(ks))
    ranked = p.select("l", F.col("rp").alias("r"), F.lit(False).alias("ideal")).unionByName(t.select("l", F.col("rt").alias("r"), F.lit(True).alias("ideal")))
    got = F.col("l") / F.log2(F.col("r") + 1)
    per = ranked.join(_ks(df.sparkSession, ks), F.col("r") <= F.col("k")).groupBy("k")
    return per.agg(F.coalesce(F.try_divide(F.sum(F.when(~F.col("ideal"), got)), F.sum(F.when(F.col("ideal"), got))), F.lit(0.0)).alias("ndcg"))


# -- classes and thresholds

def wilson_lower(k: Column, n: Column, z: float = 1.96) -> Column:
    """Lower bound of the Wilson interval of k out of n; 0 for none."""
    p = k / n
    low = (p + z * z / (2 * n) - z * F.sqrt((p * (1 - p) + z * z / (4 * n)) / n)) / (1 + z * z / n)
    return F.when(n > 0, low).otherwise(0.0)


def gate_eval(df: DataFrame, pred: str, label: str, threshold: float, by: By = ()) -> DataFrame:
    """Confusion counts, recall, precision, specificity and MAE at a threshold."""
    p, y = F.col(pred) >= threshold, F.col(label) >= threshold
    cells = [count_if(y & p).alias("tp"), count_if(~y & p).alias("fp"), count_if(y & ~p).alias("fn"), count_if(~y & ~p).alias("tn")]
    rates = [ratio(y & p, y).alias("recall"), ratio(y & p, p).alias("prec"), ratio(~y & ~p, ~y).alias("specificity")]
    return _agg(_both(df, pred, label), by, *cells, *rates, F.avg(F.abs(error(pred, label))).alias("mae"))


def fn_rate(df: DataFrame, pred: str, label: str, at: float) -> DataFrame:
    p, y = F.col(pred) >= at, F.col(label) >= at
    return _both(df, pred, label).agg(ratio(y & ~p, y).alias("fn_rate"), ratio(y & p, y).alias("recall"))


def classifier_report(df: DataFrame, pred: Column, label: Column) -> DataFrame:
    rows = df.select(pred.alias("p"), label.alias("y")).dropna()
    p, y = F.col("p"), F.col("y")
    f1 = F.coalesce(F.try_divide(2.0 * F.count_if(y & p), 2 * F.count_if(y & p) + F.count_if(y != p)), F.lit(0.0))
    return rows.agg(share(y == p).alias("accuracy"), ratio(y & p, p).alias("prec"), ratio(y & p, y).alias("recall"), f1.alias("f1"))


def tier_confusion(df: DataFrame, pred: Column, label: Column) -> DataFrame:
    return df.groupBy(label.alias("truth"), pred.alias("pred")).agg(F.count("*").alias("n"))


def on_grid(score: Column, grid: Sequence[float]) -> Column:
    """How many thresholds of a rising grid a score reaches."""
    cells = F.array(*(F.lit(float(t)) for t in grid))
    return F.size(F.filter(cells, lambda t: t <= score))


def sweep(df: DataFrame, score: str, grid: Sequence[float], flags: Mapping[str, Column] | None = None, by: By = ()) -> DataFrame:
    """For each threshold ``th`` of a rising grid: rows ``n``, of them ``n_at`` at or above it; ``f`` and ``f_at`` for each flag.

    Rows are counted by their place on the grid, once; only these counts meet the grid.
    """
    names = list(flags or {})
    placed = _both(df, score).select(*by, on_grid(F.col(score), grid).alias("g_"), *(flags[f].alias(f) for f in names))
    counts = placed.groupBy(*by, "g_").agg(F.count("*").alias("c_"), *(F.count_if(f).alias(f) for f in names))
    points = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(float(t)).alias("th")) for i, t in enumerate(grid)))
    met = counts.withColumn("p_", F.explode(points)).select("*", F.col("p_.th").alias("th"), (F.col("g_") > F.col("p_.i")).alias("at_"))
    sums = [F.sum("c_").alias("n"), F.sum(F.when(F.col("at_"), F.col("c_")).otherwise(0)).alias("n_at")]
    for f in names:
        sums += [F.sum(f).alias(f"{f}_all"), F.sum(F.when(F.col("at_"), F.col(f)).otherwise(0)).alias(f"{f}_at")]
    return met.groupBy(*by, "th").agg(*sums)


def _of(a: Column, b: Column, empty: float = 0.0) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b), F.lit(empty))


def threshold_curve(df: DataFrame, pred: str, positive: Column, grid: Sequence[float]) -> DataFrame:
    """fn_rate and recall of the positives, and the share of rows that go on to stage 2, for each threshold."""
    s = sweep(df, pred, grid, {"pos": positive})
    return s.select("th", _of(F.col("pos_all") - F.col("pos_at"), F.col("pos_all")).alias("fn_rate"), _of(F.col("pos_at"), F.col("pos_all")).alias("recall"), _of(F.col("n_at"), F.col("n")).alias("stage2_rate"))


def select_threshold(df: DataFrame, pred: str, positive: Column, grid: Sequence[float], fn_budget: float) -> DataFrame:
    """The highest threshold within the budget of missed positives; null if there is none."""
    return threshold_curve(df, pred, positive, grid).agg(F.max(F.when(F.col("fn_rate") <= fn_budget, F.col("th"))).alias("threshold"))


def hybrid_sweep(df: DataFrame, pred: str, positive: Column, grid: Sequence[float], saved: float = 0.6) -> DataFrame:
    """Share of rows that stage 1 settles, positives it loses, and the speed-up where stage 1 saves ``saved`` of the cost."""
    c = threshold_curve(df, pred, positive, grid).withColumn("stage1_pct", 1 - F.col("stage2_rate"))
    return c.select("th", "stage1_pct", "fn_rate", (1 / (1 - saved * F.col("stage1_pct"))).alias("speedup"))


def pr_sweep(df: DataFrame, pred: str, positive: Column, grid: Sequence[float]) -> DataFrame:
    s = sweep(df, pred, grid, {"pos": positive})
    return s.select("th", _of(F.col("pos_at"), F.col("n_at")).alias("prec"), _of(F.col("pos_at"), F.col("pos_all")).alias("recall"))


def probe_check(df: DataFrame, pred: str, label: str, grid: Sequence[float]) -> DataFrame:
    """MAE and bias, and for each threshold of both scores the recall (1 without positives) and the share below it."""
    rows = _both(df, pred, label)
    counts = rows.groupBy(on_grid(F.col(pred), grid).alias("g"), on_grid(F.col(label), grid).alias("h")).agg(F.count("*").alias("c"), F.sum(F.abs(error(pred, label))).alias("e"), F.sum(error(pred, label)).alias("d"))
    points = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(float(t)).alias("th")) for i, t in enumerate(grid)))
    met = counts.withColumn("p", F.explode(points)).select("*", "p.i", "p.th")
    num = lambda cond: F.sum(F.when(cond, F.col("c")).otherwise(0))
    up, true = F.col("g") > F.col("i"), F.col("h") > F.col("i")
    return met.groupBy("th").agg((F.sum("e") / F.sum("c")).alias("mae"), (F.sum("d") / F.sum("c")).alias("bias"), _of(num(up & true), num(true), 1.0).alias("recall"), _of(num(~up), F.sum("c")).alias("skip_rate"))


def filter_scenarios(df: DataFrame, pred: str, label: str, reject_below: float, good_at: float, bad_below: float) -> DataFrame:
    p, y = F.col(pred), F.col(label)
    return df.agg(count_if(p < reject_below).alias("rejected"), count_if((p < reject_below) & (y >= good_at)).alias("good_rejected"), count_if((p >= reject_below) & (y < bad_below)).alias("bad_kept"))


# -- gates

def agreement_gate(scored: DataFrame, old: str, new: str, medium: float, declined: Column, reference: Column, protected: Column | None = None, limits: Mapping[str, float] | None = None, buckets: int | None = None) -> DataFrame:
    """One row: does a new model agree with the old one?

    ``demotion_low``, the Wilson bound of declined rows that no longer surface; ``shift``, the share of the reference's
    old medium rows that the new model drops; ``protection``, the share of protected rows that surface (null: no such
    cohort, which is no failure); ``rho``, the rank correlation on the reference. ``passed``: all that are not null pass.
    """
    at = {"demotion_low": 0.90, "shift": 0.05, "protection": 0.70, "rho": 0.6} | dict(limits or {})
    surfaces, was = F.col(new) >= medium, (F.col(old) >= medium) & F.col(new).isNotNull()
    there = F.col(new).isNotNull()
    k, n = F.count_if(declined & there & ~surfaces).cast("double"), F.count_if(declined & there).cast("double")
    shield = ratio(protected & surfaces, protected & there) if protected is not None else F.lit(None).cast("double")
    one = scored.agg(wilson_lower(k, n).alias("demotion_low"), ratio(reference & was & ~surfaces, reference & was).alias("shift"), shield.alias("protection"))
    both = one.crossJoin(F.broadcast(spearman(scored.filter(reference), old, new, "rho", buckets)))
    checks = [F.col("demotion_low") >= at["demotion_low"], F.col("shift") <= at["shift"], F.coalesce(F.col("protection") >= at["protection"], F.lit(True)), F.col("rho") >= at["rho"]]
    return both.withColumn("passed", checks[0] & checks[1] & checks[2] & checks[3])
