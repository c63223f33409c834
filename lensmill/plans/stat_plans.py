"""Plans of the evaluation queries: operators applied to the views. ``q_stats`` holds the SQL that each must agree with."""

from __future__ import annotations

from pyspark.sql import functions as F

from lensmill.operators import metrics as M
from lensmill.operators import quality as Q
from lensmill.operators import ranking as K
from lensmill.operators import summary as S

C = F.col
TIERS = (("high", 6.0), ("medium", 4.5), ("low", None))
GRID4 = (4.0, 4.5, 5.0, 5.5)
GRID100 = tuple(3 + g * 0.025 for g in range(100))


def tier(name: str):
    return M.tier(C(name), TIERS)


def votes():
    return [C(f"s{i}") > 5 for i in range(4)]


def lenses():
    return {"a": (C("s0") + C("s1")) / 2, "b": (C("s2") + C("s3")) / 2, "c": (C("s4") + C("s5")) / 2}


def tier_compare(v):
    student, oracle = (v.wa.groupBy(tier(c).alias("tier")).agg(F.count("*").alias("n")).withColumn("source", F.lit(s)) for s, c in (("student", "ws"), ("oracle", "wo")))
    return student.unionByName(oracle).select("source", "tier", "n")


def length_error(v):
    j = v.articles.select("id", F.length("content").alias("len")).join(v.wa.select("id", F.abs(C("ws") - C("wo")).alias("err")), "id")
    long = C("len") > 3000
    parts = j.agg(M.share(long).alias("truncated"), F.avg(F.when(long, C("err"))).alias("a"), F.avg(F.when(~long, C("err"))).alias("b"))
    return M.spearman(j, "len", "err").crossJoin(F.broadcast(parts)).select("truncated", "rho", C("a").alias("mae_truncated"), C("b").alias("mae_whole"))


def consistency(v):
    copies = v.documents.select("doc_id", F.md5("text").alias("h"))
    first = copies.groupBy("h").agg(F.min("doc_id").alias("first"))
    pairs = copies.join(first, "h").filter("doc_id <> first")
    a, b = v.wa.select(C("id").alias("doc_id"), C("ws").alias("a")), v.wa.select(C("id").alias("first"), C("ws").alias("b"))
    d = F.abs(C("a") - C("b"))
    return pairs.join(a, "doc_id").join(b, "first").agg(F.avg(d).alias("mean_diff"), F.max(d).alias("max_diff"), (F.avg(d) <= 1.0).alias("acceptable"))


def splits(v):
    a = v.articles
    return a.withColumn("split", F.when(C("id") % 10 < 8, "train").when(C("id") % 10 == 8, "val").otherwise("test"))


def rolled(v):
    return S.majority(v.scores, "id", votes())


PLANS = {
    # aggregations
    "agg_tier_histogram": lambda v: v.wa.groupBy(tier("ws").alias("tier")).agg(F.count("*").alias("n")),
    "agg_stratum_pct": lambda v: S.stratum_pct(v.wa, tier("wo"), "tier"),
    "agg_dim_stats": lambda v: S.dim_stats(v.long, "label", ["dim"]),
    "agg_dim_stats_modal": lambda v: S.modal_stats(v.long, "label", "dim"),
    "agg_histogram": lambda v: S.histogram(v.wa, "ws", 0.5),
    "agg_majority": lambda v: rolled(v).select("id", "verdict"),
    "agg_median_consensus": lambda v: S.consensus(v.scores, "id", [C(f"o{i}") for i in range(6)]),
    "agg_tier_compare": tier_compare,
    "agg_fp_per_lens": lambda v: S.false_positives(v.wa, "ws", C("wo") < 4.8, GRID4, ["lens"]),
    "agg_flag_rates": lambda v: S.flag_rates(v.scores, {"f0": C("s0") > 5, "f1": C("s1") > 6, "f2": C("s2") < 4}, ["lens"]),
    "agg_lens_summary": lambda v: S.lens_summary(v.wa, "ws", 4.5, 6.0, ["lens"]),
    "agg_overlap_matrix": lambda v: S.overlap_matrix(v.scores, lenses(), 5.0),
    "agg_exclusivity": lambda v: S.exclusivity(v.scores, lenses(), 5.0),
    "agg_lens_combos": lambda v: S.combinations(v.scores, lenses(), 5.0),
    "agg_index_quantiles": lambda v: S.index_quantiles(v.wa, "ws"),
    "agg_disagreement_patterns": lambda v: v.wa.groupBy(tier("ws").alias("a"), tier("wo").alias("b")).agg(F.count("*").alias("n")).filter("a <> b"),
    # ranks
    "win_avg_rank": lambda v: K.avg_rank(v.wa.select("id", F.round("ws", 1).alias("r")), "r").select("id", "avg_rank"),
    "win_ecdf": lambda v: K.ecdf(v.wa.select("id", "ws"), "ws").select("id", (C("ecdf") * 10).alias("y")),
    "win_quintile": lambda v: K.slices(v.wa.select("id", "ws"), "ws", ["id"], 5, "quintile").select("id", "quintile"),
    "sort_newest": lambda v: K.top_n(v.events.select("event_id", "ts"), [F.desc("ts"), C("event_id")], 500).select("event_id", C("k").cast("bigint").alias("k")).orderBy("k"),
    "topk_disagreement": lambda v: v.wa.select("id", F.abs(C("ws") - C("wo")).alias("gap")).orderBy(F.desc("gap"), "id").limit(30),
    # metrics
    "met_mae_rmse": lambda v: M.mae_rmse(v.long, "pred", "label", ["dim"]),
    "met_recall_at_k": lambda v: M.recall_at_k(v.wa, "id", "ws", "wo", (10, 20, 50)),
    "met_ndcg": lambda v: M.ndcg(v.wa, "id", "ws", "wo", (10, 20, 50)),
    "met_fn_rate": lambda v: M.fn_rate(v.wa, "ws", "wo", 5.0),
    "met_mae_band": lambda v: M.mae_by_band(v.long, "pred", "label"),
    "met_gate_eval": lambda v: M.gate_eval(v.wa, "ws", "wo", 5.0),
    "gate_ground_truth": lambda v: M.gate_eval(v.wa, "ws", "wo", 5.0, ["lens"]),
    "met_spearman": lambda v: M.spearman(v.wa, "ws", "wo"),
    "met_pearson": lambda v: M.pearson(v.wa, "ws", "wo", ["lens"], 10),
    "met_corr_matrix": lambda v: M.correlations(v.scores, {i: C(f"o{i}") for i in range(6)}, 0.7),
    "met_error_corr": lambda v: M.correlations(v.scores, {i: C(f"s{i}") - C(f"o{i}") for i in range(6)}),
    "met_slope": lambda v: M.slope(v.long, "pred", "label", ["dim"]),
    "met_wilson": lambda v: v.wa.groupBy("lens").agg(F.count_if(C("ws") >= 5).cast("double").alias("k"), F.count("*").cast("double").alias("n")).select("lens", M.wilson_lower(C("k"), C("n")).alias("lower")),
    "gate_agreement": lambda v: M.agreement_gate(v.wa, "wo", "ws", 5.0, C("id") % 5 == 0, C("id") % 5 == 1, C("id") % 5 == 2),
    "met_length_error": length_error,
    "met_consistency": consistency,
    "agg_run_average": lambda v: v.scores.select("lens", F.round((C("s0") + C("s1") + C("s2")) / 3, 4).alias("m")).groupBy("lens").agg(F.avg("m").alias("mean"), F.count_distinct("m").alias("distinct_values")),
    "met_threshold_curve": lambda v: M.threshold_curve(v.wa, "ws", C("wo") >= 5, GRID100),
    "met_select_threshold": lambda v: M.select_threshold(v.wa, "ws", C("wo") >= 5, GRID100, 0.02),
    "met_hybrid_sweep": lambda v: M.hybrid_sweep(v.wa, "ws", C("wo") >= 5, GRID4),
    "met_hybrid_vs_model": lambda v: M.hybrid_sweep(v.wa, "ws", C("s0") >= 5, GRID4).select("th", "stage1_pct", "fn_rate"),
    "met_pr_sweep": lambda v: M.pr_sweep(v.wa, "ws", C("wo") >= 5, GRID4),
    "met_bias": lambda v: M.bias(v.long, "pred", "label", ["dim"]),
    "met_moments": lambda v: M.moments(v.long, "pred", "label", ["dim"]),
    "met_mannwhitney_u": lambda v: M.mann_whitney(v.wa, "ws", C("lens") % 2 == 0).select("u"),
    "met_error_by_range": lambda v: M.error_by_range(v.long, "pred", "label"),
    "met_tier_confusion": lambda v: M.tier_confusion(v.wa, tier("ws"), tier("wo")),
    "met_error_summary": lambda v: M.error_summary(v.long, "pred", "label", 0.5, ["dim"]),
    "met_hard_cases": lambda v: rolled(v).filter("verdict = 'split'").select("id"),
    "met_classifier": lambda v: M.classifier_report(v.labels.join(v.documents, "doc_id"), F.length("text") - F.length(F.translate("text", "#*$%&|", "")) < 20, C("quality") == 1),
    "met_within_threshold": lambda v: M.within(v.long, "pred", "label", {"w05": 0.5, "w10": 1.0, "w15": 1.5, "w20": 2.0}, ["dim"]),
    "met_filter_scenarios": lambda v: M.filter_scenarios(v.wa, "ws", "wo", 4.5, 5.0, 4.5),
    "met_probe_check": lambda v: M.probe_check(v.wa, "ws", "wo", GRID4),
    # data quality
    "dq_structure": lambda v: Q.missing(v.articles, {"no_title": "title", "no_content": "content", "no_id": "id"}),
    "dq_split_share": lambda v: Q.split_share(splits(v), "split", {"train": (80, 5), "val": (10, 3), "test": (10, 3)}),
    "dq_labels": lambda v: Q.label_problems(v.long, "label"),
    "dq_content": lambda v: Q.blank(v.articles, {"empty_title": "title", "empty_content": "content"}),
    "dq_complete_scores": lambda v: Q.complete_scores(v.scores, ["s0", "s1", "s2"]),
    "dq_dimensions": lambda v: Q.same_dimensions(v.long.groupBy("id").agg(F.sort_array(F.collect_list("dim")).alias("names")), "names", list(range(6))),
    "dq_hard_verify": lambda v: Q.hard_verify(v.articles, "content", "id", v.benchmark.withColumnRenamed("item_id", "id")),
    "dq_report": lambda v: Q.findings(v.long, [("out_of_range", Q.ISSUE, (C("label") < 0) | (C("label") > 10))]).unionByName(
        Q.findings(v.articles, [("short_content", Q.WARNING, F.length("content") < 300), ("empty_title", Q.WARNING, F.trim("title") == "")])
    ),
}
