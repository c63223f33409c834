"""Aggregations, rankings and evaluation metrics."""

from __future__ import annotations

from lensmill.plans.portable import portable as p

N = "CAST(count(*) AS BIGINT)"


def n_if(cond: str) -> str:
    return f"CAST(count_if({cond}) AS BIGINT)"


def share(cond: str) -> str:
    return f"round(CAST(count_if({cond}) AS DOUBLE) / count(*), 6)"


def ratio(a: str, b: str) -> str:
    """A share with the zero guard of the evaluation code: 0 over 0 is 0."""
    return f"round(coalesce(CAST(count_if({a}) AS DOUBLE) / nullif(count_if({b}), 0), 0), 6)"


TIER = "CASE WHEN {} >= 6 THEN 'high' WHEN {} >= 4.5 THEN 'medium' ELSE 'low' END"
tier = lambda c: TIER.format(c, c)
BAND = "CASE WHEN {0} < 2 THEN '0-2' WHEN {0} < 4 THEN '2-4' WHEN {0} < 6 THEN '4-6' WHEN {0} < 8 THEN '6-8' ELSE '8-10' END"

# -- aggregations
p("agg_session_summary", f"SELECT event_type, {N} AS n, {n_if('value > 50')} AS successes, round(avg(value), 6) AS mean_value, CAST(sum(event_id % 3) AS BIGINT) AS retries FROM {{events}} GROUP BY event_type")
p("agg_tier_histogram", f"SELECT {tier('ws')} AS tier, {N} AS n FROM {{wa}} GROUP BY 1")
p("agg_date_range", "SELECT min(CAST(ts AS STRING)) AS first_ts, max(CAST(ts AS STRING)) AS last_ts FROM {events}")
p("agg_stratum_pct", f"SELECT tier, n, round(100.0 * n / sum(n) OVER (), 6) AS pct FROM (SELECT {tier('wo')} AS tier, {N} AS n FROM {{wa}} GROUP BY 1) t")
p("agg_block_reasons", f"SELECT reason, {N} AS n FROM (SELECT CASE WHEN length(content) < 300 THEN 'short' WHEN contains(url, 'src1') THEN 'domain' ELSE 'passed' END AS reason FROM {{articles}}) t GROUP BY reason")
p("agg_dim_stats", "SELECT dim, round(min(label), 6) AS lo, round(max(label), 6) AS hi, round(avg(label), 6) AS mean, round(coalesce(stddev_samp(label), 0), 6) AS sd FROM {long} GROUP BY dim")
p(
    "agg_dim_stats_modal",
    "SELECT s.dim, s.mean, s.sd, m.bin AS modal_bin, round(CAST(m.c AS DOUBLE) / s.n, 6) AS modal_share FROM (SELECT dim, round(avg(label), 6) AS mean, round(stddev_pop(label), 6) AS sd, count(*) AS n FROM {long} GROUP BY dim) s "
    "JOIN (SELECT dim, bin, c, row_number() OVER (PARTITION BY dim ORDER BY c DESC, bin) AS k FROM (SELECT dim, floor(label * 2) / 2 AS bin, count(*) AS c FROM {long} GROUP BY dim, floor(label * 2) / 2) x) m ON s.dim = m.dim WHERE m.k = 1",
)
p("agg_label_quality", "SELECT round(min(label), 6) AS lo, round(max(label), 6) AS hi, round(avg(label), 6) AS mean, round(stddev_samp(label), 6) AS sd, stddev_samp(label) < 0.1 AS flat FROM {long}")
p("agg_content_length", "SELECT CAST(min(length(content)) AS BIGINT) AS lo, CAST(max(length(content)) AS BIGINT) AS hi, round(avg(length(content)), 6) AS mean, CAST(median(length(content)) AS DOUBLE) AS median FROM {articles}")
p("agg_histogram", f"SELECT CAST(floor(ws / 0.5) AS BIGINT) AS bin, {N} AS n FROM {{wa}} GROUP BY 1")
VOTES = "votes AS (SELECT id, voter, vote FROM (SELECT id, 'a' AS voter, s0 > 5 AS vote FROM {scores} UNION ALL SELECT id, 'b', s1 > 5 FROM {scores} UNION ALL SELECT id, 'c', s2 > 5 FROM {scores} UNION ALL SELECT id, 'd', s3 > 5 FROM {scores}) x)"
ROLL = "roll AS (SELECT id, count_if(vote) AS yes, count(*) AS n FROM votes GROUP BY id)"
p("agg_majority", f"WITH {VOTES}, {ROLL} SELECT id, CASE WHEN yes >= 3 THEN 'block' WHEN n - yes >= 3 THEN 'keep' ELSE 'split' END AS verdict FROM roll")
p("agg_median_consensus", "SELECT id, CAST(round(median(label), 6) AS DOUBLE) AS consensus FROM {long} GROUP BY id")
p("agg_tier_compare", f"SELECT source, tier, {N} AS n FROM (SELECT 'oracle' AS source, {tier('wo')} AS tier FROM {{wa}} UNION ALL SELECT 'student', {tier('ws')} FROM {{wa}}) t GROUP BY source, tier")
#: Three runs of one score.
p("agg_run_average", "SELECT lens, round(avg(mean4), 6) AS mean, CAST(count(DISTINCT mean4) AS BIGINT) AS distinct_values FROM (SELECT lens, round((s0 + s1 + s2) / 3, 4) AS mean4 FROM {scores}) t GROUP BY lens")
p("agg_distinct", "SELECT CAST(count(DISTINCT source) AS BIGINT) AS sources, CAST(count(DISTINCT id) AS BIGINT) AS ids, CAST(count(DISTINCT url) AS BIGINT) AS urls FROM {articles}")
p("agg_top_n", f"SELECT source, {N} AS n FROM {{articles}} WHERE length(content) > 500 GROUP BY source ORDER BY n DESC, source LIMIT 10")
p("agg_bucket_stats", f"SELECT lens % 3 AS bucket, {N} AS n, round(avg(ws), 6) AS mean, round(median(ws), 6) AS median, round(min(ws), 6) AS lo, round(max(ws), 6) AS hi FROM {{wa}} WHERE s0 >= 1 GROUP BY lens % 3")
p("agg_backtest", f"SELECT {tier('wo')} AS tier, {N} AS n, {n_if('s0 > 6')} AS flagged, round(100.0 * count_if(s0 > 6) / count(*), 6) AS pct, round(avg(s0), 6) AS mean, round(max(s0), 6) AS hi FROM {{wa}} GROUP BY 1")
TH = "(SELECT CAST(th AS DOUBLE) AS th FROM (VALUES (4.0), (4.5), (5.0), (5.5)) v(th))"
p("agg_fp_per_lens", f"SELECT lens, th, {n_if('ws >= th AND wo < 4.8')} AS fp FROM {{wa}} CROSS JOIN {TH} t GROUP BY lens, th")
p("agg_shadow_2x2", f"SELECT s0 > 5 AS model, s1 > 5 AS regex, {N} AS n FROM {{scores}} GROUP BY 1, 2")
p("agg_flag_rates", f"SELECT lens, {share('s0 > 5')} AS f0, {share('s1 > 6')} AS f1, {share('s2 < 4')} AS f2 FROM {{scores}} GROUP BY lens")
p("agg_gate_violations", f"SELECT {n_if('o0 < 4.5 AND wo > 5')} AS violations, {share('o0 < 4.5 AND wo > 5')} AS rate FROM {{wa}}")
p("agg_lens_summary", f"SELECT lens, {N} AS n, {n_if('ws >= 4.5')} AS medium, {n_if('ws >= 6')} AS high, round(100.0 * count_if(ws >= 4.5) / count(*), 6) AS medium_pct FROM {{wa}} GROUP BY lens")
#: Each id as seen by three lenses, with their averages.
TRI = "tri AS (SELECT id AS url, 'a' AS lens, (s0 + s1) / 2 AS wa FROM {scores} UNION ALL SELECT id, 'b', (s2 + s3) / 2 FROM {scores} UNION ALL SELECT id, 'c', (s4 + s5) / 2 FROM {scores})"
p("agg_overlap_matrix", f"WITH {TRI} SELECT a.lens AS la, b.lens AS lb, {n_if('a.wa >= 5 AND b.wa >= 5')} AS n, round(100.0 * count_if(a.wa >= 5 AND b.wa >= 5) / nullif(count_if(a.wa >= 5), 0), 6) AS pct_a FROM tri a JOIN tri b ON a.url = b.url AND a.lens < b.lens GROUP BY a.lens, b.lens")
p("agg_exclusivity", f"WITH {TRI}, c AS (SELECT *, count_if(wa >= 5) OVER (PARTITION BY url) AS k FROM tri) SELECT lens, {n_if('wa >= 5 AND k = 1')} AS exclusive, {n_if('wa >= 5')} AS n FROM c GROUP BY lens")
p("agg_lens_combos", f"WITH {TRI}, c AS (SELECT url, concat(max(CASE WHEN lens = 'a' AND wa >= 5 THEN 'a' ELSE '' END), max(CASE WHEN lens = 'b' AND wa >= 5 THEN 'b' ELSE '' END), max(CASE WHEN lens = 'c' AND wa >= 5 THEN 'c' ELSE '' END)) AS combo FROM tri GROUP BY url) SELECT combo, {N} AS n FROM c GROUP BY combo")
p("agg_reassign_best", f"WITH {TRI}, c AS (SELECT url, max_by(lens, wa) AS best, max(CASE WHEN lens = 'a' THEN wa END) AS wa FROM tri WHERE wa >= 4.5 GROUP BY url) SELECT best, {N} AS n, round(avg(wa), 6) AS mean_a FROM c GROUP BY best")
p("agg_stay_move_diff", "SELECT dim, round(avg(CASE WHEN id % 2 = 0 THEN label END) - avg(CASE WHEN id % 2 = 1 THEN label END), 6) AS diff FROM {long} GROUP BY dim")
p("agg_prefilter_quality", f"SELECT {share('ws >= 4.8')} AS pass_rate, {ratio('ws >= 4.8 AND wo <= 4.5', 'ws >= 4.8')} AS fp_rate, {ratio('ws < 4.8 AND wo > 5', 'wo > 5')} AS fn_rate, {ratio('ws >= 4.8 AND wo > 4.8', 'wo > 4.8')} AS recall, {ratio('ws >= 4.8 AND wo > 4.8', 'ws >= 4.8')} AS prec FROM {{wa}}")
p("agg_prefilter_recall_diff", f"SELECT CASE WHEN s0 < 5 THEN 's0' ELSE 'other' END AS reason, {ratio('ws >= 4.8', 'wo >= 5')} AS old_recall, {ratio('ws >= 4.6', 'wo >= 5')} AS new_recall FROM {{wa}} WHERE wo >= 5 GROUP BY 1")
p(
    "agg_provider_compare",
    f"WITH a AS (SELECT {tier('ws')} AS tier, {N} AS na FROM {{wa}} GROUP BY 1), b AS (SELECT {tier('wo')} AS tier, {N} AS nb FROM {{wa}} WHERE id % 2 = 0 GROUP BY 1) SELECT coalesce(a.tier, b.tier) AS tier, coalesce(na, 0) AS na, coalesce(nb, 0) AS nb, round(100.0 * coalesce(na, 0) / sum(coalesce(na, 0)) OVER () - 100.0 * coalesce(nb, 0) / sum(coalesce(nb, 0)) OVER (), 6) AS diff FROM a FULL OUTER JOIN b ON a.tier = b.tier",
)
p("agg_index_quantiles", "WITH r AS (SELECT ws, row_number() OVER (ORDER BY ws, id) - 1 AS k, count(*) OVER () AS n FROM {wa}) SELECT round(max(CASE WHEN k = 0 THEN ws END), 6) AS lo, round(max(CASE WHEN k = floor(n / 4) THEN ws END), 6) AS p25, round(max(CASE WHEN k = floor(n / 2) THEN ws END), 6) AS p50, round(max(CASE WHEN k = floor(3 * n / 4) THEN ws END), 6) AS p75, round(max(CASE WHEN k = n - 1 THEN ws END), 6) AS hi FROM r")
p("agg_disagreement_patterns", f"SELECT {tier('ws')} AS a, {tier('wo')} AS b, {N} AS n FROM {{wa}} WHERE {tier('ws')} <> {tier('wo')} GROUP BY 1, 2")
p("agg_flag_disagreement", f"SELECT {n_if('s0 > 5 AND NOT o0 > 5')} AS only_a, {n_if('o0 > 5 AND NOT s0 > 5')} AS only_b FROM {{scores}}")
p("agg_run_compare", "WITH e AS (SELECT lens AS run, dim AS epoch, avg(abs(pred - label)) AS mae FROM {long} GROUP BY lens, dim) SELECT run, round(max_by(mae, epoch), 6) AS final_mae, round(min(mae), 6) AS best_mae, round(100 * (max(mae) - min(mae)) / max(mae), 6) AS improvement FROM e GROUP BY run")
p("agg_three_way", "SELECT a.dim, round(avg(a.label), 6) AS a, round(avg(b.label), 6) AS b, round(avg(c.label), 6) AS c, round(avg(a.label) - avg(b.label), 6) AS ab FROM {long} a JOIN {long} b ON a.id = b.id AND a.dim = b.dim JOIN {long} c ON a.id = c.id AND a.dim = c.dim WHERE a.lens < 8 AND b.pred > 3 AND c.pred < 8 GROUP BY a.dim")

# -- windows, ranks, sort, top-k
RANK = "rank() OVER (ORDER BY {0}) + (count(*) OVER (PARTITION BY {0}) - 1) / 2.0"
p("win_avg_rank", f"SELECT id, CAST({RANK.format('r')} AS DOUBLE) AS avg_rank FROM (SELECT id, round(ws, 1) AS r FROM {{wa}}) t")
p("win_ecdf", "SELECT id, round(cume_dist() OVER (ORDER BY ws) * 10, 6) AS y FROM {wa}")
p("win_quintile", "SELECT id, CAST(floor((row_number() OVER (ORDER BY ws, id) - 1) * 5 / count(*) OVER ()) AS BIGINT) AS quintile FROM {wa}")
p("sort_newest", "SELECT event_id, CAST(row_number() OVER (ORDER BY ts DESC, event_id) AS BIGINT) AS k FROM {events} ORDER BY k LIMIT 500")
p("sort_two_key", "SELECT id, lens, round(ws, 6) AS wa FROM {wa} ORDER BY CASE WHEN lens % 2 = 0 THEN 0 ELSE 1 END, ws DESC, id LIMIT 100")
p("topk_disagreement", "SELECT id, round(abs(ws - wo), 6) AS gap FROM {wa} ORDER BY abs(ws - wo) DESC, id LIMIT 30")
p("topk_worst_per_dim", "SELECT dim, id, err FROM (SELECT dim, id, round(abs(pred - label), 6) AS err, row_number() OVER (PARTITION BY dim ORDER BY abs(pred - label) DESC, id) AS k FROM {long}) t WHERE k <= 10")
p("topk_confidence", "SELECT id, round(ws / 10, 6) AS confidence FROM {wa} WHERE ws >= 4.5 ORDER BY ws DESC, id LIMIT 50")
p("topk_chunks", "SELECT lens, id, CAST(pos AS BIGINT) AS pos FROM (SELECT lens, id, row_number() OVER (PARTITION BY lens ORDER BY id) AS pos, row_number() OVER (PARTITION BY lens ORDER BY ws DESC, id) AS k FROM {wa}) t WHERE k <= 3")
p("win_last_epoch", "SELECT lens, dim, mae FROM (SELECT lens, dim, round(avg(abs(pred - label)), 6) AS mae, row_number() OVER (PARTITION BY lens ORDER BY dim DESC) AS k FROM {long} GROUP BY lens, dim) t WHERE k = 1")
p("win_leaderboard", "WITH m AS (SELECT lens, avg(abs(pred - label)) AS mae FROM {long} GROUP BY lens) SELECT lens, round(mae, 6) AS mae, round(mae - b, 6) AS delta, round(100 * (mae - b) / b, 6) AS delta_pct FROM m CROSS JOIN (SELECT max(CASE WHEN lens = 0 THEN mae END) AS b FROM m) x")

# -- metrics
p("met_mae_rmse", "SELECT dim, round(avg(abs(pred - label)), 6) AS mae, round(sqrt(avg((pred - label) * (pred - label))), 6) AS rmse FROM {long} GROUP BY dim")
TOP = "r AS (SELECT id, ws, wo, row_number() OVER (ORDER BY ws DESC, id) AS rp, row_number() OVER (ORDER BY wo DESC, id) AS rt FROM {wa})"
KS = "(SELECT k FROM (VALUES (10), (20), (50)) v(k))"
p("met_recall_at_k", f"WITH {TOP} SELECT CAST(k AS BIGINT) AS k, round(CAST(count_if(rp <= k AND rt <= k) AS DOUBLE) / k, 6) AS recall FROM r CROSS JOIN {KS} t GROUP BY k")
p("met_ndcg", f"WITH {TOP} SELECT CAST(k AS BIGINT) AS k, round(sum(CASE WHEN rp <= k THEN wo / log2(rp + 1) ELSE 0 END) / sum(CASE WHEN rt <= k THEN wo / log2(rt + 1) ELSE 0 END), 6) AS ndcg FROM r CROSS JOIN {KS} t GROUP BY k")
p("met_fn_rate", f"SELECT {ratio('wo >= 5 AND ws < 5', 'wo >= 5')} AS fn_rate, {ratio('wo >= 5 AND ws >= 5', 'wo >= 5')} AS recall FROM {{wa}}")
p("met_mae_band", f"SELECT {BAND.format('label')} AS band, {N} AS n, round(avg(abs(pred - label)), 6) AS mae FROM {{long}} GROUP BY 1")
CONF = f"{n_if('wo >= {t} AND ws >= {t}')} AS tp, {n_if('wo < {t} AND ws >= {t}')} AS fp, {n_if('wo >= {t} AND ws < {t}')} AS fn, {n_if('wo < {t} AND ws < {t}')} AS tn"
GATE = f"{CONF}, {ratio('wo >= {t} AND ws >= {t}', 'wo >= {t}')} AS recall, {ratio('wo >= {t} AND ws >= {t}', 'ws >= {t}')} AS prec, {ratio('wo < {t} AND ws < {t}', 'wo < {t}')} AS specificity, round(avg(abs(ws - wo)), 6) AS mae"
p("met_gate_eval", f"SELECT {GATE.replace('{t}', '5')} FROM {{wa}}")
p("gate_ground_truth", f"SELECT lens, {GATE.replace('{t}', '5')} FROM {{wa}} GROUP BY lens")
SPEAR = f"k AS (SELECT lens, CAST({RANK.format('ws')} AS DOUBLE) AS ra, CAST({RANK.format('wo')} AS DOUBLE) AS rb FROM {{wa}})"
p("met_spearman", f"WITH {SPEAR} SELECT round(coalesce(corr(ra, rb), 0), 6) AS rho FROM k")
p("met_pearson", "SELECT lens, CASE WHEN count(*) >= 10 THEN round(corr(ws, wo), 6) END AS r FROM {wa} GROUP BY lens")
PAIRS = [(i, j) for i in range(6) for j in range(i + 1, 6)]
p("met_corr_matrix", " UNION ALL ".join(f"SELECT {i} AS a, {j} AS b, round(corr(o{i}, o{j}), 6) AS r, abs(corr(o{i}, o{j})) > 0.7 AS redundant FROM {{scores}}" for i, j in PAIRS))
p("met_error_corr", " UNION ALL ".join(f"SELECT {i} AS a, {j} AS b, round(corr(s{i} - o{i}, s{j} - o{j}), 6) AS r FROM {{scores}}" for i, j in PAIRS))
p("met_slope", "SELECT dim, round(corr(pred, label), 6) AS r, round(covar_pop(pred, label) / var_pop(pred), 6) AS slope FROM {long} GROUP BY dim")
WILSON = "((k / n + 1.9208 / n) - 1.96 * sqrt((k / n) * (1 - k / n) / n + 0.9604 / (n * n))) / (1 + 3.8416 / n)"
p("met_wilson", f"SELECT lens, round(CASE WHEN n = 0 THEN 0 ELSE {WILSON} END, 6) AS lower FROM (SELECT lens, CAST(count_if(ws >= 5) AS DOUBLE) AS k, CAST(count(*) AS DOUBLE) AS n FROM {{wa}} GROUP BY lens) t")
GATE_KINDS = "CASE id % 5 WHEN 0 THEN 'declined' WHEN 1 THEN 'reference' WHEN 2 THEN 'protected' END"
p(
    "gate_agreement",
    f"WITH x AS (SELECT *, {GATE_KINDS} AS kind FROM {{wa}}), k AS (SELECT CAST({RANK.format('wo')} AS DOUBLE) AS ra, CAST({RANK.format('ws')} AS DOUBLE) AS rb FROM x WHERE kind = 'reference'), "
    "s AS (SELECT round(coalesce(corr(ra, rb), 0), 6) AS rho FROM k), "
    f"g AS (SELECT CAST(count_if(kind = 'declined' AND ws < 5) AS DOUBLE) AS k, CAST(count_if(kind = 'declined') AS DOUBLE) AS n, {ratio('kind = ' + chr(39) + 'reference' + chr(39) + ' AND wo >= 5 AND ws < 5', 'kind = ' + chr(39) + 'reference' + chr(39) + ' AND wo >= 5')} AS shift, "
    f"{ratio('kind = ' + chr(39) + 'protected' + chr(39) + ' AND ws >= 5', 'kind = ' + chr(39) + 'protected' + chr(39))} AS protection FROM x) "
    f"SELECT round({WILSON}, 6) AS demotion_low, shift, protection, rho, {WILSON} >= 0.9 AND shift <= 0.05 AND protection >= 0.7 AND rho >= 0.6 AS passed FROM g CROSS JOIN s",
)
GRID = "(SELECT CAST(3 + g * 0.025 AS DOUBLE) AS th FROM (SELECT a.x * 10 + b.x AS g FROM (VALUES (0), (1), (2), (3), (4), (5), (6), (7), (8), (9)) a(x) CROSS JOIN (VALUES (0), (1), (2), (3), (4), (5), (6), (7), (8), (9)) b(x)) y)"
p("met_threshold_curve", f"SELECT round(th, 6) AS th, {ratio('wo >= 5 AND ws < th', 'wo >= 5')} AS fn_rate, {ratio('wo >= 5 AND ws >= th', 'wo >= 5')} AS recall, {share('ws >= th')} AS stage2_rate FROM {{wa}} CROSS JOIN {GRID} g GROUP BY th")
p("met_select_threshold", f"SELECT round(max(CASE WHEN fn <= 0.02 THEN th END), 6) AS threshold FROM (SELECT th, coalesce(CAST(count_if(wo >= 5 AND ws < th) AS DOUBLE) / nullif(count_if(wo >= 5), 0), 0) AS fn FROM {{wa}} CROSS JOIN {GRID} g GROUP BY th) t")
p("met_hybrid_sweep", f"SELECT th, {share('ws < th')} AS stage1_pct, {ratio('wo >= 5 AND ws < th', 'wo >= 5')} AS fn_rate, round(1 / (1 - 0.6 * CAST(count_if(ws < th) AS DOUBLE) / count(*)), 6) AS speedup FROM {{wa}} CROSS JOIN {TH} t GROUP BY th")
p("met_hybrid_vs_model", f"SELECT th, {share('ws < th')} AS stage1_pct, {ratio('s0 >= 5 AND ws < th', 's0 >= 5')} AS fn_rate FROM {{wa}} CROSS JOIN {TH} t GROUP BY th")
p("met_pr_sweep", f"SELECT th, {ratio('wo >= 5 AND ws >= th', 'ws >= th')} AS prec, {ratio('wo >= 5 AND ws >= th', 'wo >= 5')} AS recall FROM {{wa}} CROSS JOIN {TH} t GROUP BY th")
p("met_bias", "SELECT dim, round(avg(pred - label), 6) AS mean, round(median(pred - label), 6) AS median, round(stddev_pop(pred - label), 6) AS sd FROM {long} GROUP BY dim")
MOM = "m AS (SELECT dim, avg(pred - label) AS mu FROM {long} GROUP BY dim), c AS (SELECT l.dim, l.pred - l.label - m.mu AS e, l.pred - l.label AS raw FROM {long} l JOIN m ON l.dim = m.dim)"
p("met_moments", f"WITH {MOM} SELECT dim, round(avg(e * e * e) / power(avg(e * e), 1.5), 6) AS skewness, round(avg(e * e * e * e) / power(avg(e * e), 2) - 3, 6) AS kurtosis, round(PCT(raw, 0.05), 6) AS p5, round(PCT(raw, 0.95), 6) AS p95 FROM c GROUP BY dim")
p("met_mannwhitney_u", f"WITH k AS (SELECT lens % 2 AS g, CAST({RANK.format('ws')} AS DOUBLE) AS r FROM {{wa}}) SELECT round(sum(CASE WHEN g = 0 THEN r ELSE 0 END) - count_if(g = 0) * (count_if(g = 0) + 1) / 2.0, 6) AS u FROM k")
p("met_error_by_range", f"SELECT {BAND.format('label')} AS band, {N} AS n, round(avg(pred - label), 6) AS mean_error, round(avg(abs(pred - label)), 6) AS mae, round(stddev_pop(pred - label), 6) AS sd FROM {{long}} GROUP BY 1")
p("met_tier_confusion", f"SELECT {tier('wo')} AS truth, {tier('ws')} AS pred, {N} AS n FROM {{wa}} GROUP BY 1, 2")
p(
    "met_length_error",
    "WITH j AS (SELECT length(a.content) AS len, abs(s.ws - s.wo) AS err FROM {articles} a JOIN {wa} s ON a.id = s.id), k AS (SELECT len, err, CAST(" + RANK.format("len") + " AS DOUBLE) AS ra, CAST(" + RANK.format("err") + " AS DOUBLE) AS rb FROM j) SELECT round(CAST(count_if(len > 3000) AS DOUBLE) / count(*), 6) AS truncated, round(corr(ra, rb), 6) AS rho, round(avg(CASE WHEN len > 3000 THEN err END), 6) AS mae_truncated, round(avg(CASE WHEN len <= 3000 THEN err END), 6) AS mae_whole FROM k",
)
p("met_error_summary", "SELECT dim, round(PCT(abs(pred - label), 0.5), 6) AS median, round(PCT(abs(pred - label), 0.25), 6) AS q25, round(PCT(abs(pred - label), 0.75), 6) AS q75, round(avg(abs(pred - label)) - 0.5, 6) AS gap FROM {long} GROUP BY dim")
p(
    "met_oracle_alignment",
    "WITH c AS (SELECT id, median(label) AS consensus FROM {long} GROUP BY id), j AS (SELECT l.dim, l.label, CAST(c.consensus AS DOUBLE) AS consensus FROM {long} l JOIN c ON l.id = c.id) SELECT dim, round(corr(label, consensus), 6) AS r, round(avg(abs(label - consensus)), 6) AS mae FROM j GROUP BY dim",
)
p("met_hard_cases", f"WITH {VOTES}, {ROLL} SELECT id FROM roll WHERE yes < 3 AND n - yes < 3")
p("met_panel_rollup", f"WITH {VOTES}, {ROLL} SELECT {n_if('yes = n')} AS all_block, {n_if('yes = 0')} AS all_keep, {n_if('yes = 2')} AS adjudicate, {ratio('r.yes >= 3 AND s.o0 > 5', 'r.yes >= 3')} AS block_precision FROM roll r JOIN {{scores}} s ON r.id = s.id")
#: Rows that were scored twice: the documents whose text is another's, as both ids were scored.
TWICE = "k AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY md5(text)) AS first FROM {documents})"
p("met_consistency", f"WITH {TWICE} SELECT round(avg(d), 6) AS mean_diff, round(max(d), 6) AS max_diff, avg(d) <= 1.0 AS acceptable FROM (SELECT abs(a.ws - b.ws) AS d FROM k JOIN {{wa}} a ON a.id = k.doc_id JOIN {{wa}} b ON b.id = k.first WHERE k.doc_id <> k.first) t")
p("met_classifier", "WITH j AS (SELECT l.quality = 1 AS y, length(d.text) - length(translate(d.text, '#*$%&|', '')) < 20 AS p FROM {labels} l JOIN {documents} d ON l.doc_id = d.doc_id) SELECT " + f"{share('y = p')} AS accuracy, {ratio('y AND p', 'p')} AS prec, {ratio('y AND p', 'y')} AS recall, round(2.0 * count_if(y AND p) / (2 * count_if(y AND p) + count_if(y <> p)), 6) AS f1 FROM j")
p("met_within_threshold", f"SELECT dim, {share('abs(pred - label) <= 0.5')} AS w05, {share('abs(pred - label) <= 1')} AS w10, {share('abs(pred - label) <= 1.5')} AS w15, {share('abs(pred - label) <= 2')} AS w20 FROM {{long}} GROUP BY dim")
p("met_filter_scenarios", f"SELECT {n_if('ws < 4.5')} AS rejected, {n_if('ws < 4.5 AND wo >= 5')} AS good_rejected, {n_if('ws >= 4.5 AND wo < 4.5')} AS bad_kept FROM {{wa}}")
p("met_probe_check", "SELECT th, round(avg(abs(ws - wo)), 6) AS mae, round(avg(ws - wo), 6) AS bias, round(coalesce(CAST(count_if(wo >= th AND ws >= th) AS DOUBLE) / nullif(count_if(wo >= th), 0), 1), 6) AS recall, " + share("ws < th") + f" AS skip_rate FROM {{wa}} CROSS JOIN {TH} t GROUP BY th")
p("met_panel_agreement", f"WITH {VOTES}, {ROLL} SELECT round(avg(CASE WHEN (r.yes >= 3) = (s.o0 > 5) THEN 1.0 ELSE 0.0 END), 6) AS agreement, avg(CASE WHEN (r.yes >= 3) = (s.o0 > 5) THEN 1.0 ELSE 0.0 END) >= 0.95 AS passed FROM roll r JOIN {{scores}} s ON r.id = s.id WHERE r.yes <> 2")

# -- data quality
TRAIN = "t AS (SELECT id, title, content, CASE WHEN id % 10 < 8 THEN 'train' WHEN id % 10 = 8 THEN 'val' ELSE 'test' END AS split FROM {articles})"
p("dq_structure", f"SELECT {n_if('title IS NULL')} AS no_title, {n_if('content IS NULL')} AS no_content, {n_if('id IS NULL')} AS no_id, {N} AS n FROM {{articles}}")
p("dq_split_share", f"WITH {TRAIN} SELECT split, n, round(100.0 * n / sum(n) OVER (), 6) AS pct, CASE WHEN split = 'train' THEN abs(100.0 * n / sum(n) OVER () - 80) <= 5 ELSE abs(100.0 * n / sum(n) OVER () - 10) <= 3 END AS ok FROM (SELECT split, {N} AS n FROM t GROUP BY split) x")
p("dq_labels", f"SELECT {n_if('label < 0 OR label > 10')} AS out_of_range, {n_if('label IS NULL OR isnan(label)')} AS missing, {n_if('label = 0')} AS zero FROM {{long}}")
p("dq_content", f"SELECT {n_if(chr(116) + chr(114) + 'im(title) = ' + chr(39) * 2)} AS empty_title, {n_if('trim(content) = ' + chr(39) * 2)} AS empty_content FROM {{articles}}")
p("dq_dimensions", "SELECT CAST(count(DISTINCT names) AS BIGINT) AS distinct_names, count(DISTINCT names) = 1 AND bool_and(names = '0,1,2,3,4,5') AS consistent FROM (SELECT id, string_agg(CAST(dim AS STRING), ',' ORDER BY dim) AS names FROM {long} GROUP BY id) t")
p("dq_report", f"SELECT 'out_of_range' AS check_name, 'issue' AS severity, {n_if('label < 0 OR label > 10')} AS n FROM {{long}} UNION ALL SELECT 'short_content', 'warning', {n_if('length(content) < 300')} FROM {{articles}} UNION ALL SELECT 'empty_title', 'warning', {n_if('trim(title) = ' + chr(39) * 2)} FROM {{articles}}")
p("dq_complete_scores", f"SELECT {n_if('s0 IS NOT NULL AND s1 IS NOT NULL AND s2 IS NOT NULL')} AS complete, {N} AS n FROM {{scores}}")
#: Run on rows that are not filtered yet, so that there is something to find.
p("dq_hard_verify", f"SELECT {n_if('length(content) < 300')} AS short, {n_if('trim(content) = ' + chr(39) * 2)} AS empty, {n_if('b.item_id IS NOT NULL')} AS probes, {N} AS n FROM {{articles}} a LEFT JOIN (SELECT DISTINCT item_id FROM {{benchmark}}) b ON a.id = b.item_id")
