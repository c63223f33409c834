"""Score math over the stand-in scores; the flagship query is score_pipeline."""

from __future__ import annotations

from pyspark.sql import functions as F

from lensmill import packages as P
from lensmill.functions import rules as R
from lensmill.functions import scoring as S
from lensmill.plans.registry import query
from lensmill.plans.views import ARTICLES, SCORES, WA, WEIGHTS, articles, big, q, r6, scores, table, weighted, with_wa

C = F.col
D = "CAST({} AS DOUBLE)".format


def both(name: str, build, sql: str, source: str = "wa"):
    """A query of one column ``out`` over the scores with their averages."""
    query(name, q(f"SELECT id, {sql} AS out FROM {source}", SCORES, WA))(lambda spark, d: with_wa(spark, d).select("id", build().alias("out")))


both("score_clamp", lambda: r6(S.clamp(C("s0") * 3 - 8)), f"round(greatest({D(0)}, least({D(10)}, s0 * 3 - 8)), 6)")
both("score_weighted_avg", lambda: r6(weighted("s")), "round(ws, 6)")
both("score_gatekeeper", lambda: r6(S.gated(C("ws"), C("s0"), 4.5, 4.0)[0]), f"round(CASE WHEN s0 < 4.5 AND ws > 4 THEN {D(4)} ELSE ws END, 6)")
TIERS = (("high", 6.0), ("medium", 4.5), ("low", 3.0))
TIER_SQL = "CASE WHEN {0} >= 6 THEN 'high' WHEN {0} >= 4.5 THEN 'medium' WHEN {0} >= 3 THEN 'low' ELSE '{1}' END"
both("score_tier", lambda: S.tier(C("ws"), TIERS, "low"), TIER_SQL.format("ws", "low"))
both("score_train_tier", lambda: S.tier(C("wo"), TIERS, "low"), TIER_SQL.format("wo", "low"))
both("score_bin", lambda: F.when(C("ws") >= 8, "8-10").when(C("ws") >= 6, "6-8").when(C("ws") >= 4, "4-6").when(C("ws") >= 2, "2-4").otherwise("0-2"), "CASE WHEN ws >= 8 THEN '8-10' WHEN ws >= 6 THEN '6-8' WHEN ws >= 4 THEN '4-6' WHEN ws >= 2 THEN '2-4' ELSE '0-2' END")
both(
    "score_overall",
    lambda: r6(F.coalesce(F.nullif(F.when(C("id") % 3 == 0, C("ws")).when(C("id") % 3 == 1, F.lit(0.0)), F.lit(0.0)), F.when(C("id") % 2 == 0, C("wo")), (C("s0") + C("s1") + C("s2") + C("s3") + C("s4") + C("s5")) / 6)),
    f"round(coalesce(nullif(CASE WHEN id % 3 = 0 THEN ws WHEN id % 3 = 1 THEN {D(0)} END, {D(0)}), CASE WHEN id % 2 = 0 THEN wo END, (s0 + s1 + s2 + s3 + s4 + s5) / 6), 6)",
)
both("score_sample_weight", lambda: r6(1 + C("wo") * 0.5), "round(1 + wo * CAST(0.5 AS DOUBLE), 6)")
both("score_binary_label", lambda: F.when(S.gated(C("wo"), C("o0"), 3.0, 3.5)[0] >= 5, 1).otherwise(0).cast("bigint"), "CAST(CASE WHEN (CASE WHEN o0 < 3 AND wo > 3.5 THEN 3.5 ELSE wo END) >= 5 THEN 1 ELSE 0 END AS BIGINT)")
both("score_screen_wa", lambda: r6(S.weighted_average([S.clamp(C(f"s{i}") * 1.5 - 2) for i in range(6)], WEIGHTS)), "round(" + " + ".join(f"greatest({D(0)}, least({D(10)}, s{i} * {D(1.5)} - 2)) * {D(w)}" for i, w in enumerate(WEIGHTS)) + ", 6)")
both("score_surfacing", lambda: r6(F.coalesce(F.when(C("id") % 4 == 0, C("wo")), S.gated(C("ws"), C("s0"), 4.5, 4.0)[0])), f"round(coalesce(CASE WHEN id % 4 = 0 THEN wo END, CASE WHEN s0 < 4.5 AND ws > 4 THEN {D(4)} ELSE ws END), 6)")
both("score_gate_min", lambda: r6(F.when(C("s0") < 4.5, F.least(C("ws"), F.lit(4.0))).otherwise(C("ws"))), f"round(CASE WHEN s0 < 4.5 THEN least(ws, {D(4)}) ELSE ws END, 6)")
both(
    "score_typed_renorm",
    lambda: r6(F.when(C("lens") % 2 == 0, (C("s0") * 0.25 + C("s1") * 0.2 + C("s2") * 0.2) / 0.65).otherwise(C("ws"))),
    f"round(CASE WHEN lens % 2 = 0 THEN (s0 * {D(0.25)} + s1 * {D(0.2)} + s2 * {D(0.2)}) / {D(0.65)} ELSE ws END, 6)",
)
both("post_signal_strength", lambda: r6((C("s0") * 0.4 + C("s1") * 0.3 + C("s2") * 0.2) / (0.4 + 0.3 + 0.2)), f"round((s0 * {D(0.4)} + s1 * {D(0.3)} + s2 * {D(0.2)}) / ({D(0.4)} + {D(0.3)} + {D(0.2)}), 6)")
INVEST = "CASE WHEN s5 < 4 THEN 'NOISE' WHEN s0 >= 6.5 AND s1 >= 5 THEN 'RED' WHEN s2 >= 6.5 THEN 'YELLOW' WHEN s3 >= 6 AND s4 >= 5 THEN 'GREEN' WHEN s4 >= 5.5 THEN 'BLUE' ELSE 'NOISE' END"
both(
    "post_investment_tier",
    lambda: F.when(C("s5") < 4, "NOISE").when((C("s0") >= 6.5) & (C("s1") >= 5), "RED").when(C("s2") >= 6.5, "YELLOW").when((C("s3") >= 6) & (C("s4") >= 5), "GREEN").when(C("s4") >= 5.5, "BLUE").otherwise("NOISE"),
    INVEST,
)
MEAN = "((s0 + s1 + s2 + s3 + s4 + s5) / 6)"
mean = lambda: (C("s0") + C("s1") + C("s2") + C("s3") + C("s4") + C("s5")) / 6
both("post_uplifting_tier", lambda: F.when(mean() >= 7, "impact").when(C("s1") >= 6.5, "connection").when((C("s2") >= 7) & (C("s1") >= 3), "wonder").otherwise("not_uplifting"), f"CASE WHEN {MEAN} >= 7 THEN 'impact' WHEN s1 >= 6.5 THEN 'connection' WHEN s2 >= 7 AND s1 >= 3 THEN 'wonder' ELSE 'not_uplifting' END")
both("post_tone_weight", lambda: r6(C("ws") * F.when(F.abs(C("s2") - 5) < 0.5, F.lit(0.5)).when(C("s4") < 4, F.lit(0.8)).otherwise(F.lit(1.0))), f"round(ws * CASE WHEN abs(s2 - 5) < 0.5 THEN {D(0.5)} WHEN s4 < 4 THEN {D(0.8)} ELSE {D(1)} END, 6)")


@query("score_prop_cap", q(" UNION ALL ".join(f"SELECT id, CAST({i} AS BIGINT) AS dim, round(CASE WHEN ws > 2 THEN o{i} * (CAST(2 AS DOUBLE) / ws) ELSE o{i} END, 2) AS label FROM wa" for i in range(3)), SCORES, WA))
def score_prop_cap(spark, d):
    capped = S.proportional_cap(F.array("o0", "o1", "o2"), C("ws"))
    return with_wa(spark, d).select("id", F.posexplode(capped).alias("dim", "label")).select("id", big(C("dim")).alias("dim"), F.round("label", 2).alias("label"))


CAPS = ((0, 4.0), (1, 5.0), (2, 6.0))


@query("score_cap_adherence", q("SELECT ctype, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (s0 > cap) AS BIGINT) AS above FROM (SELECT s0, CAST(lens % 3 AS BIGINT) AS ctype FROM scores) JOIN (VALUES (0, 4.0), (1, 5.0), (2, 6.0)) c(ct, cap) ON ctype = ct GROUP BY ctype", SCORES))
def score_cap_adherence(spark, d):
    caps = spark.createDataFrame(CAPS, "ctype bigint, cap double")
    s = scores(spark, d).select("s0", big(C("lens") % 3).alias("ctype"))
    return s.join(F.broadcast(caps), "ctype").groupBy("ctype").agg(F.count("*").alias("n"), F.count_if(C("s0") > C("cap")).alias("above"))


@query("score_cap_sweep", q("SELECT cap, CAST(count(*) FILTER ((CASE WHEN s0 < 4.5 AND ws > cap THEN cap ELSE ws END) >= 4.5) AS BIGINT) AS positive FROM wa, (SELECT CAST(unnest([3.0, 4.0, 5.0]) AS DOUBLE) AS cap) GROUP BY cap", SCORES, WA))
def score_cap_sweep(spark, d):
    s = with_wa(spark, d).select("ws", "s0", F.explode(F.array(F.lit(3.0), F.lit(4.0), F.lit(5.0))).alias("cap"))
    gate = F.when((C("s0") < 4.5) & (C("ws") > C("cap")), C("cap")).otherwise(C("ws"))
    return s.groupBy("cap").agg(F.count_if(gate >= 4.5).alias("positive"))


ALT = {"deployed": WEIGHTS, "flat": (1 / 6,) * 6, "front": (0.5, 0.1, 0.1, 0.1, 0.1, 0.1)}


@query("score_alt_weights", q(" UNION ALL ".join(f"SELECT '{n}' AS scheme, CAST(count(*) FILTER (({' + '.join(f's{i} * {D(repr(w))}' for i, w in enumerate(ws))}) >= 4.5) AS BIGINT) AS n45, CAST(count(*) FILTER (({' + '.join(f's{i} * {D(repr(w))}' for i, w in enumerate(ws))}) >= 7) AS BIGINT) AS n70 FROM scores" for n, ws in ALT.items()), SCORES))
def score_alt_weights(spark, d):
    tried = F.array(*(F.struct(F.lit(n).alias("scheme"), weighted("s", ws).alias("wa")) for n, ws in ALT.items()))
    s = scores(spark, d).select(F.explode(tried).alias("x"))
    return s.groupBy(C("x.scheme").alias("scheme")).agg(F.count_if(C("x.wa") >= 4.5).alias("n45"), F.count_if(C("x.wa") >= 7).alias("n70"))


XS, YS = (0.0, 2.0, 4.0, 4.5, 5.5, 8.0, 10.0), (0.0, 1.0, 3.0, 4.5, 6.0, 8.0, 10.0)


def interp_sql(v: str, xs=XS, ys=YS) -> str:
    x, y = ("[" + ", ".join(D(repr(a)) for a in arr) + "]" for arr in (xs, ys))
    j = f"greatest(1, least(len(list_filter({x}, lambda e: e <= {v})), {len(xs) - 1}))"
    at = lambda arr, k: f"list_extract({arr}, {j} + {k})"
    return f"CASE WHEN {v} <= {xs[0]!r} THEN {D(ys[0])} WHEN {v} >= {xs[-1]!r} THEN {D(ys[-1])} ELSE {at(y, 0)} + ({v} - {at(x, 0)}) * ({at(y, 1)} - {at(y, 0)}) / ({at(x, 1)} - {at(x, 0)}) END"


both("calib_apply", lambda: r6(S.calibrate(C("s0"), XS, YS)), f"round({interp_sql('s0')}, 6)")
both("norm_apply", lambda: r6(S.calibrate(C("ws"), XS, YS)), f"round({interp_sql('ws')}, 6)")
both("norm_apply_batch", lambda: r6(S.interpolate(C("wo"), XS, YS)), f"round({interp_sql('wo')}, 6)")


@query("calib_fit")
def calib_fit(spark, d):
    rows = []
    for i in range(6):
        xs, ys = S.fit_calibration(scores(spark, d), f"o{i}", f"s{i}")
        rows += [(i, k, x, y) for k, (x, y) in enumerate(zip(xs, ys, strict=True))]
    return spark.createDataFrame(rows, "dim bigint, k bigint, x double, y double")


@query(
    "norm_fit",
    q(
        "SELECT CAST(k AS BIGINT) AS k, round(x, 6) AS x, round(y, 6) AS y FROM (SELECT k, any_value(x) AS x, CAST(count(*) FILTER (ws <= x) AS DOUBLE) / count(*) * 10 AS y FROM g, wa GROUP BY k)",
        SCORES, WA,
        "m AS (SELECT min(ws) AS lo, max(ws) AS hi FROM wa)",
        "g AS (SELECT k, CASE WHEN k = 199 THEN hi ELSE lo + k * ((hi - lo) / 199) END AS x FROM m, (SELECT unnest(range(200)) AS k))",
    ),
)
def norm_fit(spark, d):
    return S.fit_normalization(with_wa(spark, d), "ws")


@query("norm_op_point", "SELECT 'nature_recovery' AS name, CAST(3.75 AS DOUBLE) AS op_point UNION ALL SELECT 'uplifting', CAST(4 AS DOUBLE)")
def norm_op_point(spark, d):
    rows = [(s.name, n, t) for s in S.DEPLOYED if s.name in ("nature_recovery", "uplifting") for n, t in s.tiers]
    return spark.createDataFrame(rows, "name string, tier string, threshold double").filter("threshold > 0").groupBy("name").agg(F.min("threshold").alias("op_point"))


@query("norm_guards", q("SELECT count(*) >= 200 AS enough, abs(min(ws) - 2.7) <= 0.05 AND min(ws) <= 4.5 AS raw_min_ok, min(ws) <= 4.5 AS sample_min_ok, abs(min(ws) - 4) > 0.5 AS gap_warning FROM wa", SCORES, WA))
def norm_guards(spark, d):
    return with_wa(spark, d).agg((F.count("*") >= 200).alias("enough"), ((F.abs(F.min("ws") - 2.7) <= 0.05) & (F.min("ws") <= 4.5)).alias("raw_min_ok"), (F.min("ws") <= 4.5).alias("sample_min_ok"), (F.abs(F.min("ws") - 4) > 0.5).alias("gap_warning"))


query("norm_scale_factor", q("SELECT round(10 / max(ws), 6) AS scale FROM wa", SCORES, WA))(lambda spark, d: with_wa(spark, d).agg(r6(10 / F.max("ws")).alias("scale")))
both(
    "hybrid_route",
    lambda: F.when(C("ws") >= 4.9, S.tier(S.gated(C("wo"), C("o0"), 4.5, 4.0)[0], TIERS)).otherwise("stage1_low"),
    "CASE WHEN ws >= 4.9 THEN " + TIER_SQL.format("(CASE WHEN o0 < 4.5 AND wo > 4 THEN 4 ELSE wo END)", "low") + " ELSE 'stage1_low' END",
)

STANDARD = R.Package("standard", 1, categories=P.UPLIFTING.categories, domains=P.DOMAINS)
SCORING = S.Scoring("flagship", 1, WEIGHTS, 0, 4.5, 4.0, TIERS)


@query(
    "score_pipeline",
    q(
        f"SELECT language, tier, CAST(count(*) AS BIGINT) AS n, round(avg(w), 6) AS mean_wa, CAST(count(*) FILTER (hit) AS BIGINT) AS gated FROM (SELECT language, w, hit, {TIER_SQL.format('w', 'low')} AS tier FROM (SELECT p.language, s0 < 4.5 AND ws > 4 AS hit, CASE WHEN s0 < 4.5 AND ws > 4 THEN {D(4)} ELSE ws END AS w FROM p JOIN wa s ON p.id % (SELECT count(*) FROM embeddings) = s.id WHERE reason IS NULL)) GROUP BY language, tier",
        ARTICLES, SCORES, WA,
        f"p AS (SELECT *, {R.package_sql(STANDARD)} AS reason FROM (SELECT *, lower(concat_ws(' ', title, substring(content, 1, 2000))) AS t FROM articles))",
    ),
)
def score_pipeline(spark, d):
    """Prefilter, join with the scores, clamp, average, gate, tier; counts by language and tier. One shuffle for the counts."""
    a = R.apply_package(articles(spark, d), STANDARD, lambda: F.lower(F.concat_ws(" ", "title", F.substring("content", 1, 2000))))
    n = table(spark, d, "embeddings").agg(F.count("*").alias("n"))
    kept = a.filter("passed_prefilter").select("language", (C("id") % n.scalar()).alias("sid"))
    s = S.score(scores(spark, d), [f"s{i}" for i in range(6)], SCORING)
    j = kept.join(s.withColumnRenamed("id", "sid"), "sid")
    return j.groupBy("language", "tier").agg(F.count("*").alias("n"), r6(F.avg("weighted_average")).alias("mean_wa"), F.count_if("gatekeeper_applied").alias("gated"))
