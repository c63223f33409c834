"""Filters, predicates and rule packages. Text: the article with a topical sentence before it, so that rules fire."""

from __future__ import annotations

from pyspark.sql import functions as F

from lensmill import packages as P
from lensmill.functions import rules as R
from lensmill.functions import scoring as S
from lensmill.plans.registry import query
from lensmill.plans.views import ARTICLES, SCORES, WA, articles, big, q, r6, with_wa

C = F.col
_arr = ", ".join("'" + t.replace("'", "''") + "'" for t in P.TOPICS)
N = len(P.TOPICS)
TOPICAL = f"""tp AS (SELECT id, url, source, language, CASE WHEN id % 41 = 0 THEN NULL WHEN id % 43 = 0 THEN '  ' WHEN id % 47 = 0 THEN 'RIP ' || title ELSE title END AS title,
  CASE WHEN id % 53 = 0 THEN NULL WHEN id % 59 = 0 THEN '   ' ELSE list_extract([{_arr}], CAST(id % {N} + 1 AS BIGINT)) || ' ' || content END AS content FROM articles)"""
TEXT = "tx AS (SELECT *, lower(concat_ws(' ', title, substring(content, 1, 2000))) AS t, lower(title) AS title_lower FROM tp)"


def topical(spark, d):
    a = articles(spark, d)
    title = F.when(C("id") % 41 == 0, F.lit(None).cast("string")).when(C("id") % 43 == 0, "  ").when(C("id") % 47 == 0, F.concat(F.lit("RIP "), "title")).otherwise(C("title"))
    topic = F.get(F.array(*map(F.lit, P.TOPICS)), (C("id") % N).cast("int"))
    content = F.when(C("id") % 53 == 0, F.lit(None).cast("string")).when(C("id") % 59 == 0, "   ").otherwise(F.concat(topic, F.lit(" "), "content"))
    a = a.select("id", "url", "source", "language", title.alias("title"), content.alias("content"))
    return a.withColumns({"t": F.lower(F.concat_ws(" ", "title", F.substring("content", 1, 2000))), "title_lower": F.lower("title")})


def column(name: str, build, sql: str):
    query(name, q(f"SELECT id, {sql} AS out FROM tx", ARTICLES, TOPICAL, TEXT) if sql else None)(lambda spark, d: topical(spark, d).select("id", build().alias("out")))


def package(name: str, p: R.Package, oracle: bool = True):
    sql = R.package_sql(p).replace("regexp_like(", "regexp_matches(")
    query(name, q(f"SELECT id, {sql} AS prefilter_reason, ({sql}) IS NULL AS passed_prefilter FROM tx", ARTICLES, TOPICAL, TEXT) if oracle else None)(
        lambda spark, d: R.apply_package(topical(spark, d), p).select("id", "prefilter_reason", "passed_prefilter")
    )


def classes(name: str, rules):
    column(name, lambda: R.reason(list(rules)), R.reason_sql(list(rules)))


VALID = R.Package("valid", 1, min_length=None).ordered()
column("pred_validate", lambda: F.coalesce(R.reason(VALID), F.lit("valid")), f"coalesce({R.reason_sql(VALID)}, 'valid')")
SCORER = [R.Rule(R.Raw("title IS NULL OR title = ''"), "Invalid article: missing title"), R.Rule(R.Raw("content IS NULL OR content = ''"), "Invalid article: missing content")]
column("pred_validate_scorer", lambda: R.reason(SCORER), R.reason_sql(SCORER))
column(
    "pred_min_length",
    lambda: F.when(F.length(F.coalesce("content", F.lit(""))) < 300, F.concat(F.lit("content_too_short_"), F.length(F.coalesce("content", F.lit(""))).cast("string"), F.lit("chars"))),
    "CASE WHEN length(coalesce(content, '')) < 300 THEN 'content_too_short_' || CAST(length(coalesce(content, '')) AS VARCHAR) || 'chars' END",
)
column("pred_any_pattern", lambda: R.Any(P.FINANCE).col(), R.Any(P.FINANCE).sql())
COUNTED = R.Count((r"\bthe\b", r"\bof\b", r"\bund\b", r"\bque\b"))
column("pred_count_patterns", lambda: big(COUNTED.number()), f"CAST({COUNTED.number_sql()} AS BIGINT)")
column("pred_any_keyword", lambda: R.Keyword(P.GREEN).col(), R.Keyword(P.GREEN).sql())
DOMAIN_RULES = [R.Rule(R.Keyword((x,), on="url"), r) for x, r in P.DOMAINS]
column("pred_domain_block", lambda: R.reason(DOMAIN_RULES), R.reason_sql(DOMAIN_RULES))
STANDARD = R.Package("standard", 1, categories=P.UPLIFTING.categories, domains=P.DOMAINS, override=R.Keyword(P.GREEN), after=P.UPLIFTING.after)
package("prefilter_standard", STANDARD)
SCAN = "lower(concat_ws(' ', title, substring(content, 1, 1000)))"
EXCLUDE = [R.Rule(R.Any(c.patterns, "s") & ~R.Any(c.exceptions, "s"), f"excluded_{c.name}") for c in P.UPLIFTING.categories]
query("prefilter_exclusions", q(f"SELECT id, {R.reason_sql(EXCLUDE)} AS out FROM (SELECT *, {SCAN} AS s FROM tx)", ARTICLES, TOPICAL, TEXT))(
    lambda spark, d: topical(spark, d).withColumn("s", F.lower(F.concat_ws(" ", "title", F.substring("content", 1, 1000)))).select("id", R.reason(EXCLUDE).alias("out"))
)
GLOBAL = R.Keyword(P.GREEN) | R.Count(P.BELONG, 2)
column("pred_global_override", lambda: GLOBAL.col(), GLOBAL.sql())
CATEGORY = P.BELONGING.skips(P.BELONGING.categories[1]) | GLOBAL
column("pred_category_override", lambda: CATEGORY.col(), CATEGORY.sql())


def _junk_sql() -> str:
    def one(p: str) -> str:
        return f"CASE WHEN regexp_matches({R.sql_text('h')}, {R._q(R.sql_pattern(p))}) THEN {R._q(p)} END"

    weak = "list_filter([" + ", ".join(map(one, P.WEAK_JUNK)) + "], lambda x: x IS NOT NULL)"
    strong = "coalesce(" + ", ".join(map(one, P.STRONG_JUNK)) + ")"
    return (
        "SELECT id, CASE WHEN length(trim(b, e' \\n\\t\\r')) < 25 THEN 'empty_or_stub_content' WHEN n > 120 THEN NULL WHEN strong IS NOT NULL THEN 'scrape_junk_strong:' || strong "
        "WHEN len(weak) >= 2 THEN 'scrape_junk_weak:' || len(weak) || ':' || weak[1] WHEN len(weak) = 1 AND n <= 8 THEN 'scrape_junk_stub:' || weak[1] END AS out "
        f"FROM (SELECT id, b, n, CASE WHEN n <= 120 THEN {strong} END AS strong, CASE WHEN n <= 120 THEN {weak} ELSE [] END AS weak FROM j)"
    )


JUNK = r"j AS (SELECT id, content AS b, lower(concat_ws(' ', title, content)) AS h, len(list_filter(string_split_regex(content, '\s+'), lambda w: w <> '')) AS n FROM jp)"
#: Beside the documents themselves, whole pages that are nothing but the signs.
JUNK_PAGES = "jp AS (SELECT id, title, coalesce(content, '') AS content FROM tp UNION ALL SELECT -1 - id, title, list_extract([" + ", ".join(R._q(t) for t in P.JUNK_PAGES) + f"], CAST(id % {len(P.JUNK_PAGES)} + 1 AS BIGINT)) FROM tp)"


@query("pred_scrape_junk", q(_junk_sql(), ARTICLES, TOPICAL, JUNK_PAGES, JUNK))
def pred_scrape_junk(spark, d):
    a = topical(spark, d)
    page = F.get(F.array(*map(F.lit, P.JUNK_PAGES)), (C("id") % len(P.JUNK_PAGES)).cast("int"))
    both = a.select("id", "title", "content").unionByName(a.select((-1 - C("id")).alias("id"), "title", page.alias("content")))
    return both.select("id", R.scrape_junk(C("title"), C("content"), P.STRONG_JUNK, P.WEAK_JUNK).alias("out"))


OBIT = R.Count(P.OBIT_SIGNAL)
column(
    "pred_obit_signal",
    lambda: big(OBIT.number() + F.coalesce(C("title").rlike(R.spark_pattern(r"\bRIP\b")).cast("int"), F.lit(0))),
    f"CAST({OBIT.number_sql()} + coalesce(CAST(regexp_matches({R.sql_text('title')}, '\\bRIP\\b') AS INTEGER), 0) AS BIGINT)",
)
column("pred_off_lens", lambda: C("source").isin("src3", "src4") | F.contains(F.lower(F.concat("source", "url")), F.lit("src17")), "source IN ('src3', 'src4') OR contains(lower(source || url), 'src17')")
FIRST = [R.Rule(R.Any((p,)), p[:30]) for p in P.COMMERCE]
column("pred_commerce_regex", lambda: R.reason(FIRST), R.reason_sql(FIRST))
ROUTE = [
    R.Rule(R.Raw("length(content) < 200"), "skipped"),
    R.Rule(R.Raw("source IN ('src5', 'src6')"), "commerce_source"),
    R.Rule(R.Keyword(("src7", "shop"), "url") & ~R.Keyword(("dealer", "dealing"), "url"), "commerce_url"),
    R.Rule(R.Raw("source IN ('src0', 'src1')"), "journalism"),
    R.Rule(R.Raw("true"), "other"),
]
column("pred_route_bucket", lambda: R.reason(ROUTE), R.reason_sql(ROUTE))
#: The whole text with its accents, which ``t`` has not.
column("pred_death_adjacent", lambda: F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("content", F.lit(""))).rlike(P.DEATH_ADJACENT), "")
SIGNALS = (P.DISCOVERY, P.NATURE, P.BELONG, P.ADVERSITY, (r"\bthe\b", r"\bder\b", r"\bla\b"))
_sig = " + ".join(f"CAST({R.Any(g).sql()} AS INTEGER)" for g in SIGNALS)


@query(
    "screen_confidence",
    q(
        f"SELECT id, round(least(CAST(1 AS DOUBLE), greatest(CAST(0.1 AS DOUBLE), 0.4 + 0.05 * sig + 0.08 * boost - 0.1 * penalty)), 6) AS confidence, n BETWEEN 20 AND 15000 AND length(title) >= 10 AND sig >= 2 AND NOT blocked AND least(1, greatest(0.1, 0.4 + 0.05 * sig + 0.08 * boost - 0.1 * penalty)) >= 0.349999 AS passed "
        rf"FROM (SELECT id, title, CAST(len(string_split_regex(trim(content), '\s+')) AS INTEGER) AS n, CAST({_sig} AS DOUBLE) AS sig, CAST({R.Any(P.OUTCOME).sql()} AS INTEGER) AS boost, CAST({R.Any(P.SPECULATION).sql()} AS INTEGER) AS penalty, {R.Any(P.CRIME).sql()} AS blocked FROM tx WHERE title IS NOT NULL AND content IS NOT NULL)",
        ARTICLES, TOPICAL, TEXT,
    ),
)
def screen_confidence(spark, d):
    a = topical(spark, d).filter("title IS NOT NULL AND content IS NOT NULL")
    n = sum((R.Any(g).col().cast("int") for g in SIGNALS[1:]), R.Any(SIGNALS[0]).col().cast("int"))
    a = a.withColumns({"n": F.size(F.split(F.trim("content"), r"\s+")), "sig": n, "boost": R.Any(P.OUTCOME).col().cast("int"), "penalty": R.Any(P.SPECULATION).col().cast("int"), "blocked": R.Any(P.CRIME).col()})
    conf = F.least(F.lit(1.0), F.greatest(F.lit(0.1), F.lit(0.4) + 0.05 * C("sig") + 0.08 * C("boost") - 0.1 * C("penalty")))
    passed = C("n").between(20, 15000) & (F.length("title") >= 10) & (C("sig") >= 2) & ~C("blocked") & (conf >= 0.349999)
    return a.select("id", r6(conf).alias("confidence"), passed.alias("passed"))


#: Emotion inputs of the stand-in: joy, adversity and sentiment from the scores.
TONE = """CASE WHEN contains(CAST(lens AS VARCHAR), '9') THEN 'academic' WHEN s0 >= 6 AND s1 >= 5 THEN 'joyful' WHEN abs(s2 - 5) < 0.5 AND abs(s3 - 5) < 0.5 THEN 'neutral_technical'
  WHEN s4 >= 5.5 AND s5 >= 5 THEN 'overcoming_adversity' WHEN s4 < 4 THEN 'heavy_but_inspiring' ELSE 'unknown' END"""
query("class_emotional_tone", q(f"SELECT id, {TONE} AS out FROM scores", SCORES))(
    lambda spark, d: with_wa(spark, d).select(
        "id",
        F.when(C("lens").cast("string").contains("9"), "academic")
        .when((C("s0") >= 6) & (C("s1") >= 5), "joyful")
        .when((F.abs(C("s2") - 5) < 0.5) & (F.abs(C("s3") - 5) < 0.5), "neutral_technical")
        .when((C("s4") >= 5.5) & (C("s5") >= 5), "overcoming_adversity")
        .when(C("s4") < 4, "heavy_but_inspiring")
        .otherwise("unknown")
        .alias("out"),
    )
)
query("class_should_include", q(f"SELECT id, CASE WHEN {TONE} IN ('academic', 'unknown') THEN 'excluded_category' WHEN ws < 4.5 THEN 'below_minimum' ELSE 'included' END AS out FROM wa", SCORES, WA))(
    lambda spark, d: with_wa(spark, d)
    .withColumn("tone", F.expr(TONE.replace("CAST(lens AS VARCHAR)", "cast(lens as string)")))
    .select("id", F.when(C("tone").isin("academic", "unknown"), "excluded_category").when(C("ws") < 4.5, "below_minimum").otherwise("included").alias("out"))
)
column("pred_source_type", lambda: ~C("source").isin("src10", "src11"), "source NOT IN ('src10', 'src11')")

package("pkg_uplifting", P.UPLIFTING)
classes("pkg_uplifting_type", P.UPLIFTING_TYPE)
package("pkg_uplifting_old", P.UPLIFTING_OLD)
package("pkg_uplifting_legacy", P.UPLIFTING_LEGACY)
package("pkg_belonging", P.BELONGING)
package("pkg_cultural", P.CULTURAL)
classes("pkg_cultural_type", P.CULTURAL_TYPE)
package("pkg_cultural_old", P.CULTURAL_OLD)
package("pkg_cultural_early", P.CULTURAL_EARLY[-1])
package("pkg_foresight", P.FORESIGHT)
package("pkg_investment", P.INVESTMENT)
package("pkg_investment_legacy", P.INVESTMENT_LEGACY)
package("pkg_investment_early", P.INVESTMENT_EARLY[-1])
package("pkg_nature_gate", P.NATURE_GATE)
package("pkg_passthrough", P.PASSTHROUGH)
package("pkg_sustech", P.SUSTECH, oracle=False)  # a lookahead, which RE2 has not
package("pkg_sustech_old", P.SUSTECH_OLD)
package("pkg_ai_engineering", P.AI_ENGINEERING)
package("pkg_resilience", P.RESILIENCE)
package("pkg_greenwash", P.GREENWASH)
package("pkg_econ_viability", P.ECON_VIABILITY, oracle=False)  # a lookahead
package("pkg_policy", P.POLICY)
package("pkg_ai_practice", P.AI_PRACTICE)

REASON = R.package_sql(P.UPLIFTING).replace("regexp_like(", "regexp_matches(")


@query(
    "score_empty_result",
    q(f"SELECT id, r AS prefilter_reason, r IS NULL AS passed_prefilter, false AS gatekeeper_applied, r IS NOT NULL AS unscored FROM (SELECT id, {REASON} AS r FROM tx)", ARTICLES, TOPICAL, TEXT),
)
def score_empty_result(spark, d):
    """The default results of the rejected rows, and whether they lack all that only a scorer gives.

    Other rows stay: a filter on the reason would be pushed below it, and the rules evaluated once more for it.
    """
    found = R.apply_package(topical(spark, d), P.UPLIFTING).select("id", S.empty_result(C("prefilter_reason")).alias("r"))
    unscored = C("r.scores").isNull() & C("r.weighted_average").isNull() & C("r.tier").isNull() & C("r.tier_description").isNull()
    return found.select(
        "id", "r.prefilter_reason", F.coalesce("r.passed_prefilter", F.lit(True)).alias("passed_prefilter"),
        F.coalesce("r.gatekeeper_applied", F.lit(False)).alias("gatekeeper_applied"), (C("r").isNotNull() & unscored).alias("unscored"),
    )
