"""Projections, string and JSON scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from lensmill.functions import text as X
from lensmill.plans.registry import query
from lensmill.plans.views import ARTICLES, articles, big, q, r6, table

C = F.col
ZW = "".join(X.ZERO_WIDTH)
CONTENT = "SELECT id, {} AS out FROM articles"


def simple(name: str, build, sql: str):
    """A query of one computed column ``out`` over articles."""
    query(name, q(CONTENT.format(sql), ARTICLES))(lambda spark, d: articles(spark, d).select("id", build().alias("out")))


def _marked(chars: str, sep: str) -> tuple[str, str]:
    """The content with marks put in: as Spark literal text and as SQL."""
    return chars[0] + sep + chars[-1], "".join(f"chr({ord(c)})" if i == 0 else f" || chr({ord(c)})" for i, c in enumerate(chars[0] + sep + chars[-1]))


_zw, _zw_sql = _marked(X.ZERO_WIDTH, "x")
simple("text_zero_width", lambda: X.drop_zero_width(F.concat(F.lit(_zw), "content")), f"translate({_zw_sql} || content, '{X.ZERO_WIDTH}', '')")
_bd, _bd_sql = _marked(X.BIDI, "x")
simple("text_bidi", lambda: X.drop_bidi(F.concat(F.lit(_bd), "content")), f"translate({_bd_sql} || content, '{X.BIDI}', '')")


def ws_sql(c: str) -> str:
    base = rf"regexp_replace(regexp_replace(replace({c}, chr(9), ' '), ' {{2,}}', ' ', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g')"
    lines = rf"array_to_string(list_transform(string_split({base}, chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), chr(10))"
    return rf"regexp_replace({lines}, '^\s+|\s+$', '', 'g')"


def tags_sql(c: str) -> str:
    return f"regexp_replace(regexp_replace(regexp_replace({c}, '<[^>]+>', '', 'g'), '&[a-zA-Z]+;', ' ', 'g'), '&#[0-9]+;', ' ', 'g')"


simple("text_whitespace", lambda: X.normalize_whitespace(F.replace("content", F.lit(". "), F.lit(" \t \n\n\n\n  "))), ws_sql("replace(content, '. ', ' ' || chr(9) || ' ' || repeat(chr(10), 4) || '  ')"))
query("text_html_tags", f"SELECT page_id, {tags_sql('html')} AS out FROM pages")(lambda spark, d: table(spark, d, "pages").select("page_id", X.strip_tags(C("html")).alias("out")))
query("text_html_entities")(lambda spark, d: X.decode_entities(table(spark, d, "pages").select("page_id", "html"), "html", "out").select("page_id", "out"))
query("text_unicode", q("SELECT id, content AS out FROM articles", ARTICLES))(lambda spark, d: articles(spark, d).select("id", X.drop_invalid(C("content")).alias("out")))
MARKED = "replace(content, ' ', ' <b> ')"
query("text_sanitize", q(f"SELECT id, {ws_sql(tags_sql(MARKED))} AS out FROM articles", ARTICLES))(
    lambda spark, d: X.sanitize(articles(spark, d).select("id", F.replace("content", F.lit(" "), F.lit(" <b> ")).alias("c")), "c", "out").select("id", "out")
)


@query("text_clean_struct")
def text_clean_struct(spark, d):
    a = table(spark, d, "pages").select("page_id", F.struct(C("html").alias("body"), F.array("url", "html").alias("parts"), F.create_map(F.lit("h"), C("html")).alias("m"), C("page_id").alias("n")).alias("article"))
    return X.clean_nested(a, "article").select("page_id", "article.body", F.element_at("article.parts", 1).alias("url"), C("article.n").alias("n"))


@query("text_clean_labeling")
def text_clean_labeling(spark, d):
    p = table(spark, d, "pages").select("page_id", C("url").alias("title"), F.lit(None).cast("string").alias("text"), C("html").alias("content"))
    p = p.withColumn("body", F.when(C("text").isNotNull(), C("text")).otherwise(C("content")))
    return X.sanitize(X.sanitize(p, "title", "title"), "body", "body").select("page_id", "title", "body")


simple("text_combined", lambda: X.combined(C("title"), F.lit(None).cast("string"), C("content")), "concat_ws(' ', title, NULL, substring(content, 1, 2000))")
simple("text_combined_clean", lambda: X.sanitize_no_entities(F.lower(X.combined(C("title"), C("language"), C("content")))), ws_sql(tags_sql("lower(concat_ws(' ', title, language, substring(content, 1, 2000)))")))
W = r"string_split_regex(trim(content), '\s+')"
simple("text_head_tail", lambda: X.head_tail(C("content"), 64, 64), f"CASE WHEN len({W}) <= 128 THEN content ELSE array_to_string(list_slice({W}, 1, 64), ' ') || ' [...] ' || array_to_string(list_slice({W}, len({W}) - 63, len({W})), ' ') END")
simple(
    "text_compress",
    lambda: X.compress(C("content"), 200, " ... "),
    f"CASE WHEN len({W}) > 200 THEN array_to_string(list_slice({W}, 1, 140), ' ') || ' ... ' || array_to_string(list_slice({W}, len({W}) - 59, len({W})), ' ') ELSE content END",
)
simple(
    "text_prompt",
    lambda: F.concat(F.lit("Title: "), F.coalesce("title", F.lit("N/A")), F.lit("\nSource: "), F.coalesce("source", F.lit("N/A")), F.lit("\nText: "), F.coalesce("content", F.lit("N/A"))),
    "'Title: ' || coalesce(title, 'N/A') || chr(10) || 'Source: ' || coalesce(source, 'N/A') || chr(10) || 'Text: ' || coalesce(content, 'N/A')",
)
simple(
    "text_model_input",
    lambda: F.when((C("title") != "") & (C("content") != ""), F.concat("title", F.lit("\n\n"), "content")).otherwise(F.concat(X.lit_text(C("title")), X.lit_text(C("content")))),
    "CASE WHEN title <> '' AND content <> '' THEN title || chr(10) || chr(10) || content ELSE coalesce(title, '') || coalesce(content, '') END",
)
simple("text_e5_input", lambda: F.concat(F.lit("query: "), "title", F.lit(". "), F.substring("content", 1, 1024)), "'query: ' || title || '. ' || substring(content, 1, 1024)")
simple("text_marked_input", lambda: F.concat(F.lit("[TITLE] "), "title", F.lit(" [CONTENT] "), F.substring("content", 1, 4000)), "'[TITLE] ' || title || ' [CONTENT] ' || substring(content, 1, 4000)")
simple(
    "text_truncate_suffix",
    lambda: F.when(F.length("content") > 3000, F.concat(F.substring("content", 1, 3000), F.lit("... [truncated]"))).otherwise(C("content")),
    "CASE WHEN length(content) > 3000 THEN substring(content, 1, 3000) || '... [truncated]' ELSE content END",
)
simple("text_est_tokens", lambda: X.estimated_tokens(C("content")), f"CAST(floor(len({W}) * CAST(1.3 AS DOUBLE)) AS BIGINT)")


def _chunk_sql(size: int, step: int, starts: str) -> str:
    body = f"SELECT id, chunk, array_to_string(list_slice(w, s + 1, s + {size}), ' ') AS out FROM (SELECT id, w, unnest(starts) AS s, CAST(generate_subscripts(starts, 1) - 1 AS BIGINT) AS chunk FROM (SELECT id, w, {starts} AS starts FROM t))"
    return q(body, ARTICLES, f"t AS (SELECT id, {W} AS w FROM articles)")


def _exploded(df, chunks):
    return df.select("id", F.posexplode(chunks).alias("chunk", "out")).select("id", big(C("chunk")).alias("chunk"), "out")


query("chunk_tokens", _chunk_sql(196, 68, "list_slice(range(0, len(w), 68), 1, 32)"))(lambda spark, d: _exploded(articles(spark, d), X.token_chunks(C("content"), 256, 128)))
query("chunk_words", _chunk_sql(100, 80, "range(0, CAST(greatest(ceil((len(w) - 100) / CAST(80 AS DOUBLE)), 0) * 80 + 1 AS BIGINT), 80)"))(lambda spark, d: _exploded(articles(spark, d), X.chunks(C("content"), 100, 20, stop_at_end=True)))


@query(
    "chunk_article",
    q(
        f"SELECT id, chunk, CAST(floor(len({W.replace('content', 'out')}) * CAST(1.3 AS DOUBLE)) AS BIGINT) AS est_tokens, CAST(count(*) OVER (PARTITION BY id) AS BIGINT) AS num_chunks FROM c",
        ARTICLES,
        f"t AS (SELECT id, {W} AS w FROM articles)",
        "s AS (SELECT id, w, list_slice(range(0, len(w), 68), 1, 32) AS starts FROM t)",
        "u AS (SELECT id, w, unnest(starts) AS s, CAST(generate_subscripts(starts, 1) - 1 AS BIGINT) AS chunk FROM s)",
        "c AS (SELECT id, chunk, array_to_string(list_slice(w, s + 1, s + 196), ' ') AS out FROM u)",
    ),
)
def chunk_article(spark, d):
    a = articles(spark, d).withColumn("c", X.token_chunks(C("content"), 256, 128))
    rows = a.select("id", big(F.size("c")).alias("num_chunks"), F.posexplode("c").alias("chunk", "out"))
    return rows.select("id", big(C("chunk")).alias("chunk"), X.estimated_tokens(C("out")).alias("est_tokens"), "num_chunks")


ANSWER = "'Sure:' || chr(10) || '```json' || chr(10) || '{\"score\": ' || CAST(id % 11 AS VARCHAR) || ', \"ok\": true}' || chr(10) || '```'"


def _answer():
    return F.when(C("id") % 3 == 0, F.concat(F.lit("Sure:\n```json\n{\"score\": "), (C("id") % 11).cast("string"), F.lit(", \"ok\": true}\n```"))).when(
        C("id") % 3 == 1, F.concat(F.lit("The answer {\"score\": "), (C("id") % 11).cast("string"), F.lit(", \"ok\": true} as asked"))
    ).otherwise(F.lit("  no json  "))


ANSWERS = f"ans AS (SELECT id, CASE WHEN id % 3 = 0 THEN {ANSWER} WHEN id % 3 = 1 THEN 'The answer {{\"score\": ' || CAST(id % 11 AS VARCHAR) || ', \"ok\": true}} as asked' ELSE '  no json  ' END AS a FROM articles)"
EXTRACT = "CASE WHEN regexp_matches(a, '(?s)```(?:json)?\\s*\\n?(.*?)\\n?```') THEN trim(regexp_extract(a, '(?s)```(?:json)?\\s*\\n?(.*?)\\n?```', 1)) WHEN regexp_extract(a, '(?s)\\{.*\\}') <> '' THEN regexp_extract(a, '(?s)\\{.*\\}') ELSE trim(a) END"
query("json_extract", q(f"SELECT id, {EXTRACT} AS out FROM ans", ARTICLES, ANSWERS))(lambda spark, d: articles(spark, d).select("id", X.extract_json(_answer()).alias("out")))
query("json_repair")(lambda spark, d: articles(spark, d).select("id", X.repair_json(F.concat(F.lit('{"a": "c:\\d", /* x */ "n": ['), C("id").cast("string"), F.lit(",],} // end"))).alias("out")))


@query("json_parse_or_repair", q("SELECT id, id AS n, id % 2 = 0 AS json_repaired FROM articles", ARTICLES))
def json_parse_or_repair(spark, d):
    a = articles(spark, d).select("id", F.concat(F.lit('{"n": '), C("id").cast("string"), F.when(C("id") % 2 == 0, F.lit(",}")).otherwise(F.lit("}"))).alias("a"))
    return X.parse_or_repair(a, "a").select("id", F.try_variant_get("parsed", "$.n", "bigint").alias("n"), "json_repaired")


POLY = "CASE id % 4 WHEN 0 THEN '{\"d\": {\"score\": 7.5}}' WHEN 1 THEN '{\"d\": 6}' WHEN 2 THEN '{\"d\": \"5.5\"}' ELSE '{\"e\": 1}' END"


@query("json_dim_score", q("SELECT id, CASE id % 4 WHEN 0 THEN CAST(7.5 AS DOUBLE) WHEN 1 THEN CAST(6 AS DOUBLE) WHEN 2 THEN CAST(5.5 AS DOUBLE) END AS out FROM articles", ARTICLES))
def json_dim_score(spark, d):
    v = F.try_parse_json(F.expr(POLY.replace('"', '\\"')))
    return articles(spark, d).select("id", X.dim_score(v, "d").alias("out"))


#: A scored article: flat analysis, two dimensions, sometimes one missing.
TRAIN = "tr AS (SELECT id, title, content, url, CASE WHEN id % 5 = 0 THEN NULL ELSE CAST(id % 11 AS DOUBLE) END AS d0, CASE WHEN id % 7 = 0 THEN NULL ELSE CAST(id % 4 AS DOUBLE) END AS d1 FROM articles)"


def _train(spark, d):
    return articles(spark, d).select("id", "title", "content", "url", F.when(C("id") % 5 != 0, (C("id") % 11).cast("double")).alias("d0"), F.when(C("id") % 7 != 0, (C("id") % 4).cast("double")).alias("d1"))


@query("project_training_row", q("SELECT id, title, url, CAST(coalesce(d0, 0) AS VARCHAR) || ',' || CAST(coalesce(d1, 0) AS VARCHAR) AS labels, 'd0,d1' AS dimension_names FROM tr WHERE d0 IS NOT NULL OR d1 IS NOT NULL", ARTICLES, TRAIN))
def project_training_row(spark, d):
    t = _train(spark, d).filter("d0 IS NOT NULL OR d1 IS NOT NULL")
    labels = F.array(F.coalesce("d0", F.lit(0.0)), F.coalesce("d1", F.lit(0.0)))
    return t.select("id", "title", "url", F.array_join(labels.cast("array<string>"), ",").alias("labels"), F.array_join(F.array(F.lit("d0"), F.lit("d1")), ",").alias("dimension_names"))


query("project_training_row_float", q("SELECT id, coalesce(d0, CAST(0 AS DOUBLE)) AS l0, coalesce(d1, CAST(0 AS DOUBLE)) AS l1 FROM tr", ARTICLES, TRAIN))(
    lambda spark, d: _train(spark, d).select("id", F.coalesce("d0", F.lit(0.0)).alias("l0"), F.coalesce("d1", F.lit(0.0)).alias("l1"))
)


@query("project_score_maps", q("SELECT id, 'd0' AS dim, d0 AS score FROM tr WHERE d0 IS NOT NULL UNION ALL SELECT id, 'd1', d1 FROM tr WHERE d1 IS NOT NULL", ARTICLES, TRAIN))
def project_score_maps(spark, d):
    m = F.map_filter(F.create_map(F.lit("d0"), C("d0"), F.lit("d1"), C("d1")), lambda _, v: v.isNotNull())
    return _train(spark, d).select("id", F.explode(m).alias("dim", "score"))


query("project_field_alias", q("SELECT id, coalesce(d0, d1) AS out FROM tr WHERE coalesce(d0, d1) IS NOT NULL", ARTICLES, TRAIN))(
    lambda spark, d: _train(spark, d).select("id", F.coalesce("d0", "d1").alias("out")).filter("out IS NOT NULL")
)
query("project_candidate", q("SELECT id, title, url, language, coalesce(d0, 0) AS student_score, CASE WHEN coalesce(d0, 0) >= 7 THEN 'high' WHEN coalesce(d0, 0) >= 4 THEN 'medium' ELSE 'low' END AS tier FROM (SELECT t.*, a.language FROM tr t JOIN articles a USING (id))", ARTICLES, TRAIN))(
    lambda spark, d: articles(spark, d).withColumn("d0", F.when(C("id") % 5 != 0, (C("id") % 11).cast("double"))).select("id", "title", "url", "language", F.coalesce("d0", F.lit(0.0)).alias("student_score"), F.when(F.coalesce("d0", F.lit(0.0)) >= 7, "high").when(F.coalesce("d0", F.lit(0.0)) >= 4, "medium").otherwise("low").alias("tier"))
)
simple("text_id_source", lambda: X.source_of_id(F.concat("source", F.lit("_"), "language", F.lit("_"), C("id").cast("string"))), "regexp_extract(source || '_' || language || '_' || CAST(id AS VARCHAR), '(?s)^(.*)_[^_]*$', 1)")


@query("project_sort_date", "SELECT event_id, coalesce(split_part(nullif(CASE WHEN event_id % 3 = 0 THEN '' ELSE strftime(ts, '%Y-%m-%dT%H:%M') END, ''), 'T', 1), '9999-12-31') AS out FROM events")
def project_sort_date(spark, d):
    e = table(spark, d, "events")
    made = F.when(C("event_id") % 3 == 0, F.lit("")).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm"))
    return e.select("event_id", X.sort_date(made, F.lit(None).cast("string")).alias("out"))


KEYWORDS = ["the", "und", "que", "zzz"]
simple("text_keyword_hits", lambda: F.array_join(X.keyword_hits(C("content"), KEYWORDS), ","), "array_to_string(list_filter(['the', 'und', 'que', 'zzz'], lambda k: contains(lower(content), k)), ',')")
simple("hash_prompt", lambda: F.substring(F.sha2("content", 256), 1, 12), "substr(sha256(content), 1, 12)")
simple("hash_bucket", lambda: X.hash_bucket(C("id").cast("string")), "CAST('0x' || substr(sha1(CAST(id AS VARCHAR)), 1, 8) AS BIGINT) % 10000")
simple("text_safe_id", lambda: X.safe_id(C("url")), r"substr(regexp_replace(url, '[^\w-]', '_', 'g'), 1, 64)")
query("project_provenance", q("SELECT id, 'uplift' AS filter_name, '7' AS version, substr(sha256('prompt'), 1, 12) AS prompt_hash, true AS calibrated FROM articles", ARTICLES))(
    lambda spark, d: articles(spark, d).select("id", F.struct(F.lit("uplift").alias("filter_name"), F.lit("7").alias("version"), F.substring(F.sha2(F.lit("prompt"), 256), 1, 12).alias("prompt_hash"), F.lit(True).alias("calibrated")).alias("p")).select("id", "p.*")
)


@query("json_verdict", q("SELECT id, CASE id % 3 WHEN 0 THEN 'block' WHEN 1 THEN 'keep' ELSE 'parse_error' END AS verdict, CASE WHEN id % 3 = 0 THEN 'x' END AS reason FROM articles", ARTICLES))
def json_verdict(spark, d):
    raw = F.when(C("id") % 3 == 0, '{"verdict": " BLOCK ", "reason": "x"}').when(C("id") % 3 == 1, 'ok {"verdict": "keep"}').otherwise("nothing")
    v = F.try_parse_json(F.regexp_extract(raw, r"(?s)\{.*\}", 0))
    said = F.lower(F.trim(F.try_variant_get(v, "$.verdict", "string")))
    return articles(spark, d).select("id", F.when(said.isin("block", "keep", "unsure"), said).otherwise("parse_error").alias("verdict"), F.substring(F.try_variant_get(v, "$.reason", "string"), 1, 200).alias("reason"))


@query("json_commerce_response", q("SELECT id, CASE WHEN id % 2 = 0 THEN CAST(id % 10 AS DOUBLE) / 10 ELSE -1 END AS score, CASE WHEN id % 2 = 1 THEN 'failed' END AS error FROM articles", ARTICLES))
def json_commerce_response(spark, d):
    raw = F.when(C("id") % 2 == 0, F.concat(F.lit("```json\n{\"score\": 0."), (C("id") % 10).cast("string"), F.lit("}\n```"))).otherwise("failed")
    v = F.try_parse_json(X.extract_json(raw))
    score = F.try_variant_get(v, "$.score", "double")
    return articles(spark, d).select("id", r6(F.coalesce(score, F.lit(-1.0))).alias("score"), F.when(score.isNull(), F.substring(raw, 1, 100)).alias("error"))


@query("json_required_dims", q("SELECT id, CASE WHEN d0 IS NULL AND d1 IS NULL THEN 'missing: d0, d1' WHEN d0 IS NULL THEN 'missing: d0' WHEN d1 IS NULL THEN 'missing: d1' END AS error FROM tr", ARTICLES, TRAIN))
def json_required_dims(spark, d):
    missing = F.filter(F.array(F.when(C("d0").isNull(), "d0"), F.when(C("d1").isNull(), "d1")), lambda x: x.isNotNull())
    return _train(spark, d).select("id", F.when(F.size(missing) > 0, F.concat(F.lit("missing: "), F.array_join(missing, ", "))).alias("error"))

