"""Sources, sinks and streams, over files written for the purpose in the scratch folder."""

from __future__ import annotations

import json
import os
import tempfile
import uuid

from pyspark.sql import functions as F

from lensmill.functions.scoring import DEPLOYED
from lensmill.plans.registry import query
from lensmill.plans.views import ARTICLES, SCORES, articles, q, r6, scores, table
from lensmill.sources import config as G
from lensmill.sources import readers as A
from lensmill.sources import writers as B
from lensmill.streaming import jobs as P

C = F.col


def scratch(spark, what: str) -> str:
    """A path in the folder that the cluster names; one of our own only on a single machine."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = os.path.join(tempfile.gettempdir(), "lensmill-scratch")
    return f"{base.rstrip('/')}/{what}-{uuid.uuid4().hex}"


def _as_article(a):
    return a.select(C("id").cast("string").alias("id"), "title", "content", "url", "source", "language")


def _jsonl(spark, d, what="jsonl", split=None):
    path = scratch(spark, what)
    a = _as_article(articles(spark, d))
    (a if split is None else a.filter(split)).write.json(path)
    return path


query("scan_strict", q("SELECT CAST(id AS VARCHAR) AS id, CAST(length(content) AS INTEGER) AS n FROM articles", ARTICLES))(lambda spark, d: A.strict_jsonl(spark, _jsonl(spark, d)).select("id", F.length("content").alias("n")))


@query("scan_permissive_counts", q("SELECT CAST(count(*) + 2 AS BIGINT) AS read, CAST(2 AS BIGINT) AS malformed, CAST(count(*) AS BIGINT) AS usable FROM articles", ARTICLES))
def scan_permissive_counts(spark, d):
    path = _jsonl(spark, d)
    spark.createDataFrame([('{"id": "x", ',), ("not json",)], "value string").write.mode("append").text(path)
    return A.counters(A.permissive_jsonl(spark, path))


query("scan_next_batch", q("SELECT id FROM articles WHERE id NOT IN (SELECT doc_id FROM labels) AND length(content) >= 300 ORDER BY id LIMIT 50", ARTICLES))(
    lambda spark, d: A.next_batch(articles(spark, d).filter("length(content) >= 300"), table(spark, d, "labels").select(C("doc_id").alias("id")), "id", ["id"], 50).select("id")
)


@query("scan_newest_files")
def scan_newest_files(spark, d):
    path = scratch(spark, "newest")
    for k in range(3):
        _as_article(articles(spark, d).filter(C("id") % 3 == k)).coalesce(1).write.json(f"{path}/part{k}")
    return A.newest_files(A.nested(spark, path, "*.json"), 2).groupBy("file").agg(F.count("*").alias("n"))


@query("scan_nested_dirs", q("SELECT CAST(count(*) AS BIGINT) AS n FROM articles", ARTICLES))
def scan_nested_dirs(spark, d):
    path = scratch(spark, "nested")
    for k in range(2):
        _as_article(articles(spark, d).filter(C("id") % 2 == k)).write.json(f"{path}/day{k}/items")
    return A.nested(spark, path, "*.json").agg(F.count("*").alias("n"))


@query("scan_splits_union", q("SELECT CASE WHEN id % 10 < 8 THEN 'train' ELSE 'val' END AS split, CAST(count(*) AS BIGINT) AS n FROM articles GROUP BY 1", ARTICLES))
def scan_splits_union(spark, d):
    paths = {"train": _jsonl(spark, d, "train", "id % 10 < 8"), "val": _jsonl(spark, d, "val", "id % 10 >= 8"), "test": scratch(spark, "absent")}
    return A.splits(spark, paths).groupBy("split").agg(F.count("*").alias("n"))


@query("scan_tier_dirs", q("SELECT CASE WHEN s0 >= 6 THEN 'high' ELSE 'medium' END AS tier, CAST(count(*) AS BIGINT) AS n FROM scores WHERE s0 >= 4.5 GROUP BY 1", SCORES))
def scan_tier_dirs(spark, d):
    path = scratch(spark, "tiers")
    scores(spark, d).select("id", F.when(C("s0") >= 6, "high").when(C("s0") >= 4.5, "medium").otherwise("low").alias("tier")).write.partitionBy("tier").json(path)
    return spark.read.schema("id BIGINT, tier STRING").json(path).filter("tier IN ('medium', 'high')").groupBy("tier").agg(F.count("*").alias("n"))


@query("scan_map_explode", q("SELECT id, round(CASE WHEN id % 2 = 0 THEN s0 ELSE s1 END, 6) AS wa FROM scores WHERE CASE WHEN id % 2 = 0 THEN s0 ELSE s1 END >= 3", SCORES))
def scan_map_explode(spark, d):
    entry = lambda raw, wa: F.struct(raw.alias("raw_weighted_average"), wa.alias("weighted_average"), F.lit("4").alias("version"), F.lit("4").alias("filter_version"))
    m = F.create_map(F.lit("nature-recovery"), entry(F.when(C("id") % 2 == 0, C("s0")), C("s1")), F.lit("other"), entry(C("s2"), C("s3")))
    return A.explode_attributes(scores(spark, d).select("id", m.alias("m")), "m", "nature_recovery", "4", 3.0).select("id", r6(C("wa")).alias("wa"))


@query("scan_id_list", "SELECT DISTINCT CAST(doc_id AS VARCHAR) AS id FROM labels")
def scan_id_list(spark, d):
    path = scratch(spark, "ids")
    table(spark, d, "labels").select(F.concat(F.lit("  "), C("doc_id").cast("string"), F.lit(" "))).unionByName(spark.createDataFrame([("   ",)], "v string").toDF(*table(spark, d, "labels").select(F.concat(F.lit("  "), C("doc_id").cast("string"), F.lit(" "))).columns)).write.text(path)
    return A.id_list(spark, path)


@query("scan_matrix_to_long", q(" UNION ALL ".join(f"SELECT CAST(id AS VARCHAR) AS id, 'd{i}' AS dim, round(s{i}, 6) AS pred, round(o{i}, 6) AS label FROM scores" for i in range(2)), SCORES))
def scan_matrix_to_long(spark, d):
    s = scores(spark, d)
    rows = F.transform(F.sort_array(F.collect_list(F.struct("id", "s0", "s1", "o0", "o1"))), lambda x: x)
    b = s.agg(rows.alias("r")).select(
        F.transform("r", lambda x: x["id"].cast("string")).alias("article_ids"), F.array(F.lit("d0"), F.lit("d1")).alias("dimension_names"), F.transform("r", lambda x: F.array(x["s0"], x["s1"])).alias("predictions"), F.transform("r", lambda x: F.array(x["o0"], x["o1"])).alias("labels")
    )
    path = scratch(spark, "matrix")
    b.coalesce(1).write.json(path)
    read = spark.read.schema("article_ids ARRAY<STRING>, dimension_names ARRAY<STRING>, predictions ARRAY<ARRAY<DOUBLE>>, labels ARRAY<ARRAY<DOUBLE>>").option("multiLine", "true").json(path)
    return A.matrix_to_long(read).select("id", "dim", r6(C("pred")).alias("pred"), r6(C("label")).alias("label"))


_VALUES = ", ".join(
    [f"('{s.name}', 'dim', {k}, {w!r}::DOUBLE)" for s in DEPLOYED for k, w in enumerate(s.weights)] + [f"('{s.name}', '{n}', {k}, {t!r}::DOUBLE)" for s in DEPLOYED for k, (n, t) in enumerate(s.tiers)]
)


@query("config_dims_tiers", f"SELECT package, part, CAST(ord AS INTEGER) AS ord, value FROM (VALUES {_VALUES}) v(package, part, ord, value)")
def config_dims_tiers(spark, d):
    """Configurations written as JSON, and what the loader makes of them."""
    path, rows = scratch(spark, "config"), []
    for s in DEPLOYED:
        gate = {} if s.gate is None else {"g": {"dimension": f"d{s.gate}", "threshold": s.gate_min, "max_score": s.gate_cap}}
        config = {"filter": {"name": s.name, "version": f"{s.version}.0"}, "scoring": {"dimensions": {f"d{k}": {"weight": w} for k, w in enumerate(s.weights)}, "gatekeepers": gate, "tiers": {n: {"threshold": t} for n, t in s.tiers}}}
        spark.createDataFrame([(json.dumps(config, indent=1),)], "value string").coalesce(1).write.text(f"{path}/{s.name}.json")
        got = G.scoring_of(G.read_config(spark, f"{path}/{s.name}.json"))
        if got != s:
            raise ValueError(f"{s.name} is read as {got}")
        rows += [(got.name, "dim", k, float(w)) for k, w in enumerate(got.weights)] + [(got.name, n, k, float(t)) for k, (n, t) in enumerate(got.tiers)]
    return spark.createDataFrame(rows, "package string, part string, ord int, value double")


@query("scan_cache_join", q("SELECT id, substr(sha256(url), 1, 16) AS key, length(content) AS n FROM articles WHERE id % 7 <> 0 AND length(content) >= 300", ARTICLES))
def scan_cache_join(spark, d):
    """A cache of texts that lacks every seventh url; short texts count as missing."""
    a, path = articles(spark, d), scratch(spark, "cache")
    a.filter("id % 7 <> 0").select(A.cache_key(C("url")).alias("key"), C("content").alias("text")).write.parquet(path)
    return A.from_cache(a.select("id", "url"), spark.read.parquet(path), "url", 300).select("id", "key", F.length("cached").cast("bigint").alias("n"))


@query("scan_tsv_flags", q("SELECT CAST(id AS VARCHAR) AS id FROM articles WHERE id % 4 = 0", ARTICLES))
def scan_tsv_flags(spark, d):
    path = scratch(spark, "tsv")
    articles(spark, d).select(C("id").cast("string").alias("id"), F.when(C("id") % 4 == 0, "Y").otherwise("N").alias("cap"), F.translate("title", "\t\n\r\"", "    ").alias("title")).write.option("sep", "\t").option("header", "true").csv(path)
    return A.flags_tsv(spark, path).select("id")


@query("scan_polymorphic_scores", q("SELECT id, CAST(id % 11 AS DOUBLE) AS score FROM articles WHERE id % 4 < 3", ARTICLES))
def scan_polymorphic_scores(spark, d):
    n = (C("id") % 11).cast("string")
    raw = F.when(C("id") % 4 == 0, F.concat(F.lit('{"x_analysis": {"d": {"score": '), n, F.lit("}}}"))).when(C("id") % 4 == 1, F.concat(F.lit('{"deep": {"d": '), n, F.lit("}}"))).when(C("id") % 4 == 2, F.concat(F.lit('{"dims": {"d": '), n, F.lit("}}"))).otherwise("{}")
    v = F.try_parse_json(raw)
    got = F.coalesce(*(F.try_variant_get(v, p, "double") for p in ("$.x_analysis.d.score", "$.deep.d", "$.dims.d")))
    return articles(spark, d).select("id", got.alias("score")).filter("score IS NOT NULL")


COHORTS = "SELECT CAST(id AS VARCHAR) AS id, CASE WHEN id % 2 = 0 THEN 0 ELSE 1 END AS cohort FROM articles WHERE (id % 2 = 0 OR id % 3 = 0) AND trim(content) <> ''"


@query("scan_cohorts_first", q(COHORTS, ARTICLES))
def scan_cohorts_first(spark, d):
    """Two cohorts that overlap; the second names its ids ``article_id``, and the first has rows without content."""
    a, paths = _as_article(articles(spark, d)), [scratch(spark, "cohort") for _ in range(2)]
    whole = a.filter(C("id").cast("bigint") % 2 == 0)
    whole.unionByName(a.filter(C("id").cast("bigint") % 2 == 1).withColumn("content", F.lit(" "))).write.json(paths[0])
    a.filter(C("id").cast("bigint") % 3 == 0).withColumnRenamed("id", "article_id").write.json(paths[1])
    return A.cohorts(spark, paths).select("id", "cohort")


#: Any rows up to the cap; what is the same on every run is how many, and that they are rows of the table.
CAPPED = "SELECT least({n}, count(*)) AS n, CAST(0 AS BIGINT) AS strange FROM articles"
capped = lambda rows, all_ids: rows.join(all_ids, "id", "left").agg(F.count_distinct("id").alias("n"), F.count_if(C("there").isNull()).alias("strange"))
query("scan_capped_pool", q(CAPPED.replace("{n}", "200"), ARTICLES))(
    lambda spark, d: capped(A.usable_jsonl(spark, _jsonl(spark, d)).limit(200).select("id"), articles(spark, d).select(C("id").cast("string").alias("id"), F.lit(1).alias("there")))
)
query("limit_n", q(CAPPED.replace("{n}", "25"), ARTICLES))(lambda spark, d: capped(articles(spark, d).select("id").limit(25), articles(spark, d).select("id", F.lit(1).alias("there"))))


@query("sink_splits_roundtrip", q("SELECT CASE WHEN id % 10 < 8 THEN 'train' WHEN id % 10 = 8 THEN 'val' ELSE 'test' END AS split, CAST(id AS VARCHAR) AS id FROM articles", ARTICLES))
def sink_splits_roundtrip(spark, d):
    path = scratch(spark, "splits")
    B.write_splits(_as_article(articles(spark, d)).withColumn("split", F.when(C("id") % 10 < 8, "train").when(C("id") % 10 == 8, "val").otherwise("test")), path)
    return spark.read.schema("id STRING, split STRING").json(path).select("split", "id")


query("sink_review_rows", q("SELECT id, substring(title, 1, 120) AS title, translate(substring(content, 1, 200), chr(10) || chr(9), '  ') AS snippet, array_to_string(list_slice(list_filter(['the', 'und', 'que', 'of'], lambda k: contains(lower(content), k)), 1, 3), ', ') AS keywords FROM articles", ARTICLES))(
    lambda spark, d: B.review_rows(articles(spark, d), ["the", "und", "que", "of"])
)


@query("sink_manifest", q("SELECT CAST(count(*) AS BIGINT) AS lines, true AS sized, true AS digested FROM articles", ARTICLES))
def sink_manifest(spark, d):
    m = B.manifest(spark, _jsonl(spark, d))
    return m.agg(F.sum("lines").alias("lines"), F.bool_and((C("bytes") > 0) | (C("lines") == 0)).alias("sized"), F.bool_and(F.length("sha256") == 64).alias("digested"))


def _stream_dir(spark, d, parts=3):
    path = scratch(spark, "stream")
    e = table(spark, d, "events").withColumn("ts", C("ts").cast("timestamp"))
    e.repartitionByRange(parts, "ts").write.parquet(path)
    return path, e.schema


def _resume(spark, d):
    path, schema = _stream_dir(spark, d)
    out, check = scratch(spark, "scored"), scratch(spark, "progress")
    for _ in range(2):  # the second run finds nothing new
        P.resumable(P.read_stream(spark, path, schema), lambda b: b.select("event_id", r6(C("value") / 10).alias("score")), out, check)
    return spark.read.parquet(out)


query("stream_resume", "SELECT CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT event_id) AS BIGINT) AS distinct_n FROM events")(lambda spark, d: _resume(spark, d).agg(F.count("*").alias("n"), F.count_distinct("event_id").alias("distinct_n")))
query("sink_incremental", "SELECT CAST(3 AS BIGINT) AS batches, CAST(count(*) AS BIGINT) AS n FROM events")(lambda spark, d: _resume(spark, d).agg(F.count_distinct("batch").alias("batches"), F.count("*").alias("n")))
query("sink_state", "SELECT CAST(count(DISTINCT event_id) AS BIGINT) AS processed FROM events")(lambda spark, d: _resume(spark, d).select("event_id").distinct().agg(F.count("*").alias("processed")))


@query("stream_target", "SELECT CAST(2 AS BIGINT) AS batches, true AS reached, true AS stopped, CAST(count(*) AS BIGINT) AS resumed FROM events")
def stream_target(spark, d):
    """Three files of about a third each and a target of half: two batches, and the third is left to the next run."""
    path, schema = _stream_dir(spark, d)
    out, check, n = scratch(spark, "scored"), scratch(spark, "progress"), table(spark, d, "events").count()
    step = lambda b: b.select("event_id")
    P.resumable(P.read_stream(spark, path, schema), step, out, check, target=n // 2)
    first = spark.read.parquet(out).agg(F.count_distinct("batch").alias("batches"), (F.count("*") >= n // 2).alias("reached"), (F.count("*") < n).alias("stopped")).first()
    P.resumable(P.read_stream(spark, path, schema), step, out, check)
    return spark.read.parquet(out).agg(F.lit(first["batches"]).alias("batches"), F.lit(first["reached"]).alias("reached"), F.lit(first["stopped"]).alias("stopped"), F.count_distinct("event_id").alias("resumed"))




def _drained(spark, d, build, mode="append"):
    path, schema = _stream_dir(spark, d, 1)
    return P.drain(build(P.read_stream(spark, path, schema)), "m" + uuid.uuid4().hex, scratch(spark, "progress"), mode)


query("stream_dedup", "SELECT DISTINCT user_id, event_type FROM events")(lambda spark, d: _drained(spark, d, lambda s: P.deduplicated(s, ["user_id", "event_type"], "ts", "60 days").select("user_id", "event_type")))
LATE = "SELECT strftime(day, '%Y-%m-%d %H:%M:%S') AS day, event_type, CAST(count(*) AS BIGINT) AS n FROM (SELECT date_trunc('day', CAST(ts AS TIMESTAMP)) AS day, event_type FROM events) WHERE day + INTERVAL 1 DAY <= (SELECT max(CAST(ts AS TIMESTAMP)) - INTERVAL 1 HOUR FROM events) GROUP BY 1, 2"
query("stream_late", LATE)(lambda spark, d: _drained(spark, d, lambda s: P.window_counts(s, "ts", "1 day")).select(C("w.start").cast("string").alias("day"), "event_type", "n"))
query("stream_window_counts", "SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, CAST(count(*) AS BIGINT) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")(
    lambda spark, d: P.window_counts(table(spark, d, "events"), "ts", "1 day").select(F.date_format("w.start", "yyyy-MM-dd").alias("day"), "event_type", "n", "total")
)
query("stream_sessions", "SELECT user_id, CAST(count(*) AS BIGINT) AS sessions, CAST(max(n) AS BIGINT) AS longest FROM (SELECT user_id, sid, count(*) AS n FROM (SELECT user_id, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS sid FROM (SELECT user_id, ts, event_id, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events)) GROUP BY user_id, sid) GROUP BY user_id")(
    lambda spark, d: P.sessions(table(spark, d, "events"), "user_id", "ts", "30 minutes").groupBy("user_id").agg(F.count("*").alias("sessions"), F.max("n").alias("longest"))
)
