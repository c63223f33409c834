"""Joins, set operations, deduplication, sampling and splitting."""

from __future__ import annotations

from pyspark.sql import functions as F

from lensmill.operators import relate as J
from lensmill.operators import sampling as K
from lensmill.plans.portable import portable
from lensmill.plans.registry import query
from lensmill.plans.views import ARTICLES, SCORES, WA, articles, big, q, r6, scores, table, with_wa

C = F.col
H = "md5(CAST(id AS VARCHAR) || '42')"

# -- joins
query("join_inner_truth", q("SELECT a.id, round(a.ws, 6) AS pred, round(b.wo, 6) AS truth FROM wa a JOIN wa b ON a.id = b.id WHERE a.id % 2 = 0 AND b.id % 3 = 0", SCORES, WA))(
    lambda spark, d: with_wa(spark, d).filter("id % 2 = 0").select("id", r6(C("ws")).alias("pred")).join(with_wa(spark, d).filter("id % 3 = 0").select("id", r6(C("wo")).alias("truth")), "id")
)
query("join_nway_common", q("SELECT id FROM scores WHERE s0 > 4 AND s1 > 4 AND s2 > 4", SCORES))(lambda spark, d: J.common_to_all([scores(spark, d).filter(f"s{i} > 4") for i in range(3)], "id"))
query("join_anti_exclude", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")(lambda spark, d: J.exclude(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels"), "doc_id"))
query("join_semi", "SELECT doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")(
    lambda spark, d: table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels").filter("quality = 1"), "doc_id", "left_semi")
)
query("join_enrich", q("SELECT s.id, round(s.ws, 6) AS wa, a.title FROM wa s JOIN articles a ON s.id = a.id", ARTICLES, SCORES, WA))(
    lambda spark, d: with_wa(spark, d).select("id", r6(C("ws")).alias("wa")).join(articles(spark, d).select("id", "title"), "id")
)
portable("join_lens_pairs", "WITH tri AS (SELECT id AS url, 'a' AS lens, (s0 + s1) / 2 AS wa FROM {scores} UNION ALL SELECT id, 'b', (s2 + s3) / 2 FROM {scores} UNION ALL SELECT id, 'c', (s4 + s5) / 2 FROM {scores}) SELECT a.lens AS la, b.lens AS lb, CAST(count(*) AS BIGINT) AS n, round(corr(a.wa, b.wa), 6) AS r FROM tri a JOIN tri b ON a.url = b.url AND a.lens < b.lens GROUP BY a.lens, b.lens")
DOT = "list_inner_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))"
COS = f"cos AS (SELECT a.vec_id AS id, max({DOT}) AS sim FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id GROUP BY a.vec_id)"


def cosines(spark, d):
    e = table(spark, d, "embeddings").select(C("vec_id").alias("id"), "embedding")
    return J.max_cosine(e, e, "id", "embedding")


query("join_cosine_max", q("SELECT id, round(sim, 5) AS sim FROM cos", COS))(lambda spark, d: cosines(spark, d).select("id", F.round("sim", 5).alias("sim")))
query("vec_max_cosine", q("SELECT round(quantile_cont(sim, 0.5), 5) AS p50, round(quantile_cont(sim, 0.95), 5) AS p95, round(max(sim), 5) AS hi FROM cos", COS))(
    lambda spark, d: cosines(spark, d).agg(F.round(F.percentile("sim", F.lit(0.5)), 5).alias("p50"), F.round(F.percentile("sim", F.lit(0.95)), 5).alias("p95"), F.round(F.max("sim"), 5).alias("hi"))
)
query("dedup_near_cosine", q("SELECT id FROM cos WHERE sim < 0.93", COS))(lambda spark, d: cosines(spark, d).filter("sim < 0.93").select("id"))
query("join_broadcast_dim", q("SELECT id, c.weight FROM scores JOIN (VALUES (0, 'a'), (1, 'b'), (2, 'c')) c(k, weight) ON lens % 3 = c.k", SCORES))(
    lambda spark, d: scores(spark, d).select("id", (C("lens") % 3).alias("k")).join(F.broadcast(spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "k int, weight string")), "k").select("id", "weight")
)
query("join_range_tier", q("SELECT id, max_by(tier, th) AS tier FROM wa JOIN (VALUES ('low', 0.0), ('medium', 4.5), ('high', 6.0)) t(tier, th) ON ws >= th GROUP BY id", SCORES, WA))(
    lambda spark, d: with_wa(spark, d).join(F.broadcast(spark.createDataFrame([("low", 0.0), ("medium", 4.5), ("high", 6.0)], "tier string, th double")), C("ws") >= C("th")).groupBy("id").agg(F.max_by("tier", "th").alias("tier"))
)
portable("join_three_way", "SELECT a.id, round(a.s0, 6) AS x, round(b.s1, 6) AS y, round(c.s2, 6) AS z FROM {scores} a JOIN {scores} b ON a.id = b.id JOIN {scores} c ON a.id = c.id WHERE a.s0 > 5 AND b.s1 > 5 AND c.s2 > 4")
portable("join_duplicate_pairs", "WITH k AS (SELECT doc_id, md5(text) AS h, min(doc_id) OVER (PARTITION BY md5(text)) AS first FROM {documents}) SELECT doc_id, first FROM k WHERE doc_id <> first")

# -- sets and deduplication
EVENTS = "e AS (SELECT event_id % 5000 AS id, CAST(user_id AS BIGINT) AS user_id, event_id AS pos, value FROM events)"


def _events(spark, d):
    return table(spark, d, "events").select((C("event_id") % 5000).alias("id"), C("user_id").cast("bigint").alias("user_id"), C("event_id").alias("pos"), "value")


query("set_union_all", q("SELECT id, 'a' AS part FROM scores WHERE id % 2 = 0 UNION ALL SELECT id, 'b' FROM scores WHERE id % 3 = 0", SCORES))(
    lambda spark, d: scores(spark, d).filter("id % 2 = 0").select("id", F.lit("a").alias("part")).unionByName(scores(spark, d).filter("id % 3 = 0").select("id", F.lit("b").alias("part")))
)
query("set_intersect_except", "(SELECT doc_id, 'both' AS part FROM documents INTERSECT SELECT doc_id, 'both' FROM labels) UNION ALL (SELECT doc_id, 'only' FROM documents EXCEPT SELECT doc_id, 'only' FROM labels)")(
    lambda spark, d: table(spark, d, "documents").select("doc_id").intersect(table(spark, d, "labels").select("doc_id")).withColumn("part", F.lit("both")).unionByName(table(spark, d, "documents").select("doc_id").exceptAll(table(spark, d, "labels").select("doc_id")).withColumn("part", F.lit("only")))
)
LAST = "SELECT id, pos FROM (SELECT id, pos, row_number() OVER (PARTITION BY id ORDER BY pos DESC) AS k FROM e WHERE id IS NOT NULL) WHERE k = 1"
query("dedup_last_wins", q(LAST, EVENTS))(lambda spark, d: J.keep_one(_events(spark, d), ["id"], [C("pos").desc()]).select("id", "pos"))
query("scan_last_wins", q(LAST, EVENTS))(lambda spark, d: _events(spark, d).groupBy("id").agg(F.max("pos").alias("pos")))
query("dedup_first_url", q("SELECT url, min(id) AS id FROM (SELECT 'u' || (id % 300) AS url, id FROM articles) GROUP BY url", ARTICLES))(
    lambda spark, d: J.first_by(articles(spark, d).select(F.concat(F.lit("u"), (C("id") % 300).cast("string")).alias("url"), "id"), ["url"], ["id"])
)
SPLITS = "sp AS (SELECT id % 701 AS id, id AS pos, CASE WHEN id % 10 < 8 THEN 'train' WHEN id % 10 = 8 THEN 'val' ELSE 'test' END AS split FROM articles)"


def _splits(spark, d):
    return articles(spark, d).select((C("id") % 701).alias("id"), C("id").alias("pos"), F.when(C("id") % 10 < 8, "train").when(C("id") % 10 == 8, "val").otherwise("test").alias("split"))


query(
    "dedup_cross_split",
    q("SELECT id, split, pos FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY r) AS k FROM (SELECT *, CASE split WHEN 'train' THEN 1 WHEN 'val' THEN 2 ELSE 3 END AS r, row_number() OVER (PARTITION BY id, split ORDER BY pos DESC) AS j FROM sp) WHERE j = 1) WHERE k = 1", ARTICLES, SPLITS),
)(lambda spark, d: J.cross_split(_splits(spark, d), "id", "split", "pos").select("id", "split", "pos"))
query("dedup_priority_merge", q("SELECT id, CASE WHEN id % 3 = 0 THEN 0 ELSE 1 END AS source_ord FROM scores WHERE id % 3 = 0 OR id % 2 = 0", SCORES))(
    lambda spark, d: J.merge_by_priority([scores(spark, d).filter("id % 3 = 0").select("id"), scores(spark, d).filter("id % 2 = 0").select("id")], "id").select("id", "source_ord")
)
query("dedup_source_order", q("SELECT CAST(o AS INTEGER) AS source_ord, CAST(count(*) AS BIGINT) AS kept FROM (SELECT id, min(o) AS o FROM (SELECT id, 0 AS o FROM scores WHERE id % 4 = 0 UNION ALL SELECT id, 1 FROM scores WHERE id % 3 = 0 UNION ALL SELECT id, 2 FROM scores) GROUP BY id) GROUP BY o", SCORES))(
    lambda spark, d: J.merge_by_priority([scores(spark, d).filter(f).select("id") for f in ("id % 4 = 0", "id % 3 = 0", "true")], "id").groupBy("source_ord").agg(F.count("*").alias("kept"))
)
query("dedup_content_hash", "SELECT sha256(text) AS h, min(doc_id) AS doc_id FROM documents WHERE text <> '' GROUP BY 1")(
    lambda spark, d: table(spark, d, "documents").filter("text <> ''").groupBy(F.sha2("text", 256).alias("h")).agg(F.min("doc_id").alias("doc_id"))
)
query("check_leakage", q("SELECT id, CAST(count(DISTINCT split) AS BIGINT) AS splits FROM sp GROUP BY id HAVING count(DISTINCT split) > 1", ARTICLES, SPLITS))(
    lambda spark, d: _splits(spark, d).groupBy("id").agg(F.count_distinct("split").alias("splits")).filter("splits > 1")
)

# -- sampling
RN = f"row_number() OVER (PARTITION BY {{g}} ORDER BY {H})"
STRAT = "SELECT id, CASE WHEN k <= floor(n * CAST(0.8 AS DOUBLE)) THEN 'train' WHEN k <= floor(n * (CAST(0.8 AS DOUBLE) + CAST(0.1 AS DOUBLE))) THEN 'val' ELSE 'test' END AS split FROM (SELECT id, row_number() OVER (PARTITION BY {g} ORDER BY " + H + ") AS k, count(*) OVER (PARTITION BY {g}) AS n FROM {v})"
query("split_stratified", q(STRAT.format(g="lens", v="scores"), SCORES))(lambda spark, d: K.stratified_split(scores(spark, d), "lens", "id").select("id", "split"))
query("split_binary", q(STRAT.format(g="(ws >= 5)", v="wa"), SCORES, WA))(lambda spark, d: K.stratified_split(with_wa(spark, d).withColumn("y", C("ws") >= 5), "y", "id").select("id", "split"))
query("split_hash_holdout", q("SELECT id, CAST('0x' || substr(sha1(CAST(id AS VARCHAR)), 1, 8) AS BIGINT) % 10000 < 1500 AS held FROM articles", ARTICLES))(lambda spark, d: articles(spark, d).select("id", K.hash_holdout(C("id").cast("string"), 0.15).alias("held")))
query("sample_random", q(f"SELECT id FROM articles ORDER BY {H} LIMIT 100", ARTICLES))(lambda spark, d: K.random_sample(articles(spark, d).select("id"), "id", 100))


MIX = (
    f"c AS (SELECT id, 0 AS o FROM (SELECT id, {RN.format(g='language')} AS k FROM articles) WHERE k <= 18), "
    "s AS (SELECT id, 1 AS o FROM articles WHERE length(content) < 500 ORDER BY md5(CAST(id AS VARCHAR) || '1') LIMIT 10), "
    "l AS (SELECT id, 1 AS o FROM articles WHERE length(content) > 5000 ORDER BY md5(CAST(id AS VARCHAR) || '2') LIMIT 10), "
    "r AS (SELECT id, 2 AS o FROM articles ORDER BY md5(CAST(id AS VARCHAR) || '3') LIMIT 10), u AS (SELECT * FROM c UNION ALL SELECT * FROM s UNION ALL SELECT * FROM l UNION ALL SELECT * FROM r)"
)


@query("sample_category_mix", q("SELECT id, CASE min(o) WHEN 0 THEN 'category' WHEN 1 THEN 'edge' ELSE 'random' END AS why FROM u GROUP BY id", ARTICLES, MIX))
def sample_category_mix(spark, d):
    """70 % spread over categories, 20 % edge cases (short, long), 10 % at random; each id once."""
    a = articles(spark, d).select("id", "language", "content")
    main = K.per_group(a, ["language"], "id", 18).select("id", F.lit("category").alias("why"))
    edge = K.random_sample(a.filter("length(content) < 500"), "id", 10, 1).unionByName(K.random_sample(a.filter("length(content) > 5000"), "id", 10, 2)).select("id", F.lit("edge").alias("why"))
    rest = K.random_sample(a, "id", 10, 3).select("id", F.lit("random").alias("why"))
    return J.merge_by_priority([main, edge, rest], "id").select("id", "why")


QUOTA = "CASE lens % 3 WHEN 0 THEN 15 WHEN 1 THEN 15 ELSE 20 END"
query("sample_bucket_quota", q(f"SELECT id FROM (SELECT id, lens, {RN.format(g='lens % 3')} AS k FROM scores) WHERE k <= {QUOTA}", SCORES))(
    lambda spark, d: K.per_group(scores(spark, d).withColumn("b", C("lens") % 3), ["b"], "id", F.when(C("b") < 2, 15).otherwise(20)).select("id")
)
query("sample_proportional_floor", q(f"SELECT id FROM (SELECT id, {RN.format(g='lens')} AS k, greatest(2, CAST(floor(60.0 * count(*) OVER (PARTITION BY lens) / count(*) OVER ()) AS BIGINT)) AS quota FROM scores) WHERE k <= quota", SCORES))(
    lambda spark, d: _proportional(scores(spark, d)).select("id")
)


def _proportional(s):
    n = s.agg(F.count("*").alias("n"))
    share = s.groupBy("lens").agg(F.count("*").alias("c")).withColumn("quota", F.greatest(F.lit(2), F.floor(F.lit(60.0) * C("c") / n.scalar())))
    return K.per_group(s.join(F.broadcast(share.select("lens", "quota")), "lens"), ["lens"], "id", C("quota"))


QUINT = "qn AS (SELECT id, floor((row_number() OVER (ORDER BY ws, id) - 1) * 5 / count(*) OVER ()) AS qt FROM wa)"


@query("sample_quintile", q(f"SELECT id, CAST(qt AS BIGINT) AS quintile FROM (SELECT id, qt, {RN.format(g='qt')} AS k FROM qn) WHERE k <= 20", SCORES, WA, QUINT))
def sample_quintile(spark, d):
    from lensmill.operators.ranking import slices

    s = slices(with_wa(spark, d).select("id", "ws"), "ws", ["id"], 5, "quintile")
    return K.per_group(s, ["quintile"], "id", 20).select("id", "quintile")


@query("sample_plant_dups", q(f"SELECT id, false AS planted FROM s UNION ALL SELECT id, true FROM (SELECT id FROM s ORDER BY md5(CAST(id AS VARCHAR) || '7') LIMIT 20)", ARTICLES, f"s AS (SELECT id FROM articles ORDER BY {H} LIMIT 100)"))
def sample_plant_dups(spark, d):
    s = K.random_sample(articles(spark, d).select("id"), "id", 100)
    return s.withColumn("planted", F.lit(False)).unionByName(K.random_sample(s, "id", 20, 7).withColumn("planted", F.lit(True)))


BUCKET = "CASE WHEN s0 >= 6.5 THEN 'block' WHEN s0 >= 5.5 THEN 'boundary' ELSE 'recall' END"
query("sample_worksheet", q(f"SELECT id, b FROM (SELECT id, b, {RN.format(g='b')} AS k FROM (SELECT id, {BUCKET} AS b FROM scores)) WHERE k <= CASE b WHEN 'block' THEN 10 WHEN 'boundary' THEN 20 ELSE 15 END", SCORES))(
    lambda spark, d: K.per_group(
        scores(spark, d).select("id", F.when(C("s0") >= 6.5, "block").when(C("s0") >= 5.5, "boundary").otherwise("recall").alias("b")), ["b"], "id", F.when(C("b") == "block", 10).when(C("b") == "boundary", 20).otherwise(15)
    ).select("id", "b")
)
query("sample_batches", q(f"SELECT id, CAST(floor((row_number() OVER (ORDER BY {H}) - 1) / 50) AS BIGINT) AS batch FROM scores", SCORES))(lambda spark, d: K.batches(scores(spark, d), "id", 50).select("id", "batch"))
query("sample_seed_buckets", q("SELECT id, 'tech' AS bucket FROM scores WHERE lens % 3 IN (0, 2) UNION ALL SELECT id, 'social' FROM scores WHERE lens % 3 IN (1, 2)", SCORES))(
    lambda spark, d: scores(spark, d).select("id", F.explode(F.when(C("lens") % 3 == 0, F.array(F.lit("tech"))).when(C("lens") % 3 == 1, F.array(F.lit("social"))).otherwise(F.array(F.lit("tech"), F.lit("social")))).alias("bucket"))
)
query("sample_noise_seed", q("SELECT id, CASE WHEN length(content) < 300 THEN 'short' WHEN contains(content, '%%%') THEN 'junk' END AS reason, NOT (length(content) < 300 OR contains(content, '%%%')) AS signal FROM articles", ARTICLES))(
    lambda spark, d: articles(spark, d).select("id", F.when(F.length("content") < 300, "short").when(F.contains("content", F.lit("%%%")), "junk").alias("reason")).withColumn("signal", C("reason").isNull())
)
TOPP = f"tp AS (SELECT id, lens, count(*) OVER (PARTITION BY lens) AS c, {RN.format(g='lens')} AS k FROM scores), pr AS (SELECT lens, row_number() OVER (ORDER BY count(*) DESC, lens) AS r FROM scores GROUP BY lens)"


@query("sample_top_patterns", q("SELECT id FROM tp JOIN pr USING (lens) WHERE r <= 6 AND k <= 3", SCORES, TOPP))
def sample_top_patterns(spark, d):
    s = scores(spark, d).select("id", "lens")
    top = s.groupBy("lens").agg(F.count("*").alias("c")).orderBy(F.desc("c"), "lens").limit(6)
    return K.per_group(s.join(F.broadcast(top), "lens", "left_semi"), ["lens"], "id", 3).select("id")


query("sample_flag_quota", q(f"SELECT id FROM (SELECT id, lens, {RN.format(g='lens')} AS k, count(*) OVER (PARTITION BY lens) AS c FROM scores WHERE s0 > 5.5) WHERE k <= CASE WHEN c > 10 THEN 4 ELSE 2 END", SCORES))(
    lambda spark, d: _flag_quota(scores(spark, d).filter("s0 > 5.5")).select("id")
)


def _flag_quota(s):
    c = s.groupBy("lens").agg(F.when(F.count("*") > 10, 4).otherwise(2).alias("quota"))
    return K.per_group(s.join(F.broadcast(c), "lens"), ["lens"], "id", C("quota"))


query("sample_round_robin", q(f"SELECT id, CAST(k AS BIGINT) AS turn FROM (SELECT id, lens, {RN.format(g='lens')} AS k FROM scores) ORDER BY k, lens LIMIT 40", SCORES))(
    lambda spark, d: K.round_robin(scores(spark, d), "lens", "id", 40).select("id", big(C("_k")).alias("turn"))
)
