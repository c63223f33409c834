"""Vectors, models and top-k by similarity."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from lensmill.functions import models as M
from lensmill.functions import vectors as L
from lensmill.plans.registry import query
from lensmill.plans.views import ARTICLES, SCORES, articles, big, q, r6, scores, table, with_wa

C = F.col
DIM = 64
E = "e AS (SELECT vec_id AS id, label, embedding FROM embeddings)"
#: The mean of the vectors with label 0, scaled to unit length.
CEN = "mean AS (SELECT i, avg(CAST(embedding[i] AS DOUBLE)) AS m FROM e, (SELECT unnest(range(1, 65)) AS i) WHERE label = 0 GROUP BY i), cen AS (SELECT i, m / sqrt((SELECT sum(m * m) FROM mean)) AS c FROM mean)"
SIM = "sim AS (SELECT id, sum(CAST(embedding[i] AS DOUBLE) * c) AS sim FROM e, cen GROUP BY id)"


def _e(spark, d):
    return table(spark, d, "embeddings").select(C("vec_id").alias("id"), "label", "embedding")


def _sim(spark, d):
    e = _e(spark, d)
    return L.with_cosine(e, "embedding", L.centroid(e.filter("label = 0"), "embedding", DIM))


query("scan_embeddings", "SELECT vec_id AS id, label, CAST(len(embedding) AS BIGINT) AS dims, round(CAST(embedding[1] AS DOUBLE), 6) AS e0 FROM embeddings")(
    lambda spark, d: _e(spark, d).select("id", "label", big(F.size("embedding")).alias("dims"), r6(F.get("embedding", F.lit(0)).cast("double")).alias("e0"))
)
query("vec_centroid", q("SELECT CAST(i - 1 AS BIGINT) AS pos, round(c, 5) AS c FROM cen", E, CEN))(
    lambda spark, d: L.centroid(_e(spark, d).filter("label = 0"), "embedding", DIM).select(F.posexplode("centroid").alias("pos", "c")).select(big(C("pos")).alias("pos"), F.round("c", 5).alias("c"))
)
query("vec_cosine_centroid", q("SELECT id, round(sim, 5) AS sim FROM sim", E, CEN, SIM))(lambda spark, d: _sim(spark, d).select("id", F.round("sim", 5).alias("sim")))
query("topk_similarity", q("SELECT id, round(sim, 4) AS sim FROM sim JOIN e USING (id) WHERE label <> 0 ORDER BY sim DESC, id LIMIT 25", E, CEN, "sim AS (SELECT id, sum(CAST(embedding[i] AS DOUBLE) * c) AS sim FROM e, cen GROUP BY id)"))(
    lambda spark, d: _sim(spark, d).filter("label <> 0").orderBy(C("sim").desc(), "id").limit(25).select("id", F.round("sim", 4).alias("sim"))
)
#: Four neighbouring vectors are the chunks of one document.
CH = "ch AS (SELECT id // 4 AS doc, id % 4 AS pos, embedding FROM e)"


def _chunks(spark, d):
    c = _e(spark, d).select(F.floor(C("id") / 4).alias("doc"), (C("id") % 4).alias("pos"), "embedding")
    return c.groupBy("doc").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "embedding"))), lambda x: x["embedding"]).alias("chunks"))


query("scan_chunk_embeddings", "SELECT vec_id // 4 AS doc, vec_id % 4 AS pos, CAST(len(embedding) AS INTEGER) AS dims FROM embeddings")(lambda spark, d: _e(spark, d).select(F.floor(C("id") / 4).alias("doc"), (C("id") % 4).alias("pos"), F.size("embedding").alias("dims")))
LONGCH = "lc AS (SELECT doc, pos, i, CAST(embedding[i] AS DOUBLE) AS x, count(*) OVER (PARTITION BY doc, i) AS n FROM ch, (SELECT unnest(range(1, 65)) AS i))"
AGGS = {
    "mean": ["avg(x)"], "max": ["max(x)"], "min": ["min(x)"], "mean_max": ["avg(x)", "max(x)"], "min_max": ["min(x)", "max(x)"], "first_last": ["min_by(x, pos)", "max_by(x, pos)"],
    "weighted_position": ["sum(x * (n - pos)) / (any_value(n) * (any_value(n) + 1) / 2.0)"], "mean_std": ["avg(x)", "sqrt(greatest(avg(x * x) - avg(x) * avg(x), 0))"],
    "first_middle_last": ["min_by(x, pos)", "max(CASE WHEN pos = n // 2 THEN x END)", "max_by(x, pos)"], "percentile_25_75": ["quantile_cont(x, 0.25)", "quantile_cont(x, 0.75)"],
    "all_concat": ["avg(x)", "max(x)", "min(x)", "sqrt(greatest(avg(x * x) - avg(x) * avg(x), 0))"],
}
for _name in L.STRATEGIES:
    _sql = None
    if _name in AGGS:
        _parts = " UNION ALL ".join(f"SELECT doc, CAST(i - 1 + {64 * k} AS BIGINT) AS pos, round({a}, 5) AS v FROM lc GROUP BY doc, i" for k, a in enumerate(AGGS[_name]))
        _sql = q(_parts, E, CH, LONGCH)
    query(f"vec_pooling_{_name}", _sql)(
        lambda spark, d, n=_name: _chunks(spark, d).select("doc", F.posexplode(L.pooled(C("chunks"), n)).alias("pos", "v")).select(big(C("doc")).alias("doc"), big(C("pos")).alias("pos"), F.round("v", 5).alias("v"))
    )
NORMS = "nm AS (SELECT doc, pos, sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))) AS nrm, list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))) / 64 - pow(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))) / 64, 2) AS var, embedding FROM ch)"


def _scored(spark, d):
    c = _chunks(spark, d).select("doc", L.pooled(C("chunks"), "mean").alias("mean"), F.posexplode("chunks").alias("pos", "chunk"))
    return c.select(big(C("doc")).alias("doc"), big(C("pos")).alias("pos"), "chunk", *(L.chunk_score(C("chunk"), C("mean"), C("pos"), m).alias(m) for m in ("norm", "variance")))


query("vec_chunk_scores", q("SELECT doc, CAST(pos AS BIGINT) AS pos, round(nrm, 5) AS norm, round(var, 5) AS variance FROM nm", E, CH, NORMS))(lambda spark, d: _scored(spark, d).select("doc", "pos", F.round("norm", 5).alias("norm"), F.round("variance", 5).alias("variance")))


@query("vec_topk_mean", q("SELECT doc, CAST(i - 1 AS BIGINT) AS pos, round(avg(CAST(embedding[i] AS DOUBLE)), 5) AS v FROM (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY round(var, 9) DESC, pos) AS k FROM nm), (SELECT unnest(range(1, 65)) AS i) WHERE k <= 2 GROUP BY doc, i", E, CH, NORMS))
def vec_topk_mean(spark, d):
    k = F.row_number().over(Window.partitionBy("doc").orderBy(F.round("variance", 9).desc(), "pos"))
    top = _scored(spark, d).withColumn("k", k).filter("k <= 2").groupBy("doc").agg(F.collect_list("chunk").alias("chunks"))
    return top.select("doc", F.posexplode(L.pooled(C("chunks"), "mean")).alias("pos", "v")).select("doc", big(C("pos")).alias("pos"), F.round("v", 5).alias("v"))


@query("vec_standardize", q("SELECT id, round((s0 - m0) / d0, 5) AS z0, round((s1 - m1) / d1, 5) AS z1 FROM scores, (SELECT avg(s0) AS m0, stddev_pop(s0) AS d0, avg(s1) AS m1, stddev_pop(s1) AS d1 FROM scores)", SCORES))
def vec_standardize(spark, d):
    s = scores(spark, d)
    stats = s.agg(F.array(F.avg("s0"), F.avg("s1")).alias("m"), F.array(F.stddev_pop("s0"), F.stddev_pop("s1")).alias("sd"))
    z = L.standardize(F.array("s0", "s1"), C("m"), C("sd"))
    return s.join(F.broadcast(stats)).select("id", z.alias("z")).select("id", F.round(C("z")[0], 5).alias("z0"), F.round(C("z")[1], 5).alias("z1"))


def _layers():
    r = np.random.default_rng(0)
    return [(r.normal(size=s) / 8, r.normal(size=s[1]) / 8) for s in ((DIM, 32), (32, 16), (16, 6))]


query("vec_mlp_forward")(lambda spark, d: _e(spark, d).select("id", L.mlp(_layers())("embedding").alias("y")).select("id", F.round(C("y")[0], 5).alias("y0")))
query("topk_probe")(lambda spark, d: _e(spark, d).select("id", L.mlp(_layers())("embedding").alias("y")).select("id", F.round(1 / (1 + F.exp(-C("y")[0])), 6).alias("p")).orderBy(F.desc("p"), "id").limit(20))
query("vec_pca")(lambda spark, d: spark.createDataFrame(L.pca(scores(spark, d), [f"o{i}" for i in range(6)]), "component int, share double, cumulative double, for_95 int"))


@query("ml_probe_train")
def ml_probe_train(spark, d):
    """Ridge probe from the vectors to the weighted average; scored on held-out rows."""
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.regression import LinearRegression

    rows = _e(spark, d).join(with_wa(spark, d).select("id", C("wo").alias("label_wo")), "id").select("id", array_to_vector(C("embedding").cast("array<double>")).alias("f"), "label_wo")
    model = LinearRegression(featuresCol="f", labelCol="label_wo", regParam=0.01).fit(rows.filter("id % 5 <> 0"))
    return model.transform(rows.filter("id % 5 = 0")).agg(F.count("*").alias("n"), r6(F.avg(F.abs(C("prediction") - C("label_wo")))).alias("mae"))


query("udf_score")(lambda spark, d: articles(spark, d).select("id", M.score_udf(M.stub_model())("content").alias("s")).select("id", F.size("s").alias("dims"), F.round(C("s")[0], 6).alias("s0")))
query("udf_commerce")(lambda spark, d: articles(spark, d).select("id", (M.score_udf(M.stub_model(1))("content")[0] / 10 >= 0.95).alias("commerce")))


ZERO_SHOT = ("renewable energy, climate", "sports results", "politics, elections")


@query("prefilter_zero_shot")
def prefilter_zero_shot(spark, d):
    text = F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("content", F.lit("")))
    scored = articles(spark, d).select("id", M.score_udf(M.stub_model(len(ZERO_SHOT)))(F.lower(text)).alias("s"))
    return scored.select("id", M.zero_shot(F.transform("s", lambda x: x / 10), ZERO_SHOT).alias("r")).select("id", "r.*")


@query("udf_screen")
def udf_screen(spark, d):
    s = _e(spark, d).select("id", "embedding", r6(L.mlp(_layers())("embedding")[0]).alias("screen"))
    second = lambda df: df.withColumn("scores", L.mlp(_layers())("embedding"))
    return M.two_stage(s, "screen", 0.0, second, F.lit(None).cast("array<double>")).select("id", "screen", "stage_used")


@query("udf_oracle_stub")
def udf_oracle_stub(spark, d):
    def client():
        def call(prompt):
            if prompt.endswith("3"):
                raise TimeoutError("timed out")
            return '{"score": 5}'

        return call

    a = articles(spark, d).select("id", F.concat(F.lit("rate "), C("id").cast("string")).alias("prompt"))
    return M.ask(a, "prompt", client, sleep=lambda s: None).select("id", "answer", "attempts", "error")


MSG = "list_extract(['Rate limit exceeded', 'Request timed out', 'Invalid API key', 'Connection reset', 'HTTP 503', 'odd'], CAST(event_id % 6 + 1 AS BIGINT))"
query("class_error_type", f"SELECT event_id, CASE WHEN contains(m, 'rate limit') THEN 'rate_limit' WHEN contains(m, 'timed out') THEN 'timeout' WHEN contains(m, 'api key') THEN 'auth' WHEN contains(m, 'connection') THEN 'connection' WHEN contains(m, '503') THEN 'server' ELSE 'unknown' END AS kind FROM (SELECT event_id, lower({MSG}) AS m FROM events)")(
    lambda spark, d: table(spark, d, "events").select("event_id", M.error_type(F.get(F.array(*map(F.lit, ("Rate limit exceeded", "Request timed out", "Invalid API key", "Connection reset", "HTTP 503", "odd"))), (C("event_id") % 6).cast("int"))).alias("kind"))
)
query("udf_resume", q("SELECT id FROM articles WHERE id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)", ARTICLES))(
    lambda spark, d: articles(spark, d).select("id").join(table(spark, d, "labels").filter("quality = 1").select(C("doc_id").alias("id")), "id", "left_anti")
)
