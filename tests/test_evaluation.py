"""Evaluation operators on own columns: against numpy, and on nulls, ties, empty tables and one class."""

import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lensmill.functions import models, scoring, vectors
from lensmill.functions import rules as R
from lensmill.functions import text as X
from lensmill.operators import metrics as M
from lensmill.operators import quality as Q
from lensmill.operators import ranking as K
from lensmill.operators import sampling, summary
from lensmill.sources import config as G
from lensmill.streaming import jobs


def table(spark, n=300, seed=5):
    r = np.random.default_rng(seed)
    p = np.round(r.uniform(0, 10, n), 1)
    y = np.clip(p + np.round(r.normal(0, 1, n), 1), 0, 10)
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(zip(p, y, strict=True))]
    return spark.createDataFrame([*rows, (n, None, 3.0), (n + 1, 3.0, None)], "key bigint, student double, truth double"), p, y


def ranks(x):
    return np.array([np.sum(x < v) + (np.sum(x == v) + 1) / 2 for v in x])


@pytest.mark.parametrize("buckets", [1, 7])
def test_ranks(spark, buckets):
    df, p, y = table(spark)
    got = {r.key: r for r in K.ecdf(K.avg_rank(df, "student", "r", buckets), "student", "e", buckets).collect()}
    both = np.append(p, 3.0)  # the row without truth has a prediction
    keys = [*range(300), 301]
    assert [got[k].r for k in keys] == ranks(both).tolist() and got[300].r is None and got[300].e is None
    assert np.allclose([got[k].e for k in keys], [np.mean(both <= v) for v in both])
    some = df.dropna()
    order = sorted(range(300), key=lambda i: (p[i], i))
    rows = {r.key: r.row for r in K.row_numbers(some, "student", ["key"], buckets=buckets).collect()}
    assert rows == {k: i for i, k in enumerate(order)}
    assert {r.key: r.slice for r in K.slices(some, "student", ["key"], 5, buckets=buckets).collect()} == {k: i * 5 // 300 for i, k in enumerate(order)}
    assert K.values_at(df, "student", (0.0, 0.25, 0.5, 1.0), buckets) == [sorted(both)[int(min(301 * s, 300))] for s in (0.0, 0.25, 0.5, 1.0)]
    assert M.spearman(df, "student", "truth", buckets=buckets).first().rho == pytest.approx(np.corrcoef(ranks(p), ranks(y))[0, 1])
    empty = df.filter("false")
    assert K.avg_rank(empty, "student").count() == 0 and K.values_at(empty, "student", (0.5,)) == [] and summary.index_quantiles(empty, "student").first().p50 is None


def test_correlations_of_little(spark):
    for rows in ([], [(1.0, 2.0)], [(1.0, 1.0), (1.0, 2.0)], [(None, 1.0), (2.0, None)]):
        df = spark.createDataFrame(rows, "a double, b double")
        assert M.spearman(df, "a", "b").first().rho == 0.0
        assert M.pearson(df, "a", "b").first().r is None
    df, p, y = table(spark)
    assert M.pearson(df, "student", "truth").first().r == pytest.approx(np.corrcoef(p, y)[0, 1])
    assert M.slope(df, "student", "truth").first().slope == pytest.approx(np.polyfit(p, y, 1)[0])


def test_errors_and_classes(spark):
    df, p, y = table(spark)
    e = p - y
    got = M.mae_rmse(df, "student", "truth").first()
    assert got.mae == pytest.approx(np.abs(e).mean()) and got.rmse == pytest.approx(math.sqrt((e * e).mean()))
    g = M.gate_eval(df, "student", "truth", 5.0).first()
    tp, fp, fn = np.sum((y >= 5) & (p >= 5)), np.sum((y < 5) & (p >= 5)), np.sum((y >= 5) & (p < 5))
    assert (g.tp, g.fp, g.fn, g.tn) == (tp, fp, fn, 300 - tp - fp - fn) and g.recall == pytest.approx(tp / (tp + fn)) and g.prec == pytest.approx(tp / (tp + fp))
    none = M.gate_eval(df.filter("false"), "student", "truth", 5.0).first()
    assert (none.tp, none.recall, none.prec, none.mae) == (0, 0.0, 0.0, None)
    negatives = M.gate_eval(df.filter("truth < 5"), "student", "truth", 5.0).first()
    assert negatives.recall == 0.0 and negatives.fn == 0
    one = spark.createDataFrame([(True, True), (True, None)], "p boolean, y boolean")
    c = M.classifier_report(one, F.col("p"), F.col("y")).first()
    assert (c.accuracy, c.f1) == (1.0, 1.0) and M.classifier_report(one.filter("false"), F.col("p"), F.col("y")).first().f1 == 0.0
    assert {r.band: r.n for r in M.mae_by_band(df, "student", "truth").collect()} == {b: int(np.sum((y >= lo) & (y < hi))) for b, lo, hi in (("0-2", 0, 2), ("2-4", 2, 4), ("4-6", 4, 6), ("6-8", 6, 8), ("8-10", 8, 11))}


def test_sweeps(spark):
    df, p, y = table(spark)
    df = df.dropna()
    grid = [0.0, 2.5, 5.0, 5.1, 9.9, 11.0]
    for r in M.threshold_curve(df, "student", F.col("truth") >= 5, grid).collect():
        assert r.recall == pytest.approx(np.sum((y >= 5) & (p >= r.th)) / np.sum(y >= 5)) and r.stage2_rate == pytest.approx(np.mean(p >= r.th))
        assert r.fn_rate == pytest.approx(1 - r.recall)
    want = max(t for t in grid if np.sum((y >= 5) & (p < t)) / np.sum(y >= 5) <= 0.1)
    assert M.select_threshold(df, "student", F.col("truth") >= 5, grid, 0.1).first().threshold == want
    for r in M.probe_check(df, "student", "truth", grid).collect():
        true = np.sum(y >= r.th)
        assert r.recall == pytest.approx(np.sum((y >= r.th) & (p >= r.th)) / true if true else 1.0) and r.skip_rate == pytest.approx(np.mean(p < r.th)) and r.bias == pytest.approx((p - y).mean())
    assert {r.fn_rate for r in M.threshold_curve(df, "student", F.lit(False), grid).collect()} == {0.0}
    assert M.threshold_curve(df.filter("false"), "student", F.lit(True), grid).count() == 0


def test_top_k(spark):
    df, p, y = table(spark)
    best = lambda v: [i for i in sorted(range(300), key=lambda i: (-v[i], i))]
    a, b = best(p), best(y)
    for r in M.recall_at_k(df, "key", "student", "truth", (5, 40, 1000)).collect():
        k = min(r.k, 300)
        assert r.recall == pytest.approx(len(set(a[:k]) & set(b[:k])) / k)
    for r in M.ndcg(df, "key", "student", "truth", (5, 40)).collect():
        dcg = lambda o, k=r.k: sum(y[i] / math.log2(j + 2) for j, i in enumerate(o[:k]))
        assert r.ndcg == pytest.approx(dcg(a) / dcg(b))


def test_mann_whitney(spark):
    df, p, _ = table(spark)
    r = M.mann_whitney(df.dropna(), "student", F.col("key") % 3 == 0).first()
    x, z = p[::3], np.delete(p, np.arange(0, 300, 3))
    u = sum(np.sum(a > z) + 0.5 * np.sum(a == z) for a in x)
    n, ties = 300, sum(c**3 - c for c in np.unique(p, return_counts=True)[1])
    sd = math.sqrt(len(x) * len(z) / 12 * (n + 1 - ties / (n * (n - 1))))
    assert r.u == pytest.approx(u) and r.p == pytest.approx(math.erfc(max(abs(u - len(x) * len(z) / 2) - 0.5, 0) / sd / math.sqrt(2)), abs=1e-6)
    assert M.mann_whitney(df.filter("key = 1"), "student", F.lit(True)).first().p is None


def test_wilson_and_agreement_gate(spark):
    w = spark.createDataFrame([(0.0, 0.0), (90.0, 100.0), (100.0, 100.0)], "k double, n double").select(M.wilson_lower(F.col("k"), F.col("n")).alias("w")).collect()
    assert [round(x.w, 4) for x in w] == [0.0, 0.8256, 0.963]
    rows = [(f"d{i}", "declined", 5.0, 1.0 + i / 100) for i in range(60)] + [(f"r{i}", "reference", 2 + i / 10, 2.1 + i / 10) for i in range(50)] + [("x", "reference", 6.0, None), ("y", "declined", 5.0, None)]
    df = spark.createDataFrame(rows, "id string, kind string, old double, new double")
    of = lambda k: F.col("kind") == k
    g = M.agreement_gate(df, "old", "new", 4.0, of("declined"), of("reference")).first()
    assert g.demotion_low > 0.9 and g.shift == 0.0 and g.protection is None and g.rho == pytest.approx(1.0) and g.passed
    g = M.agreement_gate(df, "old", "new", 4.0, of("declined"), of("reference"), of("protected")).first()
    assert g.protection == 0.0 and not g.passed
    none = M.agreement_gate(df.filter("false"), "old", "new", 4.0, of("declined"), of("reference")).first()
    assert none.demotion_low == 0.0 and not none.passed


def test_summaries(spark):
    df = spark.createDataFrame([(1, True, True, True, False), (2, False, False, None, True), (3, True, False, None, None)], "id int, a boolean, b boolean, c boolean, d boolean")
    assert [(r.verdict, r.yes, r.n) for r in summary.majority(df, "id", [F.col(c) for c in "abcd"]).orderBy("id").collect()] == [("block", 3, 4), ("split", 1, 3), ("split", 1, 2)]
    v = spark.createDataFrame([(1, 3.0, 1.0, None), (2, None, None, None)], "id int, a double, b double, c double")
    assert [r.consensus for r in summary.consensus(v, "id", [F.col(c) for c in "abc"]).orderBy("id").collect()] == [2.0, None]
    s = spark.createDataFrame([(6.0, 1.0), (6.0, 7.0), (None, 7.0)], "x double, y double")
    lens = {"x": F.col("x"), "y": F.col("y")}
    assert [tuple(r) for r in summary.overlap_matrix(s, lens, 5.0).collect()] == [("x", "y", 1, 50.0)]
    assert {r.lens: (r.exclusive, r.n) for r in summary.exclusivity(s, lens, 5.0).collect()} == {"x": (1, 2), "y": (1, 2)}


def test_quality(spark):
    df = spark.createDataFrame([(1, "a" * 400, 11.0), (2, " ", float("nan")), (3, None, None)], "id int, text string, label double")
    assert Q.label_problems(df, "label").first().asDict() == {"out_of_range": 1, "missing": 2, "zero": 0}
    found = Q.findings(df, [("range", Q.ISSUE, (F.col("label") > 10) & ~F.isnan("label")), ("blank", Q.WARNING, F.trim("text") == "")])
    assert {r.check_name: r.n for r in found.collect()} == {"range": 1, "blank": 1} and not Q.verdict(found).first().passed
    assert Q.verdict(Q.findings(df.filter("id = 2"), [("blank", Q.WARNING, F.trim("text") == "")])).first().passed
    h = Q.hard_verify(df, "text", "id", spark.createDataFrame([(1,), (1,)], "id int")).first()
    assert (h.short, h.empty, h.probes, h.n) == (1, 1, 1, 3)
    names = spark.createDataFrame([(["a", "b"],), (["a", "b"],)], "names array<string>")
    assert Q.same_dimensions(names, "names", ["a", "b"]).first().consistent and not Q.same_dimensions(names, "names", ["b", "a"]).first().consistent


def test_plans_hold_no_rows_in_one_task(spark):
    """Ranks, sweeps, splits: no exchange to a single partition and no nested loop over base rows."""
    df, _, _ = table(spark)
    df.dropna().write.mode("overwrite").parquet(spark.conf.get("spark.checkpoint.dir") + "/plans")
    df = spark.read.parquet(spark.conf.get("spark.checkpoint.dir") + "/plans")
    made = {
        "avg_rank": K.avg_rank(df, "student", buckets=4), "rows": K.row_numbers(df, "student", ["key"], buckets=4), "sweep": M.sweep(df, "student", [1.0, 2.0], {"f": F.col("truth") > 5}),
        "split": sampling.stratified_split(df.withColumn("s", F.col("key") % 2), "s", "key"), "batches": sampling.batches(df, "key", 10),
    }
    for name, out in made.items():
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        physical = out._jdf.queryExecution().sparkPlan().toString()
        assert "Cross" not in plan and "NestedLoop" not in physical, name
        for window in [x for x in plan.split("\n") if "Window [" in x and "], [" not in x]:
            assert "row_number" not in window, (name, window)


def test_configurations(spark, tmp_path):
    yaml = pytest.importorskip("yaml")
    dims = {"impact": {"weight": 0.6}, "evidence": {"weight": 0.4}}
    config = {
        "filter": {"name": "x", "version": "7.0"}, "scoring": {"dimensions": dims, "gatekeepers": {"g": {"dimension": "evidence", "threshold": 3, "max_score": 2.5}}, "tiers": {"high": {"threshold": 7}, "low": {"threshold": 0}}, "score_scale_factor": 1},
        **{s: {} for s in G.SECTIONS if s not in ("filter", "scoring")},
    }
    (tmp_path / "c.yaml").write_text(yaml.safe_dump(config, sort_keys=False))
    (tmp_path / "c.json").write_text(json.dumps(config))
    for name in ("c.yaml", "c.json"):
        got = G.read_config(spark, str(tmp_path / name))
        assert G.problems(got) == [] and G.dimensions(got) == ["impact", "evidence"] and G.checklist(got, 7, 10, 5) == []
        s = G.scoring_of(got)
        assert s == scoring.Scoring("x", 7, (0.6, 0.4), 1, 3.0, 2.5, (("high", 7.0), ("low", 0.0)))
    marked = {"scoring": {"dimensions": {"a": {"weight": 1.0, "gatekeeper": True, "gatekeeper_threshold": 4, "gatekeeper_max_score": 1}}}}
    assert G.scoring_of(marked).gate == 0 and G.scoring_of({}) is None and G.scoring_of(marked).gate_min == 4
    bad = {**config, "scoring": {"dimensions": {"a": {"weight": 0.5}}, "gatekeepers": []}, "ground_truth": 1, "source_filter": {"excluded_source_types": ["code_rep", "code_repo", 4], "shadow_mode": "yes"}}
    del bad["oracle"]
    assert G.problems(bad, ("code_repo",)) == sorted({
        "missing_top_level:oracle", "unexpected_top_level:ground_truth", "scoring_missing:tiers", "scoring_missing:score_scale_factor", "scoring_type:gatekeepers_is_list_not_dict", "scoring_weights:0.500",
        "source_filter_unknown_type:code_rep", "source_filter_type:excluded_item_not_str", "source_filter_type:shadow_mode_not_bool",
    })
    for found, want in (("code_repo", "source_filter_type:excluded_not_list"), (None, "source_filter_missing:excluded_source_types")):
        assert want in G.problems({**config, "source_filter": {"excluded_source_types": found}}, ("code_repo",))
    assert "source_filter_type:not_a_dict" in G.problems({**config, "source_filter": []}) and "scoring_type:not_a_dict" in G.problems({**config, "scoring": 3})
    assert G.lookup_table(spark, str(tmp_path / "none.json")) is None and G.lookup_table(spark, str(tmp_path / "c.json")) == config
    assert G.checklist(config, 6, 3, 5) == ["version 7 in the directory of version 6", "3 training rows, 5 wanted"] and G.analysis_field("uplifting") == "uplifting_analysis"


def test_packages_from_files(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps({"name": "p", "version": 2, "min_length": 5, "domains": {"bad.example": "spam"}, "categories": [{"name": "décès", "patterns": [r"\bobsèques\b"], "exceptions": [r"\bmusée\b"]}], "override_keywords": ["solaire"]}))
    p = G.load_package(spark, str(tmp_path / "p.json"))
    rows = [("t", "les obsèques de", "http://x"), ("t", "obsèques au musée", "http://x"), ("t", "obsèques solaires", "http://x"), ("t", "abc", "http://x"), ("t", "un texte", "http://bad.example/1"), (None, "un texte", "http://x")]
    df = spark.createDataFrame(rows, "title string, content string, url string").withColumn("t", F.lower(F.concat_ws(" ", "title", "content")))
    got = R.apply_package(df, p).withColumn("e", scoring.empty_result(F.col("prefilter_reason"))).collect()
    assert [r.prefilter_reason for r in got] == ["excluded_décès", None, None, "content_too_short", "excluded_domain_spam", "missing_title"] and R.statistics(p)["patterns"] == 1
    assert [r.e and (r.e.passed_prefilter, r.e.prefilter_reason) for r in got][:2] == [(False, "excluded_décès"), None]
    assert sorted(got[0].e.asDict()) == ["gatekeeper_applied", "passed_prefilter", "prefilter_reason", "scores", "tier", "tier_description", "weighted_average"]


def test_zero_shot(spark):
    rows = [([0.4, 0.3],), ([0.34, 0.3],), ([0.3, 0.9],), ([0.5, 0.5],), ([],), (None,)]
    df = spark.createDataFrame(rows, "s array<double>")
    got = df.select(models.zero_shot(F.col("s"), ("climate, energy", "sports results")).alias("r")).select("r.*").collect()
    assert [tuple(r) for r in got] == [(True, "passed_semantic"), (False, "blocked_category:climate"), (False, "blocked_category:sports"), (True, "passed_semantic"), (False, "no_scores"), (False, "no_scores")]


def test_percentile_pooling(spark):
    v = np.random.default_rng(1).normal(size=(5, 3))
    df = spark.createDataFrame([([list(map(float, x)) for x in v],)], "c array<array<double>>")
    assert np.allclose(df.select(vectors.pooled(F.col("c"), "percentile_25_75").alias("p")).first().p, np.concatenate([np.percentile(v, q, axis=0) for q in (25, 75)]))


def test_calls_are_measured_and_spaced(spark):
    waits = spark.sparkContext.accumulator(0.0)
    df = spark.createDataFrame([(1, "ok"), (2, "no")], "id int, prompt string").coalesce(1)

    def client():
        def call(p):
            if p == "no":
                raise ValueError("Invalid API key")
            return p

        return call

    got = models.ask(df, "prompt", client, sleep=lambda s: waits.add(s), between=1.5)
    rows = {r.id: r for r in models.call_metrics(got, "id").collect()}
    assert (rows[1].success, rows[1].error_type, rows[2].success, rows[2].error_type) == (True, None, False, "auth") and waits.value == 3.0


def test_streams_stop_at_a_number_of_batches(spark, tmp_path):
    for k in range(4):
        spark.range(10 * k, 10 * k + 10).write.mode("append").parquet(str(tmp_path / "in"))
    n = len(list((tmp_path / "in").glob("*.parquet")))
    read = lambda: jobs.read_stream(spark, str(tmp_path / "in"), spark.range(1).schema)
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    assert jobs.resumable(read(), lambda b: b, out, check, max_batches=2) and len(list((tmp_path / "out").glob("batch=*"))) == 2 < n
    assert not jobs.resumable(read(), lambda b: b, out, check) and spark.read.parquet(out).select("id").distinct().count() == 40


def test_cleaner_keeps_genuine_replacement_characters(spark):
    df = spark.createDataFrame([(bytearray("a�b".encode()),), (bytearray(b"a\xff b\xed\xa0\x80"),)], "b binary").selectExpr("cast(b as string) as t")
    assert [r.t for r in df.select(X.drop_invalid(F.col("t")).alias("t")).collect()] == ["a�b", "a b"]


def test_manifest_reads_files_as_streams(spark, tmp_path):
    """Files beyond what a row may hold, of odd names, packed and without a last newline."""
    import hashlib

    from lensmill.sources import writers

    held = {"a b%20#?.jsonl": "ü\r\n\n{}".encode() * 3000, "x.json.gz": b"\x1f\x8b not gzip\n", "bom.txt": b"\xef\xbb\xbf\xff\n\nend"}
    for name, data in held.items():
        (tmp_path / "deep").mkdir(exist_ok=True)
        (tmp_path / "deep" / name).write_bytes(data)
    want = sorted((name, len(d), hashlib.sha256(d).hexdigest(), d.count(b"\n")) for name, d in held.items())
    key = "spark.sql.sources.binaryFile.maxLength"
    before = spark.conf.get(key)
    spark.conf.set(key, "1000")
    try:
        assert sorted(tuple(r) for r in writers.manifest(spark, str(tmp_path)).collect()) == want
    finally:
        spark.conf.set(key, before)
    # a file system that only Spark's readers open
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.manifest.link./in", f"file://{tmp_path}")
    assert sorted(tuple(r) for r in writers.manifest(spark, "viewfs://manifest/in").collect()) == want
