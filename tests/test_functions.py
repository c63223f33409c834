"""Edges: nulls, empties, bounds, ties."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lensmill.functions import models as M
from lensmill.functions import scoring as S
from lensmill.functions import text as X
from lensmill.operators import relate as J
from lensmill.operators import sampling as K


def one(spark, value, build, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(build(F.col("c"))).first()[0]


@pytest.mark.parametrize(
    ("raw", "clean"),
    [(None, None), ("", ""), ("a\t\tb", "a b"), ("a\n\n\n\nb", "a\n\nb"), ("  x  \n  y ", "x\ny"), ("a\n \n \n \nb", "a\n\n\n\nb")],
)
def test_whitespace(spark, raw, clean):
    assert one(spark, raw, X.normalize_whitespace) == clean


def test_sanitize(spark):
    df = spark.createDataFrame([("&lt;b&gt;x&lt;/b&gt; &amp; y​",), (None,), ("plain",)], "c string")
    assert sorted(str(r[0]) for r in X.sanitize(df, "c", "o").select("o").collect()) == ["None", "plain", "x & y"]


def test_head_tail(spark):
    assert one(spark, "a b c d e f", lambda c: X.head_tail(c, 2, 2)) == "a b [...] e f"
    assert one(spark, "a b c d", lambda c: X.head_tail(c, 2, 2)) == "a b c d"


def test_json(spark):
    assert one(spark, 'x ```json\n{"a": 1}\n``` y', X.extract_json) == '{"a": 1}'
    assert one(spark, 'x {"a": {"b": 1}} y', X.extract_json) == '{"a": {"b": 1}}'
    df = spark.createDataFrame([('{"a": 1,}',), ('{"a": 2}',), ("zzz",)], "c string")
    got = {r["c"]: r["json_repaired"] for r in X.parse_or_repair(df, "c").select("c", "json_repaired").collect()}
    assert got == {'{"a": 1,}': True, '{"a": 2}': False, "zzz": False}


@pytest.mark.parametrize("v", [-1.0, 0.0, 1.9, 2.0, 4.2, 4.5, 8.0, 10.0, 11.0])
def test_interpolate(spark, v):
    xs, ys = [0, 2, 2, 4.5, 10], [1, 1, 2, 5, 9]
    assert one(spark, v, lambda c: S.interpolate(c, xs, ys), "double") == pytest.approx(np.interp(v, xs, ys) if v != 2.0 else 2.0)


def test_scores(spark):
    assert one(spark, float("nan"), S.clamp, "double") == 10.0
    assert one(spark, float("nan"), lambda c: S.calibrate(c, [0, 1], [1, 2]), "double") == 0.0
    assert one(spark, 3.0, lambda c: S.gated(F.lit(5.0), c, 3.0, 3.5)[0], "double") == 5.0
    assert one(spark, 2.99, lambda c: S.gated(F.lit(5.0), c, 3.0, 3.5)[0], "double") == 3.5
    assert one(spark, 4.0, lambda c: S.tier(c, (("high", 7.0), ("medium", 4.0))), "double") == "medium"
    assert not [p for s in S.DEPLOYED for p in s.problems()]


def test_normalization_counts(spark):
    vals = [float(v) for v in np.random.default_rng(1).normal(5, 2, 500)]
    got = {r["k"]: (r["x"], r["y"]) for r in S.fit_normalization(spark.createDataFrame([(v,) for v in vals], "v double"), "v", 50).collect()}
    grid = np.linspace(min(vals), max(vals), 50)
    assert len(got) == 50
    for k, x in enumerate(grid):
        assert got[k][1] == pytest.approx(sum(v <= x + 1e-12 for v in vals) / 500 * 10, abs=0.021)
    assert got[49][1] == 10


def test_dedup(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (None, 3), (None, 4)], "id int, pos int")
    assert sorted(r["pos"] for r in J.keep_one(df, ["id"], [F.col("pos").desc()]).collect()) == [2, 3, 4]
    assert J.exclude(df, spark.createDataFrame([(1,)], "id int"), "id").count() == 2


@pytest.mark.parametrize("n", range(1, 12))
def test_split_sizes(spark, n):
    df = spark.range(n).withColumn("s", F.lit("x"))
    got = {r["split"]: r["count"] for r in K.stratified_split(df, "s", "id").groupBy("split").count().collect()}
    train, upto = int(n * 0.8), int(n * (0.8 + 0.1))
    assert (got.get("train", 0), got.get("val", 0), got.get("test", 0)) == (train, upto - train, n - upto)


def test_ask_retries(spark):
    def client():
        calls = {}

        def call(p):
            calls[p] = calls.get(p, 0) + 1
            if p == "auth":
                raise RuntimeError("invalid api key")
            if p == "slow" and calls[p] < 3:
                raise RuntimeError("timed out")
            return "ok"

        return call

    df = spark.createDataFrame([("auth",), ("slow",), ("good",)], "p string").coalesce(1)
    got = {r["p"]: (r["answer"], r["attempts"]) for r in M.ask(df, "p", client, sleep=lambda s: None).collect()}
    assert got == {"auth": (None, 1), "slow": ("ok", 3), "good": ("ok", 1)}
    assert M.backoff("rate_limit", 1) == 4.0


def test_death_adjacent_reads_accents_and_the_whole_text(spark, sf, monkeypatch):
    from lensmill.plans import q_rules, registry

    yes = ["Avis de décès", "ses obsèques", "Nachruf auf", "Óbito", "nota de ÓBITO", "overleden in mei", "Verstorbene", "he died.", "passed away", "x " * 2000 + "funeral"]
    no = ["distributed", "studied", "today", "édeath", "diedrich", "a clean text"]
    rows = spark.createDataFrame([(i, "u", "s", "en", None if i % 2 else t, t if i % 2 else None) for i, t in enumerate([*yes, *no])], "id bigint, url string, source string, language string, title string, content string")
    monkeypatch.setattr(q_rules, "topical", lambda spark, d: rows.withColumns({"t": F.regexp_replace(F.lower(F.concat_ws(" ", "title", F.substring("content", 1, 2000))), r"[^\x00-\x7F]", "x")}))
    out = {r.id: r.out for r in registry.load()["pred_death_adjacent"].run(spark, sf).collect()}
    assert [out[i] for i in range(len(out))] == [True] * len(yes) + [False] * len(no)
