"""The pipeline's stages, the registered queries, and the SQL of those that have it."""

import hashlib
import os
import random
import re
from collections import Counter

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from lensmill.llm import queries as llm
from lensmill.llm.common import made, materialize
from tests.llm.test_operators import WORDS, bag, brute_components, brute_lines, brute_targets, reference_encoder


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = materialize(stage(spark, docs, sf), f"t{k}")
        assert docs.count() > 0
        if k + 1 < len(corpus_pipeline.STAGES):
            assert docs.columns == columns
        if k < 3:
            assert docs.count() <= before
            before = docs.count()
    assert len(corpus_pipeline.STAGES) == 5 and docs.filter("n_tokens <> size(ids)").count() == 0


def test_empty_corpus(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").filter("false")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = materialize(stage(spark, docs, sf), f"e{k}")
        assert docs.count() == 0


def python_quality(text):
    words = bag(text)
    n = len(words)
    windows = [tuple(words[i : i + 5]) for i in range(n - 4)]
    twice = {w for w, c in Counter(windows).items() if c > 1}
    repeated = len({i + k for i, w in enumerate(windows) if w in twice for k in range(5)})
    lines = [x for x in (text or "").split("\n") if bag(x)]
    chars, symbols, dup = sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines))
    return not (n < 10 or 100 * repeated > 20 * n or 10 * symbols > 3 * n or chars > 25 * n or chars < 2 * n or (dup > 20 and 10 * dup > n))


def test_stages_against_brute_force(spark, tmp_path):
    """Each stage of the pipeline on a small corpus against plain Python, given what its predecessor kept."""
    r = random.Random(21)
    vocabulary = [f"{w}{i}" for w in WORDS for i in range(40)]
    prose = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    texts = [None, "", "too few words here", "spam " * 60, "# $ % & " * 10 + prose(12), prose(30) + "\n" + prose(30)]
    for _ in range(60):
        texts.append("\n".join(prose(r.randint(8, 20)) for _ in range(r.randint(1, 5))))
    shared = prose(14)
    for _ in range(30):
        base = r.choice(texts[6:66])
        kind = r.random()
        if kind < 0.3:
            texts.append(base)
        elif kind < 0.6:
            w = base.split(" ")
            w[r.randrange(len(w))] = "changed"
            texts.append(" ".join(w))
        else:
            texts.append(prose(15) + "\n" + shared + "\n" + prose(18))
    columns = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    rows = [(i, t, "en", r.choice(["a", "b", "hot", "hot"]), len(t or "")) for i, t in enumerate(texts)]
    docs, got = spark.createDataFrame(rows, columns), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = materialize(stage(spark, docs, "/nowhere"), f"b{k}")
        got.append(docs.collect())
    good, lines, single, mixed, tokens = got
    assert {x.doc_id for x in good} == {i for i, t in enumerate(texts) if python_quality(t)} and 0 < len(good) < len(texts)
    kept = [(x.doc_id, x.text) for x in good]
    gone = brute_lines(kept)
    want = {}
    for d, t in kept:
        parts = t.split("\n")
        left = [x for i, x in enumerate(parts) if (d, i) not in gone]
        if len(left) == len(parts) or any(bag(x) for x in left):
            want[d] = "\n".join(left)
    assert {x.doc_id: x.text for x in lines} == want and gone and all(x.n_chars == len(x.text) for x in lines)
    component, _ = brute_components(sorted(want.items()), 5, 80, 100)
    assert {x.doc_id for x in single} == {d for d in want if component[d] == d}
    sizes, taken = Counter(), Counter()
    for x in single:
        sizes[x.source] += len(bag(x.text))
    for x in mixed:
        taken[x.source] += len(bag(x.text))
    longest = max(len(bag(x.text)) for x in single)
    targets = brute_targets(sizes)
    assert all(abs(taken[s] - targets[s]) <= longest / 2 + 1 for s in sizes) and max(Counter(x.doc_id for x in mixed).values()) <= 3
    texts_of = {x.doc_id: x.text for x in single}
    assert all(x.text == texts_of[x.doc_id] for x in mixed)
    encoder = reference_encoder()
    assert Counter(x.doc_id for x in tokens) == Counter(x.doc_id for x in mixed)
    for x in tokens:
        assert list(x.ids) == encoder.encode_ordinary(texts_of[x.doc_id]) and x.decoded_sha256 == hashlib.sha256(texts_of[x.doc_id].encode()).hexdigest()


def test_run_leaves_no_scratch_but_its_result(spark, sf):
    before = made()
    out = corpus_pipeline.run(spark, sf)
    assert len(made()) == len(before) + 1 and out.count() > 0


def test_names():
    names = entry.queries()
    assert {f"op{n}" for n in range(1, 11)} == {x.split("_")[0] for x in names if x.startswith("op")} and "pipeline" in names


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_sql(spark, sf, name):
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for f in os.listdir(sf):
        c.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{sf}/{f}')")
    got = llm.queries()[name](spark, sf)
    want = c.sql(llm.oracle_sql()[name])
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    order = [list(want.columns).index(x) for x in columns]
    assert sorted((tuple(r) for r in got.select(*columns).collect()), key=str) == sorted((tuple(r[i] for i in order) for r in want.fetchall()), key=str)
