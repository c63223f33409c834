"""Rules against Python's re: boundaries of all letters, whole pages, several languages."""

import re

from pyspark.sql import functions as F

from lensmill import packages as P
from lensmill.functions import rules as R
from lensmill.operators.relate import max_cosine

TEXTS = [
    "décès de la reine", "indécès", "war", "déwar", "warß", "a war é", "naïve ai haï", "ai", "óbito", "Obituary: died aged 90, mourners mourning", "la guerre",
    "Ses obsèques", "Überlebende", "verstorben", "the theé éthe the", "She passed away; condolences. She died after a long illness", "cookie policy", "1ai2", "ai_x", "x.ai.",
]


def test_boundaries_know_all_letters(spark):
    patterns = (r"\bwar\b", r"\bai\b", r"\bthe\b", r"\bdécès\b", r"\bd[ée]c", r"\b(dies|died) (after|following)\b", *P.OBIT_SIGNAL)
    df = spark.createDataFrame([(i, t.lower()) for i, t in enumerate(TEXTS)], "id int, t string")
    cond = R.Count(patterns)
    got = {r.id: (r.n, r.m) for r in df.select("id", cond.number().alias("n"), R.Any(patterns).col().alias("m")).collect()}
    for i, t in enumerate(TEXTS):
        n = sum(len(re.findall(p, t.lower())) for p in patterns)
        assert got[i] == (n, n > 0), t


def test_the_sql_of_rules_has_the_same_boundaries():
    import duckdb

    for p in (r"\bwar\b", r"\bai\b", r"\bthe\b", r"\bdécès\b", r"\bd[ée]c", r"\b[óo]bito\b", r"\bobs[èe]ques\b"):
        for t in TEXTS:
            sql = f"SELECT len(regexp_extract_all({R.sql_text('t')}, {R._q(R.sql_pattern(p))})) FROM (SELECT {R._q(t.lower())} AS t)"
            assert duckdb.sql(sql).fetchall()[0][0] == len(re.findall(p, t.lower())), (p, t)


def python_junk(title, content):
    body = content or ""
    words = body.split()
    if len(body.strip()) < 25:
        return "empty_or_stub_content"
    if len(words) > 120:
        return None
    text = " ".join(x for x in (title, body) if x is not None).lower()
    strong = [p for p in P.STRONG_JUNK if re.search(p, text)]
    weak = [p for p in P.WEAK_JUNK if re.search(p, text)]
    if strong:
        return f"scrape_junk_strong:{strong[0]}"
    if len(weak) >= 2:
        return f"scrape_junk_weak:{len(weak)}:{weak[0]}"
    return f"scrape_junk_stub:{weak[0]}" if weak and len(words) <= 8 else None


def test_scrape_junk_reads_whole_pages(spark):
    pages = [(None, p) for p in P.JUNK_PAGES] + [("Title", None), ("", "   "), ("Enable JavaScript", "A body of no sign at all, but long enough."), ("x", "word " * 119 + "access denied"), ("x", "word " * 100 + "access denied page not found")]
    pages += [("x", "Abbonati per leggere l'articolo completo"), ("x", "Schakel JavaScript in om verder te gaan"), ("x", "Antes de continuar no Google, aceite"), ("x", "未找到页面" * 8)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pages)], "id int, title string, content string")
    got = {r.id: r.out for r in df.select("id", R.scrape_junk(F.col("title"), F.col("content"), P.STRONG_JUNK, P.WEAK_JUNK).alias("out")).collect()}
    assert got == {i: python_junk(*p) for i, p in enumerate(pages)} and len({str(x).split(":")[0] for x in got.values()}) == 5


def test_death_adjacent_is_multilingual(spark):
    want = {0: True, 8: True, 9: True, 10: False, 11: True, 12: False, 13: True, 15: True, 16: False}
    df = spark.createDataFrame([(i, TEXTS[i]) for i in want], "id int, t string")
    assert {r.id: r.m for r in df.select("id", F.col("t").rlike(P.DEATH_ADJACENT).alias("m")).collect()} == want


def test_max_cosine_in_blocks(spark):
    import numpy as np

    r = np.random.default_rng(3)
    v = r.normal(size=(60, 8))
    v /= np.linalg.norm(v, axis=1)[:, None]
    df = spark.createDataFrame([(i, [float(x) for x in v[i]]) for i in range(60)], "id bigint, v array<double>")
    sims = v @ v.T
    np.fill_diagonal(sims, -2)
    for rows, refs, want in ((df, df, sims.max(axis=1)), (df, df.filter("id < 7"), sims[:, :7].max(axis=1))):
        got = {x.id: x.sim for x in max_cosine(rows, refs, "id", "v", block_vectors=9).collect()}
        assert got.keys() == set(range(60)) and all(abs(got[i] - want[i]) < 1e-9 for i in range(60))
    assert {x.sim for x in max_cosine(df, df.filter("false"), "id", "v").collect()} == {None}
    assert max_cosine(df.filter("id = 1"), df.filter("id = 1"), "id", "v").collect()[0].sim is None


def test_required_literals_are_in_every_match():
    want = {
        r"\bquarterly earnings\b": "quarterly earnings", r"\bforests?\b": "forest", r"\blaunch(?:es|ed)\b": "launch", r"a|b": None, r"\d+ percent\b": " percent", r"(?i)abc": None, r"\bunder \$\d+": "under $",
        r"\bto{2,3}day\b": "day", r"[^.]{0,40}forbidden": "forbidden", r"\bgo+al\b": "go", r"\bai\b": None, r"x(y|z)+word": "word", r"\beco-?friendly\b": "friendly", r"(?:one|three) (?:abcd|efgh)": ("abcd", "efgh"), r"\b(abc|def)?x": None, r"(ab|cde)": None,
    }
    for p, literal in want.items():
        got = R.required(p)
        want_ = (literal,) if isinstance(literal, str) else literal
        assert got == (want_ if want_ and all(len(x) > 2 for x in want_) else None), (p, got)
    for group in vars(P).values():
        if isinstance(group, tuple) and group and all(isinstance(x, str) for x in group):
            for p in group:
                word = R.required(p)
                for t in (*TEXTS, *P.TOPICS, *P.JUNK_PAGES):
                    for m in re.finditer(p, t.lower()) if word and "\\p" not in p else ():
                        assert any(w in m[0] for w in word), (p, word, m[0])
