"""What the queries without SQL must give, computed in Python from the tables: a function of (rows, table) for each."""

import hashlib
import html
import re

import numpy as np

from lensmill import packages as P
from lensmill.functions import rules as R
from lensmill.plans.q_vectors import ZERO_SHOT

SPACES = re.compile(r" {2,}")


def strip(s):
    return re.sub(r"^\s+|\s+$", "", s, flags=re.ASCII)


def cleaned(s):
    """The full cleaner: entities, tags, left-over entities, invisible marks, white space."""
    if s is None:
        return None
    s = re.sub("<[^>]+>", "", html.unescape(s))
    s = re.sub("&#[0-9]+;", " ", re.sub("&[a-zA-Z]+;", " ", s))
    s = re.sub("[\u200b\u200c\u200d\ufeff\u2060\u00ad\u200e\u200f\u202a-\u202e\u2066-\u2069]", "", s)
    s = re.sub("\n{3,}", "\n\n", SPACES.sub(" ", s.replace("\t", " ")))
    return strip("\n".join(map(strip, s.split("\n"))))


def scores(t):
    e = t("embeddings")
    v = np.stack(e.embedding).astype(float)
    clamp = lambda x: np.clip(x, 0, 10)
    s = clamp(5 + 16 * v[:, :6])
    o = clamp(5 + 16 * v[:, :6] + 4 * v[:, 6:12])
    return e.vec_id.to_numpy(), v, s, o


def layers():
    r = np.random.default_rng(0)
    return [(r.normal(size=s) / 8, r.normal(size=s[1]) / 8) for s in ((64, 32), (32, 16), (16, 6))]


def forward(v):
    for i, (w, b) in enumerate(layers()):
        v = v @ w + b
        if i < 2:
            v = np.maximum(v, 0)
    return v


def by_id(got, column, key="id"):
    return dict(zip(got[key], got[column], strict=True))


def html_entities(got, t):
    assert by_id(got, "out", "page_id") == {p: html.unescape(h) for p, h in zip(t("pages").page_id, t("pages").html, strict=True)}


def clean_struct(got, t):
    p = t("pages")
    assert by_id(got, "body", "page_id") == {i: cleaned(h) for i, h in zip(p.page_id, p.html, strict=True)}
    assert by_id(got, "url", "page_id") == {i: cleaned(u) for i, u in zip(p.page_id, p.url, strict=True)} and (got.n == got.page_id).all()


def clean_labeling(got, t):
    p = t("pages")
    assert by_id(got, "body", "page_id") == {i: cleaned(h) for i, h in zip(p.page_id, p.html, strict=True)}


def json_repair(got, t):
    import json

    out = by_id(got, "out")
    assert len(out) == len(t("documents")) and all(json.loads(v) == {"a": "c:\\d", "n": [i]} for i, v in out.items())


def topical(t):
    """(id, url, title, content) as the rule queries see articles."""
    d = t("documents")
    for i, text, source in zip(d.doc_id, d.text, d.source, strict=True):
        title = None if i % 41 == 0 else "  " if i % 43 == 0 else ("RIP " if i % 47 == 0 else "") + text.split(".")[0]
        content = None if i % 53 == 0 else "   " if i % 59 == 0 else P.TOPICS[i % len(P.TOPICS)] + " " + text
        yield i, f"https://{source}.example/{i}", title, content


def death(got, t):
    import regex

    want = {i: bool(regex.search(P.DEATH_ADJACENT.replace("(?iu)", "(?i)"), f"{title or ''} {content or ''}")) for i, _, title, content in topical(t)}
    assert by_id(got, "out") == want and 0 < sum(want.values()) < len(want)


def package(p):
    def holds(c, row):
        if isinstance(c, R.Both):
            parts = [holds(x, row) for x in c.parts]
            return all(parts) if c.how == "AND" else any(parts)
        if isinstance(c, R.Not):
            return not holds(c.part, row)
        if isinstance(c, R.Any):
            return any(re.search(x, row[c.on] or "") for x in c.patterns)
        if isinstance(c, R.Count):
            return sum(len(re.findall(x, row[c.on])) for x in c.patterns) >= c.least
        if isinstance(c, R.Keyword):
            return any(w in row[c.on].lower() for w in c.words)
        raise TypeError(c)

    def verdict(row):
        title, content = row["title"], row["content"]
        if p.validate:
            for name, v in (("title", title), ("content", content)):
                if v is None:
                    return f"missing_{name}"
                if v.strip(" ") == "":
                    return f"empty_{name}"
        if p.min_length and len(content or "") < p.min_length:
            return "content_too_short"
        for r in p.ordered():
            if not isinstance(r.when, R.Raw) and holds(r.when, row):
                return r.reason
        return None

    def check(got, t):
        want = {}
        for i, url, title, content in topical(t):
            text = " ".join(x for x in (title, content and content[:2000]) if x is not None).lower()
            want[i] = verdict({"t": text, "url": url, "title": title, "content": content, "title_lower": title and title.lower()})
        have = {i: r if isinstance(r, str) else None for i, r in by_id(got, "prefilter_reason").items()}
        assert have == want and len(set(want.values())) > 1
        assert all(got.passed_prefilter == got.prefilter_reason.isna())

    return check


def calib_fit(got, t):
    """Pool adjacent violators of oracle on student: rising breakpoints whose fit is the isotonic one."""
    _, _, s, o = scores(t)
    for dim, g in got.groupby("dim"):
        g = g.sort_values("k")
        assert (np.diff(g.x) > 0).all() and (np.diff(g.y) >= -1e-9).all()
        order = np.lexsort((s[:, dim], s[:, dim]))
        x, y = s[order, dim], o[order, dim]
        xs, inverse = np.unique(x, return_inverse=True)
        blocks = [[np.bincount(inverse, y)[k] / n, n, 1] for k, n in enumerate(np.bincount(inverse))]
        out = []
        for m, n, c in blocks:
            out.append([m, n, c])
            while len(out) > 1 and out[-2][0] >= out[-1][0]:
                b, a = out.pop(), out.pop()
                out.append([(a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1]), a[1] + b[1], a[2] + b[2]])
        fit = np.concatenate([[m] * c for m, _, c in out])
        assert np.abs(np.interp(xs, g.x, g.y) - fit).mean() < 0.05


def top2_norm(got, t):
    ids, v, _, _ = scores(t)
    for doc, g in got.groupby("doc"):
        rows = v[ids // 4 == doc].astype(float)
        norms = np.linalg.norm(rows, axis=1)
        top = sorted(range(len(rows)), key=lambda i: (-norms[i], i))
        want = [np.concatenate((rows[a], rows[b])) for a in top for b in top if a != b or len(rows) == 1]
        have = g.sort_values("pos").v.to_numpy()
        # unit vectors tie but for the last digits, so any two of the largest norms will do
        assert any(np.abs(have - w).max() < 1e-4 for w in want)


def mlp(got, t):
    ids, v, _, _ = scores(t)
    want = dict(zip(ids, forward(v)[:, 0], strict=True))
    assert got.id.nunique() == len(want) and all(abs(y - want[i]) < 1e-4 for i, y in by_id(got, "y0").items())


def topk_probe(got, t):
    ids, v, _, _ = scores(t)
    p = 1 / (1 + np.exp(-forward(v)[:, 0]))
    assert np.allclose(sorted(got.p, reverse=True), sorted(p, reverse=True)[:20], atol=1e-5) and set(got.id) <= set(ids)


def pca(got, t):
    _, _, _, o = scores(t)
    e = np.sort(np.linalg.eigvalsh(np.corrcoef(o.T)))[::-1]
    g = got.sort_values("component")
    assert np.allclose(g.share, e / e.sum(), atol=1e-6) and np.allclose(g.cumulative, np.cumsum(e / e.sum()), atol=1e-6) and set(g.for_95) == {int(np.searchsorted(np.cumsum(e / e.sum()), 0.95) + 1)}


def probe(got, t):
    ids, v, _, o = scores(t)
    y = o @ np.array((0.25, 0.20, 0.20, 0.15, 0.10, 0.10))
    held = ids % 5 == 0
    assert got.n[0] == held.sum() and got.mae[0] < np.abs(y[held] - y[~held].mean()).mean()


def stub(text, dims=6):
    return [hashlib.md5(f"{i}{text}".encode()).digest()[0] / 25.5 for i in range(dims)]


def udf_score(got, t):
    d = t("documents")
    want = {i: stub(x)[0] for i, x in zip(d.doc_id, d.text, strict=True)}
    assert set(got.dims) == {6} and all(abs(s - want[i]) < 1e-5 for i, s in by_id(got, "s0").items()) and len(got) == len(want)


def udf_commerce(got, t):
    d = t("documents")
    assert by_id(got, "commerce") == {i: stub(x, 1)[0] / 10 >= 0.95 for i, x in zip(d.doc_id, d.text, strict=True)}


def udf_screen(got, t):
    ids, v, _, _ = scores(t)
    y = dict(zip(ids, np.round(forward(v)[:, 0], 6), strict=True))
    assert by_id(got, "stage_used") == {i: "stage2" if s >= 0 else "stage1_low" for i, s in y.items()}


def oracle_stub(got, t):
    for i, answer, attempts, error in zip(got.id, got.answer, got.attempts, got.error, strict=True):
        assert (answer, attempts, error) == ((None, 3, "timed out") if str(i).endswith("3") else ('{"score": 5}', 1, None))
    assert len(got) == len(t("documents"))


def newest(got, t):
    """Two files of three, with a third of the rows each, whichever names they got."""
    n = len(t("documents"))
    assert len(got) == 2 and set(got.n) <= {n // 3, n // 3 + 1}


def zero_shot(got, t):
    labels, d = ZERO_SHOT, t("documents")
    want = {}
    for i, x in zip(d.doc_id, d.text, strict=True):
        s = [v / 10 for v in stub(f"{(x or '').split('.')[0]} {x or ''}".lower(), len(labels))]
        top = s.index(max(s))
        want[i] = "passed_semantic" if top == 0 and s[0] >= 0.35 else "blocked_category:" + labels[top].split(",")[0].split(" ")[0]
    assert by_id(got, "reason") == want and by_id(got, "passed") == {i: r == "passed_semantic" for i, r in want.items()}
    assert len(set(want.values())) >= 3


CHECKS = {
    "text_html_entities": html_entities, "text_clean_struct": clean_struct, "text_clean_labeling": clean_labeling, "json_repair": json_repair, "pred_death_adjacent": death,
    "pkg_sustech": package(P.SUSTECH), "pkg_econ_viability": package(P.ECON_VIABILITY), "calib_fit": calib_fit, "vec_pooling_top2_norm": top2_norm, "vec_mlp_forward": mlp, "topk_probe": topk_probe,
    "vec_pca": pca, "ml_probe_train": probe, "udf_score": udf_score, "udf_commerce": udf_commerce, "prefilter_zero_shot": zero_shot, "udf_screen": udf_screen, "udf_oracle_stub": oracle_stub, "scan_newest_files": newest,
}
