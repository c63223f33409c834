"""Declarative rules: conditions are data that render as a Spark Column and as SQL; a rule set is an ordered list of
(condition, reason) whose first match gives the reason. All of it stays inside whole-stage code generation: patterns are
literals, compiled once per task, and later rules are not evaluated once one has matched."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


#: A letter or digit beyond ASCII. The SQL engine's \\b, \\w and \\s know ASCII only.
_BEYOND = r"[^\x00-\x7F\p{P}\p{S}\p{Z}\p{C}\p{M}]"


def spark_pattern(p: str) -> str:
    """Boundaries and classes know all letters, whatever the Java version."""
    return f"(?U){p}"


def sql_text(on: str) -> str:
    """``on`` with an underline on either side of each letter beyond ASCII: to \\b of ASCII such a letter is in a word."""
    return f"regexp_replace({on}, '({_BEYOND})', '_\\1_', 'g')"


def sql_pattern(p: str) -> str:
    """A pattern for ``sql_text``; classes that name letters beyond ASCII become alternatives."""
    import re

    own = lambda c: c if c.isascii() or not c.isalnum() else f"(?:_{c}_)"
    out = re.sub(r"\[([^\]\\^-]*)\]", lambda m: m[0] if m[1].isascii() else "(?:" + "|".join(map(own, m[1])) + ")", p)
    return re.sub(r"(?<!_)[^\x00-\x7F](?!_)", lambda m: own(m[0]), out)


def required(p: str) -> tuple[str, ...] | None:
    """Literals of which every match of a pattern holds one: the longest run of the pattern, or else the alternatives of
    a group of words; None if neither is plain to see."""
    import re

    runs, run, i, depth, groups = [], "", 0, 0, []
    while i < len(p):
        c, step = p[i], 1
        literal = None
        if c == "\\":
            step = 2
            literal = p[i + 1] if i + 1 < len(p) and not p[i + 1].isalnum() else None
            if p[i : i + 2] == r"\b":  # a boundary has no width
                i += 2
                continue
        elif c == "(":
            depth, step = 1, 1
            while i + step < len(p) and depth:
                if p[i + step] == "\\":
                    step += 1
                else:
                    depth += {"(": 1, ")": -1}.get(p[i + step], 0)
                step += 1
            group = re.fullmatch(r"\((?:\?:)?([a-z '-]{3,}(?:\|[a-z '-]{3,})*)\)", p[i : i + step])
            if group and p[i + step : i + step + 1] not in ("?", "*", "{"):
                groups.append(tuple(group[1].split("|")))
        elif c == "[":
            step = p.find("]", i + 2) - i + 1
            if step <= 0:
                return None
        elif c == "|":
            return None
        elif c in "?*{":
            runs.append(run[:-1])
            run, i = "", (p.find("}", i) if c == "{" else i) + 1
            continue
        elif c not in ".^$+":
            literal = c
        if literal is None:
            runs.append(run)
            run = ""
        else:
            run += literal
        i += step
    best = max([*runs, run], key=len)
    if p.startswith("(?") and not p.startswith("(?:"):
        return None
    return (best,) if len(best) > 2 else max(groups, key=lambda g: min(map(len, g)), default=None)


def may_match(on: str, patterns: tuple[str, ...]) -> Column | None:
    """Whether a text holds a literal that some pattern needs: far cheaper than the patterns. None if a pattern has none."""
    found = [required(p) for p in patterns]
    if on not in LOWER or any(f is None for f in found):
        return None
    words = [w for f in found for w in f]
    if any(w != w.lower() for w in words):
        return None
    return reduce(lambda a, b: a | b, (F.contains(F.col(on), F.lit(w)) for w in dict.fromkeys(words)))


#: Columns that hold lower-case text by agreement.
LOWER = ("t", "title_lower")


class Cond:
    def col(self) -> Column:
        raise NotImplementedError

    def sql(self) -> str:
        raise NotImplementedError

    def __and__(self, other: Cond) -> Cond:
        return Both((self, other), "AND")

    def __or__(self, other: Cond) -> Cond:
        return Both((self, other), "OR")

    def __invert__(self) -> Cond:
        return Not(self)


@dataclass(frozen=True)
class Both(Cond):
    parts: tuple[Cond, ...]
    how: str

    def col(self) -> Column:
        return reduce((lambda a, b: a & b) if self.how == "AND" else (lambda a, b: a | b), (p.col() for p in self.parts))

    def sql(self) -> str:
        return "(" + f" {self.how} ".join(p.sql() for p in self.parts) + ")"


@dataclass(frozen=True)
class Not(Cond):
    part: Cond

    def col(self) -> Column:
        return ~self.part.col()

    def sql(self) -> str:
        return f"NOT ({self.part.sql()})"


@dataclass(frozen=True)
class Any(Cond):
    """Some pattern matches ``on``."""

    patterns: tuple[str, ...]
    on: str = "t"

    def col(self) -> Column:
        hit = F.col(self.on).rlike(spark_pattern("|".join(f"(?:{p})" for p in self.patterns)))
        some = may_match(self.on, self.patterns)
        return hit if some is None else some & hit

    def sql(self) -> str:
        return f"regexp_matches({sql_text(self.on)}, {_q('|'.join(f'(?:{sql_pattern(p)})' for p in self.patterns))})"


@dataclass(frozen=True)
class Count(Cond):
    """All matches of all patterns number at least ``least`` (and at most ``most``). Patterns are never merged: overlaps count."""

    patterns: tuple[str, ...]
    least: int = 0
    most: int | None = None
    on: str = "t"

    def number(self) -> Column:
        def one(p: str) -> Column:
            n, some = F.regexp_count(F.col(self.on), F.lit(spark_pattern(p))), may_match(self.on, (p,))
            return n if some is None else F.when(some, n).when(F.col(self.on).isNotNull(), 0)

        return reduce(lambda a, b: a + b, map(one, self.patterns))

    def number_sql(self) -> str:
        return "(" + " + ".join(f"len(regexp_extract_all({sql_text(self.on)}, {_q(sql_pattern(p))}))" for p in self.patterns) + ")"

    def col(self) -> Column:
        n = self.number()
        return n >= self.least if self.most is None else (n >= self.least) & (n <= self.most)

    def sql(self) -> str:
        n = self.number_sql()
        return f"({n} >= {self.least}" + (f" AND {n} <= {self.most})" if self.most is not None else ")")


@dataclass(frozen=True)
class Groups(Cond):
    """At least ``least`` of the pattern groups match."""

    groups: tuple[tuple[str, ...], ...]
    least: int
    on: str = "t"

    def col(self) -> Column:
        return reduce(lambda a, b: a + b, (Any(g, self.on).col().cast("int") for g in self.groups)) >= self.least

    def sql(self) -> str:
        return "(" + " + ".join(f"CAST({Any(g, self.on).sql()} AS INTEGER)" for g in self.groups) + f") >= {self.least}"


@dataclass(frozen=True)
class Keyword(Cond):
    """Some substring occurs in ``on``, which is lower-cased unless ``case`` or lower-cased already (``LOWER``)."""

    words: tuple[str, ...]
    on: str = "t"
    case: bool = False

    def col(self) -> Column:
        c = F.col(self.on) if self.case or self.on in LOWER else F.lower(F.col(self.on))
        return reduce(lambda a, b: a | b, (F.contains(c, F.lit(w)) for w in self.words))

    def sql(self) -> str:
        c = self.on if self.case or self.on in LOWER else f"lower({self.on})"
        return "(" + " OR ".join(f"contains({c}, {_q(w)})" for w in self.words) + ")"


@dataclass(frozen=True)
class Raw(Cond):
    """Anything that both engines read alike."""

    text: str

    def col(self) -> Column:
        return F.expr(self.text)

    def sql(self) -> str:
        return f"({self.text})"


@dataclass(frozen=True)
class Rule:
    when: Cond
    reason: str | None  # None: passes here


@dataclass(frozen=True)
class Category:
    """A block with what overrides it: exceptions, a count of positive matches, keywords, or a floor of both."""

    name: str
    patterns: tuple[str, ...]
    exceptions: tuple[str, ...] = ()
    positive_at: int | None = None
    keywords: tuple[str, ...] = ()
    floor: Cond | None = None  # replaces exceptions and counts: the category is skipped only if this holds


@dataclass(frozen=True)
class Package:
    name: str
    version: int
    rules: tuple[Rule, ...] = ()
    categories: tuple[Category, ...] = ()
    positive: tuple[str, ...] = ()
    override: Cond | None = None
    before: tuple[Rule, ...] = field(default=())
    after: tuple[Rule, ...] = field(default=())
    domains: tuple[tuple[str, str], ...] = ()
    min_length: int | None = 300
    validate: bool = True

    def skips(self, c: Category) -> Cond | None:
        """What lets a row through category ``c``."""
        if c.floor is not None:
            return c.floor
        parts: list[Cond] = []
        if c.exceptions:
            parts.append(Any(c.exceptions))
        if c.keywords:
            parts.append(Keyword(c.keywords))
        if c.positive_at and self.positive:
            parts.append(Count(self.positive, c.positive_at))
        if self.override is not None:
            parts.append(self.override)
        return reduce(lambda a, b: a | b, parts) if parts else None

    def ordered(self) -> list[Rule]:
        out: list[Rule] = []
        if self.validate:
            out += [Rule(Raw("title IS NULL"), "missing_title"), Rule(Raw("trim(title) = ''"), "empty_title"), Rule(Raw("content IS NULL"), "missing_content"), Rule(Raw("trim(content) = ''"), "empty_content")]
        if self.min_length:
            out.append(Rule(Raw(f"length(coalesce(content, '')) < {self.min_length}"), "content_too_short"))
        out += [Rule(Keyword((d,), on="url"), f"excluded_domain_{r}") for d, r in self.domains]
        out += self.before
        for c in self.categories:
            blocked: Cond = Any(c.patterns)
            skip = self.skips(c)
            out.append(Rule(blocked if skip is None else blocked & ~skip, f"excluded_{c.name}"))
        return [*out, *self.rules, *self.after]


def reason(rules: list[Rule]) -> Column:
    """The first matching rule's reason; null where no rule matches or the first that does lets the row pass."""
    out: Column | None = None
    for r in rules:
        value = F.lit(r.reason) if r.reason is not None else F.lit(None).cast("string")
        hit = F.coalesce(r.when.col(), F.lit(False))
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out.otherwise(F.lit(None).cast("string")) if out is not None else F.lit(None).cast("string")


def reason_sql(rules: list[Rule]) -> str:
    whens = " ".join(f"WHEN coalesce({r.when.sql()}, false) THEN {_q(r.reason) if r.reason is not None else 'NULL'}" for r in rules)
    return f"CASE {whens} END" if whens else "CAST(NULL AS VARCHAR)"


def apply_package(df: DataFrame, p: Package, text: Callable[[], Column] | None = None) -> DataFrame:
    """Adds passed_prefilter and prefilter_reason. ``df``: title, content, url and ``t``, the lower-cased text (or ``text``)."""
    made = df.withColumn("t", text()) if text else df
    return made.withColumn("prefilter_reason", reason(p.ordered())).withColumn("passed_prefilter", F.col("prefilter_reason").isNull())


def package_sql(p: Package) -> str:
    return reason_sql(p.ordered())


def scrape_junk(title: Column, content: Column, strong: tuple[str, ...], weak: tuple[str, ...], max_words: int = 120, stub_words: int = 8) -> Column:
    """Why a scraped page is no article, or null. Judged on the whole of it.

    Under 25 characters of content: empty. Over ``max_words`` words: never junk. Else any strong sign, two weak ones, or
    one weak sign in a stub.
    """
    body = F.coalesce(content, F.lit(""))
    words = F.size(F.filter(F.split(body, r"(?U)\s+"), lambda w: w != ""))
    text = F.lower(F.concat_ws(" ", title, body))
    first = lambda ps: F.get(F.filter(F.array(*(F.when(text.rlike(spark_pattern(p)), F.lit(p)) for p in ps)), lambda p: p.isNotNull()), F.lit(0))
    hits = reduce(lambda a, b: a + b, (text.rlike(spark_pattern(p)).cast("int") for p in weak))
    return (
        F.when(F.length(F.regexp_replace(body, r"(?U)^\s+|\s+$", "")) < 25, "empty_or_stub_content")
        .when(words > max_words, F.lit(None).cast("string"))
        .when(first(strong).isNotNull(), F.concat(F.lit("scrape_junk_strong:"), first(strong)))
        .when(hits >= 2, F.concat(F.lit("scrape_junk_weak:"), hits.cast("string"), F.lit(":"), first(weak)))
        .when((hits == 1) & (words <= stub_words), F.concat(F.lit("scrape_junk_stub:"), first(weak)))
    )


def statistics(p: Package) -> dict[str, int]:
    """How many patterns and exceptions a package has."""
    return {"categories": len(p.categories), "patterns": sum(len(c.patterns) for c in p.categories), "exceptions": sum(len(c.exceptions) for c in p.categories), "positive": len(p.positive)}
