"""Operator 9: rule bitmask ledger.

Every rule is evaluated once for a document and leaves one bit (1: failed) in ``fail_bits``, beside the measurements it
used. A policy is a named bit mask with a version: applying one, comparing two, or removing a rule from one is bit
arithmetic on the ledger and never reads a text again.

Everything here is DataFrame expressions. A text is split once; its words are bound by ``let`` so that they are not
split again for each use. The costly measurement (words in repeated 5-word windows) first compares the count of
distinct window hashes with the count of windows, and only documents with a repeated window pay for positions.

Defined results: a null or blank text has no words, all measurements 0, and fails ``few_words``. Repeated doc_ids are
independent rows. Other columns of the input are not touched by ``ledger`` and may have any name, as measurements live
in one struct column until they are selected: ``_ledger``, with lines appended while that name is used.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lensmill.llm.common import fresh, let, text_or_empty, words_of

WINDOW = 5
SYMBOLS = r"[#*$%&|<>]"


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words that lie in a window of ``window`` words found at least twice in the text."""
    size = F.size(words)
    hashes = F.when(
        size >= window,
        F.transform(F.sequence(F.lit(1), size - (window - 1)), lambda i: F.xxhash64(F.slice(words, i, window))),
    ).otherwise(F.array().cast("array<bigint>"))

    def covered(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def starts(p: Column) -> Column:
            twin = lambda x, j: (F.get(p, j - 1)["h"] == x["h"]) | (F.get(p, j + 1)["h"] == x["h"])
            return F.sort_array(F.transform(F.filter(p, lambda x, j: F.coalesce(twin(x, j), F.lit(False))), lambda x: x["i"]))

        total = lambda s: F.aggregate(
            s,
            F.struct(F.lit(-window).alias("last"), F.lit(0).cast("bigint").alias("n")),
            lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(window), i - a["last"])).alias("n")),
            lambda a: a["n"],
        )
        return let(let(pairs, starts), total)

    return let(hashes, lambda h: F.when(F.size(h) == F.size(F.array_distinct(h)), F.lit(0).cast("bigint")).otherwise(covered(h)))


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line of the text."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("bigint"))


def measurements(text: Column) -> Column:
    """A struct of n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words."""
    t = text_or_empty(text)

    def of(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("bigint").alias("n_words"),
            F.char_length(F.array_join(words, "")).cast("bigint").alias("word_chars"),
            repeated_words(words).alias("n_repeat_words"),
        )

    base = let(words_of(text), of)
    return let(
        base,
        lambda b: F.struct(
            b["n_words"].alias("n_words"),
            b["word_chars"].alias("word_chars"),
            F.regexp_count(t, F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
            duplicate_lines(t).alias("n_dup_lines"),
            b["n_repeat_words"].alias("n_repeat_words"),
        ),
    )


@dataclass(frozen=True)
class Rule:
    """``fails`` takes the struct of measurements; the rule owns bit ``bit`` for ever, whatever the policies do."""

    bit: int
    name: str
    fails: Callable[[Column], Column]

    @property
    def mask(self) -> int:
        return 1 << self.bit


#: All comparisons are between whole numbers, so that no rounding decides a verdict.
RULES = (
    Rule(0, "few_words", lambda m: m["n_words"] < 10),
    Rule(1, "repeated_windows", lambda m: 100 * m["n_repeat_words"] > 20 * m["n_words"]),
    Rule(2, "symbols", lambda m: 10 * m["n_symbols"] > 3 * m["n_words"]),
    Rule(3, "long_words", lambda m: m["word_chars"] > 25 * m["n_words"]),
    Rule(4, "short_words", lambda m: m["word_chars"] < 2 * m["n_words"]),
    Rule(5, "duplicate_lines", lambda m: (m["n_dup_lines"] > 20) & (10 * m["n_dup_lines"] > m["n_words"])),
)
BASE = ("few_words", "repeated_windows")


@dataclass(frozen=True)
class Policy:
    name: str
    version: int
    rules: tuple[str, ...]

    def mask(self, rules: tuple[Rule, ...] = RULES) -> int:
        by_name = {r.name: r.mask for r in rules}
        return sum(by_name[n] for n in dict.fromkeys(self.rules))


POLICIES = (
    Policy("base", 1, BASE),
    Policy("prose", 1, (*BASE, "symbols")),
    Policy("prose", 2, (*BASE, "symbols", "long_words", "short_words", "duplicate_lines")),
)
CURRENT = POLICIES[-1]


def fail_bits(m: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Every rule once. ``m``: the struct of measurements, already bound."""
    out = F.lit(0).cast("bigint")
    for r in rules:
        out = out.bitwiseOR(F.when(r.fails(m), F.lit(r.mask).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
    return out


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def ledger(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with the struct column ``_ledger``: the measurements and ``fail_bits``."""
    filled = let(
        measurements(F.col(text)),
        lambda m: F.struct(*(m[n].alias(n) for n in MEASURES), fail_bits(m, rules).alias("fail_bits")),
    )
    return docs.withColumn(fresh(docs.columns, "_ledger"), filled)


def passes(bits: Column, policy: Policy, rules: tuple[Rule, ...] = RULES) -> Column:
    return bits.bitwiseAND(F.lit(policy.mask(rules)).cast("bigint")) == 0


def ablation(bits: DataFrame, policy: Policy = CURRENT, column: str = "fail_bits", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """For each rule of the policy: documents that fail it, and those that only it rejects (they would be kept without it).

    First the ledger is counted by its distinct bit patterns (at most two to the number of rules), then each rule reads
    the patterns: one shuffle of a few rows, whatever the corpus.
    """
    mask = policy.mask(rules)
    patterns = bits.groupBy(F.col(column).bitwiseAND(F.lit(mask).cast("bigint")).alias("bits")).agg(F.count("*").alias("n"))
    chosen = [r for r in rules if r.name in policy.rules]
    entries = F.array(*(F.struct(F.lit(r.name).alias("rule"), F.lit(r.mask).cast("bigint").alias("mask")) for r in chosen))
    return (
        patterns.select("bits", "n", F.explode(entries).alias("r"))
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.mask")) != 0, F.col("n")).otherwise(0)).alias("failed"),
            F.sum(F.when(F.col("bits") == F.col("r.mask"), F.col("n")).otherwise(0)).alias("failed_alone"),
            F.sum("n").alias("documents"),
        )
    )


def judge(docs: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """One row per document: measurements, fail_bits, base_failed, and the verdict ``kept`` of ``policy``."""
    base = Policy("base", 1, BASE)
    bits = F.col("_ledger.fail_bits")
    return ledger(docs.select("doc_id", "text")).select(
        "doc_id",
        *(F.col(f"_ledger.{n}").alias(n) for n in MEASURES),
        bits.alias("fail_bits"),
        (~passes(bits, base)).alias("base_failed"),
        (passes(bits, base) & passes(bits, policy)).alias("kept"),
    )


def keep(docs: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """Pipeline form: the documents that the policy keeps, with their columns as they were."""
    own = fresh(docs.columns, "_ledger")
    return ledger(docs).filter(passes(F.col(own)["fail_bits"], policy)).drop(own)


def query(spark, sf_dir: str) -> DataFrame:
    from lensmill.llm.common import table

    return judge(table(spark, sf_dir, "documents"))


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d
), win AS (
  SELECT rid, i, array_to_string(words[i:i + 4], chr(1)) AS win
  FROM (SELECT rid, words, unnest(range(1, len(words) - 3)) AS i FROM w WHERE len(words) >= 5)
), twice AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS c FROM win) WHERE c > 1
), rep AS (
  SELECT rid, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest([0, 1, 2, 3, 4]) AS k) GROUP BY rid
), m AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN rep USING (rid)
), b AS (
  SELECT *, CAST((CASE WHEN n_words < 10 THEN 1 ELSE 0 END)
    + (CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END)
    + (CASE WHEN 10 * n_symbols > 3 * n_words THEN 4 ELSE 0 END)
    + (CASE WHEN word_chars > 25 * n_words THEN 8 ELSE 0 END)
    + (CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END)
    + (CASE WHEN n_dup_lines > 20 AND 10 * n_dup_lines > n_words THEN 32 ELSE 0 END) AS BIGINT) AS fail_bits
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, fail_bits,
       (fail_bits & 3) <> 0 AS base_failed, (fail_bits & 63) = 0 AS kept
FROM b
"""
