"""Operator 6: URL filter with a Bloom filter cascade.

Level 1 is a Bloom filter of the listed keys. Asked about every key of the corpus's complete key universe it gives no
false negatives and some false positives; level 2 encodes exactly those false positives, level 3 the listed keys that
level 2 wrongly claims, and so on until a level makes no mistake. Walking the levels until one says no gives exact
membership for every key of the universe: no at an odd level means not listed, no at an even level means listed.

A level is one row of 64-bit words; it is built by or-ing bits per word (partial aggregation, at most ``MAX_BITS``
bits whatever the input) and read as a scalar subquery, a constant of the scan. Judging is therefore one pass over the
pages, with no join and no shuffle. Lists whose first level would need more than ``MAX_BITS`` are cut into shards by
key hash: a shard's cascade is built from its keys alone, and the pages are judged shard by shard.

Defined results: a url that is null or has no ``://`` has empty host and path, fits no rule and is judged by the
cascade like any other key; repeated rows get equal verdicts; an empty list or an empty table gives no level and
everything is allowed.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lensmill.llm.common import materialize

MAX_BITS = 1 << 26
BITS_PER_KEY = 8
HASHES = 4
MAX_LEVELS = 64

#: (verdict, host, path)
RULES = (
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """(the longest rule that fits, else null; its verdict, else null). Equal lengths: the longer host, then order."""
    rule = verdict = F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), len(r[1]))):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def _bit(key: Column, level: int, k: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(level), F.lit(k), key), F.lit(bits).cast("bigint"))


def _level(keys: DataFrame, level: int, count: int) -> tuple[DataFrame, int]:
    """One row (words) with the Bloom filter of ``keys`` (column key), and its number of bits."""
    bits = 64 * max(1, min(MAX_BITS, count * BITS_PER_KEY) // 64)
    spots = keys.select(F.explode(F.array(*(_bit(F.col("key"), level, k, bits) for k in range(HASHES)))).alias("b"))
    one = F.expr("shiftleft(1L, cast(b % 64 as int))")
    words = spots.groupBy(F.floor(F.col("b") / 64).cast("bigint").alias("w")).agg(F.bit_or(one).alias("bits"))
    blank = keys.sparkSession.range(bits // 64).select(F.col("id").alias("w"), F.lit(0).cast("bigint").alias("bits"))
    dense = words.unionByName(blank).groupBy("w").agg(F.bit_or("bits").alias("bits"))
    row = dense.agg(F.transform(F.array_sort(F.collect_list(F.struct("w", "bits"))), lambda x: x["bits"]).alias("words"))
    return materialize(row, "bloom"), bits


def _claims(key: Column, words: Column, level: int, bits: int) -> Column:
    def probe(ws: Column) -> Column:
        hit = lambda b: F.get(ws, F.floor(b / 64).cast("int")).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(b, F.lit(64)).cast("int"))) != 0
        return reduce(lambda a, b: a & b, (hit(_bit(key, level, k, bits)) for k in range(HASHES)))

    return probe(words)


class Cascade:
    """The levels of one key set over one universe; ``contains`` is exact for every key of the universe."""

    def __init__(self, levels: list[tuple[DataFrame, int]]):
        self.levels = levels

    @classmethod
    def build(cls, listed: DataFrame, universe: DataFrame) -> Cascade:
        """``listed`` and ``universe``: distinct keys in a column ``key``; listed is a subset of universe."""
        both = materialize(universe.join(listed.withColumn("listed", F.lit(True)), "key", "left").select("key", F.coalesce("listed", F.lit(False)).alias("listed")), "universe")
        inside, outside = both.filter("listed").select("key"), both.filter("NOT listed").select("key")
        levels: list[tuple[DataFrame, int]] = []
        count = inside.count()
        while count:
            if len(levels) == MAX_LEVELS:
                raise ValueError("the cascade does not end: a key is both listed and not")
            level = len(levels)
            words, bits = _level(inside, level, count)
            levels.append((words, bits))
            # what the new level wrongly claims is what the next one encodes
            wrong = materialize(outside.filter(_claims(F.col("key"), words.scalar(), level, bits)), "claimed")
            inside, outside = wrong, inside
            count = wrong.count()
        return cls(levels)

    def contains(self, key: Column) -> Column:
        out = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(range(len(self.levels))):
            words, bits = self.levels[level]
            out = F.when(_claims(key, words.scalar(), level, bits), out).otherwise(F.lit(level % 2 == 1))
        return out


def listed_hosts(universe: DataFrame) -> DataFrame:
    """The block list of the query, a stand-in for a list from outside: hosts whose md5 begins with 0..3."""
    return universe.filter(F.substring(F.md5(F.col("key")), 1, 1).isin("0", "1", "2", "3"))


def judge(pages: DataFrame, listed=listed_hosts, rules: Sequence[tuple[str, str, str]] = RULES, url: str = "url") -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict. ``listed``: universe of hosts -> listed hosts in it."""
    parsed = pages.select("page_id", url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    universe = materialize(parsed.groupBy(F.col("host").alias("key")).agg(F.lit(1).alias("one")).select("key"), "hosts")
    keys = materialize(listed(universe).select("key").distinct(), "listed")
    shards = max(1, math.ceil(keys.count() * BITS_PER_KEY / MAX_BITS))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    out = None
    for s in range(shards):
        mine = lambda df, c, s=s: df.filter(F.pmod(F.xxhash64(F.lit(-1), F.col(c)), F.lit(shards)) == s) if shards > 1 else df
        cascade = Cascade.build(mine(keys, "key"), mine(universe, "key"))
        listed_here = F.when(cascade.contains(F.col("host")), F.lit("block")).otherwise(F.lit("allow"))
        part = mine(parsed, "host").select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, listed_here).alias("verdict"))
        out = part if out is None else out.unionByName(part)
    return out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lensmill.llm.common import table

    return judge(table(spark, sf_dir, "pages"))


SQL = r"""
WITH p AS (
  SELECT page_id,
         CASE WHEN url LIKE '%://%' THEN translate(regexp_extract(substr(url, instr(url, '://') + 3), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
         CASE WHEN url LIKE '%://%' THEN regexp_extract(substr(url, instr(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages
), r(verdict, rhost, rpath) AS (
  VALUES ('block', 'com', '/en/'), ('allow', 'example.com', '/en/7'), ('allow', 'net', '/de/'), ('block', 'example.net', '/de/8'), ('block', 'org', '/es/')
), j AS (
  SELECT p.page_id, p.host, p.path, r.rhost || r.rpath AS rule, r.verdict,
         row_number() OVER (PARTITION BY p.page_id, p.host, p.path ORDER BY length(r.rhost || r.rpath) DESC) AS k
  FROM p LEFT JOIN r ON (p.host = r.rhost OR ends_with(p.host, '.' || r.rhost)) AND starts_with(p.path, r.rpath)
)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN substr(md5(host), 1, 1) IN ('0', '1', '2', '3') THEN 'block' ELSE 'allow' END) AS verdict
FROM j WHERE k = 1
"""
