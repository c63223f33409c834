"""Text cleaning, model inputs, chunking and JSON of model answers, as Column expressions."""

from __future__ import annotations

import html
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Code points that cleaning removes.
ZERO_WIDTH = "\u200b\u200c\u200d\ufeff\u2060\u180e"
BIDI = "\u200e\u200f\u202a\u202b\u202c\u202d\u202e\u2066\u2067\u2068\u2069"


def lit_text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def drop_zero_width(c: Column) -> Column:
    return F.translate(c, ZERO_WIDTH, "")


def drop_bidi(c: Column) -> Column:
    return F.translate(c, BIDI, "")


def strip(c: Column) -> Column:
    """Both ends without white space, as Java's and RE2's \\s have it."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def normalize_whitespace(c: Column) -> Column:
    """Tabs to spaces, runs of spaces to one, three or more newlines to two, then each line and the whole stripped."""
    t = F.regexp_replace(F.regexp_replace(F.translate(c, "\t", " "), " {2,}", " "), "\n{3,}", "\n\n")
    return strip(F.array_join(F.transform(F.split(t, "\n"), strip), "\n"))


def strip_tags(c: Column) -> Column:
    no_tags = F.regexp_replace(c, "<[^>]+>", "")
    return F.regexp_replace(F.regexp_replace(no_tags, "&[a-zA-Z]+;", " "), "&#[0-9]+;", " ")


@F.pandas_udf(T.StringType())
def _unescape(s: pd.Series) -> pd.Series:
    return s.map(lambda x: html.unescape(x) if x is not None else None)


def decode_entities(df: DataFrame, column: str, into: str) -> DataFrame:
    """All HTML5 entities. Rows without ``&`` skip Python: the two kinds are split before the UDF and united again."""
    has = F.contains(F.col(column), F.lit("&"))
    plain = df.filter(~F.coalesce(has, F.lit(False))).withColumn(into, F.col(column))
    return plain.unionByName(df.filter(has).withColumn(into, _unescape(column)))


def drop_invalid(c: Column) -> Column:
    """Bytes that are no UTF-8 go; the replacement character, where a valid text has it, stays."""
    return F.when(F.is_valid_utf8(c), c).otherwise(F.translate(F.make_valid_utf8(c), "\ufffd", ""))


def sanitize_no_entities(c: Column) -> Column:
    """The full cleaner for text whose entities are decoded: tags, zero width, BiDi, white space, in this order."""
    return normalize_whitespace(drop_bidi(drop_zero_width(strip_tags(c))))


def sanitize(df: DataFrame, column: str, into: str) -> DataFrame:
    """The full cleaner: invalid bytes, entities, tags, zero width, BiDi, white space."""
    made = decode_entities(df.withColumn(into, drop_invalid(F.col(column))), into, into)
    return made.withColumn(into, sanitize_no_entities(F.col(into)))


def clean_nested(df: DataFrame, column: str) -> DataFrame:
    """The full cleaner on every string of a nested column, all HTML5 entities included.

    Rows without ``&`` skip Python: the two kinds are split before the function and united again.
    """
    kind = df.schema[column].dataType

    def walk(v):
        if isinstance(v, str):
            return html.unescape(v)
        if isinstance(v, list):
            return [walk(x) for x in v]
        if isinstance(v, dict):
            return {k: walk(x) for k, x in v.items()}
        return tuple(walk(x) for x in v) if isinstance(v, tuple) else v

    has = F.coalesce(F.contains(F.to_json(F.struct(column)), F.lit("&")), F.lit(False))
    decoded = df.filter(~has).unionByName(df.filter(has).withColumn(column, F.udf(walk, kind)(column)))
    return decoded.withColumn(column, clean_struct(F.col(column), kind))


def clean_struct(c: Column, kind: T.DataType) -> Column:
    """Apply the cleaner to every string of a nested column whose entities are decoded; the type is walked on the driver."""
    if isinstance(kind, T.StringType):
        return sanitize_no_entities(drop_invalid(c))
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: clean_struct(x, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.transform_values(c, lambda _, v: clean_struct(v, kind.valueType))
    if isinstance(kind, T.StructType):
        fields = F.struct(*(clean_struct(c[f.name], f.dataType).alias(f.name) for f in kind.fields))
        return F.when(c.isNotNull(), fields)
    return c


def combined(title: Column, description: Column, content: Column, limit: int = 2000) -> Column:
    """title, description and the first ``limit`` characters of the content; missing parts are left out."""
    return F.concat_ws(" ", title, description, F.substring(content, 1, limit))


def words(c: Column) -> Column:
    return F.split(F.trim(c), r"\s+")


def head_tail(c: Column, head: int = 256, tail: int = 256, sep: str = " [...] ") -> Column:
    """Unchanged up to head + tail words, else the first and the last of them."""
    w = words(c)
    short = F.size(w) <= head + tail
    cut = F.concat(F.array_join(F.slice(w, 1, head), " "), F.lit(sep), F.array_join(F.slice(w, -tail, tail), " "))
    return F.when(short, c).otherwise(cut)


def compress(c: Column, max_words: int = 800, marker: str = "\n\n[...]\n\n") -> Column:
    """Over ``max_words``: 70 % of that many from the start and 30 % from the end."""
    w, head, tail = words(c), int(max_words * 0.7), int(max_words * 0.3)
    cut = F.concat(F.array_join(F.slice(w, 1, head), " "), F.lit(marker), F.array_join(F.slice(w, -tail, tail), " "))
    return F.when(F.size(w) > max_words, cut).otherwise(c)


def estimated_tokens(c: Column) -> Column:
    return F.floor(F.size(words(c)) * F.lit(1.3)).cast("bigint")


def chunk_starts(n: Column, size: int, step: int, stop_at_end: bool) -> Column:
    """Word offsets of chunks: every ``step``; with ``stop_at_end`` none after the one that reaches the end."""
    last = F.greatest(F.ceil((n - size) / F.lit(float(step))), F.lit(0)) * step if stop_at_end else F.floor((n - 1) / F.lit(float(step))) * step
    return F.sequence(F.lit(0), last.cast("int"), F.lit(step))


def chunks(c: Column, size: int, overlap: int, stop_at_end: bool = False, most: int | None = None) -> Column:
    """Array of chunks of ``size`` words; neighbours share ``overlap``."""
    w, step = words(c), max(1, size - overlap)
    starts = chunk_starts(F.size(w), size, step, stop_at_end)
    if most:
        starts = F.slice(starts, 1, most)
    return F.transform(starts, lambda s: F.array_join(F.slice(w, s + 1, size), " "))


def token_chunks(c: Column, tokens: int = 256, overlap: int = 128, most: int = 32) -> Column:
    """Chunks sized in estimated tokens (1.3 a word)."""
    return chunks(c, int(tokens / 1.3), overlap, most=most)


FENCE = r"(?s)```(?:json)?\s*\n?(.*?)\n?```"


def extract_json(c: Column) -> Column:
    """A fenced block, else from the first brace to the last, else the text, stripped."""
    fenced = F.regexp_extract(c, FENCE, 1)
    braces = F.regexp_extract(c, r"(?s)\{.*\}", 0)
    return F.when(c.rlike(FENCE), F.trim(fenced)).when(braces != "", braces).otherwise(F.trim(c))


@F.pandas_udf(T.StringType())
def _repair_escapes(s: pd.Series) -> pd.Series:
    import re

    quoted = re.compile(r'"(?:[^"\\]|\\.)*"', re.S)
    bad = re.compile(r'\\(?!["\\/bfnrtu])')
    return s.map(lambda x: quoted.sub(lambda m: bad.sub(r"\\\\", m.group()), x) if x is not None else None)


def repair_json_native(c: Column) -> Column:
    """Comments and trailing commas. As in the behaviour it reproduces, ``//`` inside a string is taken for a comment."""
    t = F.regexp_replace(F.regexp_replace(c, r"(?m)//[^\n]*$", ""), r"(?s)/\*.*?\*/", "")
    return F.regexp_replace(t, r",(\s*[}\]])", "$1")


def repair_json(c: Column) -> Column:
    return _repair_escapes(repair_json_native(c))


def parse_or_repair(df: DataFrame, column: str) -> DataFrame:
    """Adds ``parsed`` (VARIANT) and ``json_repaired``. Only rows that do not parse go through Python."""
    first = df.withColumn("_json", extract_json(F.col(column))).withColumn("parsed", F.try_parse_json("_json"))
    good = first.filter("parsed IS NOT NULL").withColumn("json_repaired", F.lit(False))
    bad = first.filter("parsed IS NULL").withColumn("_json", repair_json(F.col("_json"))).withColumn("parsed", F.try_parse_json("_json"))
    return good.unionByName(bad.withColumn("json_repaired", F.col("parsed").isNotNull())).drop("_json")


def dim_score(v: Column, path: str) -> Column:
    """A score that is a number, a numeric string or an object with ``score``; else null."""
    return F.coalesce(F.try_variant_get(v, f"$.{path}.score", "double"), F.try_variant_get(v, f"$.{path}", "double"))


def keyword_hits(c: Column, keywords: list[str]) -> Column:
    low = F.lower(c)
    return F.filter(F.array(*map(F.lit, keywords)), lambda k: F.contains(low, k))


def hash_bucket(c: Column, n: int = 10000) -> Column:
    return F.conv(F.substring(F.sha1(c), 1, 8), 16, 10).cast("bigint") % n


def safe_id(c: Column) -> Column:
    return F.substring(F.regexp_replace(c, r"[^\w-]", "_"), 1, 64)


def source_of_id(c: Column) -> Column:
    """Everything before the last underscore."""
    return F.when(F.contains(c, F.lit("_")), F.regexp_extract(c, r"(?s)^(.*)_[^_]*$", 1)).otherwise(c)


def sort_date(*candidates: Column) -> Column:
    """The first non-empty date up to ``T``; without one, a date after all others."""
    found = F.coalesce(*(F.nullif(c, F.lit("")) for c in candidates))
    return F.coalesce(F.split_part(found, F.lit("T"), F.lit(1)), F.lit("9999-12-31"))


def order_hash(key: Column, seed: int = 42) -> Column:
    """Deterministic pseudo-random order of rows, the same in any engine that has md5."""
    return F.md5(F.concat(key.cast("string"), F.lit(str(seed))))
