"""Operator 1: preference formatting.

A pair is a chosen and a rejected conversation. Their longest common prefix of turns (role and text equal, nulls equal
to nulls) is rendered once, as the prompt; what follows is rendered on either side as a completion, with a mask that
says which characters are trained on: the contents and the end mark of assistant turns, never a header and never the
turns of others.

DataFrame expressions only. The turns of a pair meet in one aggregation keyed by the pair, so a pair costs one shuffle
of its rows; there is no self-join, and copies of one conversation under many ids stay apart. A pair is one training
record and is held by one task, as its rendered text must be.

Defined results: turns are ordered by (turn, role, text), nulls first; a null role renders as ``unknown`` and a null
text as nothing; repeated turn rows are turns of their own; rows without a pair or a side (a null conv_id) are of no
pair; a side that is missing is an empty conversation (its
completion is null); equal conversations have the whole conversation as prompt and two empty completions; an empty
table gives no pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lensmill.llm.common import let

START, END = "<|im_start|>", "<|im_end|>\n"


def header(t: Column) -> Column:
    return F.concat(F.lit(START), F.coalesce(t["role"], F.lit("unknown")), F.lit("\n"))


def body(t: Column) -> Column:
    return F.concat(F.coalesce(t["text"], F.lit("")), F.lit(END))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(header(t), body(t))), "")


def trained_spans(turns: Column, trained_role: str = "assistant") -> Column:
    """``start-end`` (characters of the rendered completion, end excluded) of what is trained on, joined by commas."""
    zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("spans"))

    def add(acc: Column, t: Column) -> Column:
        start = acc["at"] + F.char_length(header(t))
        end = start + F.char_length(body(t))
        span = F.concat_ws("-", start.cast("string"), end.cast("string"))
        spans = F.when(t["role"].eqNullSafe(F.lit(trained_role)), F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
        return F.struct(end.cast("bigint").alias("at"), spans.alias("spans"))

    return F.aggregate(turns, zero, add, lambda a: F.array_join(a["spans"], ","))


def common_turns(a: Column, b: Column) -> Column:
    """How many turns two conversations share from the start."""
    same = F.zip_with(a, b, lambda x, y: x["role"].eqNullSafe(y["role"]) & x["text"].eqNullSafe(y["text"]))
    shorter = F.least(F.size(a), F.size(b))
    first = F.array_position(F.slice(same, F.lit(1), shorter), False)
    return F.when(first > 0, first - 1).otherwise(shorter.cast("bigint"))


def render_pairs(sides: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """``sides``: pair_id and the turns ``chosen`` and ``rejected`` in order (no turns: a side that is missing)."""

    def pieces(n: Column) -> Column:
        rest = lambda side: F.slice(side, n.cast("int") + 1, F.greatest(F.size(side), F.lit(1)))
        out = [n.alias("n_common_turns"), render(F.slice(F.col("chosen"), F.lit(1), n.cast("int"))).alias("prompt")]
        for side in ("chosen", "rejected"):
            there = F.size(side) > 0
            out += [
                F.when(there, render(rest(F.col(side)))).alias(side),
                F.when(there, trained_spans(rest(F.col(side)), trained_role)).alias(f"{side}_trained"),
            ]
        return F.struct(*out)

    done = sides.select("pair_id", let(common_turns(F.col("chosen"), F.col("rejected")), pieces).alias("p"))
    return done.select("pair_id", "p.*")


def gather(turns: DataFrame, pair: Column, is_first: Column, first: str, second: str) -> DataFrame:
    """pair_id and the turns of its two conversations, in order. Rows without a pair or a side are of no pair."""
    rows = turns.select(pair.alias("pair_id"), is_first.alias("c"), F.struct("turn", "role", "text").alias("t")).filter("pair_id IS NOT NULL AND c IS NOT NULL")
    return rows.groupBy("pair_id").agg(
        F.sort_array(F.collect_list(F.when(F.col("c"), F.col("t")))).alias(first),
        F.sort_array(F.collect_list(F.when(~F.col("c"), F.col("t")))).alias(second),
    )


def format_pairs(turns: DataFrame, pair: Column, is_chosen: Column, trained_role: str = "assistant") -> DataFrame:
    """``turns``: turn, role, text and what ``pair`` and ``is_chosen`` need. One row per pair."""
    return render_pairs(gather(turns, pair, is_chosen, "chosen", "rejected"), trained_role)


def branch(own: Column, other: Column, own_id: Column, other_id: Column) -> Column:
    """The turns of a rejected conversation for ``own``.

    Up to some assistant turn they are those of ``own``, from there on those of ``other`` from one of its assistant turns.
    Which turns is a matter of the ids' hashes, and so is the kind of pair: of ten, one shares nothing from the start on
    purpose, one is all of ``own``, one is missing, and the rest branch off.
    """
    number = lambda c, i: F.conv(F.substring(F.md5(F.concat(F.lit("pair-1|"), c.cast("string"))), 6 * i + 1, 6), 16, 10).cast("bigint")

    def turn(side: Column, c: Column) -> Column:
        spots = F.filter(F.transform(side, lambda t, i: F.when(t["role"] == "assistant", i + 1)), lambda i: i.isNotNull())
        return let(spots, lambda s: F.coalesce(F.get(s, (number(c, 0) % F.greatest(F.size(s), F.lit(1))).cast("int")), F.size(side) + 1))

    kind = number(own_id, 1) % 10
    before = let(turn(own, own_id), lambda at: F.slice(own, F.lit(1), at - 1))
    after = let(turn(other, other_id), lambda at: F.slice(other, at, F.size(other) + 1))
    return F.when(kind == 0, after).when(kind == 1, own).when(kind == 2, F.slice(own, 1, 0)).otherwise(F.concat(before, after))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pair for each conversation, which is the chosen one; see ``branch`` for the rejected one.

    Conversations 2k and 2k + 1 lend each other their turns, as the table has no preference labels of its own.
    """
    from lensmill.llm.common import table

    c = table(spark, sf_dir, "conversations")
    both = gather(c, F.floor(F.col("conv_id") / 2).cast("bigint"), F.col("conv_id") % 2 == 0, "a", "b")
    even, odd = F.col("pair_id") * 2, F.col("pair_id") * 2 + 1
    a, b = F.col("a"), F.col("b")
    pair = lambda i, own, other, j: F.struct(i.alias("pair_id"), own.alias("chosen"), branch(own, other, i, j).alias("rejected"))
    sides = both.select(F.explode(F.array(pair(even, a, b, odd), pair(odd, b, a, even))).alias("p")).select("p.*")
    return render_pairs(sides.filter(F.size("chosen") > 0))


SQL = r"""
WITH t AS (
  SELECT conv_id, role, text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS k,
         '<|im_start|>' || coalesce(role, 'unknown') || chr(10) AS head, coalesce(text, '') || '<|im_end|>' || chr(10) AS body
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, count(*) AS n, list(k ORDER BY k) FILTER (role = 'assistant') AS spots,
         CAST('0x' || substr(md5('pair-1|' || conv_id), 1, 6) AS BIGINT) AS h, CAST('0x' || substr(md5('pair-1|' || conv_id), 7, 6) AS BIGINT) % 10 AS kind
  FROM t GROUP BY conv_id
), d AS (
  SELECT conv_id, kind, xor(conv_id, 1) AS other, CASE WHEN len(spots) > 0 THEN spots[1 + h % len(spots)] ELSE n + 1 END AS at FROM c
), u AS (
  SELECT conv_id AS pair_id, true AS c, k, role, text, head, body FROM t
  UNION ALL
  SELECT t.conv_id, false, t.k, role, text, head, body FROM t JOIN d USING (conv_id) WHERE kind = 1 OR (kind > 2 AND t.k < d.at)
  UNION ALL
  SELECT d.conv_id, false, t.k - o.at + CASE WHEN d.kind = 0 THEN 1 ELSE d.at END, role, text, head, body
  FROM d JOIN d o ON o.conv_id = d.other JOIN t ON t.conv_id = o.conv_id AND t.k >= o.at WHERE d.kind = 0 OR d.kind > 2
), s AS (
  SELECT pair_id, count(*) FILTER (c) AS nc, count(*) FILTER (NOT c) AS nr FROM u GROUP BY pair_id
), m AS (
  SELECT a.pair_id, min(a.k) AS k FROM u a JOIN u b ON a.pair_id = b.pair_id AND a.k = b.k AND a.c AND NOT b.c
  WHERE a.role IS DISTINCT FROM b.role OR a.text IS DISTINCT FROM b.text GROUP BY a.pair_id
), n AS (
  SELECT s.*, CAST(coalesce(m.k - 1, least(nc, nr)) AS BIGINT) AS n_common_turns FROM s LEFT JOIN m USING (pair_id)
), r AS (
  SELECT u.*, n.n_common_turns, u.k <= n.n_common_turns AS shared,
         coalesce(sum(length(head) + length(body)) FILTER (u.k > n.n_common_turns) OVER (PARTITION BY u.pair_id, c ORDER BY u.k), 0) AS stop
  FROM u JOIN n USING (pair_id)
), p AS (
  SELECT pair_id, c, coalesce(string_agg(head || body, '' ORDER BY k) FILTER (shared), '') AS prompt,
         coalesce(string_agg(head || body, '' ORDER BY k) FILTER (NOT shared), '') AS completion,
         coalesce(string_agg(CAST(stop - length(body) AS BIGINT) || '-' || CAST(stop AS BIGINT), ',' ORDER BY k) FILTER (NOT shared AND role = 'assistant'), '') AS trained
  FROM r GROUP BY pair_id, c
)
SELECT n.pair_id, n.n_common_turns, coalesce(a.prompt, '') AS prompt, a.completion AS chosen, a.trained AS chosen_trained,
       b.completion AS rejected, b.trained AS rejected_trained
FROM n LEFT JOIN p a ON n.pair_id = a.pair_id AND a.c LEFT JOIN p b ON n.pair_id = b.pair_id AND NOT b.c
"""
