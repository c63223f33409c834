"""Hooks for models: scorers and answering services are injected; this package brings deterministic stand-ins only."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def score_udf(load: Callable[[], Callable[[list[str]], list[list[float]]]], batch: int = 16):
    """text -> scores. ``load`` runs once in each Python worker; texts go through in batches."""

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for s in batches:
            texts = s.fillna("").tolist()
            out: list[list[float]] = []
            for i in range(0, len(texts), batch):
                out += model(texts[i : i + batch])
            yield pd.Series(out)

    return run


def stub_model(dims: int = 6) -> Callable[[], Callable[[list[str]], list[list[float]]]]:
    """Scores 0..10 from a hash of the text."""

    def load():
        return lambda texts: [[hashlib.md5(f"{i}{t}".encode()).digest()[0] / 25.5 for i in range(dims)] for t in texts]

    return load


def zero_shot(scores: Column, labels: Sequence[str], confidence: float = 0.35) -> Column:
    """(passed, reason) by a model's ``scores`` of the lower-cased text for each of ``labels``, the wanted one first.

    Passes where the wanted label has the highest score (the first of equal ones) and that is at least ``confidence``;
    else the reason names the first word of the highest label. Without scores nothing passes, and the reason is
    ``no_scores``. A column that a ``score_udf`` makes is best added first, so that the model runs once a row.
    """
    top = F.array_max(scores)
    best = F.array_position(scores, top).cast("int")
    passed = F.coalesce((best == 1) & (top >= confidence), F.lit(False))
    words = F.array(*(F.lit("blocked_category:" + re.split("[, ]", label, maxsplit=1)[0]) for label in labels))
    return F.struct(passed.alias("passed"), F.when(passed, "passed_semantic").otherwise(F.coalesce(F.get(words, best - 1), F.lit("no_scores"))).alias("reason"))


def two_stage(df: DataFrame, screen: str, threshold: float, stage2: Callable[[DataFrame], DataFrame], empty: Column) -> DataFrame:
    """Send only rows that pass the screen through the costly stage.

    A conditional around a Python UDF runs it for every row, so the rows are split by filter and united again.
    """
    low = df.filter(~(F.col(screen) >= threshold)).withColumns({"scores": empty, "stage_used": F.lit("stage1_low")})
    high = stage2(df.filter(F.col(screen) >= threshold)).withColumn("stage_used", F.lit("stage2"))
    return low.unionByName(high)


#: (kind, substrings of the lower-cased message), first match wins.
ERRORS = (
    ("rate_limit", ("rate limit", "429", "quota")),
    ("timeout", ("timeout", "timed out")),
    ("auth", ("api key", "401", "unauthorized", "permission")),
    ("connection", ("connection", "network", "unreachable")),
    ("server", ("500", "502", "503", "overloaded")),
)
RETRYABLE = ("rate_limit", "timeout", "connection", "server")


def error_type(message: Column) -> Column:
    out = None
    for kind, words in ERRORS:
        hit = None
        for w in words:
            c = F.contains(F.lower(message), F.lit(w))
            hit = c if hit is None else hit | c
        out = F.when(hit, kind) if out is None else out.when(hit, kind)
    return out.otherwise("unknown")


def backoff(kind: str, attempt: int) -> float:
    """Seconds before the next attempt: 1, 2, 4, ...; twice that after a rate limit; authorization errors are final."""
    if kind not in RETRYABLE:
        return -1.0
    return 2.0**attempt * (2 if kind == "rate_limit" else 1)


def ask(df: DataFrame, prompt: str, client: Callable[[], Callable[[str], str]], attempts: int = 3, sleep: Callable[[float], None] | None = None, between: float = 0.0) -> DataFrame:
    """Adds answer, attempts, error, and when the call began (``asked_at``, seconds since 1970) and how long it took (``seconds``).

    Failures become rows, never failed tasks. ``between`` is the time before each call of a task: a rate limit of the
    service is kept by it and the number of tasks.
    """
    new = [("answer", T.StringType()), ("attempts", T.LongType()), ("error", T.StringType()), ("asked_at", T.DoubleType()), ("seconds", T.DoubleType())]
    schema = T.StructType([*df.schema.fields, *(T.StructField(n, t) for n, t in new)])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import time

        call, wait = client(), sleep or time.sleep
        for b in batches:
            answers, tries, errors, begun, took = [], [], [], [], []
            for p in b[prompt]:
                answer = error = None
                if between:
                    wait(between)
                start, clock = time.time(), time.perf_counter()
                for n in range(attempts):
                    try:
                        answer, error = call(p), None
                        break
                    except Exception as e:
                        error = str(e)
                        kind = next((k for k, ws in ERRORS if any(w in error.lower() for w in ws)), "unknown")
                        pause = backoff(kind, n)
                        if pause < 0 or n + 1 == attempts:
                            break
                        wait(pause)
                answers.append(answer)
                tries.append(n + 1)
                errors.append(error)
                begun.append(start)
                took.append(round(time.perf_counter() - clock, 2))
            yield b.assign(answer=answers, attempts=tries, error=errors, asked_at=begun, seconds=took)

    return df.mapInPandas(run, schema)


def call_metrics(asked: DataFrame, key: str) -> DataFrame:
    """One row a call: id, success, attempts, seconds, and the kind of error of those that failed."""
    failed = F.col("answer").isNull()
    return asked.select(key, F.col("asked_at").cast("timestamp").alias("at"), (~failed).alias("success"), "attempts", "seconds", F.when(failed, error_type(F.col("error"))).alias("error_type"))
