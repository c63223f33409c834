"""Structured Streaming jobs: resumable scoring, incremental deduplication, windows and sessions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


class TargetReached(Exception):
    """Ends a stream before its next batch, which stays to be done."""


def resumable(stream: DataFrame, step: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, timeout: int = 300, target: int | None = None, max_batches: int | None = None) -> bool:
    """Process what is new and stop. A batch is written under its number, so one that is repeated after a crash
    replaces itself; finished files are never read again.

    With ``target`` no batch begins once so many rows are written, in this run and those before; with ``max_batches`` none
    after so many in this run. What was not begun is new to the next run. Returns whether a limit ended the run.
    """
    done = {"rows": 0, "batches": 0, "ended": False}
    if target is not None and _exists(stream.sparkSession, out):
        done["rows"] = stream.sparkSession.read.parquet(out).count()

    def write(batch: DataFrame, number: int) -> None:
        if (target is not None and done["rows"] >= target) or (max_batches is not None and done["batches"] >= max_batches):
            done["ended"] = True
            raise TargetReached
        path = f"{out}/batch={number}"
        step(batch).write.mode("overwrite").parquet(path)
        done["batches"] += 1
        if target is not None:
            done["rows"] += batch.sparkSession.read.parquet(path).count()

    q = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    try:
        ended = q.awaitTermination(timeout)
    except Exception:
        if not done["ended"]:
            raise
        return True
    if not ended:
        q.stop()
        raise TimeoutError(f"stream did not end in {timeout} s")
    return False


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def deduplicated(stream: DataFrame, keys: list[str], time: str, delay: str) -> DataFrame:
    """First row of a key within the watermark's delay; older state is dropped, so it stays bounded."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def window_counts(events: DataFrame, time: str, size: str, slide: str | None = None, delay: str = "1 hour") -> DataFrame:
    source = events.withWatermark(time, delay) if events.isStreaming else events
    w = F.window(time, size, slide) if slide else F.window(time, size)
    return source.groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


def sessions(events: DataFrame, key: str, time: str, gap: str, delay: str = "1 hour") -> DataFrame:
    source = events.withWatermark(time, delay) if events.isStreaming else events
    return source.groupBy(key, F.session_window(time, gap).alias("w")).agg(F.count("*").alias("n"))


def drain(df: DataFrame, name: str, checkpoint: str, mode: str = "append", timeout: int = 300) -> DataFrame:
    """Run a bounded stream into memory and return its rows; for tests and small reports."""
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    if not q.awaitTermination(timeout):
        q.stop()
        raise TimeoutError(f"stream did not end in {timeout} s")
    return df.sparkSession.table(name)
