"""Sinks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_splits(df: DataFrame, path: str, split: str = "split") -> None:
    df.write.mode("overwrite").partitionBy(split).json(path)


def review_rows(df: DataFrame, keywords: list[str]) -> DataFrame:
    """What a reviewer sees: short title, snippet without breaks, the first three keywords."""
    from lensmill.functions.text import keyword_hits

    snippet = F.translate(F.substring("content", 1, 200), "\n\t", "  ")
    return df.select("id", F.substring("title", 1, 120).alias("title"), snippet.alias("snippet"), F.array_join(F.slice(keyword_hits(F.col("content"), keywords), 1, 3), ", ").alias("keywords"))


#: Bytes of a file that are held at a time.
CHUNK_BYTES = 4 << 20
MANIFEST = "file string, bytes bigint, sha256 string, lines bigint"


def _open(path: str):
    """(file system of pyarrow, path in it) of a path as Hadoop writes it; what pyarrow does not open raises."""
    from urllib.parse import quote

    from pyarrow import fs

    scheme, _, rest = path.partition(":")
    if "/" in scheme:
        return fs.LocalFileSystem(), path
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(quote(path, safe=":/@"))


def _streams(spark: SparkSession, path: str) -> bool:
    """Whether pyarrow opens the file system of ``path``."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    try:
        _open(p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString())
    except (OSError, ValueError, NotImplementedError):
        return False
    return True


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Size, digest and line count (newlines) of every file under ``path``; empty files are no rows, as Spark lists none.

    Spark lists the files and deals them by size; a task reads them as streams, ``CHUNK_BYTES`` at a time. On a file system
    that only Spark's readers open, a file is one row, and its length is bounded by the heap of an executor.
    """
    f = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    if not _streams(spark, path):
        lines = F.octet_length("content") - F.octet_length(F.replace(F.col("content").cast("string"), F.lit("\n"), F.lit("")))
        return f.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"), lines.cast("bigint").alias("lines"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                fs, at = _open(name)
                digest, size, lines = hashlib.sha256(), 0, 0
                with fs.open_input_stream(at, compression=None) as stream:
                    while chunk := stream.read(CHUNK_BYTES):
                        digest.update(chunk)
                        size += len(chunk)
                        lines += chunk.count(b"\n")
                yield pa.RecordBatch.from_pydict({"file": [name.rpartition("/")[2]], "bytes": [size], "sha256": [digest.hexdigest()], "lines": [lines]})

    return f.select("path").mapInArrow(run, MANIFEST)
