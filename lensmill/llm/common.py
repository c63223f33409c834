"""What the operators of this folder share: shared scratch space, words, and 64-bit token hashing."""

from __future__ import annotations

import os
import sys
import tempfile
import uuid
from collections.abc import Iterable

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lensmill.operators.ranking import fresh, numbered  # noqa: F401

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: A word is a run of anything but ASCII white space.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share; one of our own only on a single machine where none is set."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = os.path.join(tempfile.gettempdir(), "lensmill-scratch")
    return found.rstrip("/")


#: Paths of this process that ``release`` has not deleted yet.
_made: list[str] = []


def scratch(spark: SparkSession, what: str) -> str:
    """A new path in the shared folder."""
    _made.append(f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}")
    return _made[-1]


def made() -> list[str]:
    """The scratch paths so far."""
    return list(_made)


def release(spark: SparkSession, keep: Iterable[str] = ()) -> None:
    """Delete the tables that operators of this folder have written, but for ``keep``.

    To be called when the results that were read from them are written elsewhere or no longer needed.
    """
    kept = set(keep)
    for path in [p for p in _made if p not in kept]:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
        _made.remove(path)


def materialize(df: DataFrame, what: str) -> DataFrame:
    """Cut the lineage: write ``df`` in the shared folder and read it back. Survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, what)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of an Arrow batch. The default suits short rows; texts, pages and packed blobs are long, and both the JVM and the
#: Python worker hold a batch.
BATCH_ROWS = 512


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of this session small from here on."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def tidy(run):
    """``run`` for ``mapInArrow``, after which the worker gives memory back: Spark keeps workers for other tasks."""

    def wrapped(batches):
        yield from run(batches)
        import ctypes
        import gc

        import pyarrow

        gc.collect()
        gc.freeze()  # what a worker keeps (modules, tables) is not looked at again: 40 ms a task otherwise
        pyarrow.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (OSError, AttributeError):  # not glibc
            pass

    return wrapped


def text_or_empty(col: str | Column) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text as an array; [] for a null or blank text."""
    return F.array_remove(F.split(text_or_empty(text), SPACE), "")


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once for a row and use it many times in ``body``.

    A lambda variable is never inlined again, unlike a projected column that the optimizer may collapse into each use.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def public_vocabulary(name: str) -> str:
    """Path of a public tokenizer file; the folder is found where it is installed."""
    import public_tokenizers

    return public_tokenizers.path(name)
