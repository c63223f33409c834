"""Joins, set operations and deduplication by key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column], null_keys: str = "keep") -> DataFrame:
    """The first row of each key in ``order``. Rows with a null key: ``keep`` all, or ``drop`` them.

    Rows with a key and those without are split first: the latter would all meet in one task otherwise.
    """
    known = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))
    ranked = df.filter(known).withColumn("_k", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_k = 1").drop("_k")
    return ranked.unionByName(df.filter(~known)) if null_keys == "keep" else ranked


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """As ``keep_one`` with ascending order, by aggregation: rows are reduced before the shuffle, so hot keys cost nothing."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.min(F.struct(*order, *rest)).alias("_m")
    return df.groupBy(*keys).agg(packed).select(*keys, "_m.*").select(*df.columns)


def merge_by_priority(parts: Sequence[DataFrame], key: str) -> DataFrame:
    """Union in which an earlier part's row replaces later ones with the same key; adds ``source_ord``."""
    tagged = [p.withColumn("source_ord", F.lit(i)) for i, p in enumerate(parts)]
    return keep_one(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged), [key], [F.col("source_ord")])


def cross_split(df: DataFrame, key: str, split: str, position: str, precedence: Sequence[str] = ("train", "val", "test")) -> DataFrame:
    """The last row of a key within its split, then only in the first split of the precedence that has it."""
    rank = F.array_position(F.array(*map(F.lit, precedence)), F.col(split))
    last = keep_one(df, [key, split], [F.col(position).desc()])
    return keep_one(last.withColumn("_r", rank), [key], [F.col("_r")]).drop("_r")


def exclude(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in ``other``; rows without a key stay."""
    return df.join(other.select(key).distinct(), key, "left_anti")


def common_to_all(runs: Sequence[DataFrame], key: str) -> DataFrame:
    """Keys that every run has: one aggregation instead of a chain of joins."""
    tagged = reduce(lambda a, b: a.unionByName(b), (r.select(key, F.lit(i).alias("run")) for i, r in enumerate(runs)))
    return tagged.groupBy(key).agg(F.count_distinct("run").alias("n")).filter(F.col("n") == len(runs)).select(key)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


#: Vectors of a block: two blocks meet in one matrix product.
BLOCK_VECTORS = 2048


def _blocks(df: DataFrame, key: str, vec: str, block: str, n: int) -> DataFrame:
    packed = df.select(F.pmod(F.xxhash64(key), F.lit(n)).cast("int").alias(block), F.struct(F.col(key).alias("k"), F.col(vec).cast("array<double>").alias("v")).alias("x"))
    return packed.groupBy(block).agg(F.collect_list("x").alias("xs"))


def max_cosine(rows: DataFrame, reference: DataFrame, key: str, vec: str, block_vectors: int = BLOCK_VECTORS) -> DataFrame:
    """For each row the largest cosine to any other reference vector (all of unit norm); null without one.

    Every pair is looked at, as the operator asks for. Both sides are cut into blocks by hash, a block of rows meets a
    block of references in one task, as one matrix product, and maxima are reduced before the shuffle: a task holds two
    blocks, whatever the sizes of the sides.
    """
    n_rows, n_refs = (max(1, -(-df.count() // block_vectors)) for df in (rows, reference))
    a = _blocks(rows, key, vec, "i", n_rows).withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(n_refs - 1)))).withColumnRenamed("xs", "a")
    b = _blocks(reference, key, vec, "j", n_refs).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(n_rows - 1)))).withColumnRenamed("xs", "b")

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def unpack(cell):
            values = cell.values
            return values.field("k").to_numpy(zero_copy_only=False), np.stack(values.field("v").to_numpy(zero_copy_only=False))

        for batch in batches:
            for x, y in zip(batch.column(0), batch.column(1), strict=True):
                k, v = unpack(x)
                rk, r = unpack(y)
                sims = v @ r.T
                sims[k[:, None] == rk[None, :]] = -np.inf
                best = sims.max(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(best, mask=~np.isfinite(best))], names=[key, "sim"])

    cells = a.join(b, ["i", "j"]).select("a", "b")
    found = cells.mapInArrow(run, f"{key} {dict(rows.dtypes)[key]}, sim double").groupBy(key).agg(F.max("sim").alias("sim"))
    return rows.select(key).join(found, key, "left") if reference.isEmpty() else found
