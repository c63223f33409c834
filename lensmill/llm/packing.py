"""Token hashing and packed postings for the similarity joins.

Postings are dealt by a bucket of their key as packed arrays (one row for each bucket and flush) instead of one row for
each posting: the shuffle then carries 12 to 70 bytes a posting, and a task sorts plain arrays of one bucket at a time.
The number of buckets follows the bytes of text, as counted: a bucket stands for ``BUCKET_BYTES`` of them, at any size of
the input. A task that dealt to very many buckets would pack only a few postings a row, so beyond ``FAN`` buckets postings
are dealt twice: first by ranges of buckets, then each range by its buckets.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lensmill.llm.common import bounded_batches, tidy

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FLUSH = 200_000
#: Text that a bucket stands for, and the most buckets or ranges of them that a task deals to.
BUCKET_BYTES, FAN = 16 << 20, 4096
#: Size of a membership bitmap (``bitmap``): fixed, whatever the input.
BITMAP_BITS = 1 << 23

U = np.uint64
GOLD, M1, M2 = U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits depend on all input bits."""
    y = x >> U(30)
    y ^= x
    y *= M1
    y ^= y >> U(27)
    y *= M2
    y ^= y >> U(31)
    return y


LONG_WORD = 256
_MASKS = np.array([(1 << 8 * i) - 1 for i in range(9)], dtype=np.uint64)


def word_hashes(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash, first byte) of every word of a byte array; words are cut at ASCII white space.

    All words advance together, eight bytes at a time; the few very long ones are hashed one by one.
    """
    blank = np.ones(len(buf) + 2, dtype=bool)
    np.less(buf - np.uint8(9), 5, out=blank[1:-1])
    blank[1:-1] |= buf == 32
    edge = np.flatnonzero(blank[1:] != blank[:-1])
    start, size = edge[::2].copy(), edge[1::2] - edge[::2]
    out = size.astype(np.uint64) * GOLD
    padded = np.concatenate((buf, np.zeros(16, np.uint8)))
    eights = np.lib.stride_tricks.as_strided(padded, shape=(len(buf) + 8, 8), strides=(1, 1))
    with np.errstate(over="ignore"):
        at = None  # all words
        pos, rest, was = start, size, out
        if len(size) and size.max() > LONG_WORD:
            at = np.flatnonzero(size <= LONG_WORD)
            pos, rest, was = start[at], size[at], out[at]
        while len(pos):
            piece = eights[pos].view(np.uint64)[:, 0]
            piece &= _MASKS[np.minimum(rest, 8)]
            piece ^= was
            piece *= GOLD
            piece = mix(piece)
            if at is None:
                out = piece
            else:
                out[at] = piece
            more = np.flatnonzero(rest > 8)
            at = more if at is None else at[more]
            pos, rest, was = pos[more] + 8, rest[more] - 8, piece[more]
    for i in np.flatnonzero(size > LONG_WORD):
        from xxhash import xxh64_intdigest

        out[i] = xxh64_intdigest(buf[start[i] : start[i] + size[i]].tobytes(), 7)
    return out, start


def bucket_count(spark: SparkSession, text_bytes: int, least: int = 2) -> int:
    """One for each ``BUCKET_BYTES`` of text; of a small input ``least`` for each of the session's partitions, to keep them busy."""
    return max(least * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-text_bytes // BUCKET_BYTES))


class Packer:
    """Gathers arrays of equal length, the first being the keys, and deals them by bucket of the key.

    With more than ``FAN`` buckets and unless ``fine``, by ranges of buckets.
    """

    def __init__(self, buckets: int, fine: bool = False):
        self.buckets, self.parts, self.held = U(buckets), [], 0
        self.width = 1 if fine else -(-buckets // FAN)

    def add(self, *arrays: np.ndarray) -> None:
        if len(arrays[0]):
            self.parts.append(arrays)
            self.held += len(arrays[0])

    def full(self) -> bool:
        return self.held >= FLUSH

    def dealt(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
        """What was gathered, in order of buckets: the buckets, where each begins and ends, and the arrays."""
        columns = [np.concatenate(c) for c in zip(*self.parts, strict=True)]
        self.parts, self.held = [], 0
        b = ((columns[0] >> U(32)) % self.buckets).astype(np.int64) // self.width
        order = np.argsort(b, kind="stable")
        b, columns = b[order], [c[order] for c in columns]
        cuts = np.flatnonzero(np.diff(b, prepend=-1))
        return b[cuts], cuts, np.append(cuts[1:], len(b)), columns

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        b, cuts, ends, columns = self.dealt()
        yield _packed(b, [[c[s:e].tobytes() for c in columns] for s, e in zip(cuts, ends, strict=True)])


def _packed(b: np.ndarray, rows: list[list[bytes]]) -> pa.RecordBatch:
    arrays = [pa.array(b.astype(np.int32)), *(pa.array(c, pa.binary()) for c in zip(*rows, strict=True))]
    return pa.RecordBatch.from_arrays(arrays, names=["bucket", *(f"c{i}" for i in range(len(arrays) - 1))])


def packed_schema(n: int) -> str:
    return ", ".join(["bucket int", *(f"c{i} binary" for i in range(n))])


class KeyPacker(Packer):
    """Keeps 32 bits of the key: the bucket stands for others, and equal keys stay equal. A range needs all bits."""

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.width > 1:
            yield from super().flush()
            return
        for batch in super().flush():
            keys = [(np.frombuffer(k, dtype=np.uint64) & U(0xFFFFFFFF)).astype(np.uint32).tobytes() for k in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary()), *batch.columns[2:]], names=batch.schema.names)


#: The bit of a key that says that its posting begins a run, in ``RunPacker``; callers leave it 0.
START = 1 << 31


class RunPacker(KeyPacker):
    """Of the arrays after the keys, what is equal in neighbouring postings of a bucket is kept once: a run.

    A set has many keys and each posting would repeat the set's number, which outweighs the key. ``unrun`` undoes it.
    """

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        b, cuts, ends, (key, *columns) = self.dealt()
        new = np.zeros(len(key), dtype=bool)
        new[cuts] = True
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        key = key | (new.astype(np.uint64) << U(31))
        if self.width == 1:
            key = (key & U(0xFFFFFFFF)).astype(np.uint32)
        columns, at = [c[new] for c in columns], np.append(0, np.cumsum(new))
        yield _packed(b, [[key[s:e].tobytes(), *(c[at[s] : at[e]].tobytes() for c in columns)] for s, e in zip(cuts, ends, strict=True)])


def unrun(key: np.ndarray, *columns: np.ndarray) -> list[np.ndarray]:
    """The arrays that a ``RunPacker`` was given: whole rows of it, one after the other."""
    run = np.cumsum(key & key.dtype.type(START) != 0) - 1
    return [key & ~key.dtype.type(START), *(c[run] for c in columns)]


def _spread(packed: DataFrame, dtypes: list, buckets: int, runs: bool = False) -> DataFrame:
    """Deal ranges of buckets by bucket: a task holds one flush, whatever the size of a range."""
    n = len(dtypes)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = (RunPacker if runs else KeyPacker if dtypes[0] is np.uint32 else Packer)(buckets, fine=True)
        full = [np.uint64, *dtypes[1:]]
        for batch in batches:
            for i in range(batch.num_rows):
                arrays = [np.frombuffer(batch.column(k + 1)[i].as_py(), dtype=full[k]) for k in range(n)]
                packer.add(*(unrun(*arrays) if runs else arrays))
                if packer.full():
                    yield from packer.flush()
        yield from packer.flush()

    ranges = -(-buckets // -(-buckets // FAN))
    return packed.repartitionById(ranges, "bucket").mapInArrow(tidy(run), packed_schema(n))


def by_bucket(packed: DataFrame, dtypes: list, buckets: int, process: Callable[..., Iterable[pa.RecordBatch]], schema: str, repack: int = 0, runs: bool = False) -> DataFrame:
    """Deal packed rows by bucket and run ``process(*arrays)`` on each bucket's arrays.

    A first type of 32 bits says that a ``KeyPacker`` made the rows; with ``runs`` a ``RunPacker`` did, and ``process`` gets
    them as they are (``unrun``). With ``repack``, a number of buckets,
    ``process(packer, bucket, *arrays)`` adds its postings to a packer that the buckets of a task share, so that a task
    gives out a row for each of those buckets and flush.
    """
    if buckets > FAN:
        packed = _spread(packed, dtypes, buckets, runs)
    # two buckets a task, exactly: by hash some tasks would get several times as many as others
    tasks = -(-buckets // 2)
    return by_group(packed.repartitionById(tasks, F.col("bucket") % tasks), dtypes, process, schema, repack)


def by_group(dealt: DataFrame, dtypes: list, process: Callable[..., Iterable[pa.RecordBatch]], schema: str, repack: int = 0) -> DataFrame:
    """``by_bucket`` of rows that are dealt already, by any integer in place of the bucket."""
    packed = dealt
    bounded_batches(packed.sparkSession)
    n = len(dtypes)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[bytes]] = [[] for _ in range(n)]
        current = None
        packer = Packer(repack) if repack else None

        def done() -> Iterator[pa.RecordBatch]:
            arrays = [np.frombuffer(b"".join(h), dtype=t) for h, t in zip(held, dtypes, strict=True)]
            for h in held:
                h.clear()
            if packer is None:
                yield from process(*arrays)
            else:
                process(packer, current, *arrays)
                if packer.full():
                    yield from packer.flush()

        for batch in batches:
            buckets = batch.column(0).to_pylist()
            for i, b in enumerate(buckets):
                if current is not None and b != current:
                    yield from done()
                current = b
                for k in range(n):
                    held[k].append(batch.column(k + 1)[i].as_py())
        if current is not None:
            yield from done()
        if packer is not None:
            yield from packer.flush()

    return packed.sortWithinPartitions("bucket").mapInArrow(tidy(run), schema)


def bitmap(keys: DataFrame, column: str, bits: int = BITMAP_BITS) -> np.ndarray:
    """A bitmap of the hashed keys, at most ``bits`` / 8 bytes on the driver: a first sieve before an exact join."""
    spot = F.pmod(F.xxhash64(column), F.lit(bits))
    words = keys.select(F.floor(spot / 32).cast("int").alias("w"), F.expr("1").alias("one"), (spot % 32).cast("int").alias("b"))
    rows = words.groupBy("w").agg(F.bit_or(F.expr("shiftleft(1L, b)")).alias("bits")).toArrow()
    out = np.zeros(bits // 32, dtype=np.uint32)
    out[rows.column("w").to_numpy()] = rows.column("bits").to_numpy().astype(np.uint32)
    return out


def in_bitmap(bits: np.ndarray, spots: np.ndarray) -> np.ndarray:
    return (bits[spots >> 5] >> (spots & 31).astype(np.uint32)) & np.uint32(1) == 1


def spot(column: str, bits: int = BITMAP_BITS):
    """The place of a key in a bitmap, as a column."""
    return F.pmod(F.xxhash64(column), F.lit(bits)).cast("bigint")
