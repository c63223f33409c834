"""Operator 10: exact n-gram Jaccard join by partition of the universe.

A document's set holds the distinct shingles of ``n`` words (A-Z lower-cased; fewer words: the whole sequence as one).
Documents with equal sets form a class; classes link when their similarity is at least ``num`` / ``den``.

Size bands. Band k holds sizes B(k) <= s < B(k+1), each bound at least the last times den/num, so linked sets lie in
one band or in neighbours. Group g takes bands g and g+1; a set takes part in the two groups of its band. In a group
linked sets differ in at most H tokens.

Pigeonhole. Hashing cuts the universe into m segments. A set's segment is indexed by a hash of its tokens (any
difference changes it); designated segments (``q`` of them: none or all, for each group) also by their one-deletion
neighbourhood, which survives one difference. If the non-empty segments plus the designated ones with two tokens or more number at least H + 1, a linked
partner must share a key. m and q are chosen for each group by cost: the fewest keys a set at a failure probability
that is negligible; whether a set really falls short is counted exactly, and a group with one gets more segments until
none does. Of these keys a set needs only H + 1; those that no other class has come first, then the rarest (by the
exact number of classes with a key), so keys that many documents share are left out unless a set has little else.
Sets of sizes that allow no difference need no keys: their classes are their links.

Verification is exact, on the words themselves: candidates meet the texts of their classes' first documents, the centre
of a star once for each chunk of partners. A sketch of parities bounds the difference of two sets from below.

Hot groups. Copies fall into one class before anything is paired. In a run of many classes with one key only the pairs
with its first member are taken first; links and components follow, and only members of a run that are still in
different components are compared with each other, in blocks, by size and sketch. So near copies in a group of k cost k pairs,
and components are exact; links inside a component are not all looked for. Where ``similar`` is asked for ``links``, all
members of a run are compared in those blocks and every link is found and counted.
Classes are known by 64-bit hashes; two sets with the same one are detected, and everything starts again with another
seed.

Defined results: null, empty or blank texts have no shingles and link with nothing (their own component); ties and
repeated rows are copies; the component's id is its smallest doc_id (null doc_ids are ignored for it unless there is no
other); other columns are ignored by ``similar`` and kept by ``keep_one``.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lensmill.llm.common import bounded_batches, materialize, text_or_empty, tidy
from lensmill.llm.components import components
from lensmill.llm.packing import START, Packer, RunPacker, U, bitmap, bucket_count, by_bucket, in_bitmap, mix, packed_schema, spot, unrun, word_hashes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE, NUM, DEN = 5, 80, 100
SMALL_RUN = 8
CHUNK = 256
SKETCH_BITS = 1024
BLOCK = 2048
LOWEST = 16
TAIL = 1e-12
WEAK = 4
STEP, SEG, GROUP = U(0x9FB21C651E98DF25), U(0xD6E8FEB86659FD93), U(0xA0761D6478BD642F)


def bounds(num: int, den: int, upto: int) -> list[int]:
    """The first size of each band, until one exceeds ``upto``."""
    out = [1]
    while out[-1] <= upto:
        out.append(max(out[-1] + 1, out[-1] * den // num + 1))
    return out


def _falls_short(size: int, m: int, h: int, all_designated: bool) -> float:
    """Probability that ``size`` tokens in m segments weigh at most h.

    A non-empty segment weighs 1; a designated one with two tokens or more weighs 2. Exact, by dealing out the tokens
    one at a time: ``p[i, j]`` is the probability of i segments with one token and j with more.
    """
    if not all_designated:
        p = np.zeros(m + 1)
        p[0] = 1.0
        filled = np.arange(m + 1) / m
        for _ in range(size):
            p = p * filled + np.append(0.0, p[:-1] * (1 - filled[:-1]))
        return float(p[: h + 1].sum())
    p = np.zeros((m + 1, m + 1))
    p[0, 0] = 1.0
    i, j = np.meshgrid(np.arange(m + 1), np.arange(m + 1), indexing="ij")
    for _ in range(size):
        new = p * j / m
        new[1:, :] += (p * np.maximum(m - i - j, 0) / m)[:-1, :]
        new[:-1, 1:] += (p * i / m)[1:, :-1]
        p = new
    return float(p[i + 2 * j <= h].sum())


def allocate(lo: int, hi: int, num: int, den: int, more: int = 0) -> tuple[int, int, int]:
    """(H, m, q) of the group whose smaller sets have sizes lo..hi. ``more``: how often it had to be widened.

    Cost: the keys of a set, a key that hashes a single token counting ``WEAK`` times as it makes long runs.
    """
    h = (den - num) * (hi + hi * den // num) // (den + num)
    if h == 0:
        return 0, 1, 0

    def cost(m: int, q: int) -> float:
        load = hi / m
        some = 1 - math.exp(-load)
        single, pair = load * math.exp(-load), load * load / 2 * math.exp(-load)
        return m * (some + WEAK * single) + q * load * (1 + WEAK * pair)

    best = (math.inf, h + 41, 0)
    if h <= 40:
        for m in range(1, 2 * h + 40):
            options = [(m, 0)] if m > h else []
            if 2 * m > h and h <= 12 and m <= h + 12:
                options.append((m, m))
            for m, q in options:
                c = cost(m, q)
                if c < best[0] and _falls_short(lo, m, h, q > 0) <= TAIL:
                    best = (c, m, q)
    else:
        # many segments: empty ones are nearly Poisson; 8 deviations and 12 above the mean is beyond TAIL for any mean
        slack = 12
        for _ in range(8):
            empty = (h + 1 + slack) * math.exp(-lo / (h + 1 + slack))
            slack = math.ceil(empty + 8 * math.sqrt(empty) + 12)
        best = (0.0, h + 1 + slack, 0)
    _, m, q = best
    m += more * (m // 2 + 1)
    return h, m, m if q else 0


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Sets:
    """The shingle hashes of documents."""

    def __init__(self, n: int, seed: int = 0):
        self.n, self.seed = n, U(seed)

    def of_all(self, docs: list[bytes]) -> list[np.ndarray]:
        """The distinct shingles of each document; A-Z are lower-cased, words are cut at ASCII white space."""
        buf = LOWER[np.frombuffer(b"\n".join(docs), dtype=np.uint8)]
        w, start = word_hashes(buf)
        ends = np.cumsum([len(d) + 1 for d in docs])
        cut = np.concatenate(([0], np.searchsorted(start, ends)))  # the first word of each document
        shingles = self._shingles(w, self.n)
        out = []
        for a, b in zip(cut, cut[1:], strict=False):
            if b - a >= self.n:
                out.append(np.unique(shingles[a : b - self.n + 1]))
            else:
                out.append(self._shingles(w[a:b], int(b - a)) if b > a else np.zeros(0, dtype=np.uint64))
        return out

    def _shingles(self, w: np.ndarray, n: int) -> np.ndarray:
        if len(w) < n:
            return np.zeros(0, dtype=np.uint64)
        with np.errstate(over="ignore"):
            h = np.full(len(w) - n + 1, U(n), dtype=np.uint64)
            for i in range(n):
                h = (h ^ w[i : len(w) - n + 1 + i]) * STEP
                h ^= h >> U(29)
            return mix(h)

    def class_of(self, u: np.ndarray) -> tuple[int, int]:
        """Two independent hashes of a set, as signed numbers."""
        with np.errstate(over="ignore"):
            a = mix(np.add.reduce(mix(u + self.seed + U(1))) + U(len(u)))
            b = mix(np.add.reduce(mix(u ^ U(0xC2B2AE3D27D4EB4F))) + U(len(u)))
        return int(a.astype(np.int64)), int(b.astype(np.int64))


def sketch(u: np.ndarray) -> bytes:
    """Parities of the tokens in ``SKETCH_BITS`` hashed cells: two sets differ in at least as many tokens as cells."""
    cells = np.bincount((mix(u ^ U(0x3C79AC492BA7B653)) >> U(64 - SKETCH_BITS.bit_length() + 1)).astype(np.int64), minlength=SKETCH_BITS)
    return np.packbits((cells & 1).astype(np.uint8)).tobytes()


def band_of(size: int, cuts: list[int]) -> int:
    import bisect

    return bisect.bisect_right(cuts, size) - 1


def segment_keys(sets: list[np.ndarray], groups: np.ndarray, ms: np.ndarray, qs: np.ndarray, want_keys: bool = True):
    """(keys, index of the set of each key, weight of each set): all sets of a batch at once."""
    lens = np.array([len(s) for s in sets], dtype=np.int64)
    if not len(lens) or not lens.sum():
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(len(lens), np.int64)
    u = np.concatenate(sets)
    doc = np.repeat(np.arange(len(sets)), lens)
    with np.errstate(over="ignore"):
        g = groups[doc].astype(np.uint64)
        h = mix(u + g * GROUP + U(11))
        local = (h % ms[doc].astype(np.uint64)).astype(np.int64)
        base = np.concatenate(([0], np.cumsum(ms)))[:-1]
        segment = base[doc] + local
        order = np.argsort(segment, kind="stable")
        s, v = segment[order], mix(u[order] ^ U(0x5851F42D4C957F2D))
        first = np.flatnonzero(np.diff(s, prepend=-1))
        sums = np.add.reduceat(v, first)
        sizes = np.diff(np.append(first, len(s)))
        owner = doc[order][first]
        chosen = (local[order][first] < qs[owner]) & (sizes >= 2)
        weight = np.bincount(owner, minlength=len(sets)) + np.bincount(owner, weights=chosen, minlength=len(sets)).astype(np.int64)
        if not want_keys:
            return None, None, weight
        tag = local[order][first].astype(np.uint64) * SEG + groups[owner].astype(np.uint64) * GROUP
        keys, owners = [mix(sums + tag)], [owner]
        if chosen.any():
            run = np.repeat(np.arange(len(first)), sizes)
            t = chosen[run]
            keys.append(mix(sums[run][t] - v[t] + tag[run][t]))
            owners.append(owner[run][t])
    return np.concatenate(keys), np.concatenate(owners), weight


class Plan:
    """Which groups a set of a given size takes part in, and how each is cut."""

    def __init__(self, num: int, den: int, wider: dict[int, int]):
        self.cuts = bounds(num, den, 1 << 31)
        self.cut = [allocate(lo, hi - 1, num, den, wider.get(g, 0)) for g, (lo, hi) in enumerate(zip(self.cuts, self.cuts[1:], strict=False))]

    def groups(self, size: int) -> list[int]:
        k = band_of(size, self.cuts)
        return [g for g in (k, k - 1) if g >= 0 and self.of(g)[0] > 0]

    def of(self, g: int) -> tuple[int, int, int]:
        return self.cut[g]

    def entries(self, sets: list[np.ndarray]) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For each set and group: index of the set, group, m, q, H."""
        rows = [(i, g, *self.of(g)) for i, s in enumerate(sets) if len(s) for g in self.groups(len(s))]
        if not rows:
            z = np.zeros(0, np.int64)
            return [], z, z, z, z
        i, g, h, m, q = zip(*rows, strict=True)
        return list(i), np.array(g), np.array(m), np.array(q), np.array(h)


def _documents(docs: DataFrame, text: str) -> DataFrame:
    bounded_batches(docs.sparkSession)
    return docs.select("doc_id", text_or_empty(text).cast("binary").alias("data"))


def _slices(batch: pa.RecordBatch, size: int = 512) -> Iterator[pa.RecordBatch]:
    for i in range(0, batch.num_rows, size):
        yield batch.slice(i, size)


def describe(docs: DataFrame, n: int, text: str = "text", seed: int = 0) -> DataFrame:
    """doc_id, n_shingles, the class hashes c1, c2, the sketch and the bytes of text."""
    names = ["doc_id", "n_shingles", "c1", "c2", "sketch", "bytes"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = Sets(n, seed)
        for batch in batches:
            rows, data = [], [b.as_py() for b in batch.column(1)]
            for u, text in zip(sets.of_all(data), data, strict=True):
                rows.append((len(u), *sets.class_of(u), sketch(u), len(text)))
            if rows:
                columns = zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64()), strict=True)
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in columns)], names=names)

    return _documents(docs, text).mapInArrow(tidy(run), "doc_id bigint, n_shingles bigint, c1 bigint, c2 bigint, sketch binary, bytes bigint")


#: As the note of a posting or the tag of a shared key: this group has a set with too few segments. As a key: the same, later.
SHORT_NOTE, SHORT, SHORT_KEY = 0xFFFF, 0xFFFFFFFF, (1 << 64) - 1
#: The key, of which bit 30 says whether the group's number is odd; for each run of a class: its hash and its note.
POSTING = [np.uint32, np.int64, np.uint16]
ODD, SPARE_MOST = 30, 254


def postings(docs: DataFrame, n: int, plan: Plan, buckets: int, text: str = "text", seed: int = 0) -> DataFrame:
    """Packed (key, class, note): every class of a task once. The two groups of a class are told apart by the key's bit ``ODD``.

    The note is the spare of the even group and that of the odd one, a byte each. Spare: how many of a set's non-empty
    segments it could do without, N - H - 1, at most ``SPARE_MOST``; 0 in groups with one-deletion keys.
    """
    free = ~U((1 << ODD) | START)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, packer, seen = Sets(n, seed), RunPacker(buckets), set()
        for batch in batches:
            for part in _slices(batch):
                fresh, ids = [], []
                for u in sets.of_all([b.as_py() for b in part.column(1)]):
                    if len(u) and (c := sets.class_of(u)[0]) not in seen:
                        if len(seen) >= 1_000_000:
                            seen.clear()
                        seen.add(c)
                        fresh.append(u)
                        ids.append(c)
                index, g, m, q, h = plan.entries(fresh)
                if index:
                    keys, owner, weight = segment_keys([fresh[i] for i in index], g, m, q)
                    spare = np.minimum(np.where(q > 0, 0, np.maximum(weight - h - 1, 0)), SPARE_MOST)
                    at, odd = np.array(index), g & 1
                    note = np.bincount(at, weights=spare << 8 * odd, minlength=len(fresh)).astype(np.uint16)
                    order = np.argsort(at[owner], kind="stable")  # all keys of a class together
                    keys, owner = keys[order], owner[order]
                    keys = (keys & free) | (odd[owner].astype(np.uint64) << U(ODD))
                    packer.add(keys, np.array(ids, dtype=np.int64)[at[owner]], note[at[owner]])
                    if len(bad := np.unique(g[weight < h + 1])):
                        packer.add(mix(bad.astype(np.uint64)) & free, bad.astype(np.int64), np.full(len(bad), SHORT_NOTE, np.uint16))
                if packer.full():
                    yield from packer.flush()
        yield from packer.flush()

    return _documents(docs, text).mapInArrow(tidy(run), packed_schema(3))


def shared_keys(packed: DataFrame, buckets: int) -> DataFrame:
    """Of the postings, those whose key another class has too: packed (class, key, classes with the key, tag).

    The tag is the group's parity and, in the lower 24 bits, the class's spare there.
    """

    def process(out: Packer, bucket: int, key, cls, note) -> None:
        key, cls, note = unrun(key, cls, note)
        short = note == SHORT_NOTE
        if short.any():
            g = np.unique(cls[short])
            out.add(g.astype(np.uint64), np.full(len(g), SHORT_KEY, np.uint64), np.zeros(len(g), np.uint32), np.full(len(g), SHORT, np.uint32))
            key, cls, note = key[~short], cls[~short], note[~short]
        odd = (key >> np.uint32(ODD)).astype(np.uint32)
        tag = (odd << np.uint32(24)) | ((note >> (8 * odd)) & np.uint32(0xFF))
        order = np.lexsort((tag, cls, key))
        key, cls, tag = key[order], cls[order], tag[order]
        new = np.ones(len(key), dtype=bool)
        new[1:] = (key[1:] != key[:-1]) | (cls[1:] != cls[:-1])
        key, cls, tag = key[new], cls[new], tag[new]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        size = np.diff(np.append(first, len(key)))
        often = np.repeat(size, size)
        many = often > 1
        whole = (np.uint64(bucket) << U(32)) | key[many].astype(np.uint64)
        out.add(cls[many].astype(np.uint64), whole, often[many].astype(np.uint32), tag[many])

    return by_bucket(packed, POSTING, buckets, process, packed_schema(4), repack=buckets, runs=True)


def rarest_keys(shared: DataFrame, buckets: int) -> DataFrame:
    """Of each set and group the keys it needs: packed (key, class).

    A linked partner differs in at most H segments, so of any H + 1 one is the same. Segments nobody else has come
    first and match nobody; of the shared ones, in order of rarity, only as many are needed as fill up H + 1.
    """

    def process(out: Packer, _: int, cls, key, often, tag) -> None:
        short = tag == SHORT
        if short.any():
            out.add(np.full(int(short.sum()), SHORT_KEY, np.uint64), cls[short].astype(np.int64))
            cls, key, often, tag = cls[~short], key[~short], often[~short], tag[~short]
        group, spare = tag >> np.uint32(24), (tag & np.uint32(0xFFFFFF)).astype(np.int64)
        order = np.lexsort((key, often, group, cls))
        cls, key, group, spare = cls[order], key[order], group[order], spare[order]
        new = np.ones(len(key), dtype=bool)
        new[1:] = (cls[1:] != cls[:-1]) | (group[1:] != group[:-1])
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(key)))
        rank = np.arange(len(key)) - np.repeat(first, size)
        keep = rank < np.repeat(size, size) - spare
        out.add(key[keep], cls[keep].astype(np.int64))

    return by_bucket(shared, [np.uint64, np.uint64, np.uint32, np.uint32], buckets, process, packed_schema(2), repack=buckets)


def _runs(keys: np.ndarray, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
    """kind 0: candidate pairs (a, b); 1: members (run a, class b) of runs that are too long to pair; 2: groups (a) cut too coarsely.

    A long run is cut into ``blocks`` of ``BLOCK`` members, and ``own`` is a member's block, so no run meets in one task.
    """
    names = ["kind", "a", "b", "own", "blocks"]
    out = lambda kind, a, b, *at: pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int32)), pa.array(a), pa.array(b), *(pa.array(x, pa.int64()) for x in at or [np.zeros(len(a), np.int64)] * 2)], names=names)
    short = keys == SHORT_KEY
    if short.any():
        g = np.unique(ids[short])
        yield out(2, g, g)
        keys, ids = keys[~short], ids[~short]
    order = np.lexsort((ids, keys))
    k, i = keys[order], ids[order]
    new = np.ones(len(k), dtype=bool)
    new[1:] = (k[1:] != k[:-1]) | (i[1:] != i[:-1])
    k, i = k[new], i[new]
    first = np.flatnonzero(np.append(True, k[1:] != k[:-1])) if len(k) else np.zeros(0, np.int64)
    size = np.diff(np.append(first, len(k)))
    a, b = [], []
    for n in range(2, SMALL_RUN + 1):
        rows = i[first[size == n][:, None] + np.arange(n)]
        for x in range(n):
            for y in range(x + 1, n):
                a.append(rows[:, x])
                b.append(rows[:, y])
    long = size > SMALL_RUN
    f, s = first[long], size[long]
    if len(f):
        # runs with the same members once
        with np.errstate(over="ignore"):
            sums = np.add.reduceat(mix(np.append(i, 0).astype(np.uint64)), np.ravel(np.column_stack((f, f + s))))[::2]
        _, once = np.unique(sums, return_index=True)
        f, s, sums = f[once], s[once], sums[once]
        at = np.concatenate([np.arange(x, x + y) for x, y in zip(f, s, strict=True)])
        head, run = np.repeat(i[f], s), np.repeat(sums.astype(np.int64), s)
        own, blocks = (np.arange(len(at)) - np.repeat(np.cumsum(s) - s, s)) // BLOCK, np.repeat(-(-s // BLOCK), s)
        a.append(head)
        b.append(i[at])
    pairs = np.unique(np.column_stack((np.concatenate(a), np.concatenate(b))), axis=0) if a else np.zeros((0, 2), np.int64)
    pairs = pairs[pairs[:, 0] != pairs[:, 1]]
    if len(pairs):
        yield out(0, pairs[:, 0], pairs[:, 1])
    if len(f):
        yield out(1, run, i[at], own, blocks)


def shingles(data: bytes, n: int) -> frozenset:
    words = data.lower().split()
    if len(words) < n:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(zip(*(words[i:] for i in range(n)), strict=False))


def linked(x: frozenset, y: frozenset, num: int, den: int) -> bool:
    small, large = sorted((len(x), len(y)))
    if den * small < num * large:
        return False
    both = len(x & y)
    return den * both >= num * (small + large - both) and both > 0


def texts_of(docs: DataFrame, classes: DataFrame, n: int, text: str = "text", seed: int = 0) -> DataFrame:
    """(class, data) of the documents named by ``classes`` (class, rep): sieved by a bitmap, then joined exactly."""
    bits = bitmap(classes, "rep")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = Sets(n, seed)
        for batch in batches:
            part = batch.filter(pa.array(in_bitmap(bits, batch.column(2).to_numpy())))
            ids = [sets.class_of(u)[0] for u in sets.of_all([b.as_py() for b in part.column(1)])]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), part.column(1)], names=["class", "data"])

    found = docs.select("doc_id", text_or_empty(text).cast("binary").alias("data"), spot("doc_id").alias("spot"))
    found = found.mapInArrow(tidy(run), "class bigint, data binary")
    one = found.join(classes.select("class"), "class").groupBy("class").agg(F.min("data").alias("data"))
    return materialize(one, "texts")


def verify(pairs: DataFrame, texts: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """The linked pairs of ``pairs`` (a, b). A task holds the set of one centre and streams its partners."""
    degree = pairs.groupBy("a").agg(F.ceil(F.count("*") / CHUNK).cast("bigint").alias("chunks"))
    chunked = pairs.join(degree, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("chunks")).alias("chunk"))
    partners = chunked.join(texts.withColumnRenamed("class", "b"), "b").select("a", "chunk", "b", "data")
    centres = degree.select("a", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk")).join(texts.withColumnRenamed("class", "a"), "a")
    both = partners.unionByName(centres.select("a", "chunk", F.lit(None).cast("bigint").alias("b"), "data"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, own = None, frozenset()
        for batch in batches:
            a, b, out = batch.column(0).to_pylist(), batch.column(2).to_pylist(), []
            for i, data in enumerate(batch.column(3)):
                if b[i] is None:
                    centre, own = a[i], shingles(data.as_py(), n)
                elif a[i] == centre and linked(own, shingles(data.as_py(), n), num, den):
                    out.append((a[i], b[i]))
            if out:
                x, y = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], names=["a", "b"])

    dealt = both.repartition("a", "chunk").sortWithinPartitions("a", "chunk", F.col("b").asc_nulls_first())
    return materialize(dealt.mapInArrow(tidy(run), "a bigint, b bigint"), "links")


def block_pairs(members: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) of members (run, class, own, blocks, root) of one run with different roots that may be linked.

    Every two blocks of a run meet in one task, which compares sizes and sketches and gives out only pairs that these do
    not rule out.
    """
    # a pair that shares several runs is given out in the first one only, as far as the lowest runs of both tell
    lowest = members.groupBy("class").agg(F.slice(F.sort_array(F.collect_set("run")), 1, LOWEST).alias("low"))
    rows = members.join(classes.select("class", "n", "sketch"), "class").join(lowest, "class")
    met = rows.select("run", "class", "root", "n", "sketch", "low", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    met = met.withColumns({"lo": F.least("own", "other"), "hi": F.greatest("own", "other")})

    def compare(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(held)
        cls, root, n, own = (t.column(c).to_numpy() for c in ("class", "root", "n", "own"))
        bits = np.frombuffer(b"".join(t.column("sketch").to_pylist()), dtype=np.uint64).reshape(len(cls), -1)
        lo, hi = t.column("lo")[0].as_py(), t.column("hi")[0].as_py()
        left, right = np.flatnonzero(own == lo), np.flatnonzero(own == hi)
        here = t.column("run")[0].as_py()
        low = [{r for r in x if r < here} for x in t.column("low").to_pylist()]
        a, b = [], []
        for x in left:
            y = right[(root[right] != root[x]) & (n[right] * den >= n[x] * num) & (n[right] * num <= n[x] * den)]
            if lo == hi:
                y = y[cls[y] > cls[x]]
            far = np.bitwise_count(bits[y] ^ bits[x]).sum(axis=1, dtype=np.int64)
            y = y[far * (den + num) <= (den - num) * (n[y] + n[x])]
            if low[x]:
                y = y[[low[x].isdisjoint(low[j]) for j in y]] if len(y) else y
            if len(y):
                a.append(np.minimum(cls[y], cls[x]))
                b.append(np.maximum(cls[y], cls[x]))
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            keys = np.column_stack([batch.column(c).to_numpy() for c in ("run", "lo", "hi")])
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1), len(keys)]
            for s, e in zip(cuts, cuts[1:], strict=False):
                if s == e:
                    continue
                if last is not None and tuple(keys[s]) != last:
                    yield from compare(held)
                    held = []
                last = tuple(keys[s])
                held.append(batch.slice(s, e - s))
        if held:
            yield from compare(held)

    return met.repartition("run", "lo", "hi").sortWithinPartitions("run", "lo", "hi").mapInArrow(tidy(run), "a bigint, b bigint")


def similar(docs: DataFrame, n: int = SHINGLE, num: int = NUM, den: int = DEN, text: str = "text", links: bool = False) -> DataFrame:
    """One row per document: doc_id, n_shingles, class (c1), component_id; with ``links`` n_links, the number of other classes its class is linked with."""
    if num * 100 < den * 80:
        raise ValueError("the similarity must be 0.8 or more: below, small sets have too few tokens for the pigeonhole")
    spark: SparkSession = docs.sparkSession
    wider: dict[int, int] = {}
    seed = 0
    while True:
        found = materialize(describe(docs, n, text, seed), "sets")
        classes = found.filter("n_shingles > 0").groupBy(F.col("c1").alias("class")).agg(F.min("doc_id").alias("rep"), F.min("c2").alias("x"), F.max("c2").alias("y"), F.min("n_shingles").alias("n"), F.min("sketch").alias("sketch"))
        classes = materialize(classes, "classes")
        if classes.filter("x <> y").isEmpty():
            break
        seed += 1
    # the fewer the buckets, the more keys of a class share a run
    buckets = bucket_count(spark, found.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("n")).first()["n"], least=1)
    while True:
        packed = rarest_keys(shared_keys(postings(docs, n, Plan(num, den, wider), buckets, text, seed), buckets), buckets)
        runs = materialize(by_bucket(packed, [np.uint64, np.int64], buckets, _runs, "kind int, a bigint, b bigint, own bigint, blocks bigint"), "runs")
        short = [r["a"] for r in runs.filter("kind = 2").select("a").distinct().collect()]  # at most one for each band
        if not short:
            break
        wider = wider | {g: wider.get(g, 0) + 1 for g in short}
    pairs = materialize(runs.filter("kind = 0").select("a", "b").distinct(), "pairs")
    # runs with the same members have one name, whichever bucket finds them, and the same blocks
    members = runs.filter("kind = 1").select(F.col("a").alias("run"), F.col("b").alias("class"), "own", "blocks").distinct()
    named = pairs.select(F.col("a").alias("class")).union(pairs.select("b")).union(members.select("class")).distinct()
    texts = texts_of(docs, named.join(classes, "class").select("class", "rep"), n, text, seed)
    edges = verify(pairs, texts, n, num, den)
    if links:
        # every two members of a run are compared: each stands for itself
        rest = block_pairs(members.withColumn("root", F.col("class")), classes, num, den).distinct().join(pairs, ["a", "b"], "left_anti")
        edges = edges.unionByName(verify(materialize(rest, "pairs"), texts, n, num, den))
    labels = components(edges)
    while not links:
        # members of one run in different components may still be linked: pair those that were not paired yet
        placed = members.join(labels.withColumnRenamed("node", "class"), "class", "left").select("run", "class", "own", "blocks", F.coalesce("root", "class").alias("root"))
        # joined by block, not by run, so that no task gets a long run
        by_block = placed.groupBy("run", "own").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
        whole = Window.partitionBy("run")
        split = by_block.withColumns({"lo": F.min("lo").over(whole), "hi": F.max("hi").over(whole)}).filter("lo <> hi").select("run", "own")
        placed = materialize(placed.join(split, ["run", "own"]), "split")
        if placed.isEmpty():
            break
        rest = block_pairs(placed, classes, num, den).distinct().join(pairs, ["a", "b"], "left_anti")
        rest = materialize(rest, "pairs")
        if rest.isEmpty():
            break
        pairs = pairs.unionByName(rest)
        edges = edges.unionByName(verify(rest, texts, n, num, den))
        labels = components(edges)
    rooted = classes.join(labels.withColumnRenamed("node", "class"), "class", "left").select("class", "rep", F.coalesce("root", "class").alias("root"))
    rooted = materialize(rooted, "rooted")
    smallest = rooted.groupBy("root").agg(F.min("rep").alias("component"))
    of_class = rooted.join(smallest, "root").select(F.col("class").alias("c1"), "component")
    out = found.join(of_class, "c1", "left")
    alone = F.col("n_shingles") == 0
    counted = []
    if links:
        ends = edges.select(F.col("a").alias("c1")).unionByName(edges.select(F.col("b").alias("c1")))
        out = out.join(ends.groupBy("c1").agg(F.count("*").alias("n_links")), "c1", "left")
        counted = [F.when(alone, F.lit(0)).otherwise(F.coalesce("n_links", F.lit(0))).cast("bigint").alias("n_links")]
    return out.select(
        "doc_id", "n_shingles", F.when(~alone, F.col("c1")).alias("class"),
        *counted,
        F.when(alone, F.col("doc_id")).otherwise(F.col("component")).alias("component_id"),
    )


def keep_one(docs: DataFrame, n: int = SHINGLE, num: int = NUM, den: int = DEN) -> DataFrame:
    """Pipeline form: of each component the document with the smallest doc_id stays; of its repeated rows, all stay.

    Rows without a doc_id and documents without shingles stay.
    """
    found = similar(docs, n, num, den)
    gone = found.filter("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lensmill.llm.common import table

    return similar(table(spark, sf_dir, "documents"), n=4, num=85, den=100).select("doc_id", "n_shingles", "component_id")
