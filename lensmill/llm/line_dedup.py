"""Operator 5: line deduplication by an exact set-similarity join.

A line's set holds its distinct words. A line is removed if an earlier line of the corpus, by (doc_id, tie, line
number), has a Jaccard similarity of at least ``num`` / ``den`` with it, whether or not that line itself is removed; the first of any
group always stays.

Order of tokens: by rarity, counted over all lines in ``BUCKETS`` hashed counters (a fixed size; any order gives right
results, a rarer one fewer candidates), then by hash. Tokens are known by 44 bits, sets by 128.
Prefix filter: similar sets share a token among the first n - ceil(n num/den) + 1 of either; tokens that occur once in
the corpus cannot match and are left out.
Length and positional filters: sizes within num/den, and enough tokens left after the shared position. A 256-bit parity
sketch of each set then bounds the symmetric difference from below and drops nearly all other chance candidates.
Verification is exact, on the lines' words.

Equal sets first: a task posts each of its sets once, with its first place; the tasks' places meet in the run of any of
its tokens, and an exact stage finds the copies, so a line that a third of all documents share is one posting a task.
The sets of a run that agree in size, 64 bits of hash and the whole sketch are one. A run of more than ``LONG`` sets is
cut into blocks by size, and every two blocks that the length filter lets meet are compared in a task of their own.
Near copies: a later line takes its earlier partners of a run, of more than ``FEW`` the ``NEAREST`` likeliest. The ``FIRST`` of them are
verified first, the others for lines that these do not decide. Lines that had still more and are not
decided by those are looked at again with all of their partners, until nothing is left: no partner is dropped.

Recovery: all stages are plain jobs with results in the shared folder.

Defined results: lines are split at \\n; lines without words always stay; null texts stay null; a line repeated within
a document keeps its first occurrence; repeated rows (same doc_id and text) are one document and keep the same lines;
rows that share a doc_id but not the text are documents of their own, in the order of a 64-bit hash of the text (the
tie; 0 where no doc_id is used twice); so are rows without a doc_id, which come last; an empty table gives an empty
result; other columns are kept by ``dedup``.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lensmill.llm.common import bounded_batches, fresh, materialize, text_or_empty, tidy
from lensmill.llm.packing import BITMAP_BITS, GOLD, KeyPacker, Packer, U, bitmap, bucket_count, by_bucket, by_group, in_bitmap, mix, packed_schema, spot, word_hashes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

NUM, DEN = 80, 100
BUCKETS = 1 << 22
SLICES = 64
FEW, NEAREST, FIRST = 256, 24, 3
LONG = 2048
HOT = 50_000
LAST = (1 << 63) - 1
SLICE_BYTES, MAX_LINES = 1 << 20, 1 << 18
#: A flat array holds (line << TOKEN_BITS | token) of the lines of a slice; so it has fewer than 2 ** 20 lines.
TOKEN_BITS = 44
TOKEN = U((1 << TOKEN_BITS) - 1)
RARE_BITS = 36
COUNTS = 1_000_000
GONE = "class bigint, doc bigint, tie bigint, line bigint"
X, Y = ["xd", "xt", "xl"], ["yd", "yt", "yl"]


class Lines:
    """The sets of all lines with words of some pieces of documents (doc, tie, number of the first line, bytes), as flat arrays.

    ``token`` and ``of`` (index of the line here) hold the distinct tokens of each line in order, ``first`` the start of
    each line's tokens, ``size`` their number; ``doc``, ``tie`` and ``number`` say where the line stands.
    """

    def __init__(self, pieces: list[tuple[int, int, int, bytes]]):
        buf = np.frombuffer(b"\n".join(p[3] for p in pieces), dtype=np.uint8)
        words, start = word_hashes(buf)
        breaks = np.flatnonzero(buf == 10)
        ends = np.searchsorted(start, breaks)  # the words before each line break
        flat = np.repeat(np.arange(len(breaks) + 1, dtype=np.uint64) << U(TOKEN_BITS), np.diff(ends, prepend=0, append=len(start)))
        words &= TOKEN
        flat |= words
        flat.sort()
        new = np.ones(len(flat), dtype=bool)
        np.not_equal(flat[1:], flat[:-1], out=new[1:])
        self.flat = flat[new]
        self.token = self.flat & TOKEN
        here = (self.flat >> U(TOKEN_BITS)).view(np.int64)
        new = np.ones(len(here), dtype=bool)
        np.not_equal(here[1:], here[:-1], out=new[1:])
        self.first = np.flatnonzero(new)
        self.size = np.diff(np.append(self.first, len(here)))
        self.of = np.repeat(np.arange(len(self.first)), self.size)
        line = here[self.first]
        offsets = np.concatenate(([0], np.cumsum([len(p[3]) + 1 for p in pieces])))[:-1]
        starts = np.searchsorted(breaks, offsets)  # the first line of each piece
        self.piece = np.searchsorted(starts, line, side="right") - 1
        self.doc = np.array([p[0] for p in pieces], dtype=np.int64)[self.piece]
        self.tie = np.array([p[1] for p in pieces], dtype=np.int64)[self.piece]
        self.number = np.array([p[2] for p in pieces], dtype=np.int64)[self.piece] + line - starts[self.piece]
        with np.errstate(over="ignore"):
            self.mixed = mix(self.token)
            self.cls = mix(np.add.reduceat(self.mixed, self.first) + self.size.astype(np.uint64)) if len(line) else self.mixed

    def check(self) -> np.ndarray:
        """A second hash of each set."""
        with np.errstate(over="ignore"):
            return mix(np.add.reduceat(mix(self.mixed ^ U(0x2545F4914F6CDD1D)), self.first))

    def parity(self) -> list[np.ndarray]:
        """Four words: the parities of the tokens in 256 hashed cells."""
        cell, word = U(1) << (self.mixed >> U(58)), (self.mixed >> U(56)) & U(3)
        zero = U(0)
        return [np.bitwise_xor.reduceat(np.where(word == U(k), cell, zero), self.first) for k in range(4)]


def classes_of(lines: list[bytes]) -> list[int]:
    """The class of each line; 0 for a line without words."""
    out = np.zeros(len(lines), dtype=np.int64)
    start, size = 0, 0
    for end, line in enumerate(lines, 1):
        size += len(line) + 1
        if size >= SLICE_BYTES or end - start >= MAX_LINES or end == len(lines):
            x = Lines([(0, 0, 0, piece) for piece in lines[start:end]])
            out[start + x.piece] = x.cls.astype(np.int64)
            start, size = end, 0
    return out.tolist()


def _doc() -> Column:
    return F.coalesce(F.col("doc_id"), F.lit(LAST)).cast("bigint")


def survey(docs: DataFrame, text: str = "text") -> tuple[bool, int]:
    """Do rows share a doc_id (or have none)? And how many bytes of text are there?"""
    per_id = docs.groupBy(_doc().alias("d")).agg(F.count("*").alias("n"), F.sum(F.octet_length(text)).alias("b"))
    found = per_id.agg(F.coalesce(F.max("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("b"), F.lit(0)).alias("b")).first()
    return found["n"] > 1, found["b"]


def _tie(text: str, tied: bool) -> Column:
    """What tells rows of one doc_id apart: a hash of the text, never 0; 0 for all where doc_ids do."""
    if not tied:
        return F.lit(0).cast("bigint")
    h = F.xxhash64(F.col("doc_id").isNull(), F.col(text).cast("binary"))
    return F.when(h == 0, 1).otherwise(h)


def _rows(docs: DataFrame, text: str, tied: bool) -> DataFrame:
    bounded_batches(docs.sparkSession)
    return docs.select(_doc().alias("doc"), _tie(text, tied).alias("tie"), text_or_empty(text).cast("binary").alias("data"))


class Hot:
    """The smallest place of classes that a task has posted and that came twice in a slice: they are posted once a task."""

    def __init__(self) -> None:
        self.seen: dict[int, tuple[int, int, int]] = {}

    def known(self, x: Lines, leads: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Of the lines ``leads``, the first of their classes here, those that stand after a place posted before."""
        out = np.zeros(len(leads), dtype=bool)
        for k in np.flatnonzero(sizes > 1):
            i = leads[k]
            cls, at = int(x.cls[i]), (int(x.doc[i]), int(x.tie[i]), int(x.number[i]))
            first = self.seen.get(cls)
            if first is not None and first < at:
                out[k] = True
                continue
            if len(self.seen) >= HOT:
                self.seen.clear()
            self.seen[cls] = at
        return out


def _ties(tie: np.ndarray) -> tuple[np.ndarray, ...]:
    """The tie as a sort key, where there is one."""
    return (tie,) if tie.any() else ()


def _pieces(doc: int, tie: int, data: bytes) -> Iterator[tuple[int, int, int, bytes]]:
    """A document, cut between lines if it has very many."""
    if len(data) < MAX_LINES or data.count(b"\n") < MAX_LINES:
        yield doc, tie, 0, data
        return
    lines = data.split(b"\n")
    for i in range(0, len(lines), MAX_LINES):
        yield doc, tie, i, b"\n".join(lines[i : i + MAX_LINES])


def _parts(batches: Iterable[pa.RecordBatch]) -> Iterator[Lines]:
    """The lines of a few documents at a time."""
    held, size, breaks = [], 0, 0
    for batch in batches:
        for d, t, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            for piece in _pieces(d, t, data.as_py()):
                held.append(piece)
                size += len(piece[3]) + 1
                breaks += piece[3].count(b"\n") + 1
                if size >= SLICE_BYTES or breaks >= MAX_LINES:
                    x = Lines(held)
                    if len(x.size):
                        yield x
                    held, size, breaks = [], 0, 0
    if held:
        x = Lines(held)
        if len(x.size):
            yield x


#: A row of the first pass: kind 0, a slice of token counts (places that are not zero in c0, counts in c1); kind 1, packed places of sets.
PLACE = [np.uint64, np.uint64, np.int64, np.int64, np.uint32, np.uint8]


def first_pass(docs: DataFrame, buckets: int, text: str = "text", tied: bool = False) -> DataFrame:
    """Token counts and the places of all sets, from one reading of the texts; written, as both are used."""
    width = BUCKETS // SLICES

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, counts, held, n_held, hot = Packer(buckets), np.zeros(BUCKETS, dtype=np.uint32), [], 0, Hot()

        def packed() -> Iterator[pa.RecordBatch]:
            for b in packer.flush():
                yield pa.RecordBatch.from_arrays([pa.array(np.ones(b.num_rows, np.int32)), *b.columns], names=["kind", *b.schema.names])

        def count() -> None:
            nonlocal held, n_held
            if held:
                np.add.at(counts, np.concatenate(held), np.uint32(1))  # in place: no second array of all counters
            held, n_held = [], 0

        for x in _parts(batches):
            held.append((x.token & U(BUCKETS - 1)).astype(np.int32))
            n_held += len(x.token)
            if n_held >= COUNTS:
                count()
            # within a slice only the first place of a set goes to the set's bucket; the others are copies already
            order = np.lexsort((x.number, *_ties(x.tie), x.doc, x.cls))
            c, d, t, n, check = x.cls[order], x.doc[order], x.tie[order], x.number[order], x.check()[order]
            lead = np.append(True, c[1:] != c[:-1])
            first = np.flatnonzero(lead)
            start = first[np.cumsum(lead) - 1]
            late = np.zeros(len(c), dtype=bool)
            late[first[hot.known(x, order[first], np.diff(np.append(first, len(c))))]] = True
            take = lead | (d != d[start]) | (t != t[start]) | (n != n[start])  # a repeated row of one document is the same place, not a copy
            with np.errstate(over="ignore"):
                lead = lead & ~late  # one that stands after a place posted before is a copy
                key = np.where(lead, c, mix(d.astype(np.uint64) + t.astype(np.uint64) + n.astype(np.uint64)))
            packer.add(key[take], np.where(lead, check, c)[take], d[take], t[take], n[take].astype(np.uint32), (~lead).astype(np.uint8)[take])
            if packer.full():
                yield from packed()
        yield from packed()
        count()
        rows = []
        for k, part in enumerate(counts.reshape(SLICES, width)):
            at = np.flatnonzero(part)
            if len(at):
                rows.append((k, at.astype(np.uint16).tobytes(), part[at].tobytes()))
        if rows:
            k, at, n = zip(*rows, strict=True)
            columns = [pa.array(np.zeros(len(k), np.int32)), pa.array(k, pa.int32()), pa.array(at, pa.binary()), pa.array(n, pa.binary()), *[pa.nulls(len(k), pa.binary())] * 4]
            yield pa.RecordBatch.from_arrays(columns, names=["kind", "bucket", *(f"c{i}" for i in range(6))])

    return materialize(_rows(docs, text, tied).mapInArrow(tidy(run), "kind int, " + packed_schema(6)), "lines")


def rarity(first: DataFrame) -> np.ndarray:
    """For each bucket of token hashes a code that grows with the lines it occurs in; 0: in one line at most.

    The counts are added up slice by slice on the executors; the driver gets ``BUCKETS`` bytes, whatever the input.
    """
    width = BUCKETS // SLICES

    def code(total: np.ndarray) -> bytes:
        return np.minimum(8 * np.log2(np.maximum(total, 1)), 255).astype(np.uint8).tobytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, total = None, np.zeros(width, dtype=np.uint64)
        row = lambda: pa.RecordBatch.from_arrays([pa.array([current], pa.int32()), pa.array([code(total)], pa.binary())], names=["bucket", "c"])
        for batch in batches:
            for b, at, c in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                if current is not None and b != current:
                    yield row()
                    total = np.zeros(width, dtype=np.uint64)
                current = b
                total[np.frombuffer(at.as_py(), dtype=np.uint16)] += np.frombuffer(c.as_py(), dtype=np.uint32)
        if current is not None:
            yield row()

    parts = first.filter("kind = 0").select("bucket", "c0", "c1").repartition("bucket").sortWithinPartitions("bucket")
    out = np.zeros((SLICES, width), dtype=np.uint8)
    for r in parts.mapInArrow(tidy(run), "bucket int, c binary").toLocalIterator():
        out[r["bucket"]] = np.frombuffer(r["c"], dtype=np.uint8)
    return out.reshape(-1)


def copies(first: DataFrame, buckets: int) -> DataFrame:
    """(class, doc, tie, line) of lines whose set stood in the corpus before."""

    def process(key, check, d, t, n, known) -> Iterator[pa.RecordBatch]:
        known, n = known.astype(bool), n.astype(np.int64)
        k, c, dd, tt, nn = key[~known], check[~known], d[~known], t[~known], n[~known]
        order = np.lexsort((nn, *_ties(tt), dd, c, k))
        k, c, dd, tt, nn = k[order], c[order], dd[order], tt[order], nn[order]
        lead = np.ones(len(k), dtype=bool)
        lead[1:] = (k[1:] != k[:-1]) | (c[1:] != c[:-1])
        start = np.flatnonzero(lead)[np.cumsum(lead) - 1] if len(k) else np.zeros(0, np.int64)
        late = ~lead & ~((dd == dd[start]) & (tt == tt[start]) & (nn == nn[start]))
        cls = np.concatenate((check[known], k[late])).astype(np.int64)
        places = [pa.array(np.concatenate((x[known], y[late]))) for x, y in ((d, dd), (t, tt), (n, nn))]
        yield pa.RecordBatch.from_arrays([pa.array(cls), *places], names=["class", "doc", "tie", "line"])

    return materialize(by_bucket(first.filter("kind = 1").drop("kind"), PLACE, buckets, process, GONE), "copies")


#: The key, four words of the sketch, the class, the size, the position of the key, and the place of a set.
POSTING = [np.uint32, *[np.uint64] * 4, np.uint64, np.uint32, np.uint16, np.int64, np.int64, np.uint32]
#: A pair, or a block of a long run.
PAIRS = "xd bigint, xt bigint, xl bigint, yd bigint, yt bigint, yl bigint, far bigint, more boolean, bucket int, block array<binary>"


def _blocks(run: list[np.ndarray], num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Every two blocks of a long run (sorted by size) that may hold similar sets, packed in one row of ``candidates``."""
    n = run[6]
    starts = range(0, len(n), LONG)
    for i, a in enumerate(starts):
        own = slice(a, a + LONG)
        for j in range(i, len(starts)):
            other = slice(starts[j], starts[j] + LONG)
            if int(n[other][0]) * num > int(n[own][-1]) * den:
                break
            with np.errstate(over="ignore"):
                where = mix(run[0][:1].astype(np.uint64) * GOLD + U(i << 24) + U(j))[0] >> U(33)
            data = [(np.concatenate((c[own], c[other])) if j > i else c[own]).tobytes() for c in run]
            columns = [*[pa.nulls(1, pa.int64())] * 7, pa.nulls(1, pa.bool_()), pa.array([int(where)], pa.int32()), pa.array([data], pa.list_(pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns, names=[*X, *Y, "far", "more", "bucket", "block"])


def candidates(docs: DataFrame, codes, num: int, den: int, buckets: int, text: str = "text", undecided: np.ndarray | None = None, tied: bool = False) -> DataFrame:
    """(xd, xt, xl, yd, yt, yl, far, more): an earlier line x that may match a later line y, and how far their sketches are apart.

    ``more``: y has further partners in this run. With ``undecided``, a bitmap of places, all partners of those y.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, table, hot = KeyPacker(buckets), codes.value, Hot()
        for x in _parts(batches):
            # each set once, with its first place of the slice
            order = np.lexsort((x.number, *_ties(x.tie), x.doc, x.cls))
            first = np.flatnonzero(np.append(True, x.cls[order][1:] != x.cls[order][:-1]))
            leads = order[first]
            chosen = np.zeros(len(x.size), dtype=bool)
            chosen[leads[~hot.known(x, leads, np.diff(np.append(first, len(order))))]] = True
            code = table[(x.token & U(BUCKETS - 1)).astype(np.int64)].astype(np.uint64)
            # in each line by rarity, then hash: the same order everywhere
            flat = np.sort((x.flat & ~TOKEN) | code << U(RARE_BITS) | (x.token & U((1 << RARE_BITS) - 1)))
            at = np.arange(len(flat)) - np.repeat(x.first, x.size)
            prefix = np.repeat(np.where(chosen, x.size - (x.size * num + den - 1) // den + 1, 0), x.size)
            keep = (at < prefix) & ((flat & TOKEN) >> U(RARE_BITS) > 0)
            of = x.of[keep]
            token = mix(flat[keep] & TOKEN)
            packer.add(token, *(z[of] for z in x.parity()), x.cls[of], x.size[of].astype(np.uint32), np.minimum(at[keep], 65535).astype(np.uint16), x.doc[of], x.tie[of], x.number[of].astype(np.uint32))
            if packer.full():
                yield from packer.flush()
        yield from packer.flush()

    def process(*postings, whole: bool = False) -> Iterator[pa.RecordBatch]:
        # one entry for each set of a run, with its earliest place
        key, _, _, _, _, cls, n, _, d, t, line = postings
        order = np.lexsort((line, *_ties(t), d, cls, n, key))
        lead = np.ones(len(order), dtype=bool)
        for k in (0, 1, 2, 3, 4, 5, 6):
            c = postings[k][order]
            lead[1:] = (c[1:] != c[:-1]) if k == 0 else lead[1:] | (c[1:] != c[:-1])
        order = order[lead]
        run = [c[order] for c in postings]
        if not whole:
            first = np.flatnonzero(np.append(True, run[0][1:] != run[0][:-1])) if len(run[0]) else np.zeros(0, np.int64)
            size = np.diff(np.append(first, len(run[0])))
            if len(size) and size.max() > LONG:
                for s, k in zip(first[size > LONG], size[size > LONG], strict=True):
                    yield from _blocks([c[s : s + k] for c in run], num, den)
                short = np.repeat(size <= LONG, size)
                run = [c[short] for c in run]
        yield from pairs(*run)

    def pairs(key, p0, p1, p2, p3, cls, n, at, d, t, line) -> Iterator[pa.RecordBatch]:
        n, at = n.astype(np.int64), at.astype(np.int64)
        if undecided is not None:
            ask = in_bitmap(undecided, place(d, t, line))
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        i = np.arange(len(key) - 1)
        step = 1
        while len(i):  # every set against the step-th one after it, as long as the run and the length filter allow
            j = i + step
            ok = (key[j] == key[i]) & (n[j] * num <= n[i] * den)
            i, j = i[ok], j[ok]
            total = n[i] + n[j]
            need = (total * num + num + den - 1) // (num + den)
            hit = 1 + np.minimum(n[i] - at[i], n[j] - at[j]) - 1 >= need
            a, b = i[hit], j[hit]
            far = sum(np.bitwise_count(p[a] ^ p[b]).astype(np.int64) for p in (p0, p1, p2, p3))
            near = far <= total[hit] - 2 * need[hit]
            near &= (d[a] != d[b]) | (t[a] != t[b]) | (line[a] != line[b])
            if near.any():
                a, b = a[near], b[near]
                later = (d[a] > d[b]) | ((d[a] == d[b]) & ((t[a] > t[b]) | ((t[a] == t[b]) & (line[a] > line[b]))))
                x, y = np.where(later, b, a), np.where(later, a, b)
                if undecided is not None:
                    s = ask[y]
                    x, y, near = x[s], y[s], far[near][s]
                else:
                    near = far[near]
                found.append((x, y, near))
            step += 1
            i = i[i + step < len(key)]
        if not found:
            return
        x, y, far = (np.concatenate(c) for c in zip(*found, strict=True))
        more = np.zeros(len(x), dtype=bool)
        if undecided is None:
            order = np.lexsort((line[x], t[x], d[x], far, y))
            x, y, far = x[order], y[order], far[order]
            start = np.flatnonzero(np.diff(y, prepend=-1))
            size = np.diff(np.append(start, len(y)))
            rank = np.arange(len(y)) - np.repeat(start, size)
            more = np.repeat(size > FEW, size)
            k = ~more | (rank < NEAREST)
            x, y, far, more = x[k], y[k], far[k], more[k]
        rows = np.unique(np.column_stack((d[x], t[x], line[x].astype(np.int64), d[y], t[y], line[y].astype(np.int64), far, more.astype(np.int64))), axis=0)
        none = [pa.nulls(len(rows), pa.int32()), pa.nulls(len(rows), pa.list_(pa.binary()))]
        yield pa.RecordBatch.from_arrays([*(pa.array(rows[:, c]) for c in range(7)), pa.array(rows[:, 7] > 0), *none], names=[*X, *Y, "far", "more", "bucket", "block"])

    packed = _rows(docs, text, tied).mapInArrow(tidy(run), packed_schema(len(POSTING)))
    found = materialize(by_bucket(packed, POSTING, buckets, process, PAIRS), "partners")
    near = found.filter("bucket IS NULL").select(*X, *Y, "far", "more")
    blocks = found.filter("bucket IS NOT NULL").select("bucket", *(F.col("block")[k].alias(f"c{k}") for k in range(len(POSTING))))
    if found.filter("bucket IS NOT NULL").select("bucket").isEmpty():
        return near
    rest = by_group(blocks.repartition("bucket"), POSTING, lambda *c: process(*c, whole=True), PAIRS)
    return near.unionByName(rest.select(*near.columns))


def place(doc: np.ndarray, tie: np.ndarray, line: np.ndarray) -> np.ndarray:
    """Where (doc, tie, line) stands in the bitmap of undecided lines."""
    with np.errstate(over="ignore"):
        return (mix((doc.astype(np.uint64) + tie.astype(np.uint64)) * U(0x9FB21C651E98DF25) + line.astype(np.uint64)) & U(BITMAP_BITS - 1)).astype(np.int64)


def places_bitmap(lines: DataFrame) -> np.ndarray:
    """A bitmap of (doc, tie, line): each task's is or-ed into at most its fixed size."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(BITMAP_BITS, dtype=bool)
        for b in batches:
            bits[place(*(b.column(k).to_numpy() for k in range(3)))] = True
        words = np.packbits(bits, bitorder="little").view("<u4")
        w = np.flatnonzero(words)
        if len(w):
            yield pa.RecordBatch.from_arrays([pa.array(w.astype(np.int32)), pa.array(words[w].astype(np.int64))], names=["w", "bits"])

    rows = lines.select("doc", "tie", "line").mapInArrow(tidy(run), "w int, bits bigint").groupBy("w").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(BITMAP_BITS // 32, dtype=np.uint32)
    out[rows.column("w").to_numpy()] = rows.column("bits").to_numpy().astype(np.uint32)
    return out


def lines_of(docs: DataFrame, pairs: DataFrame, text: str = "text", tied: bool = False) -> DataFrame:
    """(doc, tie, line, data) of all lines of ``pairs``: documents sieved by a bitmap, then joined exactly."""
    ends = pairs.select(*X).toDF("doc", "tie", "line").union(pairs.select(*Y))
    wanted = materialize(ends.distinct().groupBy("doc", "tie").agg(F.collect_list("line").alias("lines")), "wanted")
    bits = bitmap(wanted, "doc")

    def sieve(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            part = b.filter(pa.array(in_bitmap(bits, b.column(3).to_numpy())))
            if part.num_rows:
                yield pa.RecordBatch.from_arrays(part.columns[:3], names=["doc", "tie", "data"])

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for d, t, data, lines in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3).to_pylist(), strict=True):
                all_lines = data.as_py().split(b"\n")
                out += [(d, t, n, all_lines[n]) for n in lines if n < len(all_lines)]
            if out:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=["doc", "tie", "line", "data"])

    rows = _rows(docs, text, tied)
    some = rows.withColumn("spot", spot("doc")).mapInArrow(tidy(sieve), "doc bigint, tie bigint, data binary")
    lines = some.join(wanted, ["doc", "tie"]).mapInArrow(tidy(cut), "doc bigint, tie bigint, line bigint, data binary").distinct()
    return materialize(lines, "texts")


def verify(lines: DataFrame, pairs: DataFrame, num: int, den: int) -> DataFrame:
    """(class, doc, tie, line) of the lines y of ``pairs`` that have a similar x, checked on their words."""
    x = lines.toDF(*X, "x")
    y = lines.toDF(*Y, "y")
    both = pairs.select(*X, *Y).join(x, X).join(y, Y).select(*Y, "x", "y")

    def check(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for d, t, n, p, q in zip(*(b.column(k).to_pylist() for k in range(3)), b.column(3), b.column(4), strict=True):
                y = q.as_py()
                own, other = set(p.as_py().split()), set(y.split())
                same = len(own & other)
                if same and den * same >= num * (len(own) + len(other) - same):
                    out.append((y, d, t, n))
            if out:
                y, *at = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (classes_of(list(y)), *at)], names=["class", "doc", "tie", "line"])

    return materialize(both.mapInArrow(tidy(check), GONE).distinct(), "similar")


def removed(docs: DataFrame, num: int = NUM, den: int = DEN, text: str = "text") -> DataFrame:
    """(class, doc, tie, line) of every line to remove."""
    tied, size = survey(docs, text)
    buckets = bucket_count(docs.sparkSession, size)
    first = first_pass(docs, buckets, text, tied)
    gone = copies(first, buckets)
    codes = docs.sparkSession.sparkContext.broadcast(rarity(first))
    keys = [*X, *Y]
    found = candidates(docs, codes, num, den, buckets, text, tied=tied).groupBy(*keys).agg(F.min("far").alias("far"), F.bool_or("more").alias("more"))
    nearest = F.row_number().over(Window.partitionBy(*Y).orderBy("far", *X))
    found = materialize(found.withColumn("rank", nearest), "candidates")
    lines = lines_of(docs, found, text, tied)
    similar = verify(lines, found.filter(F.col("rank") <= FIRST), num, den)
    decided = similar.select("doc", "tie", "line").toDF(*Y)
    rest = found.filter(F.col("rank") > FIRST).join(decided, Y, "left_anti")
    similar = similar.unionByName(verify(lines, rest, num, den))
    decided = similar.select("doc", "tie", "line")
    open_ = found.filter("more").select(*Y).toDF(*decided.columns).distinct().join(decided, decided.columns, "left_anti")
    open_ = materialize(open_, "undecided")
    if not open_.isEmpty():
        rest = candidates(docs, codes, num, den, buckets, text, places_bitmap(open_), tied).select(*keys).distinct().join(found.select(*keys), keys, "left_anti")
        rest = materialize(rest, "candidates")
        similar = similar.unionByName(verify(lines_of(docs, rest, text, tied), rest, num, den))
    return gone.unionByName(similar)


def strip(docs: DataFrame, gone: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the lines ``gone`` (class, doc, tie, line), plus ``n_lines`` and ``n_removed`` (lines with words).

    Where ``docs`` has columns of these names, lines are appended to the new ones' until they differ.
    """
    doc, tie, lost, n_all, n_gone = (fresh(docs.columns, n) for n in ("doc", "tie", "lost", "n_lines", "n_removed"))
    tied = not gone.filter("tie <> 0").isEmpty()
    # a doc_id that one row has says which text is meant; a tie is a hash, so the class of each line is looked at as well
    lines = F.struct("line", "class") if tied else F.struct("line")
    per_doc = gone.groupBy(F.col("doc").alias(doc), F.col("tie").alias(tie)).agg(F.collect_set(lines).alias(lost))
    keyed = docs.withColumns({doc: _doc(), tie: _tie(text, tied)})
    joined = keyed.join(per_doc, [doc, tie], "left").select(*docs.columns, lost)
    at = docs.columns.index(text)
    names = [*docs.columns, n_all, n_gone]
    schema = T.StructType([*docs.schema.fields, T.StructField(n_all, T.LongType()), T.StructField(n_gone, T.LongType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(at).cast(pa.binary()).to_pylist()
            lines = [t.split(b"\n") if t is not None else [] for t in texts]
            n_lines = [sum(1 for x in row if x.strip()) for row in lines]
            lists = b.column(b.num_columns - 1)
            inner = lists.flatten()
            number, cls = inner.field("line").to_pylist(), inner.field("class").to_pylist() if tied else None
            size = np.asarray(lists.value_lengths().fill_null(0))
            asked = [(k, n) for k, n in zip(np.repeat(np.arange(len(size)), size).tolist(), number, strict=True)]
            if tied:
                own = classes_of([lines[k][n] if n < len(lines[k]) else b"" for k, n in asked])
                asked = [kn for kn, c, o in zip(asked, cls, own, strict=True) if c == o]
            drop: list[set[int]] = [set() for _ in texts]
            for k, n in asked:
                if n < len(lines[k]):
                    drop[k].add(n)
            n_removed = [len(x) for x in drop]
            texts = [b"\n".join(x for i, x in enumerate(lines[k]) if i not in drop[k]) if drop[k] else t for k, t in enumerate(texts)]
            columns = list(b.columns[:-1])
            columns[at] = pa.array(texts, pa.binary()).cast(b.column(at).type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n_lines, pa.int64()), pa.array(n_removed, pa.int64())], names=names)

    return joined.mapInArrow(tidy(run), schema)


def dedup(docs: DataFrame, num: int = NUM, den: int = DEN) -> DataFrame:
    """Pipeline form: the documents with their remaining lines and new ``n_chars``; those that lost all lines go."""
    n_all, n_gone = (fresh(docs.columns, n) for n in ("n_lines", "n_removed"))
    out = strip(docs, removed(docs, num, den)).filter((F.col(n_gone) == 0) | (F.col(n_gone) < F.col(n_all))).drop(n_all, n_gone)
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast(kind)))
    return out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lensmill.llm.common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return strip(docs, removed(docs)).select("doc_id", "n_lines", "n_removed", "text")
