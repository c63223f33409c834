"""Operator 4: byte-level BPE encoding and decoding with the tokenizers library, over Arrow batches.

A rank file (base64 token, rank) becomes a ``tokenizers`` BPE model: every byte is written as one printable character
(the byte-to-character table), merges are derived from the ranks, a word that is itself a token is taken whole, and
words are split by the given pattern. Ids equal those of a rank-based encoder.

Offsets. A token's length in bytes is a table lookup, so byte offsets are a running sum and character offsets are the
count of UTF-8 start bytes before them. A token may begin or end inside a character (``split``): it then carries the
offsets of that whole character. Decoding reverses the byte table token by token and joins bytes before any character
is formed, so characters split over tokens, batches of ids or cut sequences come back exactly; ``stream_decode`` does
it piecewise, holding back the bytes of an unfinished character.

Memory is bounded: a task holds one Arrow batch and encodes it in slices of ``SLICE_BYTES`` or a single text, whichever
is longer. A task has no state, so lost executors only cost their tasks.

Defined results: a null text counts as empty; an empty text has no ids; invalid UTF-8 is replaced by U+FFFD before
encoding, as Spark's own decoding does; rows are independent, so repeated rows and ties do not matter; extra columns are
kept by ``encode`` and its own are ``ids`` and ``offsets``.
"""

from __future__ import annotations

import base64
import hashlib
import os
import sys
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lensmill.llm.common import bounded_batches, fresh, text_or_empty, tidy

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SLICE_BYTES = 1 << 20
#: Pieces that a process remembers, and the characters of the longest of them: so its memory is bounded in bytes.
PIECES, REMEMBERED = 60_000, 64
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def byte_characters() -> list[str]:
    """The printable character of each byte: itself where it is printable, else the next free code point from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, spare = [], 256
    for b in range(256):
        if b in printable:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return out


class ByteBPE:
    """Ranks, the tokenizer built from them, and the reversed byte table.

    Texts are cut by the pattern, and each piece goes through the tokenizer once as long as it is remembered: a bounded
    memory of pieces and their ids spares most of the work, as texts repeat their words.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex
        from tokenizers import Tokenizer, models

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        to_char = byte_characters()
        spell = lambda t: "".join(to_char[b] for b in t)
        merges = []
        for token, rank in ranks.items():
            splits = [(token[:i], token[i:]) for i in range(1, len(token))]
            merges += [(rank, ranks[a], ranks[b], a, b) for a, b in splits if a in ranks and b in ranks]
        merges.sort(key=lambda m: m[:3])
        model = models.BPE(vocab={spell(t): r for t, r in ranks.items()}, merges=[(spell(a), spell(b)) for *_, a, b in merges], ignore_merges=True)
        self.tokenizer = Tokenizer(model)
        self.spelling = str.maketrans({chr(b): c for b, c in enumerate(to_char)})
        self.split = regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}
        from_char = {c: b for b, c in enumerate(to_char)}
        vocab = self.tokenizer.get_vocab()
        self.token_bytes: list[bytes] = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.token_bytes[i] = bytes(from_char[c] for c in token)
        self.lengths = np.array([len(t) for t in self.token_bytes], dtype=np.int64)

    @staticmethod
    def from_file(path: str, pattern: str) -> ByteBPE:
        """One for each Python process: a worker that is used again keeps its tables and its pieces."""
        kept = sys.__dict__.setdefault("_lensmill_byte_bpe", {})
        if (path, pattern) not in kept:
            kept[path, pattern] = ByteBPE.read(path, pattern)
        return kept[path, pattern]

    @staticmethod
    def read(path: str, pattern: str) -> ByteBPE:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}
        return ByteBPE(ranks, pattern)

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text, as unsigned 32-bit numbers."""
        part, size = [], 0
        for text in texts:
            part.append(text)
            size += len(text)
            if size >= SLICE_BYTES:
                yield from self._encode(part)
                part, size = [], 0
        yield from self._encode(part)

    def _encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        cut = [self.split(t) for t in texts]
        if len(self.known) > PIECES:
            self.known.clear()
        known = self.known
        new = {p for pieces in cut for p in pieces if p not in known}
        tokens = self.tokenizer.model.tokenize
        for p in new:
            spelled = p.encode().decode("latin-1").translate(self.spelling)
            known[p] = np.array([t.id for t in tokens(spelled)], dtype=np.uint32).tobytes()
        out = [np.frombuffer(b"".join(map(known.__getitem__, pieces)), dtype=np.uint32) for pieces in cut]
        for p in new:
            if len(p) > REMEMBERED:
                del known[p]
        yield from out

    def offsets(self, ids: np.ndarray, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(byte starts, first character, end character, whether a character is split) of each token of ``data``."""
        ends = np.cumsum(self.lengths[ids])
        starts = ends - self.lengths[ids]
        lead = (np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80
        before = np.concatenate(([0], np.cumsum(lead)))  # characters begun before each byte
        whole = np.concatenate((lead, [True]))  # a character begins at this byte, or the text ends
        first = np.where(whole[starts], before[starts], before[starts] - 1)
        return starts, first, before[ends], ~(whole[starts] & whole[ends])

    def decode(self, ids: Iterable[int]) -> bytes:
        table = self.token_bytes
        return b"".join([table[i] for i in ids])

    def stream_decode(self, ids: Iterable[int]) -> Iterator[str]:
        """Text as soon as its characters are complete."""
        import codecs

        decoder = codecs.getincrementaldecoder("utf-8")("replace")
        for i in ids:
            if text := decoder.decode(self.token_bytes[i]):
                yield text
        if text := decoder.decode(b"", True):
            yield text


def _setting(df: DataFrame, path: str | None, pattern: str | None) -> tuple[str, str]:
    import public_tokenizers

    bounded_batches(df.sparkSession)

    return path or public_tokenizers.path(VOCABULARY), pattern or public_tokenizers.PATTERN


def _texts(column: pa.Array) -> list[str]:
    return [b.decode("utf-8", "replace") for b in column.to_pylist()]


TOKENS = T.ArrayType(T.LongType(), False)
OFFSETS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("split", T.BooleanType())]))


def encode(docs: DataFrame, text: str = "text", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``docs`` with ``ids`` and ``offsets`` (characters start to end, and whether the token splits a character).

    Where ``docs`` has columns of these names, lines are appended to the new ones' until they differ; so in ``decode``.
    """
    path, pattern = _setting(docs, path, pattern)
    new = [fresh(docs.columns, n) for n in ("ids", "offsets")]
    schema = T.StructType([*docs.schema.fields, T.StructField(new[0], TOKENS), T.StructField(new[1], OFFSETS)])
    data = docs.withColumn(fresh(docs.columns, "data"), text_or_empty(text).cast("binary"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBPE.from_file(path, pattern)
        for batch in batches:
            at = batch.num_columns - 1
            texts = _texts(batch.column(at))
            ids, starts, ends, splits = [], [], [], []
            for t, i in zip(texts, bpe.encode(texts), strict=True):
                _, a, b, s = bpe.offsets(i, t.encode())
                ids.append(i)
                starts.append(a)
                ends.append(b)
                splits.append(s)
            cuts = pa.array(np.concatenate(([0], np.cumsum([len(i) for i in ids]))).astype(np.int32))
            flat = lambda x, t: pa.array(np.concatenate(x) if x else np.array([]), type=t)
            spans = pa.StructArray.from_arrays([flat(starts, pa.int64()), flat(ends, pa.int64()), flat(splits, pa.bool_())], ["start", "end", "split"])
            columns = [*batch.columns[:at], pa.ListArray.from_arrays(cuts, flat(ids, pa.int64())), pa.ListArray.from_arrays(cuts, spans)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:at], *new])

    return data.mapInArrow(tidy(run), schema)


def decode(tokens: DataFrame, ids: str = "ids", out: str = "decoded", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``tokens`` with the binary column ``out``: the bytes of the ids; null ids give no bytes."""
    path, pattern = _setting(tokens, path, pattern)
    out = fresh(tokens.columns, out)
    schema = T.StructType([*tokens.schema.fields, T.StructField(out, T.BinaryType())])
    at = tokens.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBPE.from_file(path, pattern)
        for batch in batches:
            found = pa.array([bpe.decode(i or ()) for i in batch.column(at).to_pylist()], type=pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*batch.schema.names, out])

    return tokens.mapInArrow(tidy(run), schema)


def digests(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, n_split: ids go through encoder and decoder without leaving the task."""
    path, pattern = _setting(docs, path, pattern)
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, n_split_characters bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBPE.from_file(path, pattern)
        for batch in batches:
            texts = _texts(batch.column(1))
            n, sha, back, split = [], [], [], []
            for t, ids in zip(texts, bpe.encode(texts), strict=True):
                n.append(len(ids))
                sha.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                back.append(hashlib.sha256(bpe.decode(ids.tolist())).hexdigest())
                split.append(int(bpe.offsets(ids, t.encode())[3].sum()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(sha, pa.string()), pa.array(back, pa.string()), pa.array(split, pa.int64())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_split_characters"])

    return docs.select("doc_id", text_or_empty("text").cast("binary").alias("data")).mapInArrow(tidy(run), schema)


def tokens_and_digests(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Pipeline form: doc_id, source, ids, n_tokens and decoded_sha256, the digest of what the ids decode to."""
    path, pattern = _setting(docs, path, pattern)
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = f"doc_id {kinds['doc_id']}, source {kinds['source']}, ids array<int>, n_tokens bigint, decoded_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBPE.from_file(path, pattern)
        for batch in batches:
            for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                ids = list(bpe.encode(_texts(part.column(2))))
                back = [hashlib.sha256(bpe.decode(i.tolist())).hexdigest() for i in ids]
                sizes = [len(i) for i in ids]
                cuts = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
                lists = pa.ListArray.from_arrays(cuts, pa.array(np.concatenate(ids).astype(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), lists, pa.array(sizes, pa.int64()), pa.array(back, pa.string())], names=["doc_id", "source", "ids", "n_tokens", "decoded_sha256"])

    return docs.select("doc_id", "source", text_or_empty("text").cast("binary").alias("data")).mapInArrow(tidy(run), schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lensmill.llm.common import table

    return digests(table(spark, sf_dir, "documents"))
