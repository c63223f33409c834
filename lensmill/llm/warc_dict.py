"""Operator 3: WARC writer with a dictionary for Zstandard, one per archive file, and its reader.

An archive is a ``.warc.zst`` file: first a skippable frame (magic 0x184D2A5D) that holds the dictionary, then one
frame for each record, compressed on its own with that dictionary, so that a record is read by seeking to its frame.
The dictionary is trained on a bounded sample of the records of its file (``SAMPLE_BYTES``); it only affects sizes.

Deduplication: of records with equal payloads (by SHA-1) of at least ``min_revisit_bytes`` bytes, the one with the
smallest page_id is a ``response``; the others are ``revisit`` records that refer to it and carry no payload.
Digests are counted with partial aggregation, so a payload that a third of all rows share costs one row per task, and
only narrow rows (page_id, digest) meet again to find the revisits; payloads move once, dealt by page_id.

Recovery: a task writes each archive under a name of its own attempt and lists it in its output rows, the manifest.
Only manifest rows of tasks that ended well are kept, so files of a lost attempt are never read. A writer holds at most
``FILE_BYTES`` of payloads or one record.

Defined results: null html is an empty payload; an empty table writes no archive; equal rows with equal page_id are
separate records (the repeats are revisits of the same page_id); a null page_id is written as an empty id and is last
among equals; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import sys
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lensmill.llm.common import bounded_batches, scratch, text_or_empty, tidy

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SKIPPABLE = 0x184D2A5D
#: Raw bytes of a file, of what is held to train its dictionary, and of what is read at a time.
FILE_BYTES, HELD_BYTES, CHUNK_BYTES = 1 << 30, 12 << 20, 4 << 20
SAMPLE_BYTES = 2 << 20
DICT_BYTES = 112 << 10
LEVEL = 3
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"


def digest_base32(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def record_id(page_id) -> str:
    return f"<urn:lensmill:page:{'' if page_id is None else page_id}>"


def page_of(urn: str | None) -> int | None:
    digits = (urn or "").strip("<>").rpartition(":")[2]
    return int(digits) if digits else None


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to=None, revisit: bool = False) -> bytes:
    """One WARC/1.1 record. A revisit has no payload; its length goes to a header of its own."""
    http = HTTP % len(payload)
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {DATE}",
        "WARC-Target-URI: " + (url or "").replace("\r", "%0D").replace("\n", "%0A"),
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Payload-Length: {len(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        head[2:2] = [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """Headers, HTTP block and payload of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    headers = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    block = rest[: int(headers["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("record is cut")
    return {"headers": headers, "payload": block.partition(b"\r\n\r\n")[2]}


def train(records: list[bytes]):
    """A dictionary from the records, or None where they are too few to train one."""
    import zstandard as z

    sample, size = [], 0
    step = max(1, sum(map(len, records)) // SAMPLE_BYTES)  # every step-th record, from all parts of the file
    for r in records[::step]:
        sample.append(r[: 128 << 10])
        size += len(sample[-1])
        if size >= SAMPLE_BYTES:
            break
    try:
        return z.train_dictionary(min(DICT_BYTES, max(1024, size // 8)), sample)
    except z.ZstdError:
        return None


class Writer:
    """Writes one .warc.zst file to a stream: its first records are held to train the dictionary, the others pass through."""

    def __init__(self, out) -> None:
        self.out, self.held, self.packer, self.raw, self.size, self.records = out, [], None, 0, 0, 0

    def add(self, record: bytes) -> None:
        self.raw += len(record)
        self.records += 1
        if self.packer is None:
            self.held.append(record)
            if self.raw >= HELD_BYTES:
                self._begin()
        else:
            self._write(self.packer.compress(record))

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def _begin(self) -> None:
        import zstandard as z

        dictionary = train(self.held)
        packed = z.ZstdCompressor(level=9).compress(dictionary.as_bytes()) if dictionary else b""
        own = {"dict_data": dictionary} if dictionary else {}
        self.packer = z.ZstdCompressor(level=LEVEL, write_checksum=True, write_content_size=True, **own)
        self._write(struct.pack("<II", SKIPPABLE, len(packed)) + packed)
        for r in self.held:
            self._write(self.packer.compress(r))
        self.held = []

    def finish(self) -> None:
        if self.packer is None:
            self._begin()


def archive(records: list[bytes]) -> bytes:
    """The bytes of one .warc.zst file."""
    out = io.BytesIO()
    w = Writer(out)
    for r in records:
        w.add(r)
    w.finish()
    return out.getvalue()


def read_archive(stream) -> Iterator[bytes]:
    """The records of one file (a binary stream, or its bytes), frame by frame: a frame and a chunk are in memory."""
    import zstandard as z

    f = io.BytesIO(stream) if isinstance(stream, bytes) else stream
    magic, n = struct.unpack("<II", f.read(8))
    if magic != SKIPPABLE:
        raise ValueError("no dictionary frame")
    packed = f.read(n)
    d = z.ZstdDecompressor(dict_data=z.ZstdCompressionDict(z.ZstdDecompressor().decompress(packed))) if n else z.ZstdDecompressor()
    data, at = b"", 0
    while True:
        end = frame_end(data, at)
        if end is not None:
            yield d.decompress(memoryview(data)[at:end])
            at = end
            continue
        more = f.read(CHUNK_BYTES)
        if not more:
            if at < len(data):
                raise ValueError("frame is cut")
            return
        data, at = data[at:] + more, 0


def frame_end(data: bytes, at: int) -> int | None:
    """Where the Zstandard frame that begins at ``at`` ends: its block headers say how long they are. None: not in ``data``."""
    import zstandard as z

    head = data[at : at + 18]
    if len(head) < 18 and len(head) < (z.frame_header_size(head) if len(head) > 5 else 6):
        return None
    checksum = z.get_frame_parameters(head).has_checksum
    at += z.frame_header_size(head)
    while at + 3 <= len(data):
        block = int.from_bytes(data[at : at + 3], "little")
        at += 3 + (1 if block >> 1 & 3 == 1 else block >> 3)
        if block & 1:
            end = at + 4 * checksum
            return end if end <= len(data) else None
    return None


def _open(path: str):
    """(file system, path in it) for any address that pyarrow knows: a local or mounted folder, HDFS or an object store."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def plan(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, sha1, refers_to, revisit: every page with its role."""
    one = F.concat(F.coalesce(F.col("page_id").cast("string"), F.lit("~")), F.col("sha1")).alias("one")
    keyed = pages.select("page_id", "url", text_or_empty("html").cast("binary").alias("payload")).withColumn("sha1", F.sha1("payload")).select("*", one)
    # repeats of one (page_id, digest) are one row here
    narrow = keyed.filter(F.octet_length("payload") >= min_revisit_bytes).groupBy("one", "sha1", "page_id").agg(F.count("*").alias("n"))
    first = narrow.groupBy("sha1").agg(F.min("page_id").alias("first"), F.sum("n").alias("n")).filter("n > 1").select("sha1", "first")
    again = narrow.join(first, "sha1").select("one", "first")
    # rows without a page_id are never the response of others, so each is a group of its own
    alone = F.when(F.col("page_id").isNull(), F.monotonically_increasing_id()).alias("alone")
    roles = keyed.join(again, "one", "left").select("*", alone)
    # of rows that repeat the response's own page_id the first is the response; the rows are equal, so any will do
    turn = F.row_number().over(Window.partitionBy("one", "alone").orderBy("one"))
    revisit = F.col("first").isNotNull() & ~((turn == 1) & F.col("page_id").eqNullSafe(F.col("first")))
    return roles.select("page_id", "url", "payload", "sha1", "first", revisit.alias("revisit")).select(
        "page_id", "url", "payload", "sha1", F.when(F.col("revisit"), F.col("first")).alias("refers_to"), "revisit"
    )


def write(pages: DataFrame, to: str, min_revisit_bytes: int = 0, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the archives under ``to`` and return their manifest (path, records, bytes), itself kept in ``to``/manifest.

    A file ends after ``file_bytes`` raw bytes or with its task; a task holds ``HELD_BYTES`` of records.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _open(to)
        fs.create_dir(base, recursive=True)
        attempt, count, f, w = uuid.uuid4().hex, 0, None, None

        def done() -> pa.RecordBatch:
            w.finish()
            f.close()
            return pa.RecordBatch.from_pydict({"path": [f"{to}/{attempt}-{count:05d}.warc.zst"], "records": [w.records], "bytes": [w.size], "raw_bytes": [w.raw]})

        for batch in batches:
            columns = batch.columns
            for i in range(batch.num_rows):
                page, url, payload, sha1, refers, revisit = (c[i].as_py() for c in columns)
                if w is None:
                    f = fs.open_output_stream(f"{base}/{attempt}-{count:05d}.warc.zst", compression=None)
                    w = Writer(f)
                w.add(record(page, url, payload, digest_base32(bytes.fromhex(sha1)), refers, revisit))
                if w.raw >= file_bytes:
                    yield done()
                    count, w = count + 1, None
        if w is not None:
            yield done()

    bounded_batches(pages.sparkSession)
    manifest = f"{to}/manifest"
    plan(pages, min_revisit_bytes).mapInArrow(tidy(run), "path string, records bigint, bytes bigint, raw_bytes bigint").write.parquet(manifest)
    return pages.sparkSession.read.parquet(manifest)


def read(manifest: DataFrame) -> DataFrame:
    """Every record of the archives in ``manifest``: page_id, url, record_type, payload, payload_bytes, payload_digest, refers_to."""
    schema = "page_id bigint, url string, payload binary, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
    names = [x.split()[0] for x in schema.split(", ")]
    types = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, name = _open(path)
                rows, size = [], 0
                for r in read_archive(fs.open_input_stream(name, compression=None)):
                    x = parse(r)
                    h, payload = x["headers"], x["payload"]
                    revisit = h["WARC-Type"] == "revisit"
                    digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
                    if not revisit and (digest_base32(hashlib.sha1(payload).digest()) != digest or len(payload) != int(h["WARC-Payload-Length"])):
                        raise ValueError(f"payload of {h['WARC-Record-ID']} does not match its digest")
                    rows.append((page_of(h["WARC-Record-ID"]), h["WARC-Target-URI"], None if revisit else payload, int(h["WARC-Payload-Length"]), digest, h["WARC-Type"], page_of(h.get("WARC-Refers-To"))))
                    size += len(payload)
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    n = max(1, manifest.count())
    return manifest.select("path").repartition(n).mapInArrow(tidy(run), schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lensmill.llm.common import table

    manifest = write(table(spark, sf_dir, "pages"), scratch(spark, "warc"))
    return read(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h, row_number() OVER (PARTITION BY coalesce(html, '') ORDER BY page_id NULLS LAST) AS k,
         min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first, sha1(coalesce(html, '')) AS s
  FROM pages
)
SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST(1 + ((CAST('0x' || substr(s, CAST(1 + 10 * (i // 8) AS BIGINT), 10) AS BIGINT) >> CAST(35 - 5 * (i % 8) AS INTEGER)) & 31) AS BIGINT), 1)), '') AS payload_digest,
       CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN k > 1 THEN first END AS refers_to
FROM p
"""
