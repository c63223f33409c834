"""Operator 7: media columns of interleaved documents.

HTML is parsed into one ordered sequence of items per document: text, or a reference to media by digest
(``urn:sha256:...``) with its caption. A figure's caption, before or after its media, goes to all of them; without media,
or outside a figure, it is text; one that is never closed ends with its figure or the document. Runs of HTML white
space are one space. Scripts and styles are no content, nor what a title, noscript or template holds, if it is closed.
Media live once, in a content-addressed table (digest, stored bytes); a join on
the digest resolves references, and every item keeps its position and caption whether or not its media are found.

The stored form is a grey PNG of 64 columns: a payload padded with zero bytes to a positive multiple of 64 is its
samples, so storing is lossless. Reading back checks every chunk's CRC, the samples' size and the digest.

Scale: payloads are packed where the document is read and written once to the shared folder; features are computed
where the media are read back. Only narrow rows (digest, features; doc_id, position, digest) are shuffled, and Spark may
split the references of a digest that a third of all documents share, as that side needs no grouping. A task holds one
Arrow batch; it skips media it has just written (a bounded memory of digests) and the join tolerates repeats.

Defined results: null html or text counts as empty (an empty sequence; a payload of 64 zero bytes); a reference
without media keeps null features; equal payloads give equal values; repeated doc_ids give independent sequences;
``interleave`` keeps the input's columns and adds ``items``.
"""

from __future__ import annotations

import hashlib
import html as htmllib
import re
import struct
import sys
import zlib
from collections.abc import Iterable, Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lensmill.llm.common import bounded_batches, fresh, materialize, text_or_empty, tidy

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WIDTH = 64
MAGIC = b"\x89PNG\r\n\x1a\n"
URN = "urn:sha256:"
SEEN = 100_000
BLOCKS = frozenset("p div article section h1 h2 h3 h4 h5 h6 li ul ol table tr blockquote figure figcaption br pre header footer main nav aside body".split())
#: What these hold is no content once they are closed; one that is never closed hides nothing.
SILENT = frozenset(("template", "noscript", "title"))
RAW = frozenset(("script", "style"))
HTML_SPACE = re.compile(r"[ \t\n\r\f]+")

ITEM = "struct<position:int,kind:string,text:string,src:string,digest:string,caption:string>"


class _Figure:
    """An open figure: where its items begin, where its caption stands, and the caption's text so far."""

    def __init__(self, start: int) -> None:
        self.start, self.at, self.caption, self.open = start, start, [], False


class _Sequence(HTMLParser):
    """Text between block elements, and media references, in document order."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.items: list[dict] = []
        self.buffer: list[str] = []
        self.raw = False
        self.hidden: list[tuple] = []
        self.figures: list[_Figure] = []
        self.captioned: set[int] = set()

    def _flush(self) -> None:
        text = HTML_SPACE.sub(" ", "".join(self.buffer)).strip(" ")
        self.buffer = []
        if text:
            self.items.append(self._item(kind="text", text=text))

    def _item(self, **item) -> dict:
        return {"position": 0, "kind": None, "text": None, "src": None, "digest": None, "caption": None} | item

    def _in_caption(self) -> bool:
        return bool(self.figures) and self.figures[-1].open

    def _block(self) -> None:
        self._flush()
        if self._in_caption() and self.figures[-1].caption[-1:] != [" "]:
            self.figures[-1].caption.append(" ")

    def _end_figure(self) -> None:
        """The caption goes to all media of the figure that a figure within has not captioned; without any it is text."""
        figure = self.figures.pop()
        text = HTML_SPACE.sub(" ", "".join(figure.caption)).strip(" ")
        if not text:
            return
        media = [i for i in self.items[figure.start :] if i["kind"] != "text" and id(i) not in self.captioned]
        for item in media:
            item["caption"] = text
            self.captioned.add(id(item))
        if not media:
            self.items.insert(figure.at, self._item(kind="text", text=text))

    def _hide(self, tag: str) -> None:
        """What comes from here on goes if ``tag`` is closed."""
        captions = [len(f.caption) for f in self.figures]
        self.hidden.append((tag, len(self.items), list(self.buffer), captions))

    def _unhide(self, tag: str) -> None:
        """Back to where the innermost open ``tag`` began; what was opened within it goes too."""
        while self.hidden:
            name, n, buffer, captions = self.hidden.pop()
            if name == tag:
                del self.items[n:], self.figures[len(captions) :]
                self.buffer = buffer
                for f, size in zip(self.figures, captions, strict=False):
                    del f.caption[size:]
                return

    def handle_starttag(self, tag: str, attrs) -> None:
        self.raw = tag in RAW
        if tag in SILENT:
            self._hide(tag)
        if tag in BLOCKS:
            self._block()
        if tag == "figure":
            self.figures.append(_Figure(len(self.items)))
        if tag == "figcaption" and self.figures:
            figure = self.figures[-1]
            if not figure.caption:
                figure.at = len(self.items)
            figure.caption.append(" ")
            figure.open = True
        if tag in ("img", "video", "audio", "source"):
            self._flush()
            a = dict(attrs)
            src = a.get("src")
            if src:
                digest = src[len(URN) :].lower() if src.lower().startswith(URN) else None
                self.items.append(self._item(kind={"img": "image"}.get(tag, tag), src=src, digest=digest, caption=a.get("alt")))

    def handle_endtag(self, tag: str) -> None:
        if tag in RAW:
            self.raw = False
        if any(h[0] == tag for h in self.hidden):
            self._unhide(tag)
        if tag in BLOCKS:
            self._block()
        if tag == "figcaption" and self.figures:
            self.figures[-1].open = False
        if tag == "figure" and self.figures:
            self._end_figure()

    def handle_data(self, data: str) -> None:
        if self.raw:
            return
        (self.figures[-1].caption if self._in_caption() else self.buffer).append(data)

    def finish(self) -> list[dict]:
        self.close()
        self._flush()
        while self.figures:
            self._end_figure()
        for k, item in enumerate(self.items):
            item["position"] = k
        return self.items


def parse(page: str | None) -> list[dict]:
    """The items of one document."""
    p = _Sequence()
    p.feed(page or "")
    return p.finish()


def pad(data: bytes) -> bytes:
    """Zero bytes up to a positive multiple of 64."""
    return data + bytes(-len(data) % WIDTH or (0 if data else WIDTH))


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def pack(payload: bytes) -> bytes:
    """The PNG whose samples are the payload."""
    rows = np.zeros((len(payload) // WIDTH, WIDTH + 1), dtype=np.uint8)  # each row begins with filter 0: none
    rows[:, 1:] = np.frombuffer(payload, dtype=np.uint8).reshape(-1, WIDTH)
    head = struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0)
    return MAGIC + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(rows.tobytes(), 6)) + _chunk(b"IEND", b"")


def unpack(stored: bytes) -> bytes:
    """The samples of a PNG made by ``pack``; raises if a byte is wrong."""
    if stored[:8] != MAGIC:
        raise ValueError("not a PNG")
    at, head, data = 8, None, []
    while at < len(stored):
        n, kind = struct.unpack_from(">I4s", stored, at)
        body = stored[at + 8 : at + 8 + n]
        if struct.pack(">I", zlib.crc32(kind + body)) != stored[at + 8 + n : at + 12 + n]:
            raise ValueError("a chunk is damaged")
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"IDAT":
            data.append(body)
        at += 12 + n
    if head is None or head[0] != WIDTH or head[2:4] != (8, 0):
        raise ValueError("not 8-bit grey of 64 columns")
    rows = np.frombuffer(zlib.decompress(b"".join(data)), dtype=np.uint8).reshape(head[1], WIDTH + 1)
    if rows[:, 0].any():
        raise ValueError("a row is filtered")
    return rows[:, 1:].tobytes()


def features(payload: bytes) -> str:
    """Height, sum of samples and their distribution over 16 bands."""
    s = np.frombuffer(payload, dtype=np.uint8)
    bands = np.bincount(s >> 4, minlength=16)
    return f"gray {WIDTH}x{len(s) // WIDTH} sum {int(s.sum(dtype=np.int64))} bands {'.'.join(map(str, bands))}"


def interleave(docs: DataFrame, html: str = "html") -> DataFrame:
    """``docs`` with ``items``: the ordered text and media references of the HTML; ``items_`` if there are ``items``, and so on."""
    bounded_batches(docs.sparkSession)
    out = fresh(docs.columns, "items")
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T._parse_datatype_string(f"array<{ITEM}>"))])
    at = docs.columns.index(html)
    kind = pa.list_(pa.struct([("position", pa.int32()), *[(n, pa.string()) for n in ("kind", "text", "src", "digest", "caption")]]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = pa.array([parse(x) for x in b.column(at).to_pylist()], type=kind)
            yield pa.RecordBatch.from_arrays([*b.columns, found], names=[*b.schema.names, out])

    return docs.mapInArrow(tidy(run), schema)


def resolve(items: DataFrame, media: DataFrame, key: str = "digest") -> DataFrame:
    """``items`` (one row per item, with ``key``) joined to ``media`` (one row per digest); all items stay.

    Neither side is grouped, so a digest with many references can be split over tasks.
    """
    return items.join(media, key, "left")


def store(docs: DataFrame) -> DataFrame:
    """Pack every document's text and parse its page: doc_id, n_bytes, items (texts as lengths), digest, media.

    Written once to the shared folder; ``media`` is null where the same task has just written that digest.
    """
    bounded_batches(docs.sparkSession)
    schema = "doc_id bigint, n_bytes bigint, items array<struct<position:int,kind:string,chars:bigint,digest:string,caption:string>>, digest string, media binary"
    kind = pa.list_(pa.struct([("position", pa.int32()), ("kind", pa.string()), ("chars", pa.int64()), ("digest", pa.string()), ("caption", pa.string())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, None] = {}
        for b in batches:
            ids = b.column(0).to_pylist()
            out, size = [], 0
            for k, data in enumerate(b.column(1)):
                data = data.as_py()
                payload = pad(data)
                digest = hashlib.sha256(payload).hexdigest()
                text = htmllib.escape(data.decode("utf-8", "replace"), quote=False)
                page = f'<article><p>{text}</p><figure><img src="{URN}{digest}" alt="text as samples"><figcaption>{len(data)} bytes</figcaption></figure></article>'
                items = [{"position": i["position"], "kind": i["kind"], "chars": len(i["text"] or ""), "digest": i["digest"], "caption": i["caption"]} for i in parse(page)]
                media = None if digest in seen else pack(payload)
                seen[digest] = None
                if len(seen) > SEEN:
                    del seen[next(iter(seen))]
                out.append((ids[k], len(data), items, digest, media))
                size += len(media or b"")
                if size > 8 << 20 or k + 1 == len(ids):
                    columns = zip(zip(*out, strict=True), (pa.int64(), pa.int64(), kind, pa.string(), pa.binary()), strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], names=["doc_id", "n_bytes", "items", "digest", "media"])
                    out, size = [], 0

    return materialize(docs.select("doc_id", text_or_empty("text").cast("binary").alias("data")).mapInArrow(tidy(run), schema), "media")


def read_back(media: DataFrame) -> DataFrame:
    """digest and what is computed from the stored bytes, one row per digest."""
    schema = "digest string, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, samples string"
    types = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for digest, stored in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                stored = stored.as_py()
                payload = unpack(stored)
                sha = hashlib.sha256(payload).hexdigest()
                if sha != digest:
                    raise ValueError(f"media {digest} does not match its digest")
                rows.append((digest, len(payload), sha, zlib.crc32(payload[-WIDTH:]), len(stored), hashlib.sha256(stored).hexdigest(), features(payload)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=[x.split()[0] for x in schema.split(", ")])

    rows = media.filter("media IS NOT NULL").select("digest", "media").mapInArrow(tidy(run), schema)
    rest = [c for c in rows.columns if c != "digest"]
    return rows.groupBy("digest").agg(F.min(F.struct(*rest)).alias("m")).select("digest", "m.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as media beside its text; and of the page of the same id, read by ``interleave``, what it holds."""
    from lensmill.llm.common import table

    stored = store(table(spark, sf_dir, "documents"))
    described = lambda i: F.concat(i["kind"], F.lit("@"), i["position"].cast("string"), F.lit(":"), i["chars"].cast("string"), F.lit(":"), F.coalesce(i["caption"], F.lit("")))
    sequence = F.array_join(F.transform("items", described), ",")
    refs = stored.select("doc_id", "n_bytes", F.explode(F.filter("items", lambda i: i["digest"].isNotNull())).alias("ref"), sequence.alias("sequence"))
    refs = refs.select("doc_id", "n_bytes", F.col("ref.digest").alias("digest"), "sequence")
    pages = interleave(table(spark, sf_dir, "pages").select("page_id", "html"))
    of_kind = lambda kind: F.size(F.filter("items", lambda i: (i["kind"] == "text") == F.lit(kind == "text"))).cast("bigint")
    whole = F.sha2(F.array_join(F.transform("items", lambda i: F.concat_ws("|", i["kind"], i["position"].cast("string"), i["text"], i["src"], i["caption"])), "\n"), 256)
    # a page_id that occurs more than once has the smallest reading
    pages = pages.select("page_id", F.struct(of_kind("text").alias("page_texts"), of_kind("media").alias("page_media"), whole.alias("page_sha256")).alias("p"))
    pages = pages.groupBy(F.col("page_id").alias("doc_id")).agg(F.min("p").alias("p"))
    out = resolve(refs, read_back(stored)).join(pages, "doc_id", "left")
    feature = F.concat_ws("; ", "samples", "sequence").alias("feature")
    return out.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", feature, "p.*")
