"""Interleaved document sequences with media columns.

parse_sequences() turns HTML into an ordered array of structs (pos, kind, text, ref, caption): text
blocks and media references as they stand on the page. store_media() keeps payloads losslessly as
8-bit grey PNG images, one row per digest; media_features() reads the stored bytes back.
resolve() joins the references, and only these, to stored media by digest and puts them back into their sequences
by row and position, so that order and captions stay.

document_media() makes a page of each document: its lines as paragraphs, and between them the whole text's
payload as a figure, with the line before it as its caption. The page is parsed, the reference is resolved by its
digest, and the row tells where in the sequence the medium stands.

Defined cases: null or empty HTML gives an empty sequence; a reference whose digest is unknown keeps
its place with a null media struct; an empty payload is one block of zeros; equal payloads are
stored once, so ties share a medium; repeated rows, and rows that share an id, are sequences of their own; an empty
table gives an empty one; other columns are not read. A digest that very many documents refer to is one small row of
features; the join's other side can be split by AQE, as nothing after it needs the key together.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections.abc import Iterator, Sequence
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import materialise

BLOCK = 64
SCHEME = "sha256:"
#: Characters of a caption, at most.
CAPTION = 80
#: Fixed values of the PNG format.
PNG_SIGNATURE = b"\x89PNG\r\n\x1a\n"

ITEM = T.StructType([T.StructField("pos", T.IntegerType()), T.StructField("kind", T.StringType()), T.StructField("text", T.StringType()), T.StructField("ref", T.StringType()), T.StructField("caption", T.StringType())])
_BREAKS = frozenset("p div br li ul ol h1 h2 h3 h4 h5 h6 table tr td th section article figure figcaption blockquote pre hr".split())
_SILENT = frozenset("script style title noscript template".split())


class _Sequencer(HTMLParser):
    """Text blocks and media references in page order."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.items: list[dict] = []
        self.words: list[str] = []
        self.silent = 0
        self.figure: int | None = None
        self.caption: list[str] | None = None

    def flush(self) -> None:
        block = re.sub(r"\s+", " ", "".join(self.words)).strip()
        self.words = []
        if block:
            self.items.append({"kind": "text", "text": block, "ref": None, "caption": None})

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in _SILENT:
            self.silent += 1
        if tag in _BREAKS:
            self.flush()
        if tag == "figure":
            self.figure = len(self.items)
        elif tag == "figcaption":
            self.caption = []
        elif tag in ("img", "audio", "video", "source", "embed"):
            given = dict(attrs)
            if given.get("src"):
                self.flush()
                self.items.append({"kind": "media", "text": None, "ref": given["src"], "caption": given.get("alt") or None})

    def handle_endtag(self, tag: str) -> None:
        if tag in _SILENT and self.silent:
            self.silent -= 1
        if tag == "figcaption" and self.caption is not None:
            said = re.sub(r"\s+", " ", "".join(self.caption)).strip()
            for item in self.items[self.figure :] if self.figure is not None else ():
                if item["kind"] == "media" and said:
                    item["caption"] = said
            self.caption = None
        if tag in _BREAKS:
            self.flush()
        if tag == "figure":
            self.figure = None

    def handle_data(self, data: str) -> None:
        if self.caption is not None:
            self.caption.append(data)
        elif not self.silent:
            self.words.append(data)


def sequence(html: str | None) -> list[dict]:
    if not html:
        return []
    parser = _Sequencer()
    parser.feed(html)
    parser.close()
    parser.flush()
    return [{"pos": k, **item} for k, item in enumerate(parser.items)]


def parse_sequences(pages: DataFrame, id_col: str, html_col: str, carry: Sequence[str] = ()) -> DataFrame:
    """id_col, the carried columns and items, the ordered array of text and media structs."""
    held = [id_col, *carry]
    schema = T.StructType([*[pages.schema[c] for c in held], T.StructField("items", T.ArrayType(ITEM))])
    kind = pa.list_(pa.struct([("pos", pa.int32()), ("kind", pa.string()), ("text", pa.string()), ("ref", pa.string()), ("caption", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                items = [sequence(x) for x in part.column(len(held)).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(items, kind)], names=schema.names)

    return pages.select(*map(F.col, held), F.col(html_col)).mapInArrow(run, schema)


def pad(payload: bytes) -> bytes:
    """Zero bytes up to a positive multiple of BLOCK."""
    return payload + bytes(-len(payload) % BLOCK if payload else BLOCK)


def to_png(samples: bytes) -> bytes:
    """8-bit grey image, BLOCK samples wide; lossless."""
    rows = len(samples) // BLOCK
    lines = np.zeros((rows, BLOCK + 1), dtype=np.uint8)  # each line's first byte: no filter
    lines[:, 1:] = np.frombuffer(samples, dtype=np.uint8).reshape(rows, BLOCK)

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    return PNG_SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", BLOCK, rows, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(lines.tobytes(), 6)) + chunk(b"IEND", b"")


def from_png(stored: bytes) -> bytes:
    """Samples of an image made by to_png(); raises where a check sum doesn't hold."""
    if stored[:8] != PNG_SIGNATURE:
        raise ValueError("not a PNG image")
    at, width, rows, packed = 8, 0, 0, []
    while at < len(stored):
        size, kind = struct.unpack_from(">I4s", stored, at)
        data = stored[at + 8 : at + 8 + size]
        if zlib.crc32(kind + data) != struct.unpack_from(">I", stored, at + 8 + size)[0]:
            raise ValueError(f"damaged chunk {kind!r}")
        if kind == b"IHDR":
            width, rows = struct.unpack_from(">II", data)
        elif kind == b"IDAT":
            packed.append(data)
        at += 12 + size
    lines = np.frombuffer(zlib.decompress(b"".join(packed)), dtype=np.uint8).reshape(rows, width + 1)
    return lines[:, 1:].tobytes()


def describe(samples: bytes) -> str:
    """Feature of an image from its samples: rows, sum, sum of steps along lines, distinct values, and a four-bin histogram."""
    grid = np.frombuffer(samples, dtype=np.uint8).reshape(-1, BLOCK).astype(np.int64)
    steps = int(np.abs(np.diff(grid, axis=1)).sum())
    bins = np.bincount(grid.ravel() >> 6, minlength=4)
    return f"{len(grid)}x{BLOCK}:{int(grid.sum())}:{steps}:{len(np.unique(grid))}:{'/'.join(map(str, bins))}"


def payload_digest(text: Column) -> tuple[Column, Column]:
    """Bytes of the text, and the digest of its padded payload, without leaving the JVM."""
    raw = F.encode(F.coalesce(text, F.lit("")), "UTF-8")
    size = F.octet_length(raw)
    padded = F.greatest(F.lit(1), F.ceil(size / F.lit(BLOCK))).cast("int") * F.lit(BLOCK)
    return size.cast("long"), F.sha2(F.rpad(raw, padded, F.unhex(F.lit("00"))), 256)


def escaped(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def page_of(text: Column, digest: Column) -> Column:
    """A page of the text's lines as paragraphs, with the medium after the middle one and that line's first words as its caption."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    half = F.ceil(F.size(lines) / 2).cast("int")
    paragraphs = lambda part: F.array_join(F.transform(part, lambda x: F.concat(F.lit("<p>"), escaped(x), F.lit("</p>"))), "")
    caption = escaped(F.substring(F.element_at(lines, half), 1, CAPTION))
    figure = F.concat(F.lit(f'<figure><img src="{SCHEME}'), digest, F.lit('"><figcaption>'), caption, F.lit("</figcaption></figure>"))
    return F.concat(paragraphs(F.slice(lines, 1, half)), figure, paragraphs(F.slice(lines, half + 1, F.size(lines))))


def store_media(df: DataFrame, text_col: str) -> DataFrame:
    """digest and media (the stored PNG), one row per distinct payload of the whole column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            for first in range(0, len(column), 256):
                made: dict[str, bytes] = {}
                for t in column.slice(first, 256).to_pylist():
                    payload = pad((t or "").encode())
                    digest = hashlib.sha256(payload).hexdigest()
                    if digest not in made:
                        made[digest] = to_png(payload)
                yield pa.RecordBatch.from_arrays([pa.array(list(made)), pa.array(list(made.values()), pa.binary())], names=["digest", "media"])

    rows = df.select(F.col(text_col)).mapInArrow(run, "digest string, media binary")
    return rows.groupBy("digest").agg(F.first("media").alias("media"))


def media_features(store: DataFrame) -> DataFrame:
    """Features of each stored medium, from its bytes read back: a small row per digest."""
    schema = "digest string, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for digest, media in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                stored = media.as_py()
                payload = from_png(stored)
                rows.append((digest, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-BLOCK:]), len(stored), hashlib.sha256(stored).hexdigest(), describe(payload)))
            columns = list(zip(*rows, strict=True)) or [[]] * len(names)
            kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return store.select("digest", "media").mapInArrow(run, schema)


def references(sequences: DataFrame, carry: Sequence[str]) -> DataFrame:
    """The carried columns, n_items, pos, caption and digest (null where the reference has none) of each media item."""
    media = F.filter("items", lambda x: x["kind"] == F.lit("media"))
    parts = sequences.select(*map(F.col, carry), F.size("items").cast("long").alias("n_items"), F.explode(media).alias("item"))
    digest = F.when(F.col("item.ref").startswith(SCHEME), F.substring("item.ref", len(SCHEME) + 1, 64))
    return parts.select(*map(F.col, carry), "n_items", F.col("item.pos").alias("pos"), F.col("item.caption").alias("caption"), digest.alias("digest"))


def with_media(found: DataFrame, features: DataFrame) -> DataFrame:
    """References with a media struct each, null where the digest is not stored."""
    columns = [c for c in features.columns if c != "digest"]
    return found.join(features.select("digest", F.struct(*columns).alias("media")), "digest", "left")


def resolve(sequences: DataFrame, features: DataFrame, id_col: str) -> DataFrame:
    """id_col and items with a media struct on each reference whose digest is stored; same rows, same order."""
    # a row has its number from where it is written, once
    rows = materialise(sequences.select(id_col, "items").withColumn("__row", F.monotonically_increasing_id()), "sequences")
    joined = with_media(references(rows, ["__row"]), features)
    by_row = joined.groupBy("__row").agg(F.map_from_entries(F.collect_list(F.struct("pos", "media"))).alias("__media"))
    both = rows.join(by_row, "__row", "left")
    items = F.transform("items", lambda x: F.struct(x["pos"].alias("pos"), x["kind"].alias("kind"), x["text"].alias("text"), x["ref"].alias("ref"), x["caption"].alias("caption"), F.try_element_at("__media", x["pos"]).alias("media")))
    return both.select(id_col, items.alias("items"))


def document_media(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Each row's text as a medium in a page of its lines: stored, referred to, parsed, and resolved by digest.

    Returns id_col, n_bytes, the columns of media_features() without the digest, and the medium's place
    in the sequence (media_pos), the sequence's items (n_items) and the caption.
    """
    size, digest = payload_digest(F.col(text_col))
    pages = df.select(F.col(id_col), size.alias("n_bytes"), F.col(text_col).alias("text"), digest.alias("digest"))
    pages = pages.select(id_col, "n_bytes", page_of(F.col("text"), F.col("digest")).alias("html"))
    found = references(parse_sequences(pages, id_col, "html", ["n_bytes"]), [id_col, "n_bytes"])
    joined = with_media(found, media_features(store_media(df, text_col)))
    return joined.select(id_col, "n_bytes", "media.*", F.col("pos").cast("long").alias("media_pos"), "n_items", "caption")
