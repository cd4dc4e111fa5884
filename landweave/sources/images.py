"""Chips as image files: GeoTIFF and PNG from numpy arrays, written by the tasks that hold the rows."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import store
from .geotiff import directory, tile_array

#: Fixed values of the formats: PNG signature, TIFF tag numbers and types, GeoTIFF key ids.
PNG_SIGNATURE = b"\x89PNG\r\n\x1a\n"
_SHORT, _LONG, _DOUBLE = 3, 4, 12
_KINDS = {"u": 1, "i": 2, "f": 3}


def png(rgb: np.ndarray) -> bytes:
    """An (h, w, 3) or (h, w) array of bytes as a PNG image."""
    h, w = rgb.shape[:2]
    color = 2 if rgb.ndim == 3 else 0
    lines = np.zeros((h, 1 + rgb[0].size), dtype=np.uint8)
    lines[:, 1:] = rgb.reshape(h, -1)

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    return PNG_SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, color, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(lines.tobytes(), 6)) + chunk(b"IEND", b"")


def read_png(raw: bytes) -> np.ndarray:
    """The (h, w, 3) or (h, w) bytes of an image made by png()."""
    at, data = len(PNG_SIGNATURE), b""
    w, h, bits, color = struct.unpack_from(">IIBB", raw, at + 8)
    while at < len(raw):
        (size,) = struct.unpack_from(">I", raw, at)
        if raw[at + 4 : at + 8] == b"IDAT":
            data += raw[at + 8 : at + 8 + size]
        at += 12 + size
    lines = np.frombuffer(zlib.decompress(data), np.uint8).reshape(h, -1)
    if bits != 8 or color not in (0, 2) or lines[:, 0].any():
        raise ValueError("an image of another kind")
    return lines[:, 1:].reshape((h, w, 3) if color else (h, w))


def decoded_sums(df: DataFrame) -> DataFrame:
    """The first column, and in sums each plane's sum, of PNG images in the second."""
    key = df.schema[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [read_png(raw).reshape(-1, 3).sum(axis=0, dtype=np.int64).tolist() for raw in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sums, pa.list_(pa.int64()))], names=[key.name, "sums"])

    return df.mapInArrow(run, f"{key.name} {key.dataType.simpleString()}, sums array<bigint>")


def geotiff(bands: np.ndarray, epsg: int, minx: float, maxy: float, resolution: float, nodata: float | None = None, tile: int | None = None) -> bytes:
    """A (bands, h, w) array as a little-endian GeoTIFF, band after band: uncompressed, or in deflated tiles of a width."""
    count, h, w = bands.shape
    bands = np.ascontiguousarray(bands.astype(bands.dtype.newbyteorder("<")))
    if tile:
        padded = np.pad(bands, ((0, 0), (0, -h % tile), (0, -w % tile)))
        chunks = [zlib.compress(np.ascontiguousarray(p[y : y + tile, x : x + tile]).tobytes()) for p in padded for y in range(0, h, tile) for x in range(0, w, tile)]
    else:
        chunks = [p.tobytes() for p in bands]
    sizes = [len(c) for c in chunks]
    offsets = [8 + sum(sizes[:k]) for k in range(len(sizes))]
    layout = [(322, _SHORT, [tile]), (323, _SHORT, [tile]), (324, _LONG, offsets), (325, _LONG, sizes)] if tile else [(273, _LONG, offsets), (278, _LONG, [h]), (279, _LONG, sizes)]
    data = b"".join(chunks)
    data += b"\0" * (len(data) % 2)
    geographic = epsg == 4326
    tags: list[tuple[int, int, list]] = [
        (256, _LONG, [w]), (257, _LONG, [h]), (258, _SHORT, [bands.dtype.itemsize * 8] * count), (259, _SHORT, [8 if tile else 1]), (262, _SHORT, [1]),
        (277, _SHORT, [count]), *layout,
        (284, _SHORT, [2]), (339, _SHORT, [_KINDS[bands.dtype.kind]] * count),
        (33550, _DOUBLE, [resolution, resolution, 0.0]), (33922, _DOUBLE, [0.0, 0.0, 0.0, minx, maxy, 0.0]),
        (34735, _SHORT, [1, 1, 0, 3, 1024, 0, 1, 2 if geographic else 1, 1025, 0, 1, 1, 2048 if geographic else 3072, 0, 1, epsg]),
    ]
    if nodata is not None:
        tags.append((42113, 2, list(f"{nodata:g}\0".encode())))
    formats = {2: "B", _SHORT: "H", _LONG: "I", _DOUBLE: "d"}
    extra, entries = b"", b""
    at = 8 + len(data) + 2 + 12 * len(tags) + 4
    for number, kind, values in sorted(tags):
        raw = struct.pack(f"<{len(values)}{formats[kind]}", *values)
        if len(raw) <= 4:
            place = raw.ljust(4, b"\0")
        else:
            place = struct.pack("<I", at + len(extra))
            extra += raw + b"\0" * (len(raw) % 2)
        entries += struct.pack("<HHI", number, kind, len(values)) + place
    return struct.pack("<2sHI", b"II", 42, 8 + len(data)) + data + struct.pack("<H", len(tags)) + entries + b"\0" * 4 + extra


def read_geotiff(raw: bytes) -> tuple[np.ndarray, dict]:
    """Array and georeference of a whole file made by geotiff()."""
    found = directory(lambda at, n: raw[at : at + n], len(raw))
    layout, (planes, rows, cols) = found["layout"], found["offsets"].shape
    tile = lambda p, r, c: tile_array(raw[found["offsets"][p, r, c] :][: found["sizes"][p, r, c]], layout, r)
    bands = np.concatenate([np.concatenate([np.concatenate([tile(p, r, c) for c in range(cols)], axis=2) for r in range(rows)], axis=1) for p in range(planes)])
    return bands[:, : layout["height"], : layout["width"]], {"epsg": found["epsg"], "resolution": found["step_x"], "minx": found["minx"], "maxy": found["maxy"]}


def as_kind(values: np.ndarray, kind: str) -> np.ndarray:
    """Values as another type; raises where one doesn't fit, as NaN doesn't fit whole numbers."""
    dtype = np.dtype(kind)
    if dtype.kind in "iu":
        limits = np.iinfo(dtype)
        if not (np.isfinite(values).all() and (np.trunc(values) >= limits.min).all() and (np.trunc(values) <= limits.max).all()):
            raise ValueError(f"a value that is no {kind}")
    return values.astype(dtype)


def encode_chips(df: DataFrame, kind: str, tile: int | None = None, nodata: float | None = None) -> DataFrame:
    """name and content (binary) of an image per row; error where it can't be made, content then is null.

    kind 'tif': columns name, data (array of band arrays of doubles), n, dtype, epsg, minx, maxy, resolution.
    kind 'png': columns name, data (three band arrays of values 0..255), n.
    """

    def tif(planes: np.ndarray, r: dict) -> bytes:
        return geotiff(as_kind(planes, r["dtype"]), r["epsg"], r["minx"], r["maxy"], r["resolution"], nodata, tile)

    def thumb(planes: np.ndarray, r: dict) -> bytes:
        return png(as_kind(planes, "uint8").transpose(1, 2, 0))

    encode = {"tif": tif, "png": thumb}[kind]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = batch.column(batch.schema.get_field_index("data"))
            bands, values = data.offsets.to_numpy(), data.values  # a list of lists, looked at without making Python numbers
            cut, flat = values.offsets.to_numpy(), values.values.to_numpy(zero_copy_only=False)
            for first in range(0, batch.num_rows, 64):
                rows = batch.drop_columns(["data"]).slice(first, 64).to_pylist()
                made: list[bytes | None] = []
                errors: list[str | None] = []
                for k, r in enumerate(rows, first):
                    try:
                        planes = flat[cut[bands[k]] : cut[bands[k + 1]]].astype(np.float64, copy=False).reshape(bands[k + 1] - bands[k], r["n"], r["n"])
                        made.append(encode(planes, r))
                        errors.append(None)
                    except (ValueError, OverflowError) as e:  # an image that can't be made fails alone
                        made.append(None)
                        errors.append(f"{type(e).__name__}: {e}")
                yield pa.RecordBatch.from_arrays([pa.array([r["name"] for r in rows], pa.string()), pa.array(made, pa.binary()), pa.array(errors, pa.string())], names=["name", "content", "error"])

    return df.mapInArrow(run, "name string, content binary, error string")


def write_images(df: DataFrame, folder: str) -> DataFrame:
    """Writes each row's content to folder/name, a mounted folder or a store, from the tasks; name, size and error of each.

    A task that runs again writes the same bytes; files appear under their name only when whole. A row without content has no file
    and no size.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, path = store.opened(folder)
        where.create_dir(path, recursive=True)
        for batch in batches:
            sizes = [None if content is None else store.put(folder, name, [content]) for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), batch.column(2)], names=["name", "size", "error"])

    error = F.col("error") if "error" in df.columns else F.lit(None).cast("string").alias("error")
    return df.select("name", "content", error).mapInArrow(run, "name string, size long, error string")
