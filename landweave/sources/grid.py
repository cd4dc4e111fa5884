"""The grid of satellite paths: a table, or a zipped shapefile on disk or behind an address."""

from __future__ import annotations

import io
import os
import struct
import zipfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

from ..schemas import GRID
from .scene_catalog import fetch

#: Fixed values of the shapefile formats: header sizes and the polygon types (plain, with z, with m).
SHP_HEADER, DBF_HEADER, DBF_FIELD = 100, 32, 32
POLYGONS = frozenset({5, 15, 25})


def shape_boxes(shp: bytes) -> Iterator[tuple[float, float, float, float] | None]:
    """Bounds of each polygon record, None for a record without a shape."""
    at = SHP_HEADER
    while at + 8 <= len(shp):
        _, words = struct.unpack_from(">II", shp, at)
        (kind,) = struct.unpack_from("<i", shp, at + 8)
        yield struct.unpack_from("<4d", shp, at + 12) if kind in POLYGONS else None
        at += 8 + 2 * words


def dbf_column(dbf: bytes, name: str) -> list[str]:
    """A column's texts, one a record."""
    records, header, width = struct.unpack_from("<IHH", dbf, 4)
    offset, at = 1, DBF_HEADER
    while dbf[at] != 0x0D:
        field, size = dbf[at : at + 11].split(b"\0")[0].decode("ascii"), dbf[at + 16]
        if field.upper() == name.upper():
            return [dbf[header + k * width + offset : header + k * width + offset + size].decode("latin-1").strip() for k in range(records)]
        offset += size
        at += DBF_FIELD
    raise KeyError(name)


def zipped_paths(raw: bytes, column: str = "PATH") -> list[tuple[int, tuple[float, float, float, float]]]:
    """Path number and bounds of each polygon of a zipped shapefile."""
    with zipfile.ZipFile(io.BytesIO(raw)) as archive:
        parts = {os.path.splitext(n)[1].lower(): archive.read(n) for n in archive.namelist()}
    return [(int(float(p)), b) for p, b in zip(dbf_column(parts[".dbf"], column), shape_boxes(parts[".shp"]), strict=True) if b]


def read_grid(spark: SparkSession, path: str, url: str | None = None, get=fetch) -> DataFrame:
    """path and bbox of the grid: a zipped shapefile at path, else the one at url, else a table (Parquet) at path.

    The grid has some ten thousand polygons, whatever the areas; it is parsed on the driver.
    """
    if path.endswith(".zip"):
        if os.path.exists(path):
            with open(path, "rb") as found:
                return spark.createDataFrame(zipped_paths(found.read()), GRID)
        if url:
            return spark.createDataFrame(zipped_paths(get(url)), GRID)
        raise FileNotFoundError(path)
    return spark.read.schema(GRID).parquet(path)
