"""GeoTIFF files as block rows on a common grid: directories first, then only the tiles that a grid needs.

A file's directory makes a row for each of its tiles (`tile_table`), which Spark filters by band, joins with
grids, and deals to tasks. A task works out which windows of the grid a tile reaches, reads the tile's byte range if there are any, and
takes each target pixel's value from the source pixel that it lies in (`read_parts`); coordinate systems may differ. A window
that several tiles reach comes in parts, which are put together by window (`read_blocks`). Nothing is shuffled by pixel.

A file that is missing or damaged, or whose grid is turned, gives a row with an error in place of its tiles, and a damaged tile one
in place of its windows.
"""

from __future__ import annotations

import json
from collections import OrderedDict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..operators.raster import fold_blocks
from ..session import dealt
from .geotiff import directory, tile_array
from .store import Ranges

#: What is known of a file: where it is below the folder, whose it is, and its bands in order.
MANIFEST = "path string, aoi_index bigint, source string, t timestamp, bands array<string>, n int"
TILE = (
    "path string, aoi_index bigint, source string, t timestamp, bands array<string>, row int, col int, offset bigint, nbytes bigint, "
    "epsg int, minx double, maxy double, step_x double, step_y double, nodata double, layout string, error string"
)
#: An area's windows: of n x n pixels and `side` units of its system each, from the upper left corner.
GRID = "struct<epsg:int,minx:double,maxy:double,side:double,n:int,rows:int,cols:int>"
PART = "aoi_index bigint, source string, t timestamp, band string, wy int, wx int, n int, data array<double>, read bigint, error string"
BLOCK_KEYS = ["aoi_index", "source", "t", "band", "wy", "wx", "n"]
#: Windows whose places in a file a task remembers.
REMEMBERED = 256


def tile_table(manifest: DataFrame, folder: str, wanted: Sequence[str] | None = None) -> DataFrame:
    """A row for each tile of the manifest's files that holds a wanted band, or for each file that can't be read."""
    names = [c.split()[0] for c in TILE.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, area, source, t, bands in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                head = {"path": path, "aoi_index": area, "source": source, "t": t}
                try:
                    read = Ranges(f"{folder}/{path}")
                    try:
                        found = directory(read, read.size)
                    finally:
                        read.close()
                    layout, common = json.dumps(found["layout"]), {c: found[c] for c in ("epsg", "minx", "maxy", "step_x", "step_y", "nodata")}
                    planes, rows, cols = found["offsets"].shape
                    bands = [b if wanted is None or b in wanted else None for b in (bands or [])[: found["layout"]["samples"]]]
                    held = [bands] if planes == 1 else [[b] for b in bands]
                    out = [
                        {**head, **common, "bands": own, "row": r, "col": c, "offset": int(found["offsets"][k, r, c]), "nbytes": int(found["sizes"][k, r, c]), "layout": layout}
                        for k, own in enumerate(held) if any(own) for r in range(rows) for c in range(cols) if found["sizes"][k, r, c]
                    ]
                except Exception as e:  # whatever is wrong with a file is that file's alone
                    out = [{**head, "error": f"{type(e).__name__}: {e}"[:500]}]
                yield pa.RecordBatch.from_pylist([{c: r.get(c) for c in names} for r in out], schema=schema)

    schema = _arrow(TILE)
    return dealt(manifest.select("path", "aoi_index", "source", "t", "bands"), "path").mapInArrow(run, TILE)


_ARROW = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(), "timestamp": pa.timestamp("us", "UTC"), "array<string>": pa.list_(pa.string()), "array<double>": pa.list_(pa.float64())}


def _arrow(ddl: str) -> pa.Schema:
    return pa.schema([(name, _ARROW[kind]) for name, kind in map(str.split, ddl.split(", "))])


class Places:
    """Rows and columns of a file in which the pixels of a grid's windows lie, the last ones remembered."""

    def __init__(self):
        self.known: OrderedDict = OrderedDict()

    def of(self, grid: dict, tile: dict, wy: int, wx: int) -> tuple[np.ndarray, np.ndarray]:
        key = (*grid.values(), wy, wx, *(tile[c] for c in ("epsg", "minx", "maxy", "step_x", "step_y")))
        if key not in self.known:
            n, step = grid["n"], grid["side"] / grid["n"]
            x = grid["minx"] + wx * grid["side"] + (np.arange(n) + 0.5) * step
            y = grid["maxy"] - wy * grid["side"] - (np.arange(n) + 0.5) * step
            x, y = geo.projected(np.tile(x, n), np.repeat(y, n), grid["epsg"], tile["epsg"])
            self.known[key] = np.floor((tile["maxy"] - y) / tile["step_y"]).astype(np.int64), np.floor((x - tile["minx"]) / tile["step_x"]).astype(np.int64)
            if len(self.known) > REMEMBERED:
                self.known.popitem(last=False)
        self.known.move_to_end(key)
        return self.known[key]


def extent(tile: dict, layout: dict) -> tuple[int, int, int, int]:
    """First and last row and column of a tile within its file."""
    top, left = tile["row"] * layout["tile_height"], tile["col"] * layout["tile_width"]
    return top, min(top + layout["tile_height"], layout["height"]), left, min(left + layout["tile_width"], layout["width"])


def reached(grid: dict, tile: dict, layout: dict) -> Iterator[tuple[int, int]]:
    """Windows of a grid that a tile may have pixels of."""
    top, bottom, left, right = extent(tile, layout)
    box = (tile["minx"] + left * tile["step_x"], tile["maxy"] - bottom * tile["step_y"], tile["minx"] + right * tile["step_x"], tile["maxy"] - top * tile["step_y"])
    with np.errstate(all="ignore"):
        minx, miny, maxx, maxy = geo.projected_bounds(box, tile["epsg"], grid["epsg"])
    if np.isfinite([minx, miny, maxx, maxy]).all():
        near = grid["side"] / grid["n"] / 2  # sides are bent between the points that were looked at
        first = max(0, int((minx - near - grid["minx"]) // grid["side"])), max(0, int((grid["maxy"] - maxy - near) // grid["side"]))
        last = min(grid["cols"] - 1, int((maxx + near - grid["minx"]) // grid["side"])), min(grid["rows"] - 1, int((grid["maxy"] - miny + near) // grid["side"]))
        yield from ((wy, wx) for wy in range(first[1], last[1] + 1) for wx in range(first[0], last[0] + 1))


def read_parts(tiles: DataFrame, folder: str, nodata: float | None = None) -> DataFrame:
    """What each tile has of its grid's windows (PART); tiles: TILE, a column grid (GRID) and, if there is one, a column only.

    only: the numbers (wy * cols + wx) of the windows that are wanted, null for all of them. A part's data have null where the tile, or the value, is missing. read: bytes asked of the store, in a tile's first row.
    """
    schema = _arrow(PART)
    columns = [c.split()[0] for c in TILE.split(", ")] + ["grid", "only"]
    if "only" not in tiles.columns:
        tiles = tiles.withColumn("only", F.lit(None).cast("array<int>"))

    def parts(tile: dict, read: Ranges, places: Places) -> list[tuple]:
        layout, grid = json.loads(tile["layout"]), tile["grid"]
        top, bottom, left, right = extent(tile, layout)
        values, found = None, []
        only = None if tile["only"] is None else set(tile["only"])
        for wy, wx in reached(grid, tile, layout):
            if only is not None and wy * grid["cols"] + wx not in only:
                continue
            r, c = places.of(grid, tile, wy, wx)
            inside = (r >= top) & (r < bottom) & (c >= left) & (c < right)
            if not inside.any():
                continue
            if values is None:
                values = tile_array(read(tile["offset"], tile["nbytes"]), layout, tile["row"])
            for k, band in enumerate(tile["bands"]):
                if band is not None:
                    data = np.full(len(r), np.nan)
                    data[inside] = values[k, r[inside] - top, c[inside] - left]
                    for missing in (nodata, tile["nodata"]):
                        if missing is not None:
                            data[data == missing] = np.nan
                    found.append((band, wy, wx, data))
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, path, read = Places(), None, None
        for batch in batches:
            for tile in batch.to_pylist():
                head, error, found, before = {c: tile[c] for c in ("aoi_index", "source", "t")}, tile["error"], [], 0
                try:
                    if error is None:
                        if tile["path"] != path:
                            path, read = None, None
                            path, read = tile["path"], Ranges(f"{folder}/{tile['path']}")
                        before = read.read
                        found = parts(tile, read, places)
                except Exception as e:  # a damaged tile is that tile's alone
                    error, found = f"{type(e).__name__}: {e}"[:500], []
                rows = [{**head, "band": b, "wy": wy, "wx": wx, "n": tile["grid"]["n"], "read": 0} for b, wy, wx, _ in found]
                data = [d for *_, d in found]
                if error is not None:
                    rows, data = [{**head, "error": error, "read": 0}], [None]
                if rows:
                    rows[0]["read"] = (read.read if read else 0) - before
                    lists = pa.array(data, schema.field("data").type, from_pandas=True) if error else pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, data)]), pa.int32()), pa.array(np.concatenate(data), from_pandas=True))
                    own = pa.RecordBatch.from_pylist([{f.name: r.get(f.name) for f in schema if f.name != "data"} for r in rows], schema=pa.schema([f for f in schema if f.name != "data"]))
                    yield pa.RecordBatch.from_arrays([lists.cast(f.type) if f.name == "data" else own.column(f.name) for f in schema], schema=schema)

    return dealt(tiles.select(*columns), "path", "row").sortWithinPartitions("path", "row", "col").mapInArrow(run, PART)


def put_together(parts: DataFrame) -> DataFrame:
    """Block rows of parts without an error."""
    return fold_blocks(parts.where(F.col("error").isNull()).select(*BLOCK_KEYS, "data"), BLOCK_KEYS, "any")


def own_grids(tiles: DataFrame, n: str) -> DataFrame:
    """tiles with each file's own grid of windows of n pixels; edges that fill no window go."""
    size = F.from_json("layout", "width int, height int")
    rows, cols = (F.floor(size[c] / F.col(n)).cast("int") for c in ("height", "width"))
    grid = F.struct(F.col("epsg"), F.col("minx"), F.col("maxy"), (F.col(n) * F.col("step_x")).alias("side"), F.col(n).cast("int").alias("n"), rows.alias("rows"), cols.alias("cols"))
    return tiles.withColumn("grid", grid.cast(GRID))


def read_blocks(manifest: DataFrame, folder: str, nodata: float | None = None, wanted: Sequence[str] | None = None) -> DataFrame:
    """Block rows (schemas.BLOCK) of the manifest's files on their own grids, in windows of the manifest's n pixels. Raises where a file can't be read."""
    tiles = tile_table(manifest, folder, wanted).join(F.broadcast(manifest.select("path", "aoi_index", "n").distinct()) if _few(manifest) else manifest.select("path", "aoi_index", "n").distinct(), ["path", "aoi_index"])
    parts = read_parts(own_grids(tiles, "n"), folder, nodata)
    checked = parts.withColumn("error", F.when(F.col("error").isNotNull(), F.raise_error(F.concat_ws(" ", F.lit("a raster can't be read:"), "error"))))
    return put_together(checked).select(*BLOCK_KEYS, "data")


#: Files of a manifest that is sent to all tasks, at most.
FEW_FILES = 10_000


def _few(manifest: DataFrame) -> bool:
    return manifest.limit(FEW_FILES + 1).count() <= FEW_FILES
