"""Tiled and compressed files, warping between systems, and folding blocks, each against a plain program."""

import datetime as dt
import math
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from landweave.functions import geo
from landweave.operators import raster
from landweave.sources import geotiff, rasters

T0 = dt.datetime(2023, 1, 1)


def packed_lzw(data):
    out, bits, held = bytearray(), 0, 0

    def put(code, width):
        nonlocal bits, held
        held, bits = (held << width) | code, bits + width
        while bits >= 8:
            bits -= 8
            out.append(held >> bits & 255)
            held &= (1 << bits) - 1

    table, width = {bytes([k]): k for k in range(256)}, 9
    put(256, 9)
    size, word = 258, b""
    for k in range(len(data)):
        longer = word + data[k : k + 1]
        if longer in table:
            word = longer
            continue
        put(table[word], width)
        table[longer] = size
        size += 1
        width = max(9, size.bit_length())
        if size == 4094:
            put(256, width)
            table, width, size = {bytes([k]): k for k in range(256)}, 9, 258
        word = data[k : k + 1]
    if word:
        put(table[word], width)
        size += 1
        width = max(9, min(12, size.bit_length()))
    put(257, width)
    if bits:
        out.append(held << (8 - bits) & 255)
    return bytes(out)


def tiff(a, epsg, minx, maxy, step, tile=None, compress=1, predictor=1, planar=1, order="<", big=False, nodata=None):
    """A file of (bands, h, w) with tiles of the given height and width, or strips of five rows."""
    bands, h, w = a.shape
    th, tw = tile or (5, w)
    chunks = []
    for plane in [a] if planar == 1 else [a[k : k + 1] for k in range(bands)]:
        for y in range(0, h, th):
            for x in range(0, w, tw):
                part = plane[:, y : y + th, x : x + tw]
                if tile:
                    part = np.pad(part, ((0, 0), (0, th - part.shape[1]), (0, tw - part.shape[2])))
                lines = np.ascontiguousarray(part.transpose(1, 2, 0))
                if predictor == 2:
                    unsigned = lines.view(f"u{a.dtype.itemsize}")
                    lines = np.concatenate([unsigned[:, :1], unsigned[:, 1:] - unsigned[:, :-1]], axis=1).view(a.dtype)
                raw = lines.astype(a.dtype.newbyteorder(order)).tobytes()
                if predictor == 3:
                    rows, s = lines.astype(a.dtype.newbyteorder(">")).reshape(len(lines), -1), lines.shape[2]
                    planes = rows.view(np.uint8).reshape(len(lines), -1, a.dtype.itemsize).transpose(0, 2, 1).reshape(len(lines), -1, s)
                    raw = np.concatenate([planes[:, :1], planes[:, 1:] - planes[:, :-1]], axis=1).tobytes()
                chunks.append(zlib.compress(raw) if compress in (8, 32946) else packed_lzw(raw) if compress == 5 else raw)
    size, wide = ("Q", 16) if big else ("I", 4)
    offsets = np.cumsum([16 if big else 8, *map(len, chunks)]).tolist()
    tags = [
        (256, 3, [w]), (257, 3, [h]), (258, 3, [a.dtype.itemsize * 8] * bands), (259, 3, [compress]), (277, 3, [bands]), (284, 3, [planar]), (317, 3, [predictor]), (339, 3, [{"u": 1, "i": 2, "f": 3}[a.dtype.kind]] * bands),
        *([(322, 3, [tw]), (323, 3, [th]), (324, wide, offsets[:-1]), (325, 4, [len(c) for c in chunks])] if tile else [(273, wide, offsets[:-1]), (278, 3, [th]), (279, 4, [len(c) for c in chunks])]),
        (33550, 12, [step, step, 0.0]), (33922, 12, [0.0, 0.0, 0.0, minx, maxy, 0.0]), (34735, 3, [1, 1, 0, 2, 1024, 0, 1, 1, 2048 if epsg == 4326 else 3072, 0, 1, epsg]),
    ]
    if nodata is not None:
        tags.append((42113, 2, list(f"{nodata:g}\0".encode())))
    codes = {2: "B", 3: "H", 4: "I", 12: "d", 16: "Q"}
    at, extra, entries = offsets[-1], b"", b""
    head = struct.calcsize("<Q" if big else "<H") + len(tags) * (20 if big else 12) + struct.calcsize("<" + size)
    for number, kind, values in sorted(tags):
        raw = struct.pack(f"{order}{len(values)}{codes[kind]}", *values)
        place = raw.ljust(8 if big else 4, b"\0") if len(raw) <= (8 if big else 4) else struct.pack(order + size, at + head + len(extra))
        extra += raw if len(raw) > (8 if big else 4) else b""
        entries += struct.pack(order + "HH" + size, number, kind, len(values)) + place
    start = struct.pack(order + "2sHHHQ", b"II" if order == "<" else b"MM", 43, 8, 0, at) if big else struct.pack(order + "2sHI", b"II" if order == "<" else b"MM", 42, at)
    return start + b"".join(chunks) + struct.pack(order + ("Q" if big else "H"), len(tags)) + entries + struct.pack(order + size, 0) + extra


def read_all(raw):
    found = geotiff.directory(lambda at, n: raw[at : at + n], len(raw))
    layout, (planes, rows, cols) = found["layout"], found["offsets"].shape
    out = []
    for p in range(planes):
        lines = []
        for r in range(rows):
            lines.append(np.concatenate([geotiff.tile_array(raw[found["offsets"][p, r, c] :][: found["sizes"][p, r, c]], layout, r) for c in range(cols)], axis=2))
        out.append(np.concatenate(lines, axis=1)[:, : layout["height"], : layout["width"]])
    return np.concatenate(out), found


@pytest.mark.parametrize("kind", ["u1", "i2", "u2", "f4", "f8"])
@pytest.mark.parametrize("options", [{}, {"tile": (16, 16)}, {"tile": (16, 32), "planar": 2, "big": True}, {"planar": 2, "order": ">"}], ids=str)
@pytest.mark.parametrize("compress", [1, 5, 8, 32946])
def test_files_of_every_layout(kind, options, compress):
    rng = np.random.default_rng(1)
    a = rng.integers(0, 200, (3, 37, 53)).astype(kind)
    a[0] = 7
    for predictor in [1, 3] if kind[0] == "f" else [1, 2]:
        got, found = read_all(tiff(a, 32633, 500000.0, 5300000.0, 10.0, compress=compress, predictor=predictor, nodata=-999, **options))
        assert (got == a).all() and got.dtype.kind == kind[0]
        assert (found["epsg"], found["minx"], found["maxy"], found["step_x"], found["nodata"]) == (32633, 500000.0, 5300000.0, 10.0, -999.0)


def test_long_lzw():
    data = np.random.default_rng(2).integers(0, 4, 60_000).astype(np.uint8).tobytes() + bytes(20_000) + bytes(range(256)) * 20
    assert geotiff.unpacked_lzw(packed_lzw(data)) == data
    with pytest.raises(ValueError):
        geotiff.tile_array(zlib.compress(b"short"), {"compression": 8, "dtype": "<u1", "tile_width": 4, "tile_height": 4, "tiled": True, "height": 4, "samples": 1, "planar": 1, "predictor": 1}, 0)


GRID = {"epsg": 32632, "minx": 499_980.0, "maxy": 5_300_040.0, "side": 960.0, "n": 12, "rows": 3, "cols": 4}


def nearest(a, epsg, minx, maxy, step, grid, wy, wx):
    """A window's values, one pixel at a time."""
    out = []
    size = grid["side"] / grid["n"]
    for i in range(grid["n"]):
        for j in range(grid["n"]):
            x, y = grid["minx"] + wx * grid["side"] + (j + 0.5) * size, grid["maxy"] - wy * grid["side"] - (i + 0.5) * size
            (x,), (y,) = geo.projected(np.array([x]), np.array([y]), grid["epsg"], epsg)
            r, c = math.floor((maxy - y) / step), math.floor((x - minx) / step)
            out.append(float(a[r, c]) if 0 <= r < a.shape[0] and 0 <= c < a.shape[1] else None)
    return out


def test_two_systems_meet_on_one_grid(spark, tmp_path):
    rng = np.random.default_rng(5)
    x33, y33 = geo.projected(np.array([GRID["minx"]]), np.array([GRID["maxy"]]), 32632, 32633)
    lon, lat = geo.projected(np.array([GRID["minx"]]), np.array([GRID["maxy"]]), 32632, 4326)
    files = {
        "a/x.tif": (rng.integers(1, 99, (2, 70, 90)).astype("u2"), 32632, 499_700.0, 5_300_100.0, 60.0, {"tile": (16, 16), "compress": 8, "predictor": 2}),
        "b/x.tif": (rng.integers(1, 99, (2, 64, 80)).astype("f4"), 32633, float(x33[0]) - 900, float(y33[0]) + 700, 70.0, {"tile": (32, 16), "compress": 5, "planar": 2}),
        "c.tif": (rng.integers(1, 99, (2, 120, 140)).astype("i2"), 4326, float(lon[0]) - 0.001, float(lat[0]) + 0.002, 0.0005, {"compress": 8}),
    }
    for name, (a, epsg, minx, maxy, step, options) in files.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(tiff(a, epsg, minx, maxy, step, **options))
    (tmp_path / "damaged.tif").write_bytes((tmp_path / "a/x.tif").read_bytes()[:300])
    rows = [(name, 4, name[0], T0, ["u", "v"], 12) for name in files] + [("gone.tif", 4, "g", T0, ["u", "v"], 12), ("damaged.tif", 4, "d", T0, ["u", "v"], 12)]
    manifest = spark.createDataFrame(rows, rasters.MANIFEST)
    grid = F.struct(*[F.lit(v).alias(k) for k, v in GRID.items()]).cast(rasters.GRID)
    parts = rasters.read_parts(rasters.tile_table(manifest, str(tmp_path)).withColumn("grid", grid), str(tmp_path)).cache()
    got = {(r["source"], r["band"], r["wy"], r["wx"]): r["data"] for r in rasters.put_together(parts).collect()}
    errors = {r["source"]: r["error"] for r in parts.where("error IS NOT NULL").collect()}
    assert set(errors) == {"g", "d"} and "FileNotFound" in errors["g"]
    want = {}
    for name, (a, epsg, minx, maxy, step, _) in files.items():
        for k, band in enumerate("uv"):
            for wy in range(3):
                for wx in range(4):
                    data = nearest(a[k], epsg, minx, maxy, step, GRID, wy, wx)
                    if any(v is not None for v in data):
                        want[name[0], band, wy, wx] = data
    assert got == want and {k[0] for k in want} == set("abc")
    # several tiles make a window
    assert parts.where("source = 'a' AND error IS NULL").count() > sum(k[0] == "a" for k in want)


def test_only_the_wanted_bands_and_tiles_are_read(spark, tmp_path):
    a = np.random.default_rng(6).integers(0, 60_000, (4, 256, 256)).astype("u2")
    (tmp_path / "x.tif").write_bytes(tiff(a, 32632, 0.0, 0.0, 10.0, tile=(32, 32), planar=2, compress=8))
    size = (tmp_path / "x.tif").stat().st_size
    manifest = spark.createDataFrame([("x.tif", 1, "s", T0, ["a", "b", "c", "d"], 16)], rasters.MANIFEST)
    grid = F.struct(F.lit(32632).alias("epsg"), F.lit(640.0).alias("minx"), F.lit(-640.0).alias("maxy"), F.lit(160.0).alias("side"), F.lit(16).alias("n"), F.lit(2).alias("rows"), F.lit(2).alias("cols")).cast(rasters.GRID)
    tiles = rasters.tile_table(manifest, str(tmp_path), ["b"])
    assert tiles.count() == 64
    parts = rasters.read_parts(tiles.withColumn("grid", grid), str(tmp_path)).cache()
    assert 0 < parts.agg(F.sum("read")).first()[0] < size / 100  # one tile of 256
    got = {(r["wy"], r["wx"]): r["data"] for r in rasters.put_together(parts).collect()}
    assert got == {(y, x): a[1, 64 + 16 * y : 80 + 16 * y, 64 + 16 * x : 80 + 16 * x].astype(float).ravel().tolist() for y in (0, 1) for x in (0, 1)}
    whole = {(r["band"], r["wy"], r["wx"]): r["data"] for r in rasters.read_blocks(manifest, str(tmp_path), wanted=["d", "a"]).collect()}
    assert len(whole) == 2 * 256 and whole["d", 3, 5] == a[3, 48:64, 80:96].astype(float).ravel().tolist()
    with pytest.raises(Exception, match="can't be read"):
        rasters.read_blocks(manifest.withColumn("path", F.lit("gone.tif")), str(tmp_path)).collect()


@pytest.mark.parametrize("parts", [1, 7])
def test_folding_equals_a_loop(spark, parts):
    rng = np.random.default_rng(7)
    rows = []
    for k in range(400):
        size = int(rng.choice([4, 4, 4, 6]))
        data = [None if rng.random() < 0.4 else float(rng.integers(0, 50)) for _ in range(size)]
        rows.append((None if rng.random() < 0.1 else int(rng.integers(0, 9)), str(rng.integers(0, 2)), T0 + dt.timedelta(hours=int(rng.integers(0, 99))), k, None if rng.random() < 0.05 else data))
    df = spark.createDataFrame(rows, "a int, b string, t timestamp, id int, data array<double>").repartition(parts)
    want: dict = {}
    for a, b, t, k, data in sorted(rows, key=lambda r: (r[2], r[3])):
        least, seen = want.setdefault((a, b), [t, []])
        want[a, b][0] = min(least, t)
        seen.append(data or [])

    def column(seen, j):
        return [d[j] for d in seen if j < len(d) and d[j] is not None]

    for how, pick in (("first", lambda v: v[0] if v else None), ("mean", lambda v: sum(v) / len(v) if v else None)):
        got = {(r["a"], r["b"]): (r["t"], r["data"]) for r in raster.fold_blocks(df.select("a", "b", "t", "data", *(["id"] if how == "first" else [])), ["a", "b"], how, ["t", "id"] if how == "first" else ()).collect()}
        assert set(got) == set(want)
        for key, (t, seen) in want.items():
            assert got[key][0].replace(tzinfo=None) == t
            assert got[key][1] == pytest.approx([pick(column(seen, j)) for j in range(max(map(len, seen)))])
    assert raster.fold_blocks(df.where("false").select("a", "t", "data"), ["a"], "mean").collect() == []
