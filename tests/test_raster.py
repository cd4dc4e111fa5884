import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from landweave.functions import pixels
from landweave.operators import raster


def tiles(spark, arrays):
    return spark.createDataFrame([(i, [None if np.isnan(v) else float(v) for v in a.ravel()]) for i, a in enumerate(arrays)], "id int, data array<double>")


def test_windows_match_numpy_slices(spark):
    a = np.arange(64, dtype=float).reshape(8, 8)
    got = {(r["wy"], r["wx"]): r["data"] for r in raster.windows_in_rows(tiles(spark, [a]), "data", 8, 3, ["id"]).collect()}
    assert set(got) == {(y, x) for y in range(2) for x in range(2)}
    assert got[1, 0] == a[3:6, 0:3].ravel().tolist()


def test_pixels_and_blocks_round_trip(spark):
    a = np.random.default_rng(0).normal(size=(6, 6))
    a[2, 3] = np.nan
    cells = raster.to_pixels(tiles(spark, [a]), "data", 6, ["id"]).where("v IS NOT NULL")
    for r in raster.to_blocks(cells, ["id"], "v", 3).collect():
        want = a[r["wy"] * 3 : r["wy"] * 3 + 3, r["wx"] * 3 : r["wx"] * 3 + 3].ravel()
        assert [np.nan if v is None else v for v in r["data"]] == [v if v == v else np.nan for v in want] or np.allclose([np.nan if v is None else v for v in r["data"]], want, equal_nan=True)


def test_composite_takes_the_first_that_is_there_and_ignores_the_year(spark):
    rows = [
        (1, dt.datetime(2023, 1, 5), [None, 2.0, None]),
        (1, dt.datetime(2023, 2, 5), [1.0, 9.0, None]),
        (1, dt.datetime(2024, 3, 5), [7.0, 7.0, 7.0]),
        (1, dt.datetime(2023, 4, 5), [4.0, None, 4.0]),
    ]
    df = spark.createDataFrame(rows, "id int, t timestamp, data array<double>")
    got = [(r["t"].month, r["data"]) for r in raster.composite_blocks(df, ["id"]).orderBy("t").collect()]
    assert got == [(1, [1.0, 2.0, 7.0]), (4, [4.0, None, 4.0])]


def test_mean_leaves_missing_values_out(spark):
    t = dt.datetime(2023, 1, 1)
    df = spark.createDataFrame([(1, t, [1.0, None, None]), (1, t, [4.0, 3.0, None])], "id int, t timestamp, data array<double>")
    assert raster.mean_blocks(df, ["id"]).first()["data"] == [2.5, 3.0, None]


def test_masks(spark):
    t = dt.datetime(2023, 1, 1)
    blocks = spark.createDataFrame([(1, t, [1.0, 2.0, 3.0]), (2, t, [1.0, 2.0, 3.0])], "id int, t timestamp, data array<double>")
    scene = spark.createDataFrame([(1, t, [4.0, 8.0, None])], "id int, t timestamp, data array<double>")
    got = {r["id"]: r["data"] for r in raster.mask_blocks(blocks, scene, ["id", "t"], "class").collect()}
    assert got == {1: [1.0, None, None], 2: [None, None, None]}
    bits = spark.createDataFrame([(1, t, [1.0, 2.0, 32.0])], "id int, t timestamp, data array<double>")
    got = {r["id"]: r["data"] for r in raster.mask_blocks(blocks, bits, ["id", "t"], "bits").collect()}
    assert got[1] == [1.0, None, 3.0]


def test_radar_and_stretch_match_numpy(spark):
    vv = np.array([0.0, 1e-9, 10**-2.5, 0.05, 1.0, 3.0])
    vh = np.array([0.001, 0.2, 10**-0.5, 1e-3, 0.0, 0.4])
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(vv, vh, strict=True)], "vv double, vh double")
    got = np.array([list(r) for r in df.select(*[c.alias(n) for n, c in zip("rgb", pixels.radar_rgb(F.col("vv"), F.col("vh")), strict=True)]).collect()])
    with np.errstate(divide="ignore"):
        r = (np.clip(10 * np.log10(vv), -25, 0) + 25) / 25
        g = (np.clip(10 * np.log10(vh), -30, -5) + 30) / 25
    assert np.allclose(got[:, 0], r) and np.allclose(got[:, 1], g) and np.allclose(got[:, 2], r / (g + 1e-6))
    null = spark.range(1).select(pixels.decibel_unit(F.lit(None).cast("double"), "vv").alias("v")).first()
    assert null["v"] is None


def test_quality_predicates(spark):
    rows = [([1.0, 2.0],), ([1.0, None],), ([0.0, 1.0],), ([4.0, 4.0],), ([3.0, 3.0],), ([2.0, 2.0],), ([None, 2.0],)]
    df = spark.createDataFrame(rows, "d array<double>")
    d = F.col("d")
    got = [tuple(r) for r in df.select(pixels.any_missing(d), pixels.any_unknown_class(d), pixels.any_flooded(d), pixels.uniform_class(d)).collect()]
    assert got == [(False, False, False, False), (True, True, False, True), (True, True, False, False), (False, False, True, True), (False, True, False, True), (False, False, False, True), (True, True, False, True)]


def test_checked_cast(spark):
    df = spark.createDataFrame([(1.9,), (-1.9,), (40000.0,), (None,)], "v double")
    assert [r[0] for r in df.select(pixels.checked_cast(F.col("v"), "smallint")).collect()] == [1, -1, None, None]
