import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from landweave.functions import geo
from landweave.operators import geometry, scenes

box = st.tuples(*[st.integers(-20, 20)] * 2, *[st.integers(1, 15)] * 2).map(lambda b: np.array([[b[0], b[1]], [b[0] + b[2], b[1]], [b[0] + b[2], b[1] + b[3]], [b[0], b[1] + b[3]]], dtype=float))


def raster_area(rings, test):
    grid = np.zeros((80, 80), dtype=int)
    for r in rings:
        (x0, y0), (x1, y1) = r.min(axis=0).astype(int) + 30, r.max(axis=0).astype(int) + 30
        grid[y0:y1, x0:x1] += 1
    return int(test(grid).sum())


@given(st.lists(box, min_size=1, max_size=5))
@settings(max_examples=60, deadline=None)
def test_union_area_of_boxes(rings):
    assert geo.area(rings) == pytest.approx(raster_area(rings, lambda g: g > 0))


@given(box, box)
@settings(max_examples=60, deadline=None)
def test_intersection_commutes_and_has_the_right_area(a, b):
    ab, ba = geo.intersect([a], [b]), geo.intersect([b], [a])
    want = raster_area([a, b], lambda g: g == 2)
    assert geo.area(ab) == pytest.approx(want) and geo.area(ba) == pytest.approx(want)
    if ab:
        assert geo.bounds(ab) == pytest.approx(geo.bounds(ba))


def test_centroid():
    triangle = [np.array([[0, 0], [2, 0], [0, 2]], dtype=float)]
    assert geo.centroid(triangle) == pytest.approx((2 / 3, 2 / 3))


def test_wkt_round_trip():
    text = "MULTIPOLYGON (((0.0 0.0, 2.0 0.0, 2.0 2.0, 0.0 0.0)), ((5.0 5.0, 6.0 5.0, 6.0 6.0, 5.0 5.0)))"
    assert geo.to_wkt(geo.parse_wkt(text)) == text
    assert geo.parse_wkt(None) == [] and geo.to_wkt([]) is None
    text = "MULTIPOLYGON (((0.0 0.0, 9.0 0.0, 9.0 9.0, 0.0 9.0, 0.0 0.0), (1.0 1.0, 1.0 2.0, 2.0 2.0, 1.0 1.0)), ((1.2 1.5, 1.4 1.5, 1.4 1.6, 1.2 1.5)))"
    assert geo.to_wkt(geo.parse_wkt(text)) == text
    assert geo.to_wkt(geo.parse_wkt("POLYGON ((0 0, 0 9, 9 9, 9 0, 0 0), (2 2, 4 2, 4 4, 2 4, 2 2))")).startswith("POLYGON ((9.0 0.0, ")


def test_utm_inverse_undoes_forward(spark):
    rows = []
    for lon, lat, epsg in [(9.0, 48.0, 32632), (11.9, 60.2, 32632), (-70.1, -33.4, 32719), (3.0, 0.001, 32631), (15.0, -0.5, 32733)]:
        e, n = geo.utm_forward(np.array([lon]), np.array([lat]), epsg)
        rows.append((lon, lat, epsg, float(e[0]), float(n[0])))
    df = spark.createDataFrame(rows, "lon double, lat double, epsg int, e double, n double")
    lon, lat = geo.utm_inverse(F.col("e"), F.col("n"), F.col("epsg"))
    for r in df.select("lon", "lat", lon.alias("lon2"), lat.alias("lat2")).collect():
        assert r["lon2"] == pytest.approx(r["lon"], abs=1e-8) and r["lat2"] == pytest.approx(r["lat"], abs=1e-8)


def test_utm_at_a_central_meridian():
    e, n = geo.utm_forward(np.array([9.0]), np.array([0.0]), 32632)
    assert e[0] == pytest.approx(500000.0) and n[0] == pytest.approx(0.0, abs=1e-6)


def test_mercator(spark):
    row = spark.range(1).select(geo.mercator_x(F.lit(180.0)).alias("x"), geo.mercator_y(F.lit(85.0511287798)).alias("y")).first()
    assert row["x"] == pytest.approx(math.pi * geo.EARTH) and row["y"] == pytest.approx(math.pi * geo.EARTH, rel=1e-6)


def test_common_footprint_drops_undated_scenes(spark):
    def wkt(x0, y0, x1, y1):
        return f"POLYGON (({x0} {y0}, {x1} {y0}, {x1} {y1}, {x0} {y1}, {x0} {y0}))"

    rows = [(1, "a", "d1", wkt(0, 0, 4, 4)), (1, "a", "d1", wkt(4, 0, 8, 4)), (1, "b", "d1", wkt(2, 1, 9, 9)), (1, "b", None, wkt(20, 20, 21, 21)), (2, "a", "d1", wkt(0, 0, 1, 1)), (2, "b", "d1", wkt(5, 5, 6, 6))]
    df = spark.createDataFrame(rows, "k int, collection string, day string, g string")
    got = {r["k"]: tuple(r)[1:] for r in geometry.common_footprint(df, "k", ["collection", "day"], "g").collect()}
    assert got[1] == (2.0, 1.0, 8.0, 4.0)
    assert all(v is None or math.isnan(v) for v in got[2])


@pytest.mark.parametrize("cell", [0.5, 5.0, 400.0])
def test_box_join_gives_each_pair_once(spark, cell):
    rng = np.random.default_rng(1)

    def boxes(n, name):
        xy, wh = rng.uniform(-50, 50, (n, 2)), rng.uniform(0.1, 12, (n, 2)) * rng.choice([0.0, 0.01, 1, 1, 30], (n, 1))
        return [(i, (float(a), float(b), float(a + w), float(b + h))) for i, ((a, b), (w, h)) in enumerate(zip(xy, wh, strict=True))], f"{name} int, {name}_box struct<minx:double,miny:double,maxx:double,maxy:double>"

    (ra, sa), (rb, sb) = boxes(60, "a"), boxes(80, "b")
    got = scenes.box_overlaps(spark.createDataFrame(ra, sa), spark.createDataFrame(rb, sb), "a_box", "b_box", cell).select("a", "b").collect()
    want = {(i, j) for i, p in ra for j, q in rb if p[0] <= q[2] and q[0] <= p[2] and p[1] <= q[3] and q[1] <= p[3]}
    assert len(got) == len(want) and {tuple(r) for r in got} == want
