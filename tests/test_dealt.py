"""Steps that cost much for each row are dealt over the tasks, however few files the rows come from."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from landweave.functions import overlay
from landweave.operators import geometry
from landweave.plans import catalog
from landweave.sources import geojson

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["polygon_meeting", "wkt_boxes", "union_overlap", "polygon_centroids", "geojson_parts"])
def test_polygons_are_dealt(spark, name):
    rows = catalog.queries()[name](spark, SF).select(F.spark_partition_id().alias("p"))
    assert rows.distinct().count() > 1


def test_equal_polygons_are_united_once(spark, monkeypatch):
    square = "POLYGON ((0 0, 2 0, 2 2, 0 2, 0 0))"
    df = spark.range(500).selectExpr("id % 2 AS k", f"'{square}' AS g")
    united = geometry.dissolved(df, ["k"], "g")
    assert united.where(F.length("g") > 0).count() == 2
    plan = united._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1  # the distinct texts, before any are united


def test_unions_of_many_take_few_sweeps(monkeypatch):
    sweeps = []

    class Counted(overlay.Overlay):
        def __init__(self, groups, rule):
            sweeps.append(len(groups))
            super().__init__(groups, rule)

    monkeypatch.setattr(overlay, "Overlay", Counted)
    squares = [[np.array([[x, y], [x + 2, y], [x + 2, y + 2], [x, y + 2]], dtype=float)] for x in range(16) for y in range(8)]
    found = overlay.union(squares[::-1])
    assert len(found) == 1 and sorted(map(tuple, found[0].tolist())) == [(0.0, 0.0), (0.0, 9.0), (17.0, 0.0), (17.0, 9.0)]
    assert len(sweeps) < 64


def test_collection_is_read_by_line(spark, tmp_path):
    areas = spark.range(0, 500, 1, 3).selectExpr("id AS aoi_index", "concat('POLYGON ((', id, ' 0, ', id + 1, ' 0, ', id, ' 1, ', id, ' 0))') AS geom", "'x, \"y\"' AS status")
    geojson.write_collection(areas, "geom", str(tmp_path / "a.geojson"))
    got = geojson.read_areas(spark, str(tmp_path / "a.geojson"))
    assert "value" in got._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r["aoi_index"], r["bbox"]["minx"], r["status"]) for r in got.collect()) == [(k, float(k), 'x, "y"') for k in range(500)]
    # without an index, places are counted through all splits; the same as in a file that is read whole
    text = (tmp_path / "a.geojson").read_text().replace("aoi_index", "other")
    (tmp_path / "b.geojson").write_text(text)
    (tmp_path / "c.geojson").write_text(json.dumps(json.loads(text)))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        b, c = ([(r["aoi_index"], r["bbox"]["minx"]) for r in geojson.read_areas(spark, str(tmp_path / f"{n}.geojson")).collect()] for n in "bc")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert sorted(b) == sorted(c) == [(k, float(k)) for k in range(500)]
    (tmp_path / "d.geojson").write_text(text.replace('{"type": "Feature"', "damaged", 1))
    with pytest.raises(Exception, match="no feature"):
        geojson.read_areas(spark, str(tmp_path / "d.geojson")).collect()


def test_radar_pairs_are_dealt(spark):
    from landweave.plans import pipeline

    box, geom = "struct(0.0D AS minx, 0.0D AS miny, 1.0D AS maxx, 1.0D AS maxy)", "'POLYGON ((0 0, 1 0, 1 1, 0 0))'"
    areas = spark.range(1).selectExpr(f"{box} AS box", f"{geom} AS geom")
    scenes = spark.range(0, 64, 1, 1).selectExpr("id", f"{box} AS bbox", f"{geom} AS scene_geom")
    met = pipeline.meeting(areas, scenes, "box", "geom").withColumn("p", F.spark_partition_id())
    assert met.count() == 64 and met.select("p").distinct().count() > 1


def test_full_and_partial_blocks(spark):
    from landweave.operators import raster

    pixels = spark.range(48).selectExpr("id DIV 8 AS y", "id % 8 AS x", "CAST(id AS double) AS v").where("NOT (y = 5 AND x = 6)")
    blocks = {(r["wy"], r["wx"]): r["data"] for r in raster.to_blocks(pixels, [], "v", 4).collect()}
    at = lambda y, x: float(8 * y + x) if y < 6 and (y, x) != (5, 6) else None
    assert blocks == {(a, b): [at(4 * a + i, 4 * b + j) for i in range(4) for j in range(4)] for a in range(2) for b in range(2)}
