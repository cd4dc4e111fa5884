"""A small world end to end: two areas with scenes and blocks, one without a season."""

import datetime as dt
import json

import numpy as np
import pytest

from landweave.config import RunConfig
from landweave.plans import pipeline
from landweave.schemas import AOI, BLOCK, GRID, SCENE

from .test_sources import TREE

DAYS = [dt.datetime(2023, m, 10, 10) for m in (2, 5, 8, 11)]


def rect(x0, y0, x1, y1):
    return f"POLYGON (({x1} {y0}, {x1} {y1}, {x0} {y1}, {x0} {y0}, {x1} {y0}))", (float(x0), float(y0), float(x1), float(y1))


def scene(i, collection, t, box, **more):
    geom, bbox = rect(*box)
    base = {"item_id": i, "collection": collection, "dt": t, "geom": geom, "bbox": bbox, "epsg": None, "proj_code": "EPSG:32632", "cloud": 10.0, "nodata_pct": 1.0, "mgrs_tile": "T1", "rel_orbit": 5, "platform": "landsat-8", "wrs_path": "007"}
    return tuple({**base, **more}.values())


@pytest.fixture(scope="module")
def world(spark):
    cfg = RunConfig.from_dict(TREE)
    areas = [(k, *rect(9 + 4 * k, 48, 9.1 + 4 * k, 48.1), "not processed") for k in range(3)]
    rows = []
    for k in range(3):
        foot = (8.5 + 4 * k, 47.5, 9.6 + 4 * k, 48.6)
        for q, t in enumerate(DAYS):
            if k == 1 and q == 2:
                continue
            rows.append(scene(f"s2-{k}-{q}", "sentinel-2-l2a", t, foot, cloud=5.0))
            rows.append(scene(f"s2-{k}-{q}-clear", "sentinel-2-l2a", t, foot, cloud=1.0 if q else 9.0, mgrs_tile="T2"))
            rows.append(scene(f"s2-{k}-{q}-cloudy", "sentinel-2-l2a", t, foot, cloud=30.0))
            rows.append(scene(f"s1-{k}-{q}", "sentinel-1-rtc", t + dt.timedelta(days=3), foot))
            rows.append(scene(f"s1-{k}-{q}-part", "sentinel-1-rtc", t + dt.timedelta(days=1), (foot[0], foot[1], foot[0] + 0.3, foot[3]), rel_orbit=9))
            rows.append(scene(f"l8-{k}-{q}", "landsat-c2-l2", t + dt.timedelta(days=20), foot, cloud=3.0))
            rows.append(scene(f"l8-{k}-{q}-other", "landsat-c2-l2", t, foot, cloud=1.0, wrs_path="008"))
        rows.append(scene(f"lulc-{k}", "io-lulc-annual-v02", dt.datetime(2023, 6, 1), foot))
        rows.append(scene(f"dem-{k}", "cop-dem-glo-30", dt.datetime(2021, 4, 22), foot))
    grid = [(7, (5.0, 45.0, 25.0, 55.0)), (8, (-60.0, 45.0, 8.6, 55.0))]
    return cfg, spark.createDataFrame(areas, AOI), spark.createDataFrame(rows, SCENE), spark.createDataFrame(grid, GRID)


def test_selection(spark, world):
    cfg, areas, catalogue, grid = world
    chosen, checked = pipeline.select_scenes(areas, catalogue, grid, cfg)
    got = {}
    for r in chosen.collect():
        got.setdefault((r["aoi_index"], r["source"]), []).append(r["item_id"])
    assert sorted(got[0, "s2l2a"]) == [f"s2-0-{q}" for q in range(4)]
    assert sorted(got[0, "s1rtc"]) == [f"s1-0-{q}" for q in range(4)]
    assert sorted(got[2, "lc2l2"]) == [f"l8-2-{q}" for q in range(4)]
    assert got[0, "lulc"] == ["lulc-0"] and got[0, "dem"] == ["dem-0"]
    assert {r["aoi_index"]: r["status"] for r in checked.collect()} == {0: "success", 1: "s2l2a scenes insufficient", 2: "success"}
    ids = {r["aoi_index"]: r for r in pipeline.scene_id_lists(chosen).collect()}
    assert ids[0]["s2l2a_scene_ids"] == "s2-0-0,s2-0-1,s2-0-2,s2-0-3"


def blocks_of(cfg):
    """4 x 4 windows of 4 x 4 pixels for area 0: class 2 all over but for some windows."""
    t0, rows = dt.datetime(2023, 1, 1), []
    sources = {"lulc": ["lulc"], "dem": ["dem"], "s2l2a": cfg.s2l2a.bands, "s1rtc": cfg.s1rtc.bands, "lc2l2": cfg.lc2l2.bands}
    for wy in range(4):
        for wx in range(4):
            for source, bands in sources.items():
                n = 4 if source in ("lulc", "s2l2a", "s1rtc") else 1
                for t in DAYS if source in ("s2l2a", "s1rtc", "lc2l2") else [t0]:
                    for b in bands:
                        v = np.full(n * n, {"lulc": 2.0, "SCL": 4.0, "qa_pixel": 64.0}.get(b, 0.2 if source == "s1rtc" else 500.0))
                        if source == "lulc" and (wy, wx) == (0, 1):
                            v[:] = 4  # flooded
                        if source == "lulc" and (wy, wx) == (0, 2):
                            v[0] = 1  # mixed: no candidate
                        if source == "lulc" and (wy, wx) == (1, 0):
                            v[3] = np.nan
                        if source == "dem" and (wy, wx) == (1, 1):
                            v[0] = 0
                        if b == "SCL" and (wy, wx) == (2, 0) and t == DAYS[0]:
                            v[5] = 9  # cloud
                        rows.append((0, source, t, b, wy, wx, n, v.tolist()))
    return rows


def test_chips_and_release(spark, world):
    cfg, *_ = world
    blocks = spark.createDataFrame(blocks_of(cfg), BLOCK)
    areas = spark.createDataFrame([(0, "success", 32632, 500000.0, 5300000.0, 4, 4)], "aoi_index bigint, status string, epsg int, minx double, maxy double, rows int, cols int")
    ids = spark.createDataFrame([(0, *["x,y"] * 5)], "aoi_index bigint, s2l2a_scene_ids string, s1rtc_scene_ids string, lc2l2_scene_ids string, lulc_scene_ids string, dem_scene_ids string")
    log = pipeline.make_chips(blocks, areas, ids, cfg).cache()
    got = {(r["wy"], r["wx"]): r for r in log.collect()}
    status = {k: r["status"] for k, r in got.items()}
    assert (0, 2) not in got and len(got) == 15
    assert status[0, 0] == "success" and status[0, 1] == "lulc_values_flooded_vegetation" and status[1, 0] == "lulc missing values"
    assert status[1, 1] == "dem missing values" and status[2, 0] == "s2l2a missing values"
    assert status[3, 0] == status[0, 3] == "edge_out_of_bounds"
    assert sorted(r["chip_index"] for r in got.values()) == list(range(15))
    assert got[0, 0]["s2l2a_dates"] == "20230210,20230510,20230810,20231110" and got[1, 1]["s2l2a_dates"] == "[]"
    table = pipeline.release(log, cfg, "t/").orderBy("id").collect()
    assert [r["id"] for r in table] == list(range(len(table))) and {r["category"] for r in table} == {"Trees"}
    assert table[0]["lon"] == pytest.approx(9.0, abs=0.01) and table[0]["lat"] == pytest.approx(47.85, abs=0.01)
    assert table[0]["s1rtc_thumbs"].startswith("t/s1rtc_000000_20230210.png,")
    thumbs = pipeline.thumbnails(blocks, log, "s1rtc", cfg)
    assert thumbs.count() == 4 * sum(s == "success" for s in status.values())
    assert {len(p) for r in thumbs.collect() for p in r["data"]} == {16}


def test_a_block_of_another_size_fails_its_window_alone(spark, world):
    cfg, *_ = world
    rows = [(*r[:7], r[7][:3]) if (r[1], r[4], r[5]) in (("dem", 0, 0), ("s2l2a", 1, 2)) and len(r[7]) > 3 else (*r[:7], [*r[7], 500.0]) if (r[1], r[4], r[5]) == ("dem", 0, 0) else r for r in blocks_of(cfg)]
    areas = spark.createDataFrame([(0, "success", 32632, 500000.0, 5300000.0, 4, 4)], "aoi_index bigint, status string, epsg int, minx double, maxy double, rows int, cols int")
    ids = spark.createDataFrame([(0, *["x"] * 5)], "aoi_index bigint, s2l2a_scene_ids string, s1rtc_scene_ids string, lc2l2_scene_ids string, lulc_scene_ids string, dem_scene_ids string")
    got = {(r["wy"], r["wx"]): r["status"] for r in pipeline.make_chips(spark.createDataFrame(rows, BLOCK), areas, ids, cfg).collect()}
    assert got[0, 0] == "dem missing values" and got[1, 2] == "s2l2a missing values" and got[2, 1] == "success"


def test_orbit_is_chosen_by_area_in_metres(spark, world):
    """Two orbits whose order differs between degrees and EPSG:3857: high latitudes weigh more."""
    cfg, _, _, grid = world
    foot = (10.0, 50.0, 11.0, 70.0)
    south, north = (10.0, 50.0, 11.0, 60.4), (10.0, 60.4, 11.0, 70.0)  # more degrees in the south, more metres in the north
    anchors = spark.createDataFrame([(0, 0, DAYS[0], DAYS[0] - dt.timedelta(days=20), DAYS[0] + dt.timedelta(days=20), rect(*foot)[0], rect(*foot)[1])], "aoi_index bigint, season_idx int, center timestamp, range_start timestamp, range_end timestamp, footprint string, foot_box struct<minx:double,miny:double,maxx:double,maxy:double>")
    rows = [scene("south", "sentinel-1-rtc", DAYS[0], south, rel_orbit=1), scene("north", "sentinel-1-rtc", DAYS[0], north, rel_orbit=2)]
    catalogue = spark.createDataFrame(rows, SCENE).withColumnRenamed("geom", "scene_geom")
    assert [r["item_id"] for r in pipeline.radar_scenes(anchors, catalogue, cfg).collect()] == ["north"]


def test_a_malformed_area_and_scenes_apart_fail_alone(spark, world):
    cfg, areas, catalogue, grid = world
    broken = spark.createDataFrame([(7, "POLYGON ((1 x, y 2, 3 4))", (9.0, 48.0, 9.1, 48.1), "not processed")], AOI)
    moved = [scene("dem-far", "cop-dem-glo-30", dt.datetime(2021, 4, 22), (17.45, 48.5, 17.55, 48.6))]  # meets area 2's first scene, not its Landsat scenes
    chosen, checked = pipeline.select_scenes(areas.unionByName(broken), catalogue.unionByName(spark.createDataFrame(moved, SCENE)), grid, cfg)
    status = {r["aoi_index"]: r for r in checked.collect()}
    assert status[7]["status"] == pipeline.MALFORMED and status[0]["status"] == "success"
    assert tuple(status[0]["common"]) == pytest.approx((8.5, 47.5, 9.6, 48.6))


@pytest.mark.parametrize("margin", [0, 2])
def test_chip_images_have_margins_and_places(spark, world, margin):
    cfg = RunConfig.from_dict({**TREE, "chips": {"sample_size": 40, "chip_size": 40 + 20 * margin}, "rules": {"reject_edge": False}})
    blocks = spark.createDataFrame(blocks_of(cfg), BLOCK)
    areas = spark.createDataFrame([(0, "success", 32632, 500000.0, 5300000.0, 4, 4)], "aoi_index bigint, status string, epsg int, minx double, maxy double, rows int, cols int")
    log = spark.createDataFrame([(0, 2, 2, 5, "success"), (0, 3, 1, 6, "dem missing values")], "aoi_index bigint, wy int, wx int, chip_index bigint, status string")
    rows = pipeline.chip_images(blocks, log, areas, "s2l2a", cfg).collect()
    assert sorted(r["name"] for r in rows) == [f"s2l2a_000005_{k}_{d:%Y%m%d}.tif" for k, d in enumerate(DAYS)]
    side = 4 + 2 * margin
    assert all((r["n"], r["minx"], r["maxy"]) == (side, 500080.0 - 10 * margin, 5299920.0 + 10 * margin) and len(r["data"]) == 4 for r in rows)
    a = np.array(rows[0]["data"][0]).reshape(side, side)
    assert (a[margin : margin + 4, margin : margin + 4] == 500).all() and (a == 500).sum() == 16 and (a == -999).sum() == side * side - 16
    assert [r["name"] for r in pipeline.chip_images(blocks, log, areas, "dem", cfg).collect()] == ["dem_000005.tif"]
    assert [r["name"] for r in pipeline.chip_images(blocks, log, areas, "lulc", cfg).collect()] == ["lc_000005.tif"]
    assert {r["n"] for r in pipeline.thumbnails(blocks, log, "s2l2a", cfg).collect()} == {side}


def test_main_runs_and_goes_on(spark, world, tmp_path):
    import yaml

    from landweave.plans import run
    from landweave.sources import geojson, images

    cfg, areas, catalogue, grid = world
    tree = {**TREE, "lc2l2": {**TREE["lc2l2"], "bands": ["coastal", "blue", "green", "red", "qa_pixel"]}, "directory": {"working": str(tmp_path / "w"), "output": str(tmp_path / "o")}}
    (tmp_path / "c.yml").write_text(yaml.safe_dump(tree))
    (tmp_path / "w").mkdir()
    geojson.write_collection(areas, "geom", str(tmp_path / "w" / "aois_v1.geojson"))
    catalogue.write.parquet(str(tmp_path / "scenes"))
    grid.write.parquet(str(tmp_path / "scenes_grid"))
    place = "aoi_index bigint, epsg int, minx double, maxy double, rows int, cols int"
    spark.createDataFrame([(k, 32632, 500000.0 + 5000 * k, 5300000.0, 4, 4) for k in range(3)], place).write.parquet(str(tmp_path / "blocks_areas"))
    blocks = blocks_of(RunConfig.from_dict(tree))
    spark.createDataFrame(blocks, BLOCK).write.parquet(str(tmp_path / "blocks"))
    argv = ["-c", str(tmp_path / "c.yml"), "--scenes", str(tmp_path / "scenes"), "--blocks", str(tmp_path / "blocks")]
    pipeline.main(argv)
    work, out = tmp_path / "w" / "v1", tmp_path / "o" / "v1"
    status = lambda: {r["aoi_index"]: r["status"] for r in geojson.read_areas(spark, str(work / "aois.geojson")).collect()}
    assert status() == {0: "success", 1: "s2l2a scenes insufficient", 2: "success"}
    first = run.log_of(spark, str(work)).collect()
    good = [r for r in first if r["status"] == "success"]
    # every successful chip has its files, and every released one its copies
    for r in good:
        i = f"{r['chip_index']:06}"
        for s in ("s2l2a", "s1rtc", "lc2l2"):
            for k, day in enumerate(r[f"{s}_dates"].split(",")):
                assert (work / f"{s}_{i}_{k}_{day}.tif").exists() and (work / f"{s}_{i}_{k}_{day}.png").exists()
        assert (work / f"lc_{i}.tif").exists() and (work / f"dem_{i}.tif").exists()
    values, at = images.read_geotiff((work / f"s2l2a_{good[0]['chip_index']:06}_0_20230210.tif").read_bytes())
    assert values.shape == (4, 4, 4) and at["epsg"] == 32632 and (values == 500).all()
    released = json.loads((out / "tracker.geojson").read_text())["features"]
    assert len(released) == len(good) and [f["properties"]["id"] for f in released]
    # the second run goes on behind area 0, with blocks of area 2
    spark.createDataFrame([(2, *r[1:]) for r in blocks], BLOCK).write.mode("append").parquet(str(tmp_path / "blocks"))
    pipeline.main(argv)
    again = run.log_of(spark, str(work)).collect()
    assert sorted(r["chip_index"] for r in again) == list(range(2 * len(first)))
    assert {r["aoi_index"] for r in again if r["chip_index"] >= len(first)} == {2}
    assert status() == {0: "success", 1: "s2l2a scenes insufficient", 2: "success"}
    assert {"aoi_index=0", "aoi_index=2"} <= {p.name for p in (work / "scenes").glob("aoi_index=*")}
    assert len(json.loads((out / "tracker.geojson").read_text())["features"]) == 2 * len(good)
    feature = json.loads(next((work / "scenes" / "aoi_index=0").glob("*.txt")).read_text().splitlines()[0])
    assert feature["geometry"]["type"] == "Polygon" and feature["properties"]["item_id"]


def files_of(blocks, corner, shift=0.0):
    """The blocks' values as one array for each source, time and band, and where they are."""
    found = {}
    for _, source, t, band, wy, wx, n, data in blocks:
        found.setdefault((source, t), {}).setdefault(band, np.full((4 * n, 4 * n), np.nan))[wy * n : wy * n + n, wx * n : wx * n + n] = np.array(data).reshape(n, n)
    return found


def test_main_from_raster_files(spark, world, tmp_path):
    """Scenes' files in place of blocks: tiled, compressed, one of them damaged and one lost."""
    import yaml

    from landweave.plans import run
    from landweave.sources import geojson, images

    cfg, areas, catalogue, grid = world
    tree = {**TREE, "lc2l2": {**TREE["lc2l2"], "bands": ["coastal", "blue", "green", "red", "qa_pixel"]}, "directory": {"working": str(tmp_path / "w"), "output": str(tmp_path / "o")}}
    cfg = RunConfig.from_dict(tree)
    (tmp_path / "c.yml").write_text(yaml.safe_dump(tree))
    (tmp_path / "w").mkdir()
    geojson.write_collection(areas, "geom", str(tmp_path / "w" / "aois_v1.geojson"))
    catalogue.write.parquet(str(tmp_path / "scenes"))
    grid.write.parquet(str(tmp_path / "scenes_grid"))
    chosen, checked = pipeline.select_scenes(areas, catalogue, grid, cfg)
    corner = {r["aoi_index"]: r for r in pipeline.area_grids(checked.join(pipeline.area_systems(chosen, catalogue), "aoi_index"), cfg).collect()}
    assert corner[0]["epsg"] == 32632 and corner[0]["minx"] % 10 == 0 and corner[0]["rows"] > 2000 and corner[0]["cols"] > 1500
    assets = []
    for area in (0, 2):
        for (source, t), bands in files_of(blocks_of(cfg), corner).items():
            q = DAYS.index(t) if t in DAYS else None
            item = f"{ {'s2l2a': 's2', 's1rtc': 's1', 'lc2l2': 'l8'}.get(source, source) }-{area}" + ("" if q is None else f"-{q}")
            values = np.nan_to_num(np.stack(list(bands.values())), nan=-999).astype("f4")
            step = 160 / values.shape[1]
            path = f"{area}/{item}.tif"
            (tmp_path / "files" / str(area)).mkdir(parents=True, exist_ok=True)
            raw = images.geotiff(values, 32632, corner[area]["minx"], corner[area]["maxy"], step, -999, tile=16 if step < 40 else None)
            if item != "s1-2-1":  # area 2 has lost one
                (tmp_path / "files" / path).write_bytes(raw[: len(raw) // 2] if item == "dem-2" else raw)
            assets.append((item, path, list(bands)))
    spark.createDataFrame(assets, "item_id string, path string, bands array<string>").write.parquet(str(tmp_path / "assets"))
    pipeline.main(["-c", str(tmp_path / "c.yml"), "--scenes", str(tmp_path / "scenes"), "--assets", str(tmp_path / "assets"), "--rasters", str(tmp_path / "files")])
    work = tmp_path / "w" / "v1"
    log = run.log_of(spark, str(work)).collect()
    status = {}
    for r in log:
        status.setdefault(r["aoi_index"], []).append(r["status"])
    want = {"success": 9, "lulc_values_flooded_vegetation": 1, "lulc missing values": 1, "dem missing values": 1, "s2l2a missing values": 1}
    assert {k: status[0].count(k) for k in want} == {**want, "success": 15 - 4} and len(status[0]) == 15
    assert status[2].count("dem missing values") == 13 and "success" not in status[2]
    unread = {(r["aoi_index"], r["source"]): r["error"] for r in spark.read.parquet(*map(str, (work / "unread").glob("batch=*"))).collect()}
    assert set(unread) == {(2, "dem"), (2, "s1rtc")} and "FileNotFound" in unread[2, "s1rtc"]
    good = next(r for r in log if r["status"] == "success")
    values, at = images.read_geotiff((work / f"s2l2a_{good['chip_index']:06}_0_20230210.tif").read_bytes())
    assert (values == 500).all() and (at["minx"] - corner[0]["minx"]) % 40 == 0


def test_an_image_that_cannot_be_made_fails_its_chip_alone(spark, world, tmp_path):
    cfg, *_ = world
    rows = [(*r[:7], [70_000.0] * len(r[7])) if (r[1], r[4], r[5]) == ("s2l2a", 1, 2) and r[3] != "SCL" else r for r in blocks_of(cfg)]  # more than an int16 holds
    blocks = spark.createDataFrame(rows, BLOCK)
    areas = spark.createDataFrame([(0, "success", 32632, 500000.0, 5300000.0, 4, 4)], "aoi_index bigint, status string, epsg int, minx double, maxy double, rows int, cols int")
    ids = spark.createDataFrame([(0, *["x"] * 5)], "aoi_index bigint, s2l2a_scene_ids string, s1rtc_scene_ids string, lc2l2_scene_ids string, lulc_scene_ids string, dem_scene_ids string")
    log = pipeline.make_chips(blocks, areas, ids, cfg).cache()
    failures = pipeline.write_chips(blocks, log, areas, cfg, str(tmp_path))
    after = {(r["wy"], r["wx"]): r["status"] for r in pipeline.with_failures(log, failures).collect()}
    before = {(r["wy"], r["wx"]): r["status"] for r in log.collect()}
    assert before[1, 2] == "success" and "no int16" in after[1, 2]
    assert {k: s for k, s in after.items() if k != (1, 2)} == {k: s for k, s in before.items() if k != (1, 2)}
