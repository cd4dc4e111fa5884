import io
import json
import urllib.error

import numpy as np
import pytest
from pyspark.sql import functions as F

from landweave.config import RunConfig, parse_args
from landweave.operators import scenes
from landweave.sources import chiplog, geojson, images, release, scene_catalog
from landweave.streaming import incremental

TREE = {
    "dataset": {"version": "v1"},
    "aoi": {"version": "v1"},
    "directory": {"working": "w", "output": "o"},
    "s2l2a": {"collection": "sentinel-2-l2a", "time_ranges": ["2023-01-01/2023-03-31", "2023-04-01/2023-06-30", "2023-07-01/2023-09-30", "2023-10-01/2023-12-31"], "cloud_cover": 30, "nodata_pixel_percentage": 5, "bands": ["B01", "B02", "B03", "B04", "SCL"], "cloud_band": "SCL", "resolution": 10, "native_crs": True, "fill_na": False, "na_value": -999, "dtype": "int16"},
    "s1rtc": {"collection": "sentinel-1-rtc", "delta_days": 12, "nodata_pixel_percentage": 5, "bands": ["vv", "vh"], "resolution": 10, "native_crs": False, "fill_na": False, "na_value": -999, "dtype": "float32"},
    "lc2l2": {"collection": "landsat-c2-l2", "delta_days": 91, "platforms": ["landsat-8", "landsat-9"], "cloud_cover": 50, "bands": ["red", "qa_pixel"], "cloud_band": "qa_pixel", "resolution": 30, "native_crs": False, "fill_na": False, "na_value": -999, "dtype": "float32"},
    "dem": {"collection": "cop-dem-glo-30", "year": "2021-01-02/2021-12-31", "resolution": 30, "native_crs": False, "fill_na": False, "na_value": -999, "dtype": "float32"},
    "lulc": {"collection": "io-lulc-annual-v02", "year": "2023-01-02/2023-12-31", "resolution": 10, "native_crs": False, "sampling_factor": None, "fill_na": False, "na_value": 0, "dtype": "int8"},
    "chips": {"sample_size": 40, "chip_size": 40},
}


def test_config_is_strict():
    cfg = RunConfig.from_dict(TREE)
    assert cfg.s2l2a.spark_type == "smallint" and cfg.chips.pixels(30) == (1, 1, 0)
    assert cfg.s2l2a.seasons()[0][2].isoformat() == "2023-03-31T23:59:59"
    with pytest.raises(TypeError):
        RunConfig.from_dict({**TREE, "chips": {"sample_size": 1, "chip_size": 1, "more": 2}})
    with pytest.raises(TypeError):
        RunConfig.from_dict({k: v for k, v in TREE.items() if k != "dem"})
    with pytest.raises(TypeError):
        RunConfig.from_dict({**TREE, "odd": 1})
    assert parse_args([]).config == "config.yml" and parse_args(["-c", "x.yml"]).config == "x.yml"


def test_config_from_yaml(tmp_path):
    import yaml

    (tmp_path / "c.yml").write_text(yaml.safe_dump(TREE))
    assert RunConfig.from_yaml(tmp_path / "c.yml") == RunConfig.from_dict(TREE)
    assert release.snapshot_config(tmp_path / "c.yml", tmp_path / "v").exists()


def test_areas_round_trip(spark, tmp_path):
    square = [[[0.0, 0.0], [2.0, 0.0], [2.0, 1.0], [0.0, 1.0], [0.0, 0.0]]]
    features = [{"type": "Feature", "properties": {"name": "x"}, "geometry": {"type": "Polygon", "coordinates": square}}, {"type": "Feature", "properties": {"aoi_index": 9, "status": "success"}, "geometry": {"type": "MultiPolygon", "coordinates": [square]}}]
    (tmp_path / "a.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    got = geojson.read_areas(spark, str(tmp_path / "a.geojson"))
    rows = {r["aoi_index"]: r for r in got.collect()}
    assert set(rows) == {0, 9} and rows[0]["status"] == "not processed" and rows[9]["status"] == "success"
    assert tuple(rows[0]["bbox"]) == (0.0, 0.0, 2.0, 1.0)
    geojson.write_collection(got, "geom", str(tmp_path / "b.geojson"))
    again = {r["aoi_index"]: r for r in geojson.read_areas(spark, str(tmp_path / "b.geojson")).collect()}
    assert tuple(again[9]["bbox"]) == (0.0, 0.0, 2.0, 1.0) and again[9]["status"] == "success"


def test_chip_log_round_trip(spark, tmp_path):
    df = chiplog.empty_log(spark)
    rows = [(1, 0, "20230101,20230401", "[]", "a", 2, "POLYGON ((0 0, 1 0, 1 1, 0 0))", 32632, "success", "x,y", None, 'q"uote', "l", "d"), (2, 0, "[]", "[]", "[]", None, None, 32632, "lulc_values_wrong", "x", "x", "x", "x", "x")]
    new = spark.createDataFrame(rows, df.schema)
    chiplog.write_log(new, str(tmp_path / "log"))
    chiplog.write_log(new.where("chip_index = 2"), str(tmp_path / "log"))
    got = chiplog.read_log(spark, str(tmp_path / "log")).orderBy("chip_index").collect()
    assert [tuple(r) for r in got] == [rows[0], rows[1], rows[1]]
    lists = spark.createDataFrame([(1, ["a", "b"]), (2, [])], "k int, v array<string>")
    assert [r["v"] for r in chiplog.flat_lists(lists).orderBy("k").collect()] == ["a,b", "[]"]


def test_scene_source_prunes_by_pushed_filters(spark, tmp_path):
    items = [{"id": f"s{k}", "collection": "c1" if k % 2 else "c2", "bbox": [0, 0, 1, 1], "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}, "properties": {"datetime": f"2023-01-{k + 1:02}T10:00:00Z" if k else None, "eo:cloud_cover": float(k)}} for k in range(8)]
    for k in range(2):
        (tmp_path / f"p{k}.ndjson").write_text("\n".join(map(json.dumps, items[k::2])) + "\n")
    spark.dataSource.register(scene_catalog.SceneItems)
    df = spark.read.format("scene_items").load(str(tmp_path))
    assert df.count() == 8 and df.where("dt IS NULL").count() == 1
    found = df.where("collection = 'c1' AND cloud < 5")
    assert sorted(r["item_id"] for r in found.collect()) == ["s1", "s3"]
    reader = scene_catalog.SceneReader(str(tmp_path), 1)
    from pyspark.sql.datasource import EqualTo, StringContains

    left = list(reader.pushFilters([EqualTo(("collection",), "c2"), StringContains(("item_id",), "s")]))
    assert len(left) == 1 and [r[0] for p in reader.partitions() for r in reader.read(p)] == ["s0", "s2", "s4", "s6"]


def test_fetch_retries_gateway_errors():
    calls = []

    def opener(url):
        calls.append(url)
        if len(calls) < 3:
            raise urllib.error.HTTPError(url, 503, "busy", {}, None)
        return io.BytesIO(b"ok")

    assert scene_catalog.fetch("u", backoff=0, opener=opener, sign=lambda u: u + "?s") == b"ok" and calls == ["u?s"] * 3

    def broken(url):
        raise urllib.error.HTTPError(url, 404, "no", {}, None)

    with pytest.raises(urllib.error.HTTPError):
        scene_catalog.fetch("u", backoff=0, opener=broken)


@pytest.mark.parametrize("dtype", ["int16", "float32", "int8", "uint8"])
def test_geotiff_round_trip(dtype):
    a = (np.arange(2 * 5 * 7).reshape(2, 5, 7) % 100).astype(dtype)
    got, at = images.read_geotiff(images.geotiff(a, 32632, 500000.0, 5300000.0, 10.0, -999))
    assert (got == a).all() and at == {"epsg": 32632, "resolution": 10.0, "minx": 500000.0, "maxy": 5300000.0}


def test_images_and_release_copies(spark, tmp_path):
    rows = [("s2l2a_000001_0_20230101.png", [[1.0, 2.0, 3.0, 4.0]] * 3, 2)]
    made = images.encode_chips(spark.createDataFrame(rows, "name string, data array<array<double>>, n int"), "png")
    written = images.write_images(made, str(tmp_path / "work")).collect()
    assert written[0]["size"] == (tmp_path / "work" / rows[0][0]).stat().st_size
    assert (tmp_path / "work" / rows[0][0]).read_bytes()[:8] == images.PNG_SIGNATURE
    manifest = spark.createDataFrame([(rows[0][0], "s2l2a_000000_20230101.png"), ("gone.tif", "x.tif")], "src string, dst string")
    release.check_distinct(manifest)
    assert {r["dst"]: r["copied"] for r in release.copy_files(manifest, str(tmp_path / "work"), str(tmp_path / "out")).collect()} == {"s2l2a_000000_20230101.png": True, "x.tif": False}
    with pytest.raises(ValueError, match="more than one"):
        release.check_distinct(manifest.unionByName(manifest))


def test_archives_are_written_by_tasks(spark, tmp_path):
    import zipfile

    rng = np.random.default_rng(3)
    files = {f"{d}f {k}.bin": rng.integers(0, 9, int(rng.integers(0, 200_000))).astype(np.uint8).tobytes() for d in ("", "a/", "a/b+c/") for k in range(8)}
    for name, data in files.items():
        (tmp_path / "out" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "out" / name).write_bytes(data)
    members = release.archive(spark, str(tmp_path / "out"), str(tmp_path / "zips"), "one")
    assert {r["path"]: r["size"] for r in members.collect()} == {n: len(d) for n, d in files.items()}
    release.archive(spark, f"file://{tmp_path}/out", f"file://{tmp_path}/zips", "some", 300_000)
    release.archive(spark, str(tmp_path / "out"), str(tmp_path / "zips"), "some", 300_000)  # again: replaced by equal ones
    names = sorted(p.name for p in (tmp_path / "zips").iterdir())
    assert names[0] == "one.zip" and len(names) > 3 and all(n.startswith("some-0") for n in names[1:])
    for group in (names[:1], names[1:]):
        found = {}
        for n in group:
            with zipfile.ZipFile(tmp_path / "zips" / n) as z:
                assert z.testzip() is None
                found |= {m: z.read(m) for m in z.namelist()}
        assert found == files


def test_stream_appends_each_file_once(spark, tmp_path):
    source, out, mark = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mark")
    schema = "k long, v string"
    spark.createDataFrame([(1, "a"), (2, "b")], schema).write.parquet(source)
    run = lambda: incremental.append_batches(spark.readStream.schema(schema).parquet(source), lambda b: b, out, mark)
    run()
    run()
    assert spark.read.parquet(out).count() == 2
    spark.createDataFrame([(3, "c")], schema).write.mode("append").parquet(source)
    run()
    assert sorted(r["k"] for r in spark.read.parquet(out).collect()) == [1, 2, 3]


def test_ragged_union_and_status_order(spark):
    a, b = spark.createDataFrame([(1, "x")], "k int, a string"), spark.createDataFrame([(2, 5)], "k int, b int")
    assert scenes.ragged_union(a, b).columns == ["k", "a", "b"]
    counts = {"n_s2l2a_seasons": 4, "n_s2l2a": 4, "n_s1rtc": 4, "n_lc2l2": 4, "n_lc2l2_dates": 3, "n_s1rtc_dates": 2, "n_lulc": 1, "n_dem": None}
    df = spark.createDataFrame([tuple(counts.values())], ", ".join(f"{c} int" for c in counts))
    assert scenes.area_status(df, 4).first()["status"] == "lc2l2 dates insufficient"


def test_searches_are_read_page_by_page():
    pages = {"http://x/1": {"features": [{"id": "a"}], "links": [{"rel": "next", "href": "http://x/2?k=1"}]}, "http://x/2?k=1": {"features": [{"id": "b"}, {"id": "c"}], "links": []}}
    asked = []

    def get(url, sign=None):
        asked.append(sign(url) if sign else url)
        return json.dumps(pages[url])

    assert [i["id"] for i in scene_catalog.fetch_items("http://x/1", "sig=z", get)] == ["a", "b", "c"]
    assert asked == ["http://x/1?sig=z", "http://x/2?k=1&sig=z"]


def test_time_filters_are_taken_over(spark, tmp_path):
    items = [{"id": f"s{k}", "collection": "c", "bbox": [0, 0, 1, 1], "properties": {"datetime": f"2023-01-{k + 1:02}T10:00:00Z" if k else None}} for k in range(8)]
    (tmp_path / "p.ndjson").write_text("\n".join(map(json.dumps, items)))
    df = scene_catalog.read_scenes(spark, str(tmp_path / "p.ndjson"))
    found = df.where("dt >= TIMESTAMP '2023-01-03 10:00:00' AND dt < TIMESTAMP '2023-01-05 10:00:00'")
    assert sorted(r["item_id"] for r in found.collect()) == ["s2", "s3"]
    plan = found._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert "Filter (" not in plan or "dt" not in plan.split("Filter (")[1].split("\n")[0] or "PushedFilters" in plan


def test_rasters_become_blocks(spark, tmp_path):
    import datetime as dt

    a = np.arange(2 * 7 * 9, dtype=np.float32).reshape(2, 7, 9)
    a[0, 1, 1] = -999
    (tmp_path / "x.tif").write_bytes(images.geotiff(a, 32632, 0.0, 0.0, 10.0, -999))
    from landweave.sources import rasters

    manifest = spark.createDataFrame([("x.tif", 4, "dem", dt.datetime(2023, 1, 1), ["u", "v"], 3)], rasters.MANIFEST)
    got = {(r["band"], r["wy"], r["wx"]): r["data"] for r in rasters.read_blocks(manifest, str(tmp_path), -999).collect()}
    assert len(got) == 2 * 2 * 3
    for (b, wy, wx), data in got.items():
        want = a["uv".index(b), 3 * wy : 3 * wy + 3, 3 * wx : 3 * wx + 3].ravel().tolist()
        assert data == [None if v == -999 else v for v in want]


def test_missing_copies_raise(spark, tmp_path):
    manifest = spark.createDataFrame([("gone.tif", "x.tif")], "src string, dst string")
    with pytest.raises(FileNotFoundError, match=r"x\.tif"):
        release.copy_all(manifest, str(tmp_path), str(tmp_path / "out"))


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from landweave.session import shared_folder

    def session(master, **conf):
        kept = dict(conf)
        context = SimpleNamespace(master=master, getConf=lambda: SimpleNamespace(get=kept.get))
        return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda k, d=None: kept.get(k, d), set=kept.__setitem__))

    with pytest.raises(ValueError, match="checkpoint"):
        shared_folder(session("spark://host:7077"))
    assert shared_folder(session("yarn", **{"spark.checkpoint.dir": "hdfs:///x/"})) == "hdfs:///x"
    local = session("local[2]")
    assert shared_folder(local) == shared_folder(local)


def test_features_in_parts_have_geometry_and_keep_other_partitions(spark, tmp_path):
    square = "POLYGON ((0 0, 2 0, 2 1, 0 1, 0 0))"
    df = spark.createDataFrame([(1, "a", square), (2, "b", square)], "k int, v string, g string")
    geojson.write_features(df, "g", str(tmp_path / "f"), "k")
    geojson.write_features(df.where("k = 2").selectExpr("k", "'c' AS v", "g"), "g", str(tmp_path / "f"), "k")
    got = {r["v"]: r["geom"] for r in geojson.read_features(spark, str(tmp_path / "f"), "v string").collect()}
    assert set(got) == {"a", "c"} and all(g.startswith("POLYGON ((0.0 0.0") for g in got.values())


def shapefile(paths):
    """A zipped shapefile of squares, made by hand."""
    import struct
    import zipfile

    shp, dbf = bytes(100), struct.pack("<BBBBIHH20x", 3, 0, 0, 0, len(paths), 32 + 2 * 32 + 1, 1 + 6 + 5)
    for name, size in ((b"NAME", 6), (b"PATH", 5)):
        dbf += name.ljust(11, b"\0") + b"N" + bytes(4) + bytes([size, 0]) + bytes(14)
    dbf += b"\r"
    for k, (path, (x0, y0, x1, y1)) in enumerate(paths):
        points = [(x0, y0), (x0, y1), (x1, y1), (x1, y0), (x0, y0)]
        body = struct.pack("<i4dii", 5, x0, y0, x1, y1, 1, 5) + struct.pack("<i", 0) + b"".join(struct.pack("<2d", *p) for p in points)
        shp += struct.pack(">II", k + 1, len(body) // 2) + body
        dbf += b" " + b"x".ljust(6) + str(path).rjust(5).encode()
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        z.writestr("g.shp", shp)
        z.writestr("g.dbf", dbf)
    return raw.getvalue()


def test_grid_is_read_from_a_zip_an_address_or_a_table(spark, tmp_path):
    from landweave.sources import grid

    paths = [(7, (0.0, 1.0, 2.0, 3.0)), (193, (-10.5, 4.0, -8.0, 6.25))]
    raw = shapefile(paths)
    plain = lambda df: sorted((r["path"], tuple(r["bbox"])) for r in df.collect())
    asked = []
    remote = grid.read_grid(spark, str(tmp_path / "g.zip"), "http://x/g.zip", lambda url: asked.append(url) or raw)
    assert plain(remote) == paths and asked == ["http://x/g.zip"]
    (tmp_path / "g.zip").write_bytes(raw)
    assert plain(grid.read_grid(spark, str(tmp_path / "g.zip"), "http://x/g.zip", None)) == paths
    remote.write.parquet(str(tmp_path / "table"))
    assert plain(grid.read_grid(spark, str(tmp_path / "table"))) == paths
    with pytest.raises(FileNotFoundError):
        grid.read_grid(spark, str(tmp_path / "none.zip"))


def test_stream_leaves_out_repeats_of_a_key_across_batches(spark, tmp_path):
    source, out, mark = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mark")
    schema = "k long, v string"
    run = lambda: incremental.append_batches(spark.readStream.schema(schema).parquet(source), lambda b: b, out, mark, "k")
    for rows in ([(1, "a"), (2, "b"), (2, "b")], [(2, "c"), (3, "d")], [(1, "e")]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        run()
    assert sorted((r["k"], r["v"]) for r in spark.read.parquet(out).select("k", "v").collect()) == [(1, "a"), (2, "b"), (3, "d")]


def test_a_search_sends_its_request(spark):
    """A server that answers by time, box and collection, two items a page, and keeps what it was asked."""
    import threading
    from datetime import datetime
    from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
    from urllib.parse import parse_qs, urlsplit

    asked: list[dict] = []
    items = [{"id": f"s{k}", "collection": "c" if k % 3 else "other", "bbox": [k, 0, k + 1, 1], "properties": {"datetime": f"2023-01-{k + 1:02}T10:00:00Z", "eo:cloud_cover": float(k)}} for k in range(28)]

    class Server(BaseHTTPRequestHandler):
        def do_GET(self):
            q = {k: v[0] for k, v in parse_qs(urlsplit(self.path).query).items()}
            asked.append(q)
            a, b = (datetime.fromisoformat(x.replace("Z", "+00:00")) for x in q["datetime"].split("/"))
            x0, _, x1, _ = map(float, q["bbox"].split(","))
            most = json.loads(q["query"])["eo:cloud_cover"]["lte"]
            found = [i for i in items if i["collection"] in q["collections"].split(",") and a <= datetime.fromisoformat(i["properties"]["datetime"].replace("Z", "+00:00")) <= b and i["bbox"][0] <= x1 and i["bbox"][2] >= x0 and i["properties"]["eo:cloud_cover"] <= most]
            at = int(q.get("at", 0))
            page = {"features": found[at : at + 2], "links": [{"rel": "next", "href": f"http://{self.headers['Host']}{self.path.split('&at=')[0]}&at={at + 2}"}] if at + 2 < len(found) else []}
            self.send_response(200)
            self.end_headers()
            self.wfile.write(json.dumps(page).encode())

        def log_message(self, *args):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Server)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        catalogue = scene_catalog.read_scenes(spark, f"http://127.0.0.1:{server.server_port}/search", slices="4", signature="key=1")
        start, end = (F.lit(x).cast("timestamp") for x in ("2023-01-03 10:00:00", "2023-01-24 10:00:00"))
        found = scene_catalog.search(catalogue, ["c"], start, end, F.col("cloud") < 21, (4.5, 0.0, 30.0, 9.0))
        got = sorted(r["item_id"] for r in found.collect())
    finally:
        server.shutdown()
    want = [f"s{k}" for k in range(2, 24) if k % 3 and k < 21 and k + 1 >= 4.5]
    assert got == sorted(want)
    assert all(q["collections"] == "c" and q["bbox"] == "4.5,0,30,9" and q["key"] == "1" and q["limit"] == "250" for q in asked)
    firsts = [q for q in asked if "at" not in q]
    assert len({q["datetime"] for q in firsts}) == 4 and len(asked) > len(firsts)  # slices, and pages of their own
    assert min(q["datetime"] for q in firsts).startswith("2023-01-03T10:00:00") and json.loads(firsts[0]["query"]) == {"eo:cloud_cover": {"lte": 21.0}}
