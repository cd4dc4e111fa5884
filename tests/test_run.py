"""Batches of areas: a failure at any sink and a restart give what an undisturbed run gives; an area that fails, fails alone."""

import pytest
from pyspark.sql import functions as F

from landweave.config import RunConfig
from landweave.plans import run
from landweave.schemas import AOI, CHIP_LOG
from landweave.sources import chiplog, geojson

from .test_sources import TREE

BOX = "POLYGON ((1.0 0.0, 1.0 1.0, 0.0 1.0, 0.0 0.0, 1.0 0.0))"
TEXT = [c.split()[0] for c in CHIP_LOG.split(", ") if c.endswith(" string")]


@pytest.fixture
def areas(spark):
    return spark.createDataFrame([(k, BOX, (0.0, 0.0, 1.0, 1.0), "not processed") for k in (0, 1, 3, 4, 6, 7, 9)], AOI)


def given(each):
    return run.Given(RunConfig.from_dict({**TREE, "rules": {"batch_areas": each}}), None, None)


def small(bad=()):
    """Two chips for each area but the fourth, in order; raises where a bad area is among them."""

    def process(areas, start, given, work):
        found = sorted(r[0] for r in areas.select(run.KEY).collect())
        if set(found) & set(bad):
            raise ValueError(f"no such raster\nin {found}")
        spark = areas.sparkSession
        chips = [(start + n, k) for n, k in enumerate(k for k in found if k != 4 for _ in range(2))]
        log = spark.createDataFrame(chips, "chip_index bigint, aoi_index bigint").withColumns({c: F.lit("a,b") for c in TEXT if c != "status"}).withColumns({"lulc": F.lit(2), "epsg": F.lit(32632), "status": F.lit("success")})
        return run.Done(log, areas.select(run.KEY, F.lit("success").alias("status")), spark.createDataFrame([], run.UNREAD), len(chips))

    return process


def results(spark, work):
    log = sorted((r["chip_index"], r["aoi_index"], r["status"]) for r in run.log_of(spark, work).collect())
    return log, {r["aoi_index"]: r["status"] for r in geojson.read_areas(spark, f"{work}/aois.geojson").collect()}


def test_any_batch_size_gives_the_same(spark, areas, tmp_path, monkeypatch):
    monkeypatch.setattr(run, "process", small())
    found = []
    for each in (2, 3, 100):
        work = str(tmp_path / str(each))
        (tmp_path / str(each)).mkdir()
        run.run(areas, given(each), work, f"{work}/aois.geojson")
        found.append(results(spark, work))
    assert found[0] == found[1] == found[2]
    assert [c[:2] for c in found[0][0]] == list(enumerate([0, 0, 1, 1, 3, 3, 6, 6, 7, 7, 9, 9])) and set(found[0][1].values()) == {"success"}


@pytest.mark.parametrize("sink", ["status", "log", "log half written", "state"])
def test_a_failed_sink_and_a_restart(spark, areas, tmp_path, monkeypatch, sink):
    work = str(tmp_path)
    monkeypatch.setattr(run, "process", small())
    count = {"n": 0}

    def failing(f, at):
        def g(*args, **kwargs):
            count["n"] += 1
            if count["n"] == at:
                if sink == "log half written":
                    (tmp_path / "chip_log" / "batch=1" / "_temporary").mkdir(parents=True)
                raise OSError("the disk is full")
            return f(*args, **kwargs)

        return g

    with monkeypatch.context() as m:
        if sink == "status":
            m.setattr(run, "reduce", failing(run.reduce, 4))  # the second batch's statuses
        elif sink == "state":
            m.setattr(geojson, "write_collection", failing(geojson.write_collection, 3))
        else:
            m.setattr(chiplog, "write_log", failing(chiplog.write_log, 2))
        with pytest.raises(OSError):
            run.run(areas, given(3), work, f"{work}/aois.geojson")
    assert len(run.batches(f"{work}/chip_log")) == (2 if sink == "state" else 1)
    run.run(areas, given(3), work, f"{work}/aois.geojson")
    log, status = results(spark, work)
    assert [c[:2] for c in log] == list(enumerate([0, 0, 1, 1, 3, 3, 6, 6, 7, 7, 9, 9]))
    assert set(status.values()) == {"success"} and len(status) == 7


def test_an_area_that_fails_fails_alone(spark, areas, tmp_path, monkeypatch):
    work = str(tmp_path)
    monkeypatch.setattr(run, "process", small(bad={3, 9}))
    run.run(areas, given(5), work, f"{work}/aois.geojson")
    log, status = results(spark, work)
    assert [c[:2] for c in log] == list(enumerate([0, 0, 1, 1, 6, 6, 7, 7]))
    assert {k: s for k, s in status.items() if s != "success"} == {3: "ValueError: no such raster", 9: "ValueError: no such raster"}
    # what has failed behind the last area of the log is tried again
    monkeypatch.setattr(run, "process", small())
    run.run(areas, given(5), work, f"{work}/aois.geojson")
    log, status = results(spark, work)
    assert [c[:2] for c in log][-2:] == [(8, 9), (9, 9)] and status[9] == "success" and status[3].startswith("ValueError")
