"""From areas and a scene catalogue to selected scenes, chips and a release table.

All areas go through one plan. An area or a window that fails keeps its row and says why in status.
"""

from __future__ import annotations

import math
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import RunConfig, parse_args
from ..functions import geo, names, pixels, timefn
from ..operators import chips, curate, geometry, raster, scenes
from ..schemas import ID_COLUMNS, SEASON, SOURCES
from ..session import dealt, held
from ..sources import rasters

AREA_KEYS = ["aoi_index"]
WINDOW_KEYS = ["aoi_index", "wy", "wx"]
#: Cell width in degrees of the join of areas and scenes.
CELL = 2.0
#: Fixed value: scenes of a search, at most.
SEARCH_LIMIT = 50
#: Statuses of areas that fail outside the search.
MALFORMED, APART = "aoi geometry malformed", "scenes without a common footprint"


def seasons_of(spark: SparkSession, cfg: RunConfig) -> DataFrame:
    return spark.createDataFrame(cfg.s2l2a.seasons(), SEASON)


def meeting(areas: DataFrame, catalogue: DataFrame, box: str, geom: str) -> DataFrame:
    """Area and scene rows whose polygons meet: grid cells, then boxes, then the polygons."""
    pairs = scenes.box_overlaps(areas, catalogue.withColumnRenamed("bbox", "scene_box"), box, "scene_box", CELL)
    return dealt(pairs).where(geometry.polygons_meet(F.col(geom), F.col("scene_geom")))


def optical_scenes(areas: DataFrame, catalogue: DataFrame, cfg: RunConfig) -> DataFrame:
    """The least cloudy scene of each area and season; all seasons on the first one's tile."""
    found = catalogue.where((F.col("collection") == cfg.s2l2a.collection) & scenes.optical_predicate(cfg.s2l2a.nodata_pixel_percentage, cfg.s2l2a.cloud_cover))
    near = meeting(areas.select("aoi_index", F.col("geom").alias("aoi_geom"), F.col("bbox").alias("aoi_box")), found, "aoi_box", "aoi_geom")
    seasons = seasons_of(areas.sparkSession, cfg)  # some rows, from the configuration
    timed = near.join(F.broadcast(seasons), scenes.within(F.col("dt"), F.col("range_start"), F.col("range_end")))
    order = [F.asc(c) for c in ("cloud", "dt", "item_id")]
    return scenes.locked_top(timed, "aoi_index", "season_idx", 0, order, "mgrs_tile")


def season_anchors(optical: DataFrame, grid: DataFrame) -> DataFrame:
    """Centre time and window of each area's seasons, the first scene's footprint, epsg and path."""
    first = scenes.top_per_group(optical, AREA_KEYS, [F.asc("season_idx")])
    first = first.select("aoi_index", names.epsg_of(F.col("epsg"), F.col("proj_code")).alias("area_epsg"), F.col("scene_geom").alias("footprint"), F.col("scene_box").alias("foot_box"))
    reference = grid.select("path", F.col("bbox").alias("grid_box"))
    pairs = scenes.box_overlaps(first, reference, "foot_box", "grid_box", 10.0)
    area = geo.box_intersection_area(geo.mercator_box(F.col("foot_box")), geo.mercator_box(F.col("grid_box")))
    paths = scenes.largest_overlap(pairs, AREA_KEYS, area, ["path"]).select("aoi_index", "path")
    anchored = optical.select("aoi_index", "season_idx", "range_start", "range_end", F.col("dt").alias("center"))
    return anchored.join(first.join(paths, "aoi_index", "left"), "aoi_index")


def _windowed(anchors: DataFrame, catalogue: DataFrame, collection: str, days: int, where: Column | None = None) -> DataFrame:
    found = catalogue.where(F.col("collection") == collection)
    low, high = timefn.clipped_window(F.col("center"), F.col("range_start"), F.col("range_end"), days)
    pairs = meeting(anchors, found, "foot_box", "footprint").where(scenes.within(F.col("dt"), low, high))
    return pairs if where is None else pairs.where(where)


def radar_scenes(anchors: DataFrame, catalogue: DataFrame, cfg: RunConfig) -> DataFrame:
    """Scenes on the date nearest to each season's centre, of the 50 nearest, all of the orbit that is best in the first season."""
    pairs = _windowed(anchors, catalogue, cfg.s1rtc.collection, cfg.s1rtc.delta_days).withColumn("distance", timefn.apart(F.col("center"), F.col("dt")))
    near = held(pairs, "radar-pairs")  # read twice, and dear: polygons are held against each other
    first = near.where("season_idx = 0")
    orbits = first.groupBy("aoi_index", "rel_orbit", "footprint").agg(F.collect_set("scene_geom").alias("geoms"), F.min("distance").alias("distance"))
    plane = orbits.withColumn("area", geometry.mercator_overlap_area("geoms", "footprint"))
    locked = scenes.top_per_group(plane, AREA_KEYS, [F.desc("area"), F.asc("distance"), F.asc("rel_orbit")]).select("aoi_index", F.col("rel_orbit").alias("orbit"))
    of_orbit = near.join(locked, "aoi_index").where(F.col("rel_orbit") == F.col("orbit"))
    top = scenes.top_per_group(of_orbit, ["aoi_index", "season_idx"], [F.asc("distance"), F.asc("dt"), F.asc("item_id")], SEARCH_LIMIT)
    return scenes.best_date_rows(top, ["aoi_index", "season_idx"], "dt", ["distance", "dt", "item_id"])


def landsat_scenes(anchors: DataFrame, catalogue: DataFrame, cfg: RunConfig) -> DataFrame:
    """Scenes on the date of each season's least cloudy one, of the 50 least cloudy."""
    near = _windowed(anchors, catalogue, cfg.lc2l2.collection, cfg.lc2l2.delta_days, scenes.thermal_predicate(cfg.lc2l2.platforms, cfg.lc2l2.cloud_cover, F.col("path")))
    top = scenes.top_per_group(near, ["aoi_index", "season_idx"], [F.asc("cloud"), F.asc("dt"), F.asc("item_id")], SEARCH_LIMIT)
    return scenes.best_date_rows(top, ["aoi_index", "season_idx"], "dt", ["cloud", "dt", "item_id"])


def annual_scenes(anchors: DataFrame, catalogue: DataFrame, collection: str, year: str) -> DataFrame:
    start, end = (F.lit(x).cast("timestamp") for x in year.split("/"))
    once = anchors.select("aoi_index", "footprint", "foot_box").distinct()
    end = end + F.expr("INTERVAL '1' DAY") - F.expr("INTERVAL '1' SECOND")
    return meeting(once, catalogue.where((F.col("collection") == collection) & scenes.within(F.col("dt"), start, end)), "foot_box", "footprint")


def select_scenes(areas: DataFrame, catalogue: DataFrame, grid: DataFrame, cfg: RunConfig) -> tuple[DataFrame, DataFrame]:
    """Chosen scenes (aoi_index, source, season_idx, item_id, collection, dt, geom) and areas with their status."""
    catalogue = catalogue.withColumnRenamed("geom", "scene_geom")
    # each step's rows are stored: the next ones use them several times, and a box join twice more, so that one plan of all would grow by powers
    optical = held(optical_scenes(areas, catalogue, cfg), "optical")
    anchors = held(season_anchors(optical, grid), "anchors")
    parts = {
        "s2l2a": optical,
        "s1rtc": radar_scenes(anchors, catalogue, cfg),
        "lc2l2": landsat_scenes(anchors, catalogue, cfg),
        "lulc": annual_scenes(anchors, catalogue, cfg.lulc.collection, cfg.lulc.year),
        "dem": annual_scenes(anchors, catalogue, cfg.dem.collection, cfg.dem.year),
    }
    none = F.lit(None).cast("int")
    found = scenes.ragged_union(*[p.select("aoi_index", F.lit(s).alias("source"), (F.col("season_idx") if "season_idx" in p.columns else none).alias("season_idx"), "item_id", "collection", "dt", F.col("scene_geom").alias("geom")) for s, p in parts.items()])
    chosen = held(found, "chosen")
    of = lambda s: F.when(F.col("source") == s, F.to_date("dt"))
    counts = chosen.groupBy("aoi_index").agg(
        F.count_distinct(F.when(F.col("source") == "s2l2a", F.col("season_idx"))).alias("n_s2l2a_seasons"),
        *[F.count_if(F.col("source") == s).alias(f"n_{s}") for s in parts],
        *[F.count_distinct(of(s)).alias(f"n_{s}_dates") for s in ("lc2l2", "s1rtc")],
    )
    common = common_areas(chosen)
    checked = scenes.area_status(areas.drop("status").join(counts, "aoi_index", "left").join(common, "aoi_index", "left"), cfg.rules.required_dates)
    failures = [(~geometry.well_formed(F.col("geom")), MALFORMED), (F.col("status") != "success", F.col("status")), (F.col("common").isNull(), APART)]
    return chosen, checked.withColumn("status", scenes.first_failure(failures)).select("aoi_index", "geom", "bbox", "common", "status")


def common_areas(chosen: DataFrame) -> DataFrame:
    """common: bounds of what the scenes of all collections and dates of an area have in common, null for nothing."""
    found = geometry.common_footprint(chosen.withColumn("date", F.to_date("dt")), "aoi_index", ["collection", "date"], "geom")
    return found.select("aoi_index", F.when(F.col("minx").isNotNull(), F.struct("minx", "miny", "maxx", "maxy")).alias("common"))


PLACED = "struct<epsg:int,minx:double,maxy:double,rows:int,cols:int>"


def area_grids(areas: DataFrame, cfg: RunConfig) -> DataFrame:
    """epsg, minx, maxy, rows and cols of each area's windows, from common (degrees) and area_epsg.

    The common box is brought to the area's system, and widened to whole pixels of the coarsest source; what
    is left behind the last whole window has none.
    """
    coarsest = float(max(getattr(cfg, s).resolution for s in (*SOURCES, "lulc", "dem")))
    side = float(cfg.chips.sample_size)

    @F.pandas_udf(PLACED)
    def placed(common: pd.DataFrame, epsg: pd.Series) -> pd.DataFrame:
        rows = []
        for *box, code in zip(common["minx"], common["miny"], common["maxx"], common["maxy"], epsg, strict=True):
            try:
                minx, miny, maxx, maxy = geo.projected_bounds(tuple(box), 4326, int(code))
                minx, maxy = math.floor(minx / coarsest) * coarsest, math.ceil(maxy / coarsest) * coarsest
                width, height = math.ceil(maxx / coarsest) * coarsest - minx, maxy - math.floor(miny / coarsest) * coarsest
                rows.append((int(code), minx, maxy, int(height // side), int(width // side)))
            except (ValueError, OverflowError):  # no common box, no system or none that is known: no windows
                rows.append((None, None, None, 0, 0))
        return pd.DataFrame(rows, columns=["epsg", "minx", "maxy", "rows", "cols"]).astype({"epsg": "Int32", "rows": "int32", "cols": "int32"})

    found = areas.withColumn("__g", placed("common", "area_epsg"))
    return found.select("aoi_index", "status", *[F.col(f"__g.{c}").alias(c) for c in ("epsg", "minx", "maxy", "rows", "cols")])


def area_systems(chosen: DataFrame, catalogue: DataFrame) -> DataFrame:
    """area_epsg of each area: of its first season's optical scene."""
    first = scenes.top_per_group(chosen.where("source = 's2l2a'"), AREA_KEYS, [F.asc("season_idx")]).select("aoi_index", "item_id", "collection")
    codes = catalogue.select("item_id", "collection", names.epsg_of(F.col("epsg"), F.col("proj_code")).alias("area_epsg")).dropDuplicates(["item_id", "collection"])
    return first.join(codes, ["item_id", "collection"]).select("aoi_index", "area_epsg")


def file_parts(chosen: DataFrame, grids: DataFrame, assets: DataFrame, folder: str, source: str, cfg: RunConfig, windows: DataFrame | None = None) -> DataFrame:
    """Parts of one source's windows on the areas' grids, from the files of the chosen scenes.

    assets: item_id, path below folder, and bands in order. windows: the ones (aoi_index, wy, wx) that are wanted; tiles that
    reach none of them aren't read.
    """
    settings = getattr(cfg, source)
    n = cfg.chips.pixels(settings.resolution)[0]
    wanted = None if source in ("lulc", "dem") else settings.bands
    mine = chosen.where(F.col("source") == source).join(assets, "item_id")
    manifest = mine.select("path", "aoi_index", "source", F.col("dt").alias("t"), "bands").distinct()
    grid = F.struct("epsg", "minx", "maxy", F.lit(float(cfg.chips.sample_size)).alias("side"), F.lit(n).alias("n"), "rows", "cols").cast(rasters.GRID)
    placed = grids.where("status = 'success' AND rows > 0 AND cols > 0").select("aoi_index", grid.alias("grid"))
    if windows is not None:
        cells = windows.join(placed, "aoi_index").groupBy("aoi_index").agg(F.collect_set((F.col("wy") * F.col("grid.cols") + F.col("wx")).cast("int")).alias("only"))
        placed = placed.join(cells, "aoi_index")
    return rasters.read_parts(rasters.tile_table(manifest, folder, wanted).join(placed, "aoi_index"), folder)


def blocks_from_files(chosen: DataFrame, grids: DataFrame, assets: DataFrame, folder: str, cfg: RunConfig) -> tuple[DataFrame, DataFrame]:
    """Blocks (schemas.BLOCK) of all sources, and the files and tiles that couldn't be read with their errors.

    Land cover is read first; of the other sources only what its candidates need.
    """
    cover = held(file_parts(chosen, grids, assets, folder, "lulc", cfg), "cover-parts")
    blocks = held(rasters.put_together(cover), "cover")
    whole = source_blocks(blocks, "lulc", cfg).withColumn("data", F.transform("data", lambda v: pixels.checked_cast(v, "smallint").cast("double")))
    windows = held(chips.candidates(whole).select(*WINDOW_KEYS).distinct(), "candidate-windows")
    others = [file_parts(chosen, grids, assets, folder, s, cfg, windows) for s in (*SOURCES, "dem")]
    parts = held(scenes.ragged_union(*others), "parts")
    errors = cover.unionByName(parts).where(F.col("error").isNotNull()).select("aoi_index", "source", "t", "error")
    return scenes.ragged_union(blocks, rasters.put_together(parts)), errors


def scene_id_lists(chosen: DataFrame) -> DataFrame:
    """Comma-joined scene ids of each area and source, in order of selection."""
    out = chosen.select("aoi_index").distinct()
    for c in ID_COLUMNS:
        part = chosen.where(F.col("source") == c.removesuffix("_scene_ids"))
        ids = scenes.ids_in_order(part, AREA_KEYS, F.struct(F.coalesce("season_idx", F.lit(-1)), "dt", "item_id"), "item_id", c)
        out = out.join(ids, "aoi_index", "left")
    return out


def source_blocks(blocks: DataFrame, source: str, cfg: RunConfig) -> DataFrame:
    """One source's blocks, ready: bands chosen, clouds masked, composed or averaged over time."""
    settings = getattr(cfg, source)
    rows = blocks.where(F.col("source") == source).withColumn("data", F.transform("data", pixels.null_nan))
    keys = [*WINDOW_KEYS, "band"]
    if source in ("lulc", "dem"):
        return raster.mean_blocks(rows, keys)
    cloud = getattr(settings, "cloud_band", None)
    if source == "s2l2a" or (source == "lc2l2" and cfg.rules.mask_landsat):
        masks = rows.where(F.col("band") == cloud)
        rows = raster.mask_blocks(raster.select_bands(rows, settings.bands, drop=cloud), masks, [*WINDOW_KEYS, "t"], "class" if source == "s2l2a" else "bits")
    else:
        rows = raster.select_bands(rows, settings.bands)
    return rows.select(*keys, "t", "data") if source == "s2l2a" else raster.composite_blocks(rows, keys)


def source_quality(ready: DataFrame, source: str, cfg: RunConfig) -> DataFrame:
    """bad per window: a missing or zero value in any block after filling; and the dates."""
    settings = getattr(cfg, source)
    full = F.transform("data", lambda v: pixels.filled(v, settings.fill_na, settings.na_value)) if settings.fill_na else F.col("data")
    broken = F.size("data") != cfg.chips.pixels(settings.resolution)[0] ** 2  # a block of another size fails its window alone
    return ready.groupBy(*WINDOW_KEYS).agg(F.bool_or(pixels.any_missing(full) | broken).alias("bad"), F.array_join(F.array_sort(F.collect_set(timefn.day_stamp(F.col("t")))), ",").alias("dates"))


def make_chips(blocks: DataFrame, areas: DataFrame, ids: DataFrame, cfg: RunConfig, start: int = 0) -> DataFrame:
    """The chip log of all areas. areas: aoi_index, epsg, minx, maxy (upper left corner of window 0, 0), rows, cols.

    Land cover decides first; only its candidates' windows of the other sources are read further.
    """
    cover = source_blocks(blocks, "lulc", cfg)
    found = chips.candidates(cover.join(areas.where("status = 'success'"), "aoi_index"))
    margin = cfg.chips.pixels(cfg.lulc.resolution)[2] * cfg.lulc.resolution
    edge = (F.col("wy") == F.col("rows") - 1) | (F.col("wx") == F.col("cols") - 1) if cfg.rules.reject_edge else None
    if margin:  # a chip at the first row or column would reach beyond the stack
        first = (F.col("wy") == 0) | (F.col("wx") == 0)
        edge = first if edge is None else edge | first
    # as the int8 cast does, means are truncated
    sized = F.when(F.size("data") == cfg.chips.pixels(cfg.lulc.resolution)[0] ** 2, F.col("data")).otherwise(F.array(F.lit(None).cast("double")))
    whole = found.withColumn("data", F.transform(sized, lambda v: pixels.checked_cast(v, "smallint").cast("double")))
    state = whole.withColumn("lulc_status", chips.land_cover_status(F.col("data"), edge))
    state = chips.chip_class(state, "lulc_status", "data").drop("data", "t", "band")
    order = ["lc2l2", "dem", "s1rtc", "s2l2a"]
    wanted = state.where("lulc_status = 'ok'").select(*WINDOW_KEYS)
    for s in order:
        ready = source_blocks(blocks.where(F.col("source") == s).join(wanted, WINDOW_KEYS, "left_semi"), s, cfg)
        quality = source_quality(ready, s, cfg).select(*WINDOW_KEYS, F.col("bad").alias(f"{s}_bad"), F.col("dates").alias(f"{s}_dates"))
        state = state.join(quality, WINDOW_KEYS, "left").withColumn(f"{s}_bad", F.coalesce(f"{s}_bad", F.lit(True)))
    passed = F.col("lulc_status") == "ok"
    clean = ~(F.col("lc2l2_bad") | F.col("dem_bad") | F.col("s1rtc_bad") | F.col("s2l2a_bad"))
    held = chips.capped(state.withColumn("__ok", passed & clean), AREA_KEYS, "lulc", ["wy", "wx"], "__ok", cfg.rules.class_cap)
    failures = [(F.col(f"{s}_bad"), f"{s} missing values") for s in order]
    done = held.withColumn("status", chips.chip_status(F.col("lulc_status"), F.col("over_cap") & passed, F.col("lulc"), failures))
    numbered = chips.running_index(done, "aoi_index", ["wy", "wx"], "chip_index", start)
    side = float(cfg.chips.sample_size)
    x, y = F.col("minx") + F.col("wx") * side, F.col("maxy") - F.col("wy") * side
    box = F.struct((x - margin).alias("minx"), (y - side - margin).alias("miny"), (x + side + margin).alias("maxx"), (y + margin).alias("maxy"))
    good = F.col("status") == "success"
    full = numbered.join(ids, "aoi_index", "left").withColumn("chip_footprint", F.when(F.col("lulc_status").isin("ok", chips.WRONG, chips.FLOOD), geo.footprint_wkt(box, F.col("epsg"))))
    return full.select("chip_index", "aoi_index", *[F.when(good, F.col(f"{s}_dates")).otherwise(F.lit("[]")).alias(f"{s}_dates") for s in SOURCES], F.col("lulc").cast("int").alias("lulc"), "chip_footprint", "epsg", "status", *ID_COLUMNS, "wy", "wx")


def release(log: DataFrame, cfg: RunConfig, thumb_prefix: str = "") -> DataFrame:
    """The release table of a chip log."""
    kept = curate.releasable(log, cfg.rules.required_dates)
    kept = curate.balanced(kept, "lulc", "chip_index", cfg.lulc.sampling_factor, cfg.rules.seed)
    ids = chips.dense_ids(kept.withColumnRenamed("chip_index", "original_id"), "original_id", "id")
    at = ids.withColumn("__c", geometry.centroids("chip_footprint")).withColumns({"lat": F.col("__c.lat"), "lon": F.col("__c.lon"), "lulc": F.col("lulc").cast("string")}).drop("__c")
    return curate.with_paths(curate.labelled(at, "lulc"), thumb_prefix)


def chip_bands(source: str, cfg: RunConfig) -> list[str] | None:
    """The bands of a source's chips in order; None where it has one, whatever its name."""
    settings = getattr(cfg, source)
    if source in ("lulc", "dem"):
        return None
    masked = source == "s2l2a" or (source == "lc2l2" and cfg.rules.mask_landsat)
    return [b for b in settings.bands if not (masked and b == settings.cloud_band)]


def chip_images(blocks: DataFrame, log: DataFrame, areas: DataFrame, source: str, cfg: RunConfig) -> DataFrame:
    """What images.encode_chips() needs for each chip image of a source: of every step, or one where it has no time.

    log: a chip log with wy and wx. Values outside the sample, and missing ones, are the source's no-data value.
    """
    settings = getattr(cfg, source)
    sample, side, margin = cfg.chips.pixels(settings.resolution)
    good = log.where("status = 'success'").select(*WINDOW_KEYS, "chip_index")
    ready = source_blocks(blocks.where(F.col("source") == source).join(good.select(*WINDOW_KEYS), WINDOW_KEYS, "left_semi"), source, cfg)
    rows = ready.join(good, WINDOW_KEYS).groupBy(*WINDOW_KEYS, "chip_index", "t").agg(F.map_from_entries(F.collect_list(F.struct("band", "data"))).alias("m"))
    bands = chip_bands(source, cfg)
    planes = F.array(*[F.element_at("m", b) for b in bands]) if bands else F.map_values("m")
    whole = settings.fill_na or "int" in settings.dtype
    value = (lambda v: F.coalesce(v, F.lit(float(settings.na_value)))) if whole else (lambda v: v)
    data = F.transform(planes, lambda p: F.transform(raster.with_margin(p, sample, margin), value))
    placed = chips.numbered_in_group(rows, ["chip_index"], ["t"], "step").join(areas.select("aoi_index", "epsg", "minx", "maxy"), "aoi_index")
    width, reach = float(cfg.chips.sample_size), float(margin * settings.resolution)
    name = names.step_name(F.lit(source), F.col("chip_index"), F.col("step"), timefn.day_stamp(F.col("t")), "tif") if bands else names.plain_name("lc" if source == "lulc" else source, F.col("chip_index"))
    return placed.select(
        name.alias("name"), data.alias("data"), F.lit(side).alias("n"), F.lit(settings.dtype).alias("dtype"), "epsg",
        (F.col("minx") + F.col("wx") * width - reach).alias("minx"), (F.col("maxy") - F.col("wy") * width + reach).alias("maxy"), F.lit(float(settings.resolution)).alias("resolution"),
    )


def thumbnails(blocks: DataFrame, log: DataFrame, source: str, cfg: RunConfig) -> DataFrame:
    """name, data (three arrays of byte values) and n of the thumbnails of successful chips.

    The second to fourth band are blue, green and red; a source with fewer has no thumbnails.
    """
    settings = getattr(cfg, source)
    sample, side, margin = cfg.chips.pixels(settings.resolution)
    good = log.where("status = 'success'").select(*WINDOW_KEYS, "chip_index")
    ready = source_blocks(blocks.where(F.col("source") == source).join(good.select(*WINDOW_KEYS), WINDOW_KEYS, "left_semi"), source, cfg)
    if source != "s1rtc" and len(settings.bands) < 4:
        return good.where("false").select(F.lit("").alias("name"), F.array(F.array(F.lit(0).cast("bigint"))).alias("data"), F.lit(0).alias("n"))
    chosen = settings.bands if source == "s1rtc" else [settings.bands[k] for k in (3, 2, 1)]
    rows = ready.where(F.col("band").isin(*chosen)).groupBy(*WINDOW_KEYS, "t").agg(F.map_from_entries(F.collect_list(F.struct("band", "data"))).alias("m"))
    if source == "s1rtc":
        vv, vh = F.element_at("m", chosen[0]), F.element_at("m", chosen[1])
        rgb = F.zip_with(vv, vh, lambda a, b: F.struct(*[pixels.to_byte(v).alias(n) for v, n in zip(pixels.radar_rgb(a, b), "rgb", strict=True)]))
        planes = F.array(F.transform(rgb, lambda p: p["r"]), F.transform(rgb, lambda p: p["g"]), F.transform(rgb, lambda p: p["b"]))
    else:
        plane = lambda b: F.transform(F.element_at("m", b), lambda v: pixels.to_byte(pixels.stretch(v, F.array_max(F.element_at("m", b)))))
        planes = F.array(*[plane(b) for b in chosen])
    data = F.transform(planes, lambda p: F.transform(raster.with_margin(p, sample, margin), lambda v: F.coalesce(v, F.lit(0).cast("bigint"))))
    numbered = chips.numbered_in_group(rows.withColumn("data", data).join(good, WINDOW_KEYS), ["chip_index"], ["t"], "step")
    name = names.step_name(F.lit(source), F.col("chip_index"), F.col("step"), timefn.day_stamp(F.col("t")), "png")
    return numbered.select(name.alias("name"), "data", F.lit(side).alias("n"))


def near_scenes(catalogue: DataFrame, areas: DataFrame, cfg: RunConfig) -> DataFrame:
    """The catalogue's scenes of the run's collections and years around all areas: what a search server is asked for, once."""
    from ..sources import scene_catalog

    seasons = cfg.s2l2a.seasons()
    years = [x for y in (cfg.lulc.year, cfg.dem.year) for x in y.split("/")]
    box = areas.agg(F.min("bbox.minx"), F.min("bbox.miny"), F.max("bbox.maxx"), F.max("bbox.maxy")).first()
    days = F.expr("INTERVAL '1' DAY")
    first = F.least(*[F.lit(t).cast("timestamp") for t in [s[1] for s in seasons] + years])
    last = F.greatest(*[F.lit(t).cast("timestamp") for t in [s[2] for s in seasons] + years]) + days
    start, end = catalogue.sparkSession.range(1).select(first, last).first()
    names = [c.collection for c in (cfg.s2l2a, cfg.s1rtc, cfg.lc2l2, cfg.lulc, cfg.dem)]
    reach = 3.0  # degrees: later searches go by the footprint of a scene that meets an area, not by the area
    return scene_catalog.search(catalogue, names, start, end, None, (box[0] - reach, box[1] - reach, box[2] + reach, box[3] + reach))


def write_chips(blocks: DataFrame, log: DataFrame, areas: DataFrame, cfg: RunConfig, folder: str) -> DataFrame:
    """Writes the chip images and thumbnails of a log's successful chips; chip_index and error of those that have one that can't be made."""
    from ..sources import images

    made = [images.encode_chips(chip_images(blocks, log, areas, s, cfg), "tif") for s in ("s2l2a", "s1rtc", "lc2l2", "lulc", "dem")]
    made += [images.encode_chips(thumbnails(blocks, log, s, cfg), "png") for s in SOURCES]
    written = held(scenes.ragged_union(*[images.write_images(m, folder) for m in made]), "images")
    index = F.regexp_extract("name", "_([0-9]{6,})[_.]", 1).cast("bigint").alias("chip_index")
    return written.where(F.col("error").isNotNull()).groupBy(index).agg(F.min(F.concat_ws(" ", "name", "error")).alias("error"))


def with_failures(log: DataFrame, failures: DataFrame) -> DataFrame:
    """A log whose chips have failed where an image of theirs has."""
    joined = log.join(failures, "chip_index", "left")
    return joined.withColumn("status", F.coalesce("error", "status")).drop("error")


def main(argv: list[str] | None = None) -> None:
    """Search, chips and release of one run, from tables of areas, scenes and grid, and from raster files or tables of blocks.

    Areas go in batches (plans/run.py). A run that finds its chip log goes on behind the last area in it: chips are numbered on.
    """
    from ..session import build_session, ship
    from ..sources import geojson, grid, scene_catalog, store
    from ..sources import release as folders
    from . import run

    args = parse_args(argv)
    cfg = RunConfig.from_yaml(args.config)
    spark = build_session()
    ship(spark)
    work = Path(cfg.directory.working, cfg.dataset.version)
    folders.snapshot_config(args.config, work)
    state = f"{work}/aois.geojson"
    if store.exists(state):
        areas = held(geojson.read_areas(spark, state), "areas")
    else:
        found = geojson.read_areas(spark, f"{cfg.directory.working}/aois_{cfg.aoi.version}.geojson")
        areas = held(curate.exclude_include(found, "aoi_index", cfg.aoi.include_indices, cfg.aoi.exclude_indices).withColumn("status", F.lit("not processed")), "areas")
    catalogue = scene_catalog.read_scenes(spark, args.scenes)
    if args.scenes.startswith("http"):
        catalogue = held(near_scenes(catalogue, areas, cfg), "catalogue")
    given = run.Given(cfg, catalogue, grid.read_grid(spark, args.grid or f"{args.scenes}_grid", args.grid_url), args.blocks, args.assets, args.rasters)
    log = run.run(areas, given, str(work), state)
    out = Path(cfg.directory.output, cfg.dataset.version)
    folders.snapshot_config(args.config, out)
    table = held(release(log, cfg), "release")
    geojson.write_features(table, "chip_footprint", f"{out}/tracker")
    if cfg.rules.single_file:
        geojson.write_collection(table, "chip_footprint", f"{out}/tracker.geojson")
    manifest = curate.asset_manifest(table)
    folders.check_distinct(manifest)
    folders.copy_all(manifest, str(work), str(out))
    if cfg.directory.zip_output:
        folders.archive(spark, str(out if cfg.rules.zip_release else work), str(out.parent), f"{out.name}_archive")


if __name__ == "__main__":
    main()
