"""Schemas of the tables that plans exchange; nothing is inferred from files."""

from __future__ import annotations

BBOX = "struct<minx:double,miny:double,maxx:double,maxy:double>"
AOI = f"aoi_index bigint, geom string, bbox {BBOX}, status string"
SCENE = (
    f"item_id string, collection string, dt timestamp, geom string, bbox {BBOX}, epsg int, proj_code string, "
    "cloud double, nodata_pct double, mgrs_tile string, rel_orbit int, platform string, wrs_path string"
)
SEASON = "season_idx int, range_start timestamp, range_end timestamp"
GRID = f"path int, bbox {BBOX}"
BLOCK = "aoi_index bigint, source string, t timestamp, band string, wy int, wx int, n int, data array<double>"
SOURCES = ("s2l2a", "s1rtc", "lc2l2")
ID_COLUMNS = tuple(f"{s}_scene_ids" for s in ("s2l2a", "s1rtc", "lc2l2", "lulc", "dem"))
CHIP_LOG = (
    "chip_index bigint, aoi_index bigint, s2l2a_dates string, s1rtc_dates string, lc2l2_dates string, lulc int, "
    "chip_footprint string, epsg int, status string, " + ", ".join(f"{c} string" for c in ID_COLUMNS)
)
