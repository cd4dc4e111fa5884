"""Typed run configuration, read from YAML with strict keys, and the command line."""

from __future__ import annotations

import argparse
from dataclasses import dataclass, field, fields
from datetime import datetime, timedelta
from pathlib import Path
from typing import Any

import numpy as np

#: Value types a source's pixels may be cast to, and their Spark types.
PIXEL_TYPES = {"int8": "tinyint", "int16": "smallint", "int32": "int", "float32": "float", "float64": "double"}


@dataclass(frozen=True)
class Source:
    """What all raster sources share."""

    collection: str
    resolution: int
    native_crs: bool
    fill_na: bool
    na_value: int
    dtype: str

    def __post_init__(self):
        name = np.dtype(self.dtype).name
        if name not in PIXEL_TYPES:
            raise ValueError(f"unknown pixel type {self.dtype!r}")
        object.__setattr__(self, "dtype", name)

    @property
    def spark_type(self) -> str:
        return PIXEL_TYPES[self.dtype]


@dataclass(frozen=True)
class Optical(Source):
    time_ranges: list[str]
    nodata_pixel_percentage: float
    cloud_cover: float
    cloud_band: str
    bands: list[str]

    def seasons(self) -> list[tuple[int, datetime, datetime]]:
        """Number, start and end of each season; an end is the last second of its day."""
        out = []
        for k, text in enumerate(self.time_ranges):
            first, last = (datetime.fromisoformat(x) for x in text.split("/"))
            out.append((k, first, last + timedelta(days=1, seconds=-1)))
        return out


@dataclass(frozen=True)
class Radar(Source):
    nodata_pixel_percentage: float
    delta_days: int
    bands: list[str]


@dataclass(frozen=True)
class Thermal(Source):
    platforms: list[str]
    cloud_cover: float
    cloud_band: str
    delta_days: int
    bands: list[str]


@dataclass(frozen=True)
class Annual(Source):
    year: str


@dataclass(frozen=True)
class LandCover(Annual):
    sampling_factor: float | None = None


@dataclass(frozen=True)
class Chips:
    sample_size: int
    chip_size: int

    def pixels(self, resolution: int) -> tuple[int, int, int]:
        """Sample and chip width in pixels and the margin between them, truncated as integers."""
        sample, chip = int(self.sample_size / resolution), int(self.chip_size / resolution)
        return sample, chip, int((chip - sample) / 2)


@dataclass(frozen=True)
class Dataset:
    version: str


@dataclass(frozen=True)
class Areas:
    version: str
    include_indices: list[int] | None = None
    exclude_indices: list[int] | None = None


@dataclass(frozen=True)
class Folders:
    working: str
    output: str
    zip_output: bool = False


@dataclass(frozen=True)
class Rules:
    """Choices that are fixed numbers in a plain run; see the README for each."""

    required_dates: int = 4
    class_cap: int = 401
    mask_landsat: bool = False
    reject_edge: bool = True
    seed: str = "42"
    zip_release: bool = False
    #: Areas that are run, and committed, together.
    batch_areas: int = 1000
    #: The release table as one file, too, beside its parts.
    single_file: bool = True


@dataclass(frozen=True)
class RunConfig:
    dataset: Dataset
    aoi: Areas
    directory: Folders
    s2l2a: Optical
    s1rtc: Radar
    lc2l2: Thermal
    dem: Annual
    lulc: LandCover
    chips: Chips
    log_errors: bool = True
    rules: Rules = field(default_factory=Rules)

    @classmethod
    def from_dict(cls, tree: dict[str, Any]) -> RunConfig:
        """Every section by its dataclass; unknown and missing keys raise."""
        kinds = {"dataset": Dataset, "aoi": Areas, "directory": Folders, "s2l2a": Optical, "s1rtc": Radar, "lc2l2": Thermal, "dem": Annual, "lulc": LandCover, "chips": Chips, "rules": Rules}
        unknown = set(tree) - {f.name for f in fields(cls)}
        if unknown:
            raise TypeError(f"unknown sections: {', '.join(sorted(unknown))}")
        return cls(**{k: kinds[k](**v) if k in kinds else v for k, v in tree.items()})

    @classmethod
    def from_text(cls, text: str) -> RunConfig:
        import yaml

        return cls.from_dict(yaml.safe_load(text))

    @classmethod
    def from_yaml(cls, path: str | Path) -> RunConfig:
        return cls.from_text(Path(path).read_text())


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Build a chip dataset from areas of interest and a scene catalogue.")
    parser.add_argument("-c", "--config", default="config.yml", help="YAML run configuration")
    parser.add_argument("--scenes", help="scene catalogue (Parquet, item JSON, or the address of an item search)")
    parser.add_argument("--grid", help="grid of satellite paths (Parquet or zipped shapefile); by default the scenes' path with _grid")
    parser.add_argument("--grid-url", help="address of the zipped shapefile, for where --grid is a zip that is not there")
    parser.add_argument("--blocks", help="raster blocks (Parquet), with the areas' windows in a table of that path with _areas")
    parser.add_argument("--assets", help="in place of blocks, a table (Parquet) of the scenes' raster files: item_id, path, bands")
    parser.add_argument("--rasters", help="the folder or store that the paths of --assets are in")
    return parser.parse_args(argv)
