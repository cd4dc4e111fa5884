"""Polygon operators as grouped aggregates; a group is one area's scenes, which a search bounds."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geo, overlay
from ..session import dealt


@lru_cache(maxsize=64)
def rings_of(text: str | None) -> list[np.ndarray]:
    """The text's rings; none where it is no polygon, so that one malformed geometry leaves the others alone. The last ones are remembered; they are not to be changed."""
    try:
        return geo.parse_wkt(text)
    except (ValueError, IndexError, AttributeError):
        return []


def _common_area(texts: Sequence[str] | None, other: str | None, project: Callable[[list[np.ndarray]], list[np.ndarray]]) -> float:
    window = project(rings_of(other))
    near = [common for t in (texts if texts is not None else []) if (common := geo.intersect(project(rings_of(t)), window))]
    return geo.area(near[0]) if len(near) == 1 else overlay.area_of_union(near)


@F.pandas_udf(T.DoubleType())
def overlap_area(geoms: pd.Series, footprint: pd.Series) -> pd.Series:
    """Area that the union of some polygons (array of WKT) has in common with a footprint (WKT), in its plane."""
    return pd.Series([_common_area(a, b, lambda r: r) for a, b in zip(geoms, footprint, strict=True)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def mercator_overlap_area(geoms: pd.Series, footprint: pd.Series) -> pd.Series:
    """overlap_area() of polygons in degrees, in square metres of EPSG:3857."""
    return pd.Series([_common_area(a, b, geo.mercator_rings) for a, b in zip(geoms, footprint, strict=True)], dtype="float64")


@F.pandas_udf(T.BooleanType())
def polygons_meet(a: pd.Series, b: pd.Series) -> pd.Series:
    """Whether two polygons (WKT) have common area; a malformed one has none."""
    return pd.Series([bool(geo.intersect(rings_of(x), rings_of(y))) for x, y in zip(a, b, strict=True)], dtype="bool")


@F.pandas_udf(T.DoubleType())
def areas(wkt: pd.Series) -> pd.Series:
    """Area of a polygon text in its plane, without its holes."""
    return pd.Series([geo.area(rings_of(t)) for t in wkt], dtype="float64")


@F.pandas_udf(T.BooleanType())
def well_formed(wkt: pd.Series) -> pd.Series:
    """Whether a text is a polygon with an area."""
    return pd.Series([any(abs(geo.signed_area(r)) > 0 for r in rings_of(t)) for t in wkt], dtype="bool")


@F.pandas_udf(T.StructType([T.StructField(c, T.DoubleType()) for c in ("minx", "miny", "maxx", "maxy")]))
def wkt_box(wkt: pd.Series) -> pd.DataFrame:
    """Bounds of a polygon text."""
    return pd.DataFrame([geo.bounds(rings_of(t)) or (None,) * 4 for t in wkt], columns=["minx", "miny", "maxx", "maxy"], dtype="float64")


@F.pandas_udf(T.StructType([T.StructField("lon", T.DoubleType()), T.StructField("lat", T.DoubleType())]))
def centroids(wkt: pd.Series) -> pd.DataFrame:
    found = [geo.centroid(rings_of(t)) or (None, None) for t in wkt]
    return pd.DataFrame(found, columns=["lon", "lat"], dtype="float64")


#: Parts into which a group is dealt before its parts' unions are united.
DEALT = 16


def dissolved(df: DataFrame, keys: Sequence[str], geom: str) -> DataFrame:
    """keys, and in geom the union of each group's polygons as text: disjoint rings with holes, null where there is no area.

    Equal texts count once. A group is dealt into parts that are united first, so that no task holds a hot group's polygons but only what is left of them.
    Null keys are a group; malformed polygons add nothing.
    """
    kinds = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)

    def united(pdf: pd.DataFrame) -> pd.DataFrame:
        found = geo.to_wkt(overlay.union([rings_of(t) for t in pdf["__geom"]]))
        return pd.DataFrame({**{k: pdf[k].iloc[:1] for k in keys}, "__geom": [found]}, index=pdf.index[:1])

    once = df.select(*keys, F.col(geom).alias("__geom")).distinct()
    parts = dealt(once.withColumn("__deal", F.pmod(F.xxhash64("__geom"), F.lit(DEALT))), *keys, "__deal").groupBy(*keys, "__deal").applyInPandas(united, f"{kinds}, __geom string")
    return dealt(parts, *keys).groupBy(*keys).applyInPandas(united, f"{kinds}, __geom string").withColumnRenamed("__geom", geom)


def common_geometry(df: DataFrame, key: str, geom: str) -> DataFrame:
    """key, and in geom what all of its polygons have in common as text, null where that has no area."""

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        rings = rings_of(pdf["__geom"].iloc[0])
        for text in pdf["__geom"].iloc[1:]:
            rings = geo.intersect(rings, rings_of(text)) if rings else []
        return pd.DataFrame({key: pdf[key].iloc[:1], "__geom": [geo.to_wkt(rings)]}, index=pdf.index[:1])

    kind = df.schema[key].dataType.simpleString()
    return dealt(df.select(key, F.col(geom).alias("__geom")), key).groupBy(key).applyInPandas(fold, f"`{key}` {kind}, __geom string").withColumnRenamed("__geom", geom)


def common_footprint(scenes: DataFrame, key: str, union_keys: Sequence[str], geom: str) -> DataFrame:
    """Bounds of what all of a key's scenes have in common; scenes of equal union_keys count as one footprint.

    Rows with a null union key don't constrain it. Null bounds: nothing in common.
    """
    held = scenes.dropna(subset=list(union_keys)).select(key, *union_keys, geom)
    common = common_geometry(dissolved(held, [key, *union_keys], geom), key, geom)
    return common.withColumn("__box", wkt_box(geom)).select(key, *[F.col(f"__box.{c}").alias(c) for c in ("minx", "miny", "maxx", "maxy")])
