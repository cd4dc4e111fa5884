"""Projections and box geometry as column expressions, polygon geometry as numpy functions."""

from __future__ import annotations

import math
import re

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import overlay

EARTH = 6378137.0
#: Fixed values of the WGS 84 ellipsoid and of the transverse Mercator grid.
FLATTENING = 1 / 298.257223563
SCALE, FALSE_EAST, FALSE_NORTH = 0.9996, 500000.0, 10000000.0


def mercator_x(lon: Column) -> Column:
    return F.radians(lon) * F.lit(EARTH)


def mercator_y(lat: Column) -> Column:
    return F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2)) * F.lit(EARTH)


def mercator_box(b: Column) -> Column:
    return F.struct(mercator_x(b["minx"]).alias("minx"), mercator_y(b["miny"]).alias("miny"), mercator_x(b["maxx"]).alias("maxx"), mercator_y(b["maxy"]).alias("maxy"))


def box_overlaps(a: Column, b: Column) -> Column:
    return (a["minx"] <= b["maxx"]) & (b["minx"] <= a["maxx"]) & (a["miny"] <= b["maxy"]) & (b["miny"] <= a["maxy"])


def box_intersection_area(a: Column, b: Column) -> Column:
    w = F.least(a["maxx"], b["maxx"]) - F.greatest(a["minx"], b["minx"])
    h = F.least(a["maxy"], b["maxy"]) - F.greatest(a["miny"], b["miny"])
    return F.greatest(w, F.lit(0.0)) * F.greatest(h, F.lit(0.0))


def adjusted_box(b: Column, resolution: Column | float) -> Column:
    """Half a pixel off the left and the upper edge."""
    half = (resolution if isinstance(resolution, Column) else F.lit(float(resolution))) / 2
    return F.struct((b["minx"] + half).alias("minx"), b["miny"].alias("miny"), b["maxx"].alias("maxx"), (b["maxy"] - half).alias("maxy"))


def _series() -> tuple[float, list[float], list[float], list[float]]:
    n = FLATTENING / (2 - FLATTENING)
    radius = EARTH / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    forward = [n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180, 13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440, 61 * n**3 / 240 - 103 * n**4 / 140, 49561 * n**4 / 161280]
    inverse = [n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96 - n**4 / 360, n**2 / 48 + n**3 / 15 - 437 * n**4 / 1440, 17 * n**3 / 480 - 37 * n**4 / 840, 4397 * n**4 / 161280]
    latitude = [2 * n - 2 * n**2 / 3 - 2 * n**3 + 116 * n**4 / 45, 7 * n**2 / 3 - 8 * n**3 / 5 - 227 * n**4 / 45, 56 * n**3 / 15 - 136 * n**4 / 35, 4279 * n**4 / 630]
    return radius, forward, inverse, latitude


def utm_inverse(east: Column, north: Column, epsg: Column) -> tuple[Column, Column]:
    """Longitude and latitude (degrees) of UTM coordinates in EPSG 326xx or 327xx, by the Krueger series."""
    radius, _, inverse, latitude = _series()
    zone = F.pmod(epsg, F.lit(100))
    south = (epsg - zone) == 32700
    xi = (north - F.when(south, F.lit(FALSE_NORTH)).otherwise(0.0)) / F.lit(SCALE * radius)
    eta = (east - F.lit(FALSE_EAST)) / F.lit(SCALE * radius)
    xi2, eta2 = xi, eta
    for j, b in enumerate(inverse, 1):
        xi2 = xi2 - F.lit(b) * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        eta2 = eta2 - F.lit(b) * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(xi2) / F.cosh(eta2))
    lat = chi
    for j, d in enumerate(latitude, 1):
        lat = lat + F.lit(d) * F.sin(2 * j * chi)
    lon = F.degrees(F.atan2(F.sinh(eta2), F.cos(xi2))) + (zone * 6 - 183)
    return lon, F.degrees(lat)


def utm_forward(lon: np.ndarray, lat: np.ndarray, epsg: int) -> tuple[np.ndarray, np.ndarray]:
    """UTM coordinates of longitudes and latitudes (degrees); numpy."""
    radius, forward, _, _ = _series()
    phi, lam = np.radians(lat), np.radians(np.asarray(lon) - (epsg % 100 * 6 - 183))
    e = math.sqrt(FLATTENING * (2 - FLATTENING))
    t = np.sinh(np.arctanh(np.sin(phi)) - e * np.arctanh(e * np.sin(phi)))
    xi, eta = np.arctan2(t, np.cos(lam)), np.arctanh(np.sin(lam) / np.sqrt(1 + t**2))
    x, y = eta.copy(), xi.copy()
    for j, a in enumerate(forward, 1):
        x += a * np.cos(2 * j * xi) * np.sinh(2 * j * eta)
        y += a * np.sin(2 * j * xi) * np.cosh(2 * j * eta)
    return FALSE_EAST + SCALE * radius * x, SCALE * radius * y + (FALSE_NORTH if epsg // 100 == 327 else 0.0)


def utm_degrees(east: np.ndarray, north: np.ndarray, epsg: int) -> tuple[np.ndarray, np.ndarray]:
    """Longitudes and latitudes (degrees) of UTM coordinates; numpy."""
    radius, _, inverse, latitude = _series()
    xi = (np.asarray(north) - (FALSE_NORTH if epsg // 100 == 327 else 0.0)) / (SCALE * radius)
    eta = (np.asarray(east) - FALSE_EAST) / (SCALE * radius)
    a, b = xi.copy(), eta.copy()
    for j, c in enumerate(inverse, 1):
        a = a - c * np.sin(2 * j * xi) * np.cosh(2 * j * eta)
        b = b - c * np.cos(2 * j * xi) * np.sinh(2 * j * eta)
    chi = np.arcsin(np.sin(a) / np.cosh(b))
    lat = chi + sum(d * np.sin(2 * j * chi) for j, d in enumerate(latitude, 1))
    return np.degrees(np.arctan2(np.sinh(b), np.cos(a))) + (epsg % 100 * 6 - 183), np.degrees(lat)


def is_utm(epsg: int) -> bool:
    return epsg // 100 in (326, 327) and 1 <= epsg % 100 <= 60


def projected(x: np.ndarray, y: np.ndarray, source: int, target: int) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates in another system: EPSG 4326 (longitude, latitude), 3857 and UTM; numpy."""
    x, y = np.asarray(x, dtype=np.float64), np.asarray(y, dtype=np.float64)
    if source == target:
        return x, y
    if is_utm(source):
        x, y = utm_degrees(x, y, source)
    elif source == 3857:
        x, y = np.degrees(x / EARTH), np.degrees(2 * np.arctan(np.exp(y / EARTH)) - np.pi / 2)
    elif source != 4326:
        raise ValueError(f"EPSG:{source}")
    if is_utm(target):
        return utm_forward(x, y, target)
    if target == 3857:
        return np.radians(x) * EARTH, np.log(np.tan(np.pi / 4 + np.radians(y) / 2)) * EARTH
    if target != 4326:
        raise ValueError(f"EPSG:{target}")
    return x, y


def projected_bounds(box: tuple[float, float, float, float], source: int, target: int, points: int = 33) -> tuple[float, float, float, float]:
    """Bounds in another system of a box, whose sides are bent there."""
    minx, miny, maxx, maxy = box
    t = np.linspace(0, 1, points)
    x = np.concatenate([minx + t * (maxx - minx)] * 2 + [np.full(points, minx), np.full(points, maxx)])
    y = np.concatenate([np.full(points, miny), np.full(points, maxy), *[miny + t * (maxy - miny)] * 2])
    x, y = projected(x, y, source, target)
    return float(x.min()), float(y.min()), float(x.max()), float(y.max())


def footprint_wkt(b: Column, epsg: Column) -> Column:
    """POLYGON text in degrees of a box in UTM coordinates; its corners from the lower right, counter-clockwise."""
    corners = [utm_inverse(b[x], b[y], epsg) for x, y in (("maxx", "miny"), ("maxx", "maxy"), ("minx", "maxy"), ("minx", "miny"), ("maxx", "miny"))]
    points = [F.concat_ws(" ", F.round(lon, 9).cast("string"), F.round(lat, 9).cast("string")) for lon, lat in corners]
    return F.concat(F.lit("POLYGON (("), F.concat_ws(", ", *points), F.lit("))"))


# polygons: a geometry is a list of rings, each an (n, 2) array; outer ones counter-clockwise, holes clockwise


def parse_wkt(text: str | None) -> list[np.ndarray]:
    """Rings of a POLYGON or MULTIPOLYGON text, holes too."""
    if not text:
        return []
    polygons = re.findall(r"\(\s*(\([^()]*\)(?:\s*,\s*\([^()]*\))*)\s*\)", text)
    rings = []
    for polygon in polygons:
        for k, part in enumerate(re.findall(r"\(([^()]*)\)", polygon)):
            ring = np.array([[float(v) for v in p.split()[:2]] for p in part.split(",")])
            ring = oriented(ring[:-1] if len(ring) > 1 and (ring[0] == ring[-1]).all() else ring)
            rings.append(ring[::-1] if k else ring)
    return rings


def contains(ring: np.ndarray, point: np.ndarray) -> bool:
    """Whether a point is inside a ring."""
    (x0, y0), (x1, y1) = ring.T, np.roll(ring, -1, axis=0).T
    over = (y0 > point[1]) != (y1 > point[1])
    return bool((over & (point[0] < x0 + (point[1] - y0) * (x1 - x0) / np.where(y1 == y0, 1, y1 - y0))).sum() % 2)


def polygons(rings: list[np.ndarray]) -> list[list[np.ndarray]]:
    """Outer rings, each with its holes: a hole belongs to the smallest ring around it."""
    outers = [[r] for r in rings if signed_area(r) > 0]
    by_size = sorted(outers, key=lambda p: signed_area(p[0]))
    for hole in rings:
        if signed_area(hole) <= 0:
            middle = (hole[0] + hole[1]) / 2
            home = next((p for p in by_size if -signed_area(hole) <= signed_area(p[0]) and contains(p[0], middle)), None)
            if home:
                home.append(hole)
    return outers


def to_wkt(rings: list[np.ndarray]) -> str | None:
    def text(r: np.ndarray) -> str:
        return "(" + ", ".join(f"{x!r} {y!r}" for x, y in np.vstack([r, r[:1]]).tolist()) + ")"

    texts = ["(" + ", ".join(map(text, p)) + ")" for p in polygons(rings)]
    if not texts:
        return None
    return f"POLYGON {texts[0]}" if len(texts) == 1 else f"MULTIPOLYGON ({', '.join(texts)})"


def mercator_rings(rings: list[np.ndarray]) -> list[np.ndarray]:
    """Rings in degrees as rings in EPSG:3857 metres."""
    return [np.column_stack([np.radians(r[:, 0]) * EARTH, np.log(np.tan(np.pi / 4 + np.radians(r[:, 1]) / 2)) * EARTH]) for r in rings]


def onward(values: np.ndarray) -> np.ndarray:
    """Each value's next one around a ring; for short arrays much cheaper than np.roll."""
    return np.concatenate([values[1:], values[:1]])


def signed_area(ring: np.ndarray) -> float:
    x, y = (ring - ring[0]).T if len(ring) else np.zeros((2, 0))
    return float((x * onward(y) - onward(x) * y).sum() / 2)


def oriented(ring: np.ndarray) -> np.ndarray:
    return ring[::-1] if signed_area(ring) < 0 else ring


def clip_convex(subject: np.ndarray, window: np.ndarray) -> np.ndarray | None:
    """Intersection of two convex rings, None where it has no area."""
    out, corners = subject.tolist(), window.tolist()  # few points: plain numbers are faster than arrays
    for (ax, ay), (bx, by) in zip(corners, corners[1:] + corners[:1], strict=True):
        if not out:
            return None
        side = [(bx - ax) * (y - ay) - (by - ay) * (x - ax) for x, y in out]
        kept = []
        for k, (x, y) in enumerate(out):
            j = (k + 1) % len(out)
            if side[k] >= 0:
                kept.append([x, y])
            if side[k] * side[j] < 0:
                kept.append([x + (out[j][0] - x) * side[k] / (side[k] - side[j]), y + (out[j][1] - y) * side[k] / (side[k] - side[j])])
        out = kept
    found = np.array(out).reshape(-1, 2)
    return found if len(found) > 2 and signed_area(found) > 0 else None


def is_convex(ring: np.ndarray) -> bool:
    d = onward(ring) - ring
    e = onward(d)
    turn = d[:, 0] * e[:, 1] - d[:, 1] * e[:, 0]
    return bool((turn >= 0).all() and abs(np.arctan2(turn, (d * e).sum(axis=1)).sum() - 2 * np.pi) < 1e-6)


def intersect(a: list[np.ndarray], b: list[np.ndarray]) -> list[np.ndarray]:
    """What two geometries have in common; two convex rings are clipped, all else goes by a sweep."""
    if len(a) == len(b) == 1 and is_convex(a[0]) and is_convex(b[0]):
        common = clip_convex(a[0], b[0])
        return [] if common is None else [common]
    return overlay.intersection([a, b])


def area(rings: list[np.ndarray]) -> float:
    """Area of a geometry; what its rings cover twice counts once."""
    return float(signed_area(rings[0])) if len(rings) == 1 else overlay.Overlay([rings], overlay.in_any).area()


def bounds(rings: list[np.ndarray]) -> tuple[float, float, float, float] | None:
    if not rings:
        return None
    points = np.vstack(rings)
    return (*map(float, points.min(axis=0)), *map(float, points.max(axis=0)))


def centroid(rings: list[np.ndarray]) -> tuple[float, float] | None:
    """Centre of gravity of the rings' areas."""
    total, cx, cy = 0.0, 0.0, 0.0
    for r in rings:
        o = r - r[0]
        x, y = o.T
        next_x, next_y = onward(x), onward(y)
        cross = x * next_y - next_x * y
        a = cross.sum() / 2
        total += a
        cx += ((x + next_x) * cross).sum() / 6 + a * r[0, 0]
        cy += ((y + next_y) * cross).sum() / 6 + a * r[0, 1]
    return (cx / total, cy / total) if total else None
