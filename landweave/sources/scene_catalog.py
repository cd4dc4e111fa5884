"""Scene catalogues: a Python data source over item JSON that prunes while it reads, and its table form.

spark.dataSource.register(SceneItems); spark.read.format("scene_items").load(folder)

Every file holds newline-delimited items (id, collection, geometry, bbox, properties). Equality and
range filters on collection, dt, cloud, the box's sides and the other plain columns are taken over by the reader; the rest
stays with Spark. A path that begins with http is an item search: collections, time, box and cloud go into its request,
the time is cut into slices, each a partition that turns its own pages by their links to the next (with retries and growing
pauses, signed where the option `signature` gives a query string). Answers are tested like files, so a server
that leaves out a condition costs time and no rows.
"""

from __future__ import annotations

import json
import os
import sys
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterable, Iterator
from datetime import datetime, timezone

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from ..schemas import SCENE

#: Statuses that are tried again.
RETRIED = frozenset({502, 503, 504})
FIELDS = ("item_id", "collection", "dt", "geom", "bbox", "epsg", "proj_code", "cloud", "nodata_pct", "mgrs_tile", "rel_orbit", "platform", "wrs_path")
_TESTS = {
    EqualTo: lambda v, x: v == x,
    In: lambda v, x: v in x,
    LessThan: lambda v, x: v < x,
    LessThanOrEqual: lambda v, x: v <= x,
    GreaterThan: lambda v, x: v > x,
    GreaterThanOrEqual: lambda v, x: v >= x,
}
SIDES = ("minx", "miny", "maxx", "maxy")
_PUSHED = {"collection", "dt", "cloud", "mgrs_tile", "rel_orbit", "platform", "wrs_path", "nodata_pct"}


def fetch(url: str, retries: int = 10, backoff: float = 1.0, sign=None, opener=urllib.request.urlopen) -> bytes:
    """The bytes at url; tried again after gateway errors, with pauses that double."""
    for k in range(retries + 1):
        try:
            with opener(sign(url) if sign else url) as answer:
                return answer.read()
        except urllib.error.HTTPError as error:
            if error.code not in RETRIED or k == retries:
                raise
            time.sleep(backoff * 2**k)
    raise AssertionError


def fetch_items(url: str, signature: str = "", get=fetch) -> Iterator[dict]:
    """All items of a search answer and of the pages after it."""
    sign = (lambda u: f"{u}{'&' if '?' in u else '?'}{signature}") if signature else None
    while url:
        page = json.loads(get(url, sign=sign))
        yield from page.get("features", ())
        url = next((x.get("href") for x in page.get("links", ()) if x.get("rel") == "next"), None)


def _plain(value):
    """A pushed value as item rows have it: times in UTC without a zone."""
    if isinstance(value, datetime) and value.tzinfo is not None:
        return value.astimezone(timezone.utc).replace(tzinfo=None)
    return [_plain(x) for x in value] if isinstance(value, (list, tuple)) else value


def box_text(b: list[float]) -> str:
    x0, y0, x1, y1 = b
    return f"POLYGON (({x1} {y0}, {x1} {y1}, {x0} {y1}, {x0} {y0}, {x1} {y0}))"


def item_row(item: dict) -> tuple:
    """A scene row of a catalogue item; what it lacks is None."""
    p = item.get("properties") or {}
    when = p.get("datetime")
    dt = datetime.fromisoformat(when.replace("Z", "+00:00")).astimezone(timezone.utc).replace(tzinfo=None) if when else None
    bbox = item.get("bbox")
    rings = (item.get("geometry") or {}).get("coordinates")
    geom = None
    if rings:
        kind = item["geometry"]["type"]
        polygons = rings if kind == "MultiPolygon" else [rings]
        texts = ["(" + ", ".join("(" + ", ".join(f"{x} {y}" for x, y, *_ in r) + ")" for r in g) + ")" for g in polygons]
        geom = f"POLYGON {texts[0]}" if len(texts) == 1 else f"MULTIPOLYGON ({', '.join(texts)})"
    elif bbox:
        geom = box_text(bbox)
    path = p.get("landsat:wrs_path")
    return (
        item.get("id"), item.get("collection"), dt, geom, tuple(map(float, bbox)) if bbox else None, p.get("proj:epsg"), p.get("proj:code"),
        p.get("eo:cloud_cover"), p.get("s2:nodata_pixel_percentage"), p.get("s2:mgrs_tile"), p.get("sat:relative_orbit"), p.get("platform"), path,
    )


class _Files(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


class _Search(InputPartition):
    """A request, and the times (the first included, the last not) of which this partition has the items."""

    def __init__(self, url: str, start: datetime | None = None, end: datetime | None = None):
        self.url, self.start, self.end = url, start, end


def _lines(name: str) -> Iterator[dict]:
    with open(name) as lines:
        yield from (json.loads(line) for line in lines if line.strip())


def _stamp(t: datetime) -> str:
    return t.isoformat(timespec="microseconds") + "Z"


class SceneReader(DataSourceReader):
    def __init__(self, path: str, files_each: int, signature: str = "", slices: int = 8, page: int = 250):
        self.path, self.files_each, self.signature, self.slices, self.page = path, files_each, signature, slices, page
        self.tests: list[tuple[tuple[int, ...], type, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            name = f.attribute
            if type(f) in _TESTS and len(name) == 1 and name[0] in _PUSHED:
                self.tests.append(((FIELDS.index(name[0]),), type(f), _plain(f.value)))
            elif type(f) in _TESTS and len(name) == 2 and name[0] == "bbox" and name[1] in SIDES:
                self.tests.append(((FIELDS.index("bbox"), SIDES.index(name[1])), type(f), f.value))
            else:
                yield f

    def _limits(self, at: tuple[int, ...]) -> tuple:
        """Least and largest value that the filters leave a column, None where there is no limit."""
        of = [(kind, v) for place, kind, v in self.tests if place == at and kind is not In]
        low = [v for kind, v in of if kind in (EqualTo, GreaterThan, GreaterThanOrEqual)]
        high = [v for kind, v in of if kind in (EqualTo, LessThan, LessThanOrEqual)]
        return max(low, default=None), min(high, default=None)

    def requests(self) -> list[_Search]:
        """The search as requests, one for each slice of its time."""
        column = lambda c: (FIELDS.index(c),)
        params: dict[str, str] = {"limit": str(self.page)}
        names = [set(v if kind is In else [v]) for at, kind, v in self.tests if at == column("collection") and kind in (EqualTo, In)]
        if names:
            params["collections"] = ",".join(sorted(set.intersection(*names)))
        box = FIELDS.index("bbox")
        west, south = (self._limits((box, SIDES.index(c)))[0] for c in ("maxx", "maxy"))
        east, north = (self._limits((box, SIDES.index(c)))[1] for c in ("minx", "miny"))
        if None not in (west, south, east, north) and west <= east and south <= north:
            params["bbox"] = ",".join(f"{v:g}" if float(f"{v:g}") == v else repr(v) for v in (west, south, east, north))
        cloud = self._limits(column("cloud"))[1]
        if cloud is not None:
            params["query"] = json.dumps({"eo:cloud_cover": {"lte": cloud}})
        ask = lambda **more: f"{self.path}{'&' if '?' in self.path else '?'}{urllib.parse.urlencode({**params, **more})}"
        start, end = self._limits(column("dt"))
        if start is None and end is None:
            return [_Search(ask())]
        if start is None or end is None or start >= end:
            return [_Search(ask(datetime=f"{_stamp(start) if start else '..'}/{_stamp(end) if end else '..'}"))]
        cuts = [start + (end - start) * k / self.slices for k in range(self.slices)] + [end]
        return [_Search(ask(datetime=f"{_stamp(a)}/{_stamp(b)}"), a, None if k + 1 == self.slices else b) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]

    def partitions(self) -> list[InputPartition]:
        if self.path.startswith("http"):
            return self.requests()
        names = sorted(os.path.join(d, n) for d, _, found in os.walk(self.path) for n in found if n.endswith((".json", ".ndjson"))) if os.path.isdir(self.path) else [self.path]
        return [_Files(names[k : k + self.files_each]) for k in range(0, len(names), self.files_each)] or [_Files([])]

    def _passes(self, row: tuple) -> bool:
        for at, kind, value in self.tests:
            found = row[at[0]]
            found = found[at[1]] if len(at) > 1 and found is not None else found
            if found is None or not _TESTS[kind](found, value):
                return False
        return True

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        if isinstance(partition, _Search):
            for row in map(item_row, fetch_items(partition.url, self.signature)):
                when = row[FIELDS.index("dt")]
                inside = (partition.start is None or when is not None and when >= partition.start) and (partition.end is None or when is not None and when < partition.end)
                if inside and self._passes(row):
                    yield row
            return
        for name in partition.paths:
            yield from filter(self._passes, map(item_row, _lines(name)))


class SceneItems(DataSource):
    """Catalogue items in files of newline-delimited JSON, or of a search; options filesPerPartition (16), slices (8), pageSize (250), signature."""

    @classmethod
    def name(cls) -> str:
        return "scene_items"

    def schema(self) -> str:
        return SCENE

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return SceneReader(self.options["path"], int(self.options.get("filesPerPartition", 16)), self.options.get("signature", ""), int(self.options.get("slices", 8)), int(self.options.get("pageSize", 250)))


# the processes that plan and read a data source may not have this package: its classes travel whole
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def read_scenes(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """A catalogue: an item search, a folder or file of item JSON, or, the form for large ones, Parquet in the scene schema."""
    if path.startswith("http") or path.endswith((".json", ".ndjson")) or (os.path.isdir(path) and any(n.endswith((".json", ".ndjson")) for n in os.listdir(path))):
        spark.dataSource.register(SceneItems)
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")  # a reader that takes filters over needs it
        return spark.read.format("scene_items").options(**options).load(path)
    return spark.read.schema(SCENE).parquet(path)


def search(scenes: DataFrame, collection: str | list[str], start, end, where=None, box: tuple[float, float, float, float] | None = None) -> DataFrame:
    """Scenes of collections and a time range (inclusive), of boxes that meet one, and of a further predicate; all of it reaches the scan."""
    found = scenes.where(F.col("collection").isin([collection] if isinstance(collection, str) else collection) & F.col("dt").between(F.lit(start), F.lit(end)))
    if box:
        minx, miny, maxx, maxy = box
        found = found.where((F.col("bbox.minx") <= maxx) & (F.col("bbox.maxx") >= minx) & (F.col("bbox.miny") <= maxy) & (F.col("bbox.maxy") >= miny))
    return found if where is None else found.where(where)
