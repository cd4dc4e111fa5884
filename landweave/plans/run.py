"""A run in batches of areas: each batch is committed before the next begins, and a restart goes on behind the last one.

A batch goes through scenes, rasters, chips and images, and leaves its statuses, the files that couldn't be read, and its part of the
chip log, each in a folder of the batch's number that a repeated batch replaces. The log comes last: a batch without it has not been, and is
run again with the same chip numbers, so images of the first try are replaced by equal ones. The area file with all
statuses is made anew from them after each batch and at each start.

What fails in the plan of a batch is narrowed down by halves to the areas that it fails for; those get the error as their status and
the others go on. What fails in writing a batch's tables ends the run.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import RunConfig
from ..operators import curate
from ..session import held
from ..sources import chiplog, geojson, store
from . import pipeline

KEY = "aoi_index"
STATUS = "aoi_index bigint, status string"
UNREAD = "aoi_index bigint, source string, t timestamp, error string"


@dataclass(frozen=True)
class Given:
    """What a run is made of: the catalogue, the grid of paths, and blocks or the scenes' files."""

    cfg: RunConfig
    catalogue: DataFrame
    grid: DataFrame
    blocks: str | None = None
    assets: str | None = None
    rasters: str | None = None


@dataclass(frozen=True)
class Done:
    """A batch's rows: of the log, statuses (STATUS) and unread files (UNREAD); and how many chips it numbered."""

    log: DataFrame
    status: DataFrame
    unread: DataFrame
    chips: int


def process(areas: DataFrame, start: int, given: Given, work: str) -> Done:
    """Scenes, rasters, chips and images of some areas; chips are numbered from start."""
    spark, cfg = areas.sparkSession, given.cfg
    chosen, checked = pipeline.select_scenes(areas, given.catalogue, given.grid, cfg)
    checked = held(checked, "checked")
    geojson.write_features(chosen, "geom", f"{work}/scenes", partition=KEY)
    unread = spark.createDataFrame([], UNREAD)
    if given.assets:
        placed = held(pipeline.area_grids(checked.join(pipeline.area_systems(chosen, given.catalogue), KEY), cfg), "grids")
        blocks, unread = pipeline.blocks_from_files(chosen, placed, spark.read.parquet(given.assets), given.rasters, cfg)
        blocks = held(blocks, "blocks")
    else:
        blocks = spark.read.parquet(given.blocks)
        placed = checked.select(KEY, "status").join(spark.read.parquet(f"{given.blocks}_areas"), KEY)
    new = held(pipeline.make_chips(blocks, placed, pipeline.scene_id_lists(chosen), cfg, start), "chips")
    log = held(pipeline.with_failures(new, pipeline.write_chips(blocks, new, placed, cfg, work)), "logged")
    return Done(log, checked.select(KEY, "status"), unread, log.count())


def isolated(areas: DataFrame, start: int, given: Given, work: str) -> list[Done]:
    """process(), by halves where it fails; an area that fails alone has its error as status."""
    try:
        return [process(areas, start, given, work)]
    except Exception as error:
        spark = areas.sparkSession
        if spark.sparkContext._jsc.sc().isStopped():
            raise
        low, high, middle = areas.agg(F.min(KEY), F.max(KEY), F.percentile_approx(KEY, 0.5)).first()
        if low == high:
            text = f"{type(error).__name__}: {error}".splitlines()[0][:200]
            return [Done(chiplog.empty_log(spark), spark.createDataFrame([(low, text)], STATUS), spark.createDataFrame([], UNREAD), 0)]
        middle = min(middle, high - 1)
        done = isolated(areas.where(F.col(KEY) <= middle), start, given, work)
        return done + isolated(areas.where(F.col(KEY) > middle), start + sum(d.chips for d in done), given, work)


def batches(folder: str) -> list[int]:
    """Numbers of the batches whose folder is whole."""
    return sorted(int(n.removeprefix("batch=")) for n in store.names(folder) if n.startswith("batch=") and store.exists(f"{folder}/{n}/_SUCCESS"))


def log_of(spark: SparkSession, work: str) -> DataFrame:
    """The chip log of all batches."""
    found = [f"{work}/chip_log/batch={n}" for n in batches(f"{work}/chip_log")]
    return chiplog.read_log(spark, found) if found else chiplog.empty_log(spark)


def with_statuses(areas: DataFrame, work: str) -> DataFrame:
    """Areas with their latest status."""
    found = batches(f"{work}/status")
    if not found:
        return areas
    told = areas.sparkSession.read.schema(f"{STATUS}, batch int").option("basePath", f"{work}/status").parquet(*[f"{work}/status/batch={n}" for n in found])
    return curate.upsert_status(areas, told.groupBy(KEY).agg(F.max_by("status", "batch").alias("status")), KEY)


def run(areas: DataFrame, given: Given, work: str, state: str) -> DataFrame:
    """All areas behind the last one in the log, batch by batch; the whole log. state: the area file to keep."""
    spark = areas.sparkSession
    geojson.write_collection(with_statuses(areas, work), "geom", state)
    todo = held(curate.resumable(areas, log_of(spark, work), KEY), "todo")
    low = None
    while True:
        left = todo if low is None else todo.where(F.col(KEY) > low)
        high = left.select(KEY).orderBy(KEY).limit(given.cfg.rules.batch_areas).agg(F.max(KEY)).first()[0]
        if high is None:
            return log_of(spark, work)
        number = max(batches(f"{work}/chip_log"), default=-1) + 1
        last = log_of(spark, work).agg(F.max("chip_index")).first()[0]
        done = isolated(left.where(F.col(KEY) <= high), 0 if last is None else last + 1, given, work)
        united = lambda part: reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [getattr(d, part) for d in done])  # noqa: B023, E731
        united("status").write.mode("overwrite").parquet(f"{work}/status/batch={number}")
        united("unread").write.mode("overwrite").parquet(f"{work}/unread/batch={number}")
        chiplog.write_log(united("log"), f"{work}/chip_log/batch={number}", "overwrite")
        geojson.write_collection(with_statuses(areas, work), "geom", state)
        low = high
