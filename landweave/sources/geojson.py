"""GeoJSON feature collections as tables, and tables as feature collections."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..schemas import AOI
from ..session import dealt

_FEATURE = "struct<geometry:struct<type:string,coordinates:string>,properties:map<string,string>>"
_FEATURES = f"features array<{_FEATURE}>"


def ring_box(points: Column) -> Column:
    """Bounds of an array of [x, y] points."""
    xs, ys = F.transform(points, lambda p: F.get(p, 0)), F.transform(points, lambda p: F.get(p, 1))
    return F.struct(F.array_min(xs).alias("minx"), F.array_min(ys).alias("miny"), F.array_max(xs).alias("maxx"), F.array_max(ys).alias("maxy"))


def polygon_wkt(kind: Column, coordinates: Column) -> tuple[Column, Column]:
    """WKT and points of a GeoJSON geometry given as its type and its coordinates' JSON text."""
    polygons = F.when(kind == "MultiPolygon", F.from_json(coordinates, "array<array<array<array<double>>>>")).otherwise(F.array(F.from_json(coordinates, "array<array<array<double>>>")))
    # a polygon is an array of rings, a ring an array of points
    ring_text = lambda r: F.concat(F.lit("("), F.array_join(F.transform(r, lambda p: F.concat_ws(" ", F.get(p, 0).cast("string"), F.get(p, 1).cast("string"))), ", "), F.lit(")"))
    polygon_text = lambda g: F.concat(F.lit("("), F.array_join(F.transform(g, ring_text), ", "), F.lit(")"))
    texts = F.transform(polygons, polygon_text)
    wkt = F.when(F.size(texts) == 1, F.concat(F.lit("POLYGON "), F.get(texts, 0))).otherwise(F.concat(F.lit("MULTIPOLYGON ("), F.array_join(texts, ", "), F.lit(")")))
    return wkt, F.flatten(F.flatten(polygons))


#: The first and the last line of the collections written here, which have a feature on each line between.
_HEAD, _TAIL = '{"type": "FeatureCollection", "features": [', "]}"


def _feature_lines(spark: SparkSession, path: str) -> DataFrame:
    """pos and f of a collection with a feature on each line, read by tasks of some lines each. Raises where a line is something else."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    before = lines.groupBy("block").count().withColumn("before", F.sum("count").over(Window.orderBy("block")) - F.col("count"))  # a row for each split
    place = F.row_number().over(Window.partitionBy("block").orderBy("line")) + F.col("before") - 2
    held = lines.join(F.broadcast(before.drop("count")), "block").withColumn("pos", place).where(~F.col("value").isin(_HEAD, _TAIL))
    read = held.select("pos", "value", F.from_json(F.regexp_replace("value", ",$", ""), _FEATURE).alias("f"))
    damaged = F.col("f.geometry").isNull() & F.col("f.properties").isNull()
    return read.select("pos", F.when(damaged, F.raise_error(F.concat(F.lit("no feature: "), F.substring("value", 1, 200))).cast(_FEATURE)).otherwise(F.col("f")).alias("f"))


def read_areas(spark: SparkSession, path: str) -> DataFrame:
    """aoi_index, geom (WKT), bbox and status of each feature; the index is the property of that name or the place.

    Collections written here are read by line, in parallel; others are read whole, by one task.
    """
    first = spark.read.text(path).first()
    if first is not None and first[0] == _HEAD:
        raw = _feature_lines(spark, path)
    else:
        raw = spark.read.schema(_FEATURES).option("multiLine", True).json(path).select(F.posexplode("features").alias("pos", "f"))
    wkt, points = polygon_wkt(F.col("f.geometry.type"), F.col("f.geometry.coordinates"))
    index = F.coalesce(F.try_element_at("f.properties", F.lit("aoi_index")).try_cast("bigint"), F.col("pos").cast("bigint"))
    status = F.coalesce(F.try_element_at("f.properties", F.lit("status")), F.lit("not processed"))
    return spark.createDataFrame([], AOI).unionByName(raw.select(index.alias("aoi_index"), wkt.alias("geom"), ring_box(points).alias("bbox"), status.alias("status")))


def wkt_geometry(wkt: str | None) -> dict | None:
    from ..functions import geo

    found = [[[*r.tolist(), r[0].tolist()] for r in p] for p in geo.polygons(geo.parse_wkt(wkt))]
    if not found:
        return None
    return {"type": "Polygon", "coordinates": found[0]} if len(found) == 1 else {"type": "MultiPolygon", "coordinates": found}


def features(df: DataFrame, geom: str, keep: str | None = None) -> DataFrame:
    """`feature`: each row as a GeoJSON feature, all other columns its properties; with keep, that column beside it."""
    properties = F.to_json(F.struct(*[c for c in df.columns if c != geom]), {"ignoreNullFields": "false"})
    kept = [F.col(keep)] if keep else []
    names = [*([keep] if keep else []), "feature"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [json.dumps({"type": "Feature", "properties": json.loads(p), "geometry": wkt_geometry(g)}) for p, g in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[2:], pa.array(made, pa.string())], names=names)

    schema = T.StructType([*([df.schema[keep]] if keep else []), T.StructField("feature", T.StringType())])
    return df.select(properties.alias("p"), F.col(geom).alias("g"), *kept).mapInArrow(run, schema)


def write_collection(df: DataFrame, geom: str, path: str) -> None:
    """One feature collection file on the driver's file system, a partition at a time; for tables of some size only.

    It appears under its name when it is whole, so df may come from the file that it replaces.
    """
    part = f"{path}.part"
    with open(part, "w") as out:
        out.write(_HEAD)
        for k, row in enumerate(features(df, geom).toLocalIterator()):
            out.write((",\n" if k else "\n") + row["feature"])
        out.write(f"\n{_TAIL}\n")
    os.replace(part, path)


#: Files of a partition, at most.
FILES = 4


def write_features(df: DataFrame, geom: str, path: str, partition: str | None = None) -> None:
    """Newline-delimited features, written in parallel by Spark to any store; the form for tables of any size.

    With partition, only the partitions that df has rows of are replaced.
    """
    made = features(dealt(df), geom, partition).withColumnRenamed("feature", "value")
    if partition:  # some files a partition, not one from each task
        made = dealt(made.withColumn("__deal", F.pmod(F.xxhash64("value"), F.lit(FILES))), partition, "__deal").drop("__deal")
    writer = made.write.mode("overwrite")
    if partition:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(partition)
    writer.text(path)


def read_features(spark: SparkSession, path: str, properties: str) -> DataFrame:
    """geom (WKT) and the properties, by their schema, of newline-delimited features with polygons."""
    raw = spark.read.schema(f"geometry struct<type:string,coordinates:string>, properties struct<{properties}>").json(path)
    return raw.select(polygon_wkt(F.col("geometry.type"), F.col("geometry.coordinates"))[0].alias("geom"), "properties.*")
