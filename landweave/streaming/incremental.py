"""Incremental runs: areas or scenes arrive as files, each batch is appended once, a restart goes on."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder


def append_batches(stream: DataFrame, process: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, key: str | None = None) -> None:
    """Runs process over all files that the checkpoint has not seen and appends each batch to out.

    A batch that runs again after a failure replaces its own folder, so rows are there once. With key, a row is left out
    where its key stands twice in the batch or in a batch before it.
    """

    def write(batch: DataFrame, number: int) -> None:
        rows = process(batch)
        if key:
            rows = rows.dropDuplicates([key])
            if number:
                before = rows.sparkSession.read.schema(f"{rows.schema[key].name} {rows.schema[key].dataType.simpleString()}, batch int").parquet(out)
                rows = rows.join(before.where(F.col("batch") < number).select(key), key, "left_anti")
        rows.write.mode("overwrite").parquet(f"{out}/batch={number}")

    running = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    running.awaitTermination()


def replay(spark: SparkSession, folder: str, name: str, key: str) -> DataFrame:
    """A table's file as a stream, appended once; the rows that came out, without repeats of the key."""
    path = f"{folder}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    work = f"{shared_folder(spark)}/landweave/stream-{uuid.uuid4().hex}"
    reader = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
    append_batches(reader.parquet(folder), lambda batch: batch, f"{work}/out", f"{work}/checkpoint", key)
    return spark.read.parquet(f"{work}/out").select(*[f.name for f in schema])
