"""Caps and numbers that go on from batch to batch, for windows of one area that arrive in several.

What a sequential run keeps in its counters is a table here: the successes and rows of each area and class up
to a batch, a folder of the batch's number. A batch reads its predecessor's folder, so a batch that runs
again replaces its own folders and nothing is counted twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import chips
from ..session import held


def count_batch(batch: DataFrame, number: int, out: str, area: str, cls: str, order: Sequence[str], ok: str, cap: int) -> None:
    """One batch's rows with over_cap and chip_index, to out/rows, and the counts up to it, to out/counts.

    over_cap marks rows behind the cap-th success of their area and class, those of earlier batches included; a null class is one
    of its own. chip_index goes on behind the last number of the batch before, by area and order. The rows come first: a
    batch without its counts has not been.
    """
    spark, keys = batch.sparkSession, [area, cls]
    types = {f.name: f.dataType.simpleString() for f in batch.schema.fields}
    schema = ", ".join([*[f"{k} {types[k]}" for k in keys], "__passed bigint", "__rows bigint"])
    if number:
        before = spark.read.schema(schema).parquet(f"{out}/counts/batch={number - 1}")
    else:
        before = spark.createDataFrame([], schema)
    start = before.agg(F.coalesce(F.sum("__rows"), F.lit(0))).first()[0]
    rows = held(batch, "counted")
    earlier = before.select(*[F.col(k).alias(f"__{k}") for k in keys], "__passed")
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    known = rows.join(earlier, same, "left").drop(*[f"__{k}" for k in keys])
    capped = chips.capped(known, [area], cls, order, ok, cap, before=F.coalesce("__passed", F.lit(0))).drop("__passed")
    chips.running_index(capped, area, order, "chip_index", start).write.mode("overwrite").parquet(f"{out}/rows/batch={number}")
    new = rows.groupBy(*keys).agg(F.coalesce(F.sum(F.col(ok).cast("bigint")), F.lit(0)).alias("__passed"), F.count("*").alias("__rows"))
    total = before.unionByName(new).groupBy(*keys).agg(F.sum("__passed").alias("__passed"), F.sum("__rows").alias("__rows"))
    total.write.mode("overwrite").parquet(f"{out}/counts/batch={number}")


def counted_batches(stream: DataFrame, out: str, checkpoint: str, area: str, cls: str, order: Sequence[str], ok: str, cap: int) -> None:
    """count_batch() on all that the checkpoint has not seen.

    Where an area's windows arrive in order, caps are those of one batch, however they are split; numbers are, where all rows do. Out
    of order, the first to arrive count first.
    """
    running = stream.writeStream.foreachBatch(lambda batch, number: count_batch(batch, number, out, area, cls, order, ok, cap)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    running.awaitTermination()
