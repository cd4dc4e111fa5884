"""The chip log as CSV, with its schema given and never inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import CHIP_LOG


def read_log(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.schema(CHIP_LOG).option("header", True).option("escape", '"').option("multiLine", True).csv(path)


def empty_log(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], CHIP_LOG)


def flat_lists(df: DataFrame) -> DataFrame:
    """Arrays as comma-joined texts; an empty array, as failed chips have, as []."""
    lists = [f.name for f in df.schema if isinstance(f.dataType, T.ArrayType)]
    return df.withColumns({c: F.when(F.size(c) == 0, F.lit("[]")).otherwise(F.array_join(F.col(c).cast("array<string>"), ",")) for c in lists}) if lists else df


def write_log(df: DataFrame, path: str, mode: str = "append") -> None:
    """Appends only the new rows: a run writes each row once."""
    columns = [c.split()[0] for c in CHIP_LOG.split(", ")]
    flat_lists(df).select(*columns).write.mode(mode).option("header", True).option("escape", '"').csv(path)
