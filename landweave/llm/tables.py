"""Table access and materialisation shared by the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder, ship

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and every executor reach: spark.checkpoint.dir.

    Raises where it is unset, as a folder of one machine would lose what the others write; only in
    local mode, where there are no others, a temporary one is made.
    """
    return shared_folder(spark)


#: Bytes of a row group, and of a page, in a table whose rows are large.
LARGE_ROWS = {"parquet.block.size": 16 << 20, "parquet.page.size": 1 << 20, "parquet.page.size.row.check.min": 1}


def materialise(df: DataFrame, name: str, compression: str = "snappy", large: bool = False) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back.

    Cuts the lineage so that a lost executor costs a re-read and not a recomputation, and gives
    later joins true sizes. large: rows of megabytes, of which a writer or reader holds a few at a time; by default it looks at
    a row group's size after 100 rows only.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/landweave/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).options(**(LARGE_ROWS if large else {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(text, ASCII_UPPER, ASCII_UPPER.lower())


def free_name(taken: Iterable[str], name: str) -> str:
    """name, with as many _ after it as make it differ from the taken ones, in any case."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name += "_"
    return name


#: Bits of a row filter, at most: 4,096 buckets of 4 KB.
FILTER_BITS = 1 << 27


def parted(df: DataFrame, key: str, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of df whose key may be in wanted (a stored table with a column of that name), and all others.

    Keys are told apart by a bitmap of hashes, which is of bounded size and is joined in the JVM, so what goes on to an exact
    join's shuffle is little more than is wanted: about one bit in 16 is set. With more keys than FILTER_BITS / 16 it lets more
    other rows through. df is read once for each part.
    """
    size = 1 << 15
    while size < min(FILTER_BITS, 16 * wanted.count()):
        size *= 2
    place = F.pmod(F.xxhash64(F.col(key)), F.lit(size)) + F.lit(1)
    parts = wanted.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("__bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("__bits"))
    own = free_name(df.columns, "__place")
    at = F.bitmap_bit_position(F.col(own))
    byte = F.conv(F.hex(F.substring("__bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("long")
    held = (F.bitmap_bucket_number(F.col(own)) == F.col("__bucket")) & (F.getbit(byte, F.pmod(at, F.lit(8)).cast("int")) == 1)
    placed = df.withColumn(own, place)
    return placed.join(F.broadcast(parts), held, "left_semi").drop(own), placed.join(F.broadcast(parts), held, "left_anti").drop(own)


def let_through(df: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """The rows of df whose key may be in wanted."""
    return parted(df, key, wanted)[0]


def without(df: DataFrame, key: str, unwanted: DataFrame) -> DataFrame:
    """The rows of df whose key is not in unwanted, a stored table; only the rows near it are shuffled."""
    near, clear = parted(df, key, unwanted)
    return clear.unionByName(near.join(unwanted.select(key), key, "left_anti").select(df.columns))
