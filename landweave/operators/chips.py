"""Chip candidates: status, caps, numbering. Sequential rules are window functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import pixels as px
from ..session import held
from .scenes import first_failure

#: Statuses of a window; texts that end up in the chip log.
EDGE, WRONG, FLOOD = "edge_out_of_bounds", "lulc_values_wrong", "lulc_values_flooded_vegetation"


def candidates(windows: DataFrame, data: str = "data") -> DataFrame:
    """Windows of one positive class, whatever is missing in them."""
    return windows.where(px.uniform_class(F.col(data)))


def land_cover_checks(data: Column, edge: Column | None = None) -> list[tuple[Column, str]]:
    """The land-cover part of a window's status, in order."""
    found = [] if edge is None else [(edge, EDGE)]
    return [*found, (px.any_missing(data), "lulc missing values"), (px.any_unknown_class(data), WRONG), (px.any_flooded(data), FLOOD)]


def land_cover_status(data: Column, edge: Column | None = None, ok: str = "ok") -> Column:
    return first_failure(land_cover_checks(data, edge), ok)


def capped(df: DataFrame, group: Sequence[str], cls: str, order: Sequence[str], ok: str, cap: int, out: str = "over_cap", before: Column | None = None) -> DataFrame:
    """Marks rows after the cap-th successful one of their group and class, in order.

    As a counter would that goes up with each success and rejects from cap on: rows before count. before: successes of
    the row's group and class that are not in df.
    """
    earlier = Window.partitionBy(*group, cls).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    prior = F.coalesce(F.sum(F.col(ok).cast("int")).over(earlier), F.lit(0))
    return df.withColumn(out, (prior if before is None else prior + before) >= cap)


def chip_status(lulc_status: Column, over_cap: Column, cls: Column, source_failures: Sequence[tuple[Column, str]]) -> Column:
    """The whole chain: land cover, cap, then the other sources in the order given."""
    limit = F.concat(F.lit("lulc_"), cls.cast("int").cast("string"), F.lit("_limit"))
    checks = [(lulc_status != "ok", lulc_status), (over_cap, limit), *source_failures]
    return first_failure(checks)


def chip_class(df: DataFrame, lulc_status: str, data: str, out: str = "lulc") -> DataFrame:
    """The window's class once it is known; null where land cover failed before."""
    return df.withColumn(out, F.when(F.col(lulc_status) == "ok", F.array_min(data)))


def carried(df: DataFrame, group: Sequence[str], order: Sequence[str], value: str, out: str) -> DataFrame:
    """The last value that is not null up to each row."""
    upto = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(out, F.last(value, ignorenulls=True).over(upto))


def numbered_in_group(df: DataFrame, group: Sequence[str], order: Sequence[str], out: str) -> DataFrame:
    """Numbers from 0 within each group."""
    return df.withColumn(out, (F.row_number().over(Window.partitionBy(*group).orderBy(*order)) - 1).cast("bigint"))


def running_index(df: DataFrame, area: str, order: Sequence[str], out: str = "chip_index", start: int = 0, stored: bool = False) -> DataFrame:
    """Numbers over all areas in order: an area's offset is the count of all before it.

    Counts and numbers come from one stored copy of df, unless df is stored already. Only the per-area
    counts, one row an area, are summed in one place.
    """
    rows = df if stored else held(df, "numbered")
    counts = rows.groupBy(area).agg(F.count("*").alias("__n"))
    before = Window.orderBy(area).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(area, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    inside = numbered_in_group(rows, [area], order, "__k")
    return inside.join(offsets, area).withColumn(out, (F.col("__offset") + F.col("__k") + F.lit(start)).cast("bigint")).drop("__k", "__offset")


def dense_ids(df: DataFrame, order: str | Sequence[str | Column], out: str = "id", ranges: int | None = None, stored: bool = False) -> DataFrame:
    """Numbers from 0 over the whole table in the order of some columns, without sorting it in one task.

    Rows are dealt into ranges by Spark's range partitioning and sorted there; a row's number is its place in its
    range plus the rows of all ranges before, of which there are as many as shuffle partitions (or `ranges`). Rows that tie
    are dealt by their place in df, so that a hot value is no hot range. df is read twice, once for the sample
    that sets the ranges, from a stored copy of it unless it is stored already (or as cheap to read).
    """
    rows = df if stored else held(df, "to-number")
    columns = [order] if isinstance(order, str | Column) else list(order)
    placed = rows.withColumn("__place", F.monotonically_increasing_id())
    dealt = placed.repartitionByRange(*([ranges] if ranges else []), *columns, "__place").sortWithinPartitions(*columns, "__place").drop("__place")
    at = F.monotonically_increasing_id()  # the range in the upper bits, the place in it in the lower 33
    found = held(dealt.withColumns({"__range": F.shiftright(at, 33), "__k": at.bitwiseAND(F.lit((1 << 33) - 1))}), "numbered")
    counts = found.groupBy("__range").agg(F.count("*").alias("__n"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))  # a row for each range
    return found.join(F.broadcast(offsets), "__range").withColumn(out, (F.col("__offset") + F.col("__k")).cast("bigint")).drop("__range", "__k", "__offset")
