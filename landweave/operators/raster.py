"""Raster blocks and pixels: conversion, masks, composites, means, windows.

A block row has the n x n values of one window in row-major order; a pixel row has one value. NULL is
the only missing value.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import pixels as px
from ..functions.timefn import quarter


def to_pixels(blocks: DataFrame, data: str, width: int | Column, keep: Sequence[str], value: str = "v") -> DataFrame:
    """One row per value, with y and x in the block."""
    w = F.lit(width) if isinstance(width, int) else width
    rows = blocks.select(*keep, w.alias("__w"), F.posexplode(data).alias("__pos", value))
    return rows.select(*keep, F.floor(F.col("__pos") / F.col("__w")).cast("int").alias("y"), F.pmod("__pos", F.col("__w")).cast("int").alias("x"), value)


def to_blocks(pixels: DataFrame, keys: Sequence[str], value: str, n: int) -> DataFrame:
    """Windows of n x n values from pixel rows with global y and x; places without a row are null."""
    cells = pixels.withColumns({"wy": F.floor(F.col("y") / n).cast("int"), "wx": F.floor(F.col("x") / n).cast("int")})
    place = F.pmod("y", F.lit(n)) * n + F.pmod("x", F.lit(n))
    found = cells.groupBy(*keys, "wy", "wx").agg(F.sort_array(F.collect_list(F.struct(place.cast("int").alias("p"), F.col(value).alias("v")))).alias("__l"))
    places = F.sequence(F.lit(0), F.lit(n * n - 1))
    # a full block is its sorted list; looking each place up takes the square of them
    some = F.transform(places, lambda k: F.try_element_at(F.map_from_entries("__l"), k))
    whole = F.when(F.col("__l.p") == places, F.col("__l.v")).otherwise(some)
    return found.select(*keys, "wy", "wx", F.lit(n).alias("n"), whole.alias("data"))


def windows_in_rows(df: DataFrame, data: str, side: int, n: int, keep: Sequence[str], out: str = "data") -> DataFrame:
    """All whole n x n windows of square arrays, row by row, without a shuffle; edges that don't fill one go."""
    per = side // n
    numbers = F.sequence(F.lit(0), F.lit(per * per - 1))

    def window(k: Column) -> Column:
        wy, wx = F.floor(k / per).cast("int"), F.pmod(k, F.lit(per)).cast("int")
        lines = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda r: F.slice(data, (wy * n + r) * side + wx * n + 1, n))
        return F.struct(wy.alias("wy"), wx.alias("wx"), F.flatten(lines).alias(out))

    return df.select(*keep, F.inline(F.transform(numbers, window)))


def quarter_composite(pixels: DataFrame, keys: Sequence[str], place: Sequence[str], t: str, order: Sequence[str], value: str) -> DataFrame:
    """The earliest value that is not missing of each quarter and place."""
    named = pixels.withColumn("quarter", quarter(F.col(t)))
    picked = F.min_by(F.col(value), F.when(F.col(value).isNotNull(), F.struct(*order)))
    return named.groupBy(*keys, "quarter", *place).agg(picked.alias(value))


def quarter_values(pixels: DataFrame, keys: Sequence[str], t: str, order: Sequence[str], value: str) -> DataFrame:
    """quarter_composite() and quarter_labels() of single values (no place) in one aggregation."""
    named = pixels.withColumn("quarter", quarter(F.col(t)))
    picked = F.min_by(F.col(value), F.when(F.col(value).isNotNull(), F.struct(*order)))
    return named.groupBy(*keys, "quarter").agg(picked.alias(value), F.min(t).alias("t"))


def quarter_labels(pixels: DataFrame, keys: Sequence[str], t: str) -> DataFrame:
    """The first time of each quarter, whichever scene a composite's values came from."""
    return pixels.withColumn("quarter", quarter(F.col(t))).groupBy(*keys, "quarter").agg(F.min(t).alias("t"))


def temporal_mean(pixels: DataFrame, place: Sequence[str], value: str) -> DataFrame:
    return pixels.groupBy(*place).agg(F.avg(value).alias(value))


def mask_blocks(blocks: DataFrame, masks: DataFrame, keys: Sequence[str], clear: str) -> DataFrame:
    """Blocks with values nulled where the mask block of the same keys says cloud.

    clear: 'class' for scene classes, 'bits' for quality bits. A block without a mask is all missing.
    """
    test = {"class": px.clear_by_class, "bits": px.clear_by_bits}[clear]
    joined = blocks.join(masks.select(*keys, F.col("data").alias("__mask")), list(keys), "left")
    masked = F.when(F.col("__mask").isNotNull(), F.zip_with("data", "__mask", lambda v, m: test(v, m))).otherwise(F.transform("data", lambda v: F.lit(None).cast("double")))
    return joined.withColumn("data", masked).drop("__mask")


def composite_blocks(blocks: DataFrame, keys: Sequence[str], order: Sequence[str] = ("t",)) -> DataFrame:
    """Quarter composite of whole blocks: of each place the earliest value that is not missing; t is the first scene's.

    order: what the earliest scene is told by; scenes of one time need more than t, or it is open which comes first.
    """
    named = blocks.withColumn("quarter", quarter(F.col("t"))).select(*keys, "quarter", *dict.fromkeys(["t", *order]), "data")
    return fold_blocks(named, [*keys, "quarter"], "first", order).select(*keys, "t", "data")


def mean_blocks(blocks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean over time of each place, of the values that are not missing; t is the first scene's."""
    return fold_blocks(blocks.select(*keys, "t", "data"), keys, "mean")


def fold_blocks(df: DataFrame, keys: Sequence[str], how: str, order: Sequence[str] = ()) -> DataFrame:
    """One row for each of keys, its blocks' data folded place by place, missing values left out; t, where df has it, is the least.

    how: 'first' in the given order, 'mean', or 'any' value (of parts that don't overlap). Rows are sorted by key and
    folded one after the other, so that a task holds one block and no list of scenes. Means and parts are combined before the
    shuffle, too. A null block adds nothing; where blocks differ in size, the result has the largest.
    """
    timed = "t" in df.columns and "t" not in keys
    kinds = {c: df.schema[c].dataType.simpleString() for c in df.columns}
    state = [*keys, *(["t"] if timed else []), "data", *(["n"] if how == "mean" and "n" not in keys else [])]
    count = state[-1] if how == "mean" else None
    ddl = ", ".join(f"`{c}` {kinds.get(c, 'array<double>') if c != count else 'array<double>'}" for c in state)

    def folded(final: bool, partial: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names = state if not final or how != "mean" else [c for c in state if c != count]
            out: list[tuple] = []
            key = least = value = seen = None

            def row() -> tuple:
                data, n = value, seen
                if how == "mean":
                    with np.errstate(invalid="ignore", divide="ignore"):
                        data = np.where(n > 0, value / n, np.nan) if final else value
                return (*key, *([least] if timed else []), data, *([n] if how == "mean" and not final else []))

            def flushed() -> pa.RecordBatch:
                columns = []
                for c, values in zip(names, zip(*out, strict=True), strict=True):
                    if c == "data" or c == count:
                        cut = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
                        columns.append(pa.ListArray.from_arrays(pa.array(cut), pa.array(np.concatenate(values), pa.float64(), from_pandas=True)))
                    else:
                        columns.append(pa.array(values, types[c]))
                out.clear()
                return pa.RecordBatch.from_arrays(columns, names=names)

            types: dict = {}
            for batch in batches:
                types = types or {f.name: f.type for f in batch.schema}
                own = [batch.column(batch.schema.get_field_index(c)) for c in keys]
                change = np.zeros(batch.num_rows, dtype=bool)
                for c in own:  # where a key differs from the row before, nulls alike
                    code = c.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
                    change[1:] |= code[1:] != code[:-1]
                arrays = {c: _rows(batch.column(batch.schema.get_field_index(c))) for c in ("data", count) if c in batch.schema.names}
                times = batch.column(batch.schema.get_field_index("t")).to_pylist() if timed else []
                for k in range(batch.num_rows):
                    if k == 0 or change[k]:
                        here = tuple(c[k].as_py() for c in own)
                        if key is None or here != key:
                            if key is not None:
                                out.append(row())
                                if len(out) >= FOLDED:
                                    yield flushed()
                            key, least, value, seen = here, None, np.zeros(0), np.zeros(0)
                    if timed and times[k] is not None and (least is None or times[k] < least):
                        least = times[k]
                    new = arrays["data"](k)
                    if len(new) > len(value):
                        value = np.concatenate([value, np.full(len(new) - len(value), 0.0 if how == "mean" else np.nan)])
                        seen = np.concatenate([seen, np.zeros(len(new) - len(seen))]) if how == "mean" else seen
                    part = slice(0, len(new))
                    if how == "mean":
                        value[part] += np.nan_to_num(new) if partial else new
                        seen[part] += ~np.isnan(new) if partial else arrays[count](k)
                    else:
                        value[part] = np.where(np.isnan(value[part]), new, value[part])
            if key is not None:
                out.append(row())
                yield flushed()

        return run

    by = [*keys, *order]
    if how == "first":
        return df.repartition(*keys).sortWithinPartitions(*by).mapInArrow(folded(True, True), ddl)
    some = df.sortWithinPartitions(*keys).mapInArrow(folded(False, True), ddl)
    last = ddl if how != "mean" else ddl[: ddl.rindex(", `")]
    return some.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(folded(True, False), last)


#: Blocks that a task hands on together.
FOLDED = 64


def _rows(column: pa.Array) -> Callable[[int], np.ndarray]:
    """The numbers of each list of a column, NaN for null; a null list has none."""
    cut = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    return lambda k: values[cut[k] : cut[k + 1]] if valid[k] else values[:0]


def coarsen(pixels: DataFrame, keys: Sequence[str], n: int, height: int, width: int, value: str) -> DataFrame:
    """Least and largest value of each whole n x n window, missing values left out, and whether it is of one positive class."""
    whole = (F.col("y") < height // n * n) & (F.col("x") < width // n * n)
    cells = pixels.where(whole).withColumns({"wy": F.floor(F.col("y") / n).cast("int"), "wx": F.floor(F.col("x") / n).cast("int")})
    found = cells.groupBy(*keys, "wy", "wx").agg(F.min(value).alias("low"), F.max(value).alias("high"))
    return found.withColumn("uniform", F.coalesce((F.col("low") == F.col("high")) & (F.col("low") > 0), F.lit(False)))


def inside_sample(v: Column, y: Column, x: Column, first: int, sample: int) -> Column:
    """The value where y and x lie in the sample that begins at `first` in both directions, else null."""
    return F.when(y.between(first, first + sample - 1) & x.between(first, first + sample - 1), v)


def with_margin(data: Column, sample: int, margin: int) -> Column:
    """A sample's values in the middle of a chip that is wider by the margin on each side, where values are missing."""
    side = sample + 2 * margin
    if not margin:
        return data

    def value(k: Column) -> Column:
        y, x = F.floor(k / side).cast("int"), F.pmod(k, F.lit(side)).cast("int")
        return inside_sample(F.get(data, (y - margin) * sample + (x - margin)), y, x, margin, sample)

    return F.transform(F.sequence(F.lit(0), F.lit(side * side - 1)), value)


def band_check(blocks: DataFrame, keys: Sequence[str], expected: int) -> DataFrame:
    """Groups and whether they have all bands."""
    return blocks.groupBy(*keys).agg((F.count_distinct("band") == expected).alias("complete"))


def select_bands(blocks: DataFrame, bands: Sequence[str], drop: str | None = None) -> DataFrame:
    return blocks.where(F.col("band").isin(*[b for b in bands if b != drop]))


def resample_nearest(blocks: DataFrame, data: str, side: int, target: int) -> DataFrame:
    """Square arrays on another grid of the same extent, each place from the nearest source value."""
    step = side / target
    source = F.transform(F.sequence(F.lit(0), F.lit(target * target - 1)), lambda k: F.get(data, (F.floor((F.floor(k / target) + 0.5) * step) * side + F.floor((F.pmod(k, F.lit(target)) + 0.5) * step)).cast("int")))
    return blocks.withColumn(data, source)
