"""Pixel value expressions: masks, stretches, casts. Missing values are NULL, never NaN."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Scene classes that are not cloud, dB ranges, stretch constants, known land-cover classes.
CLEAR_SCENE_CLASSES = (2, 4, 5, 6, 11)
CLOUD_BITS = 0b11110
DB_RANGES = {"vv": (-25.0, 0.0), "vh": (-30.0, -5.0)}
STRETCH_DIVISOR, STRETCH_FACTOR = 4000.0, 5.0
RATIO_EPSILON = 1e-6
KNOWN_CLASSES = (1, 2, 4, 5, 7, 8, 11)
FLOODED = 4


def null_nan(v: Column) -> Column:
    return F.when(~F.isnan(v), v)


def clip(v: Column, low: float, high: float) -> Column:
    """Into [low, high]; null stays null, which least() and greatest() alone would not keep."""
    return F.when(v.isNotNull(), F.least(F.greatest(v, F.lit(low)), F.lit(high)))


def clear_by_class(v: Column, scene_class: Column) -> Column:
    return F.when(scene_class.isin(*CLEAR_SCENE_CLASSES), v)


def clear_by_bits(v: Column, quality: Column) -> Column:
    return F.when(quality.cast("int").bitwiseAND(F.lit(CLOUD_BITS)) == 0, v)


def without(v: Column, *nodata: float) -> Column:
    """Null for the given no-data values."""
    return F.when(~v.isin(*nodata), v)


def decibel_unit(linear: Column, band: str) -> Column:
    """Linear power to dB, clipped to the band's range and scaled to 0..1; power of 0 or less is the minimum."""
    low, high = DB_RANGES[band]
    db = F.when(linear <= 0, F.lit(low)).otherwise(F.lit(10.0) * F.log10(linear))
    return (clip(db, low, high) - F.lit(low)) / F.lit(high - low)


def radar_rgb(vv: Column, vh: Column) -> tuple[Column, Column, Column]:
    a, b = decibel_unit(vv, "vv"), decibel_unit(vh, "vh")
    return a, b, a / (b + F.lit(RATIO_EPSILON))


def stretch(v: Column, largest: Column) -> Column:
    """To 0..1: reflectance counts are divided, unit reflectance is multiplied; by the array's largest value."""
    return clip(F.when(largest > 1, v / F.lit(STRETCH_DIVISOR)).otherwise(v * F.lit(STRETCH_FACTOR)), 0.0, 1.0)


def to_byte(v: Column) -> Column:
    """Truncated 255-fold, modulo 256."""
    return F.pmod(F.floor(v * F.lit(255)).cast("bigint"), F.lit(256).cast("bigint"))


def filled(v: Column, fill_na: bool, na_value: float) -> Column:
    return F.coalesce(v, F.lit(float(na_value))) if fill_na else v


#: Smallest and largest whole value of each integer type.
_RANGES = {"tinyint": (-128, 127), "smallint": (-32768, 32767), "int": (-(2**31), 2**31 - 1)}


def checked_cast(v: Column, to: str) -> Column:
    """Truncating cast; null where the value is missing or out of range."""
    if to not in _RANGES:
        return v.cast(to)
    low, high = _RANGES[to]
    return F.when((v > low - 1) & (v < high + 1), F.when(v < 0, F.ceil(v)).otherwise(F.floor(v))).cast(to)


def missing(v: Column) -> Column:
    """A null or a zero."""
    return v.isNull() | (v == 0)


def any_missing(data: Column) -> Column:
    return F.exists(data, lambda v: F.coalesce(v == 0, F.lit(True)))


def any_unknown_class(data: Column) -> Column:
    return F.exists(data, lambda v: F.coalesce(~v.isin(*KNOWN_CLASSES), F.lit(True)))


def any_flooded(data: Column) -> Column:
    return F.exists(data, lambda v: F.coalesce(v == FLOODED, F.lit(False)))


def uniform_class(data: Column) -> Column:
    """Least equals largest and is positive; missing pixels are not regarded."""
    return F.coalesce((F.array_min(data) == F.array_max(data)) & (F.array_min(data) > 0), F.lit(False))
