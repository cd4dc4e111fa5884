"""File names, paths and links built from ids and date lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def id6(i: Column) -> Column:
    """At least six digits; longer ids are kept whole."""
    return F.format_string("%06d", i)


def padded_path(path: Column) -> Column:
    text = path.cast("string")
    return F.when(F.length(text) < 3, F.lpad(text, 3, "0")).otherwise(text)


def dated_names(source: str, i: Column, dates: Column, ext: str, prefix: str = "") -> Column:
    """Comma-joined {prefix}{source}_{id}_{date}.{ext}, one for each date of a comma-joined list."""
    stem = F.concat(F.lit(f"{prefix}{source}_"), id6(i), F.lit("_"))
    return F.array_join(F.transform(F.split(dates, ","), lambda d: F.concat(stem, d, F.lit(f".{ext}"))), ",")


def step_name(source: Column, i: Column, step: Column, day: Column, ext: str) -> Column:
    return F.concat(source, F.lit("_"), id6(i), F.lit("_"), step.cast("string"), F.lit("_"), day, F.lit(f".{ext}"))


def plain_name(source: str, i: Column, ext: str = "tif") -> Column:
    return F.concat(F.lit(f"{source}_"), id6(i), F.lit(f".{ext}"))


def list_size(dates: Column) -> Column:
    """Entries of a comma-joined list; an empty text has one, as when it is split."""
    return F.size(F.split(dates, ","))


def epsg_of(epsg: Column, code: Column) -> Column:
    """The number itself, else what follows the colon of a code such as EPSG:32633."""
    return F.coalesce(epsg, F.element_at(F.split(code, ":"), -1).try_cast("int"))
