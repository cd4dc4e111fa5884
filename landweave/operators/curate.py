"""From the chip log to a balanced release table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import names
from ..schemas import SOURCES
from ..session import held

#: Released classes, their categories and colours.
CLASSES = {
    "1": ("Water", "#419bdf"),
    "2": ("Trees", "#397d49"),
    "5": ("Crops", "#e49635"),
    "7": ("Built area", "#c4281b"),
    "8": ("Bare ground", "#a59b8f"),
    "11": ("Rangeland", "#e3e2c3"),
}


def releasable(log: DataFrame, required_dates: int = 4, sources: Sequence[str] = SOURCES, classes: Sequence[int] = tuple(map(int, CLASSES))) -> DataFrame:
    """Successful chips of released classes with all dates of every source."""
    held = (F.col("status") == "success") & F.col("lulc").isin(*classes)
    for s in sources:
        held = held & (names.list_size(F.col(f"{s}_dates")) == required_dates)
    return log.where(held)


def class_counts(df: DataFrame, cls: str, counted: str) -> DataFrame:
    return df.groupBy(cls).agg(F.count(counted).alias("n"))


def balance_quota(counts: DataFrame, factor: float | None) -> DataFrame:
    """to_drop of each class: in proportion to what it has above the smallest one.

    Without a factor, with equal counts, or where the largest is within the factor, nothing is dropped.
    """
    if not factor:
        return counts.withColumn("to_drop", F.lit(0).cast("bigint"))
    ends = counts.agg(F.max("n").alias("mx"), F.min("n").alias("mn"))  # one row
    joined = counts.crossJoin(F.broadcast(ends))
    span, over = F.col("mx") - F.col("mn"), F.col("mx") - F.col("mn") * F.lit(float(factor))
    share = F.when((span > 0) & (over > 0), over / span)
    drop = F.coalesce(F.floor(share * (F.col("n") - F.col("mn"))), F.lit(0)).cast("bigint")
    return joined.withColumn("to_drop", drop).drop("mx", "mn")


#: Bits of the seeded hash by which a class is counted.
BUCKET_BITS = 16


def _seeded(item: str, seed: str) -> Column:
    """Hash of the seed and the id, as text of even spread."""
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(item).cast("string")))


def _bucket(item: str, seed: str) -> Column:
    return F.conv(F.substring(_seeded(item, seed), 1, BUCKET_BITS // 4), 16, 10).cast("int")


def histogram(df: DataFrame, cls: str, item: str, seed: str) -> DataFrame:
    """Rows (__n) and ids (__ids) of each class and bucket of the seeded hash."""
    return df.groupBy(cls, _bucket(item, seed).alias("__bucket")).agg(F.count("*").alias("__n"), F.count(item).alias("__ids"))


def marked(df: DataFrame, cls: str, item: str, quota: DataFrame, seed: str, out: str = "__drawn", counts: DataFrame | None = None) -> DataFrame:
    """df with whether a row is of its class's first to_drop in an order given by a hash of the seed and the id.

    No class is sorted as a whole: a histogram of the hash's first bits (counts, if it is known) tells in which bucket a class's cut
    lies, and only that bucket's rows, one in 2^BUCKET_BITS, are ranked.
    """
    key, bucket = _seeded(item, seed), _bucket(item, seed)
    counts = histogram(df, cls, item, seed) if counts is None else counts
    upto = Window.partitionBy(cls).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.withColumn("__before", F.coalesce(F.sum("__n").over(upto), F.lit(0))).join(F.broadcast(quota.select(cls, "to_drop")), cls)  # a row for each class
    at_cut = placed.where((F.col("__before") < F.col("to_drop")) & (F.col("__before") + F.col("__n") >= F.col("to_drop")))
    cuts = at_cut.select(F.col(cls).alias("__cls"), F.col("__bucket").alias("__cut"), (F.col("to_drop") - F.col("__before")).alias("__rest"))
    rows = df.withColumns({"__key": key, "__bucket": bucket}).join(F.broadcast(cuts), F.col(cls).eqNullSafe(F.col("__cls")), "left")
    near = F.coalesce(F.col("__bucket") == F.col("__cut"), F.lit(False))
    rank = F.row_number().over(Window.partitionBy("__cls").orderBy("__key", F.col(item)))
    ranked = rows.where(near).withColumn(out, rank <= F.col("__rest"))
    clear = rows.where(~near).withColumn(out, F.coalesce(F.col("__bucket") < F.col("__cut"), F.lit(False)))
    return clear.unionByName(ranked).select(*df.columns, out)


def balanced(df: DataFrame, cls: str, item: str, factor: float | None, seed: str = "42") -> DataFrame:
    """df without each class's quota, drawn by a seeded hash."""
    counts = held(histogram(df, cls, item, seed), "histogram")  # a row for each class and bucket
    quota = balance_quota(counts.groupBy(cls).agg(F.sum("__ids").alias("n")), factor)
    return marked(df, cls, item, quota, seed, counts=counts).where(~F.col("__drawn")).drop("__drawn")


def labelled(df: DataFrame, cls: str) -> DataFrame:
    """category and color of each class; null for unknown ones."""

    def table(k: int) -> Column:
        return F.create_map(*[F.lit(x) for c, v in CLASSES.items() for x in (c, v[k])])

    return df.withColumns({"category": F.try_element_at(table(0), F.col(cls)), "color": F.try_element_at(table(1), F.col(cls))})


def with_paths(df: DataFrame, thumb_prefix: str = "") -> DataFrame:
    """Thumbnail and chip paths of every source, from ids and dates."""
    new = {}
    for s in SOURCES:
        new[f"{s}_thumbs"] = names.dated_names(s, F.col("id"), F.col(f"{s}_dates"), "png", thumb_prefix)
        new[f"{s}_paths"] = names.dated_names(s, F.col("id"), F.col(f"{s}_dates"), "tif")
    return df.withColumns({**new, "dem_paths": names.plain_name("dem", F.col("id"))})


def asset_manifest(df: DataFrame, old_id: str = "original_id", new_id: str = "id", dates: str = "{}_dates", sources: Sequence[str] = SOURCES) -> DataFrame:
    """src and dst of every file to copy: the step number goes, the id changes. Land-cover chips stay behind."""
    def files(source: str, ext: str) -> Column:
        def renamed(day: Column, step: Column) -> Column:
            src = names.step_name(F.lit(source), F.col(old_id), step, day, ext)
            return F.struct(src.alias("src"), F.concat(F.lit(f"{source}_"), names.id6(F.col(new_id)), F.lit("_"), day, F.lit(f".{ext}")).alias("dst"))

        return F.transform(F.split(F.col(dates.format(source)), ","), renamed)

    dem = F.array(F.struct(names.plain_name("dem", F.col(old_id)).alias("src"), names.plain_name("dem", F.col(new_id)).alias("dst")))
    return df.select(F.inline(F.concat(*[files(s, ext) for s in sources for ext in ("tif", "png")], dem)))


def exclude_include(df: DataFrame, key: str, include: Sequence[int] | None, exclude: Sequence[int] | None) -> DataFrame:
    """Without the excluded keys, then only the included ones; a key that is not there raises."""
    asked = sorted({*(include or ()), *(exclude or ())})
    if asked:
        there = {r[0] for r in df.where(F.col(key).isin(*asked)).select(key).distinct().collect()}  # at most the asked ones
        lacking = [k for k in asked if k not in there]
        if lacking or set(include or ()) & set(exclude or ()):
            raise KeyError(f"no such {key}: {lacking or sorted(set(include) & set(exclude))}")
    if exclude:
        df = df.where(~F.col(key).isin(*exclude))
    return df.where(F.col(key).isin(*include)) if include else df


def resumable(areas: DataFrame, log: DataFrame, key: str) -> DataFrame:
    """Areas after the last one in the log; all of them where the log is empty."""
    last = log.agg(F.max(key).alias("__last"))  # one row
    return areas.crossJoin(F.broadcast(last)).where(F.col("__last").isNull() | (F.col(key) > F.col("__last"))).drop("__last")


def upsert_status(areas: DataFrame, done: DataFrame, key: str, status: str = "status") -> DataFrame:
    news = done.select(key, F.col(status).alias("__new"))
    return areas.join(news, key, "left").withColumn(status, F.coalesce("__new", status)).drop("__new")
