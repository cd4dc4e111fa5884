"""Line dedup by distinct-site spread.

Every line's hash gets a HyperLogLog sketch of the sites it stands on; sketches merge by partial
aggregation, so a line that stands everywhere costs each task one row. A line whose estimate is
clear of min_sites by three standard errors is decided by it; the lines near it get an exact
distinct count. Boilerplate lines keep their first occurrence (smallest id, then place) and lose all
others. Each row loses what its own text has: rows are told apart by id and text, not by id alone.

Defined cases: null text stays null and has no lines; blank lines are never boilerplate; a null
site is a site of its own; a null id is the smallest one. Ties: rows with one id that have a line at
the same first place all keep it, so repeated rows have equal results and rows with one id and different
texts are cut each by its own lines. An empty table gives an empty one. Other columns pass through; where
the table has a column n_lines or n_removed, the new one has _ after its name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import free_name, materialise, parted

MIN_SITES = 10
LG_K = 10


def _lines(df: DataFrame, id_col: str, text: str, *more: Column) -> DataFrame:
    """id, more, and h and pos of each line that is not blank."""
    lines = F.transform(F.split(F.col(text), "\n", -1), lambda line, i: F.struct(F.xxhash64(line).alias("h"), i.alias("pos"), (line == "").alias("blank")))
    rows = df.select(F.col(id_col).alias("id"), *more, F.inline(lines))
    return rows.where(~F.col("blank")).drop("blank")


def boilerplate(df: DataFrame, id_col: str, text: str, site: str, min_sites: int = MIN_SITES, lg_k: int = LG_K) -> DataFrame:
    """h, first (struct of id and place) and sites of every line on min_sites sites or more."""
    margin = 3 * 1.04 / math.sqrt(2**lg_k)
    lines = _lines(df, id_col, text, F.coalesce(F.col(site), F.lit("\x00")).alias("site"))
    spread = lines.groupBy("h").agg(F.hll_sketch_agg("site", lg_k).alias("sketch"), F.min(F.struct("id", "pos")).alias("first"))
    spread = spread.select("h", "first", F.hll_sketch_estimate("sketch").alias("sites"))
    wide = materialise(spread.where(F.col("sites") >= min_sites * (1 - margin)), "wide-lines")
    near = wide.where(F.col("sites") <= min_sites * (1 + margin))
    exact = lines.join(near.select("h"), "h").select("h", "site").distinct().groupBy("h").agg(F.count("*").alias("exact"))
    decided = wide.join(exact, "h", "left").withColumn("sites", F.coalesce("exact", "sites")).drop("exact")
    return materialise(decided.where(F.col("sites") >= min_sites), "boilerplate")


def remove_boilerplate(df: DataFrame, id_col: str = "doc_id", text: str = "text", site: str = "source", min_sites: int = MIN_SITES, lg_k: int = LG_K) -> DataFrame:
    """df with its text cut, and n_lines and n_removed (long) as further columns."""
    found = boilerplate(df, id_col, text, site, min_sites, lg_k)
    row = F.xxhash64(F.col(text))  # with the id, which row it is; rows that share both are equal
    key, cut = free_name(df.columns, "__row"), free_name(df.columns, "__cut")
    again = _lines(df, id_col, text, row.alias("row")).join(found.select("h", "first"), "h")
    again = again.where(~F.struct("id", "pos").eqNullSafe(F.col("first")))
    places = materialise(again.groupBy(F.struct("id", "row").alias(key)).agg(F.collect_set("pos").alias(cut)), "cuts")
    # only rows that lose a line, and few others, are shuffled
    near, clear = parted(df.withColumn(key, F.struct(F.col(id_col).alias("id"), row.alias("row"))), key, places)
    joined = near.join(places, key, "left").select(*df.columns, cut).unionByName(clear.select(*df.columns, F.lit(None).cast("array<int>").alias(cut)))
    parts = F.split(F.col(text), "\n", -1)
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col(cut)), lambda i: F.get(parts, i))
    counts = {
        free_name(df.columns, "n_lines"): F.coalesce(F.when(F.col(text).isNotNull(), F.size(parts)), F.lit(0)).cast("long"),
        free_name(df.columns, "n_removed"): F.coalesce(F.when(F.col(cut).isNotNull(), F.size(cut)), F.lit(0)).cast("long"),
    }
    return joined.withColumns(counts).withColumn(text, F.when(F.col(cut).isNotNull(), F.array_join(kept, "\n")).otherwise(F.col(text))).drop(cut)


#: The query's result in DuckDB, by rows.
ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS row, * FROM documents),
lines AS (
  SELECT row, doc_id, coalesce(source, chr(0)) AS site, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM d),
wide AS (
  SELECT line, min((doc_id, pos)) AS first FROM lines WHERE line <> ''
  GROUP BY line HAVING count(DISTINCT site) >= {MIN_SITES}),
marked AS (
  SELECT l.row, l.pos, l.line, w.line IS NOT NULL AND (l.doc_id, l.pos) IS DISTINCT FROM w.first AS cut
  FROM lines l LEFT JOIN wide w ON l.line = w.line)
SELECT any_value(d.doc_id) AS doc_id, count(m.pos)::BIGINT AS n_lines, (count(*) FILTER (m.cut))::BIGINT AS n_removed,
       CASE WHEN any_value(d.text) IS NOT NULL THEN md5(coalesce(string_agg(m.line, chr(10) ORDER BY m.pos) FILTER (NOT m.cut), '')) END AS text_md5
FROM d LEFT JOIN marked m ON d.row = m.row
GROUP BY d.row
"""
