"""The land-cover queries on the shared tables, each with its SQL twin.

The tables are no satellite data, so each operator runs on a table of the same shape: orders are
scenes of a customer's area in a quarter's season, lineitem rows are a supplier's time series,
events are scenes of a user, embeddings are 8 x 8 pixel tiles.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo, names, pixels, timefn
from ..operators import chips, curate, raster, scenes
from ..session import dealt, held, table

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query by its name, with its SQL."""

    def register(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _ORACLES[f.__name__] = sql
        return f

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)


def big(c: str) -> F.Column:
    return F.col(c).cast("bigint")


def whole(v: F.Column) -> F.Column:
    """A value's hundred-thousandths, of which sums are the same in any order."""
    return F.round(v * 100000).cast("bigint")


def orders(spark: SparkSession, sf_dir: str, year: int | None = 1997) -> DataFrame:
    df = table(spark, sf_dir, "orders").withColumn("t", timefn.ts("o_orderdate")).withColumn("q", timefn.quarter(F.col("t")))
    return df if year is None else df.where((F.col("t") >= F.lit(f"{year}-01-01").cast("timestamp")) & (F.col("t") < F.lit(f"{year + 1}-01-01").cast("timestamp")))


Y1997 = "o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'"

# scene predicates and rankings


@query("""
SELECT event_id, user_id, event_type, value FROM events
WHERE value < 30 AND event_type IN ('click', 'view', 'purchase')
  AND ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20'""")
def scene_filter(spark, d):
    wanted = (F.col("value") < 30) & F.col("event_type").isin("click", "view", "purchase")
    within = scenes.within(timefn.ts("ts"), F.lit("2024-01-05").cast("timestamp"), F.lit("2024-01-20").cast("timestamp"))
    return table(spark, d, "events").where(wanted & within).select("event_id", "user_id", "event_type", "value")


@query(f"""
SELECT o_custkey, quarter(o_orderdate)::BIGINT AS q, o_orderkey, o_totalprice FROM orders WHERE {Y1997}
QUALIFY row_number() OVER (PARTITION BY o_custkey, quarter(o_orderdate) ORDER BY o_totalprice, o_orderkey) = 1""")
def least_cloudy_per_season(spark, d):
    best = scenes.top_per_group(orders(spark, d), ["o_custkey", "q"], [F.asc("o_totalprice"), F.asc("o_orderkey")])
    return best.select("o_custkey", "q", "o_orderkey", "o_totalprice")


@query(f"""
WITH o AS (SELECT *, quarter(o_orderdate)::BIGINT AS q FROM orders WHERE {Y1997}),
lock AS (SELECT o_custkey, o_orderpriority FROM o WHERE q = 1
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) = 1)
SELECT o.o_custkey, o.q, o.o_orderkey, o.o_orderpriority FROM o JOIN lock USING (o_custkey, o_orderpriority)
QUALIFY row_number() OVER (PARTITION BY o.o_custkey, o.q ORDER BY o_totalprice, o_orderkey) = 1""")
def locked_seasons(spark, d):
    best = scenes.locked_top(orders(spark, d), "o_custkey", "q", 1, [F.asc("o_totalprice"), F.asc("o_orderkey")], "o_orderpriority")
    return best.select("o_custkey", "q", "o_orderkey", "o_orderpriority")


@query("""
WITH g AS (SELECT l_suppkey, l_linenumber, sum(l_quantity::BIGINT)::BIGINT AS area,
  min(abs(date_diff('day', DATE '1997-07-01', l_shipdate::DATE)))::BIGINT AS distance FROM lineitem GROUP BY ALL)
SELECT l_suppkey, l_linenumber, area, distance FROM g
QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY area DESC, distance, l_linenumber) = 1""")
def locked_orbit(spark, d):
    lines = table(spark, d, "lineitem")
    distance = F.min(F.abs(F.datediff(F.to_date("l_shipdate"), F.lit("1997-07-01").cast("date")))).cast("bigint")
    return scenes.locked_orbit(lines, "l_suppkey", "l_linenumber", F.sum(big("l_quantity")), distance)


@query("""
SELECT o_orderkey,
  strftime(greatest(o_orderdate - INTERVAL 12 DAY, date_trunc('quarter', o_orderdate)), '%Y-%m-%dT%H:%M:%SZ') AS lo,
  strftime(least(o_orderdate + INTERVAL 12 DAY, date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH - INTERVAL 1 SECOND), '%Y-%m-%dT%H:%M:%SZ') AS hi
FROM orders""")
def clipped_window(spark, d):
    o = orders(spark, d, None)
    start = F.date_trunc("quarter", "t")
    low, high = timefn.clipped_window(F.col("t"), start, start + F.expr("INTERVAL '3' MONTH") - F.expr("INTERVAL '1' SECOND"), 12)
    return o.select("o_orderkey", timefn.iso_seconds(low).alias("lo"), timefn.iso_seconds(high).alias("hi"))


@query(f"""
WITH a AS (SELECT o_orderkey, o_orderdate FROM orders WHERE {Y1997}),
j AS (SELECT o_orderkey, l_shipdate, l_linenumber, l_partkey, abs(epoch_us(o_orderdate) - epoch_us(l_shipdate)) AS dist
  FROM a JOIN lineitem ON l_orderkey = o_orderkey
  WHERE l_shipdate BETWEEN o_orderdate - INTERVAL 91 DAY AND o_orderdate + INTERVAL 91 DAY)
SELECT o_orderkey, l_partkey, l_linenumber::BIGINT AS l_linenumber, dist::BIGINT AS distance FROM j
QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY dist, l_shipdate, l_linenumber, l_partkey) = 1""")
def nearest_in_time(spark, d):
    lines = table(spark, d, "lineitem").withColumn("o_orderkey", F.col("l_orderkey")).withColumn("item", F.struct("l_linenumber", "l_partkey"))
    near = scenes.nearest_in_time(orders(spark, d), lines, ["o_orderkey"], "o_orderkey", "t", "l_shipdate", "item", 91)
    return near.select("o_orderkey", "l_partkey", big("l_linenumber").alias("l_linenumber"), "distance")


@query("""
WITH e AS (SELECT * FROM events WHERE value < 100),
b AS (SELECT user_id, arg_min(ts, (value, event_id))::DATE AS d FROM e GROUP BY user_id)
SELECT e.event_id, e.user_id, e.value FROM e JOIN b ON e.user_id = b.user_id AND e.ts::DATE = b.d""")
def best_date_scenes(spark, d):
    held = table(spark, d, "events").where("value < 100")
    return scenes.best_date_rows(held, ["user_id"], "ts", ["value", "event_id"]).select("event_id", "user_id", "value")


@query(f"""
SELECT c.c_custkey, count(DISTINCT quarter(o.o_orderdate))::BIGINT AS n_quarters,
  CASE WHEN count(o.o_orderkey) = 0 THEN 'scenes missing' WHEN count(DISTINCT quarter(o.o_orderdate)) < 4 THEN 'scenes insufficient' ELSE 'success' END AS status
FROM customer c LEFT JOIN (SELECT * FROM orders WHERE {Y1997}) o ON c.c_custkey = o.o_custkey GROUP BY c.c_custkey""")
def date_coverage(spark, d):
    counts = orders(spark, d).groupBy("o_custkey").agg(F.count_distinct("q").alias("n"), F.count("*").alias("rows"))
    joined = table(spark, d, "customer").join(counts, F.col("c_custkey") == F.col("o_custkey"), "left")
    n = F.coalesce("n", F.lit(0))
    status = scenes.first_failure([(F.col("rows").isNull(), "scenes missing"), (n < 4, "scenes insufficient")])
    return joined.select("c_custkey", n.alias("n_quarters"), status.alias("status"))


@query("""
SELECT user_id, count(DISTINCT ts::DATE)::BIGINT AS n_dates FROM events GROUP BY user_id""")
def distinct_dates(spark, d):
    return scenes.distinct_dates(table(spark, d, "events"), ["user_id"], "ts")


# footprints


@query("""
WITH g AS (SELECT nullif(event_type, 'error') AS event_type, ts::DATE AS d, min(user_id) AS minx, min(value) AS miny, max(user_id) AS maxx, max(value) AS maxy
  FROM events WHERE nullif(event_type, 'error') IS NOT NULL GROUP BY ALL),
f AS (SELECT event_type, max(minx) AS a, max(miny) AS b, min(maxx) AS c, min(maxy) AS e FROM g GROUP BY event_type)
SELECT event_type, CASE WHEN a <= c AND b <= e THEN a END AS minx, CASE WHEN a <= c AND b <= e THEN b END AS miny,
  CASE WHEN a <= c AND b <= e THEN c END AS maxx, CASE WHEN a <= c AND b <= e THEN e END AS maxy FROM f""")
def group_union_bounds(spark, d):
    e = table(spark, d, "events").withColumns({"event_type": F.nullif("event_type", F.lit("error")), "d": F.to_date("ts")})
    unions = scenes.group_bounds(e, ["event_type", "d"], "user_id", "value", "user_id", "value")
    return scenes.common_bounds(unions, ["event_type"])


@query("""
SELECT p_partkey, s_suppkey FROM
 (SELECT p_partkey, p_retailprice AS lo, p_retailprice + p_size AS hi FROM part) p JOIN
 (SELECT s_suppkey, 900 + (s_acctbal + 1000) / 10 AS lo, 900 + (s_acctbal + 1000) / 10 + 5 AS hi FROM supplier) s
 ON p.lo <= s.hi AND s.lo <= p.hi""")
def bbox_overlap_join(spark, d):
    return scenes.interval_overlaps(*_price_intervals(spark, d)).select("p_partkey", "s_suppkey")


def _price_intervals(spark, d):
    """Both sides, their ends, and a width of cells: of that the number of keys depends, and nothing else."""
    p = table(spark, d, "part").select("p_partkey", F.col("p_retailprice").alias("p_lo"), (F.col("p_retailprice") + F.col("p_size")).alias("p_hi"))
    base = F.lit(900) + (F.col("s_acctbal") + 1000) / 10
    s = table(spark, d, "supplier").select("s_suppkey", base.alias("s_lo"), (base + 5).alias("s_hi"))
    return p, s, "p_lo", "p_hi", "s_lo", "s_hi", 5.0


@query("""
WITH j AS (SELECT p_partkey, s_suppkey, round(least(p.hi, s.hi) - greatest(p.lo, s.lo), 4) AS area FROM
 (SELECT p_partkey, p_retailprice AS lo, p_retailprice + p_size AS hi FROM part) p JOIN
 (SELECT s_suppkey, 900 + (s_acctbal + 1000) / 10 AS lo, 900 + (s_acctbal + 1000) / 10 + 5 AS hi FROM supplier) s
 ON p.lo <= s.hi AND s.lo <= p.hi)
SELECT p_partkey, s_suppkey, area FROM j QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY area DESC, s_suppkey) = 1""")
def best_path(spark, d):
    area = F.round(F.least("p_hi", "s_hi") - F.greatest("p_lo", "s_lo"), 4)
    return scenes.best_interval(*_price_intervals(spark, d), area, "s_suppkey").select("p_partkey", "s_suppkey", "area")


_LONLAT = "(c_custkey * 37 % 340) - 170.0 AS minx, (c_custkey * 53 % 140) - 70.0 AS miny"


def _customer_boxes(spark, d):
    k = F.col("c_custkey")
    lon, lat = k * 37 % 340 - 170.0, k * 53 % 140 - 70.0
    return table(spark, d, "customer").select("c_custkey", F.struct(lon.alias("minx"), lat.alias("miny"), (lon + 1).alias("maxx"), (lat + 1).alias("maxy")).alias("box"))


@query(f"""
WITH b AS (SELECT c_custkey, {_LONLAT} FROM customer)
SELECT c_custkey, round(6378137.0 * (radians(minx + 1) - radians(minx)) * 6378137.0 *
  (ln(tan(pi() / 4 + radians(miny + 1) / 2)) - ln(tan(pi() / 4 + radians(miny) / 2))) / 1e6, 2) AS km2 FROM b""")
def mercator_area(spark, d):
    m = geo.mercator_box(F.col("box"))
    boxes = _customer_boxes(spark, d).select("c_custkey", m.alias("m"))
    return boxes.select("c_custkey", F.round((F.col("m.maxx") - F.col("m.minx")) * (F.col("m.maxy") - F.col("m.miny")) / 1e6, 2).alias("km2"))


@query(f"""
WITH b AS (SELECT c_custkey, {_LONLAT} FROM customer),
s AS (SELECT s_suppkey, (s_suppkey * 17 % 340) - 170.0 AS x, (s_suppkey * 29 % 140) - 70.0 AS y FROM supplier)
SELECT c_custkey, s_suppkey,
  round(greatest(least(minx + 1, x + 3) - greatest(minx, x), 0) * greatest(least(miny + 1 - 0.25, y + 3) - greatest(miny, y), 0), 6)::DOUBLE AS area
FROM (SELECT c_custkey, minx + 0.25 AS minx0, minx, miny FROM b) q JOIN s
ON q.minx0 <= s.x + 3 AND s.x <= q.minx + 1 AND q.miny <= s.y + 3 AND s.y <= q.miny + 1 - 0.25""")
def bbox_adjust(spark, d):
    k = F.col("s_suppkey")
    x, y = k * 17 % 340 - 170.0, k * 29 % 140 - 70.0
    s = table(spark, d, "supplier").select("s_suppkey", F.struct(x.alias("minx"), y.alias("miny"), (x + 3).alias("maxx"), (y + 3).alias("maxy")).alias("sbox"))
    c = _customer_boxes(spark, d).withColumn("adjusted", geo.adjusted_box(F.col("box"), 0.5))
    pairs = scenes.box_overlaps(c, s, "adjusted", "sbox", 5.0)
    wide = F.struct(F.col("box.minx").alias("minx"), F.col("adjusted.miny").alias("miny"), F.col("box.maxx").alias("maxx"), F.col("adjusted.maxy").alias("maxy"))
    return pairs.select("c_custkey", "s_suppkey", F.round(geo.box_intersection_area(wide, F.col("sbox")), 6).alias("area"))


_UTM = """
WITH b AS (SELECT s_suppkey, 32601 + s_suppkey % 60 AS epsg, 400000.0 + (s_suppkey * 7919 % 200000) AS x, 1000000.0 + (s_suppkey * 104729 % 5000000) AS y FROM supplier),
c AS (SELECT s_suppkey, epsg, x + 480 AS e, y + 480 AS n FROM b),
k AS (SELECT *, 1 / 298.257223563 / (2 - 1 / 298.257223563) AS m FROM c),
r AS (SELECT *, 6378137.0 / (1 + m) * (1 + m**2 / 4 + m**4 / 64) AS rad FROM k),
z AS (SELECT *, n / (0.9996 * rad) AS xi, (e - 500000.0) / (0.9996 * rad) AS eta FROM r),
w AS (SELECT *, xi - (m/2 - 2*m**2/3 + 37*m**3/96 - m**4/360) * sin(2*xi) * cosh(2*eta) - (m**2/48 + m**3/15 - 437*m**4/1440) * sin(4*xi) * cosh(4*eta)
      - (17*m**3/480 - 37*m**4/840) * sin(6*xi) * cosh(6*eta) - (4397*m**4/161280) * sin(8*xi) * cosh(8*eta) AS xi2,
  eta - (m/2 - 2*m**2/3 + 37*m**3/96 - m**4/360) * cos(2*xi) * sinh(2*eta) - (m**2/48 + m**3/15 - 437*m**4/1440) * cos(4*xi) * sinh(4*eta)
      - (17*m**3/480 - 37*m**4/840) * cos(6*xi) * sinh(6*eta) - (4397*m**4/161280) * cos(8*xi) * sinh(8*eta) AS eta2 FROM z),
v AS (SELECT *, asin(sin(xi2) / cosh(eta2)) AS chi FROM w)
SELECT s_suppkey, round(degrees(atan2(sinh(eta2), cos(xi2))) + (epsg % 100) * 6 - 183, 6) AS lon,
  round(degrees(chi + (2*m - 2*m**2/3 - 2*m**3 + 116*m**4/45) * sin(2*chi) + (7*m**2/3 - 8*m**3/5 - 227*m**4/45) * sin(4*chi)
      + (56*m**3/15 - 136*m**4/35) * sin(6*chi) + (4279*m**4/630) * sin(8*chi)), 6) AS lat FROM v"""


@query(_UTM)
def footprint_centroid(spark, d):
    k = F.col("s_suppkey")
    epsg = (F.lit(32601) + k % 60).cast("int")
    x, y = F.lit(400000.0) + k * 7919 % 200000, F.lit(1000000.0) + k * 104729 % 5000000
    lon, lat = geo.utm_inverse(x + 480, y + 480, epsg)
    return table(spark, d, "supplier").select("s_suppkey", F.round(lon, 6).alias("lon"), F.round(lat, 6).alias("lat"))


# composites, means and masks


@query("""
WITH l AS (SELECT l_suppkey, quarter(l_shipdate)::BIGINT AS quarter, l_shipdate, l_orderkey, l_linenumber, l_partkey, nullif(l_quantity, 1) AS v FROM lineitem),
c AS (SELECT l_suppkey, quarter, arg_min(v, (l_shipdate, l_orderkey, l_linenumber, l_partkey)) FILTER (v IS NOT NULL) AS v FROM l GROUP BY ALL),
t AS (SELECT l_suppkey, quarter, strftime(min(l_shipdate), '%Y-%m-%d') AS day FROM l GROUP BY ALL)
SELECT l_suppkey, quarter, v, day FROM c JOIN t USING (l_suppkey, quarter)""")
def quarter_composite(spark, d):
    lines = table(spark, d, "lineitem").withColumn("v", F.nullif("l_quantity", F.lit(1.0)))
    found = raster.quarter_values(lines, ["l_suppkey"], "l_shipdate", ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"], "v")
    return found.select("l_suppkey", "quarter", "v", F.date_format("t", "yyyy-MM-dd").alias("day"))


@query("""
SELECT l_suppkey, round(avg(nullif(l_quantity, 1)), 6) AS v FROM lineitem GROUP BY l_suppkey""")
def temporal_mean(spark, d):
    lines = table(spark, d, "lineitem").withColumn("v", F.nullif("l_quantity", F.lit(1.0)))
    return raster.temporal_mean(lines, ["l_suppkey"], "v").withColumn("v", F.round("v", 6))


@query("""
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_suppkey, CASE WHEN l_linenumber IN (2, 4, 5, 6, 11) THEN l_quantity END AS v FROM lineitem""")
def scl_mask(spark, d):
    v = pixels.clear_by_class(F.col("l_quantity"), F.col("l_linenumber"))
    return table(spark, d, "lineitem").select("l_orderkey", big("l_linenumber").alias("l_linenumber"), "l_partkey", "l_suppkey", v.alias("v"))


@query("""
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_suppkey, CASE WHEN (l_linenumber & 30) = 0 THEN l_quantity END AS v FROM lineitem""")
def qa_bits(spark, d):
    v = pixels.clear_by_bits(F.col("l_quantity"), F.col("l_linenumber"))
    return table(spark, d, "lineitem").select("l_orderkey", big("l_linenumber").alias("l_linenumber"), "l_partkey", "l_suppkey", v.alias("v"))


_CLASS = "CASE WHEN v < -0.08 THEN 1 WHEN v < 0.02 THEN 2 WHEN v < 0.12 THEN 5 WHEN v < 0.30 THEN 7 ELSE 4 END"
_PIXELS = f"""
p AS (SELECT vec_id, label, i - 1 AS pos, embedding[i]::DOUBLE AS v FROM embeddings, range(1, 65) r(i)),
c AS (SELECT vec_id, label, pos, pos // 8 AS y, pos % 8 AS x, ({_CLASS})::BIGINT AS c, v FROM p),
w AS (SELECT vec_id, label, y // 2 AS wy, x // 2 AS wx, min(c) AS low, max(c) AS high, count(*) FILTER (c = 4) AS n4 FROM c GROUP BY ALL)"""


def class_of(v):
    v = v.cast("double")
    return F.when(v < -0.08, 1.0).when(v < 0.02, 2.0).when(v < 0.12, 5.0).when(v < 0.30, 7.0).otherwise(4.0)


def class_tiles(spark, d):
    """Tiles of 64 classes from the embeddings' values."""
    return table(spark, d, "embeddings").select("vec_id", "label", F.transform("embedding", class_of).alias("tile"))


def class_windows(spark, d, n: int = 2):
    return raster.windows_in_rows(class_tiles(spark, d), "tile", 8, n, ["vec_id", "label"])


@query(f"WITH {_PIXELS} SELECT vec_id, wy::BIGINT AS wy, wx::BIGINT AS wx, low AS cls FROM w WHERE low = high AND low > 0")
def class_raster(spark, d):
    return chips.candidates(class_windows(spark, d)).select("vec_id", big("wy").alias("wy"), big("wx").alias("wx"), F.array_min("data").cast("bigint").alias("cls"))


@query(f"""
WITH {_PIXELS}, t AS (SELECT vec_id, y // 3 AS wy, x // 3 AS wx, min(c) AS low, max(c) AS high FROM c WHERE y < 6 AND x < 6 GROUP BY ALL)
SELECT vec_id, wy::BIGINT AS wy, wx::BIGINT AS wx, low, high, low = high AND low > 0 AS uniform FROM t""")
def coarsen_trimmed(spark, d):
    cells = raster.to_pixels(class_tiles(spark, d), "tile", 8, ["vec_id"])
    found = raster.coarsen(cells, ["vec_id"], 3, 8, 8, "v")
    return found.select("vec_id", big("wy").alias("wy"), big("wx").alias("wx"), big("low").alias("low"), big("high").alias("high"), "uniform")


def spoiled(data):
    """A window's classes with some values missing and some of class 3."""
    return F.transform(data, lambda v, i: F.when((F.col("vec_id") % 11 == 0) & (F.col("wy") == 1) & (i == 3), F.lit(None).cast("double")).when((F.col("vec_id") % 7 == 0) & (F.col("wx") == 2), F.lit(3.0)).otherwise(v))


def status_windows(spark, d):
    """2 x 2 class windows with some values missing and some of class 3, and the last row and column as edges."""
    w = class_windows(spark, d).withColumn("data", spoiled(F.col("data")))
    edge = (F.col("wy") == 3) | (F.col("wx") == 3)
    return w.withColumn("lulc_status", chips.land_cover_status(F.col("data"), edge))


_STATUS = f"""
{_PIXELS}, s AS (SELECT vec_id, label, y // 2 AS wy, x // 2 AS wx,
  CASE WHEN vec_id % 11 = 0 AND y // 2 = 1 AND y % 2 = 1 AND x % 2 = 1 THEN NULL WHEN vec_id % 7 = 0 AND x // 2 = 2 THEN 3 ELSE c END AS c FROM c),
ws AS (SELECT vec_id, label, wy, wx, min(c) AS cls,
  CASE WHEN wy = 3 OR wx = 3 THEN 'edge_out_of_bounds' WHEN count(c) < 4 THEN 'lulc missing values' WHEN count(*) FILTER (c NOT IN (1, 2, 4, 5, 7, 8, 11)) > 0 THEN 'lulc_values_wrong'
  WHEN count(*) FILTER (c = 4) > 0 THEN 'lulc_values_flooded_vegetation' ELSE 'ok' END AS st FROM s GROUP BY vec_id, label, wy, wx)"""


@query(f"""
WITH {_STATUS} SELECT vec_id, wy::BIGINT AS wy, wx::BIGINT AS wx, count(*) FILTER (c = 4) > 0 AS flooded,
  count(*) FILTER (c IS NULL OR c NOT IN (1, 2, 4, 5, 7, 8, 11)) > 0 AS unknown, count(*) FILTER (c IS NULL OR c = 0) > 0 AS gaps
FROM s GROUP BY vec_id, wy, wx""")
def missing_qc(spark, d):
    data = F.col("data")
    return status_windows(spark, d).select("vec_id", big("wy").alias("wy"), big("wx").alias("wx"), pixels.any_flooded(data).alias("flooded"), pixels.any_unknown_class(data).alias("unknown"), pixels.any_missing(data).alias("gaps"))


@query(f"WITH {_STATUS} SELECT vec_id, wy::BIGINT AS wy, wx::BIGINT AS wx, st AS lulc_status, CASE WHEN st = 'ok' THEN cls END AS lulc FROM ws")
def chip_status(spark, d):
    w = chips.chip_class(status_windows(spark, d), "lulc_status", "data")
    return w.select("vec_id", big("wy").alias("wy"), big("wx").alias("wx"), "lulc_status", big("lulc").alias("lulc"))


def capped_windows(spark, d, cap: int = 5):
    """Windows of every class with the cap of successes per label and class, and their status."""
    w = chips.chip_class(status_windows(spark, d), "lulc_status", "data")
    passed = w.where(F.col("lulc_status") == "ok").withColumn("ok", F.col("vec_id") % 5 != 0)
    capped = chips.capped(passed, ["label"], "lulc", ["vec_id", "wy", "wx"], "ok", cap)
    failures = [(F.col("vec_id") % 5 == 0, "s1rtc missing values")]
    return capped.withColumn("status", chips.chip_status(F.col("lulc_status"), F.col("over_cap"), F.col("lulc"), failures))


_CAP = f"""
{_STATUS}, k AS (SELECT *, coalesce(sum(CASE WHEN vec_id % 5 <> 0 THEN 1 ELSE 0 END) OVER (PARTITION BY label, cls ORDER BY vec_id, wy, wx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior
  FROM ws WHERE st = 'ok'),
cap AS (SELECT vec_id, label, wy, wx, cls, CASE WHEN prior >= 5 THEN 'lulc_' || cls || '_limit' WHEN vec_id % 5 = 0 THEN 's1rtc missing values' ELSE 'success' END AS status FROM k)"""


@query(f"WITH {_CAP} SELECT vec_id, label::BIGINT AS label, wy::BIGINT AS wy, wx::BIGINT AS wx, cls AS lulc, status FROM cap")
def class_cap(spark, d):
    return capped_windows(spark, d).select("vec_id", big("label").alias("label"), big("wy").alias("wy"), big("wx").alias("wx"), big("lulc").alias("lulc"), "status")


@query(f"""
WITH {_CAP} SELECT vec_id, wy::BIGINT AS wy, wx::BIGINT AS wx, (row_number() OVER (ORDER BY label, vec_id, wy, wx) - 1)::BIGINT AS chip_index FROM cap""")
def running_chip_index(spark, d):
    found = chips.running_index(capped_windows(spark, d), "label", ["vec_id", "wy", "wx"])
    return found.select("vec_id", big("wy").alias("wy"), big("wx").alias("wx"), "chip_index")


@query(f"""
WITH {_STATUS} SELECT vec_id, wy::BIGINT AS wy, wx::BIGINT AS wx,
  last_value(CASE WHEN st = 'ok' THEN cls END IGNORE NULLS) OVER (PARTITION BY label ORDER BY vec_id, wy, wx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS carried FROM ws""")
def carry_forward_class(spark, d):
    w = chips.chip_class(status_windows(spark, d), "lulc_status", "data")
    return chips.carried(w, ["label"], ["vec_id", "wy", "wx"], "lulc", "carried").select("vec_id", big("wy").alias("wy"), big("wx").alias("wx"), big("carried").alias("carried"))


@query(f"WITH {_CAP} SELECT vec_id, wy::BIGINT AS wy, wx::BIGINT AS wx, cls AS lulc FROM cap WHERE status = 'success' AND cls IN (1, 2, 5, 7, 8, 11)")
def success_classes(spark, d):
    return curate.releasable(capped_windows(spark, d), sources=()).select("vec_id", big("wy").alias("wy"), big("wx").alias("wx"), big("lulc").alias("lulc"))


@query(f"""
WITH {_CAP}, r AS (SELECT *, (row_number() OVER (ORDER BY label, vec_id, wy, wx) - 1)::BIGINT AS original_id FROM cap),
rel AS (SELECT *, (row_number() OVER (ORDER BY original_id) - 1)::BIGINT AS id FROM r WHERE status = 'success' AND cls IN (1, 2, 5, 7, 8, 11))
SELECT id, original_id, label::BIGINT AS aoi_index, cls::VARCHAR AS lulc,
  CASE cls WHEN 1 THEN 'Water' WHEN 2 THEN 'Trees' WHEN 5 THEN 'Crops' WHEN 7 THEN 'Built area' WHEN 8 THEN 'Bare ground' WHEN 11 THEN 'Rangeland' END AS category,
  'dem_' || printf('%06d', id) || '.tif' AS dem_paths FROM rel""")
def release_rows(spark, d):
    return flagship(spark, d)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles to windows to status, cap, numbers, classes and paths: a small release table."""
    numbered = chips.running_index(capped_windows(spark, sf_dir), "label", ["vec_id", "wy", "wx"], "original_id")
    kept = curate.releasable(numbered, sources=())
    ids = chips.dense_ids(kept, "original_id", "id")
    named = curate.labelled(ids.withColumn("lulc", F.col("lulc").cast("int").cast("string")), "lulc")
    return named.select("id", "original_id", big("label").alias("aoi_index"), "lulc", "category", names.plain_name("dem", F.col("id")).alias("dem_paths"))


# curation

_EV = "e AS (SELECT event_id, event_type, value FROM events WHERE value > 100), n AS (SELECT event_type, count(event_id) AS n FROM e GROUP BY 1)"


def _quota(s: float) -> str:
    drop = f"CASE WHEN mx > mn AND mx - mn * {s} > 0 THEN floor((mx - mn * {s}) / (mx - mn) * (n - mn)) ELSE 0 END"
    return f"{_EV}, q AS (SELECT event_type, n, ({drop})::BIGINT AS to_drop FROM n, (SELECT max(n)::DOUBLE AS mx, min(n)::DOUBLE AS mn FROM n))"


def _events(spark, d):
    return table(spark, d, "events").where("value > 100").select("event_id", "event_type", "value")


@query(f"WITH {_EV} SELECT event_type, n::BIGINT AS n FROM n")
def class_counts(spark, d):
    return curate.class_counts(_events(spark, d), "event_type", "event_id")


@query(f"WITH {_quota(1.1)} SELECT event_type, n::BIGINT AS n, to_drop FROM q")
def balance_quota(spark, d):
    return curate.balance_quota(curate.class_counts(_events(spark, d), "event_type", "event_id"), 1.1)


_RANKED = "r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY md5('42|' || event_id), event_id) AS k FROM e)"


@query(f"WITH {_quota(1.0)}, {_RANKED} SELECT event_id, r.event_type, value FROM r JOIN q USING (event_type) WHERE k > to_drop")
def balanced_sample(spark, d):
    return curate.balanced(_events(spark, d), "event_type", "event_id", 1.0)


@query(f"WITH {_quota(1.1)}, {_RANKED} SELECT event_id, event_type FROM e ANTI JOIN (SELECT event_id FROM r JOIN q USING (event_type) WHERE k <= to_drop) x USING (event_id)")
def drop_sample(spark, d):
    e = _events(spark, d)
    quota = curate.balance_quota(curate.class_counts(e, "event_type", "event_id"), 1.1)
    drawn = curate.marked(e, "event_type", "event_id", quota, "42", "drawn")
    return drawn.where("NOT drawn").select("event_id", "event_type")


@query("""
SELECT o_orderkey AS original_id, (row_number() OVER (ORDER BY o_orderkey) - 1)::BIGINT AS id, o_custkey::VARCHAR AS lulc FROM orders WHERE o_totalprice > 200000""")
def release_ids(spark, d):
    kept = table(spark, d, "orders").where("o_totalprice > 200000").withColumnRenamed("o_orderkey", "original_id")
    return chips.dense_ids(kept, "original_id", "id", stored=True).select("original_id", "id", F.col("o_custkey").cast("string").alias("lulc"))


@query("""
SELECT p_partkey, CASE p_size % 12 WHEN 1 THEN 'Water' WHEN 2 THEN 'Trees' WHEN 5 THEN 'Crops' WHEN 7 THEN 'Built area' WHEN 8 THEN 'Bare ground' WHEN 11 THEN 'Rangeland' END AS category,
 CASE p_size % 12 WHEN 1 THEN '#419bdf' WHEN 2 THEN '#397d49' WHEN 5 THEN '#e49635' WHEN 7 THEN '#c4281b' WHEN 8 THEN '#a59b8f' WHEN 11 THEN '#e3e2c3' END AS color FROM part""")
def category_lookup(spark, d):
    p = table(spark, d, "part").withColumn("cls", (F.col("p_size") % 12).cast("string"))
    return curate.labelled(p, "cls").select("p_partkey", "category", "color")


_DATES = f"""
b AS (SELECT o_custkey, quarter(o_orderdate) AS q, min((o_orderdate, o_orderkey)) AS m FROM orders WHERE {Y1997} GROUP BY ALL),
dd AS (SELECT o_custkey AS id, string_agg(strftime(m[1], '%Y%m%d'), ',' ORDER BY q) AS dates FROM b GROUP BY o_custkey)"""


def date_lists(spark, d):
    """Each customer's first order date of each quarter, comma-joined in order."""
    best = scenes.top_per_group(orders(spark, d), ["o_custkey", "q"], [F.asc("t"), F.asc("o_orderkey")])
    days = best.withColumn("day", timefn.day_stamp(F.col("t")))
    return scenes.ids_in_order(days, ["o_custkey"], "q", "day", "dates").withColumnRenamed("o_custkey", "id")


@query(f"""
WITH {_DATES} SELECT id, array_to_string(list_transform(string_split(dates, ','), lambda x: 's2l2a_' || printf('%06d', id) || '_' || x || '.tif'), ',') AS paths,
 array_to_string(list_transform(string_split(dates, ','), lambda x: 'https://thumbs/s2l2a_' || printf('%06d', id) || '_' || x || '.png'), ',') AS thumbs,
 'dem_' || printf('%06d', id) || '.tif' AS dem FROM dd""")
def path_lists(spark, d):
    i, dates = F.col("id"), F.col("dates")
    return date_lists(spark, d).select("id", names.dated_names("s2l2a", i, dates, "tif").alias("paths"), names.dated_names("s2l2a", i, dates, "png", "https://thumbs/").alias("thumbs"), names.plain_name("dem", i).alias("dem"))


@query(f"WITH {_DATES} SELECT id, dates FROM dd WHERE len(string_split(dates, ',')) = 4")
def four_dates_filter(spark, d):
    return date_lists(spark, d).where(names.list_size(F.col("dates")) == 4)


@query(f"""
WITH {_DATES}, n AS (SELECT id AS original_id, (row_number() OVER (ORDER BY id) - 1)::BIGINT AS id, dates FROM dd WHERE len(string_split(dates, ',')) = 4),
s AS (SELECT *, unnest(string_split(dates, ',')) AS day, generate_subscripts(string_split(dates, ','), 1) - 1 AS step FROM n),
x AS (SELECT * FROM s, (VALUES ('tif'), ('png')) e(ext), (VALUES ('s2l2a'), ('s1rtc')) c(src_name))
SELECT src_name || '_' || printf('%06d', original_id) || '_' || step || '_' || day || '.' || ext AS src, src_name || '_' || printf('%06d', id) || '_' || day || '.' || ext AS dst FROM x
UNION ALL SELECT 'dem_' || printf('%06d', original_id) || '.tif', 'dem_' || printf('%06d', id) || '.tif' FROM n""")
def asset_manifest(spark, d):
    held = date_lists(spark, d).where(names.list_size(F.col("dates")) == 4).withColumnRenamed("id", "original_id")
    return curate.asset_manifest(chips.dense_ids(held, "original_id", "id"), dates="dates", sources=("s2l2a", "s1rtc"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (3, 7, 11, 42)")
def include_exclude(spark, d):
    return curate.exclude_include(table(spark, d, "customer"), "c_custkey", [3, 7, 11, 42], [5, 6]).select("c_custkey", "c_name")


@query("SELECT c_custkey FROM customer WHERE c_custkey > (SELECT max(o_custkey) FROM orders WHERE o_custkey % 4 = 1 AND o_totalprice > 150000)")
def resume_filter(spark, d):
    log = table(spark, d, "orders").where("o_custkey % 4 = 1 AND o_totalprice > 150000").withColumnRenamed("o_custkey", "c_custkey")
    return curate.resumable(table(spark, d, "customer").select("c_custkey"), log, "c_custkey")


@query(f"""
SELECT c_custkey, coalesce(s, 'not processed') AS status FROM customer LEFT JOIN
 (SELECT o_custkey, CASE WHEN count(*) > 3 THEN 'success' ELSE 'scenes insufficient' END AS s FROM orders WHERE {Y1997} GROUP BY 1) ON c_custkey = o_custkey""")
def status_upsert(spark, d):
    done = orders(spark, d).groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.when(F.count("*") > 3, "success").otherwise("scenes insufficient").alias("status"))
    return curate.upsert_status(table(spark, d, "customer").select("c_custkey", F.lit("not processed").alias("status")), done, "c_custkey")


# unions, ids and lookups


@query("""
SELECT 'orders' AS collection, o_orderkey AS item, strftime(o_orderdate, '%Y-%m-%d') AS day, o_totalprice AS cloud, NULL::VARCHAR AS event_type FROM orders
UNION ALL BY NAME SELECT 'events' AS collection, event_id AS item, strftime(ts, '%Y-%m-%d') AS day, event_type FROM events""")
def ragged_union(spark, d):
    o = table(spark, d, "orders").select(F.lit("orders").alias("collection"), F.col("o_orderkey").alias("item"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), F.col("o_totalprice").alias("cloud"))
    e = table(spark, d, "events").select(F.lit("events").alias("collection"), F.col("event_id").alias("item"), F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type")
    return scenes.ragged_union(o, e)


@query(f"""
WITH a AS (SELECT o_orderkey, o_custkey, o_orderdate, quarter(o_orderdate)::BIGINT AS q FROM orders WHERE {Y1997}),
j AS (SELECT a.*, l_suppkey, l_quantity, l_partkey FROM a JOIN lineitem ON l_orderkey = o_orderkey AND l_linenumber = 1
  WHERE l_shipdate BETWEEN o_orderdate - INTERVAL 91 DAY AND o_orderdate + INTERVAL 91 DAY),
r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, q ORDER BY l_quantity, o_orderkey, l_suppkey, l_partkey) AS k FROM j)
SELECT o_custkey, string_agg(l_suppkey::VARCHAR, ',' ORDER BY q, k) AS ids FROM r WHERE k <= 50 GROUP BY o_custkey""")
def locked_scene_lookup(spark, d):
    o = orders(spark, d)
    lines = table(spark, d, "lineitem").where("l_linenumber = 1").withColumn("ship", timefn.ts("l_shipdate"))
    near = scenes.within(F.col("ship"), F.col("t") - F.expr("INTERVAL '91' DAY"), F.col("t") + F.expr("INTERVAL '91' DAY"))
    joined = o.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).where(near)
    top = scenes.top_per_group(joined, ["o_custkey", "q"], [F.asc(c) for c in ("l_quantity", "o_orderkey", "l_suppkey", "l_partkey")], 50, "k")
    return scenes.ids_in_order(top, ["o_custkey"], F.struct("q", "k"), "l_suppkey", "ids")


@query(f"""
WITH i AS (SELECT o_custkey, string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderdate, o_orderkey) AS scene_ids FROM orders WHERE {Y1997} GROUP BY 1)
SELECT o_orderkey, o_custkey, scene_ids FROM orders JOIN i USING (o_custkey) WHERE {Y1997}""")
def scene_ids_broadcast(spark, d):
    o = orders(spark, d)
    ids = scenes.ids_in_order(o, ["o_custkey"], F.struct("t", "o_orderkey"), "o_orderkey", "scene_ids")
    return o.join(ids, "o_custkey").select("o_orderkey", "o_custkey", "scene_ids")


# bands, windows and casts


@query("""
WITH p AS (SELECT vec_id, i - 1 AS pos, embedding[i]::DOUBLE AS v FROM embeddings, range(1, 65) r(i))
SELECT vec_id, count(*) = 5 AS complete, sum(round(v * 100000)::BIGINT)::BIGINT AS total FROM p WHERE pos IN (1, 2, 3, 7, 11) GROUP BY vec_id""")
def band_select(spark, d):
    bands = table(spark, d, "embeddings").select("vec_id", F.posexplode("embedding").alias("pos", "v")).select("vec_id", F.col("pos").cast("string").alias("band"), F.col("v").cast("double").alias("v"))
    chosen = raster.select_bands(bands, ["1", "2", "3", "7", "11", "13"], drop="13")
    totals = chosen.groupBy("vec_id").agg(F.sum(whole(F.col("v"))).alias("total"))
    return raster.band_check(chosen, ["vec_id"], 5).join(totals, "vec_id")


@query("""
WITH p AS (SELECT vec_id, (i - 1) // 8 AS y, (i - 1) % 8 AS x, embedding[i]::DOUBLE AS v FROM embeddings, range(1, 65) r(i)),
w AS (SELECT *, CASE WHEN y BETWEEN 2 AND 4 AND x BETWEEN 2 AND 4 THEN v END AS m FROM p WHERE y BETWEEN 1 AND 5 AND x BETWEEN 1 AND 5)
SELECT vec_id, y::BIGINT AS y, x::BIGINT AS x, coalesce(trunc(m * 1000), -999)::BIGINT AS v FROM w""")
def window_extract(spark, d):
    cells = raster.to_pixels(table(spark, d, "embeddings"), "embedding", 8, ["vec_id"])
    y, x, sample, margin = F.col("y"), F.col("x"), 3, 1
    low, high = 2 - margin, 2 + sample + margin - 1
    part = cells.where(y.between(low, high) & x.between(low, high))
    inner = raster.inside_sample(F.col("v").cast("double") * 1000, y, x, 2, sample)
    value = pixels.checked_cast(pixels.filled(inner, True, -999), "smallint")
    return part.select("vec_id", big("y").alias("y"), big("x").alias("x"), value.cast("bigint").alias("v"))


@query("""
SELECT vec_id, max(nullif(CASE WHEN (vec_id + i) % 13 = 0 THEN -999.0 ELSE round(embedding[i]::DOUBLE, 5) END, -999.0)) AS top,
 count(*) FILTER ((vec_id + i) % 13 = 0)::BIGINT AS n_missing FROM embeddings, range(1, 65) r(i) GROUP BY vec_id""")
def nodata_mask(spark, d):
    raw = F.transform("embedding", lambda v, i: F.when((F.col("vec_id") + i + 1) % 13 == 0, F.lit(-999.0)).otherwise(F.round(v.cast("double"), 5)))
    masked = F.transform(raw, lambda v: pixels.without(v, -999.0))
    return table(spark, d, "embeddings").select("vec_id", F.array_max(masked).alias("top"), F.size(F.filter(masked, lambda v: v.isNull())).cast("bigint").alias("n_missing"))


@query("""
WITH v AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_discount / 2 AS vv, l_tax / 8 AS vh FROM lineitem),
n AS (SELECT *, (greatest(least(CASE WHEN vv <= 0 THEN -25 ELSE 10 * log10(vv) END, 0), -25) + 25) / 25 AS r, (greatest(least(CASE WHEN vh <= 0 THEN -30 ELSE 10 * log10(vh) END, -5), -30) + 30) / 25 AS g FROM v)
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_suppkey, round(r, 6) AS r, round(g, 6) AS g, round(r / (g + 1e-6), 4) AS b FROM n""")
def sar_norm(spark, d):
    r, g, b = pixels.radar_rgb(F.col("l_discount") / 2, F.col("l_tax") / 8)
    return table(spark, d, "lineitem").select("l_orderkey", big("l_linenumber").alias("l_linenumber"), "l_partkey", "l_suppkey", F.round(r, 6).alias("r"), F.round(g, 6).alias("g"), F.round(b, 4).alias("b"))


@query("""
WITH p AS (SELECT vec_id, i, embedding[i]::DOUBLE * CASE WHEN vec_id % 2 = 0 THEN 9000 ELSE 1 END AS v FROM embeddings, range(1, 65) r(i)),
m AS (SELECT vec_id, max(v) AS mx FROM p GROUP BY vec_id)
SELECT vec_id, sum(round(greatest(least(CASE WHEN mx > 1 THEN v / 4000 ELSE v * 5 END, 1), 0) * 100000)::BIGINT)::BIGINT AS total FROM p JOIN m USING (vec_id) GROUP BY vec_id""")
def rgb_stretch(spark, d):
    scaled = table(spark, d, "embeddings").select("vec_id", F.transform("embedding", lambda v: v.cast("double") * F.when(F.col("vec_id") % 2 == 0, 9000).otherwise(1)).alias("data")).withColumn("mx", F.array_max("data"))
    unit = F.transform("data", lambda v: pixels.stretch(v, F.col("mx")))
    return scaled.select("vec_id", F.aggregate(unit, F.lit(0).cast("bigint"), lambda a, v: a + whole(v)).alias("total"))


@query("""
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_suppkey, (floor(l_quantity / 10 * 255)::BIGINT % 256)::BIGINT AS b FROM lineitem""")
def to_8bit(spark, d):
    b = pixels.to_byte(F.col("l_quantity") / 10)
    return table(spark, d, "lineitem").select("l_orderkey", big("l_linenumber").alias("l_linenumber"), "l_partkey", "l_suppkey", b.alias("b"))


@query("""
SELECT s_suppkey, coalesce(CASE WHEN s_suppkey % 3 = 0 THEN 32600 + s_suppkey % 60 END, TRY_CAST(split_part(CASE WHEN s_suppkey % 7 = 0 THEN 'EPSG:unknown' ELSE 'EPSG:' || (32700 + s_suppkey % 60) END, ':', 2) AS INT))::BIGINT AS epsg FROM supplier""")
def epsg_parse(spark, d):
    k = F.col("s_suppkey")
    given = F.when(k % 3 == 0, (F.lit(32600) + k % 60).cast("int"))
    code = F.when(k % 7 == 0, F.lit("EPSG:unknown")).otherwise(F.concat(F.lit("EPSG:"), (F.lit(32700) + k % 60).cast("string")))
    return table(spark, d, "supplier").select("s_suppkey", names.epsg_of(given, code).cast("bigint").alias("epsg"))


@query("""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, CASE WHEN length(o_orderkey::VARCHAR) < 3 THEN lpad(o_orderkey::VARCHAR, 3, '0') ELSE o_orderkey::VARCHAR END AS path FROM orders""")
def time_parse(spark, d):
    o = orders(spark, d, None)
    text = F.when(F.col("o_orderkey") % 2 == 0, timefn.iso_seconds(F.col("t"))).otherwise(F.date_format("t", "yyyyMMdd"))
    return o.select("o_orderkey", F.date_format(timefn.parse_time(text), "yyyy-MM-dd").alias("day"), names.padded_path(F.col("o_orderkey")).alias("path"))


@query("""
WITH s AS (SELECT vec_id, (i - 1) // 4 AS y, (i - 1) % 4 AS x FROM embeddings, range(1, 17) r(i))
SELECT s.vec_id, y::BIGINT AS y, x::BIGINT AS x, e.embedding[(2 * y + 1) * 8 + (2 * x + 1) + 1]::DOUBLE AS v FROM s JOIN embeddings e USING (vec_id)""")
def resample_grid(spark, d):
    tiles = table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("data"))
    cells = raster.to_pixels(raster.resample_nearest(tiles, "data", 8, 4), "data", 4, ["vec_id"])
    return cells.select("vec_id", big("y").alias("y"), big("x").alias("x"), "v")


@query("""
SELECT l_suppkey, count(*)::BIGINT AS n, min(l_linenumber)::BIGINT AS first, (min(l_linenumber) = max(l_linenumber)) AS same FROM lineitem GROUP BY l_suppkey ORDER BY l_suppkey LIMIT 10""")
def first_rows(spark, d):
    found = table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("n"), F.min("l_linenumber").cast("bigint").alias("first"), (F.min("l_linenumber") == F.max("l_linenumber")).alias("same"))
    return found.orderBy("l_suppkey").limit(10)


@query("SELECT event_id, user_id, event_type, value, strftime(ts, '%Y-%m-%d') AS day FROM events")
def stac_stream(spark, d):
    """Events as a stream of scenes, appended batch by batch, each once."""
    from ..streaming import incremental

    found = incremental.replay(spark, d.rstrip("/"), "events", "event_id")
    return found.select("event_id", "user_id", "event_type", "value", F.date_format("ts", "yyyy-MM-dd").alias("day"))


# the rules of a search, by their own functions


@query("""
SELECT event_id FROM events WHERE event_id % 10 < 5 AND value < 100
  AND (CASE WHEN user_id % 3 = 0 THEN 'click' END IS NULL OR event_type = 'click')""")
def optical_scenes(spark, d):
    e = table(spark, d, "events").withColumns({"nodata_pct": F.col("event_id") % 10, "cloud": F.col("value"), "mgrs_tile": F.col("event_type")})
    return e.where(scenes.optical_predicate(5, 100, F.when(F.col("user_id") % 3 == 0, F.lit("click")))).select("event_id")


@query("""
SELECT event_id FROM events WHERE event_type IN ('click', 'view') AND value < 50 AND lpad((user_id % 200)::VARCHAR, 3, '0') = lpad((event_id % 200)::VARCHAR, 3, '0')""")
def thermal_scenes(spark, d):
    e = table(spark, d, "events").withColumns({"platform": F.col("event_type"), "cloud": F.col("value"), "wrs_path": F.lpad((F.col("user_id") % 200).cast("string"), 3, "0")})
    return e.where(scenes.thermal_predicate(["click", "view"], 50, F.col("event_id") % 200)).select("event_id")


@query("""
WITH g AS (SELECT l_suppkey, l_linenumber, sum(l_quantity::BIGINT) AS area, min(abs(date_diff('day', DATE '1997-07-01', l_shipdate::DATE))) AS distance FROM lineitem GROUP BY ALL),
o AS (SELECT l_suppkey, l_linenumber FROM g QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY area DESC, distance, l_linenumber) = 1),
h AS (SELECT l.* FROM lineitem l JOIN o USING (l_suppkey, l_linenumber)),
b AS (SELECT l_suppkey, min((abs(date_diff('day', DATE '1997-07-01', l_shipdate::DATE)), l_shipdate))[2]::DATE AS day FROM h GROUP BY l_suppkey)
SELECT h.l_suppkey, strftime(b.day, '%Y-%m-%d') AS day, count(*)::BIGINT AS n FROM h JOIN b ON h.l_suppkey = b.l_suppkey AND h.l_shipdate::DATE = b.day GROUP BY ALL""")
def orbit_dates(spark, d):
    """Rows of the locked orbit only, on its date nearest to a centre."""
    lines = table(spark, d, "lineitem").withColumn("distance", F.abs(F.datediff(F.to_date("l_shipdate"), F.lit("1997-07-01").cast("date"))))
    orbit = scenes.locked_orbit(lines, "l_suppkey", "l_linenumber", F.sum(big("l_quantity")), F.min("distance")).select("l_suppkey", "l_linenumber")
    best = scenes.best_date_rows(lines.join(orbit, ["l_suppkey", "l_linenumber"]), ["l_suppkey"], "l_shipdate", ["distance", "l_shipdate"])
    return best.groupBy("l_suppkey", F.date_format("l_shipdate", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("n"))


@query("""
WITH c AS (SELECT c_custkey, count(DISTINCT quarter(o_orderdate)) AS seasons, count(o_orderkey) AS n, count(*) FILTER (o_orderpriority < '3') AS s1, count(*) FILTER (o_orderpriority >= '3') AS lc,
  count(DISTINCT o_orderdate::DATE) FILTER (o_orderpriority >= '3') AS lcd, count(DISTINCT o_orderdate::DATE) FILTER (o_orderpriority < '3') AS s1d, count(*) FILTER (o_totalprice > 150000) AS lu, count(*) FILTER (o_totalprice < 150000) AS de
  FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1)
SELECT c_custkey, CASE WHEN seasons < 1 THEN 's2l2a scenes missing' WHEN n < 4 THEN 's2l2a scenes insufficient' WHEN s1 < 1 THEN 's1rtc scenes missing' WHEN lc < 1 THEN 'lc2l2 scenes missing'
  WHEN lcd < 4 THEN 'lc2l2 dates insufficient' WHEN s1d < 4 THEN 's1rtc dates insufficient' WHEN lu < 1 THEN 'lulc scenes missing' WHEN de < 1 THEN 'dem scenes missing' ELSE 'success' END AS status FROM c""")
def area_statuses(spark, d):
    o = orders(spark, d, None).withColumn("day", F.to_date("t"))
    low = F.col("o_orderpriority") < "3"
    counts = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count_distinct("q").alias("n_s2l2a_seasons"), F.count("*").alias("n_s2l2a"), F.count_if(low).alias("n_s1rtc"), F.count_if(~low).alias("n_lc2l2"),
        F.count_distinct(F.when(~low, F.col("day"))).alias("n_lc2l2_dates"), F.count_distinct(F.when(low, F.col("day"))).alias("n_s1rtc_dates"),
        F.count_if(F.col("o_totalprice") > 150000).alias("n_lulc"), F.count_if(F.col("o_totalprice") < 150000).alias("n_dem"),
    )
    joined = table(spark, d, "customer").select("c_custkey").join(counts, "c_custkey", "left")
    return scenes.area_status(joined, 4).select("c_custkey", "status")


@query(f"""
WITH {_DATES} SELECT id, (id % 13)::BIGINT AS lulc FROM dd WHERE id % 4 <> 0 AND id % 13 IN (1, 2, 5, 7, 8, 11) AND len(string_split(dates, ',')) = 4""")
def releasable_rows(spark, d):
    log = date_lists(spark, d).select("id", (F.col("id") % 13).alias("lulc"), F.when(F.col("id") % 4 == 0, "dem missing values").otherwise("success").alias("status"), *[F.col("dates").alias(f"{s}_dates") for s in ("s2l2a", "s1rtc", "lc2l2")])
    return curate.releasable(log).select("id", "lulc")


_CONFIG = """
dataset: {version: v1}
aoi: {version: v1}
directory: {working: w, output: o}
s2l2a: {collection: s2, time_ranges: [1996-01-01/1996-03-31, 1996-04-01/1996-06-30, 1996-07-01/1996-09-30, 1996-10-01/1996-12-31], cloud_cover: 30, nodata_pixel_percentage: 5, bands: [B01], cloud_band: SCL, resolution: 10, native_crs: true, fill_na: false, na_value: -999, dtype: int16}
s1rtc: {collection: s1, delta_days: 12, nodata_pixel_percentage: 5, bands: [vv, vh], resolution: 10, native_crs: false, fill_na: false, na_value: -999, dtype: float32}
lc2l2: {collection: l8, delta_days: 91, platforms: [a], cloud_cover: 50, bands: [red], cloud_band: qa_pixel, resolution: 30, native_crs: false, fill_na: false, na_value: -999, dtype: float32}
dem: {collection: dem, year: 1996-01-02/1996-12-31, resolution: 30, native_crs: false, fill_na: false, na_value: -999, dtype: float32}
lulc: {collection: lulc, year: 1996-01-02/1996-12-31, resolution: 10, native_crs: false, fill_na: false, na_value: 0, dtype: int8}
chips: {sample_size: 960, chip_size: 960}
"""


@query("""
WITH s AS (SELECT * FROM (VALUES (0, TIMESTAMP '1996-01-01', TIMESTAMP '1996-03-31 23:59:59'), (1, TIMESTAMP '1996-04-01', TIMESTAMP '1996-06-30 23:59:59'), (2, TIMESTAMP '1996-07-01', TIMESTAMP '1996-09-30 23:59:59'), (3, TIMESTAMP '1996-10-01', TIMESTAMP '1996-12-31 23:59:59')) v(season_idx, a, b))
SELECT season_idx::BIGINT AS season_idx, o_custkey, count(*)::BIGINT AS n FROM orders JOIN s ON o_orderdate BETWEEN a AND b GROUP BY ALL""")
def season_scenes(spark, d):
    """Seasons as the configuration gives them, to scenes."""
    from ..config import RunConfig
    from ..schemas import SEASON

    seasons = RunConfig.from_text(_CONFIG).s2l2a.seasons()
    joined = orders(spark, d, None).join(F.broadcast(spark.createDataFrame(seasons, SEASON)), scenes.within(F.col("t"), F.col("range_start"), F.col("range_end")))
    return joined.groupBy(big("season_idx").alias("season_idx"), "o_custkey").agg(F.count("*").alias("n"))


@query("""
SELECT resolution::BIGINT AS resolution, (960 // resolution)::BIGINT AS sample, (1280 // resolution)::BIGINT AS chip, ((1280 // resolution - 960 // resolution) // 2)::BIGINT AS margin
FROM (SELECT n_nationkey + 10 AS resolution FROM nation)""")
def chip_sizes(spark, d):
    from ..config import Chips

    sizes = Chips(960, 1280)
    known = spark.createDataFrame([(r, *sizes.pixels(r)) for r in range(1, 121)], "resolution bigint, sample bigint, chip bigint, margin bigint")
    return table(spark, d, "nation").select((F.col("n_nationkey") + 10).cast("bigint").alias("resolution")).join(F.broadcast(known), "resolution")


# masks, composites and margins of whole blocks


def _blocks(spark, d):
    """Embeddings as blocks of 64 whole values with a time each, so that sums are the same in any order; values below 0 are missing."""
    t = F.lit("2023-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(hours=(F.col("vec_id") * 7).cast("int"))
    data = F.transform("embedding", lambda v: F.when(v >= 0, F.round(v.cast("double") * 100000)))
    return table(spark, d, "embeddings").select("vec_id", "label", t.alias("t"), data.alias("data"))


_BLOCK_PIXELS = """
b AS (SELECT vec_id, label, TIMESTAMP '2023-01-01' + to_hours((vec_id * 7)::INT) AS t, i, CASE WHEN embedding[i] >= 0 THEN round(embedding[i]::DOUBLE * 100000) END AS v FROM embeddings, range(1, 65) r(i))"""


@query(f"""
WITH {_BLOCK_PIXELS}, m AS (SELECT vec_id, count(v) FILTER (vec_id % 5 <> 0 AND (vec_id + i) % 12 IN (2, 4, 5, 6, 11))::BIGINT AS n_class,
  count(v) FILTER (vec_id % 5 <> 0 AND ((vec_id + i) % 64 & 30) = 0)::BIGINT AS n_bits,
  coalesce(sum(v) FILTER (vec_id % 5 <> 0 AND (vec_id + i) % 12 IN (2, 4, 5, 6, 11)), 0)::BIGINT AS total FROM b GROUP BY vec_id)
SELECT * FROM m""")
def masked_blocks(spark, d):
    blocks = _blocks(spark, d)
    numbers = F.sequence(F.lit(1), F.lit(64))
    some = blocks.where("vec_id % 5 <> 0")
    by_class = raster.mask_blocks(blocks, some.select("vec_id", F.transform(numbers, lambda i: ((F.col("vec_id") + i) % 12).cast("double")).alias("data")), ["vec_id"], "class")
    by_bits = raster.mask_blocks(blocks, some.select("vec_id", F.transform(numbers, lambda i: ((F.col("vec_id") + i) % 64).cast("double")).alias("data")), ["vec_id"], "bits")
    count = lambda c: F.size(F.filter(c, lambda v: v.isNotNull())).cast("bigint")
    total = F.aggregate("data", F.lit(0.0), lambda a, v: a + F.coalesce(v, F.lit(0.0))).cast("bigint")
    return by_class.select("vec_id", count("data").alias("n_class"), total.alias("total")).join(by_bits.select("vec_id", count("data").alias("n_bits")), "vec_id").select("vec_id", "n_class", "n_bits", "total")


@query(f"""
WITH {_BLOCK_PIXELS}, p AS (SELECT label, quarter(t) AS q, i, arg_min(v, t) FILTER (v IS NOT NULL) AS v FROM b GROUP BY ALL),
s AS (SELECT label, q, count(v)::BIGINT AS n, coalesce(sum(v), 0)::BIGINT AS total FROM p GROUP BY ALL),
d AS (SELECT label, quarter(t) AS q, strftime(min(t), '%Y-%m-%d %H') AS first FROM b GROUP BY ALL)
SELECT s.label::BIGINT AS label, first, n, total FROM s JOIN d USING (label, q)""")
def composed_blocks(spark, d):
    made = raster.composite_blocks(_blocks(spark, d), ["label"])
    total = F.aggregate("data", F.lit(0.0), lambda a, v: a + F.coalesce(v, F.lit(0.0))).cast("bigint")
    return made.select(big("label").alias("label"), F.date_format("t", "yyyy-MM-dd HH").alias("first"), F.size(F.filter("data", lambda v: v.isNotNull())).cast("bigint").alias("n"), total.alias("total"))


@query(f"""
WITH {_BLOCK_PIXELS}, p AS (SELECT label, i, avg(v) AS v FROM b GROUP BY ALL) SELECT label::BIGINT AS label, i::BIGINT AS place, floor(v * 8)::BIGINT AS v FROM p""")
def mean_blocks(spark, d):
    made = raster.mean_blocks(_blocks(spark, d), ["label"])
    cells = made.select(big("label").alias("label"), F.posexplode("data").alias("place", "v"))
    return cells.select("label", (F.col("place") + 1).cast("bigint").alias("place"), F.floor(F.col("v") * 8).alias("v"))


@query("""
WITH k AS (SELECT vec_id, embedding, k - 1 AS pos, (k - 1) // 6 AS y, (k - 1) % 6 AS x FROM embeddings, range(1, 37) r(k))
SELECT vec_id, pos::BIGINT AS pos, CASE WHEN y BETWEEN 1 AND 4 AND x BETWEEN 1 AND 4 THEN round(embedding[(y - 1) * 4 + x]::DOUBLE, 5) END AS v FROM k""")
def chip_margins(spark, d):
    data = F.transform(F.slice("embedding", 1, 16), lambda v: F.round(v.cast("double"), 5))
    return table(spark, d, "embeddings").select("vec_id", F.posexplode(raster.with_margin(data, 4, 1)).alias("pos", "v")).select("vec_id", big("pos").alias("pos"), "v")


# polygons


def _box_wkt(x0, y0, x1, y1):
    corners = ((x1, y0), (x1, y1), (x0, y1), (x0, y0), (x1, y0))
    return F.concat(F.lit("POLYGON (("), F.concat_ws(", ", *[F.concat_ws(" ", a.cast("double").cast("string"), b.cast("double").cast("string")) for a, b in corners]), F.lit("))"))


@query(f"WITH b AS (SELECT c_custkey, {_LONLAT} FROM customer) SELECT c_custkey, minx::DOUBLE AS minx, miny::DOUBLE AS miny, (minx + 1)::DOUBLE AS maxx, (miny + 1)::DOUBLE AS maxy, (c_custkey % 9 <> 0) AS valid FROM b WHERE c_custkey % 9 <> 0 UNION ALL SELECT c_custkey, NULL, NULL, NULL, NULL, false FROM b WHERE c_custkey % 9 = 0")
def wkt_boxes(spark, d):
    """Polygons read from text; every ninth text is malformed."""
    from ..operators import geometry

    b = F.col("box")
    text = F.when(F.col("c_custkey") % 9 == 0, F.lit("POLYGON ((1 x, 2 y))")).otherwise(_box_wkt(b["minx"], b["miny"], b["maxx"], b["maxy"]))
    found = dealt(_customer_boxes(spark, d), "c_custkey").withColumn("wkt", text).select("c_custkey", geometry.wkt_box("wkt").alias("found"), geometry.well_formed("wkt").alias("valid"))
    return found.select("c_custkey", *[F.col(f"found.{c}").alias(c) for c in ("minx", "miny", "maxx", "maxy")], "valid")


@query("""
SELECT c_custkey, ((c_custkey % 6) + ((c_custkey // 6) % 6) < 4) AS meets FROM customer""")
def polygon_meeting(spark, d):
    """A triangle and a box: the box meets it where its lower left corner lies below the long side."""
    from ..operators import geometry

    k = F.col("c_custkey")
    x, y = (k % 6).cast("double"), (F.floor(k / 6) % 6).cast("double")
    triangle = F.lit("POLYGON ((0 0, 4 0, 0 4, 0 0))")
    return dealt(table(spark, d, "customer").select("c_custkey"), "c_custkey").select("c_custkey", geometry.polygons_meet(triangle, _box_wkt(x, y, x + 1, y + 1)).alias("meets"))


@query("""
WITH s AS (SELECT s_suppkey, (s_suppkey * 17 % 300) - 150.0 AS x, (s_suppkey * 29 % 100) - 50.0 AS y FROM supplier),
m AS (SELECT s_suppkey, radians(1.0) * 6378137.0 AS deg, ln(tan(pi() / 4 + radians(y) / 2)) * 6378137.0 AS y0, ln(tan(pi() / 4 + radians(y + 1) / 2)) * 6378137.0 AS y1,
  ln(tan(pi() / 4 + radians(y + 2) / 2)) * 6378137.0 AS y2, ln(tan(pi() / 4 + radians(y + 3) / 2)) * 6378137.0 AS y3 FROM s)
SELECT s_suppkey, round((1.5 * (y2 - y0) + 1.5 * (y3 - y1) - (y2 - y1)) * deg / 1e6, 1) AS km2 FROM m""")
def union_overlap(spark, d):
    """Area in EPSG:3857 of what the union of two boxes has in common with a third."""
    from ..operators import geometry

    k = F.col("s_suppkey")
    x, y = k * 17 % 300 - 150.0, k * 29 % 100 - 50.0
    both = F.array(_box_wkt(x, y, x + 2, y + 2), _box_wkt(x + 1, y + 1, x + 3, y + 3))
    area = geometry.mercator_overlap_area(both, _box_wkt(x + 0.5, y, x + 2.5, y + 3))
    return dealt(table(spark, d, "supplier").select("s_suppkey"), "s_suppkey").select("s_suppkey", F.round(area / 1e6, 1).alias("km2"))


@query("""
WITH b AS (SELECT c_nationkey, c_mktsegment, (c_custkey % 7) * 0.5 AS x0, 10 + (c_custkey % 5) * 0.5 AS x1 FROM customer WHERE c_mktsegment <> 'MACHINERY'),
u AS (SELECT c_nationkey, c_mktsegment, min(x0) AS x0, max(x1) AS x1 FROM b GROUP BY ALL)
SELECT c_nationkey::BIGINT AS c_nationkey, max(x0)::DOUBLE AS minx, 0.0::DOUBLE AS miny, min(x1)::DOUBLE AS maxx, 5.0::DOUBLE AS maxy FROM u GROUP BY c_nationkey""")
def common_footprints(spark, d):
    """Each nation's segments are unions of polygons; their common bounds. A null segment constrains nothing."""
    from ..operators import geometry

    k = F.col("c_custkey")
    rows = table(spark, d, "customer").select("c_nationkey", F.nullif("c_mktsegment", F.lit("MACHINERY")).alias("segment"), _box_wkt((k % 7) * 0.5, F.lit(0), (k % 5) * 0.5 + 10, F.lit(5)).alias("g"))
    found = geometry.common_footprint(rows.distinct(), "c_nationkey", ["segment"], "g")
    return found.select(big("c_nationkey").alias("c_nationkey"), "minx", "miny", "maxx", "maxy")


def _turned_square(x, y, r, hole):
    """A square on its corner, whose edges run along whole values of x + y and x - y, with a hole of radius 1 where asked for."""
    ring = lambda r: F.concat(F.lit("("), F.concat_ws(", ", *[F.concat_ws(" ", a.cast("double").cast("string"), b.cast("double").cast("string")) for a, b in ((x - r, y), (x, y - r), (x + r, y), (x, y + r), (x - r, y))]), F.lit(")"))
    return F.concat(F.lit("POLYGON ("), ring(r), F.when(hole, F.concat(F.lit(", "), ring(F.lit(1)))).otherwise(F.lit("")), F.lit(")"))


_TURNED_CELLS = """
c AS (SELECT c_nationkey, c_mktsegment, c_custkey AS k, (c_custkey * 7 % {w}) + (c_custkey * 11 % {h}) AS cu, (c_custkey * 7 % {w}) - (c_custkey * 11 % {h}) AS cv, {r} + c_custkey % 3 AS r FROM customer),
us AS (SELECT *, unnest(range(cu - r, cu + r)) AS u FROM c), uv AS (SELECT *, unnest(range(cv - r, cv + r)) AS v FROM us),
cells AS (SELECT DISTINCT c_nationkey, c_mktsegment, u, v FROM uv WHERE NOT (k % 2 = 0 AND u BETWEEN cu - 1 AND cu AND v BETWEEN cv - 1 AND cv))"""


def _turned(spark, d, w, h, r):
    k = F.col("c_custkey")
    return table(spark, d, "customer").select(big("c_nationkey").alias("c_nationkey"), "c_mktsegment", _turned_square(k * 7 % w, k * 11 % h, F.lit(r) + k % 3, k % 2 == 0).alias("g"))


@query(f"""
WITH {_TURNED_CELLS.format(w=61, h=53, r=2)}, n AS (SELECT DISTINCT c_nationkey, u, v FROM cells)
SELECT c_nationkey::BIGINT AS c_nationkey, count(*)::BIGINT AS half_cells, min(u + v) / 2.0::DOUBLE AS minx, min(u - v - 1) / 2.0::DOUBLE AS miny, max(u + v + 2) / 2.0::DOUBLE AS maxx, max(u - v + 1) / 2.0::DOUBLE AS maxy FROM n GROUP BY c_nationkey""")
def dissolved_footprints(spark, d):
    """Each nation's squares on their corners, half of them with a hole, as one geometry: its area and bounds."""
    from ..operators import geometry

    found = geometry.dissolved(_turned(spark, d, 61, 53, 2), ["c_nationkey"], "g").withColumn("b", geometry.wkt_box("g"))
    return found.select("c_nationkey", F.round(geometry.areas("g") * 2).cast("bigint").alias("half_cells"), *[F.round(f"b.{c}", 6).alias(c) for c in ("minx", "miny", "maxx", "maxy")])


@query(f"""
WITH {_TURNED_CELLS.format(w=9, h=8, r=4)}, n AS (SELECT c_nationkey, count(DISTINCT c_mktsegment) AS n FROM customer GROUP BY 1),
x AS (SELECT c_nationkey, u, v FROM cells JOIN n USING (c_nationkey) GROUP BY c_nationkey, u, v, n HAVING count(*) = n)
SELECT n.c_nationkey::BIGINT AS c_nationkey, count(u)::BIGINT AS half_cells, min(u + v) / 2.0::DOUBLE AS minx, min(u - v - 1) / 2.0::DOUBLE AS miny, max(u + v + 2) / 2.0::DOUBLE AS maxx, max(u - v + 1) / 2.0::DOUBLE AS maxy
FROM n LEFT JOIN x ON n.c_nationkey = x.c_nationkey GROUP BY n.c_nationkey""")
def common_geometries(spark, d):
    """What the unions of all of a nation's segments have in common: area, without holes, and bounds."""
    from ..operators import geometry

    united = geometry.dissolved(_turned(spark, d, 9, 8, 4), ["c_nationkey", "c_mktsegment"], "g")
    found = geometry.common_geometry(united, "c_nationkey", "g").withColumn("b", geometry.wkt_box("g"))
    return found.select("c_nationkey", F.round(geometry.areas("g") * 2).cast("bigint").alias("half_cells"), *[F.round(f"b.{c}", 6).alias(c) for c in ("minx", "miny", "maxx", "maxy")])


@query("""
SELECT s_suppkey, round((x + x + 6 + x) / 3, 6) AS lon, round((y + y + y + 3) / 3, 6) AS lat FROM (SELECT s_suppkey, (s_suppkey * 17 % 300) - 150.0 AS x, (s_suppkey * 29 % 100) - 50.0 AS y FROM supplier)""")
def polygon_centroids(spark, d):
    from ..operators import geometry

    k = F.col("s_suppkey")
    x, y = (k * 17 % 300 - 150.0).cast("double"), (k * 29 % 100 - 50.0).cast("double")
    point = lambda a, b: F.concat_ws(" ", a.cast("string"), b.cast("string"))
    text = F.concat(F.lit("POLYGON (("), F.concat_ws(", ", point(x, y), point(x + 6, y), point(x, y + 3), point(x, y)), F.lit("))"))
    at = dealt(table(spark, d, "supplier").select("s_suppkey"), "s_suppkey").select("s_suppkey", geometry.centroids(text).alias("c"))
    return at.select("s_suppkey", F.round("c.lon", 6).alias("lon"), F.round("c.lat", 6).alias("lat"))


@query(_UTM.replace("x + 480 AS e, y + 480 AS n", "x + 960 AS e, y AS n"))
def footprint_corner(spark, d):
    """The first corner of the footprint text, its lower right."""
    k = F.col("s_suppkey")
    epsg = (F.lit(32601) + k % 60).cast("int")
    x, y = F.lit(400000.0) + k * 7919 % 200000, F.lit(1000000.0) + k * 104729 % 5000000
    box = F.struct(x.alias("minx"), y.alias("miny"), (x + 960).alias("maxx"), (y + 960).alias("maxy"))
    corner = F.split(F.regexp_extract(geo.footprint_wkt(box, epsg), r"\(\(([^,]*),", 1), " ")
    return table(spark, d, "supplier").select("s_suppkey", F.round(F.get(corner, 0).cast("double"), 6).alias("lon"), F.round(F.get(corner, 1).cast("double"), 6).alias("lat"))


# files: written to the shared folder and read back


def _folder(spark, name: str) -> str:
    """A new folder's path; without a scheme where it is local, for the writers that need a file system."""
    import uuid

    from ..session import shared_folder

    path = f"{shared_folder(spark)}/landweave/{name}-{uuid.uuid4().hex}"
    return path.removeprefix("file://") if path.startswith("file:///") else path


def _uri(path: str) -> str:
    """The path as Spark's own readers and writers take it, whatever the default file system is."""
    return f"file://{path}" if path.startswith("/") else path


@query("""
SELECT s_suppkey AS aoi_index, ((s_suppkey * 17 % 340) - 170.0)::DOUBLE AS minx, ((s_suppkey * 29 % 140) - 69.0)::DOUBLE AS maxy, CASE WHEN s_suppkey % 3 = 0 THEN 'success' ELSE 'not processed' END AS status FROM supplier""")
def geojson_areas(spark, d):
    """Areas as one feature collection, written and read."""
    import os

    from ..sources import geojson

    k = F.col("s_suppkey")
    x, y = k * 17 % 340 - 170.0, k * 29 % 140 - 70.0
    areas = table(spark, d, "supplier").select(k.alias("aoi_index"), _box_wkt(x, y, x + 1, y + 1).alias("geom"), F.when(k % 3 == 0, "success").otherwise("not processed").alias("status"))
    path = _folder(spark, "areas")
    os.makedirs(path, exist_ok=True)
    geojson.write_collection(areas, "geom", f"{path}/aois.geojson")
    return geojson.read_areas(spark, f"{_uri(path)}/aois.geojson").select("aoi_index", F.col("bbox.minx").alias("minx"), F.col("bbox.maxy").alias("maxy"), "status")


@query(f"""
WITH b AS (SELECT c_custkey, c_nationkey, {_LONLAT} FROM customer) SELECT c_custkey, c_nationkey::BIGINT AS nation, round(minx + 0.5, 6)::DOUBLE AS lon, round(miny + 0.5, 6)::DOUBLE AS lat FROM b""")
def geojson_parts(spark, d):
    """Footprints as features in parts, a partition a nation."""
    from ..operators import geometry
    from ..sources import geojson

    b = F.col("box")
    boxes = _customer_boxes(spark, d).join(table(spark, d, "customer").select("c_custkey", big("c_nationkey").alias("nation")), "c_custkey")
    path = _folder(spark, "features")
    geojson.write_features(boxes.select("c_custkey", "nation", _box_wkt(b["minx"], b["miny"], b["maxx"], b["maxy"]).alias("geom")), "geom", path, "nation")
    found = dealt(geojson.read_features(spark, path, "c_custkey bigint, nation bigint"), "c_custkey").withColumn("c", geometry.centroids("geom"))
    return found.select("c_custkey", "nation", F.round("c.lon", 6).alias("lon"), F.round("c.lat", 6).alias("lat"))


@query(f"""
WITH {_DATES} SELECT id AS chip_index, dates AS s2l2a_dates, '[]' AS s1rtc_dates, (id % 13)::INT::BIGINT AS lulc, CASE WHEN id % 2 = 0 THEN 'success' ELSE 'status "' || id || '", quoted' END AS status FROM dd""")
def chip_log_rows(spark, d):
    """A chip log written in two appends and read with its schema."""
    from ..sources import chiplog

    rows = date_lists(spark, d).select("id", "dates")
    i = F.col("id")
    text = lambda v: F.lit(v).cast("string")
    log = rows.select(
        i.alias("chip_index"), (i % 5).alias("aoi_index"), F.col("dates").alias("s2l2a_dates"), F.array().cast("array<string>").alias("s1rtc_dates"), text("[]").alias("lc2l2_dates"), (i % 13).cast("int").alias("lulc"),
        text(None).alias("chip_footprint"), F.lit(32632).alias("epsg"), F.when(i % 2 == 0, "success").otherwise(F.concat(F.lit('status "'), i.cast("string"), F.lit('", quoted'))).alias("status"),
        *[text("a,b").alias(c) for c in ("s2l2a_scene_ids", "s1rtc_scene_ids", "lc2l2_scene_ids", "lulc_scene_ids", "dem_scene_ids")],
    )
    path = _folder(spark, "chip-log")
    chiplog.write_log(log.where(i % 3 == 0), path)
    chiplog.write_log(log.where(i % 3 != 0), path)
    return chiplog.read_log(spark, path).select("chip_index", "s2l2a_dates", "s1rtc_dates", big("lulc").alias("lulc"), "status")


@query("""
SELECT 'e' || event_id AS item_id, event_type AS collection, value AS cloud, (user_id % 60)::BIGINT AS rel_orbit FROM events
WHERE event_type = 'click' AND value < 200 AND ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20'""")
def scene_items(spark, d):
    """Items as JSON files, searched through the data source that prunes while it reads."""
    from ..sources import scene_catalog

    e = table(spark, d, "events")
    properties = F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("datetime"), F.col("value").alias("eo:cloud_cover"), (F.col("user_id") % 60).cast("int").alias("sat:relative_orbit"))
    path = _folder(spark, "items")
    e.select(F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("id"), F.col("event_type").alias("collection"), F.array(*map(F.lit, (0.0, 0.0, 1.0, 1.0))).alias("bbox"), properties.alias("properties")).write.json(_uri(path))
    scenes_in = scene_catalog.read_scenes(spark, path)
    start, end = (F.lit(x).cast("timestamp") for x in ("2024-01-05", "2024-01-20"))
    found = scene_catalog.search(scenes_in, "click", start, end, F.col("cloud") < 200)
    return found.select("item_id", "collection", "cloud", big("rel_orbit").alias("rel_orbit"))


@query("""
WITH p AS (SELECT vec_id, (i - 1) // 8 AS y, (i - 1) % 8 AS x, embedding[i] AS v FROM embeddings, range(1, 65) r(i))
SELECT vec_id AS aoi_index, (y // 4)::BIGINT AS wy, (x // 4)::BIGINT AS wx, sum(round(v::DOUBLE * 100000)::BIGINT)::BIGINT AS total FROM p GROUP BY ALL""")
def geotiff_blocks(spark, d):
    """Tiles as GeoTIFF files, read back as blocks of 4 x 4."""
    from ..session import ship
    from ..sources import images, rasters

    ship(spark)
    tiles = table(spark, d, "embeddings").select(
        F.concat(F.lit("dem_"), F.col("vec_id").cast("string"), F.lit(".tif")).alias("name"), F.array(F.col("embedding").cast("array<double>")).alias("data"), F.lit(8).alias("n"), F.lit("float32").alias("dtype"),
        F.lit(32632).alias("epsg"), F.lit(0.0).alias("minx"), F.lit(0.0).alias("maxy"), F.lit(10.0).alias("resolution"), "vec_id",
    )
    path = _folder(spark, "tiles")
    images.write_images(images.encode_chips(tiles.drop("vec_id"), "tif"), path).count()
    manifest = tiles.select(F.col("name").alias("path"), F.col("vec_id").alias("aoi_index"), F.lit("dem").alias("source"), F.lit("2023-01-01").cast("timestamp").alias("t"), F.array(F.lit("elevation")).alias("bands"), F.lit(4).alias("n"))
    total = F.aggregate("data", F.lit(0).cast("bigint"), lambda a, v: a + whole(v))
    return rasters.read_blocks(manifest, _uri(path)).select("aoi_index", big("wy").alias("wy"), big("wx").alias("wx"), total.alias("total"))


_MOSAIC = """
p AS (SELECT (vec_id // 16)::BIGINT AS m, (vec_id % 16 // 4) * 8 + (i - 1) // 8 AS y, (vec_id % 16 % 4) * 8 + (i - 1) % 8 AS x, round(embedding[i]::DOUBLE * 1000)::BIGINT AS v FROM embeddings, range(1, 65) r(i))"""


def _mosaic_files(spark, d, epsg: int, minx: float, maxy: float, step: float) -> tuple[DataFrame, str]:
    """Sixteen tiles each as one file of 32 x 32 pixels, in deflated tiles of 16; what is missing is -999. The manifest and the folder."""
    from ..session import ship
    from ..sources import images

    ship(spark)
    k = F.col("vec_id") % 16
    cells = table(spark, d, "embeddings").select(F.floor(F.col("vec_id") / 16).cast("bigint").alias("m"), k.alias("k"), F.posexplode("embedding").alias("pos", "v"))
    placed = cells.select("m", (F.floor(F.col("k") / 4) * 8 + F.floor(F.col("pos") / 8)).alias("y"), (F.col("k") % 4 * 8 + F.col("pos") % 8).alias("x"), F.round(F.col("v").cast("double") * 1000).alias("v"))
    whole = raster.to_blocks(placed, ["m"], "v", 32)
    name = F.concat(F.lit("m"), F.col("m").cast("string"), F.lit(".tif"))
    data = F.array(F.transform("data", lambda v: F.coalesce(v, F.lit(-999.0))))
    tiles = whole.select(name.alias("name"), data.alias("data"), F.lit(32).alias("n"), F.lit("int16").alias("dtype"), F.lit(epsg).alias("epsg"), F.lit(minx).alias("minx"), F.lit(maxy).alias("maxy"), F.lit(step).alias("resolution"))
    path = _folder(spark, "mosaics")
    images.write_images(images.encode_chips(dealt(tiles, "name"), "tif", tile=16, nodata=-999), path).count()
    mosaics = table(spark, d, "embeddings").select(F.floor(F.col("vec_id") / 16).cast("bigint").alias("m")).distinct()  # without the pixels, as the manifest is read several times
    return mosaics.select(name.alias("path"), F.col("m").alias("aoi_index"), F.lit("dem").alias("source"), F.lit("2023-01-01").cast("timestamp").alias("t"), F.array(F.lit("elevation")).alias("bands"), F.lit(12).alias("n")), path


def _block_sums(blocks: DataFrame) -> DataFrame:
    some = F.filter("data", lambda v: v.isNotNull())
    total = F.aggregate(some, F.lit(0).cast("bigint"), lambda a, v: a + v.cast("bigint"))
    return blocks.select("aoi_index", big("wy").alias("wy"), big("wx").alias("wx"), F.size(some).cast("bigint").alias("n"), total.alias("total")).where("n > 0")


@query(f"""
WITH {_MOSAIC} SELECT m AS aoi_index, (y // 12)::BIGINT AS wy, (x // 12)::BIGINT AS wx, count(*)::BIGINT AS n, sum(v)::BIGINT AS total FROM p WHERE y < 24 AND x < 24 GROUP BY ALL""")
def tiled_blocks(spark, d):
    """Tiled and compressed files, read by the byte ranges of their tiles into windows that the tiles' edges cut."""
    from ..sources import rasters

    manifest, path = _mosaic_files(spark, d, 32632, 500000.0, 5300000.0, 10.0)
    return _block_sums(rasters.read_blocks(manifest, path))


#: The corner of a grid in EPSG:3857 near 10 degrees east and 50 north, and the width of its windows of 6 x 6 pixels.
_CORNER_X, _CORNER_Y, _SIDE = 1114195.2079327, 6445375.4149121, 10200.0


@query(f"""
WITH {_MOSAIC}, t AS (SELECT wy, wx, {_CORNER_X} + wx * {_SIDE} + (j + 0.5) * {_SIDE / 6} AS tx, {_CORNER_Y} - wy * {_SIDE} - (i + 0.5) * {_SIDE / 6} AS ty FROM range(3) a(wy), range(3) b(wx), range(6) c(i), range(6) e(j)),
s AS (SELECT wy, wx, floor((degrees(tx / 6378137.0) - 10.0) / 0.01)::BIGINT AS x, floor((50.0 - degrees(2 * atan(exp(ty / 6378137.0)) - pi() / 2)) / 0.01)::BIGINT AS y FROM t)
SELECT m AS aoi_index, wy::BIGINT AS wy, wx::BIGINT AS wx, count(*)::BIGINT AS n, sum(v)::BIGINT AS total FROM s JOIN p USING (x, y) GROUP BY ALL""")
def warped_blocks(spark, d):
    """Files in degrees onto a grid in metres of EPSG:3857: each pixel from the source pixel that it lies in."""
    from ..sources import rasters

    manifest, path = _mosaic_files(spark, d, 4326, 10.0, 50.0, 0.01)
    values = (("epsg", 3857), ("minx", _CORNER_X), ("maxy", _CORNER_Y), ("side", _SIDE), ("n", 6), ("rows", 3), ("cols", 3))
    grid = F.struct(*[F.lit(v).alias(c) for c, v in values]).cast(rasters.GRID)
    return _block_sums(rasters.put_together(rasters.read_parts(rasters.tile_table(manifest, path).withColumn("grid", grid), path)))


@query("""
WITH p AS (SELECT vec_id, band, floor(greatest(least(embedding[i]::DOUBLE * 4 * (band + 1), 1), 0) * 255)::BIGINT AS b FROM embeddings, range(1, 65) r(i), range(3) s(band))
SELECT vec_id, band::BIGINT AS band, sum(b)::BIGINT AS total FROM p GROUP BY ALL""")
def thumbnail_files(spark, d):
    """Thumbnails as PNG files, read by Spark's binary source and decoded."""
    from ..session import ship
    from ..sources import images

    ship(spark)
    plane = lambda k: F.transform("embedding", lambda v: pixels.to_byte(pixels.clip(v.cast("double") * 4 * (k + 1), 0, 1)))
    thumbs = table(spark, d, "embeddings").select(F.concat(F.lit("t_"), F.col("vec_id").cast("string"), F.lit(".png")).alias("name"), F.array(plane(0), plane(1), plane(2)).alias("data"), F.lit(8).alias("n"))
    path = _folder(spark, "thumbs")
    images.write_images(images.encode_chips(thumbs, "png"), path).count()
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.png").load(_uri(path))
    sums = images.decoded_sums(files.select(F.regexp_extract("path", "t_([0-9]+)", 1).cast("bigint").alias("vec_id"), "content"))
    return sums.select("vec_id", F.posexplode("sums").alias("band", "total")).select("vec_id", big("band").alias("band"), "total")


# steps of the plans as a run calls them


_STEP_CONFIG = _CONFIG.replace("resolution: 30", "resolution: 20").replace("sample_size: 960, chip_size: 960", "sample_size: 20, chip_size: 20").replace("bands: [B01]", "bands: [B01, SCL]").replace("bands: [red]", "bands: [red, qa_pixel]") + "rules: {class_cap: 1}\n"


@query(f"""
WITH {_STATUS}, e AS (SELECT vec_id, y // 2 AS wy, x // 2 AS wx, sum(v) FILTER (y % 2 = 0 AND x % 2 = 0) AS e0, sum(v) FILTER (y % 2 = 1 AND x % 2 = 1) AS e3 FROM c GROUP BY ALL),
n AS (SELECT vec_id, wy, wx, min(c) AS cls, max(c) AS high, count(c) AS known, count(*) FILTER (c NOT IN (1, 2, 4, 5, 7, 8, 11)) AS odd FROM s GROUP BY ALL),
g AS (SELECT vec_id // 16 AS area, (vec_id % 16 // 4) * 4 + wy AS gy, (vec_id % 4) * 4 + wx AS gx, cls, known, odd, round(e3 * 100) = 0 AS lc, round(e0 * 100) = 0 AS dem,
  {" OR ".join(f"((vec_id + wx + {q}) % 5 = 0 AND (vec_id + wy + {q}) % 3 = 0)" for q in range(4))} AS s1, (vec_id + wy + wx) % 29 IN (0, 26, 27, 28) AS s2
  FROM n JOIN e USING (vec_id, wy, wx) WHERE cls = high AND cls > 0),
t AS (SELECT *, CASE WHEN gy = 15 OR gx = 15 THEN 'edge_out_of_bounds' WHEN known < 4 THEN 'lulc missing values' WHEN odd > 0 THEN 'lulc_values_wrong' WHEN cls = 4 THEN 'lulc_values_flooded_vegetation' ELSE 'ok' END AS st FROM g),
k AS (SELECT *, coalesce(sum(CASE WHEN lc OR dem OR s1 OR s2 THEN 0 ELSE 1 END) OVER (PARTITION BY area, cls, st ORDER BY gy, gx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior FROM t),
f AS (SELECT *, CASE WHEN st <> 'ok' THEN st WHEN prior >= 1 THEN 'lulc_' || cls || '_limit' WHEN lc THEN 'lc2l2 missing values' WHEN dem THEN 'dem missing values' WHEN s1 THEN 's1rtc missing values' WHEN s2 THEN 's2l2a missing values' ELSE 'success' END AS status FROM k)
SELECT (row_number() OVER (ORDER BY area, gy, gx) - 1)::BIGINT AS chip_index, area AS aoi_index, gy::BIGINT AS wy, gx::BIGINT AS wx, CASE WHEN st = 'ok' THEN cls END AS lulc, status,
  CASE WHEN status = 'success' THEN '1996020' || (area % 9 + 1) || ',1996050' || (area % 9 + 1) || ',1996080' || (area % 9 + 1) || ',1996110' || (area % 9 + 1) ELSE '[]' END AS s1rtc_dates FROM f""")
def aligned_chips(spark, d):
    """make_chips(): windows of five sources meet by their place; sixteen tiles each are an area of 16 x 16 windows.

    Radar is composed of two scenes a quarter with gaps of their own, optical scenes are masked by their classes.
    """
    from ..config import RunConfig
    from ..schemas import ID_COLUMNS
    from . import pipeline

    cfg = RunConfig.from_text(_STEP_CONFIG)
    id_, wy, wx, data = F.col("vec_id"), F.col("wy"), F.col("wx"), F.col("data")
    tiles = raster.windows_in_rows(table(spark, d, "embeddings").select("vec_id", F.col("embedding").alias("tile")), "tile", 8, 2, ["vec_id"])
    place = [F.floor(id_ / 16).alias("aoi_index"), (F.floor(id_ % 16 / 4) * 4 + wy).cast("int").alias("wy"), (id_ % 4 * 4 + wx).cast("int").alias("wx")]
    quarters = [F.to_timestamp(F.concat(F.lit(f"1996-{m}-0"), (F.floor(id_ / 16) % 9 + 1).cast("string"))) for m in ("02", "05", "08", "11")]
    once = quarters[0]
    hundredths = F.transform(data, lambda v: F.round(v.cast("double") * 100))
    gap = lambda base, hit: F.transform(hundredths, lambda v, i: F.when((i == 2) & hit, F.lit(None).cast("double")).otherwise(v + base))
    block = lambda source, t, band, values, n: F.struct(F.lit(source).alias("source"), t.alias("t"), F.lit(band).alias("band"), F.lit(n).alias("n"), values.alias("data"))
    made = [block("lulc", once, "lulc", spoiled(F.transform(data, class_of)), 2), block("dem", once, "elevation", F.slice(hundredths, 1, 1), 1)]
    for q, t in enumerate(quarters):
        cloudy = (id_ + wy + wx + q) % 29 == 0
        classes = F.transform(data, lambda v, i: F.when((i == 1) & cloudy, 9.0).otherwise(4.0))  # noqa: B023
        made += [block("s2l2a", t, "B01", gap(5000.0, F.lit(False)), 2), block("s2l2a", t, "SCL", classes, 2)]
        for k, hit in enumerate(((id_ + wx + q) % 5 == 0, (id_ + wy + q) % 3 == 0)):
            later = t + F.expr(f"INTERVAL '{k}' DAY")
            made += [block("s1rtc", later, "vv", gap(5000.0, hit), 2), block("s1rtc", later, "vh", gap(6000.0, F.lit(False)), 2)]
        made += [block("lc2l2", t, "red", F.slice(hundredths, 4, 1), 1), block("lc2l2", t, "qa_pixel", F.array(F.lit(64.0)), 1)]
    blocks = tiles.select("vec_id", "wy", "wx", F.inline(F.array(*made))).select(*place, "source", "t", "band", "n", "data")
    areas = table(spark, d, "embeddings").select(F.floor(id_ / 16).alias("aoi_index")).distinct()
    placed = areas.select("aoi_index", F.lit("success").alias("status"), F.lit(32632).alias("epsg"), F.lit(500000.0).alias("minx"), F.lit(5300000.0).alias("maxy"), F.lit(16).alias("rows"), F.lit(16).alias("cols"))
    ids = areas.select("aoi_index", *[F.lit("x").alias(c) for c in ID_COLUMNS])
    log = pipeline.make_chips(held(blocks, "blocks"), placed, ids, cfg)
    return log.select("chip_index", "aoi_index", big("wy").alias("wy"), big("wx").alias("wx"), big("lulc").alias("lulc"), "status", "s1rtc_dates")


@query("""
WITH s AS (SELECT event_id, 'e' || event_id AS item_id, ts, user_id % 5 AS area, CASE WHEN event_id % 8 = 0 THEN 1 ELSE 2 END AS orbit FROM events),
a AS (SELECT r_regionkey AS area, season, CASE season WHEN 0 THEN TIMESTAMP '2024-01-08' ELSE TIMESTAMP '2024-01-21' END AS center, CASE season WHEN 0 THEN TIMESTAMP '2024-01-01' ELSE TIMESTAMP '2024-01-16' END AS low,
  CASE season WHEN 0 THEN TIMESTAMP '2024-01-15 23:59:59' ELSE TIMESTAMP '2024-01-31 23:59:59' END AS high FROM region, range(2) q(season)),
n AS (SELECT a.area, season, s.*, abs(epoch_us(center) - epoch_us(ts)) AS distance FROM a JOIN s ON s.area = a.area AND ts BETWEEN greatest(low, center - INTERVAL 12 DAY) AND least(high, center + INTERVAL 12 DAY)),
l AS (SELECT area, arg_max(orbit, CASE WHEN orbit = 1 THEN 40 - (event_id % 3) * 10 ELSE 45 - (event_id % 4) * 10 END) AS locked FROM n WHERE season = 0 GROUP BY area),
k AS (SELECT n.* FROM n JOIN l ON n.area = l.area AND orbit = locked QUALIFY row_number() OVER (PARTITION BY n.area, season ORDER BY distance, ts, item_id) <= 50)
SELECT area::BIGINT AS aoi_index, season AS season_idx, item_id, orbit::BIGINT AS orbit FROM k QUALIFY ts::DATE = first_value(ts::DATE) OVER (PARTITION BY area, season ORDER BY distance, ts, item_id)""")
def radar_dates(spark, d):
    """radar_scenes(): the orbit whose united footprints cover the area best, the 50 scenes nearest in time, and of them the best one's date."""
    from ..config import RunConfig
    from . import pipeline

    def box(area, width):
        x = (area * 10).cast("double")
        return _box_wkt(x, F.lit(0.0), x + width, F.lit(1.0)), F.struct(x.alias("minx"), F.lit(0.0).alias("miny"), (x + width).alias("maxx"), F.lit(1.0).alias("maxy"))

    def at(first, second):
        return F.when(F.col("season_idx") == 0, F.lit(first).cast("timestamp")).otherwise(F.lit(second).cast("timestamp"))

    foot, foot_box = box(F.col("r_regionkey"), F.lit(1.0))
    seasons = table(spark, d, "region").withColumn("season_idx", F.explode(F.array(F.lit(0), F.lit(1))))
    anchors = seasons.select(
        big("r_regionkey").alias("aoi_index"), "season_idx", at("2024-01-08", "2024-01-21").alias("center"), at("2024-01-01", "2024-01-16").alias("range_start"),
        at("2024-01-15 23:59:59", "2024-01-31 23:59:59").alias("range_end"), foot.alias("footprint"), foot_box.alias("foot_box"),
    )
    first = F.col("event_id") % 8 == 0
    geom, bbox = box(F.col("user_id") % 5, F.when(first, 0.4 - F.col("event_id") % 3 * 0.1).otherwise(0.45 - F.col("event_id") % 4 * 0.1))
    catalogue = table(spark, d, "events").select(
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("item_id"), F.lit("s1").alias("collection"), timefn.ts("ts").alias("dt"), geom.alias("scene_geom"), bbox.alias("bbox"), F.when(first, 1).otherwise(2).alias("rel_orbit"),
    )
    found = pipeline.radar_scenes(anchors, catalogue, RunConfig.from_text(_CONFIG))
    return found.select("aoi_index", big("season_idx").alias("season_idx"), "item_id", big("rel_orbit").alias("orbit"))


_MERC_Y = "6378137.0 * ln(tan(pi() / 4 + radians({}) / 2))"


@query(f"""
WITH b AS (SELECT c_custkey, {_LONLAT} FROM customer), s AS (SELECT s_suppkey AS path, (s_suppkey * 17 % 340) - 170.25 AS x, (s_suppkey * 29 % 140) - 70.25 AS y FROM supplier),
o AS (SELECT o_custkey AS aoi_index, quarter(o_orderdate) - 1 AS season_idx, o_orderdate, o_totalprice, o_orderkey FROM orders WHERE {Y1997}
  QUALIFY row_number() OVER (PARTITION BY o_custkey, quarter(o_orderdate) ORDER BY o_totalprice, o_orderkey) = 1),
j AS (SELECT c_custkey, path, 6378137.0 * radians(greatest(least(minx + 1, x + 3) - greatest(minx, x), 0))
  * greatest({_MERC_Y.format("least(miny + 1, y + 3)")} - {_MERC_Y.format("greatest(miny, y)")}, 0) AS area FROM b JOIN s ON minx <= x + 3 AND x <= minx + 1 AND miny <= y + 3 AND y <= miny + 1
  QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY round(area, 2) DESC, path) = 1)
SELECT aoi_index, season_idx::BIGINT AS season_idx, strftime(o_orderdate, '%Y%m%d') AS center, path, (32601 + aoi_index % 60)::BIGINT AS area_epsg FROM o LEFT JOIN j ON aoi_index = c_custkey""")
def season_paths(spark, d):
    """A grid's table, read; season_anchors(): each area's seasons with the path that has most of its first scene."""
    from ..sources import grid
    from . import pipeline

    k = F.col("s_suppkey")
    x, y = k * 17 % 340 - 170.25, k * 29 % 140 - 70.25
    path = _uri(_folder(spark, "grid"))
    box = F.struct(*[v.cast("double").alias(c) for c, v in (("minx", x), ("miny", y), ("maxx", x + 3), ("maxy", y + 3))])
    table(spark, d, "supplier").select(k.cast("int").alias("path"), box.alias("bbox")).write.parquet(path)
    best = scenes.top_per_group(orders(spark, d), ["o_custkey", "q"], [F.asc("o_totalprice"), F.asc("o_orderkey")]).join(_customer_boxes(spark, d), F.col("o_custkey") == F.col("c_custkey"))
    b = F.col("box")
    scene_box = F.struct(*[b[c].cast("double").alias(c) for c in ("minx", "miny", "maxx", "maxy")])
    optical = best.select(
        F.col("o_custkey").alias("aoi_index"), (F.col("q") - 1).alias("season_idx"), F.col("t").alias("dt"), F.col("t").alias("range_start"), F.col("t").alias("range_end"), F.lit(None).cast("int").alias("epsg"),
        F.concat(F.lit("EPSG:"), (F.col("o_custkey") % 60 + 32601).cast("string")).alias("proj_code"), _box_wkt(b["minx"], b["miny"], b["maxx"], b["maxy"]).alias("scene_geom"), scene_box.alias("scene_box"),
    )
    found = pipeline.season_anchors(optical, grid.read_grid(spark, path))
    return found.select("aoi_index", big("season_idx").alias("season_idx"), timefn.day_stamp(F.col("center")).alias("center"), big("path").alias("path"), big("area_epsg").alias("area_epsg"))


@query("""
WITH o AS (SELECT o_custkey AS aoi_index, o_orderpriority[1] AS p, CASE WHEN o_orderpriority[1] IN ('4', '5') THEN -1 ELSE quarter(o_orderdate) - 1 END AS season, o_orderdate AS dt, o_orderkey::VARCHAR AS id FROM orders)
SELECT aoi_index, string_agg(id, ',' ORDER BY season, dt, id) FILTER (p = '1') AS s2l2a_scene_ids, string_agg(id, ',' ORDER BY season, dt, id) FILTER (p = '2') AS s1rtc_scene_ids,
  string_agg(id, ',' ORDER BY season, dt, id) FILTER (p = '3') AS lc2l2_scene_ids, string_agg(id, ',' ORDER BY season, dt, id) FILTER (p = '4') AS lulc_scene_ids, string_agg(id, ',' ORDER BY season, dt, id) FILTER (p = '5') AS dem_scene_ids
FROM o GROUP BY aoi_index""")
def chosen_id_lists(spark, d):
    """scene_id_lists(): each source's chosen scenes as a text, in columns named for the source."""
    from . import pipeline

    source = F.element_at(F.array(*map(F.lit, ("s2l2a", "s1rtc", "lc2l2", "lulc", "dem"))), F.substring("o_orderpriority", 1, 1).cast("int"))
    chosen = orders(spark, d, None).select(F.col("o_custkey").alias("aoi_index"), source.alias("source"), (F.col("q") - 1).alias("season_idx"), F.col("t").alias("dt"), F.col("o_orderkey").cast("string").alias("item_id"))
    return pipeline.scene_id_lists(chosen.withColumn("season_idx", F.when(~F.col("source").isin("lulc", "dem"), F.col("season_idx"))))


@query("SELECT c_custkey, c_nationkey::BIGINT AS nation, c_name || ', ' || c_mktsegment AS line FROM customer")
def archived_rows(spark, d):
    """Files in folders, packed by tasks into zip volumes, and read back from them."""
    import io
    import zipfile

    from ..session import ship
    from ..sources import release, store

    ship(spark)
    folder, target = _folder(spark, "packed"), _folder(spark, "volumes")
    text = F.concat_ws("\t", F.col("c_custkey").cast("string"), F.concat(F.col("c_name"), F.lit(", "), F.col("c_mktsegment")))
    table(spark, d, "customer").select(F.col("c_nationkey").alias("nation"), text.alias("value")).repartition("nation").write.partitionBy("nation").text(_uri(folder))
    release.archive(spark, _uri(folder), target, "customers", 1 << 14)

    def members(batches):
        for batch in batches:
            for path in batch["path"]:
                files, at = store.opened(path)
                with files.open_input_file(at) as f, zipfile.ZipFile(f) as volume:
                    for name in volume.namelist():
                        nation = int(name.split("nation=")[1].split("/")[0])
                        with volume.open(name) as member:
                            cells = [line.rstrip("\n").split("\t") for line in io.TextIOWrapper(member, "utf-8")]
                        yield pd.DataFrame({"c_custkey": [int(c[0]) for c in cells], "nation": nation, "line": [c[1] for c in cells]})

    volumes = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(_uri(target)).select("path")
    return volumes.mapInPandas(members, "c_custkey bigint, nation bigint, line string")


@query(f"""
WITH {_CAP}, n AS (SELECT max(vec_id) + 1 AS n FROM embeddings)
SELECT vec_id, label::BIGINT AS label, wy::BIGINT AS wy, wx::BIGINT AS wx, cls AS lulc, status LIKE '%_limit' AS over_cap, (row_number() OVER (ORDER BY vec_id * 3 // n, label, vec_id, wy, wx) - 1)::BIGINT AS chip_index FROM cap, n""")
def counted_windows(spark, d):
    """Windows that arrive in three batches of a stream: caps and numbers go on from batch to batch."""
    from ..streaming import counters

    windows = capped_windows(spark, d).drop("over_cap", "status", "data")
    n = table(spark, d, "embeddings").agg(F.max("vec_id") + 1).first()[0] or 1
    path = _uri(_folder(spark, "counted"))
    for part in range(3):
        windows.where(F.floor(F.col("vec_id") * 3 / n) == part).write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(windows.schema).parquet(f"{path}/in")
        counters.counted_batches(stream, f"{path}/out", f"{path}/checkpoint", "label", "lulc", ["vec_id", "wy", "wx"], "ok", 5)
    found = spark.read.parquet(f"{path}/out/rows")
    return found.select("vec_id", big("label").alias("label"), big("wy").alias("wy"), big("wx").alias("wx"), big("lulc").alias("lulc"), "over_cap", "chip_index")
