import random

import pytest
from pyspark.sql import functions as F

from landweave.operators import chips, curate


def test_cap_equals_a_sequential_counter(spark):
    rng = random.Random(3)
    rows = [(a, rng.choice([1, 2, 5]), k, rng.random() < 0.7) for a in range(4) for k in range(120)]
    want, counter = {}, {}
    for a, c, k, ok in rows:
        over = counter.get((a, c), 0) >= 9
        want[a, k] = over
        if ok and not over:
            counter[a, c] = counter.get((a, c), 0) + 1
    df = spark.createDataFrame(rows, "a int, c int, k int, ok boolean")
    got = {(r["a"], r["k"]): r["over_cap"] for r in chips.capped(df, ["a"], "c", ["k"], "ok", 9).collect()}
    assert got == want


def test_dense_ids_and_running_index(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(10**6), rng.randrange(5)) for _ in range(900)]
    rows = list({r[0]: r for r in rows}.values())
    df = spark.createDataFrame(rows, "k long, a int")
    ids = {r["k"]: r["id"] for r in chips.dense_ids(df, "k", "id", 32).collect()}
    assert ids == {k: i for i, k in enumerate(sorted(k for k, _ in rows))}
    index = {r["k"]: r["chip_index"] for r in chips.running_index(df, "a", ["k"], start=7).collect()}
    assert index == {k: i + 7 for i, (a, k) in enumerate(sorted((a, k) for k, a in rows))}
    assert chips.dense_ids(df.where("k < 0"), "k").count() == 0
    ties = chips.dense_ids(df.withColumn("same", F.lit(1)), "same", "id", 8)  # one value in all rows goes to many ranges
    assert sorted(r["id"] for r in ties.collect()) == list(range(len(rows)))
    backwards = chips.dense_ids(df, [F.col("k").desc()], "id", 8, stored=True)
    assert {r["k"]: r["id"] for r in backwards.collect()} == {k: i for i, k in enumerate(sorted((k for k, _ in rows), reverse=True))}


@pytest.mark.parametrize("factor", [None, 1.0, 1.5, 10.0])
def test_balance_drops_the_quota_and_keeps_the_smallest(spark, factor):
    sizes = {"a": 50, "b": 20, "c": 11}
    rows = [(f"{c}{k}", c) for c, n in sizes.items() for k in range(n)]
    df = spark.createDataFrame(rows, "i string, c string")
    got = {r["c"]: r["count"] for r in curate.balanced(df, "c", "i", factor).groupBy("c").count().collect()}
    mx, mn = max(sizes.values()), min(sizes.values())
    over = mx - mn * factor if factor else 0
    want = {c: n - (int(over / (mx - mn) * (n - mn)) if over > 0 else 0) for c, n in sizes.items()}
    assert got == want and got["c"] == 11


def test_equal_counts_are_left_alone(spark):
    df = spark.createDataFrame([("a1", "a"), ("b1", "b")], "i string, c string")
    assert curate.balanced(df, "c", "i", 1.0).count() == 2


def test_status_precedence(spark):
    rows = [("ok", False, 2.0, True), ("ok", True, 2.0, True), ("lulc_values_wrong", True, None, True), ("ok", None, 5.0, None)]
    df = spark.createDataFrame(rows, "st string, cap boolean, c double, bad boolean")
    status = chips.chip_status(F.col("st"), F.col("cap"), F.col("c"), [(F.col("bad"), "dem missing values")])
    assert [r[0] for r in df.select(status).collect()] == ["dem missing values", "lulc_2_limit", "lulc_values_wrong", "success"]


def test_include_exclude_raises_on_missing_keys(spark):
    df = spark.range(5).withColumnRenamed("id", "k")
    assert [r[0] for r in curate.exclude_include(df, "k", None, [1, 2]).orderBy("k").collect()] == [0, 3, 4]
    with pytest.raises(KeyError):
        curate.exclude_include(df, "k", [9], None)
    with pytest.raises(KeyError):
        curate.exclude_include(df, "k", [1], [1])


def test_resume_on_an_empty_log_starts_from_scratch(spark):
    areas, log = spark.range(4).withColumnRenamed("id", "k"), spark.createDataFrame([], "k long")
    assert curate.resumable(areas, log, "k").count() == 4
    assert curate.resumable(areas, spark.createDataFrame([(1,)], "k long"), "k").count() == 2


def test_release_filter_and_manifest(spark):
    good = "20230101,20230401,20230701,20231001"
    rows = [(1, "success", 2, good, good, good), (2, "success", 4, good, good, good), (3, "s2l2a missing values", 2, good, good, good), (4, "success", 2, good, "20230101", good)]
    log = spark.createDataFrame(rows, "original_id long, status string, lulc int, s2l2a_dates string, s1rtc_dates string, lc2l2_dates string")
    kept = curate.releasable(log)
    assert [r["original_id"] for r in kept.collect()] == [1]
    files = {(r["src"], r["dst"]) for r in curate.asset_manifest(chips.dense_ids(kept, "original_id")).collect()}
    assert len(files) == 3 * 4 * 2 + 1
    assert ("s1rtc_000001_2_20230701.png", "s1rtc_000000_20230701.png") in files and ("dem_000001.tif", "dem_000000.tif") in files
