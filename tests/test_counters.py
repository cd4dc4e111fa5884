"""Caps and numbers across batches against one batch over all rows."""

import random

import pytest

from landweave.operators import chips
from landweave.streaming import counters

SCHEMA = "area bigint, cls double, place int, ok boolean, extra string"
HOW = {"area": "area", "cls": "cls", "order": ["place"], "ok": "ok", "cap": 3}


def rows_of(seed):
    rng = random.Random(seed)
    return [(a, rng.choice([1.0, 2.0, None]), p, rng.random() < 0.7, "x") for a in range(4) for p in range(12)]


def found(spark, out):
    return sorted(map(tuple, spark.read.parquet(f"{out}/rows").select("area", "place", "over_cap", "chip_index").collect()))


@pytest.mark.parametrize("cuts", [(48,), (0, 1, 20, 20, 47, 48), (7, 30, 48)])
def test_any_split_gives_what_one_batch_gives(spark, tmp_path, cuts):
    rows = rows_of(5)
    low = 0
    for number, high in enumerate(cuts):
        counters.count_batch(spark.createDataFrame(rows[low:high], SCHEMA), number, f"file://{tmp_path}", **HOW)
        low = high
    once = chips.capped(spark.createDataFrame(rows, SCHEMA), ["area"], "cls", ["place"], "ok", 3)
    over = {(r["area"], r["place"]): r["over_cap"] for r in once.collect()}
    want = [(a, p, over[a, p], k) for k, (a, _, p, _, _) in enumerate(rows)]
    assert found(spark, tmp_path) == want and any(over.values())


def test_windows_of_an_area_that_come_later_go_on_counting(spark, tmp_path):
    """Areas interleaved over batches: caps hold per area and class, and numbers are 0 to n - 1."""
    rows = rows_of(9)
    parts = [[r for r in rows if r[2] % 12 in range(low, low + 4)] for low in (0, 4, 8)]
    for number, part in enumerate(parts):
        counters.count_batch(spark.createDataFrame(part, SCHEMA), number, f"file://{tmp_path}", **HOW)
    seen, want = {}, {}
    for a, c, p, ok, _ in rows:
        want[a, p] = seen.get((a, c), 0) >= 3
        seen[a, c] = seen.get((a, c), 0) + ok
    got = found(spark, tmp_path)
    assert {(a, p): over for a, p, over, _ in got} == want
    assert sorted(k for *_, k in got) == list(range(len(rows)))


def test_a_batch_that_fails_between_its_folders_counts_once(spark, tmp_path, monkeypatch):
    rows = rows_of(3)
    parts = [rows[:20], rows[20:]]
    made = lambda k: spark.createDataFrame(parts[k], SCHEMA)
    counters.count_batch(made(0), 0, f"file://{tmp_path}/a", **HOW)
    counters.count_batch(made(1), 1, f"file://{tmp_path}/a", **HOW)
    counters.count_batch(made(0), 0, f"file://{tmp_path}/b", **HOW)
    counters.count_batch(made(0), 0, f"file://{tmp_path}/b", **HOW)  # again
    from py4j.protocol import Py4JError

    union = type(made(0)).unionByName

    def broken(*_, **__):
        raise RuntimeError("counts")

    monkeypatch.setattr(type(made(0)), "unionByName", broken)
    with pytest.raises((RuntimeError, Py4JError)):
        counters.count_batch(made(1), 1, f"file://{tmp_path}/b", **HOW)
    monkeypatch.setattr(type(made(0)), "unionByName", union)
    counters.count_batch(made(1), 1, f"file://{tmp_path}/b", **HOW)
    assert found(spark, tmp_path / "b") == found(spark, tmp_path / "a")


def test_the_stream_goes_on_from_its_checkpoint(spark, tmp_path):
    rows = rows_of(7)
    out = f"file://{tmp_path}/out"
    for low, high in ((0, 24), (24, 48)):
        spark.createDataFrame(rows[low:high], SCHEMA).write.mode("append").parquet(f"file://{tmp_path}/in")
        stream = spark.readStream.schema(SCHEMA).parquet(f"file://{tmp_path}/in")
        counters.counted_batches(stream, out, f"file://{tmp_path}/checkpoint", **HOW)
    assert [k for *_, k in found(spark, tmp_path / "out")] == list(range(48))
