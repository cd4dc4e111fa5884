"""Resampling towards a target against a plain program, and the checksums against zlib."""

import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow.parquet as pq
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from landweave.llm import flat, queries, target_resampling

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return words, [zlib.crc32(r.encode()) % 10_000 for r in runs]


def brute(docs, targets):
    raw, target = np.zeros(10_000, int), np.zeros(10_000, int)
    for t in targets:
        np.add.at(target, features(t)[1], 1)
    for _, t in docs:
        np.add.at(raw, features(t)[1], 1)
    s, t = int(raw.sum()), int(target.sum())
    gain = [math.floor(1000 * math.log((int(b) + 1) * (s + 10_000) / ((int(a) + 1) * (t + 10_000)))) for a, b in zip(raw, target)]
    rows = []
    for i, text in docs:
        words, found = features(text)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found)
        rows.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words)])
    eligible = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for k, r in enumerate(eligible[: 5 * len(eligible) // 100]):
        r[4] = k + 1
    return sorted(map(tuple, rows), key=str)


@given(st.lists(st.text(alphabet="abAB é漢0 .-\n", max_size=30), max_size=8))
@settings(max_examples=150, deadline=None)
def test_buckets_equal_checksums_of_the_runs(texts):
    data = "".join(texts).encode()
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    stream, n, words = target_resampling.bucket_stream(np.frombuffer(data, np.uint8), offsets)
    ends = np.cumsum(n)
    for text, end, count, w in zip(texts, ends, n, words):
        want_words, want = features(text)
        assert sorted(stream[end - count : end].tolist()) == sorted(want) and w == len(want_words)


def test_checksums_of_long_words():
    text = " ".join(["x" * n for n in (1, 63, 64, 65, 66, 1000)] + ["é" * 40_000, "last"])
    data = np.frombuffer(text.encode(), np.uint8)
    starts, ends, _ = flat.words(data, np.array([0, len(data)]), target_resampling.WORD)
    assert target_resampling.word_checksums(data, starts, ends).tolist() == [zlib.crc32(w.encode()) for w in text.split()]
    stream, _, _ = target_resampling.bucket_stream(data, np.array([0, len(data)]))
    assert sorted(stream.tolist()) == sorted(features(text)[1])


def test_runs_of_sorted_streams():
    values, n = target_resampling.run_lengths(np.array([1, 1, 4, 9, 9, 9], np.uint16))
    assert (values.tolist(), n.tolist()) == ([1, 4, 9], [2, 1, 3])
    assert target_resampling.run_lengths(np.zeros(0, np.uint16))[1].tolist() == []


def test_query_equals_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()]
    targets = [r["text"] for r in pq.read_table(f"{SF}/benchmark.parquet").to_pylist()]
    got = queries.op12_target_resampling(spark, SF)
    assert got.columns[:5] == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, targets)


LONG = "some words and Other words 42 é at me@site.example.com, " * 5000


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, " \n\n "), (4, LONG), (None, LONG), (6, "one"), (7, "two words"), (8, "x" * 100_000), (9, LONG), (9, LONG)]
    docs += [(100 + k, LONG[: 200 + 7 * k]) for k in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"score": F.lit("7"), "id": F.lit(1), "stream": F.lit("s"), "__range": F.lit(3)})
    for targets in (["some words and nothing else", None, ""], []):
        target = spark.createDataFrame([(k, t) for k, t in enumerate(targets)], "item_id long, text string")
        got = target_resampling.resample(df.repartition(3), target)
        assert sorted(map(tuple, got.collect()), key=str) == brute(docs, targets)
    empty = target_resampling.resample(df.limit(0), target)
    assert empty.collect() == [] and empty.columns == got.columns


def test_ties_go_to_the_smaller_id(spark, monkeypatch):
    monkeypatch.setattr(target_resampling, "gumbel", lambda id_col, seed: F.lit(0).cast("long"))
    text = "one two three four five six seven eight nine ten " * 3
    df = spark.createDataFrame([(k * 37 % 200, text) for k in range(200)], "doc_id long, text string").repartition(5)
    got = target_resampling.resample(df, df.limit(1), percent=11)
    ranks = {r["doc_id"]: r["rank"] for r in got.collect()}
    assert {i: r for i, r in ranks.items() if r} == {i: i + 1 for i in range(22)}


def test_kth_highest(spark):
    values = [((-1) ** k) * (k * k * 7919 % 100_003) * 10**9 for k in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    for k in (1, 2, 250, 500):
        assert target_resampling.kth_highest(df, "v", k, bins=16) == sorted(values, reverse=True)[k - 1]
    assert target_resampling.kth_highest(df, "v", 0) is None and target_resampling.kth_highest(df, "v", 501) is None
