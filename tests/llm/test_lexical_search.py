"""Ranked search against scoring everything, and block boundaries against every way to cut."""

import math
import random
import re
from collections import Counter
from functools import lru_cache

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from landweave.llm import lexical_search, queries, tables

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(text or "")]


def brute(docs, items, k=10):
    counts = [(i, Counter(words(t))) for i, t in docs]
    counts = [(i, c, sum(c.values())) for i, c in counts if c]
    n_docs, n_terms = len(counts), sum(n for *_, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    found = []
    for item, text in items:
        rows = []
        for i, c, n in counts:
            m = 25 + 75 * n * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in words(text) if t in c)
            if score > 0:
                rows.append((-score, i is not None, i or 0))
        found += [(item, r + 1, i if known else None, -s) for r, (s, known, i) in enumerate(sorted(rows)[:k])]
    return sorted(found, key=str)


@pytest.mark.parametrize("unit", [1, 3])
def test_blocks_have_the_least_bound_error(unit):
    rng = random.Random(4)
    lists = [[rng.choice([rng.randrange(1, 50), rng.randrange(1, 10**6)]) for _ in range(n)] for n in (1, 2, 3, 7, 12, 13, 29, 1, 40)]
    firsts = np.cumsum([0, *map(len, lists)])
    starts = lexical_search.block_starts(np.concatenate(lists).astype(np.int32), firsts, unit, 8, 5)
    assert set(firsts[:-1].tolist()) <= set(starts.tolist())

    for values, first in zip(lists, firsts):

        @lru_cache(None)
        def least(a, values=tuple(values)):
            if a >= len(values):
                return 0
            return min(max(values[a:b]) * (b - a) + 5 * max(values) + least(b) for b in [*range(a + unit, min(len(values), a + 8 * unit + 1), unit), *([len(values)] if len(values) - a <= 8 * unit else [])])

        own = [int(s - first) for s in starts if first <= s < first + len(values)] + [len(values)]
        assert sum(max(values[a:b]) * (b - a) + 5 * max(values) for a, b in zip(own, own[1:])) == least(0)
        assert all(b - a <= 8 * unit and (a % unit == 0) for a, b in zip(own, own[1:]))


def shard_of(texts):
    counted = [words(t) for t in texts]
    n = np.array([len(w) for w in counted])
    column = pa.array(texts)
    hashes = np.concatenate([h for _, _, h, _ in lexical_search.terms(column)])
    row = lexical_search.shard([pa.array(range(len(texts)), pa.int64())], hashes, n, len(texts), int(n.sum()))
    return lexical_search.Shard(row.column(0)[0].values, **{c: np.frombuffer(row.column(k + 1)[0].as_buffer(), t) for k, (c, t) in enumerate(lexical_search.ARRAYS.items())})


def test_search_skips_most_postings():
    rng = random.Random(8)
    common = [f"w{k}" for k in range(30)]
    texts = [" ".join(rng.choices(common, k=60) + (["rare"] * rng.randrange(1, 9) if k < 900 and k % 29 == 5 else [])) for k in range(3000)]
    part = shard_of(texts)
    read = []
    h = np.concatenate([h for _, _, h, _ in lexical_search.terms(pa.array(["rare w1 w2 w3 w4"]))])
    at = np.searchsorted(part.terms, h)
    weight = np.array([5000, 20, 20, 20, 20])
    got = part.best(at, weight, 10, 0, read)
    every = np.zeros(3000, dtype=np.int64)
    for t, w in zip(at, weight):
        every[part.docs[part.lists[t] : part.lists[t + 1]]] += part.values[part.lists[t] : part.lists[t + 1]] * w
    want = sorted((-int(s), True, i) for i, s in enumerate(every) if s)[:10]
    assert got == want
    postings = int(np.diff(part.lists)[at].sum())
    assert sum(n for n, _ in read) < 300 and sum(p for _, p in read) < postings / 2
    assert part.best(at, weight, 10, -want[9][0] + 1) == want[: sum(w[0] < want[9][0] for w in want)]


def test_query_equals_brute_force_and_sql(spark):
    docs = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()]
    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{SF}/benchmark.parquet").to_pylist()]
    got = queries.op13_lexical_search(spark, SF)
    assert got.columns == ["item_id", "rank", "doc_id", "score"] and dict(got.dtypes)["rank"] == "int"
    want = brute(docs, items)
    assert sorted(map(tuple, got.collect()), key=str) == want
    duck = duckdb.connect()
    for name in ("documents", "benchmark"):
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    assert sorted(duck.execute(lexical_search.ORACLE).fetchall(), key=str) == want


LONG = "some words and Other words 42 é at me@site.example.com, " * 3000


@pytest.mark.parametrize("tokens,block", [(1 << 20, 2000), (40, 2), (1, 3)])
def test_odd_rows_in_any_shards_and_blocks(spark, tokens, block):
    rng = random.Random(2)
    docs = [(1, None), (2, ""), (3, " \n\n "), (4, LONG), (None, "some words"), (None, LONG), (6, "one"), (7, "漢字 x"), (9, "some words"), (9, "some words"), (9, "other Words é é")]
    docs += [(100 + k, " ".join(rng.choices(["some", "words", "site", "x", "zz"], k=rng.randrange(1, 30)))) for k in range(60)]
    items = [(1, "Some WORDS, some words é"), (1, "one x"), (None, "site x 漢字"), (2, None), (3, ""), (4, "absent"), (5, LONG)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"score": F.lit("7"), "rank": F.lit(1), "ids": F.lit("s"), "__q": F.lit(3)}).repartition(4)
    asked = spark.createDataFrame(items, "item_id long, text string").withColumns({"rank": F.lit("7"), "doc_id": F.lit("x")})
    got = lexical_search.search(lexical_search.build_index(df, shard_tokens=tokens), asked, item_block=block)
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items)
    if block == 2:
        empty = [lexical_search.search(lexical_search.build_index(d), i) for d, i in ((df.limit(0), asked), (df, asked.limit(0)))]
        assert all(e.collect() == [] and e.columns == got.columns for e in empty)


def test_impacts_of_enormous_tables_are_exact():
    n = np.array([10**7, 5])
    got = lexical_search.impacts(np.array([3, 1]), n, 10**12, 10**14)
    assert got.tolist() == [3_000_000_000 // (3000 + 8 * (25 + 75 * 10**7 * 10**12 // 10**14)), 1_000_000_000 // (1000 + 8 * (25 + 75 * 5 * 10**12 // 10**14))]
    assert lexical_search.summed(np.array([0, 0, 1]), np.array([2**60, 1, 3]), 2).tolist() == [2**60 + 1, 3]


def test_shards_lie_in_row_groups_of_bounded_size(spark, monkeypatch):
    """A task that writes or reads the index holds some shards, however many its documents make."""
    monkeypatch.setitem(tables.LARGE_ROWS, "parquet.block.size", 1 << 12)
    docs = spark.range(60).selectExpr("id AS doc_id", "concat_ws(' ', transform(sequence(1, 40), x -> concat('w', x * (id + 1)))) AS text").coalesce(1)
    index = lexical_search.build_index(docs, shard_tokens=80)
    files = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in index.shards.inputFiles()]
    assert sum(f.num_rows for f in files) == 30
    assert max(f.row_group(k).num_rows for f in files for k in range(f.num_row_groups)) <= 8
