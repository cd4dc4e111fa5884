"""Ranked lexical search: an index of posting shards with blocks of variable length, searched exactly by block bounds.

Documents are gathered into shards of about SHARD_TOKENS terms, wherever Spark has dealt them; nothing is shuffled. A shard
holds, for each term, the documents that have it and what one occurrence of the term in a query is worth there (its
impact). Each list of postings is cut into blocks by dynamic programming, which minimises the bound error: a block costs
its largest impact times its postings, and a fixed charge. All lists of a shard go through the recurrence together.

A search takes a shard's items one by one. The blocks' largest impacts, weighted and summed over an item's terms, bound the
score of every document at once; the postings of a term that few documents hold are known one by one, as by a
cursor, and bound no other document. A document whose bound is below the k-th score so far is no pivot and is never
scored, and a block without a pivot is never read. The likeliest pivots are scored first, which raises the k-th score for
the others, and it is carried from shard to shard within a task. Bounds are never below scores, so the result is
that of scoring everything. Ties: a pivot whose bound equals the k-th score is scored, as a smaller id may win.

Scores are whole numbers: a term's weight is floor(1000*ln((2N+2)/(2df+1))), its impact
1000000000*tf div (1000*tf+8*m), and m = 25 + 75*n*N div L is the document's relative length.

Defined cases: a document without terms (null and empty texts, too) doesn't count and is never found; an item without terms, or
whose terms are in no document, has no rows; documents that share an id are ranked each for itself; a null id is the smallest; items
that share an id, or have a null one, have rows of their own each; empty tables give an empty result; columns other than id
and text aren't read. Terms are told apart by a 64-bit hash. Items are taken ITEM_BLOCK at a time.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from heapq import merge
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..operators.chips import dense_ids
from . import flat
from .tables import materialise
from .target_resampling import WORD

TOP = 10
#: Terms of a shard, about; a longer document is a shard of its own.
SHARD_TOKENS = 1 << 20
#: Items that the driver hands to all tasks at a time.
ITEM_BLOCK = 2_000
#: Postings that a block boundary never parts, units that a block has at most, and its charge in postings of the largest impact.
UNIT, LONGEST_BLOCK, CHARGE = 4, 32, 8
#: Pivots that are scored first, for each wanted document.
PROBE = 4
#: A term in less than one document of so many counts at its own documents only.
SPARSE = 8
#: Groups of tasks whose best documents are merged before those of all are.
MERGES = 64


def terms(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices of a text column: first row, last row + 1, hashes of all terms, and terms of each row."""
    data, offsets = flat.column_bytes(column)
    for first, last, part, at in flat.slices(data, offsets):
        part = flat.LOWER[part]
        starts, ends, rows = flat.words(part, at, WORD)
        yield first, last, flat.word_hashes(part, starts, ends), np.diff(rows)


def totals(documents: DataFrame, text: str) -> tuple[int, int]:
    """Documents that hold a term, and all their terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = every = 0
        for batch in batches:
            data, offsets = flat.column_bytes(batch.column(0))
            for _, _, part, at in flat.slices(data, offsets):
                n = np.diff(flat.words(flat.LOWER[part], at, WORD)[2])
                some, every = some + int((n > 0).sum()), every + int(n.sum())
        yield pa.RecordBatch.from_pydict({"some": [some], "every": [every]})

    got = documents.select(text).mapInArrow(run, "some long, every long").agg(F.sum("some"), F.sum("every")).first()
    return int(got[0] or 0), int(got[1] or 0)


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What an occurrence of a term is worth, by its occurrences in a document and that document's terms."""
    exact = n.astype(object) if len(n) and 75 * int(n.max()) * n_docs >= 1 << 63 else n.astype(np.int64)
    m = (25 + (75 * exact * n_docs) // n_terms).astype(np.int64)
    tf = tf.astype(np.int64)
    return ((1_000_000_000 * tf) // (1000 * tf + 8 * m)).astype(np.int32)


def block_starts(values: np.ndarray, firsts: np.ndarray, unit: int = UNIT, longest: int = LONGEST_BLOCK, charge: int = CHARGE) -> np.ndarray:
    """Places in values where blocks begin. List k is values[firsts[k]:firsts[k+1]] and isn't empty.

    The blocks of a list, of whole units (but for the list's end) and `longest` units at most, minimise the sum over
    blocks of the postings times their largest value, plus charge times the list's largest value each.
    """
    sizes = np.diff(firsts)
    begins = np.zeros(len(values), dtype=bool)
    begins[firsts[:-1]] = True
    lists = np.flatnonzero(sizes > unit)
    if not len(lists):
        return np.flatnonzero(begins)
    lists = lists[np.argsort(-sizes[lists], kind="stable")]
    size, first = sizes[lists], firsts[:-1][lists]
    units = -(-size // unit)
    at = np.concatenate([[0], np.cumsum(units)])
    of = np.repeat(np.arange(len(lists)), units)
    places = first[of] + (np.arange(at[-1]) - at[of]) * unit
    largest = np.zeros(at[-1], dtype=np.int64)
    for k in range(unit):  # of each unit; those at a list's end may have fewer postings
        inside = places + k < (first + size)[of]
        largest[inside] = np.maximum(largest[inside], values[places[inside] + k])
    fixed = charge * np.maximum.reduceat(largest, at[:-1])
    # column k: what a block of the last k + 1 units starts from, and its largest value
    before = np.full((len(lists), longest), np.iinfo(np.int64).max // 4)
    before[:, 0] = 0
    top = np.zeros((len(lists), longest), dtype=np.int64)
    choice = np.zeros(at[-1], dtype=np.int16)
    back = np.arange(longest) * unit
    for i in range(int(units[0])):
        n = int(np.searchsorted(-units, -i, side="left"))  # lists of more than i units
        x = largest[at[:n] + i]
        top[:n, 1:] = top[:n, :-1]
        top[:n, 0] = 0
        np.maximum(top[:n], x[:, None], out=top[:n])
        postings = (np.minimum((i + 1) * unit, size[:n]) - i * unit)[:, None] + back
        cost = before[:n] + postings * top[:n]
        best = cost.argmin(axis=1)
        choice[at[:n] + i] = best
        before[:n, 1:] = before[:n, :-1]
        before[:n, 0] = cost[np.arange(n), best] + fixed[:n]
    end, k = units.copy(), np.arange(len(lists))
    while len(k):
        end[k] -= choice[at[k] + end[k] - 1] + 1
        begins[first[k] + end[k] * unit] = True
        k = k[end[k] > 0]
    return np.flatnonzero(begins)


#: A shard: ids, and terms (uint64, ascending), the places of their lists and blocks, blocks' first postings and largest impacts, and postings.
ARRAYS = {"terms": "<u8", "lists": "<i8", "blocks": "<i8", "starts": "<i8", "bounds": "<i4", "docs": "<i4", "values": "<i4"}
SHARD = "ids array<bigint>, " + ", ".join(f"{c} binary" for c in ARRAYS)


def shard(ids: list[pa.Array], hashes: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> pa.RecordBatch:
    """A shard's row: of its documents' ids, all their terms one document after the other, and how many each has."""
    doc = np.repeat(np.arange(len(n), dtype=np.int32), n)
    order = np.argsort(hashes, kind="stable")
    h, d = hashes[order], doc[order]
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (d[1:] != d[:-1])])
    begins = np.flatnonzero(new)
    tf = np.diff(np.append(begins, len(h)))
    h, d = h[begins], d[begins]
    values = impacts(tf, n[d], n_docs, n_terms)
    lists = np.append(np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])), len(h))
    starts = block_starts(values, lists)
    found = {"terms": h[lists[:-1]], "lists": lists, "blocks": np.searchsorted(starts, lists), "starts": np.append(starts, len(h)), "bounds": np.maximum.reduceat(values, starts), "docs": d, "values": values}
    own = pa.concat_arrays(ids)
    arrays = [pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own), *(pa.array([found[c].astype(t).tobytes()], pa.binary()) for c, t in ARRAYS.items())]
    return pa.RecordBatch.from_arrays(arrays, names=["ids", *ARRAYS])


@dataclass(frozen=True)
class Index:
    """Shards of all documents that hold a term, their number, and the number of their terms."""

    shards: DataFrame
    n_docs: int
    n_terms: int
    id_type: T.DataType


def build_index(documents: DataFrame, text: str = "text", id_col: str = "doc_id", shard_tokens: int = SHARD_TOKENS) -> Index:
    """The index of all documents, stored in the shared folder."""
    n_docs, n_terms = totals(documents, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, hashes, counts, held = [], [], [], 0
        for batch in batches:
            for first, last, h, n in terms(batch.column(1)):
                ends = np.cumsum(n)
                a = 0  # rows that a shard has taken; terms before them
                while a < last - first:
                    done = int(ends[a - 1]) if a else 0
                    b = max(a + (not held), int(np.searchsorted(ends, done + shard_tokens - held, side="right")))
                    if b > a:
                        some = n[a:b] > 0
                        ids.append(batch.column(0).slice(first + a, b - a).filter(pa.array(some)))
                        hashes.append(h[done : ends[b - 1]])
                        counts.append(n[a:b][some])
                        held += int(ends[b - 1]) - done
                    if b < last - first:
                        if held:
                            yield shard(ids, np.concatenate(hashes), np.concatenate(counts), n_docs, n_terms)
                        ids, hashes, counts, held = [], [], [], 0
                    a = b
        if held:
            yield shard(ids, np.concatenate(hashes), np.concatenate(counts), n_docs, n_terms)

    rows = documents.select(F.col(id_col).cast("long"), F.col(text))
    return Index(materialise(rows.mapInArrow(run, SHARD), "posting-shards", large=True), n_docs, n_terms, documents.schema[id_col].dataType)


def item_terms(items: DataFrame, text: str, id_col: str) -> DataFrame:
    """__q (a number), __item, and terms (uint64) and repeats (int64) of each item, stored."""
    numbered = dense_ids(items.select(F.col(id_col).alias("__item"), F.col(text).alias("__text")), "__item", "__q")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, h, n in terms(batch.column(1)):
                own = [np.unique(x, return_counts=True) for x in np.split(h, np.cumsum(n)[:-1])]
                packed = [pa.array([x[k].astype(t).tobytes() for x in own], pa.binary()) for k, t in ((0, "<u8"), (1, "<i8"))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), *packed], names=["__q", "terms", "repeats"])

    packed = numbered.select("__q", "__text").mapInArrow(run, "__q long, terms binary, repeats binary")
    return materialise(packed.join(numbered.select("__q", "__item"), "__q"), "item-terms")


def frequencies(index: Index, wanted: np.ndarray) -> np.ndarray:
    """Documents that hold each of some terms (uint64, ascending)."""
    shared = index.shards.sparkSession.sparkContext.broadcast(wanted)  # the terms of ITEM_BLOCK items

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(shared.value), dtype=np.int64)
        for batch in batches:
            for row in zip(*batch.columns, strict=True):
                own, lists = (np.frombuffer(x.as_buffer(), t) for x, t in zip(row, ("<u8", "<i8"), strict=True))
                _, here, at = np.intersect1d(shared.value, own, assume_unique=True, return_indices=True)
                n[here] += np.diff(lists)[at]
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], names=["at", "n"])

    got = index.shards.select("terms", "lists").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    found = np.zeros(len(wanted), dtype=np.int64)
    found[got["at"].to_numpy()] = got["n"].to_numpy()
    return found


def summed(places: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Sums of whole numbers by place."""
    if float(values.sum()) < 2**53:  # doubles are exact so far
        return np.bincount(places, values, size)[:size].astype(np.int64)
    found = np.zeros(size, dtype=np.int64)
    np.add.at(found, places, values)
    return found


def ranges(begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All places of some ranges, one range after the other."""
    sizes = ends - begins
    first = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) + np.repeat(begins - first, sizes)


class Shard:
    """A shard as it is searched."""

    def __init__(self, ids: pa.Array, **arrays: np.ndarray):
        self.ids = ids
        self.__dict__.update(arrays)
        self.n = len(ids)
        self.lo, self.hi = self.docs[self.starts[:-1]], self.docs[self.starts[1:] - 1]
        self.most = np.maximum.reduceat(self.bounds, self.blocks[:-1])
        self.known = ids.is_valid().to_numpy(zero_copy_only=False)
        self.id = np.asarray(ids.fill_null(0))

    def best(self, lists: np.ndarray, weight: np.ndarray, k: int, least: int, read: list | None = None) -> list[tuple[int, bool, int]]:
        """(-score, id is known, id) of documents that can be among the k best, those below `least` left out.

        lists and weight: an item's terms in this shard. read: gets the numbers of documents scored and of postings read in blocks.
        """
        if int((self.most[lists].astype(np.int64) * weight).sum()) < max(1, least):
            return []
        begins, ends = self.lists[lists], self.lists[lists + 1]
        sparse = (ends - begins) * SPARSE < self.n
        at = ranges(begins[sparse], ends[sparse])
        sure = summed(self.docs[at], self.values[at] * np.repeat(weight[sparse], (ends - begins)[sparse]), self.n)
        begins, ends = self.blocks[lists[~sparse]], self.blocks[lists[~sparse] + 1]
        block = ranges(begins, ends)
        w = np.repeat(weight[~sparse], ends - begins)
        bound = self.bounds[block] * w
        lo, hi = self.lo[block], self.hi[block]
        upper = sure + np.cumsum(summed(lo, bound, self.n + 1) - summed(hi + 1, bound, self.n + 1))[:-1]
        pivots = np.flatnonzero(upper >= max(1, least))
        found: list[tuple[int, bool, int]] = []
        while len(pivots):
            first = pivots
            if len(pivots) > PROBE * k and not found:
                first = np.sort(pivots[np.argpartition(-upper[pivots], PROBE * k)[: PROBE * k]])
            slot = np.full(self.n + 1, -1, dtype=np.int64)
            slot[first] = np.arange(len(first))
            upto = np.concatenate([[0], np.cumsum(slot[:-1] >= 0)])
            live = upto[hi + 1] > upto[lo]
            a, b = self.starts[block[live]], self.starts[block[live] + 1]
            at, ww = ranges(a, b), np.repeat(w[live], b - a)
            place = slot[self.docs[at]]
            held = place >= 0
            score = sure[first] + summed(place[held], self.values[at[held]] * ww[held], len(first))
            if read is not None:
                read.append((len(first), len(at)))
            good = np.flatnonzero(score >= max(1, least))
            good = good[np.lexsort((self.id[first[good]], self.known[first[good]], -score[good]))[:k]]
            rows = list(zip((-score[good]).tolist(), self.known[first[good]].tolist(), self.id[first[good]].tolist(), strict=True))
            found = list(islice(merge(found, rows), k))
            if len(found) == k:
                least = max(least, -found[-1][0])
            rest = pivots[slot[pivots] < 0]
            pivots = rest[upper[rest] >= least]
        return found


def search(index: Index, items: DataFrame, text: str = "text", id_col: str = "item_id", k: int = TOP, item_block: int = ITEM_BLOCK) -> DataFrame:
    """id_col, rank (int, from 1), doc_id and score (long) of each item's k best documents."""
    stored = item_terms(items, text, id_col)
    n_items = stored.count()
    found = [_best(index, stored.where(F.col("__q").between(a, a + item_block - 1)), k) for a in range(0, n_items, item_block)]
    empty = index.shards.sparkSession.createDataFrame([], "__q long, doc_id long, score long")
    rows = reduce(DataFrame.unionByName, found) if found else empty
    order = [F.col("score").desc(), F.col("doc_id")]
    some = rows.withColumn("__m", F.pmod(F.spark_partition_id(), F.lit(MERGES)))
    some = some.withColumn("__r", F.row_number().over(Window.partitionBy("__q", "__m").orderBy(*order))).where(F.col("__r") <= k).drop("__m", "__r")
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("__q").orderBy(*order))).where(F.col("rank") <= k)
    return ranked.join(stored.select("__q", "__item"), "__q").select(F.col("__item").alias(id_col), "rank", F.col("doc_id").cast(index.id_type).alias("doc_id"), "score")


def _best(index: Index, block: DataFrame, k: int) -> DataFrame:
    """__q, doc_id and score of each task's k best documents for a block of items."""
    got = block.select("__q", "terms", "repeats").toArrow()  # ITEM_BLOCK rows
    own = [np.frombuffer(x.as_buffer(), "<u8") for x in got["terms"]]
    repeats = [np.frombuffer(x.as_buffer(), "<i8") for x in got["repeats"]]
    wanted = np.unique(np.concatenate([*own, np.zeros(0, np.uint64)]))
    df = frequencies(index, wanted)
    w = np.array([math.floor(1000 * math.log((2 * index.n_docs + 2) / (2 * int(n) + 1))) for n in df], dtype=np.int64)
    queries = [(q, at := np.searchsorted(wanted, t), w[at] * r) for q, t, r in zip(got["__q"].to_pylist(), own, repeats, strict=True)]
    shared = index.shards.sparkSession.sparkContext.broadcast((wanted, queries))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, queries = shared.value
        best: dict[int, list] = {q: [] for q, *_ in queries}
        for batch in batches:
            for ids, *row in zip(*batch.columns, strict=True):
                part = Shard(ids.values, **{c: np.frombuffer(x.as_buffer(), t) for x, (c, t) in zip(row, ARRAYS.items(), strict=True)})
                at = np.searchsorted(part.terms, wanted)
                here = part.terms[np.minimum(at, len(part.terms) - 1)] == wanted
                for q, places, weight in queries:
                    held = here[places]
                    if held.any():
                        least = -best[q][-1][0] if len(best[q]) == k else 0
                        best[q] = list(islice(merge(best[q], part.best(at[places[held]], weight[held], k, least)), k))
        rows = [(q, i if known else None, -s) for q, found in best.items() for s, known, i in found]
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.int64()) for c in range(3)], names=["__q", "doc_id", "score"])

    return index.shards.mapInArrow(run, "__q long, doc_id long, score long")


def ranked(documents: DataFrame, items: DataFrame) -> DataFrame:
    """item_id, rank, doc_id and score of the ten best documents of each item."""
    return search(build_index(documents), items)


_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: The query's result in DuckDB, by scoring everything.
ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, {_WORDS} AS words FROM documents),
i AS (SELECT row_number() OVER () AS q, item_id, {_WORDS} AS words FROM benchmark),
t AS (SELECT row, doc_id, term, count(*) AS tf FROM (SELECT row, doc_id, unnest(words) AS term FROM d) GROUP BY ALL),
n AS (SELECT row, sum(tf)::BIGINT AS n FROM t GROUP BY row),
g AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM n),
w AS (SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM t, g GROUP BY term),
p AS (SELECT row, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))) AS s FROM t JOIN n USING (row) JOIN w USING (term), g),
x AS (SELECT q, item_id, row, doc_id, sum(s)::BIGINT AS score FROM (SELECT q, item_id, unnest(words) AS term FROM i) JOIN p USING (term) GROUP BY ALL)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM x WHERE score > 0)
WHERE rank <= {TOP}
"""
