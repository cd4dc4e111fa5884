"""Importance resampling towards the distribution of a target: hashed word runs, counted by external sorting.

The features of a text are all runs of one to three words; a feature's bucket is the crc32 of its bytes modulo BUCKETS. A
checksum is linear, so that of a run is put together from those of its words by tables, without making the run. Each
slice of texts becomes one row of a stored table: its documents, their offsets, and the packed uint16 stream of all their
buckets. Counting sorts each stream, run-length encodes it and adds the runs up, in the task first and then by
aggregation; the texts are not read again. A bucket's gain is the thousandfold log of its share in the target over its
share in the documents, both smoothed by one; a document's weight is the sum of the gains gathered along its stream, by
np.add.reduceat. Gumbel noise from a hash of the id turns the highest scores into a draw without replacement. The documents that may be
drawn are numbered by ranges of their scores, never in one task.

Defined cases: null, empty and wordless texts have no features, the weight 0 and are too short to be drawn; a null id hashes like
the empty string and ties as the smallest; rows that share an id have the same noise, and where they tie each still has a rank of its own;
without target texts all gains come from the documents alone; an empty table gives an empty one; columns
other than id and text aren't read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.chips import dense_ids
from . import flat
from .tables import materialise
from .token_files import binary

BUCKETS = 10_000
LONGEST_RUN = 3
MIN_WORDS = 20
PERCENT = 5
SEED = 42

#: Digits, a-z and every byte of a character beyond ASCII; A-Z are lower-cased before.
WORD = np.zeros(256, dtype=bool)
WORD[48:58] = WORD[97:123] = WORD[128:] = True

#: Words of up to so many bytes go through the checksum's tables together.
TABLED = 64


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


CRC = _byte_table()


def _spread(columns: np.ndarray) -> np.ndarray:
    """A linear map of 32 bits, given by what it makes of each bit, as four tables of 256."""
    byte = np.arange(256)
    tables = np.zeros((4, 256), dtype=np.uint32)
    for k in range(32):
        tables[k // 8] ^= np.where(byte >> (k % 8) & 1, columns[k], 0).astype(np.uint32)
    return tables


def _applied(tables: np.ndarray, x: np.ndarray) -> np.ndarray:
    return tables[0][x & 255] ^ tables[1][x >> 8 & 255] ^ tables[2][x >> 16 & 255] ^ tables[3][x >> 24]


def _zeros() -> tuple[np.ndarray, np.ndarray]:
    """For each n up to TABLED the map of a checksum over n zero bytes, and for each k the map of 2^k zero bytes."""
    bits = np.uint32(1) << np.arange(32, dtype=np.uint32)
    each = [_spread(bits)]
    for _ in range(TABLED):
        x = _applied(each[-1], bits)
        each.append(_spread(CRC[x & 255] ^ (x >> 8)))
    doubled = [each[1]]
    for _ in range(31):
        doubled.append(_spread(_applied(doubled[-1], _applied(doubled[-1], bits))))
    return np.stack(each), np.stack(doubled)


SHORT_ZEROS, POWER_ZEROS = _zeros()


def appended(crc: np.ndarray, crc_after: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Checksums of byte strings with others, of given checksums and lengths, put behind them."""
    n = np.minimum(length, TABLED)
    moved = SHORT_ZEROS[n, 0, crc & 255] ^ SHORT_ZEROS[n, 1, crc >> 8 & 255] ^ SHORT_ZEROS[n, 2, crc >> 16 & 255] ^ SHORT_ZEROS[n, 3, crc >> 24]
    for i in np.flatnonzero(length > TABLED):
        x = crc[i : i + 1]
        for k in range(32):
            if length[i] >> k & 1:
                x = _applied(POWER_ZEROS[k], x)
        moved[i] = x[0]
    return moved ^ crc_after


def word_checksums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """crc32 of each word's bytes: all short words a byte at a time, together; long ones one by one."""
    lengths = ends - starts
    order = np.argsort(-lengths, kind="stable")
    found = np.zeros(len(starts), dtype=np.uint32)
    long = int(np.searchsorted(-lengths[order], -TABLED, side="left"))  # those over TABLED stand first
    for i in order[:long]:
        found[i] = zlib.crc32(data[starts[i] : ends[i]])
    short = order[long:]
    at, size = starts[short], lengths[short]
    state = np.full(len(short), 0xFFFFFFFF, dtype=np.uint32)
    for k in range(int(size[0]) if len(short) else 0):
        n = int(np.searchsorted(-size, -k, side="left"))  # words of more than k bytes
        x = state[:n]
        state[:n] = CRC[(x ^ data[at[:n] + k]) & 255] ^ (x >> 8)
    found[short] = state ^ np.uint32(0xFFFFFFFF)
    return found


def bucket_stream(data: np.ndarray, offsets: np.ndarray, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bucket of each feature, document after document; features and words of each document."""
    data = flat.LOWER[data]
    starts, ends, rows = flat.words(data, offsets, WORD)
    lengths = ends - starts
    crc = word_checksums(data, starts, ends)
    spaced = appended(np.full(len(crc), zlib.crc32(b" "), dtype=np.uint32), crc, lengths)  # of " word"
    last = np.repeat(rows[1:], np.diff(rows))  # behind the last word of a word's document
    runs = np.zeros((len(crc), LONGEST_RUN), dtype=np.uint32)
    inside = np.zeros((len(crc), LONGEST_RUN), dtype=bool)
    runs[:, 0], inside[:, 0] = crc, True
    for n in range(1, LONGEST_RUN):
        k = len(crc) - n
        if k > 0:
            runs[:k, n] = appended(runs[:k, n - 1], spaced[n:], lengths[n:] + 1)
            inside[:k, n] = np.arange(n, len(crc)) < last[:k]
    counts = np.concatenate([[0], np.cumsum(inside.sum(axis=1))])[rows]
    return (runs[inside] % np.uint32(buckets)).astype("<u2"), np.diff(counts), np.diff(rows)


STREAM = "ids array<bigint>, n_features binary, n_words binary, stream binary"


def streams(df: DataFrame, text: str, id_col: str | None = None, buckets: int = BUCKETS) -> DataFrame:
    """A row for each slice of texts: ids, and packed features (int64), words (int64) and buckets (uint16)."""
    if not 0 < buckets <= 1 << 16:
        raise ValueError("buckets are packed into 16 bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat.column_bytes(batch.column(1))
            for first, last, part, at in flat.slices(data, offsets):
                stream, features, words = bucket_stream(part, at, buckets)
                ids = pa.ListArray.from_arrays(pa.array([0, last - first], pa.int32()), batch.column(0).slice(first, last - first))
                row = [ids, *(pa.array([x.tobytes()], pa.binary()) for x in (features.astype("<i8"), words.astype("<i8"), stream))]
                yield pa.RecordBatch.from_arrays(row, names=["ids", "n_features", "n_words", "stream"])

    own = F.col(id_col).cast("long") if id_col else F.lit(None).cast("long")
    return df.select(own.alias("id"), F.col(text)).mapInArrow(run, STREAM)


def run_lengths(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of a sorted stream and how often each stands there."""
    if not len(values):
        return values, np.zeros(0, dtype=np.int64)
    begins = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    return values[begins], np.diff(np.append(begins, len(values)))


def bucket_counts(table: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket stands in all streams; a row for each bucket reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for row in batch.column(0):
                values, n = run_lengths(np.sort(np.frombuffer(row.as_buffer(), dtype="<u2"), kind="stable"))
                total[values] += n
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    got = table.select("stream").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(buckets, dtype=np.int64)
    counts[got["bucket"].to_numpy()] = got["n"].to_numpy()
    return counts


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandfold log ratio of each bucket's share in the target to that in the documents, rounded down."""
    all_raw, all_target = int(raw.sum()) + len(raw), int(target.sum()) + len(target)
    ratio = (target + 1).astype(np.float64) * all_raw / ((raw + 1).astype(np.float64) * all_target)
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weights(table: DataFrame, gain: np.ndarray) -> DataFrame:
    """id, n_features, n_words and weight (the sum of its features' gains) of each document."""
    shared = table.sparkSession.sparkContext.broadcast(gain)  # one number for each bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, *packed in zip(*batch.columns, strict=True):
                features, words, stream = (np.frombuffer(x.as_buffer(), dtype=t) for x, t in zip(packed, ("<i8", "<i8", "<u2"), strict=True))
                weight = np.zeros(len(features), dtype=np.int64)
                some = features > 0
                if some.any():
                    firsts = (np.cumsum(features) - features)[some]
                    weight[some] = np.add.reduceat(shared.value[stream], firsts)
                yield pa.RecordBatch.from_arrays([ids.values, pa.array(features), pa.array(words), pa.array(weight)], names=["id", "n_features", "n_words", "weight"])

    return table.mapInArrow(run, "id long, n_features long, n_words long, weight long")


def gumbel(id_col: Column, seed: int = SEED) -> Column:
    """Thousandfold Gumbel noise of an id, rounded down."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def kth_highest(df: DataFrame, key: str, k: int, bins: int = 4096) -> int | None:
    """The k-th highest value of a column of whole numbers, by narrowing histograms; None where there are fewer."""
    low, high, n = df.agg(F.min(key), F.max(key), F.count(key)).first()
    if not 0 < k <= n:
        return None
    above = 0
    while low < high:
        width = (high - low) // bins + 1
        inside = df.where(F.col(key).between(low, high))
        found = inside.groupBy(F.floor((F.col(key) - F.lit(low)) / F.lit(width)).alias("b")).agg(F.count("*").alias("n")).collect()  # a row for each bin
        for r in sorted(found, key=lambda r: -r["b"]):
            if above + r["n"] >= k:
                low, high = low + r["b"] * width, min(high, low + (r["b"] + 1) * width - 1)
                break
            above += r["n"]
    return low


def resample(df: DataFrame, target: DataFrame, text: str = "text", id_col: str = "doc_id", target_text: str = "text", percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED, buckets: int = BUCKETS) -> DataFrame:
    """id_col, n_features, weight, score, rank and n_words of each document; the rank of those that aren't drawn is null.

    Of the documents with min_words words or more, percent out of a hundred are drawn.
    """
    table = materialise(streams(df, text, id_col, buckets), "bucket-streams")
    gain = gains(bucket_counts(table, buckets), bucket_counts(streams(target, target_text, buckets=buckets), buckets))
    scored = materialise(weights(table, gain).withColumn("score", F.col("weight") + gumbel(F.col("id"), seed)), "target-scores")
    long_enough = F.col("n_words") >= min_words
    k = percent * scored.where(long_enough).count() // 100
    least = kth_highest(scored.where(long_enough), "score", k)
    may = F.lit(False) if least is None else long_enough & (F.col("score") >= F.lit(least))
    # ties at the last place are numbered, too, the smaller ids first, and lose their rank after it
    numbered = dense_ids(scored.where(may), [F.col("score").desc(), "id"], "rank", stored=True).withColumn("rank", F.col("rank") + 1)
    drawn = numbered.withColumn("rank", F.when(F.col("rank") <= F.lit(k), F.col("rank")))
    found = drawn.unionByName(scored.where(~may).withColumn("rank", F.lit(None).cast("long")))
    return found.select(F.col("id").alias(id_col), "n_features", "weight", "score", "rank", "n_words")
