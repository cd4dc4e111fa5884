"""Quality classifier by importance resampling.

Generative models over hashed n-grams are compared, all with one additive smoothing: the raw corpus
(counted over all of it, in proportion), the target (labelled rows of good quality that are not toxic)
and toxic text. Words and word pairs carry the quality ratio log p_target/q_raw, the mean over the
text's n-grams; word beginnings carry the toxic ratio log p_toxic/q_raw, by texts that have them,
of which only clear evidence (above TOXIC_RATIO) counts, summed over the text and divided by the root of
its words, with which chance hits grow. The n-grams of a text are not independent, so the sums
overstate: a temperature and an offset for each ratio are fitted by logistic regression on
labelled rows, each half of them scored by the models of the other. The log importance weight of a text is its log ratio a
of the target to raw text; where it has evidence of toxic text, the log ratio of the target to raw and toxic text
together, -log(exp(-a) + exp(-b)) with the log ratio b of the target to toxic text. Gumbel noise from a hash of the id is added and the k rows with the largest keys are kept:
what is clearly of the target stays, what is clearly not goes, and rows near the edge are drawn.
k is a parameter; by default it is the number of rows with a weight of 0 or more. The k-th key is found
by histogram refinement, never by a sort.

At most LABELLED rows of labels (those with the smallest id hash) are used; this is the only bound.

Defined cases: a null or empty text has ratios of 0 and the weight 0, so it is drawn like a row at the edge;
rows with the same id have the same noise, and ties at the k-th key are all kept; without labels of a
class its ratio is left out, without any all rows have the weight 0 and the default k keeps them all; an
empty table gives an empty one; further columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import flat
from .tables import materialise

LABELLED = 20_000
WORD_BUCKETS = 1 << 18
BEGIN_BUCKETS = 1 << 16
BEGIN_BYTES = 4
TOXIC_RATIO = 1.0
#: Weight of the squared slope in the regressions, which keeps them finite where classes don't overlap.
RIDGE = 0.01
SEED = 17
SCORES = ("__n_words", "__quality_ratio", "__toxic_ratio")


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of each word, of each pair (-1 for a row's last word) and of each word's beginning, and rows' first words."""
    starts, ends, rows = flat.words(data, offsets)
    hashes = flat.word_hashes(data, starts, ends)
    word = (hashes & np.uint64(WORD_BUCKETS - 1)).astype(np.int64)
    pair = np.full(len(word), -1, dtype=np.int64)
    if len(word) > 1:
        pair[:-1] = (flat.windows(hashes, 2) & np.uint64(WORD_BUCKETS - 1)).astype(np.int64)
    lasts = rows[1:][np.diff(rows) > 0] - 1
    pair[lasts] = -1
    begin = flat.word_hashes(flat.LOWER[data], starts, np.minimum(ends, starts + BEGIN_BYTES))
    return word, pair, (begin & np.uint64(BEGIN_BUCKETS - 1)).astype(np.int64), rows


def labelled_rows(labels: DataFrame, most: int = LABELLED) -> DataFrame:
    """At most `most` labels, a fixed sample by id hash: doc_id, class (1 good, 2 toxic, 3 other), half."""
    kind = F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 1, 1).otherwise(3)
    h = F.xxhash64(F.col("doc_id"), F.lit(SEED))
    return labels.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("__id"), kind.alias("__class"), h.alias("__h")).orderBy("__h", "__id").limit(most).select("__id", "__class", F.pmod("__h", F.lit(2)).alias("__half"))


def model_counts(documents: DataFrame, sample: DataFrame) -> np.ndarray:
    """Counts by model and bucket; the last column counts rows.

    Model 0: all rows; 1 and 2: the two halves of the good ones; 3 and 4: those of the toxic ones.
    """
    width = WORD_BUCKETS + BEGIN_BUCKETS + 1
    # the sample is bounded by its parameter, so it may be sent to all executors
    rows = documents.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("__id"), "left")
    rows = rows.select("text", F.when(F.col("__class") < 3, F.col("__class") * 2 - 1 + F.col("__half")).cast("int").alias("model"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((5, width), dtype=np.int64)
        for batch in batches:
            models = batch.column(1).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            data, offsets = flat.column_bytes(batch.column(0))
            for first, last, part, at in flat.slices(data, offsets):
                word, pair, begin, starts = features(part, at)
                row = np.repeat(np.arange(last - first), np.diff(starts))
                once = np.unique(row * BEGIN_BUCKETS + begin)
                row_once, once = once // BEGIN_BUCKETS, once % BEGIN_BUCKETS
                mine = models[first:last]
                for k in {0, *mine.tolist()}:
                    every = k == 0
                    w, p, b = (word, pair, once) if every else (word[mine[row] == k], pair[mine[row] == k], once[mine[row_once] == k])
                    counts[k, :WORD_BUCKETS] += np.bincount(w, minlength=WORD_BUCKETS) + np.bincount(p[p >= 0], minlength=WORD_BUCKETS)
                    counts[k, WORD_BUCKETS:-1] += np.bincount(b, minlength=BEGIN_BUCKETS)
            counts[0, -1] += len(models)
            counts[1:, -1] += np.bincount(models, minlength=5)[1:]
        at = np.flatnonzero(counts.ravel())
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(counts.ravel()[at])], names=["at", "n"])

    summed = rows.mapInArrow(run, "at int, n long").groupBy("at").agg(F.sum("n").alias("n"))
    got = summed.toArrow()  # at most 5 * width rows, whatever the corpus
    counts = np.zeros(5 * width, dtype=np.float64)
    counts[got["at"].to_numpy()] = got["n"].to_numpy()
    return counts.reshape(5, width)


def ratios(raw: np.ndarray, good: np.ndarray, evil: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log ratio of target to raw for each word bucket, and of toxic to raw for each beginning."""

    def ratio(target: np.ndarray, expected: np.ndarray, strength: float) -> np.ndarray:
        return np.log((target + strength) / (expected + strength)).astype(np.float32)

    words, begins = slice(0, WORD_BUCKETS), slice(WORD_BUCKETS, -1)
    quality = toxic = None
    if good[-1] and raw[words].sum():
        quality = ratio(good[words], raw[words] * (good[words].sum() / raw[words].sum()), 2.0)
    if evil[-1]:
        toxic = ratio(evil[begins], raw[begins] * (evil[-1] / raw[-1]), max(2.0, evil[-1] / 400))
        toxic = np.where(toxic > TOXIC_RATIO, toxic, 0).astype(np.float32)
    none = np.zeros(1, dtype=np.float32)
    return np.resize(none, WORD_BUCKETS) if quality is None else quality, np.resize(none, BEGIN_BUCKETS) if toxic is None else toxic


def score(df: DataFrame, text: str, quality: np.ndarray, toxic: np.ndarray) -> DataFrame:
    """df with SCORES (words, quality ratio, toxic ratio) as further columns."""
    spark = df.sparkSession
    tables = spark.sparkContext.broadcast((quality, toxic))  # of fixed size
    column = df.columns.index(text)
    schema = T.StructType([*df.schema.fields, T.StructField(SCORES[0], T.LongType()), T.StructField(SCORES[1], T.DoubleType()), T.StructField(SCORES[2], T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        good, bad = tables.value
        good = np.append(good, np.float32(0))  # place -1: no pair
        for batch in batches:
            n = np.zeros(batch.num_rows, dtype=np.int64)
            means = np.zeros((2, batch.num_rows))
            data, offsets = flat.column_bytes(batch.column(column))
            for first, last, part, at in flat.slices(data, offsets):
                word, pair, begin, starts = features(part, at)
                count = np.diff(starts)
                n[first:last] = count
                both = np.cumsum(np.concatenate([[0], good[word].astype(np.float64) + good[pair]]))
                evil = np.cumsum(np.concatenate([[0], bad[begin].astype(np.float64)]))
                means[0, first:last] = (both[starts[1:]] - both[starts[:-1]]) / np.maximum(1, 2 * count - 1)
                means[1, first:last] = (evil[starts[1:]] - evil[starts[:-1]]) / np.sqrt(np.maximum(1, count))
            arrays = [*batch.columns, pa.array(n), pa.array(means[0]), pa.array(means[1])]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return df.mapInArrow(run, schema)


def calibrated(low: np.ndarray, high: np.ndarray) -> tuple[float, float] | None:
    """Slope and offset that make a ratio the log odds of class high to class low, by Newton steps."""
    if not len(low) or not len(high):
        return None
    x = np.concatenate([low, high])
    y = np.concatenate([np.zeros(len(low)), np.ones(len(high))])
    mean, spread = x.mean(), x.std() + 1e-9
    z = np.stack([(x - mean) / spread, np.ones(len(x))], axis=1)
    held = np.diag([RIDGE, 1e-9])
    w = np.zeros(2)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -500, 500)))
        g = z.T @ (p - y) + held @ w
        w -= np.clip(np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + held, g), -3, 3)
    return float(w[0] / spread), float(w[1] - w[0] * mean / spread)


def fit(documents: DataFrame, labels: DataFrame, most: int = LABELLED) -> dict:
    """Everything scoring needs: the ratio tables, and slope and offset of both."""
    sample = materialise(labelled_rows(labels, most), "labelled")
    counts = model_counts(documents, sample)
    kind, q, t = [], [], []
    for half in (0, 1):
        models = ratios(counts[0], counts[2 - half], counts[4 - half])
        held = documents.select("doc_id", "text").join(F.broadcast(sample.where(F.col("__half") == half)), F.col("doc_id") == F.col("__id")).select("text", "__class")
        got = score(held, "text", *models).select("__class", *SCORES).toArrow()  # at most `most` rows
        kind, q, t = ([*x, *got[c].to_numpy()] for x, c in ((kind, "__class"), (q, SCORES[1]), (t, SCORES[2])))
    kind, q, t = (np.array(x) for x in (kind, q, t))
    quality, toxic = ratios(counts[0], counts[1] + counts[2], counts[3] + counts[4])
    return {"quality": quality, "toxic": toxic, "q": calibrated(q[kind == 3], q[kind == 1]), "t": calibrated(t[kind == 2], t[kind == 1])}


def log_weight(model: dict) -> Column:
    """Log ratio of the target to raw and toxic text."""
    found = [F.lit(model[k][0]) * F.col(c) + F.lit(model[k][1]) for k, c in (("q", SCORES[1]), ("t", SCORES[2])) if model[k]]
    if not found:
        return F.lit(0.0)
    weight = found[0]
    if len(found) == 2:  # without toxic evidence the toxic ratio would be one and the same, and cap the weight
        weight = F.when(F.col(SCORES[2]) > 0, F.least(*found) - F.log1p(F.exp(-F.abs(found[0] - found[1])))).otherwise(weight)
    return F.when(F.col(SCORES[0]) == 0, F.lit(0.0)).otherwise(weight)


def gumbel(id_col: Column, seed: int = SEED) -> Column:
    u = (F.xxhash64(id_col, F.lit(seed), F.lit("gumbel")).bitwiseAND(F.lit((1 << 52) - 1)) + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.log(-F.log(u))


def kth_largest(df: DataFrame, key: str, k: int, bins: int = 1024) -> float:
    """The k-th largest value of a double column, by narrowing histograms; bins rows reach the driver at a time.

    Infinite keys and those that are no numbers don't count, so that the bins stay finite.
    """
    df = df.where(F.col(key).between(-1.7976931348623157e308, 1.7976931348623157e308))
    low, high = df.agg(F.min(key), F.max(key)).first()
    if k <= 0 or low is None:
        return float("inf")
    above = 0
    while low < high:
        width = (high - low) / bins
        place = F.least(F.lit(bins - 1), F.floor((F.col(key) - F.lit(low)) / F.lit(width)).cast("int"))
        inside = df.where((F.col(key) >= F.lit(low)) & (F.col(key) <= F.lit(high)))
        found = inside.groupBy(place.alias("b")).agg(F.count("*").alias("n"), F.min(key).alias("low"), F.max(key).alias("high")).collect()
        for r in sorted(found, key=lambda r: -r["b"]):
            if above + r["n"] >= k:
                low, high = r["low"], r["high"]
                break
            above += r["n"]
        else:
            return low
    return low


def resample(documents: DataFrame, labels: DataFrame, most: int = LABELLED, k: int | None = None) -> tuple[DataFrame, float]:
    """All rows of documents with SCORES, __log_weight and __gumbel_key, and the key that the kept rows reach."""
    model = fit(documents, labels, most)

    def keyed(df: DataFrame) -> DataFrame:
        weighted = score(df, "text", model["quality"], model["toxic"]).withColumn("__log_weight", log_weight(model))
        return weighted.withColumn("__gumbel_key", F.col("__log_weight") + gumbel(F.col("doc_id")))

    light = materialise(keyed(documents.select("doc_id", "text")).select("__log_weight", "__gumbel_key"), "gumbel-keys")
    if k is None:
        k = light.where("__log_weight >= 0").count()
    return keyed(documents), kth_largest(light, "__gumbel_key", k)


def keep(documents: DataFrame, labels: DataFrame, most: int = LABELLED, k: int | None = None) -> DataFrame:
    """The rows of documents that are kept, with their columns as they were."""
    scored, least = resample(documents, labels, most, k)
    return scored.where(F.col("__gumbel_key") >= F.lit(least)).select(documents.columns)


def kept_scores(documents: DataFrame, labels: DataFrame, most: int = LABELLED, k: int | None = None) -> DataFrame:
    """doc_id, n_words, quality_ratio, toxic_ratio, log_weight and gumbel_key of the rows that are kept."""
    scored, least = resample(documents.select("doc_id", "text"), labels, most, k)
    names = [*SCORES, "__log_weight", "__gumbel_key"]
    return scored.where(F.col("__gumbel_key") >= F.lit(least)).select("doc_id", *[F.col(n).alias(n.strip("_")) for n in names])
