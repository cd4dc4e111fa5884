"""Language-model scoring with a log-bilinear neural model trained by noise-contrastive estimation.

Tokens are lower-cased words and one end per text. Counts of all tokens are gathered over the whole
training part. The HEAD most frequent tokens have vectors of their own; the others share classes by
their last byte and by whether they are pure ASCII. The two tokens before predict a vector
r = E[before] C1 + E[two before] C2; it scores the next token in two steps, its group of GROUP classes
(r Qg + bg) and the class in the group (r Q + b). Both steps are trained in numpy by
noise-contrastive estimation, and then normalised exactly: batched matrix products give all scores of a step,
a log-softmax the log-probabilities. A token's probability is its class's times its smoothed share in the
class, so the probabilities of all tokens (unseen ones are one more of each class) sum to 1.

Training takes every token of the training part once, so its steps grow with the corpus: in each of
ROUNDS rounds the tasks take their texts of the round (a hash of the text deals them) from common parameters on, and the
mean of their parameters, weighted by tokens, is the next round's start. A batch has BATCH tokens; in a corpus of less
than AIMED batches of that size a round it has fewer, so that there are as many, but LEAST_BATCH at least.

A passage is a run of tokens up to one whose hash says that it ends (one in PASSAGE) or to the text's end, so equal
stretches of text fall into equal passages wherever they stand. The counts of all passages of the training part tell how
many of a text's tokens stand in passages of LEAST_PASSAGE tokens or more that another training row has, too
(n_repeated): what occurs twice in the corpus is told apart however rare or common its words are.

Counts of the HOT most frequent tokens go to every task (a table of bounded size); all other tokens
and all passages are looked up by a shuffle join, so the size of neither is limited.

Defined cases: null and empty texts are the end token alone; a null id is a training row; ties in frequency are broken
by the token's hash; repeated rows are scored each (and are each other's repetition); without training rows every token
has its smoothed floor; an empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import flat
from .tables import materialise

HOT = 1 << 18
HEAD = 4032
TAIL = 64
CLASSES = HEAD + TAIL
GROUP = 128
GROUPS = CLASSES // GROUP
ADD = 0.1
END = np.uint64(0x1)
END_CLASS = HEAD - 1
_PASSAGES = np.uint64(0xA24BAED4963EE407)
DIM = 24
BATCH, LEAST_BATCH, AIMED = 8192, 512, 1600
#: Noise groups of a batch, and noise classes of a group in it.
NOISE_GROUPS, NOISE = 16, 16
RATE = 0.1
ROUNDS = 2
#: Parts in which parameters are summed up.
SHARDS = 16
PASSAGE, LEAST_PASSAGE = 16, 4
SEED = 5
NAMES = ("e", "c1", "c2", "q", "b", "qg", "bg")


def tail_class(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of the TAIL shared classes each word would be in."""
    if not len(starts):
        return np.zeros(0, dtype=np.int64)
    wide = np.concatenate([[0], np.cumsum(data >= 0x80)])
    return (data[ends - 1].astype(np.int64) % (TAIL // 2)) * 2 + (wide[ends] > wide[starts])


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and tail class of each token, each row's end token included, and the rows' first tokens (n+1)."""
    lower = flat.LOWER[data]
    starts, ends, rows = flat.words(lower, offsets)
    hashes, tails = flat.word_hashes(lower, starts, ends), tail_class(lower, starts, ends)
    at = rows[1:]
    return np.insert(hashes, at, END), np.insert(tails, at, 0), rows + np.arange(len(rows))


def passages(h: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, row and tokens of each passage of LEAST_PASSAGE tokens or more."""
    ends = (flat.mix(h ^ _PASSAGES) & np.uint64(PASSAGE - 1)) == 0
    ends[rows[1:] - 1] = True
    start = np.concatenate([[0], np.flatnonzero(ends)[:-1] + 1]) if len(h) else np.zeros(0, np.int64)
    size = np.diff(np.append(start, len(h)))
    if not len(start):
        return np.zeros(0, np.uint64), start, size
    place = np.arange(len(h)) - np.repeat(start, size)
    total = flat.mix(np.add.reduceat(h * flat.powers(int(size.max()) + 1)[place], start) + size.astype(np.uint64))
    long = np.flatnonzero(size >= LEAST_PASSAGE)
    return total[long], np.searchsorted(rows, start[long], side="right") - 1, size[long]


def held_out(id_col: str):
    return F.coalesce(F.pmod(F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")), F.lit(10)) == 0, F.lit(False))


def token_table(texts: DataFrame) -> DataFrame:
    """h, tail and n of every distinct token of the texts, and of every distinct passage with -1 as its tail."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def merge() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            h, t, n = (np.concatenate(x) for x in zip(*held, strict=True))
            u, first, inverse = np.unique(h, return_index=True, return_inverse=True)
            return u, t[first], np.bincount(inverse, weights=n, minlength=len(u)).astype(np.int64)

        def out(h: np.ndarray, t: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(t.astype(np.int32)), pa.array(n)], names=["h", "tail", "n"])

        for batch in batches:
            data, offsets = flat.column_bytes(batch.column(0))
            for _, _, part, at in flat.slices(data, offsets):
                h, t, rows = tokens(part, at)
                u, first, n = np.unique(h, return_index=True, return_counts=True)
                held.append((u, t[first], n))
                p, m = np.unique(passages(h, rows)[0], return_counts=True)
                held.append((p, np.full(len(p), -1), m))
                size += len(u) + len(p)
                if size > 1 << 20:
                    held = [merge()]
                    size = len(held[0][0])
                    if size > 1 << 19:
                        yield out(*held[0])
                        held, size = [], 0
        if held:
            yield out(*merge())

    return texts.mapInArrow(run, "h long, tail int, n long").groupBy("h").agg(F.first("tail").alias("tail"), F.sum("n").alias("n"))


def hot_tokens(table: DataFrame, most: int = HOT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """h, n and tail of the tokens above the lowest step of counts that leaves at most `most`; by descending count."""
    step = F.floor(F.log2(F.col("n")) * 16).cast("int")
    counted = table.groupBy(step.alias("step")).agg(F.count("*").alias("rows")).collect()  # some hundreds of rows
    total, least = 0, None
    for r in sorted(counted, key=lambda r: -r["step"]):
        if total + r["rows"] > most:
            break
        total, least = total + r["rows"], r["step"]
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    got = table.where(step >= least).toArrow()
    h, n, tail = got["h"].to_numpy().view(np.uint64), got["n"].to_numpy(), got["tail"].to_numpy().astype(np.int64)
    order = np.lexsort((h, -n))
    return h[order], n[order], tail[order]


class Classes:
    """Class of each token, and the counts of the hot ones."""

    def __init__(self, h: np.ndarray, n: np.ndarray, tail: np.ndarray):
        kind = np.where(np.arange(len(h)) < END_CLASS, np.arange(len(h)), HEAD + tail)
        kind[h == END] = END_CLASS
        order = np.argsort(h)
        self.h, self.n, self.kind = h[order], n[order], kind[order].astype(np.int32)

    def of(self, h: np.ndarray, tail: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class of each token, and its count (-1 where it is not a hot token)."""
        if not len(self.h):
            return np.where(h == END, END_CLASS, HEAD + tail), np.full(len(h), -1, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.h, h), len(self.h) - 1)
        hit = self.h[at] == h
        return np.where(hit, self.kind[at], np.where(h == END, END_CLASS, HEAD + tail)), np.where(hit, self.n[at], -1)


    def streams(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Class of the token two before each token, of the one before it, and of the token itself; ends stand before a text."""
        h, tail, rows = tokens(data, offsets)
        kind = self.of(h, tail)[0].astype(np.int64)
        return *before(kind, rows), kind


def before(kind: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Classes two before and one before each token of the rows."""
    one = np.concatenate([[END_CLASS], kind])[: len(kind)]
    two = np.concatenate([[END_CLASS, END_CLASS], kind])[: len(kind)]
    two[rows[:-1]] = END_CLASS
    return two, one


def initial(counts: np.ndarray, seed: int = SEED) -> dict[str, np.ndarray]:
    """Parameters before training: small vectors, and the classes' shares as they were counted."""
    rng = np.random.default_rng(seed)
    share, group = shares(counts)
    p = {"e": rng.normal(0, 0.1, (CLASSES, DIM)), "c1": np.eye(DIM), "c2": 0.5 * np.eye(DIM), "q": rng.normal(0, 0.1, (CLASSES, DIM)), "b": np.log(share), "qg": rng.normal(0, 0.1, (GROUPS, DIM)), "bg": np.log(group)}
    return {k: v.astype(np.float32) for k, v in p.items()}


def shares(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smoothed share of each class in its group, and of each group."""
    held = (counts + ADD).reshape(GROUPS, GROUP)
    groups = held.sum(axis=1)
    return (held / groups[:, None]).ravel(), groups / groups.sum()


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _runs(index: np.ndarray) -> np.ndarray:
    """Where equal values of a sorted index begin."""
    return np.flatnonzero(np.concatenate([[True], index[1:] != index[:-1]]))


def _summed(index: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """Sum of the rows by index."""
    order = np.argsort(index.astype(np.uint16), kind="stable")  # a radix sort
    found = index[order]
    starts = _runs(found)
    out = np.zeros((size, rows.shape[1]), rows.dtype)
    out[found[starts]] = np.add.reduceat(rows[order], starts, axis=0)
    return out


def loss_and_gradients(p: dict, log_share: np.ndarray, log_group: np.ndarray, two: np.ndarray, one: np.ndarray, kind: np.ndarray, noise_groups: np.ndarray, noise: np.ndarray, want_loss: bool = True) -> tuple[float, dict]:
    """Noise-contrastive loss of a batch in both steps (0 unless it is wanted), and its gradients.

    noise_groups has the noise of the first step, noise (groups, n) the noise classes of each group.
    """
    size, loss = len(kind), 0.0
    order = np.argsort(kind.astype(np.uint16), kind="stable")
    two, one, kind = two[order], one[order], kind[order]
    e1, e2 = p["e"][one], p["e"][two]
    r = e1 @ p["c1"] + e2 @ p["c2"]
    g = {k: np.zeros_like(v) for k, v in p.items()}
    group = kind // GROUP
    # first step
    log_k = np.float32(np.log(len(noise_groups)))
    true = np.einsum("bd,bd->b", r, p["qg"][group]) + (p["bg"] - log_group)[group] - log_k
    false = r @ p["qg"][noise_groups].T + ((p["bg"] - log_group)[noise_groups] - log_k)
    if want_loss:
        loss += np.logaddexp(0, -true).sum(dtype=np.float64) + np.logaddexp(0, false).sum(dtype=np.float64)
    d_true, d_false = (_sigmoid(true) - 1) / size, _sigmoid(false) / size
    d_r = d_true[:, None] * p["qg"][group] + d_false @ p["qg"][noise_groups]
    starts = _runs(group)
    g["qg"][group[starts]] += np.add.reduceat(d_true[:, None] * r, starts, axis=0)
    np.add.at(g["qg"], noise_groups, d_false.T @ r)
    g["bg"][group[starts]] += np.add.reduceat(d_true, starts)
    np.add.at(g["bg"], noise_groups, d_false.sum(axis=0))
    # second step
    log_k = np.float32(np.log(noise.shape[1]))
    extra = p["b"] - log_share - log_k
    own = p["q"][kind]
    true = np.einsum("bd,bd->b", r, own) + extra[kind]
    if want_loss:
        loss += np.logaddexp(0, -true).sum(dtype=np.float64)
    d_true = (_sigmoid(true) - 1) / size
    own *= d_true[:, None]
    d_r += own
    starts = _runs(kind)
    g["q"][kind[starts]] += np.add.reduceat(d_true[:, None] * r, starts, axis=0)
    g["b"][kind[starts]] += np.add.reduceat(d_true, starts)
    ends = np.searchsorted(group, np.arange(GROUPS + 1))
    for k in np.flatnonzero(np.diff(ends)).tolist():
        rows, z = r[ends[k] : ends[k + 1]], noise[k]
        qz = p["q"][z]
        false = rows @ qz.T + extra[z]
        if want_loss:
            loss += np.logaddexp(0, false).sum(dtype=np.float64)
        d_false = _sigmoid(false) / size
        d_r[ends[k] : ends[k + 1]] += d_false @ qz
        np.add.at(g["q"], z, d_false.T @ rows)
        np.add.at(g["b"], z, d_false.sum(axis=0))
    g["c1"] += e1.T @ d_r
    g["c2"] += e2.T @ d_r
    g["e"] += _summed(np.concatenate([one, two]), np.concatenate([d_r @ p["c1"].T, d_r @ p["c2"].T]), CLASSES)
    return float(loss / size), g


class Learner:
    """Batches of a token stream, one after the other, by AdaGrad steps."""

    def __init__(self, p: dict, counts: np.ndarray, batch: int = BATCH, seed: int = SEED):
        self.batch = batch
        share, group = shares(counts)
        self.p = {k: v.copy() for k, v in p.items()}
        self.log_share, self.log_group = np.log(share).astype(np.float32), np.log(group).astype(np.float32)
        self.reach, self.group_reach = np.cumsum(share.reshape(GROUPS, GROUP), axis=1), np.cumsum(group)
        self.square = {k: np.full_like(v, 1e-6) for k, v in p.items()}
        self.rng = np.random.default_rng(seed)
        self.rest: list[np.ndarray] | None = None
        self.seen = self.steps = 0

    def step(self, two: np.ndarray, one: np.ndarray, kind: np.ndarray) -> None:
        draw = self.rng.random
        groups = np.minimum(np.searchsorted(self.group_reach, draw(NOISE_GROUPS) * self.group_reach[-1], side="right"), GROUPS - 1)
        u = draw((GROUPS, NOISE)) * self.reach[:, -1:]
        noise = np.minimum((self.reach[:, None, :] <= u[:, :, None]).sum(axis=2), GROUP - 1) + np.arange(GROUPS)[:, None] * GROUP
        _, g = loss_and_gradients(self.p, self.log_share, self.log_group, two, one, kind, groups, noise, want_loss=False)
        self.steps += 1
        for k, v in self.p.items():
            self.square[k] += g[k] * g[k]
            v -= RATE * g[k] / np.sqrt(self.square[k])

    def take(self, two: np.ndarray, one: np.ndarray, kind: np.ndarray) -> None:
        now = np.stack([two, one, kind]) if self.rest is None else np.concatenate([self.rest, [two, one, kind]], axis=1)
        self.seen += len(kind)
        whole = now.shape[1] // self.batch * self.batch
        for first in range(0, whole, self.batch):
            self.step(*now[:, first : first + self.batch])
        self.rest = now[:, whole:].copy()

    def finish(self) -> None:
        """The last tokens, as a batch of their own."""
        if self.rest is not None and self.rest.shape[1]:
            self.step(*self.rest)
        self.rest = None


def flat_parameters(p: dict) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in NAMES])


def shaped_parameters(values: np.ndarray, like: dict) -> dict:
    out, at = {}, 0
    for k in NAMES:
        out[k] = values[at : at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out


def train(training: DataFrame, text: str, classes: Classes, counts: np.ndarray, rounds: int = ROUNDS) -> dict:
    """Parameters after all tokens of training, by rounds of local steps and weighted means."""
    p = initial(counts)
    context = training.sparkSession.sparkContext
    per_step = int(min(BATCH, max(LEAST_BATCH, counts.sum() / (AIMED * max(1, rounds)))))
    size = -(-sum(v.size for v in p.values()) // SHARDS)
    for number in range(rounds):
        shared = context.broadcast((classes, p, counts))  # of fixed size

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own, start, seen = shared.value
            learner = Learner(start, seen, per_step)
            for batch in batches:
                data, offsets = flat.column_bytes(batch.column(0))
                for _, _, part, at in flat.slices(data, offsets):
                    learner.take(*own.streams(part, at))
            learner.finish()
            if learner.seen:
                moved = (flat_parameters(learner.p) - flat_parameters(start)).astype(np.float64) * learner.seen
                parts = [moved[k * size : (k + 1) * size].tobytes() for k in range(SHARDS)]
                yield pa.RecordBatch.from_arrays([pa.array(range(SHARDS), pa.int32()), pa.array([learner.seen] * SHARDS, pa.int64()), pa.array(parts, pa.binary())], names=["shard", "weight", "sum"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[int, list] = {}
            for batch in batches:
                for k, w, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                    total = held.setdefault(k, [0, 0.0])
                    total[0] += w
                    total[1] = total[1] + np.frombuffer(raw.as_buffer(), np.float64)
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([v[0] for v in held.values()], pa.int64()), pa.array([v[1].tobytes() for v in held.values()], pa.binary())], names=["shard", "weight", "sum"])

        schema = "shard int, weight long, sum binary"
        mine = training.where(F.pmod(F.xxhash64(text, F.lit(SEED)), F.lit(rounds)) == number).select(text)
        found = mine.mapInArrow(run, schema).repartition(SHARDS, "shard").mapInArrow(add, schema).collect()  # SHARDS rows of fixed size
        if found:
            moved = np.concatenate([np.frombuffer(bytes(r["sum"]), np.float64) / r["weight"] for r in sorted(found, key=lambda r: r["shard"])])
            p = shaped_parameters(flat_parameters(p) + moved, p)
    return p


def _normalised(scores: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Log-softmax of each row at one place."""
    own = scores[np.arange(len(at)), at]
    if max(scores.max(), -scores.min()) > 60:  # exp() would leave the range of its type
        top = scores.max(axis=1, keepdims=True)
        own, scores = own - top[:, 0], scores - top
    return own - np.log(np.exp(scores) @ np.ones(scores.shape[1], scores.dtype))


class Scorer:
    """Log-probabilities (natural) of classes after two others."""

    def __init__(self, p: dict):
        self.one, self.two = p["e"] @ p["c1"], p["e"] @ p["c2"]
        self.q = [np.ascontiguousarray(p["q"][k * GROUP : (k + 1) * GROUP].T) for k in range(GROUPS)]
        self.b, self.qg, self.bg = p["b"].reshape(GROUPS, GROUP), np.ascontiguousarray(p["qg"].T), p["bg"]

    def of(self, two: np.ndarray, one: np.ndarray, kind: np.ndarray) -> np.ndarray:
        out = np.empty(len(kind), np.float32)
        for first in range(0, len(kind), 1 << 15):
            part = slice(first, first + (1 << 15))
            r, group, place = self.one[one[part]] + self.two[two[part]], kind[part] // GROUP, kind[part] % GROUP
            found = _normalised(r @ self.qg + self.bg, group)
            order = np.argsort(group.astype(np.uint16), kind="stable")
            r, place = r[order], place[order]
            ends = np.searchsorted(group[order], np.arange(GROUPS + 1))
            inside = np.empty(len(order), np.float32)
            for k in np.flatnonzero(np.diff(ends)).tolist():
                own = slice(ends[k], ends[k + 1])
                inside[own] = _normalised(r[own] @ self.q[k] + self.b[k], place[own])
            found[order] += inside
            out[part] = found
        return out


def score(documents: DataFrame, id_col: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """id_col, held_out, n_tokens, n_known, train_tokens, base_score, score and n_repeated of every row."""
    training = documents.where(~held_out(id_col)).select(text)
    both = materialise(token_table(training), "tokens")
    table = both.where("tail >= 0")
    known, total = table.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    classes = Classes(*hot_tokens(table))

    # counts of the classes; those of the tail without the tokens that are classes of their own
    counts = np.zeros(CLASSES)
    own = classes.kind < HEAD
    counts[classes.kind[own]] = classes.n[own]
    heads = table.sparkSession.createDataFrame(pa.table({"h": classes.h[own].view(np.int64)})) if own.any() else None
    rest = table.join(F.broadcast(heads), "h", "left_anti") if heads is not None else table  # at most HEAD rows
    tail_v = np.zeros(TAIL)
    for r in rest.where(F.col("h") != F.lit(int(END))).groupBy("tail").agg(F.count("*").alias("v"), F.sum("n").alias("n")).collect():
        counts[HEAD + r["tail"]], tail_v[r["tail"]] = r["n"], r["v"]
    tail_log = np.log10(counts[HEAD:] + ADD * (tail_v + 1))
    base_log = float(np.log10(total + ADD * (known + 1)))
    model = train(training, text, classes, counts, rounds)

    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast((classes, Scorer(model), tail_log))  # of fixed size
    fields = [("uid", T.LongType()), ("id", documents.schema[id_col].dataType), ("held_out", T.BooleanType()), ("n_tokens", T.LongType()), ("n_known", T.LongType()), ("base_score", T.DoubleType()), ("score", T.DoubleType()), ("h", T.ArrayType(T.LongType())), ("times", T.ArrayType(T.IntegerType())), ("size", T.ArrayType(T.IntegerType()))]
    schema = T.StructType([T.StructField(*f) for f in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_classes, scorer, tails = shared.value
        # written out before it is used, so a task that runs again does not change numbers in use
        uid = int.from_bytes(os.urandom(8), "little") >> 1
        for batch in batches:
            data, offsets = flat.column_bytes(batch.column(2))
            for first, last, part, at in flat.slices(data, offsets):
                h, tail, rows = tokens(part, at)
                kind, n = own_classes.of(h, tail)
                kind = kind.astype(np.int64)
                hot = n >= 0
                log_n = np.where(hot, np.log10(np.maximum(n, 0) + ADD), 0.0)
                base = log_n - base_log
                # log_n of the other tokens follows after the join
                inside = np.where(kind >= HEAD, log_n - tails[np.maximum(kind - HEAD, 0)], 0.0)
                found = scorer.of(*before(kind, rows), kind) / np.log(10) + inside
                sums = [np.add.reduceat(x, rows[:-1]) for x in (hot.astype(np.int64), base, found)]
                # what is left to look up: tokens that are not hot (of size 0) and passages
                cold = np.flatnonzero(~hot)
                ph, prow, psize = passages(h, rows)
                row = np.concatenate([np.searchsorted(rows, cold, side="right") - 1, prow])
                key, width = np.concatenate([h[cold], ph]), np.concatenate([np.zeros(len(cold), np.int64), psize])
                order = np.lexsort((key, row))
                row, key, width = row[order], key[order], width[order]
                new = np.concatenate([[True], (row[1:] != row[:-1]) | (key[1:] != key[:-1])]) if len(row) else np.zeros(0, bool)
                where = np.flatnonzero(new)
                times = np.diff(np.append(where, len(row))).astype(np.int32)
                ends = pa.array(np.searchsorted(row[where], np.arange(last - first + 1)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (key[where].view(np.int64), times, width[where].astype(np.int32))]
                ids = (np.arange(last - first, dtype=np.uint64) + np.uint64(uid)).view(np.int64)
                uid = (uid + last - first) & (2**63 - 1)
                size = last - first
                yield pa.RecordBatch.from_arrays([pa.array(ids), batch.column(0).slice(first, size), batch.column(1).slice(first, size), pa.array(np.diff(rows)), *[pa.array(x) for x in sums], *lists], names=schema.names)

    scored = materialise(documents.select(F.col(id_col), held_out(id_col).alias("held_out"), F.col(text)).mapInArrow(run, schema), "scored")
    cold = scored.where(F.size("h") > 0).select("uid", "held_out", F.inline(F.arrays_zip("h", "times", "size")))
    found = cold.join(both.select("h", "n"), "h", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    token = F.col("size") == 0
    elsewhere = F.col("n") > F.when(F.col("held_out"), F.lit(0)).otherwise(F.col("times"))
    extra = found.groupBy("uid").agg(
        F.sum(F.when(token, F.col("times") * F.log10(F.col("n") + F.lit(ADD)))).alias("log_n"),
        F.sum(F.when(token & (F.col("n") > 0), F.col("times"))).alias("known"),
        F.sum(F.when(~token & elsewhere, F.col("times") * F.col("size"))).alias("repeated"),
    )
    joined = scored.drop("h", "times", "size").join(extra, "uid", "left")
    none = F.lit(0)
    return joined.select(
        F.col("id").alias(id_col),
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", none)).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("log_n", none)).alias("base_score"),
        (F.col("score") + F.coalesce("log_n", none)).alias("score"),
        F.coalesce("repeated", none).cast("long").alias("n_repeated"),
    )
