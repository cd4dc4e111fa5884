"""N-gram Jaccard self-join by a size-aware heavy-light join, and the components of its links.

Each document is the set of its distinct word shingles. All shingles have one global order: by their
count in a fixed-size counting sketch over all documents, then by hash, so that what many
documents share comes last. Two sets that are similar enough share at least c shingles among the
first k+c of each, k being how many a set may lack.

- Light sets (up to a boundary) enumerate all subsets of c = 2 of these as keys.
- Heavy sets post their first k+1 shingles to inverted lists, which are scanned; so do light sets
  near enough to the boundary to link with a heavy one.
- The boundary is the one with the least cost by the histogram of set sizes.

Equal sets are one class from the start; a class has a number of its own, given where the classes are
written, so rows that share an id stay apart. A key of more than BLOCK classes has its list dealt by a
hash into blocks of about half of that, each a list like any other. Inside a list the symmetric
difference of two sets is bounded from below by the difference of their parity bitmaps. A list gives
a spanning forest over the pairs within that bound, not all pairs: what is linked through the forest
needs no further link. The forest's edges are verified on the exact sets. As the many lists of one
large group of near copies would find the same links again, a first round looks at each class's
longest list only, and the second round at all lists, but only at pairs between components found so
far. Then every list with an edge that failed gives all pairs within the bound between components, and
those are verified too: no pair within the bound lies between two trees of a list's forest, so no
link is lost. Last come the pairs between two blocks of one key: only classes outside the key's
largest component are held against the key's blocks, which is nothing at all where the blocks of a group
of copies have come together. A key whose many sets don't link costs pairs of blocks, in tasks of bounded size.

Defined cases: a null text, or one without words, is the empty set and linked with nothing; a text
of fewer words than a shingle is one shingle; rows with the same id are documents of their own, each
linked by its own text; a row without an id links as others do, and its component is named by the
smallest id there is in it (null where there is none). Ties in the order of shingles are broken by their hash;
an empty table gives an empty one; other columns are not read. Shingles and sets are compared by 64-bit and
128-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from . import flat
from .tables import free_name, let_through, materialise, without

SKETCH_BITS = 18
#: Bits of a set's parity bitmap, below LARGE shingles and from there on; the larger folds to the smaller.
BITMAP_BITS, LARGE_BITS = 1024, 8192
LARGE = 2000
SUBSET = 2
BLOCK = 512
#: Up to so many hot keys (of more than BLOCK classes) are sent to every task.
FEW_HOT = 1 << 16
#: Up to so many links are joined by one task in memory; beyond, by alternating stars over all executors.
FEW_LINKS = 1 << 20
#: Cost of reading one entry of an inverted list, when making one subset's key costs 1.
SCAN_COST = 4.0
_SALT = np.uint64(0xA0761D6478BD642F)


@dataclass(frozen=True)
class Measure:
    """Shingles of so many words; sets link from a Jaccard similarity of num/den on."""

    words: int = 3
    num: int = 9
    den: int = 10

    def lacking(self, n):
        """How many of its n shingles a set may lack in a set it links with."""
        return n - -(-self.num * n // self.den)

    @property
    def least(self) -> int:
        """Sets of fewer shingles link only with equal ones."""
        return -(-self.num // (self.den - self.num))

    def difference(self, total):
        """Largest symmetric difference of two linked sets with so many shingles in all."""
        return total * (self.den - self.num) // (self.den + self.num)


def row_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row."""
    starts, ends, rows = flat.words(data, offsets)
    hashes = flat.word_hashes(flat.LOWER[data], starts, ends)
    shingles = flat.windows(hashes, words)
    for first, last in zip(rows[:-1].tolist(), rows[1:].tolist(), strict=True):
        n = last - first
        if n >= words:
            yield np.unique(shingles[first : last - words + 1])
        elif n:
            yield flat.windows(hashes[first:last], n)
        else:
            yield np.zeros(0, dtype=np.uint64)


def _each_set(batch_column: pa.Array, words: int) -> Iterator[tuple[int, np.ndarray]]:
    data, offsets = flat.column_bytes(batch_column)
    for first, _, part, at in flat.slices(data, offsets):
        for k, found in enumerate(row_sets(part, at, words)):
            yield first + k, found


def statistics(texts: DataFrame, measure: Measure) -> tuple[np.ndarray, dict[int, int]]:
    """The counting sketch of all documents' shingles, and how many sets there are of each size.

    The sketch is of fixed size; sizes are counted in steps of about one in 64, so both stay small.
    """
    words = measure.words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
        sizes: dict[int, int] = {}
        for batch in batches:
            held, pending = [], 0
            for _, found in _each_set(batch.column(0), words):
                n = len(found)
                step = max(1, 1 << max(0, n.bit_length() - 7))
                sizes[n // step * step] = sizes.get(n // step * step, 0) + 1
                held.append(found)
                pending += n
                if pending > 1 << 18:
                    counts += np.bincount((np.concatenate(held) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(counts))
                    held, pending = [], 0
            if held:
                counts += np.bincount((np.concatenate(held) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(counts))
        at = np.flatnonzero(counts)
        where = np.concatenate([at, -1 - np.array(list(sizes), dtype=np.int64)])
        yield pa.RecordBatch.from_arrays([pa.array(where), pa.array(np.concatenate([counts[at], np.array(list(sizes.values()), dtype=np.int64)]))], names=["at", "n"])

    got = texts.mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    at, n = got["at"].to_numpy(), got["n"].to_numpy()
    sketch = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
    sketch[at[at >= 0]] = n[at >= 0]
    return sketch, dict(zip((-1 - at[at < 0]).tolist(), n[at < 0].tolist(), strict=True))


def boundary(sizes: dict[int, int], measure: Measure) -> int:
    """Largest size of a light set, by cost."""
    n = np.array(sorted(s for s in sizes if s >= measure.least), dtype=np.int64)
    if not len(n):
        return 0
    count = np.array([sizes[s] for s in n.tolist()], dtype=np.float64)
    k = measure.lacking(n)
    light = np.cumsum(count * (k + 2) * (k + 1) / 2)
    scan = np.concatenate([[0], np.cumsum(count * (k + 1) * SCAN_COST)])
    posted = np.searchsorted(n, n * measure.num / measure.den, side="right")
    cost = light + scan[-1] - scan[posted]
    best = int(np.argmin(cost))
    return int(n[best]) if cost[best] < scan[-1] else 0


def set_keys(found: np.ndarray, sketch: np.ndarray, limit: int, measure: Measure) -> np.ndarray:
    """Join keys of one set: its subsets if it is light, its first shingles if a heavy set may link with it."""
    n = len(found)
    if n < measure.least:
        return np.zeros(0, dtype=np.uint64)
    k = measure.lacking(n)
    order = np.lexsort((found, sketch[(found >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]))[: k + SUBSET]
    head = found[order]
    keys = []
    if n <= limit:
        i, j = np.triu_indices(len(head), 1)
        keys.append(flat.mix(head[i] * np.uint64(3) + flat.mix(head[j] ^ _SALT)))
    if n * measure.den >= (limit + 1) * measure.num:
        keys.append(flat.mix(head[: k + 1] ^ _SALT))
    return np.concatenate(keys) if keys else np.zeros(0, dtype=np.uint64)


def set_sums(found: np.ndarray) -> tuple[int, int]:
    """Two 64-bit hashes of a set."""
    return found.sum(dtype=np.uint64), flat.mix(found ^ _SALT).sum(dtype=np.uint64)


def describe_sets(documents: DataFrame, id_col: str, text: str, sketch: np.ndarray, limit: int, measure: Measure) -> DataFrame:
    """id, row (hash of the text), n, two halves of the set's hash, parity bitmap and join keys of every row."""
    shared = documents.sparkSession.sparkContext.broadcast(sketch)  # of fixed size
    schema = T.StructType([T.StructField("id", documents.schema[id_col].dataType), T.StructField("row", T.LongType()), T.StructField("n", T.IntegerType()), T.StructField("s1", T.LongType()), T.StructField("s2", T.LongType()), T.StructField("bits", T.BinaryType()), T.StructField("keys", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for batch in batches:
            column, rows = batch.column(1), batch.num_rows
            n = np.zeros(rows, dtype=np.int32)
            sums = np.zeros((2, rows), dtype=np.uint64)
            bits = [bytes(BITMAP_BITS // 8)] * rows
            keys: list[np.ndarray] = [np.zeros(0, np.uint64)] * rows
            for r, found in _each_set(column, measure.words):
                n[r] = len(found)
                if len(found):
                    sums[:, r] = set_sums(found)
                    size = LARGE_BITS if len(found) >= LARGE else BITMAP_BITS
                    bits[r] = np.packbits(np.bincount((found & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1).tobytes()
                    keys[r] = set_keys(found, counts, limit, measure)
            ends = np.concatenate([[0], np.cumsum([len(x) for x in keys])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(n), pa.array(sums[0].view(np.int64)), pa.array(sums[1].view(np.int64)),
                 pa.array(bits, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.uint64), *keys]).view(np.int64)))],
                names=schema.names,
            )

    return documents.select(F.col(id_col), F.col(text), F.xxhash64(F.col(text))).mapInArrow(run, schema)


def id_bitmap(ids: DataFrame, most: int = 1 << 27) -> np.ndarray:
    """One bit for each hash of an id that is in ids; at most `most` bits, so of bounded size.

    About one bit in 16 is set; with more ids than most / 16 it lets more other rows through.
    """
    size = 1 << 15
    while size < min(most, 16 * ids.count()):
        size *= 2
    place = F.pmod(F.xxhash64("id"), F.lit(size)) + F.lit(1)
    parts = ids.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    found = np.zeros((size >> 15, (1 << 15) // 8), dtype=np.uint8)
    for r in parts.collect():  # at most most / 2**15 rows of 4 KB
        found[r["bucket"] - 1] = np.frombuffer(bytes(r["bits"]), dtype=np.uint8)
    return found.ravel()


def exact_sets(documents: DataFrame, id_col: str, text: str, words: int, wanted: DataFrame) -> DataFrame:
    """key and its shingles' hashes, array<long>, of the wanted classes (key, id of one of its rows, n, s1, s2).

    Rows are first let through by a bitmap of the wanted ids, so that only theirs are made into sets
    and shuffled; the join after it is exact, by the id and the set's own hashes.
    """
    bits = id_bitmap(wanted.select("id"))
    shared = documents.sparkSession.sparkContext.broadcast(bits)
    schema = T.StructType([T.StructField("__id", documents.schema[id_col].dataType), T.StructField("n", T.IntegerType()), T.StructField("s1", T.LongType()), T.StructField("s2", T.LongType()), T.StructField("shingles", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.column(2).to_numpy(zero_copy_only=False)
            chosen = np.flatnonzero((shared.value[place >> 3] >> (place & 7)) & 1)
            if not len(chosen):
                continue
            part = batch.take(pa.array(chosen))
            found = [s for _, s in _each_set(part.column(1), words)]
            sizes = np.array([len(x) for x in found], dtype=np.int32)
            sums = np.array([set_sums(x) for x in found], dtype=np.uint64).reshape(-1, 2).view(np.int64)
            ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            sets = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.uint64), *found]).view(np.int64)))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes), pa.array(sums[:, 0]), pa.array(sums[:, 1]), sets], names=schema.names)

    place = F.pmod(F.xxhash64(F.col(id_col)), F.lit(8 * len(bits)))
    made = documents.select(F.col(id_col), F.col(text), place.alias("place")).mapInArrow(run, schema)
    met = made.join(wanted, [F.col("__id").eqNullSafe(F.col("id")), *[made[c] == wanted[c] for c in ("n", "s1", "s2")]])
    return materialise(met.select("key", "shingles").dropDuplicates(["key"]), "exact-sets")


def postings(classes: DataFrame) -> DataFrame:
    return classes.select("key", "n", F.explode("keys").alias("at"))


def hot_lists(classes: DataFrame) -> DataFrame:
    """at and size of the join keys with more than BLOCK classes."""
    sizes = postings(classes).groupBy("at").agg(F.count("*").alias("size"))
    return materialise(sizes.where(F.col("size") > BLOCK), "hot-lists")


def _numbered(lists: DataFrame, measure: Measure) -> DataFrame:
    """The distinct lists of two classes or more, each with a number, from arrays of (n, key) in `members`.

    Where the sizes in a list leave a gap that no link can bridge, it is cut in two.
    """
    held = lists.where(F.size("members") > 1).select(F.array_sort("members").alias("m"))

    def begins(i: Column) -> Column:
        before, here = F.get("m", i - 1)["n"], F.get("m", i)["n"]
        return (i == 0) | (before.cast("long") * F.lit(measure.den) < here.cast("long") * F.lit(measure.num))

    starts = F.filter(F.sequence(F.lit(0), F.size("m") - 1), begins)
    cut = held.select("m", starts.alias("starts")).select(F.explode(F.transform("starts", lambda p, j: F.slice("m", p + 1, F.coalesce(F.get("starts", j + 1), F.size("m")) - p))).alias("m"))
    ids = F.transform("m", lambda x: x["key"])
    return cut.where(F.size("m") > 1).select(ids.alias("ids")).distinct().withColumn("list", F.xxhash64("ids", F.size("ids")))


def _with_hot(placed: DataFrame, hot: DataFrame, how: str) -> DataFrame:
    return placed.join(F.broadcast(hot) if hot.count() <= FEW_HOT else hot, "at", how)


def inverted_lists(classes: DataFrame, hot: DataFrame, measure: Measure) -> DataFrame:
    """list and ids: the distinct lists of two classes or more that share a join key; those of hot keys in blocks."""
    salts = F.pow(F.lit(2.0), F.ceil(F.log2(F.col("size") * F.lit(2.0 / BLOCK)))).cast("long")
    placed = _with_hot(postings(classes), hot.select("at", salts.alias("salts")), "left")
    # equal classes go to blocks of equal number whatever the key, so that equal lists are one
    salt = F.coalesce(F.pmod(F.xxhash64("key"), F.col("salts")), F.lit(-1))
    return _numbered(placed.groupBy("at", salt.alias("salt")).agg(F.collect_list(F.struct("n", "key")).alias("members")), measure)


def crossing_lists(classes: DataFrame, hot: DataFrame, labels: DataFrame, measure: Measure) -> DataFrame:
    """list and ids for the hot keys whose classes are in several components: each block of classes outside
    the key's largest component with each block of all its classes."""
    members = _with_hot(postings(classes), hot, "inner").join(labels.withColumnRenamed("id", "key"), "key", "left").withColumn("label", F.coalesce("label", "key"))
    parts = members.groupBy("at", "label").agg(F.count("*").alias("part"))
    apart = parts.groupBy("at").agg(F.max_by("label", F.struct("part", "label")).alias("main"), F.sum("part").alias("all"), F.max("part").alias("most"))
    half = F.lit(BLOCK // 2)
    apart = apart.where("most < all").select("at", "main", F.ceil((F.col("all") - F.col("most")) / half).cast("int").alias("outer"), F.ceil(F.col("all") / half).cast("int").alias("blocks"))
    held = materialise(members.join(apart, "at").select("at", "key", "n", "outer", "blocks", (F.col("label") != F.col("main")).alias("outside")), "apart")
    place = lambda n, seed: F.pmod(F.xxhash64("key", F.lit(seed)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    outside = held.where("outside").select("at", "key", "n", place("outer", 1).alias("x"), every("blocks").alias("y"))
    inside = held.select("at", "key", "n", every("outer").alias("x"), place("blocks", 2).alias("y"))
    return _numbered(outside.unionByName(inside).groupBy("at", "x", "y").agg(F.collect_set(F.struct("n", "key")).alias("members")), measure)


class Bitmaps:
    """Parity bitmaps of a list's sets; large sets have the large one too."""

    def __init__(self, n: np.ndarray, words: np.ndarray):
        self.n, self.large = n, np.flatnonzero(n >= LARGE)
        self.small, self.wide = words[:, : BITMAP_BITS // 64], words[self.large, BITMAP_BITS // 64 :]
        self.of_large = np.full(len(n), -1, dtype=np.int64)
        self.of_large[self.large] = np.arange(len(self.large))

    @staticmethod
    def unpack(stored: list[bytes]) -> np.ndarray:
        """Rows of the small bitmap's words and then the large one's (0 where there is none)."""
        narrow, wide = BITMAP_BITS // 64, LARGE_BITS // 64
        out = np.zeros((len(stored), narrow + wide), dtype=np.uint64)
        for k, raw in enumerate(stored):
            words = np.frombuffer(raw, dtype=np.uint64)
            if len(words) == wide:
                out[k, narrow:] = words
                words = np.bitwise_xor.reduce(words.reshape(-1, narrow), axis=0)
            out[k, :narrow] = words
        return out

    def fitting(self, at: int, measure: Measure) -> tuple[np.ndarray, np.ndarray]:
        """Which sets may link with set `at`, and the least possible difference of each in parts of the total."""
        n = self.n
        d = np.bitwise_count(self.small ^ self.small[at]).sum(axis=1, dtype=np.int64)
        if self.of_large[at] >= 0:
            d[self.large] = np.bitwise_count(self.wide ^ self.wide[self.of_large[at]]).sum(axis=1, dtype=np.int64)
        total = n + n[at]
        fits = (d <= measure.difference(total)) & (np.minimum(n, n[at]) * measure.den >= np.maximum(n, n[at]) * measure.num)
        return fits, d / total


def spanning_edges(bitmaps: Bitmaps, label: np.ndarray, measure: Measure) -> list[tuple[int, int]]:
    """Edges that join the labels' components to a spanning forest over the pairs whose difference may be small enough.

    Only ids outside the largest component are compared with the others, so a list that hangs
    together already costs next to nothing.
    """
    size, edges = len(label), []
    names, number, count = np.unique(label, return_inverse=True, return_counts=True)
    inside = number == int(np.argmax(count))
    best, parent = np.full(size, np.inf), np.zeros(size, dtype=np.int64)  # of ids outside: to the tree
    rows: dict[int, np.ndarray] = {}
    for x in np.flatnonzero(~inside).tolist():
        fits, part = bitmaps.fitting(x, measure)
        rows[x] = np.where(fits, part, np.inf).astype(np.float32)
        near = np.where(inside, rows[x], np.inf)
        parent[x] = int(np.argmin(near))
        best[x] = near[parent[x]]
    while rows:
        x = int(np.argmin(np.where(inside, np.inf, best)))
        if inside[x] or not np.isfinite(best[x]):
            x = next(iter(rows))  # a new tree
        else:
            edges.append((int(parent[x]), x))
        # all of the component that x is in join the tree
        for y in np.flatnonzero((number == number[x]) & ~inside).tolist():
            inside[y] = True
            row = rows.pop(y)
            nearer = ~inside & (row < best)
            best[nearer], parent[nearer] = row[nearer], y
    return edges


def crossing_edges(bitmaps: Bitmaps, label: np.ndarray, measure: Measure) -> list[tuple[int, int]]:
    """All pairs of different labels whose difference may be small enough."""
    edges = []
    for at in range(len(label) - 1):
        fits = (label != label[at]) & (np.arange(len(label)) > at)
        if fits.any():
            edges += [(at, int(b)) for b in np.flatnonzero(fits & bitmaps.fitting(at, measure)[0])]
    return edges


def candidate_edges(lists: DataFrame, classes: DataFrame, labels: DataFrame | None, measure: Measure, all_pairs: bool = False) -> DataFrame:
    """list and pairs a < b between different labels that the lists give: a spanning forest each, or all pairs."""
    members = lists.select("list", F.explode("ids").alias("id"))
    if labels is not None:
        members = members.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
        # lists that hang together already need no more; a list is of bounded length
        whole = Window.partitionBy("list")
        members = members.withColumns({"low": F.min("label").over(whole), "high": F.max("label").over(whole)}).where("low < high").drop("low", "high")
    else:
        members = members.withColumn("label", F.col("id"))
    rows = members.join(classes.select(F.col("key").alias("id"), "n", "bits"), "id").select("list", "id", "n", "label", "bits")
    # a list's rows stand together in one partition; several lists go through Python in one batch
    rows = rows.repartition("list").sortWithinPartitions("list", "id")
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("list", "a", "b")])

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
        rest: list[np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            words = Bitmaps.unpack(batch.column(4).to_pylist())
            now = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)] + [words]
            if rest is not None:
                now = [np.concatenate([x, y]) for x, y in zip(rest, now, strict=True)]
            cuts = np.flatnonzero(np.diff(now[0])) + 1
            for first, last in zip(np.concatenate([[0], cuts[:-1]]), cuts, strict=True) if len(cuts) else ():
                yield tuple(x[first:last] for x in now)
            rest = [x[cuts[-1] :] for x in now] if len(cuts) else now
        if rest is not None:
            yield tuple(rest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where: list[np.ndarray] = []
        a: list[np.ndarray] = []
        b: list[np.ndarray] = []
        held = 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (where, a, b)], names=schema.names)

        for number, ids, n, label, words in groups(batches):
            bitmaps = Bitmaps(n.astype(np.int64), words)
            edges = crossing_edges(bitmaps, label, measure) if all_pairs else spanning_edges(bitmaps, label, measure)
            if edges:
                pair = ids[np.array(edges)]
                where.append(np.full(len(pair), number[0]))
                a.append(pair.min(axis=1))
                b.append(pair.max(axis=1))
                held += len(pair)
            if held > 100_000:
                yield batch()
                where, a, b, held = [], [], [], 0
        if held:
            yield batch()

    return rows.mapInArrow(run, schema).where("a < b")


def verified(edges: DataFrame, documents: DataFrame, id_col: str, text: str, classes: DataFrame, measure: Measure) -> DataFrame:
    """The edges between classes whose exact sets are similar enough."""
    involved = edges.select(F.col("a").alias("key")).union(edges.select(F.col("b").alias("key"))).distinct()
    wanted = materialise(classes.join(involved, "key", "left_semi").select("key", F.col("least").alias("id"), "n", "s1", "s2"), "involved")
    sets = exact_sets(documents, id_col, text, measure.words, wanted)
    left = edges.join(sets.select(F.col("key").alias("a"), F.col("shingles").alias("sa")), "a")
    both = left.join(sets.select(F.col("key").alias("b"), F.col("shingles").alias("sb")), "b")
    common = F.size(F.array_intersect("sa", "sb")).cast("long")
    total = (F.size("sa") + F.size("sb")).cast("long")
    return both.where(common * F.lit(measure.den) >= (total - common) * F.lit(measure.num)).select("a", "b").distinct()


def joined_links(links: DataFrame) -> DataFrame:
    """components() of a bounded number of links, by a disjoint-set forest in one task."""
    kind = links.schema["a"].dataType
    schema = T.StructType([T.StructField("id", kind), T.StructField("label", kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict = {}

        def root(x):
            while (p := parent.setdefault(x, x)) != x:
                parent[x] = parent.setdefault(p, p)
                x = parent[x]
            return x

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                a, b = root(a), root(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
        ids = list(parent)
        yield pa.RecordBatch.from_arrays([pa.array(ids, batch_type), pa.array([root(x) for x in ids], batch_type)], names=schema.names)

    from pyspark.sql.pandas.types import to_arrow_type

    batch_type = to_arrow_type(kind)
    return links.select("a", "b").coalesce(1).mapInArrow(run, schema)


def components(links: DataFrame) -> DataFrame:
    """id and label (the smallest id of its component) for every id in links (a, b).

    A counted number of links that is small goes through one task; any other through alternating stars,
    whose rounds grow with the logarithm of the longest chain.
    """
    now = materialise(links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "stars")
    if now.count() <= FEW_LINKS:
        return joined_links(now)

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40)))).first())

    was = state(now)
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(down, "a")
        small = joined.select("a", F.col("m").alias("b")).unionByName(joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")))
        now = materialise(small.where("a <> b").distinct(), "stars")
        is_now = state(now)
        if is_now == was:
            break
        was = is_now
    labels = now.select(F.col("a").alias("id"), F.col("b").alias("label"))
    return labels.unionByName(labels.select(F.col("label").alias("id"), "label")).distinct()


def linked_rows(documents: DataFrame, id_col: str, text: str, measure: Measure) -> DataFrame:
    """id, row, n, component and main (whether the row is of the text that stands for its component) of every row."""
    sketch, sizes = statistics(documents.select(text), measure)
    sets = materialise(describe_sets(documents, id_col, text, sketch, boundary(sizes, measure), measure), "sets")
    same = ["n", "s1", "s2"]
    grouped = sets.where("n > 0").groupBy(*same).agg(F.min("id").alias("least"), F.first("bits").alias("bits"), F.first("keys").alias("keys"))
    # a class has its number from where it is written, once
    classes = materialise(grouped.withColumn("key", F.monotonically_increasing_id()), "classes")

    def check(edges: DataFrame, name: str) -> DataFrame:
        return materialise(verified(edges, documents, id_col, text, classes, measure), name)

    def joined(labels: DataFrame, links: DataFrame) -> DataFrame:
        known = labels.where("id <> label").select(F.col("id").alias("a"), F.col("label").alias("b"))
        return materialise(components(known.unionByName(links)), "labels")

    def settled(lists: DataFrame, labels: DataFrame) -> DataFrame:
        """labels after all links within the lists."""
        forest = materialise(candidate_edges(lists, classes, labels, measure), "forest")
        tried = forest.select("a", "b").distinct()
        links = check(tried, "links")
        labels = joined(labels, links)
        # trees of one forest have no pair within the bound between them, so only a failed edge can leave one out
        failed = materialise(forest.join(links, ["a", "b"], "left_anti").select("list").distinct(), "failed")
        if failed.isEmpty():
            return labels
        again = candidate_edges(lists.join(failed, "list", "left_semi"), classes, labels, measure, all_pairs=True)
        crossing = materialise(again.select("a", "b").distinct().join(tried, ["a", "b"], "left_anti"), "crossing")
        return labels if crossing.isEmpty() else joined(labels, check(crossing, "links"))

    hot = hot_lists(classes)
    lists = materialise(inverted_lists(classes, hot, measure), "lists")
    longest = lists.select("list", F.size("ids").alias("size"), F.explode("ids").alias("id")).groupBy("id").agg(F.max(F.struct("size", "list"))["list"].alias("list"))
    early = candidate_edges(lists.join(longest.select("list").distinct(), "list", "left_semi"), classes, None, measure)
    labels = materialise(components(check(materialise(early.select("a", "b").distinct(), "early"), "links")), "labels")
    labels = settled(lists, labels)
    if not hot.isEmpty():
        across = materialise(crossing_lists(classes, hot, labels, measure), "crossing-lists")
        if not across.isEmpty():
            labels = settled(across, labels)
    named = labels.withColumnRenamed("id", "key").join(classes.select("key", "least"), "key")
    # of classes with ids the one with the smallest
    first = F.min(F.struct(F.col("least").isNull().alias("none"), "least", "key")).alias("first")
    named = named.join(named.groupBy("label").agg(first), "label").select("key", F.col("first.least").alias("component"), (F.col("key") == F.col("first.key")).alias("main"))
    of_class = classes.select("key", "least", *same).join(named, "key", "left")
    of_class = of_class.select(*same, "least", F.coalesce("component", "least").alias("component"), F.coalesce("main", F.lit(True)).alias("main"))
    labelled = sets.select("id", "row", *same).join(of_class, same, "left")
    some = F.col("n") > 0
    main = ~some | (F.col("main") & F.col("id").eqNullSafe(F.col("least")))
    return labelled.select("id", "row", "n", F.when(some, F.col("component")).otherwise(F.col("id")).alias("component"), main.alias("main"))


def link_components(documents: DataFrame, id_col: str = "doc_id", text: str = "text", measure: Measure | None = None) -> DataFrame:
    """id_col, n_shingles (long) and component_id (the smallest id reachable by links) of every row."""
    found = linked_rows(documents, id_col, text, measure or Measure())
    return found.select(F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"), F.col("component").alias("component_id"))


def one_of_each(documents: DataFrame, id_col: str = "doc_id", text: str = "text", measure: Measure | None = None) -> DataFrame:
    """The documents with one row of each component, that of the smallest id; rows without words all stay.

    Of rows that share that id and text one stays, whichever.
    """
    found = materialise(linked_rows(documents, id_col, text, measure or Measure()), "linked")
    key = free_name(documents.columns, "__row")
    keyed = documents.withColumn(key, F.struct(F.col(id_col).alias("id"), F.xxhash64(F.col(text)).alias("row")))
    row = F.struct("id", "row").alias(key)
    kept = without(keyed, key, materialise(found.where(~F.col("main")).select(row).distinct(), "others"))
    twice = found.where(F.col("main") & (F.col("n") > 0)).groupBy("id", "row").agg(F.count("*").alias("times")).where("times > 1")
    twice = materialise(twice.select(row), "twice")
    if not twice.isEmpty():
        once = let_through(kept, key, twice).join(twice, key, "left_semi").dropDuplicates([key])
        kept = without(kept, key, twice).unionByName(once.select(kept.columns))
    return kept.select(documents.columns)


#: The query's result in DuckDB, by rows: all pairs with a common shingle, and a recursive closure.
ORACLE = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS row, doc_id, text FROM documents),
w AS (
  SELECT row, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM d),
s AS (
  SELECT DISTINCT row, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) END) AS sh FROM w),
n AS (SELECT row, count(*) AS n FROM s GROUP BY row),
p AS (SELECT a.row AS x, b.row AS y, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.row <> b.row GROUP BY ALL),
e AS (SELECT x, y FROM p JOIN n a ON a.row = x JOIN n b ON b.row = y WHERE 100 * c >= 90 * (a.n + b.n - c)),
r AS (SELECT row, row AS other FROM d UNION SELECT r.row, e.y FROM r JOIN e ON e.x = r.other)
SELECT any_value(d.doc_id) AS doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(o.doc_id) AS component_id
FROM d JOIN r ON r.row = d.row JOIN d o ON o.row = r.other LEFT JOIN n ON n.row = d.row GROUP BY d.row
"""
