"""Token ids as binary files: frequency-ranked ids in byte-aligned variable-length coding.

The library encodes every distinct piece of text that a process meets once: runs of ASCII letters, digits and runs of signs,
which its pre-tokeniser parts in any text, and whole runs between white space that hold anything else. That is exact
for the kind of tokenizer that `in_pieces` asks for; for any other, texts are encoded whole. All ids are counted; the
commonest gets rank 0.
A file holds documents in ascending order of their ids. Its ranks are cut into fours: one control byte
has two bits for each, its length less one, and stands in a stream of its own; the ranks' bytes, the low one first, follow
in another. Reading looks each control byte up in a table of 256 rows of four lengths, sums them to
places, and gathers the bytes of all ranks at once.

A folder holds ranks.bin (the ids by rank, little-endian uint32), the files part-RRRRR-SSSSSS.lwt and the table index
(one row a file: range, shard, documents, tokens, and start, the number of ids in all files before). A file is written
under another name and renamed, so a repeated task replaces it by an equal one and a lost one leaves nothing behind
that is read: only files in the index are.

Defined cases: null and empty texts have the end id alone; a null id comes first and stays null; rows that share an id follow
each other, each with its own count; an empty table gives a folder without files; a document longer
than a file's share has a file of its own; columns other than id and text aren't read. Ids have to be whole numbers.
"""

from __future__ import annotations

import json
import struct
import uuid
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import flat
from .tables import materialise, shared_dir
from .token_counts import tokenizer

MAGIC = b"LWTOK001"
#: Ids of a file, about; 4 million take 5 to 8 MB.
SHARD_TOKENS = 1 << 22
#: Bytes of text encoded at once, pieces that a process remembers, and new ones in a call of the library.
SLICE_BYTES, REMEMBERED, TOGETHER = 1 << 22, 500_000, 256
#: magic, range, shard, documents, tokens, control bytes, data bytes
HEADER = struct.Struct("<8s6q")

_codes = np.arange(256)
#: Lengths of the four ranks that a control byte stands for.
LENGTHS = np.stack([(_codes >> (2 * k) & 3) + 1 for k in range(4)], axis=1).astype(np.int64)


def pack(ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Control bytes and data bytes of some ranks (uint32)."""
    n = len(ranks)
    padded = np.zeros(-(-n // 4) * 4, dtype=np.uint32)
    padded[:n] = ranks
    code = (padded > 0xFF).astype(np.uint8) + (padded > 0xFFFF) + (padded > 0xFFFFFF)
    fours = code.reshape(-1, 4)
    control = (fours[:, 0] | fours[:, 1] << 2 | fours[:, 2] << 4 | fours[:, 3] << 6).astype(np.uint8)
    bytes_of = padded[:n].astype("<u4").view(np.uint8).reshape(-1, 4)
    return control, bytes_of[np.arange(4) <= code[:n, None]]


def unpack(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The n ranks of some control and data bytes."""
    lengths = LENGTHS[control].ravel()[:n]
    at = np.cumsum(lengths) - lengths
    ranks = data[at].astype(np.uint32) if n else np.zeros(0, np.uint32)
    for k in (1, 2, 3):
        longer = np.flatnonzero(lengths > k)
        ranks[longer] |= data[at[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return ranks


#: The pre-tokeniser's pattern and the normaliser for which texts may be cut into pieces, as they stand in the vocabulary's file.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALISERS = ["NFC", "Replace", "Lowercase"]
END_OF_WORD = "</w>"

#: A sign that texts hardly hold: an id of its own, which no piece without it has.
MARK = "\x01"

#: Classes of bytes: white space, letters, digits, other signs, and what only the library is asked about.
BLANK, LETTER, DIGIT, SIGN, UNSURE = range(5)
CLASS = np.full(256, UNSURE, dtype=np.uint8)
CLASS[33:127] = SIGN
CLASS[[0x20, *range(0x09, 0x0E)]] = BLANK
CLASS[48:58] = DIGIT
CLASS[65:91] = CLASS[97:123] = LETTER
CLASS[[ord("'"), ord("<")]] = UNSURE  # contractions and special strings


def in_pieces(path: str) -> bool:
    """Whether a tokenizer is of the kind whose texts may be cut into pieces, each encoded by itself."""
    spec = json.loads(tokenizer(path).to_str())
    first = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0]
    split = first.get("type") == "Split" and first.get("pattern") == {"Regex": PATTERN} and first.get("behavior") == "Removed" and first.get("invert")
    normal = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])] == NORMALISERS
    added = [t for t in spec["added_tokens"] if t["lstrip"] or t["rstrip"] or t["single_word"] or "<" not in t["content"] or any(c.isspace() for c in t["content"])]
    return bool(split and normal and not added and spec["model"].get("end_of_word_suffix") == END_OF_WORD)


def pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """All pieces of some texts' bytes, and the number of those before each text (n+1 values).

    A piece is a run of ASCII letters, in lower case, a digit, or a run of other signs; a run between white space that holds
    anything else is one piece as it stands.
    """
    kind = CLASS[data]
    row = np.zeros(len(data) + 1, dtype=bool)
    row[offsets] = True
    row = row[:-1]
    blank = kind == BLANK
    word = row.copy()
    word[1:] |= blank[1:] != blank[:-1]
    word[:1] = True
    at = np.flatnonzero(word)
    unsure = np.repeat(np.logical_or.reduceat(kind == UNSURE, at), np.diff(np.append(at, len(data)))) if len(at) else blank
    begins = kind == DIGIT
    begins[1:] |= kind[1:] != kind[:-1]
    begins = (begins & ~unsure | word) & ~blank
    kept = ~blank
    text = np.where(unsure, data, flat.LOWER[data])[kept]
    cut = np.append(np.flatnonzero(begins[kept]), len(text))
    before = np.concatenate([[0], np.cumsum(begins)])[offsets]
    return pa.Array.from_buffers(pa.large_string(), len(cut) - 1, [None, pa.py_buffer(cut.astype(np.int64)), pa.py_buffer(text)]), before


def strings(column: pa.Array) -> list[str]:
    """to_pylist() of a column of strings without nulls, which makes no scalar of Arrow's for each."""
    return column.to_numpy(zero_copy_only=False).tolist()


class Words:
    """The ids of pieces, remembered for as long as the process lives."""

    def __init__(self, path: str):
        self.tok, self.cut = tokenizer(path), in_pieces(path)
        vocabulary = self.tok.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith(END_OF_WORD)]] = True
        self.mark = self.tok.encode(MARK, add_special_tokens=False).ids or [-1]
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.firsts, self.flat = np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.uint32)

    def encoded(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some texts without nulls, one text after the other, and how many each has."""
        if not self.cut:
            lists = [e.ids for e in self.tok.encode_batch(texts.to_pylist(), add_special_tokens=False)]
            return np.array([i for x in lists for i in x], dtype=np.uint32), np.array([len(x) for x in lists], dtype=np.int64)
        found, before = pieces(*flat.column_bytes(texts))
        coded = found.dictionary_encode()
        place = self.places(strings(coded.dictionary))[coded.indices.to_numpy(zero_copy_only=False)]
        first = self.firsts[place]
        count = self.firsts[place + 1] - first
        ends = np.concatenate([[0], np.cumsum(count)])
        ids = self.flat[np.arange(ends[-1]) + np.repeat(first - ends[:-1], count)]
        return ids, np.diff(ends[before])

    def places(self, words: list[str]) -> np.ndarray:
        """The places of pieces, all different; those of new ones are made."""
        found = np.fromiter(map(self.place.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        unknown = np.flatnonzero(found < 0)
        if len(self.place) + len(unknown) > REMEMBERED and len(self.place):
            self.forget()
            return self.places(words)
        if len(unknown):
            new = [words[k] for k in unknown]
            plain = [w for w in new if w.isascii() and "'" not in w and "<" not in w and w.isprintable()]
            some = set(plain)
            others = [w for w in new if w not in some]
            marked = [w for w in others if "<" not in w and MARK not in w]
            alone = [w for w in others if "<" in w or MARK in w]
            parts = [self.joined(plain), self.parted(marked), self.each(alone)]
            self.place.update(zip(plain + marked + alone, range(len(self.place), len(self.place) + len(new)), strict=True))
            self.firsts = np.concatenate([self.firsts, len(self.flat) + np.cumsum(np.concatenate([n for _, n in parts]))])
            self.flat = np.concatenate([self.flat, *(ids for ids, _ in parts)])
            found[unknown] = [self.place[w] for w in new]
        return found

    def each(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of any words, and how many each has."""
        lists = [e.ids for e in self.tok.encode_batch(words, add_special_tokens=False)]
        return np.fromiter((i for x in lists for i in x), np.uint32), np.fromiter(map(len, lists), np.int64, len(lists))

    def groups(self, words: list[str], between: str) -> Iterator[tuple[list[str], np.ndarray]]:
        """Some words at a time, and the ids of their text."""
        found = [words[k : k + TOGETHER] for k in range(0, len(words), TOGETHER)]
        for group, e in zip(found, self.tok.encode_batch([between.join(g) for g in found], add_special_tokens=False), strict=True):
            yield group, np.array(e.ids, dtype=np.uint32)

    def joined(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """each() of pieces that the pre-tokeniser leaves whole, so that the last id of each is one that ends a word."""
        ids, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for group, own in self.groups(words, " "):
            last = np.flatnonzero(self.ends[own])
            own, n = (own, np.diff(last, prepend=-1)) if len(last) == len(group) else self.each(group)
            ids.append(own)
            sizes.append(n)
        return np.concatenate(ids), np.concatenate(sizes)

    def parted(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """each() of words that don't hold MARK, which stands between them as a word of its own."""
        ids, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for group, own in self.groups(words, f" {MARK} "):
            marks = np.flatnonzero(own == self.mark[-1])
            known = len(self.mark) == 1 and len(marks) == len(group) - 1
            own, n = (np.delete(own, marks), np.diff(marks, prepend=-1, append=len(own)) - 1) if known else self.each(group)
            ids.append(own)
            sizes.append(n)
        return np.concatenate(ids), np.concatenate(sizes)


@lru_cache(maxsize=1)
def words_of(path: str) -> Words:
    return Words(path)


def unit(tokenizer_path: str, end_id: int) -> str:
    """The type that ids are kept in before they are ranked."""
    return "<u2" if max(end_id, *tokenizer(tokenizer_path).get_vocab().values()) < 1 << 16 else "<u4"


def encoded(df: DataFrame, text: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id") -> DataFrame:
    """id (long), n and ids (of type unit(), the end id last) of each row."""
    kind = np.dtype(unit(tokenizer_path, end_id))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = words_of(tokenizer_path)
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            _, offsets = flat.column_bytes(texts)
            for first, last, _, _ in flat.slices(np.zeros(0, np.uint8), offsets, SLICE_BYTES):
                ids, n = words.encoded(texts.slice(first, last - first))
                ends = np.cumsum(n)
                ids = np.insert(ids.astype(kind), ends, end_id)
                cut = np.concatenate([[0], ends + np.arange(1, len(n) + 1)]) * kind.itemsize
                stream = pa.Array.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(cut.astype(np.int64)), pa.py_buffer(ids)]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), pa.array(n + 1), stream], names=["id", "n", "ids"])

    return df.select(F.col(id_col).cast("long"), F.col(text)).mapInArrow(run, "id long, n long, ids binary")


def ranked_ids(tokens: DataFrame, kind: str) -> np.ndarray:
    """All ids that occur, the commonest first and smaller ones before larger: as many as the vocabulary has, at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(0, dtype=np.int64)
        for batch in batches:
            data, _ = binary(batch.column(0))
            found = np.bincount(data.view(kind))
            if len(found) > len(counts):
                counts = np.concatenate([counts, np.zeros(len(found) - len(counts), dtype=np.int64)])
            counts[: len(found)] += found
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["id", "n"])

    got = tokens.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    ids, n = got["id"].to_numpy(), got["n"].to_numpy()
    return ids[np.lexsort((ids, -n))].astype("<u4")


def binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n+1 offsets of a binary column without nulls."""
    column = column.cast(pa.large_binary())
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None and buffers[2].size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder, and its path there; a path without a scheme is a mounted one."""
    if "://" not in folder and not folder.startswith("file:"):
        return fs.LocalFileSystem(), folder
    if folder.startswith("file:"):
        return fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(folder)


def put(folder: str, name: str, parts: list) -> None:
    """A file that is there as a whole or not at all."""
    store, path = opened(folder)
    made = f"{path}/_{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(made) as out:
        for part in parts:
            out.write(part)
    store.move(made, f"{path}/{name}")


def file_name(part: int, shard: int) -> str:
    return f"part-{part:05d}-{shard:06d}.lwt"


def file_parts(part: int, shard: int, ids: list, counts: list[int], ranks: np.ndarray) -> list:
    """A file's bytes: header, ids and their nulls, counts, control bytes, data bytes."""
    control, data = pack(ranks)
    values = np.array([0 if i is None else i for i in ids], dtype="<i8")
    null = np.array([i is None for i in ids], dtype=np.uint8)
    head = HEADER.pack(MAGIC, part, shard, len(ids), len(ranks), len(control), len(data))
    return [memoryview(x).cast("B") for x in (head, values, null, np.array(counts, dtype="<i8"), control, data) if len(x)]


def parsed(data: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Ids, counts and ranks of a file's bytes."""
    magic, _, _, docs, n, n_control, n_data = HEADER.unpack_from(data)
    if magic != MAGIC or len(data) != HEADER.size + 17 * docs + n_control + n_data:
        raise ValueError("not a token file, or not a whole one")
    at = HEADER.size
    values, at = np.frombuffer(data, "<i8", docs, at), at + 8 * docs
    null, at = np.frombuffer(data, np.uint8, docs, at), at + docs
    counts, at = np.frombuffer(data, "<i8", docs, at), at + 8 * docs
    control, at = np.frombuffer(data, np.uint8, n_control, at), at + n_control
    return pa.array(values, mask=null.astype(bool)), counts, unpack(control, np.frombuffer(data, np.uint8, n_data, at), n)


def write_files(df: DataFrame, text: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", folder: str | None = None, shard_tokens: int = SHARD_TOKENS) -> str:
    """Write the ids of all texts below folder (by default a new one in the shared folder), which is returned."""
    spark = df.sparkSession
    folder = folder or f"{shared_dir(spark)}/landweave/tokens-{uuid.uuid4().hex}"
    tokens = materialise(encoded(df, text, tokenizer_path, end_id, id_col), "encoded", "zstd")
    kind = np.dtype(unit(tokenizer_path, end_id))
    ids = ranked_ids(tokens, kind.str)
    store, path = opened(folder)
    store.create_dir(path, recursive=True)
    put(folder, "ranks.bin", [memoryview(ids).cast("B")] if len(ids) else [])
    rank_of = np.zeros(int(ids.max()) + 1 if len(ids) else 1, dtype=np.uint32)
    rank_of[ids] = np.arange(len(ids), dtype=np.uint32)
    shared = spark.sparkContext.broadcast(rank_of)  # as large as the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = shard = held = 0
        docs, counts, ranks = [], [], []

        def flush() -> pa.RecordBatch:
            nonlocal docs, counts, ranks, held, shard
            put(folder, file_name(part, shard), file_parts(part, shard, docs, counts, np.concatenate(ranks)))
            row = pa.RecordBatch.from_pydict({"range": [part], "shard": pa.array([shard], pa.int64()), "docs": [len(docs)], "tokens": [held]})
            docs, counts, ranks, held, shard = [], [], [], 0, shard + 1
            return row

        for batch in batches:
            part = batch.column(3)[0].as_py() if batch.num_rows else part
            data, offsets = binary(batch.column(2))
            offsets = offsets // kind.itemsize
            first = 0
            while first < batch.num_rows:  # as many documents as still fit, one at least
                room = offsets[first] + shard_tokens - held
                last = max(first + (not docs), int(np.searchsorted(offsets, room, side="right")) - 1)
                if last > first:
                    ranks.append(shared.value[data[offsets[first] * kind.itemsize : offsets[last] * kind.itemsize].view(kind)])
                    docs += batch.column(0).slice(first, last - first).to_pylist()
                    counts += batch.column(1).slice(first, last - first).to_pylist()
                    held += int(offsets[last] - offsets[first])
                if last < batch.num_rows:
                    yield flush()
                first = last
        if docs:
            yield flush()

    # the place parts rows that share an id, so that they are no hot range
    placed = tokens.withColumn("place", F.monotonically_increasing_id())
    dealt = placed.repartitionByRange("id", "place").sortWithinPartitions("id", "place").drop("place").withColumn("range", F.spark_partition_id().cast("long"))
    written = materialise(dealt.mapInArrow(run, "range long, shard long, docs long, tokens long"), "token-files")
    ranges = written.groupBy("range").agg(F.sum("tokens").alias("n"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    offsets = ranges.select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("range").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    index = written.withColumn("start", F.coalesce(F.sum("tokens").over(inside), F.lit(0))).join(offsets, "range").withColumn("start", F.col("start") + F.col("offset"))
    index.drop("offset").write.parquet(f"{folder}/index")
    return folder


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids (little-endian uint32) of each document in a folder of token files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = opened(folder)
        with store.open_input_stream(f"{path}/ranks.bin") as f:
            id_of = np.frombuffer(f.read(), dtype="<u4")
        for batch in batches:
            for part, shard, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with store.open_input_stream(f"{path}/{file_name(part, shard)}") as f:
                    docs, counts, ranks = parsed(f.read())
                ids = id_of[ranks]
                cut = np.concatenate([[0], np.cumsum(counts)])
                for first, last, _, _ in flat.slices(np.zeros(0, np.uint8), cut * 4):
                    own = np.ascontiguousarray(ids[cut[first] : cut[last]])
                    at = (cut[first : last + 1] - cut[first]) * 4
                    stream = pa.Array.from_buffers(pa.large_binary(), last - first, [None, pa.py_buffer(at), pa.py_buffer(own)]).cast(pa.binary())
                    yield pa.RecordBatch.from_arrays([docs.slice(first, last - first), pa.array(cut[first:last] + start), pa.array(counts[first:last]), stream], names=["doc_id", "start", "n_tokens", "ids"])

    index = spark.read.schema("range long, shard long, docs long, tokens long, start long").parquet(f"{folder}/index")
    files = index.select("range", "shard", "start").repartition("range", "shard")
    return files.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def file_digests(df: DataFrame, text: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id") -> DataFrame:
    """id_col, start, n_tokens and ids_crc32 of each document, from the files that its ids are written to."""
    found = read_files(df.sparkSession, write_files(df, text, tokenizer_path, end_id, id_col))
    return found.select(F.col("doc_id").alias(id_col), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
