"""SentencePiece BPE by vectorised merge rounds on flat numpy symbol arrays.

Symbols of all distinct words of a batch lie in one flat array. A round takes the best pair rank of
each word by a segmented minimum, merges it in all words at once at its leftmost place, and
compacts; words without a pair left leave the array. Where no piece that the merged piece takes part
in has a rank as good or better, the word's further places of the same pair are merged in the same
round (leftmost first, without overlap), as the one-by-one order would do next anyway.

A word here is a run of characters whose neighbours stand side by side in at least one vocabulary
piece: no merge can cross any other place, so words are independent and equal words are done once.

Defined cases: null and empty texts give no ids and decode to ''. Rows are independent, so repeated rows and rows that share
an id give their own results, and an empty table gives an empty one; texts of any length are encoded whole; ties
of the score go to the leftmost pair, as in the library; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACE = "▁"
NONE = np.int32(2**31 - 1)
#: Characters of text merged at once; a longer single text is a batch of its own.
BATCH_CHARS = 1 << 20


class PieceTable:
    """Vocabulary of a sentencepiece BPE model as numpy lookup tables."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(n)]
        normal = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.byte_id = np.zeros(256, dtype=np.int32)
        for i in range(n):
            if sp.is_byte(i):
                self.byte_id[int(pieces[i][3:5], 16)] = i
        ids = {pieces[i]: i for i in normal}
        scores = sorted({-sp.get_score(i) for i in normal})
        rank_of = {s: k for k, s in enumerate(scores)}
        chars = sorted({c for i in normal for c in pieces[i]})
        symbol = dict(ids)
        self.extra_cp = []
        for c in chars:
            if c not in symbol:
                symbol[c] = n + len(self.extra_cp)
                self.extra_cp.append(ord(c))
        self.extra_cp = np.array(self.extra_cp, dtype=np.int64)
        self.n, self.width = n, n + len(self.extra_cp)

        keys, merged, ranks = [], [], []
        unsafe = set()
        for i in normal:
            piece, rank = pieces[i], rank_of[-sp.get_score(i)]
            for cut in range(1, len(piece)):
                a, b = symbol.get(piece[:cut]), symbol.get(piece[cut:])
                if a is None or b is None:
                    continue
                keys.append(a * self.width + b)
                merged.append(i)
                ranks.append(rank)
                for part in (a, b):
                    if part < n and len(pieces[part]) > 1 and rank <= rank_of[-sp.get_score(part)]:
                        unsafe.add(part)
        order = np.argsort(np.array(keys, dtype=np.int64))
        # a sentinel above every key keeps searchsorted inside the arrays
        self.keys = np.append(np.array(keys, dtype=np.int64)[order], np.iinfo(np.int64).max)
        self.merged = np.append(np.array(merged, dtype=np.int32)[order], 0).astype(np.int32)
        self.ranks = np.append(np.array(ranks, dtype=np.int32)[order], NONE).astype(np.int32)
        self.safe = np.ones(self.width, dtype=bool)
        self.safe[list(unsafe)] = False

        # characters: code point -> number among the vocabulary's characters (0: in no piece)
        self.char_no = np.zeros(0x110000, dtype=np.int32)
        self.char_no[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.char_symbol = np.array([0, *(symbol[c] for c in chars)], dtype=np.int32)
        self.beside = np.zeros((len(chars) + 1, len(chars) + 1), dtype=bool)
        for i in normal:
            at = self.char_no[[ord(c) for c in pieces[i]]]
            self.beside[at[:-1], at[1:]] = True

        texts = [b""] * n
        for i in normal:
            texts[i] = pieces[i].replace(SPACE, " ").encode()
        for i in range(n):
            if sp.is_byte(i):
                texts[i] = bytes([int(pieces[i][3:5], 16)])
            elif sp.is_unknown(i):
                texts[i] = " ⁇ ".encode()
        self.text_len = np.array([len(t) for t in texts], dtype=np.int64)
        self.text_at = np.concatenate([[0], np.cumsum(self.text_len)])
        self.text_bytes = np.frombuffer(b"".join(texts), dtype=np.uint8)

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged id of each pair; rank NONE where it is no piece."""
        key = np.where((left >= 0) & (right >= 0), left.astype(np.int64) * self.width + right, -1)
        at = np.searchsorted(self.keys, key)
        hit = self.keys[at] == key
        return np.where(hit, self.ranks[at], NONE), self.merged[at]

    def merge(self, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Final symbols and their words; sym and word are flat and word ascends."""
        done_sym, done_word = [], []
        rank = np.full(len(sym), NONE, dtype=np.int32)
        into = np.zeros(len(sym), dtype=np.int32)
        inner = np.flatnonzero(word[:-1] == word[1:])
        rank[inner], into[inner] = self.pairs(sym[inner], sym[inner + 1])
        while len(sym):
            starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            lengths = np.diff(np.append(starts, len(sym)))
            least = np.minimum.reduceat(rank, starts)
            over = least == NONE
            if over.any():
                gone = np.repeat(over, lengths)
                done_sym.append(sym[gone])
                done_word.append(word[gone])
                stay = ~gone
                sym, word, rank, into = sym[stay], word[stay], rank[stay], into[stay]
                lengths, least = lengths[~over], least[~over]
                if not len(sym):
                    break
            at = np.flatnonzero(rank == np.repeat(least, lengths))
            w = word[at]
            lead = np.concatenate([[True], w[1:] != w[:-1]])
            # number of each place within its run of touching places of the same word
            fresh = lead | np.concatenate([[True], np.diff(at) > 1])
            run = np.arange(len(at)) - np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
            at = at[lead | (self.safe[into[at]] & self.safe[into[at[np.maximum.accumulate(np.where(lead, np.arange(len(at)), 0))]]] & (run % 2 == 0))]
            sym[at] = into[at]
            stay = np.ones(len(sym), dtype=bool)
            stay[at + 1] = False
            new_at = at - np.arange(len(at))
            sym, word, rank, into = sym[stay], word[stay], rank[stay], into[stay]
            touched = np.unique(np.concatenate([new_at, new_at[new_at > 0] - 1]))
            last = touched == len(sym) - 1
            rank[touched] = NONE
            touched = touched[~last]
            touched = touched[word[touched] == word[touched + 1]]
            rank[touched], into[touched] = self.pairs(sym[touched], sym[touched + 1])
        if not done_sym:
            return sym, word
        sym, word = np.concatenate(done_sym), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        return sym[order], word[order]

    def to_ids(self, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols without a piece become the ids of their UTF-8 bytes."""
        bare = (sym < 0) | (sym >= self.n)
        if not bare.any():
            return sym, word
        cp = np.where(sym < 0, -(sym.astype(np.int64) + 1), 0)
        if len(self.extra_cp):
            extra = sym >= self.n
            cp[extra] = self.extra_cp[sym[extra] - self.n]
        size = np.where(bare, 1 + (cp > 0x7F) + (cp > 0x7FF) + (cp > 0xFFFF), 1)
        raw = np.frombuffer("".join(map(chr, cp[bare].tolist())).encode(), dtype=np.uint8)
        ids = np.repeat(sym, size)
        ids[np.repeat(bare, size)] = self.byte_id[raw]
        return ids, np.repeat(word, size)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and n+1 offsets."""
        lengths = np.array([len(t) + 1 if t else 0 for t in texts], dtype=np.int64)
        rows = np.concatenate([[0], np.cumsum(lengths)])
        if not rows[-1]:
            return np.zeros(0, dtype=np.int32), np.zeros(len(texts) + 1, dtype=np.int64)
        cp = np.frombuffer("".join(" " + t for t in texts if t).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        cp[cp == 0x20] = ord(SPACE)
        no = self.char_no[cp]
        begins = np.ones(len(cp), dtype=bool)
        begins[1:] = ~self.beside[no[:-1], no[1:]]
        begins[rows[:-1][lengths > 0]] = True
        starts = np.flatnonzero(begins)
        sizes = np.diff(np.append(starts, len(cp)))
        uniq, inverse = distinct_words(cp, starts, sizes)
        starts_u, sizes_u = starts[uniq], sizes[uniq]
        first = np.concatenate([[0], np.cumsum(sizes_u)])
        take = np.arange(first[-1]) - np.repeat(first[:-1] - starts_u, sizes_u)
        sym = np.where(no[take] > 0, self.char_symbol[no[take]], -(cp[take] + 1)).astype(np.int32)
        ids, word = self.to_ids(*self.merge(sym, np.repeat(np.arange(len(uniq)), sizes_u)))
        at = np.searchsorted(word, np.arange(len(uniq) + 1))
        count = np.diff(at)[inverse]
        ends = np.concatenate([[0], np.cumsum(count)])
        out = ids[np.arange(ends[-1]) - np.repeat(ends[:-1] - at[inverse], count)]
        return out, ends[np.searchsorted(starts, rows)]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all texts one after the other, and their offsets; the prefix space goes."""
        size = self.text_len[ids]
        ends = np.concatenate([[0], np.cumsum(size)])
        flat = self.text_bytes[np.arange(ends[-1]) - np.repeat(ends[:-1] - self.text_at[ids], size)]
        out = ends[offsets]
        filled = np.flatnonzero(np.diff(out) > 0)
        lead = out[filled][flat[out[filled]] == 0x20]
        keep = np.ones(len(flat), dtype=bool)
        keep[lead] = False
        kept = np.concatenate([[0], np.cumsum(keep)])
        return flat[keep], kept[out]


def distinct_words(cp: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of a first occurrence of each distinct word, and each word's distinct number."""
    from .flat import mix, powers

    p = powers(int(sizes.max()) + 1)
    at = np.arange(len(cp)) - np.repeat(starts, sizes)
    h = np.add.reduceat((cp.astype(np.uint64) + np.uint64(1)) * p[at], starts)
    h = mix(h + sizes.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    _, first, inverse = np.unique(h, return_index=True, return_inverse=True)
    return first, inverse


@lru_cache(maxsize=2)
def piece_table(path: str) -> PieceTable:
    return PieceTable(path)


def _runs(texts: list[str]) -> Iterator[tuple[int, int]]:
    first = size = 0
    for i, t in enumerate(texts):
        if i > first and size + len(t) > BATCH_CHARS:
            yield first, i
            first, size = i, 0
        size += len(t)
    if first < len(texts):
        yield first, len(texts)


def encode_decode(df: DataFrame, text: str, model_path: str, id_col: str) -> DataFrame:
    """id_col, ids array<int> and the text decoded from these ids, for every row of df.

    The model file is read once per Python worker from model_path.
    """
    id_type = df.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, id_type), T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = piece_table(model_path)
        for batch in batches:
            texts = ["" if t is None else t for t in batch.column(1).to_pylist()]
            for first, last in _runs(texts):
                ids, offsets = table.encode(texts[first:last])
                raw, at = table.decode(ids, offsets)
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids, pa.int32()))
                decoded = pa.StringArray.from_buffers(last - first, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(raw))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), lists, decoded], names=[id_col, "ids", "decoded"])

    return df.select(F.col(id_col), F.col(text)).mapInArrow(run, schema)


def encoding_digests(df: DataFrame, text: str, model_path: str, id_col: str = "doc_id") -> DataFrame:
    """Counts and digests of encode_decode(): one row per row of df."""
    coded = encode_decode(df, text, model_path, id_col)
    return coded.select(
        id_col,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )
