"""Exact token counts by overlap resynchronisation.

A text of up to CHUNK_CHARS is encoded as it is. Any longer one is encoded in overlapping chunks,
each with the offsets of its pre-tokens; two neighbours are spliced at a boundary between
pre-tokens that both have. Such a place is proven stable: the pre-tokeniser's pattern looks ahead by
at most GUARD characters and never behind, so a boundary of the left chunk at or behind its own splice and GUARD
or more before its end is one of the whole text, and from a true boundary on the right chunk goes as the
whole text does. Where the overlap holds no common boundary it is doubled until it does; in the end
the two chunks are encoded as one.

Defined cases: null and empty texts have 0 bytes and tokens; a text without any boundary, however long, is encoded
whole; rows are independent, so ties and repeated rows give repeated results and an empty table gives an
empty one; other columns are not read. Special strings inside texts are the library's default
tokens; one is shorter than GUARD, so a cut through it cannot reach a boundary that counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import islice
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK_CHARS = 4096
OVERLAP_CHARS = 128
GUARD = 32
#: Chunks that are encoded at a time.
TOGETHER = 128


@lru_cache(maxsize=2)
def tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


class Chunk(NamedTuple):
    """An encoded part of a text, and where it begins and ends there."""

    encoding: object
    begin: int
    end: int


def splice(left: Chunk, right: Chunk, skip: int) -> tuple[int, int] | None:
    """Tokens of both chunks before their last common stable boundary; left's are skip or more."""
    at = left.end - GUARD - left.begin
    word = None
    while word is None and at > 0:
        word = left.encoding.char_to_word(at)
        at -= 1
    while word is not None and word >= 0:
        place = left.begin + left.encoding.word_to_chars(word)[0]
        before = left.encoding.word_to_tokens(word)[0]
        if place < right.begin or before < skip:
            return None
        other = right.encoding.char_to_word(place - right.begin)
        if other is not None and right.encoding.word_to_chars(other)[0] == place - right.begin:
            return before, right.encoding.word_to_tokens(other)[0]
        word -= 1
    return None


class Count:
    """The running count of one text, chunk after chunk."""

    def __init__(self, tok, text: str):
        self.tok, self.text = tok, text
        self.total = self.skip = 0  # skip: tokens of the present chunk that its predecessor has counted
        self.chunk: Chunk | None = None

    def encoded(self, begin: int, end: int) -> Chunk:
        return Chunk(self.tok.encode(self.text[begin:end], add_special_tokens=False), begin, end)

    def add(self, right: Chunk) -> None:
        left, width = self.chunk, OVERLAP_CHARS
        while left is not None:
            found = splice(left, right, self.skip)
            if found:
                self.total += found[0] - self.skip
                self.skip = found[1]
                break
            if right.begin == left.begin:  # no boundary in all of the left chunk: both are one
                break
            width *= 2
            right = self.encoded(max(left.begin, left.end - width), right.end)
        self.chunk = right

    def result(self) -> int:
        return self.total + (len(self.chunk.encoding) - self.skip if self.chunk else 0)


def cuts(size: int, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> list[tuple[int, int]]:
    """Begin and end of a text's chunks; one where it is short enough."""
    step = chunk - overlap
    return [(k, min(size, k + chunk)) for k in range(0, max(1, size - overlap), step)]


def counts(tok, texts: list[str], chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> list[int]:
    """Tokens of each text."""
    found = [Count(tok, t) for t in texts]
    places = ((k, a, b) for k, t in enumerate(texts) if t for a, b in cuts(len(t), chunk, overlap))
    while part := list(islice(places, TOGETHER)):
        encodings = tok.encode_batch([texts[k][a:b] for k, a, b in part], add_special_tokens=False)
        for (k, a, b), e in zip(part, encodings, strict=True):
            found[k].add(Chunk(e, a, b))
            if b == len(texts[k]):
                found[k] = found[k].result()
    return [0 if isinstance(c, Count) else c for c in found]


def token_counts(df: DataFrame, text: str, tokenizer_path: str, id_col: str = "doc_id", limit: int = 512) -> DataFrame:
    """id_col, n_bytes, n_tokens, over_limit (n_tokens > limit) and n_chunks of every row of df."""
    id_type = df.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, id_type), *[T.StructField(c, T.LongType()) for c in ("n_bytes", "n_tokens", "n_chunks")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(tokenizer_path)
        for batch in batches:
            texts = ["" if t is None else t for t in batch.column(1).to_pylist()]
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).cast(pa.int64())
            chunks = [len(cuts(len(t))) if t else 0 for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, pa.array(counts(tok, texts), pa.int64()), pa.array(chunks, pa.int64())], names=schema.names)

    counted = df.select(F.col(id_col), F.col(text)).mapInArrow(run, schema)
    return counted.select(id_col, "n_bytes", "n_tokens", (F.col("n_tokens") > F.lit(limit)).alias("over_limit"), "n_chunks")
