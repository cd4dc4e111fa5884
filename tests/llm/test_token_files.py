"""Token files against the library, and the coding by itself."""

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from landweave.llm import queries, token_files
from landweave.llm.queries import BYTE_BPE, END_ID, WORD_BPE, vocabulary

SF = "/root/testdata/sf0.001"


def expected(rows, name=WORD_BPE):
    """doc_id, start, n_tokens and crc32 by the library alone, rows in order."""
    tok, start, found = Tokenizer.from_file(vocabulary(name)), 0, []
    for i, text in rows:
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, END_ID]
        found.append((i, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return found


@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300)))
@settings(max_examples=60, deadline=None)
def test_coding_is_lossless(values):
    ranks = np.array(values, dtype=np.uint32)
    control, data = token_files.pack(ranks)
    assert len(control) == -(-len(values) // 4)
    assert len(data) == sum(max(1, -(-v.bit_length() // 8)) for v in values)
    assert token_files.unpack(control, data, len(values)).tolist() == values


ODD = [
    "It's done;they'll  go\t\n now, WE'VE 12 3.4 <|endoftext|>x<|startoftext|>",
    "é é ß ſ İI Σας ΟΔΟΣ \U0001f642 a b c d \x1c \x85 x",
    "  ' s  't 'ré …… --- ___ \x00\x01 ́́ z",
    "word" * 3000 + " " + "漢字" * 2000,
    "<|ENDOFTEXT|> <|endof text|> ﬁ Å Ⅷ ½ ﻿",
    "", None, "\n",
]


def test_words_give_the_ids_of_whole_texts():
    words, tok = token_files.Words(vocabulary(WORD_BPE)), Tokenizer.from_file(vocabulary(WORD_BPE))
    assert words.cut and not token_files.Words(vocabulary(BYTE_BPE)).cut
    import pyarrow as pa

    texts = [t or "" for t in ODD]
    for _ in range(2):  # new words, then remembered ones
        ids, n = words.encoded(pa.array(texts))
        want = [tok.encode(t, add_special_tokens=False).ids for t in texts]
        assert n.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


ANY = st.text(alphabet=st.characters(codec="utf-8"), max_size=40)
ASCII = st.text(alphabet=st.characters(codec="ascii"), max_size=60)
NEAR = st.text(alphabet="aB's<|>reEndoftx 1!.\té", max_size=40)


@given(st.lists(ANY | ASCII | NEAR, max_size=6))
@settings(max_examples=400, deadline=None)
def test_words_give_the_ids_of_any_text(texts):
    import pyarrow as pa

    words, tok = token_files.words_of(vocabulary(WORD_BPE)), Tokenizer.from_file(vocabulary(WORD_BPE))
    ids, n = words.encoded(pa.array(texts, pa.string()))
    want = [tok.encode(t, add_special_tokens=False).ids for t in texts]
    assert n.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_a_process_forgets_and_goes_on(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(token_files, "REMEMBERED", 5)
    words, tok = token_files.Words(vocabulary(WORD_BPE)), Tokenizer.from_file(vocabulary(WORD_BPE))
    for text in ("one two three", "two four five six", "a b c d e f g h", "one"):
        assert words.encoded(pa.array([text]))[0].tolist() == tok.encode(text, add_special_tokens=False).ids


def test_query_equals_the_library(spark):
    rows = sorted((r["doc_id"], r["text"]) for r in pq.read_table(f"{SF}/documents.parquet").to_pylist())
    got = queries.op11_token_files(spark, SF)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(tuple(r) for r in got.collect()) == expected(rows)


def odd_table(spark):
    rows = [(k, t, "7") for k, t in enumerate(ODD)]
    return spark.createDataFrame([*rows, (None, "null id", "7"), (3, "word", "7"), (3, "word", "7")], "doc_id long, text string, ids string").repartition(3)


@pytest.mark.parametrize("name", [WORD_BPE, BYTE_BPE])
def test_odd_rows_in_small_files(spark, name):
    df = odd_table(spark)
    folder = token_files.write_files(df, "text", vocabulary(name), END_ID, shard_tokens=50)
    got = token_files.read_files(spark, folder)
    rows = sorted(got.collect(), key=lambda r: r["start"])
    ids = [r["doc_id"] for r in rows]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0)) and ids.count(3) == 3
    texts = {k: t for k, t in enumerate(ODD) if k != 3} | {None: "null id"}
    tok, start = Tokenizer.from_file(vocabulary(name)), 0
    for r in rows:
        found = np.frombuffer(r["ids"], "<u4").tolist()
        wanted = [[*tok.encode(t or "", add_special_tokens=False).ids, END_ID] for t in ([texts[r["doc_id"]]] if r["doc_id"] != 3 else [ODD[3], "word"])]
        assert found in wanted and (r["start"], r["n_tokens"]) == (start, len(found))
        start += len(found)
    index = spark.read.parquet(f"{folder}/index")
    assert index.count() > 3 and index.agg({"tokens": "sum"}).first()[0] == start
    ranks = np.fromfile(f"{folder}/ranks.bin", "<u4")
    counts = np.bincount(np.concatenate([np.frombuffer(r["ids"], "<u4") for r in rows]))
    assert (np.diff(counts[ranks]) <= 0).all() and len(ranks) == (counts > 0).sum()


def test_empty_table_and_damaged_file(spark, tmp_path):
    got = token_files.file_digests(odd_table(spark).limit(0), "text", vocabulary(WORD_BPE), END_ID)
    assert got.collect() == [] and got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    parts = token_files.file_parts(0, 0, [1], [3], np.array([1, 2, 70_000], np.uint32))
    data = b"".join(bytes(p) for p in parts)
    assert token_files.parsed(data)[2].tolist() == [1, 2, 70_000]
    with pytest.raises(ValueError):
        token_files.parsed(data[:-1])
    token_files.put(str(tmp_path), "x", [b"1"])
    token_files.put(f"file://{tmp_path}", "x", [b"2"])
    assert [p.name for p in tmp_path.iterdir()] == ["x"] and (tmp_path / "x").read_bytes() == b"2"


def test_strings_are_listed_as_arrow_lists_them():
    for some in ([], ["", "a", "é\x00ü", "😀" * 3, "a"]):
        for kind in (pa.string(), pa.large_string()):
            assert token_files.strings(pa.array(some, kind)) == some
    assert token_files.strings(pa.array(["x", "yy", "z"], pa.large_string()).slice(1)) == ["yy", "z"]
