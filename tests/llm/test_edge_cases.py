"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns, for every operator."""

import pytest
from pyspark.sql import functions as F

from landweave.llm import bilinear, importance, jaccard_join, license_rules, line_spread, media, piece_merge, private_spans, span_net, template_match, token_counts
from landweave.llm.queries import BYTE_BPE, PIECE_BPE, vocabulary

LONG = "word and other words 42 at me@site.example.com, " * 4000
SAME = "the same text stands here again and again for all to read"
CLASH = "w string, h long, id string, n int, label string, site string, list long, keys string, items string, digest string, n_words int, spans string, words string, tail int, uid long, pos int, first string, n_lines string, n_removed string, __id string, __row string, __cut string, key long, row long, least long, component long, main string, bits string, __key string, n_windows long"
NAMES = [c.split()[0] for c in CLASH.split(", ")]


def table(spark, rows):
    """doc_id, text, source, lang, n_chars and a column of each name that operators use inside."""
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    more = {c.split()[0]: F.lit("7").cast(c.split()[1]) for c in CLASH.split(", ")}
    return df.withColumns({"lang": F.lit("en"), "n_chars": F.length("text").cast("long"), **more})


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(1, None, "a"), (2, "", None), (3, "   \n\n ", "b"), (4, SAME, "a"), (5, SAME, "b"), (6, LONG, None), (7, "one", "c"), (8, "é ß \U0001f642 Ω", "c"), (9, SAME, "b"), (9, SAME, "b"), (10, "\x01\x02\x00", "c")]
    return table(spark, rows)


@pytest.fixture(scope="module")
def empty(spark):
    return table(spark, [])


@pytest.fixture(scope="module")
def net():
    return span_net.initial(1)


def counts(df):
    found = {}
    for r in df.collect():
        found.setdefault(r["doc_id"], []).append(r)
    return found


def operators(spark, net):
    labels = spark.createDataFrame([(4, 1, 0), (5, 1, 0), (6, 0, 0), (7, 1, 1), (None, 1, None), (9, None, None)], "doc_id long, quality int, toxic int")
    benchmark = spark.createDataFrame([(1, SAME), (2, None), (3, ""), (4, SAME), (5, "too short")], "item_id long, text string")
    return {
        "importance": lambda df: importance.kept_scores(df, labels),
        "importance without labels": lambda df: importance.kept_scores(df, labels.limit(0)),
        "license_rules": lambda df: license_rules.scan(df, "text"),
        "line_spread": line_spread.remove_boilerplate,
        "bilinear": lambda df: bilinear.score(df, rounds=1),
        "private_spans": lambda df: private_spans.span_digests(private_spans.find_spans(df, net)),
        "token_counts": lambda df: token_counts.token_counts(df, "text", vocabulary(BYTE_BPE)),
        "template_match": lambda df: template_match.leaks(df, benchmark),
        "template_match on no items": lambda df: template_match.leaks(df, benchmark.limit(0)),
        "media": lambda df: media.document_media(df, "doc_id", "text"),
        "piece_merge": lambda df: piece_merge.encoding_digests(df, "text", vocabulary(PIECE_BPE)),
        "jaccard_join": jaccard_join.link_components,
    }


WHOLE = {"license_rules", "line_spread", "bilinear", "private_spans", "token_counts", "media", "piece_merge", "jaccard_join"}


@pytest.mark.parametrize("name", ["importance", "importance without labels", "license_rules", "line_spread", "bilinear", "private_spans", "token_counts", "template_match", "template_match on no items", "media", "piece_merge", "jaccard_join"])
def test_odd_rows_and_empty_tables(spark, odd, empty, net, name):
    run = operators(spark, net)[name]
    got = run(odd)
    rows = got.collect()
    if name in WHOLE:
        assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in odd.select("doc_id").collect())
    by_text = {}
    for r in rows:
        if r["doc_id"] in (4, 5, 9):
            by_text.setdefault(tuple(str(v) for k, v in r.asDict().items() if k in got.columns and k not in ("doc_id", "source", "held_out", "gumbel_key", "component_id", *NAMES)), 0)
    assert len(by_text) <= 1 or name in ("template_match", "line_spread")
    assert run(empty).collect() == [] and run(empty).columns == got.columns


def test_defined_results_of_empty_texts(spark, odd, net):
    ops = operators(spark, net)
    for i in (1, 2):
        assert counts(ops["token_counts"](odd))[i][0]["n_tokens"] == 0
        r = counts(ops["license_rules"](odd))[i][0]
        assert (r["n_words"], r["n_base"], r["first_word"], r["labels"], r["score"]) == (0, 0, None, "", 0.0)
        r = counts(ops["jaccard_join"](odd))[i][0]
        assert (r["n_shingles"], r["component_id"]) == (0, i)
        assert counts(ops["bilinear"](odd))[i][0]["n_tokens"] == 1
        assert counts(ops["media"](odd))[i][0]["payload_bytes"] == 64
        assert counts(ops["piece_merge"](odd))[i][0]["n_tokens"] == 0
    assert {r["component_id"] for i in (4, 5, 9) for r in counts(ops["jaccard_join"](odd))[i]} == {4}


def test_line_spread_leaves_null_and_columns_alone(spark, odd):
    got = line_spread.remove_boilerplate(odd, min_sites=2)
    assert set(odd.columns) <= set(got.columns)
    rows = counts(got)
    assert rows[1][0]["text"] is None and rows[2][0]["text"] == ""
    assert rows[4][0]["text"] == SAME and rows[5][0]["text"] == "" and (rows[5][0]["n_removed"], rows[5][0]["n_removed_"]) == ("7", 1)
    assert rows[4][0]["w"] == "7"


def test_pipeline_stages_keep_columns_of_documents(spark, odd, empty, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([(4, 1, 0), (6, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "nothing of the kind is in any of these texts at all")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in (odd, empty):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, str(tmp_path))
            assert name == "pieces" or out.columns == docs.columns
            assert out.count() <= docs.count()


TWO = [(5, "boiler line\nx"), (5, "unique words here\nsecond unique"), (None, "boiler line\ny"), (None, "z\nboiler line"), (2, "boiler line"), (2, "boiler line\ntail")]


def test_rows_of_one_id_are_cut_by_their_own_lines(spark):
    df = spark.createDataFrame([(i, t, f"s{k}") for k, (i, t) in enumerate([*TWO, (9, "other\nboiler line")])], "doc_id long, text string, source string")
    got = sorted((str(r["doc_id"]), r["text"], r["n_removed"]) for r in line_spread.remove_boilerplate(df, min_sites=3).collect())
    # the null id is the smallest one, and its first place is 0
    assert got == sorted([("5", "x", 1), ("5", "unique words here\nsecond unique", 0), ("None", "boiler line\ny", 0), ("None", "z", 1), ("2", "", 1), ("2", "tail", 1), ("9", "other", 1)])


def test_rows_of_one_id_link_by_their_own_text(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(60)) for x in "abc")
    rows = [(1, a + " end"), (3, b + " end"), (2, a), (2, b), (None, c), (None, c + " more"), (8, c + " end"), (7, "x"), (7, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r["doc_id"]), r["component_id"]) for r in jaccard_join.link_components(df).collect())
    assert got == sorted([("1", 1), ("2", 1), ("2", 2), ("3", 2), ("None", 8), ("None", 8), ("8", 8), ("7", 7), ("7", 7)])
    kept = sorted((r["doc_id"], r["text"]) for r in jaccard_join.one_of_each(df.unionAll(df)).collect())
    assert kept == sorted([(1, a + " end"), (2, b), (8, c + " end"), (7, "x"), (7, "y")])


def test_twins_tell_rows_of_one_id_apart(spark):
    """The SQL of the two operators gives what they give where ids repeat."""
    duckdb = pytest.importorskip("duckdb")
    body = "boiler line\n" + " ".join(f"w{k}" for k in range(50))
    rows = [(k // 2, body + (f" {k % 3}" if k % 4 else "") if k % 5 else f"own text {k}\nboiler line", f"site{k % 12}") for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    con = duckdb.connect()
    con.register("documents", df.toArrow())
    key = lambda r: tuple(map(str, r))
    got = line_spread.remove_boilerplate(df).select("doc_id", "n_lines", "n_removed", F.md5(F.encode("text", "UTF-8")))
    assert sorted(map(tuple, got.collect()), key=key) == sorted(con.execute(line_spread.ORACLE).fetchall(), key=key)
    assert sorted(map(tuple, jaccard_join.link_components(df).collect()), key=key) == sorted(con.execute(jaccard_join.ORACLE).fetchall(), key=key)


def test_row_filter_loses_no_wanted_row(spark):
    from landweave.llm.tables import let_through, materialise

    rows = spark.range(30_000).select(F.struct(F.when(F.col("id") % 7 != 0, F.col("id")).alias("id"), (F.col("id") * 31).alias("row")).alias("doc"))
    wanted = materialise(rows.where("doc.row % 93 = 0"), "wanted")
    got = let_through(rows, "doc", wanted)
    assert wanted.count() == 10_000 and wanted.join(got, "doc", "left_anti").count() == 0 and got.count() < 12_000
    assert got.columns == rows.columns and let_through(rows, "doc", wanted.limit(0)).count() == 0
