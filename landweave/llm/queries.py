"""The registered corpus queries, one per operator and the pipeline, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bilinear, importance, jaccard_join, lexical_search, license_rules, line_spread, media, piece_merge, private_spans, target_resampling, template_match, token_counts, token_files
from .tables import read

BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"
WORD_BPE = "word_bpe_49k.json"
END_ID = 2


def vocabulary(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.kept_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op2_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_rules.scan(read(spark, sf_dir, "documents"), "text").drop("detections")


def op3_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_spread.remove_boilerplate(read(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return cut.select("doc_id", "n_lines", "n_removed", F.md5(F.encode("text", "UTF-8")).alias("text_md5"))


def op4_bilinear_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bilinear.score(read(spark, sf_dir, "documents"))


def op5_private_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents")
    return private_spans.span_digests(private_spans.find_spans(documents, private_spans.fit(documents)))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read(spark, sf_dir, "documents"), "text", vocabulary(BYTE_BPE))


def op7_template_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return template_match.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op8_media_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.document_media(read(spark, sf_dir, "documents"), "doc_id", "text")


def op9_piece_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_merge.encoding_digests(read(spark, sf_dir, "documents"), "text", vocabulary(PIECE_BPE))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link_components(read(spark, sf_dir, "documents"))


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.file_digests(read(spark, sf_dir, "documents"), "text", vocabulary(WORD_BPE), END_ID)


def op12_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return target_resampling.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.ranked(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_importance_resampling, op2_license_rules, op3_line_spread, op4_bilinear_scores, op5_private_spans, op6_token_counts, op7_template_match, op8_media_sequences, op9_piece_merge, op10_jaccard_join, op11_token_files, op12_target_resampling, op13_lexical_search, pipeline)}


def oracle_sql() -> dict[str, str]:
    return {"op2_license_rules": license_rules.oracle(), "op3_line_spread": line_spread.ORACLE, "op10_jaccard_join": jaccard_join.ORACLE, "op13_lexical_search": lexical_search.ORACLE}
