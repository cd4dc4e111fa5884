"""The corpus pipeline: five stages over documents, each written as Parquet and read by the next.

Every stage takes and returns whole rows. Defined cases, for all stages: an empty table gives an empty one; null and empty
texts pass but where a stage says otherwise; rows that share an id are documents of their own; columns beyond those of documents
are carried along, whatever they are called; ties are broken as the stage's operator says.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landweave.llm import importance, jaccard_join, line_spread, piece_merge, queries, template_match
from landweave.llm.tables import free_name, read, shared_dir
from landweave.session import ship


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling keeps; null and empty texts, whose weight is 0, are drawn like those at the edge."""
    ship(spark)
    return importance.keep(docs, read(spark, sf_dir, "labels")).select(docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without cross-site boilerplate lines; those that were nothing else go. A cut text has its n_chars counted anew."""
    ship(spark)
    removed = F.col(free_name(docs.columns, "n_removed"))
    cut = line_spread.remove_boilerplate(docs)
    emptied = (removed > 0) & (F.trim(F.col("text")) == "")
    kept = cut.where(~F.coalesce(emptied, F.lit(False)))
    size = F.when(removed > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", size).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies, that of the smallest id: five-word shingles, Jaccard 0.8 or more.

    Documents without words all stay.
    """
    ship(spark)
    return jaccard_join.one_of_each(docs, measure=jaccard_join.Measure(words=5, num=4, den=5))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark, as it is or re-parameterised."""
    ship(spark)
    return template_match.clean(docs, read(spark, sf_dir, "benchmark"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's SentencePiece ids and digests: doc_id, n_tokens, ids_sha256, decoded_sha256; none of an empty text."""
    ship(spark)
    return piece_merge.encoding_digests(docs, "text", queries.vocabulary(queries.PIECE_BPE))


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate), ("pieces", pieces)]

#: The first stage's sampling and the last stage's encoding can't be said in SQL; tests/llm holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage for documents in sf_dir."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{shared_dir(spark)}/landweave/pipeline-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
