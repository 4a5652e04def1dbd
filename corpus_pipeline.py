"""The corpus pipeline: quality, repeated lines, near copies, benchmark passages, packing.

Each stage takes (spark, docs, sf_dir), works on all that the one before kept, and returns the
columns of documents, the last one the packed pieces. Stages meet through Parquet below the folder
that all executors share.
"""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from parcelworks.llm import decontaminate, lines, near_copies, packing, quality
from parcelworks.llm.ordering import new_folder
from parcelworks.llm.queries import quality_model

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    scored = quality.score(docs, quality_model(spark, docs, sf_dir))
    return scored.filter("predicted = 1").select(*COLUMNS)


def fresh_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated windows of lines; a document that loses all its lines goes."""
    kept = lines.kept_lines(docs).filter("n_lines = 0 OR n_removed < n_lines")
    return kept.selectExpr("doc_id", "kept_text AS text", "lang", "source", "char_length(kept_text) AS n_chars").selectExpr(
        "doc_id", "text", "lang", "source", "bigint(n_chars) AS n_chars"
    )


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest key of each group of near copies."""
    gone = near_copies.near_copy_groups(docs).filter("NOT kept").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.without_items(docs, benchmark).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the kept documents."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", good_quality),
    ("line dedup", fresh_lines),
    ("near copies", one_of_each),
    ("benchmark decontamination", without_benchmark),
    ("packing", packed),
]

#: SQL cannot express the classifier; tests hold run() against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for place, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            folder = new_folder(spark, name.replace(" ", "-"))
            docs.write.parquet(folder)
            docs = spark.read.parquet(folder)
    return docs
