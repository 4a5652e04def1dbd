"""The operators of this subpackage as registered queries, and their SQL where SQL can say them."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from parcelworks.llm import (
    align,
    archive,
    decontaminate,
    fingerprint,
    hard_negatives,
    lines,
    near_copies,
    packing,
    pii,
    quality,
    simhash,
    substrings,
    token_files,
)
from parcelworks.llm.ordering import new_folder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint_documents(_table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(_table(spark, sf_dir, "documents"), pii.labelled_table(spark))
    return found.selectExpr(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "sha2(base, 256) AS base_sha256", "spans", "n_spans"
    )


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> quality.Model:
    """The model of the labelled documents that are not held out."""
    labels = _table(spark, sf_dir, "labels").filter(f"NOT {quality.held_out()}")
    return quality.fit(docs, labels)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scored = quality.score(docs.select("doc_id", "text"), quality_model(spark, docs, sf_dir))
    return scored.selectExpr("doc_id", f"{quality.held_out()} AS held_out", "score", "predicted")


def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.remove_repeats(_table(spark, sf_dir, "documents"))
    return kept.selectExpr("doc_id", "n_words", "n_removed", "sha2(kept_text, 256) AS kept_sha256")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies.near_copy_groups(_table(spark, sf_dir, "documents"))


def op8_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive.archived(_table(spark, sf_dir, "pages"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "token-files")
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    token_files.write_token_files(_table(spark, sf_dir, "documents"), folder, vocabulary)
    return token_files.read_token_files(spark, folder)


def op10_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.dedup_lines(_table(spark, sf_dir, "documents"))
    return kept.selectExpr("doc_id", "n_lines", "n_removed", "sha2(kept_text, 256) AS kept_sha256")


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicate_groups(_table(spark, sf_dir, "documents"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    byte, piece = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return align.align_documents(_table(spark, sf_dir, "documents"), byte, piece)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _table(spark, sf_dir, "embeddings").selectExpr(
        "vec_id", "embedding", "CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label"
    )
    return hard_negatives.mine(table, "vec_id % 100 = 0")


QUERIES = {
    "op1_fingerprints": op1_fingerprints,
    "op2_decontamination": op2_decontamination,
    "op3_personal_data": op3_personal_data,
    "op4_quality": op4_quality,
    "op5_substrings": op5_substrings,
    "op6_packing": op6_packing,
    "op7_near_copies": op7_near_copies,
    "op8_archive": op8_archive,
    "op9_token_files": op9_token_files,
    "op10_lines": op10_lines,
    "op11_simhash": op11_simhash,
    "op12_alignment": op12_alignment,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLE: dict[str, str] = {"op10_lines": lines.ORACLE, "op13_hard_negatives": hard_negatives.ORACLE}
