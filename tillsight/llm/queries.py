"""The registered queries of this subpackage, as ``callable(spark, folder) -> DataFrame``."""

from __future__ import annotations

import pathlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decontaminate, hard_negatives, jaccard_join, licenses, packing, pieces, quality_rules, secret_scan,
    token_counts, token_files, toxicity, url_filters, whitening,
)
from .workers import small_batches

WORD_BPE, BYTE_BPE, PIECES = "word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"

#: Where Python workers find this package if it is not installed on them.
ROOT = str(pathlib.Path(__file__).resolve().parents[2])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    small_batches(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def packed(docs: DataFrame) -> DataFrame:
    """Pieces with a checksum of their ids, and their places in sequences of 4096 tokens."""
    capacity = 4096
    cut = packing.pieces(docs, public_tokenizers.path(WORD_BPE), 1, capacity)
    narrow = cut.select("part", "row", "doc_id", "piece", "start", "length",
                        F.crc32("ids").alias("ids_crc32"))
    placed = packing.place(narrow, capacity, [F.col("part"), F.col("row"), F.col("piece")])
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packed(table(spark, folder, "documents"))


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judge(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def op3_url_words(spark: SparkSession, folder: str) -> DataFrame:
    return url_filters.judge(table(spark, folder, "pages"))


def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.scan(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"), "spans")


def op5_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.join(table(spark, folder, "documents"))


def op6_license_digests(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, folder, "labels")))


def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count(table(spark, folder, "documents"), public_tokenizers.path(PIECES))


def op9_token_files(spark: SparkSession, folder: str) -> DataFrame:
    stored = token_files.through_files(table(spark, folder, "documents"),
                                       public_tokenizers.path(BYTE_BPE))
    return stored.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op10_secret_battery(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.scan(table(spark, folder, "documents"))
    base = F.filter("spans", lambda s: s["rank"] < len(secret_scan.BASE))

    def number(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(number, secret_scan.BASE),
        F.sha2(secret_scan.listed(base), 256).alias("base_sha256"),
        secret_scan.listed("spans").alias("spans"))


def op11_pieces(spark: SparkSession, folder: str) -> DataFrame:
    done = pieces.round_trip(table(spark, folder, "documents"), public_tokenizers.path(PIECES))
    return done.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    # Where vec_id is divisible by 7 a wrong label is planted.
    label = F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END")
    return hard_negatives.mine(table(spark, folder, "embeddings"), F.expr("vec_id % 50 = 0"), label)


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_quality_rules": op2_quality_rules,
    "op3_url_words": op3_url_words,
    "op4_decontamination": op4_decontamination,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_license_digests": op6_license_digests,
    "op7_toxicity": op7_toxicity,
    "op8_token_counts": op8_token_counts,
    "op9_token_files": op9_token_files,
    "op10_secret_battery": op10_secret_battery,
    "op11_pieces": op11_pieces,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_whitening": op13_whitening,
}


def oracle_sql() -> dict[str, str]:
    return {"op6_license_digests": licenses.oracle(), "op12_hard_negatives": hard_negatives.oracle()}
