"""Registered queries of the operators: each applies one, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomdex.llm import (
    fim, html_text, licenses, minhash, multi_index, packing, quality, repeats_sql, seed_extend, simhash, suffix_dedup, tiling, toxicity, whitening,
)
from loomdex.llm.common import keep, table

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary(name: str) -> str:
    """File of a public vocabulary. It is part of an installed package, so every executor has it."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _in_fold(remainder: int, n: int):
    return F.coalesce(toxicity.remainder("doc_id", n) == remainder, F.lit(False))


def op1_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    labels = table(spark, folder, "labels").where(~_in_fold(0, 5)).selectExpr("doc_id", "quality as label")
    scored = quality.score(docs, quality.learn(docs, labels))
    return scored.select(
        "doc_id", _in_fold(0, 5).alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted")
    )


def op2_license_scans(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.licenses(table(spark, folder, "documents"))


def op3_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents")).select("doc_id", "class_id", "class_size")


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    labels = table(spark, folder, "labels").where(~_in_fold(2, 4)).selectExpr("doc_id", "toxic as label")
    scored = toxicity.score(docs, toxicity.learn(docs, labels))
    return scored.select(
        "doc_id", _in_fold(2, 4).alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted")
    )


def op5_inverted_multi_index(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return multi_index.search(vectors, vectors.where("vec_id % 50 = 0"), k=5)


def op6_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(table(spark, folder, "pages"))


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), vocabulary("byte_bpe_50k.tiktoken"))


def op8_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, folder, "documents"))


def op9_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return seed_extend.remove_repeats(table(spark, folder, "documents"))


def op10_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = tiling.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("row.doc_id", F.explode("matches").alias("m")).select("doc_id", "m.*")


def op11_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    white = whitening.whiten(table(spark, folder, "embeddings"), 4)
    return white.withColumn("deviation", F.col("deviation").cast("long"))


def op12_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    store = keep(fim.frame_store(table(spark, folder, "documents")), "frames")
    return fim.outputs(fim.fill_in_middle(store), text=False).withColumnRenamed("units", "n")


def op13_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents")).select("doc_id", "fingerprint", "component_id")


QUERIES: dict[str, Query] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_license_scans": op2_license_scans,
    "op3_minhash_near_dedup": op3_minhash_near_dedup,
    "op4_toxicity": op4_toxicity,
    "op5_inverted_multi_index": op5_inverted_multi_index,
    "op6_html_extraction": op6_html_extraction,
    "op7_packing": op7_packing,
    "op8_suffix_array_dedup": op8_suffix_array_dedup,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_benchmark_decontamination": op10_benchmark_decontamination,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_simhash_near_dedup": op13_simhash_near_dedup,
}
ORACLES: dict[str, str] = {
    "op2_license_scans": licenses.oracle(),
    "op8_suffix_array_dedup": repeats_sql.repeated_bytes(suffix_dedup.LEAST),
    "op9_substring_dedup": repeats_sql.repeated_words(),
    "op12_fill_in_middle": fim.oracle(),
}
