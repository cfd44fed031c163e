"""The subpackage's queries over the test tables, and the SQL of those that have one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymill.llm import (
    alignment,
    compression,
    hamming,
    licenses,
    minhash,
    packing,
    pieces,
    quality,
    sharding,
    token_files,
    toxicity,
    urls,
    whitening,
)

#: The sites that the URL query lists.
SITES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression.compression_rules(table(spark, sf_dir, "documents"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("row.doc_id", "evidence", "host_posterior", "path_posterior", "score", "kept")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [urls.site_rule(verdict, name) for verdict, name in SITES]
    return urls.url_filter(table(spark, sf_dir, "pages"), [*rules, *urls.PATTERNS])


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, links = minhash.near_dedup_links(table(spark, sf_dir, "documents"))
    return docs.join(links.counts(), "class_id", "left").select(
        "doc_id", "class_id", F.coalesce("n", F.lit(0)).alias("n_links"), "component_id", "kept"
    )


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit_packing(table(spark, sf_dir, "documents"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents"))


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming.near_vectors(table(spark, sf_dir, "embeddings"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharding(table(spark, sf_dir, "documents"))


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_output(table(spark, sf_dir, "documents"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment(table(spark, sf_dir, "documents"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    whitened = whitening.whiten(table(spark, sf_dir, "embeddings"))
    # Null where the exact value doesn't fit.
    return whitened.withColumn("deviation", F.col("deviation").try_cast("long"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    found = [
        op1_toxicity, op2_compression_bands, op3_license_scan, op4_quality_classifier, op5_url_filter, op6_sentencepiece,
        op7_embedding_near_dedup, op8_minhash,
        op9_best_fit_packing, op10_sharding, op11_token_files, op12_token_alignment,
        op13_embedding_whitening,
    ]
    return {f.__name__: f for f in found} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {}
