"""The corpus pipeline: documents without toxic, poor and repeated texts, packed into sequences.

Without usable labels the first two stages keep every document. Null and empty texts are judged as texts without words. Long
texts are taken whole. Rows that repeat are judged row by row until the near copies, of which one row stays. Other columns,
whatever their names, pass through to the packing, which returns pieces. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymill.llm import minhash, packing, quality, toxicity
from tallymill.session import settle


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, _labels(spark, sf_dir))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.quality(docs, _labels(spark, sf_dir)).where("kept").select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of copies and near copies one row stays, whatever the rows' ids: ids may be null or repeated, and rows
    that share one are judged by their texts. Rows without a text are copies of nothing, empty texts are of each other."""
    number = "row"
    while number in docs.columns:
        number += "_"
    # Written, so that a row keeps its number.
    rows = settle(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    judged = minhash.representatives(rows.select(F.col(number).alias("doc_id"), "text"))
    kept = judged.where("kept").select(F.col("doc_id").alias(number))
    return rows.join(kept, number, "left_semi").drop(number)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.best_fit_packing(docs)


STAGES = [("toxicity", drop_toxic), ("quality", drop_poor), ("minhash", drop_near_copies), ("packing", pack)]
#: Fitted models and token ids have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name)
    return docs
