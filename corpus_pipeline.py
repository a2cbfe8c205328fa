"""Corpus pipeline: from raw documents to packed training sequences."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from wardflow.llm.common import Scratch, documents, ship_package, shuffle_partitions
from wardflow.llm.exact import keep_owners
from wardflow.llm.near import near_duplicates
from wardflow.llm.packing import pack_documents
from wardflow.llm.quality import passing
from wardflow.llm.substring import remove_repeats


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the compression bands."""
    ship_package(spark)
    return passing(docs)


def by_row(docs: DataFrame, stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``stage`` on ``docs`` with ids that name one row each.

    Where a doc_id is null or repeated, all rows are numbered in the order of
    doc_id (null last) and text hash, and the numbers take the place of doc_id
    within the stage.
    """
    unclear = docs.groupBy("doc_id").agg(F.count("*").alias("c")).where("c > 1 OR doc_id IS NULL")
    if unclear.isEmpty():
        return stage(docs)
    spark = docs.sparkSession
    order = [F.col("doc_id").asc_nulls_last(), F.col("h"), F.col("at")]
    keyed = docs.select(F.struct("*").alias("own"), "doc_id", "text", F.xxhash64("text").alias("h"),
                        F.monotonically_increasing_id().alias("at"))  # deals out equal rows, too
    ranged = keyed.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
    # written, so that the numbers are the same whenever they are read
    rows = Scratch(spark, "rows").save(
        ranged.select(F.monotonically_increasing_id().alias("doc_id"), "text", "own"), "numbered")
    return stage(rows).select("own.*")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (blanks aside) one row: the longest original, then the smallest doc_id."""
    ship_package(spark)
    return by_row(docs, keep_owners)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows linked by 80 % of their five-word shingles the one of the smallest doc_id."""
    ship_package(spark)
    return by_row(docs, _first_of_linked)


def _first_of_linked(docs: DataFrame) -> DataFrame:
    kept = near_duplicates(docs, width=5, percent=80).where("kept").select("doc_id").distinct()
    rows = docs.select("doc_id", F.struct("*").alias("row"))
    return rows.join(kept, rows.doc_id.eqNullSafe(kept.doc_id), "left_semi").select("row.*")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 20 words that occur earlier; a text without any stays as it is.

    Documents of which no word is left go.
    """
    ship_package(spark)
    cut = remove_repeats(docs, carry=tuple(docs.columns)).where("n_words > n_removed")
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("row.text"))
    new = {"text": text, "n_chars": F.length(text).cast("bigint")}
    return cut.select(*[new.get(c, F.col(f"row.{c}")).alias(c) for c in docs.columns])


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents packed into sequences of at most 2048 tokens."""
    ship_package(spark)
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("MinHash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("best-fit packing", best_fit_packing),
]

# zstandard ratios, near-duplicate components and tokens have no SQL form; the
# tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = documents(spark, sf_dir)
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = scratch.save(docs, f"stage-{k}")
    return docs
