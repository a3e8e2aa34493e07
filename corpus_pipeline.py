"""The corpus pipeline: documents to packed sequences.

Each stage gets (spark, docs, sf_dir), where docs is what the stage before it
left, written as Parquet and read again; all but the last return the columns of
docs. The last returns one row for each packed piece.

SQL cannot express SimHash (XXH64) or the tokenizer, so ``ORACLE_SQL`` is None;
``tests/llm/test_pipeline.py`` holds each stage against a brute-force version.

Nulls, empty tables, repeated rows and columns beside those of documents: as
each operator's docstring says. A document that loses all its words to
substring dedup stays, as an empty text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waitline.llm import common, mixing, packing, quality, simhash, substring


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the divergence reject go."""
    return quality.filtered(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose SimHash fingerprints are linked, the smallest id stays."""
    return simhash.one_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of repeated 13-word windows go from all but the smallest id; n_chars
    follows the text."""
    cut = substring.remove_repeated(docs)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return cut.select(*docs.columns)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by their source's rate, shuffled."""
    return mixing.replicated(docs).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents' token sequences, packed."""
    return packing.packed(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("source mixing", source_mixing),
    ("best-fit packing", best_fit_packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
