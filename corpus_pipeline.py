"""The corpus pipeline: quality filter, exact dedup, near-dedup, source mixing, packing.

Every stage works on all documents that the one before kept. ``run`` writes each result as Parquet into
the shared folder and reads it for the next. Null ids, null and empty texts, repeated rows and empty
tables pass as the operators define; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vitalgrid.llm import exact_dedup, mixing, near_dedup, packing, quality
from vitalgrid.llm.common import documents, ship_package, stored

#: similarity of word shingles, in hundredths, from which the near-dedup stage links
NEAR_PERCENT = 80
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; it learns from ``labels``."""
    ship_package(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(docs, quality.learnable(labels))
    return quality.keep_good(docs.select(*COLUMNS), model)


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each distinct text, that with the largest id."""
    return exact_dedup.keep_distinct(docs.select(*COLUMNS))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest id."""
    ship_package(spark)
    return near_dedup.keep_one(docs.select(*COLUMNS), NEAR_PERCENT)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mix(docs.select(*COLUMNS))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of token ids, a power of two long each."""
    ship_package(spark)
    return packing.pack(docs)


STAGES = [
    ("quality", good_quality),
    ("exact dedup", distinct_texts),
    ("near dedup", one_of_near_copies),
    ("mixing", mixed_sources),
    ("packing", packed),
]

#: stages train a model, hash shingles and call a tokenizer, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; gives the pieces of the last."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
