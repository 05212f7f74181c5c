"""Registered queries of the corpus operators: each over whole tables and whole texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid.llm import (
    binary_output, bisector, exact_dedup, hmm, language, mixing, near_dedup, ngram_join, order_minhash, packing,
    periodic, quality)
from vitalgrid.llm.common import crc_remainder, documents, shared_folder, ship_package, stored
from vitalgrid.llm.token_rollup import Rollup, count_tokens


def op1_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after four batches: all documents come in; copies of later documents go; a second tokenizer
    version comes in; documents that repeat lines are counted again without the repetitions.

    The counts of all three kinds are made in one pass over the texts and stored; only numbers are joined.
    """
    digest = F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)
    counted = stored(count_tokens(documents(spark, sf_dir).withColumn("digest", digest), "doc_id", "source", "lang", "digest"),
                     "token-counts")

    def changes(rows: DataFrame, op: str, tokenizer: str, n_tokens) -> DataFrame:
        return rows.select("doc_id", F.lit(op).alias("op"), "source", "lang", F.lit(tokenizer).alias("tokenizer"), n_tokens)

    rollup = Rollup.create(spark, shared_folder(spark, "token-rollup"))
    rollup.commit("load", changes(counted, "insert", "words/1", F.col("words").alias("n_tokens")))
    # of equal texts the document with the largest id stays
    copies = counted.groupBy("digest").agg(F.max("doc_id").alias("last")).withColumnRenamed("digest", "_digest")
    marked = stored(counted.join(copies, F.col("digest") == F.col("_digest")).select(
        *counted.columns, F.col("doc_id").eqNullSafe(F.col("last")).alias("stays")), "token-counts")
    rollup.commit("copies", changes(marked.where("not stays"), "delete", "words/1", F.lit(0).alias("n_tokens")))
    left = marked.where("stays")
    rollup.commit("words/2", changes(left, "insert", "words/2", F.col("marks").alias("n_tokens")))
    rollup.commit("lines", changes(left, "revise", "words/1", F.col("words_once").alias("n_tokens")))
    return rollup.totals()


def op2_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.compare_with_next(documents(spark, sf_dir))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(docs, quality.learnable(labels))
    return quality.score(docs, model).select(
        "doc_id", (crc_remainder("doc_id", 5) == 0).alias("held_out"), "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(documents(spark, sf_dir))


def op5_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written to shards in the shared folder, then read back from them."""
    manifest = binary_output.write_tokens(documents(spark, sf_dir), shared_folder(spark, "token-shards"))
    return binary_output.read_tokens(manifest).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = language.identify(docs, language.fit(language.learnable(docs)))
    return found.select(
        "doc_id", (crc_remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op7_hmm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score_texts(documents(spark, sf_dir))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir)).drop("uid")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.systematic_copies(documents(spark, sf_dir)).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir)).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_groups(documents(spark, sf_dir))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.run_digests(documents(spark, sf_dir))


def op13_bisector_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return bisector.clustered(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_token_rollup, op2_order_minhash, op3_quality, op4_near_dedup, op5_token_output, op6_language,
        op7_hmm_scores, op8_exact_dedup, op9_mixing, op10_packing, op11_ngram_join, op12_periodic_runs, op13_bisector_clusters)}
