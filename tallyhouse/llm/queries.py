"""One query per corpus operator over the given tables, with production parameters, and SQL where SQL can say it."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decontamination, neighbours, phrases, pieces, quality, sharding, simhash, suffix_dedup, token_counts, tool_calls, toxicity,
    warc, whitening,
)
from .common import read_table, write_through
from .oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = read_table(spark, folder, "documents"), read_table(spark, folder, "labels")
    model = toxicity.fit(toxicity.training_rows(docs, labels))
    scored = toxicity.score(docs, model, threshold=0.7, kept=["doc_id"])
    return scored.select(
        "doc_id",
        toxicity.held_out().alias("held_out"),
        F.col("tox_score").alias("score"),
        F.col("tox_predicted").alias("predicted"),
    )


def op2_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs, benchmark = read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark")
    return decontamination.find_leaks(docs, benchmark).drop("h")


def op3_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, folder, "documents"), words=3, distance=3)
    return found.select("doc_id", "fingerprint", "component_id")


def op4_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = suffix_dedup.repeat_report(read_table(spark, folder, "documents"), length=400)
    return found.withColumn("loses_bytes", (F.col("n_removed") > 0).cast("int"))


def op5_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    calls, results = tool_calls.calls_of(read_table(spark, folder, "conversations"))
    tools = spark.createDataFrame([(name, json.dumps(schema)) for name, schema in tool_calls.TOOLS], "name string, schema string")
    return tool_calls.link_calls(calls, results, tools)


def op6_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive_report(spark, read_table(spark, folder, "pages"))


def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_by_section(read_table(spark, folder, "documents"), rule="first")


def op8_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.encode_documents(read_table(spark, folder, "documents"))


def op9_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = read_table(spark, folder, "embeddings")
    return neighbours.nearest_neighbours(vectors, vectors.filter("vec_id % 50 = 0"), k=5)


def op10_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_by_bytes(read_table(spark, folder, "documents"), shards=24)


def op11_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(read_table(spark, folder, "documents"), least=30, share=80, first=2000)


def op12_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    vectors = read_table(spark, folder, "embeddings")
    model = whitening.fit(vectors, components=8)
    # read twice, for the covariance and for the rows
    done = write_through(whitening.transform(vectors, model, kept=["vec_id"]), "whitened")
    return whitening.report(done, model)


def op13_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = read_table(spark, folder, "documents"), read_table(spark, folder, "labels")
    model = quality.fit(quality.training_rows(docs, labels))
    scored = quality.score(docs, model, threshold=0.7, kept=["doc_id"])
    return scored.select(
        "doc_id",
        quality.held_out().alias("held_out"),
        F.col("quality_score").alias("score"),
        F.col("quality_predicted").alias("predicted"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_benchmark_decontamination": op2_benchmark_decontamination,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_suffix_array_dedup": op4_suffix_array_dedup,
    "op5_chat_formatting": op5_chat_formatting,
    "op6_warc": op6_warc,
    "op7_token_counts": op7_token_counts,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_nearest_neighbours": op9_nearest_neighbours,
    "op10_sharding": op10_sharding,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_quality_classifier": op13_quality_classifier,
}
