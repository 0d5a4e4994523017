"""From raw documents to token ids: toxicity, near-duplicates, repeated passages, benchmark leaks, encoding.

Each stage is one operator of the corpus subpackage over all that the stage before kept.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.llm import decontamination, pieces, simhash, suffix_dedup, toxicity
from tallyhouse.llm.common import read_table, write_through


#: Rows that go to a Python worker at once. Whole texts are long: the default of 10,000 rows holds tens of megabytes
#: on both sides, in memory that neither side gives back between the stages.
ROWS_AT_ONCE = 512
BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def in_small_batches(stage):
    """The setting holds when the stage's rows are computed, after it returns; ``run`` puts the caller's back."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set(BATCH_CONF, str(ROWS_AT_ONCE))
        return stage(spark, docs, sf_dir)

    return run_stage


@in_small_batches
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the toxicity model, learned from the labels, does not reject.

    Each row is judged by its whole text alone: rows with null ids, and repeated rows, stay or go by it. A null or empty
    text has no toxic words and stays. Labels of too few documents reject nothing, with a warning.
    """
    return toxicity.without_toxic(docs, read_table(spark, sf_dir, "labels"))


@in_small_batches
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: its smallest doc_id. Of repeated rows, null ids and null texts see
    ``simhash.one_of_each``."""
    return simhash.one_of_each(docs, words=3, distance=3)


@in_small_batches
def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the bytes of 400-byte strings that stand anywhere else. Every row stays, one that loses
    all bytes with an empty text; a null text stays null."""
    return suffix_dedup.cut_texts(docs, length=400)


@in_small_batches
def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark item. Rows with equal ids and texts go or stay together, null ids as well;
    a null or empty text holds nothing and stays."""
    return decontamination.without_leaks(docs, read_table(spark, sf_dir, "benchmark"))


@in_small_batches
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens, n_chars, round_trip of each row; a null or empty text has no ids."""
    return pieces.encode_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeats),
    ("benchmark_decontamination", drop_leaks),
    ("sentencepiece", encode),
]

# trained scores, fingerprints, edit distances and segmentations are not SQL; see tests/llm/test_pipeline.py
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = read_table(spark, sf_dir, "documents"), spark.conf.get(BATCH_CONF)
    try:
        for name, stage in STAGES:
            docs = write_through(stage(spark, docs, sf_dir), name)
    finally:
        spark.conf.set(BATCH_CONF, before)
    return docs
