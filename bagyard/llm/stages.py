"""Stages of the corpus pipeline: (spark, docs, sf_dir) -> DataFrame.

All but packing take and return the columns of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bagyard.llm import minhash, mixing, packing, suffixes
from bagyard.llm import toxicity as tox
from bagyard.llm.frames import ship, table, tokenizer_file


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.3 or more go; the model is fitted on labelled documents outside the held-out fold."""
    ship(spark)
    return tox.clean(docs, tox.fit(docs, table(spark, sf_dir, "labels")))


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the document with the smallest id stays."""
    ship(spark)
    return minhash.one_of_each(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that another document keeps are cut out; all documents stay."""
    ship(spark)
    cut = suffixes.without_repeats(docs)
    return cut.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.char_length("text").cast("long")))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or more."""
    ship(spark)
    return mixing.mixed(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The encoded documents packed into sequences of 2048 tokens."""
    ship(spark)
    pieces = packing.token_pieces(docs, tokenizer_file("word_bpe_49k.json"), 2048)
    return packing.pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), 2048)
