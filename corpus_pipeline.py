"""A training corpus from raw documents: each stage reads what the one before wrote.

Every function of ``STAGES`` takes the session, the documents left and the folder of tables, and returns a
DataFrame; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keytables.llm import minhash_dedup, mixing, ordinal_quality, piece_encoding, substring_dedup
from keytables.llm.queries import OTHER_RATE, SOURCE_WEIGHTS
from keytables.sources.scratch import remove_scratch, scratch_path, scratch_scope

# Per cent; the query op3 alone asks for 85.
NEAR_DUPLICATES = 80

# Tokenizers and trained models are not for SQL to express.
ORACLE_SQL = None


def choose(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = ordinal_quality.train(docs, ordinal_quality.graded_labels(labels))
    return ordinal_quality.grade(docs, model).where("selected").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash_dedup.one_of_each_group(docs, similarity=NEAR_DUPLICATES)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    left = substring_dedup.remove_repeats(docs)
    n_chars = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rates = mixing.repetition_rates(docs, "source", SOURCE_WEIGHTS, size=F.col("n_chars"))
    return mixing.mix_sources(docs, "source", rates, default_rate=OTHER_RATE).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return piece_encoding.encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", choose),
    ("near duplicates", drop_near_duplicates),
    ("substrings", drop_repeats),
    ("mixing", mix),
    ("encoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again. Nothing but the last one's result is left."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES:
        path = scratch_path(spark, f"corpus-{name.replace(' ', '-')}")
        try:
            with scratch_scope(spark):
                stage(spark, docs, sf_dir).write.parquet(path)
        except BaseException:
            remove_scratch(spark, path)
            raise
        finally:
            if before is not None:  # read for the last time
                remove_scratch(spark, before)
        docs = spark.read.parquet(path)
        before = path
    return docs
