"""A corpus pipeline over ``documents``: language, near copies, secrets, mixing, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from onomast.llm import language, mixing, near_copies, packing, secret_scan
from onomast.llm.common import arrow_batches, held_out, unused
from onomast.llm.queries import tokenizer_path
from onomast.sources.scratch import release_scratch, scratch_written, stage


#: Rows that a Python worker gets at a time: texts are long, and a worker keeps the memory of its largest batch.
BATCH_ROWS = 2_000


def _small_batches(spark: SparkSession) -> None:
    """A stage is written by whoever calls it, so the setting is the session's; ``run`` gives back the one that was there."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter in their text; ``lang`` becomes the one that was found, or stays if no row to learn from has one."""
    _small_batches(spark)
    langs, model = language.learn(docs.where(~held_out("doc_id")))
    if not langs:
        return docs.where(language.lettered(F.col("text")))
    (name,) = unused(docs, "_lang")
    found = docs.withColumn(name, language.language_column(F.col("text"), langs, model)["lang"])
    return found.where(F.col(name) != language.UNKNOWN).withColumn("lang", F.col(name)).select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest doc_id."""
    return near_copies.keep_one(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark; ``n_chars`` is counted anew."""
    _small_batches(spark)
    clean = secret_scan.redact_secrets(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them."""
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1,024 tokens."""
    _small_batches(spark)
    pieces = packing.pack(docs, tokenizer_path(), ["doc_id"], plain=False)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "padded")


STAGES = [("language", by_language), ("near_copies", one_of_each), ("secrets", without_secrets), ("mixing", mixed), ("packing", packed)]

#: SQL cannot express the stages; tests hold their rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, written. What a stage has written besides goes when it is done, and so does its input, but for the table."""
    docs, written = spark.read.parquet(f"{sf_dir}/documents.parquet"), 0
    with arrow_batches(spark, BATCH_ROWS):
        for name, function in STAGES:
            since = scratch_written() - written
            docs, written = stage(function(spark, docs, sf_dir), name), 1
            release_scratch(spark, since, keep=1)
    return docs
