"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from spanloom.llm import langid, lines, mixing, packing, simhash
from spanloom.llm.tables import read_table
from spanloom.staging import new_folder, remove, staged_job


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go: null texts, and texts without a letter."""
    return langid.identified_documents(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return simhash.representatives(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines and sentences stay where they occur first; n_chars follows the text."""
    return lines.cut_documents(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences: the token ids, and their CRC-32."""
    return packing.pack(docs).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("language_id", identify_language),
    ("simhash_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("mixing", mix_sources),
    ("packing", pack_documents),
]

#: Trained models, similarity groups and a tokenizer decide here: not for SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; the rows of the last.

    What a stage staged goes when it has written its rows, and these when the next stage has.
    """
    docs, before = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = new_folder(spark, f"pipeline-{name}")
        with staged_job(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove(spark, before)
        before = path
    return docs
