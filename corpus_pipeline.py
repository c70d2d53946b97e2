"""From raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from filingflow.llm import jaccard, mixing, packing, quality, repeats
from filingflow.llm.text import unused
from filingflow.session import clear, configure, fresh_dir, scratch, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.quality(docs, labels).filter("kept").select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of linked documents.

    Rows of one id are documents of their own.  Those without words count as copies of each
    other and of the id's other rows; rows without an id stay.
    """
    named, unnamed = docs.filter("doc_id IS NOT NULL"), docs.filter("doc_id IS NULL")
    if named.groupBy("doc_id").agg(F.count(F.lit(1)).alias("times")).filter("times > 1").isEmpty():
        groups = jaccard.jaccard_components(docs)
        first = written(groups.filter("doc_id = component_id").select("doc_id"), "first-of-group")
        return named.join(first, "doc_id").select(docs.columns).unionByName(unnamed)
    row = unused("row", docs.columns)
    numbered = written(named.withColumn(row, F.monotonically_increasing_id()), "numbered")
    groups = jaccard.jaccard_components(numbered.select(F.col(row).alias("doc_id"), "text"))
    groups = groups.select(F.col("doc_id").alias(row), "n_shingles", "component_id")
    order = F.struct("doc_id", F.xxhash64(*docs.columns).alias("content"), row).alias("order")
    placed = written(numbered.select(row, "doc_id", order).join(groups, row), "placed")
    worded = placed.filter("n_shingles > 0")
    blank = placed.filter("n_shingles = 0").join(worded.select("doc_id").distinct(), "doc_id", "left_anti")
    first = worded.groupBy("component_id").agg(F.min("order").alias("first")).select(f"first.{row}").unionByName(
        blank.groupBy("doc_id").agg(F.min("order").alias("first")).select(f"first.{row}")
    )
    return numbered.join(written(first, "first-of-group"), row).select(docs.columns).unionByName(unnamed)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that stand in one with a smaller id."""
    cleaned = repeats.remove_repeats(docs)
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources have their target shares, shuffled."""
    return mixing.mix(docs).select(docs.columns)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the packed sequences."""
    placed = packing.pack(docs)
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", substring_dedup),
    ("mixing sources to target weights", source_mix),
    ("best-fit packing", packed_sequences),
]

#: SQL cannot express the hashes and the tokenizer; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written and read again by the next."""
    docs, before = configure(spark).read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        folder = fresh_dir(spark, name.replace(" ", "-"))
        with scratch(spark):  # what the stage made on its way
            docs = written(stage(spark, docs, sf_dir), name, folder)
        if before is not None:
            clear(spark, before)  # its only reader is written
        before = folder
    return STAGES[-1][1](spark, docs, sf_dir)
