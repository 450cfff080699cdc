"""Corpus pipeline: documents to packed training sequences, one operator a stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's docs. All but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import jaccard_join, line_quality, mixing, packing, substring_dedup
from tallyloom.llm.frames import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go, and documents that the rules reject."""
    return line_quality.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five-word shingles, similarity 0.8 or more."""
    return jaccard_join.keep_one(docs, n=5, percent=80)


def substring_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 35 words or more that occur again go from the texts; every document stays."""
    out = substring_dedup.dedup(docs, layout="original")
    cols = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return out.select(*[cols[c].alias(c) if c in cols else F.col(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the source mix."""
    return mixing.mix(docs)


def in_written_order(docs: DataFrame) -> DataFrame:
    """A table read from files, in ranges of the order in which its rows were written.

    Spark deals files to read tasks by size, so that order is lost between files.
    """
    order = {"_file": F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).try_cast("long"),
             "_name": F.col("_metadata.file_name"), "_row": F.col("_metadata.row_index")}
    placed = docs.select("*", *[c.alias(n) for n, c in order.items()])
    return placed.repartitionByRange(*order).sortWithinPartitions(*order).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document in a sequence of at most 2048 tokens, packed in the order of the mix."""
    return packing.pack(in_written_order(docs))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup_stage),
    ("mix_sources", mix_sources),
    ("packing", packing_stage),
]

#: Hash-based order of the mix and byte-pair ids are beyond SQL; tests/llm holds a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
