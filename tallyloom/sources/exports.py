"""Readers for code-host JSON exports (the shapes a host's issue, PR and
GraphQL timeline queries return), flattened into the project-history tables.

Each reader takes a folder (or glob) of JSON-lines files, one object per line,
with an explicit schema (no inference pass). The repo comes from a ``repo``
field when present, else from the parent folder name of the file. Nested
lists (labels, timeline nodes, comments) are flattened with ``posexplode`` so
list position becomes ``seq``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

S, L = StringType(), LongType()
CORRUPT = "_corrupt"
LABEL = StructType([StructField("name", S)])
ISSUE_EXPORT = StructType([
    StructField("repo", S), StructField("number", L), StructField("title", S), StructField("body", S),
    StructField("state", S), StructField("createdAt", S), StructField("labels", ArrayType(LABEL)),
    StructField("url", S)])
PR_EXPORT = StructType([
    StructField("repo", S), StructField("number", L), StructField("title", S), StructField("body", S),
    StructField("state", S), StructField("headRefName", S), StructField("diff", S)])
CLOSER = StructType([
    StructField("__typename", S), StructField("number", L), StructField("title", S), StructField("body", S),
    StructField("headRefName", S), StructField("state", S)])
TIMELINE_EXPORT = StructType([
    StructField("repo", S), StructField("number", L),
    StructField("timelineItems", StructType([StructField("nodes", ArrayType(StructType([
        StructField("createdAt", S), StructField("closer", CLOSER)])))]))])
COMMENT_EXPORT = StructType([
    StructField("repo", S), StructField("number", L),
    StructField("comments", ArrayType(StructType([StructField("body", S)])))])


def _read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    df = _lines(spark, path, schema)
    return df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def _lines(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    # parsed by from_json over the text lines, so that a broken line can be told from a line of nulls
    full = StructType([*schema.fields, StructField(CORRUPT, S)])
    df = spark.read.text(path, recursiveFileLookup=True)
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1)
    df = df.filter(F.trim("value") != "").select(
        F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("j"), folder.alias("_folder"))
    return df.select("j.*", "_folder").withColumn("repo", F.coalesce("repo", "_folder")).drop("_folder")


def read_export_rejects(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """(repo, line) of the lines that are no JSON object of the export."""
    return _lines(spark, path, schema).filter(F.col(CORRUPT).isNotNull()).select("repo", F.col(CORRUPT).alias("line"))


def _ts(c: Column) -> Column:
    """UTC time with or without a fraction; null where the text is none."""
    return F.regexp_replace(c, r"Z\z", "").try_cast("timestamp_ntz")


def read_issue_export(spark: SparkSession, path: str) -> DataFrame:
    """Issues -> ``schemas.ISSUES`` (labels flattened to their names)."""
    df = _read(spark, path, ISSUE_EXPORT)
    return df.select("repo", "number", "title", "body", "state", _ts(F.col("createdAt")).alias("created_at"),
                     F.transform(F.coalesce("labels", F.array().cast("array<struct<name:string>>")),
                                 lambda x: x["name"]).alias("labels"), "url")


def read_pr_export(spark: SparkSession, path: str) -> DataFrame:
    """Pull requests -> ``schemas.PULL_REQUESTS``."""
    df = _read(spark, path, PR_EXPORT)
    return df.select("repo", "number", F.col("headRefName").alias("head_ref"), "body", "title",
                     F.coalesce("diff", F.lit("")).alias("diff"), "state")


def read_close_event_export(spark: SparkSession, path: str) -> DataFrame:
    """Closed-event timelines -> one row per event (``schemas.CLOSE_EVENTS``):
    ``seq`` is the position in the timeline; a closer that is no pull request
    (a person, a commit) becomes ``User`` with no PR fields."""
    df = _read(spark, path, TIMELINE_EXPORT)
    ev = df.select("repo", F.col("number").alias("issue"),
                   F.posexplode(F.coalesce("timelineItems.nodes", F.array())).alias("_i", "e"))
    is_pr = F.col("e.closer.__typename") == "PullRequest"
    return ev.select("repo", "issue", _ts(F.col("e.createdAt")).alias("closed_at"),
                     (F.col("_i") + 1).alias("seq"),
                     F.when(is_pr, "PullRequest").otherwise("User").alias("closer_type"),
                     F.col("e.closer.number").alias("closer_id"),
                     F.when(is_pr, F.col("e.closer.number")).alias("pr_number"),
                     F.when(is_pr, F.col("e.closer.state")).alias("pr_state"),
                     F.lit(0).cast("bigint").alias("actor"))


def read_comment_export(spark: SparkSession, path: str) -> DataFrame:
    """Issue comments -> ``schemas.COMMENTS`` with list position as ``seq``."""
    df = _read(spark, path, COMMENT_EXPORT)
    c = df.select("repo", F.col("number").alias("issue"),
                  F.posexplode(F.coalesce("comments", F.array())).alias("_i", "c"))
    return c.select("repo", "issue", F.col("_i").cast("bigint").alias("seq"), F.col("c.body").alias("body"))
