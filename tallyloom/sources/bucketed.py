"""Bucketed tables: stored sides of joins that need no exchange.

A note or issue table that many batches are joined with is written once in buckets of its
key, sorted in each. A batch is then dealt into the same buckets, and the join reads the
stored side where it lies: a large table is not shuffled for a small change. The key ends
with a name or number inside the repo, so a repo that holds a third of all rows is spread
over all buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

BUCKETS = 64


def write_bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """Write df as a bucketed catalog table at path; one sorted file a bucket."""
    (df.repartition(buckets, *keys).write.format("parquet").option("path", path)
     .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table))
    return df.sparkSession.table(table)


def register(spark: SparkSession, table: str, path: str, schema: str, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """Name a bucketed table that another session wrote (schema as DDL)."""
    names = ", ".join(f"`{k}`" for k in keys)
    spark.sql(f"CREATE TABLE `{table}` ({schema}) USING parquet CLUSTERED BY ({names}) SORTED BY ({names}) "
              f"INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(table)


def dealt(df: DataFrame, keys: Sequence[str], buckets: int | None) -> DataFrame:
    """A batch, already aggregated by key, in the buckets of a stored table (as it is, without one)."""
    return df if buckets is None else df.repartition(buckets, *keys)
