"""Typed reads of the driver's Parquet tables, projected to the needed columns
so the scan's ReadSchema stays minimal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df
