"""Small DataFrame helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.session import scratch_path

WORD_GAP = r"[\x20\x09-\x0D]+"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet").select(*columns)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to a fresh table in the shared folder and read it back.

    Cuts the lineage: a lost executor costs a reread, and every later reader
    sees the same rows. What the write has shuffled goes with its end, so an
    operator of many steps holds the shuffles of one at a time.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def _row_hash(key: str, text: str, seed: int) -> Column:
    # hashes pass over nulls, so what is null is hashed as well
    k, t = F.col(key).cast("string"), F.col(text)
    return F.xxhash64(F.lit(seed), k.isNull(), t.isNull(), k, t)


def row_key(key: str, text: str) -> Column:
    """A key of 16 bytes of a row by its content: repeated rows share it, and so their result."""
    return F.unhex(F.concat(*[F.lpad(F.hex(_row_hash(key, text, seed)), 16, "0") for seed in (1, 2)]))


def short_row_key(key: str, text: str) -> Column:
    """The same in 8 bytes, for tables with a row key on every n-gram."""
    return _row_hash(key, text, 1)


def free_name(df: DataFrame, name: str) -> str:
    """name, with underscores put before it until no column has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def shuffle_width(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
