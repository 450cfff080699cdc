"""Comparing large file trees by a hash tree over path prefixes.

A stored tree is a versioned table of files, a partition for each path prefix of ``depth``
characters, and a table of node hashes: for every prefix of 1 to ``depth`` characters, the
combined hash of all files below it. Two trees are compared from the top: only children of
nodes that differ are looked at, and only files below the lowest differing nodes are read
with their texts. Equal subtrees cost their node's row, and their paths where the caller
wants rows for files that are as they should be.

A node's hash is the exclusive or of a hash of every file's path and content, so it is an
aggregate that needs no order and combines before the shuffle; two hashes and the number of
files are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators import notes as nt
from tallyloom.sources import snapshots

DEPTH = 6
NODE = "level int, prefix string, a long, b long, n long"


def node_hashes(files: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(level, prefix, a, b, n) of files (path, content): one node per path prefix of 1 to depth characters."""
    digest = F.sha2(F.coalesce("content", F.lit("")), 256)
    own = [F.xxhash64(F.lit(seed), F.col("path"), digest, F.col("content").isNull()).alias(c) for seed, c in ((1, "a"), (2, "b"))]
    lowest = (files.select(F.substring("path", 1, depth).alias("prefix"), *own).groupBy("prefix")
              .agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"), F.count(F.lit(1)).alias("n")))
    levels = F.sequence(F.lit(1), F.lit(depth))
    return (lowest.select(F.explode(levels).alias("level"), "prefix", "a", "b", "n")
            .groupBy("level", F.expr("left(prefix, level)").alias("prefix"))
            .agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"), F.sum("n").alias("n")))


def store_tree(files: DataFrame, root: str, depth: int = DEPTH) -> None:
    """Write a tree (path, content) and its node hashes as the next version under root."""
    rows = files.select("path", "content", F.substring("path", 1, depth).alias("prefix"))
    snapshots.write_snapshot(rows, f"{root}/files", ["prefix"])
    stored = snapshots.read_snapshot(files.sparkSession, f"{root}/files")
    snapshots.write_snapshot(node_hashes(stored, depth), f"{root}/nodes")


def differing_nodes(spark: SparkSession, expected: str, actual: str, depth: int = DEPTH) -> DataFrame:
    """(prefix): the lowest nodes of the expected tree that the actual tree lacks or holds differently."""
    from tallyloom.session import materialize

    want, have = (snapshots.read_snapshot(spark, f"{root}/nodes") for root in (expected, actual))
    found = None
    for level in range(1, depth + 1):
        nodes = want.filter(F.col("level") == level)
        if found is not None:  # children of differing nodes only
            nodes = nodes.withColumn("_up", F.expr(f"left(prefix, {level - 1})")).join(
                found.withColumnRenamed("prefix", "_up"), "_up", "left_semi")
        other = have.filter(F.col("level") == level).drop("level").withColumn("_same", F.lit(True))
        found = materialize(nodes.join(other, ["prefix", "a", "b", "n"], "left")
                            .filter(F.col("_same").isNull()).select("prefix"), "tree-level")
    return found


def tree_drift(spark: SparkSession, expected: str, actual: str, depth: int = DEPTH) -> DataFrame:
    """The rows of ``content_drift`` of two stored trees; texts are read below differing nodes only."""
    nodes = differing_nodes(spark, expected, actual, depth)
    read = [snapshots.read_snapshot(spark, f"{root}/files", partitions=nodes) for root in (expected, actual)]
    below = nt.content_drift(*[df.select("path", "content") for df in read])
    whole = snapshots.read_snapshot(spark, f"{expected}/files").select("path", "prefix")
    equal = whole.join(nodes, "prefix", "left_anti").select("path", F.lit("current").alias("status"))
    return below.unionByName(equal)
