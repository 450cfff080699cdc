"""Skew-safe ordinals and ordered text aggregation.

A window ``row_number() OVER (PARTITION BY key ORDER BY ...)`` runs each key in
one task, so a key holding a third of all rows lands in one task. Here the
ordinal is computed instead from a range partitioning on ``(key, order)``: a hot
key is spread over many range partitions, each partition numbers its own rows,
and a small per-(key, partition) count table supplies the offsets.

Ordered text (digests, indexes, prompts) is cut into parts of a fixed number of
characters: every piece gets its place in the whole text of its group by a
prefix sum of lengths, taken the same way, and a piece that crosses a border is
split there. So every part but the last has the same size whatever the sizes of
the pieces, no output value or task grows with the data, and the parts of a
group, joined, are the plain ``string_agg(... ORDER BY ...)``. Short rows of
bounded size (tables, JSON blobs) go by ``(ordinal - 1) div part_rows``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.session import materialize

ColLike = str | Column


ROWS_A_PARTITION = 2_000_000


def _num_partitions(keys: DataFrame) -> int:
    """Range partitions for a table of sort keys: the shuffle setting, or as
    many as hold ``ROWS_A_PARTITION`` rows each, whatever the table's size."""
    base = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(base, -(-keys.count() // ROWS_A_PARTITION))


def ordinal_within_group(df: DataFrame, keys: Sequence[str], order: Sequence[ColLike],
                         name: str = "ord", num_partitions: int | None = None,
                         keep_partition: bool = False) -> DataFrame:
    """Add ``name`` = 1-based position of each row inside its ``keys`` group.

    ``order`` must be a total order inside each group (add tie-breakers).
    Keys and order columns must be non-null.

    Only keys and order columns are numbered; the ordinal is joined back, so
    texts are neither sorted nor checkpointed. Plan: range exchange on (keys, order) and a sort inside each range
    partition; every row is tagged with its partition and its position in it
    (``monotonically_increasing_id``). Range bounds come from a seeded sample
    tied to the exchange, so the tagged rows are written once with a reliable
    ``checkpoint`` to the shared folder: both the count table and the rows read
    the same tags, and a lost executor re-reads them instead of re-sampling.
    The count table has at most partitions + keys rows.
    """
    return _placed(df, keys, order, name, num_partitions, keep_partition)


def _placed(df: DataFrame, keys: Sequence[str], order: Sequence[ColLike], name: str, num_partitions: int | None = None,
            keep_partition: bool = False, size: Column | None = None) -> DataFrame:
    """Positions as ``ordinal_within_group``; with ``size`` also ``_before``, the sum of the sizes before each row."""
    places = {f"_o{i}": F.col(c) if isinstance(c, str) else c for i, c in enumerate(order)}
    df = df.withColumns(places)
    sort_cols = [*keys, *places]
    small = df.select(*sort_cols, *([] if size is None else [size.cast("bigint").alias("_size")]))
    ranged = (small.repartitionByRange(num_partitions or _num_partitions(small), *sort_cols)
              .sortWithinPartitions(*sort_cols)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id()))
    ranged = materialize(ranged, "ordinal")
    stats = (ranged.groupBy(*keys, "_pid")
             .agg(F.count(F.lit(1)).alias("_cnt"), F.min("_mid").alias("_base"),
                  *([] if size is None else [F.sum("_size").alias("_sum")])))
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    ahead = {"_off": "_cnt"} if size is None else {"_off": "_cnt", "_ahead": "_sum"}
    stats = stats.select(*keys, "_pid", "_base",
                         *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(n) for n, c in ahead.items()])
    out = ranged
    if size is not None:
        # a range partition bounds the rows of one key here
        inside = Window.partitionBy(*keys, "_pid").orderBy("_mid").rowsBetween(Window.unboundedPreceding, -1)
        out = out.withColumn("_in", F.coalesce(F.sum("_size").over(inside), F.lit(0)))
    out = out.join(stats, [*keys, "_pid"])
    found = [(F.col("_mid") - F.col("_base") + F.col("_off") + 1).cast("bigint").alias(name)]
    if size is not None:
        found.append((F.col("_ahead") + F.col("_in")).cast("bigint").alias("_before"))
    out = df.join(out.select(*sort_cols, "_pid", *found), sort_cols).drop(*places)
    return out if keep_partition else out.drop("_pid")


def last_flagged(df: DataFrame, keys: Sequence[str], order: Sequence[str], flag: Column, name: str) -> DataFrame:
    """Add ``name`` = the ``order`` columns (a struct) of the last flagged row at or before each
    row of its ``keys`` group, null where there is none.

    Rows must be unique in keys and order. As with ordinals, rows are placed in ranges of (keys,
    order), and each range takes over what the ranges before it end with, so a hot group is
    spread over many tasks."""
    cols = [*keys, *order]
    ranged = (df.select(*cols, F.coalesce(flag, F.lit(False)).alias("_f"))
              .repartitionByRange(*cols).sortWithinPartitions(*cols)
              .withColumn("_pid", F.spark_partition_id()).withColumn("_mid", F.monotonically_increasing_id()))
    ranged = materialize(ranged, "ranges")
    own = F.struct(*order)
    inside = Window.partitionBy(*keys, "_pid").orderBy("_mid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = ranged.groupBy(*keys, "_pid").agg(F.max(F.when(F.col("_f"), own)).alias("_end"))
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("_over", F.last("_end", ignorenulls=True).over(before)).drop("_end")
    found = ranged.withColumn("_in", F.last(F.when(F.col("_f"), own), ignorenulls=True).over(inside)).join(
        ends, [*keys, "_pid"]).select(*cols, F.coalesce("_in", "_over").alias(name))
    return df.join(found, cols)


def ordinal_by_numeric(df: DataFrame, keys: Sequence[str], num_col: str, name: str = "ord",
                       bucket_width: int = 1 << 16) -> DataFrame:
    """Exact 1-based position inside ``keys`` for a *unique, numeric* order
    column, with no sampling and no checkpoint.

    ``bucket = num_col div bucket_width`` preserves order, so the position is
    the count of rows in earlier buckets of the same key (a prefix sum over a
    small (key, bucket) count table) plus the ``row_number`` inside the
    bucket. A bucket holds at most ``bucket_width`` rows of one key, so a hot
    key is spread over many bounded window groups. Everything is
    deterministic, so recomputation after a lost executor gives the same
    numbers.
    """
    b = df.withColumn("_bkt", F.floor(F.col(num_col) / F.lit(bucket_width)).cast("bigint"))
    inner = Window.partitionBy(*keys, "_bkt").orderBy(num_col)
    b = b.withColumn("_loc", F.row_number().over(inner))
    stats = b.groupBy(*keys, "_bkt").agg(F.count(F.lit(1)).alias("_cnt"))
    before = Window.partitionBy(*keys).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.select(*keys, "_bkt", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"))
    return (b.join(stats, [*keys, "_bkt"])
            .withColumn(name, (F.col("_loc") + F.col("_off")).cast("bigint"))
            .drop("_bkt", "_loc", "_off"))


def concat_by_ordinal(df: DataFrame, keys: Sequence[str], ord_col: str, piece: Column, sep: str,
                      part_rows: int, text_name: str = "text") -> DataFrame:
    """Concatenate ``piece`` per group in dense ``ord_col`` order (1-based),
    in parts of at most ``part_rows`` pieces: part 0 holds 1..part_rows."""
    d = df.withColumn("_piece", piece).withColumn(
        "part", F.floor((F.col(ord_col) - 1) / F.lit(part_rows)).cast("bigint"))
    return d.groupBy(*keys, "part").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.min(ord_col).alias("first_ord"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(ord_col).alias("o"), "_piece"))),
                                 lambda x: x["_piece"]), sep).alias(text_name))


PART_CHARS = 1_000_000


def ordered_text_parts(df: DataFrame, keys: Sequence[str], order: Sequence[ColLike], piece: ColLike, sep: str = "",
                       part_chars: int = PART_CHARS, text_name: str = "text", lead: str = "") -> DataFrame:
    """Concatenate ``piece`` per group in ``order``, cut into numbered parts.

    The whole text of a group is ``lead``, then its pieces joined by ``sep``.
    Returns ``keys + [part, n_items, first_ord, <text_name>]``: part k (0-based)
    holds characters k * part_chars and on, at most part_chars of them (four
    times as many bytes at most); ``n_items`` counts the pieces that begin in it.
    The same layout holds at every size. Null pieces are empty."""
    piece_col = F.coalesce(F.col(piece) if isinstance(piece, str) else piece, F.lit(""))
    d = _placed(df.withColumn("_p", piece_col), keys, order, "_ord", size=F.length("_p"))
    first = F.col("_ord") == 1
    # the text between pieces belongs to the piece after it
    d = d.withColumn("_p", F.concat(F.when(first, F.lit(lead)).otherwise(F.lit(sep)), "_p")).withColumn(
        "_start", F.when(first, F.lit(0)).otherwise(
            F.col("_before") + F.lit(len(lead)) + (F.col("_ord") - 2) * F.lit(len(sep))).cast("bigint"))
    d = d.withColumn("_end", F.col("_start") + F.length("_p"))
    size = F.lit(part_chars).cast("bigint")

    def part_of(c):
        return F.floor(c / size).cast("bigint")

    d = d.select(*keys, "_ord", "_start", "_end", "_p", F.explode(F.sequence(
        part_of(F.col("_start")), part_of(F.greatest(F.col("_end") - 1, F.col("_start"))))).alias("part"))
    low = F.greatest(F.col("_start"), F.col("part") * size)
    high = F.least(F.col("_end"), (F.col("part") + 1) * size)
    slice_ = F.substring(F.col("_p"), (low - F.col("_start") + 1).cast("int"), (high - low).cast("int"))
    return d.groupBy(*keys, "part").agg(
        F.count_if(part_of(F.col("_start")) == F.col("part")).alias("n_items"),
        F.min("_ord").alias("first_ord"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col("_ord").alias("o"), slice_.alias("p")))),
                                 lambda x: x["p"]), "").alias(text_name))
