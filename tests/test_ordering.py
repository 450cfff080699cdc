"""Skew-safe ordinals equal row_number, also with one hot key."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyloom.functions.ordering import ordered_text_parts, ordinal_by_numeric, ordinal_within_group


def _data(spark):
    # key 0 holds about half of all rows
    return spark.range(0, 20000).select(
        F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id") % 97).alias("k"),
        ((F.col("id") * 7919) % 100003).alias("v"))


def test_ordinal_within_group_matches_row_number(spark):
    df = _data(spark)
    got = ordinal_within_group(df, ["k"], ["v"], "o", num_partitions=6)
    w = Window.partitionBy("k").orderBy("v")
    assert got.withColumn("rn", F.row_number().over(w)).filter("rn != o").count() == 0
    assert got.count() == 20000


def test_ordinal_by_numeric_matches_row_number(spark):
    df = _data(spark)
    got = ordinal_by_numeric(df, ["k"], "v", "o", bucket_width=64)
    w = Window.partitionBy("k").orderBy("v")
    assert got.withColumn("rn", F.row_number().over(w)).filter("rn != o").count() == 0


def test_ordered_text_parts(spark):
    df = spark.createDataFrame([("a", i, f"x{i}") for i in range(1, 8)] + [("b", 1, "y"), ("c", 1, None), ("d", 1, "z" * 20)],
                               "g string, i int, s string")
    parts = {(r.g, r.part): (r.n_items, r.text) for r in
             ordered_text_parts(df, ["g"], ["i"], F.col("s"), ",", 8).collect()}
    assert parts == {("a", 0): (3, "x1,x2,x3"), ("a", 1): (3, ",x4,x5,x"), ("a", 2): (1, "6,x7"), ("b", 0): (1, "y"),
                     ("c", 0): (1, ""), ("d", 0): (1, "z" * 8), ("d", 1): (0, "z" * 8), ("d", 2): (0, "zzzz")}


def test_text_parts_join_to_the_whole(spark):
    """Pieces of any size, one hot group, characters of several bytes: all parts but the last are full."""
    rng = random.Random(4)
    rows = [(rng.choice(["hot", "hot", "hot", f"g{i % 7}"]), i, "".join(rng.choice("aé😀\n") for _ in range(rng.choice((0, 1, 5, 40, 700)))))
            for i in range(600)]
    df = spark.createDataFrame(rows, "g string, i int, s string").repartition(5)
    for sep, lead in (("", ""), ("--", "head\n")):
        got = ordered_text_parts(df, ["g"], ["i"], "s", sep, 64, lead=lead).collect()
        for g in {r[0] for r in rows}:
            mine = sorted((r for r in got if r.g == g), key=lambda r: r.part)
            whole = lead + sep.join(s for k, _, s in sorted(rows, key=lambda r: r[1]) if k == g)
            assert "".join(r.text for r in mine) == whole and [r.part for r in mine] == list(range(len(mine)))
            assert all(len(r.text) == 64 for r in mine[:-1])
            assert sum(r.n_items for r in mine) == sum(k == g for k, _, _ in rows)


def test_hot_key_spreads_over_range_partitions(spark):
    """Half of all rows share one key; they land in several range partitions,
    so no single task numbers the whole hot group."""
    df = _data(spark)
    got = ordinal_within_group(df, ["k"], ["v"], "o", num_partitions=6, keep_partition=True)
    spread = got.filter("k = 0").select("_pid").distinct().count()
    assert spread >= 3
    biggest = got.groupBy("_pid").count().agg(F.max("count")).first()[0]
    assert biggest < 10000  # no partition holds the whole hot group (10000 rows)
