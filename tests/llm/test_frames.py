import time

from pyspark.sql import functions as F
from tallyloom.llm import frames


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (n.rsplit("/", 1)[-1] for n in files.mkString("\n").split("\n"))
    return {n for n in names if n.startswith("shuffle_")}


def test_shuffles_of_a_stored_table_go_with_its_write(spark):
    before, setting = shuffle_files(spark), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    sums = spark.range(1000).groupBy((F.col("id") % 7).alias("r")).agg(F.sum("id").alias("s"))
    got = frames.stored(sums.join(sums.withColumnRenamed("s", "t"), "r"), "test")
    until = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.1)
    assert not left
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == setting
    want = [(r, s := sum(range(r, 1000, 7)), s) for r in range(7)]
    assert sorted((r.r, r.s, r.t) for r in got.collect()) == want
    assert sorted((r.r, r.s) for r in sums.collect()) == [w[:2] for w in want]  # what was stored can still be read anew
