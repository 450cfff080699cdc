"""Ledger, bucketed tables and hash trees."""

import re

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import notes as nt
from tallyloom.operators import trees
from tallyloom.plans.catalog import QUERIES
from tallyloom.session import scratch_path
from tallyloom.sources import bucketed, ledger, snapshots

SF = "/root/testdata/sf0.001"


def keys(spark, rows):
    return spark.createDataFrame(rows, "repo string, number long")


@pytest.mark.parametrize("slots", [1 << 20, 8])
def test_ledger_appends_once(spark, slots):
    root = scratch_path(spark, "ledger-test")
    first = keys(spark, [("r", 1), ("r", 2), ("q", 1), ("r", 1)])
    assert ledger.append(first, root, "2024-01-01", slots) == 3
    assert ledger.append(first, root, "2024-01-02", slots) == 0
    assert ledger.append(keys(spark, [("r", 2), ("r", 9)]), root, "2024-01-03", slots) == 1
    got = {(r.repo, r.number): str(r.learned_on) for r in ledger.read(spark, root).collect()}
    assert got == {("r", 1): "2024-01-01", ("r", 2): "2024-01-01", ("q", 1): "2024-01-01", ("r", 9): "2024-01-03"}
    asked = keys(spark, [("r", k) for k in range(300)] + [("q", 2)])
    left = ledger.missing(asked, ledger.read(spark, root), slots)
    assert left.count() == 301 - 3 and left.filter("repo = 'r' and number in (1, 2, 9)").isEmpty()


def test_the_filter_keeps_every_asked_key_and_drops_most_others(spark):
    asked = keys(spark, [("r", k) for k in range(200)])
    many = spark.range(20_000).select(F.lit("r").alias("repo"), F.col("id").alias("number"))
    passed = many.filter(ledger.may_hold(ledger.key_filter(asked)))
    assert passed.filter("number < 200").count() == 200 and passed.count() < 400
    assert many.filter(ledger.may_hold(ledger.key_filter(asked.limit(0)))).isEmpty()


def test_appends_and_replacements_meet(spark):
    root = scratch_path(spark, "append-test")
    t = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v long")
    assert snapshots.append(t, root, ["k"]) == 1
    assert snapshots.append(t.filter("k = 'a'").withColumn("v", F.lit(7).cast("long")), root) == 2
    with pytest.raises(snapshots.Conflict):  # computed before the append to a
        snapshots.replace_partitions(t.filter("k = 'a'"), root, t.filter("k = 'a'"), 1)
    assert snapshots.replace_partitions(t.filter("k = 'x'"), root, t.filter("k = 'b'"), 1) == 3
    assert sorted((r.k, r.v) for r in snapshots.read_snapshot(spark, root).collect()) == [("a", 1), ("a", 7)]


def lines_of(spark, df):
    return spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple").split("\n")


def above_stored(lines):
    """Operators between each bucketed scan and the join above it."""
    depth = lambda s: len(re.match(r"[ :+|-]*", s)[0])
    for i, line in enumerate(lines):
        if "Bucketed: true" in line or re.search(r"SelectedBucketsCount|Bucketed: true", line):
            at, passed = depth(line), []
            for up in reversed(lines[:i]):
                if depth(up) < at:
                    at = depth(up)
                    passed.append(up.strip(" :+-"))
                    if "Join" in up:
                        break
            yield passed


@pytest.mark.parametrize("name", ["upsert_notes_bucketed", "compact_merge_bucketed", "compact_delete_bucketed",
                                  "audit_coverage_bucketed"])
def test_stored_side_is_not_exchanged(spark, name):
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        found = list(above_stored(lines_of(spark, QUERIES[name](spark, SF))))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert found
    for passed in found:
        assert "Join" in passed[-1] and not any("Exchange" in x for x in passed), passed


def test_register_a_bucketed_table(spark):
    path = scratch_path(spark, "bucket_test")
    df = spark.range(50).select(F.col("id").alias("k"), F.col("id").cast("string").alias("v"))
    bucketed.write_bucketed(df, "t_written", path, ["k"], 4)
    again = bucketed.register(spark, "t_registered", path, "k long, v string", ["k"], 4)
    assert again.count() == 50 and any("Bucketed: true" in x for x in lines_of(spark, again.join(df, "k")))


def tree(spark, files):
    root = scratch_path(spark, "tree-test")
    trees.store_tree(spark.createDataFrame(files, "path string, content string"), root, depth=3)
    return root


def test_hash_trees(spark):
    files = [(f"{d}/{x}{i}", f"text {i}") for d in ("aa", "ab", "b") for x in "pq" for i in range(5)] + [("c", None)]
    expected = tree(spark, files)
    cases = [
        (files, set()), (files + [("ab/new", "x")], {"ab/"}), (files[1:], {"aa/"}), (files + [("zz/new", "x")], set()),
        ([(p, "edited" if p == "b/q3" else t) for p, t in files], {"b/q"}), ([], {f[0][:3] for f in files}),
        ([(p, "" if p == "c" else t) for p, t in files], {"c"})]
    for other, want in cases:
        actual = tree(spark, other or [("none", "x")])
        assert {r.prefix for r in trees.differing_nodes(spark, expected, actual, 3).collect()} == want
        a, b = (spark.createDataFrame(f, "path string, content string") for f in (files, other or [("none", "x")]))
        plain = sorted(map(tuple, nt.content_drift(a, b).collect()))
        assert sorted(map(tuple, trees.tree_drift(spark, expected, actual, 3).collect())) == plain


def test_texts_of_equal_subtrees_are_not_read(spark):
    files = [(f"d{i}/x", "t" * 10) for i in range(8)]
    expected, actual = tree(spark, files), tree(spark, [(p, t + "!" if p == "d3/x" else t) for p, t in files])
    plan = "\n".join(lines_of(spark, trees.tree_drift(spark, expected, actual, 3)))
    scans = re.findall(r"Location: [^,]*\(1 paths\)|ReadSchema: struct<[^>]*>", plan)
    assert "ReadSchema: struct<path:string,prefix:string>" in scans  # paths alone, of all
    one = snapshots.read_snapshot(spark, f"{expected}/files", partitions=trees.differing_nodes(spark, expected, actual, 3))
    assert [r.path for r in one.collect()] == ["d3/x"]
