"""Versioned tables: a new folder per write and a commit log."""

import os

import pytest
from pyspark.sql import functions as F

from tallyloom.session import scratch_path
from tallyloom.sources import snapshots as snap

ODD = ["a", "b c", "d/e", "f=g%41", "ü+", ""]


def test_write_read_versions(spark):
    root = scratch_path(spark, "snap-test")
    with pytest.raises(FileNotFoundError):
        snap.read_snapshot(spark, root)
    v1 = snap.write_snapshot(spark.range(3).withColumn("cat", F.lit("a")), root, ["cat"])
    # the next version may be computed from the live one: no in-place overwrite
    cur = snap.read_snapshot(spark, root)
    v2 = snap.write_snapshot(cur.withColumn("id", F.col("id") + 10), root, ["cat"])
    assert (v1, v2) == (1, 2)
    assert snap.current_version(spark, root) == 2
    assert sorted(r.id for r in snap.read_snapshot(spark, root).collect()) == [10, 11, 12]
    assert sorted(r.id for r in snap.read_snapshot(spark, root, 1).collect()) == [0, 1, 2]


def table(spark, values=ODD, shift=0):
    rows = [(i + shift, v, "x") for i, v in enumerate(values)] + [(i + 100 + shift, None, "x") for i in range(2)]
    return spark.createDataFrame(rows, "id long, repo string, cat string")


def ids(df):
    return sorted(r.id for r in df.collect())


def named(spark, *repos):
    return spark.createDataFrame([(r, "x") for r in repos], "repo string, cat string")


def folders(spark, root, version=None):
    return {r.repo: r.folder for r in snap.partition_files(spark, root, version).collect()}


def test_untouched_partitions_share_their_files(spark):
    root = scratch_path(spark, "snap-parts")
    snap.write_snapshot(table(spark), root, ["repo", "cat"])
    want = {r.repo: r.id for r in table(spark).collect() if r.repo is not None}
    for repo, number in want.items():  # any name comes back, read alone
        assert ids(snap.read_snapshot(spark, root, partitions=named(spark, repo))) == [number]
    change = named(spark, "b c", None)
    old = snap.read_snapshot(spark, root, 1, change)
    assert ids(old) == [1, 100, 101]
    new = old.filter("repo is not null").withColumn("id", F.col("id") + 1000)
    assert snap.replace_partitions(new, root, change, 1) == 2
    assert ids(snap.read_snapshot(spark, root)) == [0, 2, 3, 4, 5, 1001]
    assert ids(snap.read_snapshot(spark, root, 1)) == [0, 1, 2, 3, 4, 5, 100, 101]
    before, after = folders(spark, root, 1), folders(spark, root, 2)
    assert {r for r in after if after[r] == before[r]} == set(ODD) - {"b c"} and None not in after
    assert after["b c"] != before["b c"]
    written = os.listdir(f"{root.removeprefix('file:')}/data")
    assert len(written) == 2


def test_two_writers(spark):
    root = scratch_path(spark, "snap-two")
    snap.write_snapshot(table(spark, ["a", "b", "c"]), root, ["repo", "cat"])

    def bump(repo, by, base=1):
        rows = snap.read_snapshot(spark, root, base, named(spark, repo))
        return snap.replace_partitions(rows.withColumn("id", F.col("id") + by), root, named(spark, repo), base)

    assert bump("a", 10) == 2
    assert bump("b", 20) == 3  # computed from version 1, touches another partition
    assert ids(snap.read_snapshot(spark, root)) == [2, 10, 21, 100, 101]
    with pytest.raises(snap.Conflict):
        bump("a", 30)
    with pytest.raises(snap.Conflict):
        snap.write_snapshot(table(spark), root, ["repo", "cat"], base=1)
    assert bump("a", 30, base=3) == 4 and ids(snap.read_snapshot(spark, root)) == [2, 21, 40, 100, 101]


def test_a_crash_leaves_the_table_usable(spark, monkeypatch):
    root = scratch_path(spark, "snap-crash")
    snap.write_snapshot(table(spark, ["a", "b"]), root, ["repo", "cat"])
    bad = table(spark, ["a"]).withColumn("id", F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        snap.replace_partitions(bad, root, named(spark, "a"), 1)
    # files and manifest are written, the writer ends before its claim
    monkeypatch.setattr(snap, "claim", lambda *_: (_ for _ in ()).throw(RuntimeError("gone")))
    with pytest.raises(RuntimeError, match="gone"):
        snap.replace_partitions(table(spark, ["a"], 50).filter("repo = 'a'"), root, named(spark, "a"), 1)
    monkeypatch.undo()
    assert snap.current_version(spark, root) == 1 and ids(snap.read_snapshot(spark, root)) == [0, 1, 100, 101]
    assert snap.replace_partitions(table(spark, ["a"], 70).filter("repo = 'a'"), root, named(spark, "a"), 1) == 2
    assert ids(snap.read_snapshot(spark, root)) == [1, 70, 100, 101]


def test_empty_and_unpartitioned(spark):
    root = scratch_path(spark, "snap-empty")
    snap.write_snapshot(spark.range(0), root)
    assert snap.read_snapshot(spark, root).count() == 0
    snap.write_snapshot(spark.range(5), root)
    assert ids(snap.read_snapshot(spark, root)) == [0, 1, 2, 3, 4]
    with pytest.raises(ValueError):
        snap.replace_partitions(spark.range(1), root, spark.range(1), 2)


def test_claim_is_taken_once(spark):
    path = scratch_path(spark, "claim") + "/1"
    assert snap.claim(spark, path, "first") and not snap.claim(spark, path, "second")
    assert snap.read_small(spark, path) == "first" and snap.read_small(spark, path + "x") is None
