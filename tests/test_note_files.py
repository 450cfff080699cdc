"""Notes as files: what a reader sees of whole, killed and repeated writes."""

import datetime as dt
import os
import pathlib

import pytest
from pyspark.sql import functions as F

from tallyloom import schemas
from tallyloom.operators import notes as nt
from tallyloom.sources import note_files

FILES = "repo string, category string, slug string, content string"


def seen(spark, root):
    return sorted((r.repo, r.path, r.content) for r in nt.read_note_folder(spark, str(root)).collect())


def test_round_trip(spark, tmp_path):
    rows = [("r1", "patterns", "x", "---\ntitle: X\n---\n\nbody\n"), ("r 2+%41", "tripwires", "ü b+c", "é\r\n\n"),
            ("r1", "testing", "long", "y" * 300_000)]
    df = spark.createDataFrame(rows, FILES).repartition(3)
    note_files.write_note_files(df, str(tmp_path / "n"))
    assert seen(spark, tmp_path / "n") == sorted((r, f"{c}/{s}.md", t) for r, c, s, t in rows)
    # the next write replaces the tree, in one step
    note_files.write_note_files(df.filter("slug = 'x'"), str(tmp_path / "n"))
    assert [(r, p) for r, p, _ in seen(spark, tmp_path / "n")] == [("r1", "patterns/x.md")]
    note_files.write_note_files(df.limit(0), str(tmp_path / "n"))
    assert seen(spark, tmp_path / "n") == []


def test_typed_notes_come_back(spark, tmp_path):
    rows = [("r", "patterns", f"s{i}", "T", ["w"], [], dt.date(2024, 1, 1), [i], f"b{i}") for i in range(20)]
    rendered = nt.render_notes(spark.createDataFrame(rows, schemas.NOTES))
    note_files.write_note_files(rendered, f"file:{tmp_path}/n")
    back = nt.note_catalog(nt.scan_notes(nt.read_note_folder(spark, f"file:{tmp_path}/n")))
    assert {(r.slug, tuple(r.source_issues), r.body) for r in back.collect()} == {(f"s{i}", (i,), f"b{i}") for i in range(20)}


def test_a_killed_task_publishes_nothing(spark, tmp_path):
    good = spark.createDataFrame([("r", "patterns", "old", "kept")], FILES)
    root = tmp_path / "n"
    note_files.write_note_files(good, str(root))
    df = spark.range(400).select(
        F.lit("r").alias("repo"), F.lit("patterns").alias("category"), F.concat(F.lit("s"), "id").alias("slug"),
        F.when(F.col("id") == 399, F.raise_error(F.lit("lost"))).otherwise(F.lit("z" * 50)).alias("content"))
    with pytest.raises(Exception, match="lost"):
        note_files.write_note_files(df.repartition(4), str(root))
    assert seen(spark, root) == [("r", "patterns/old.md", "kept")]


def test_a_worker_that_dies_midway_publishes_nothing(spark, tmp_path):
    root = tmp_path / "n"

    def die(batches):
        for n, batch in enumerate(batches):
            if n:
                os._exit(1)  # the Python worker is gone
            yield batch

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        df = spark.range(40).select(F.lit("r").alias("repo"), F.lit("patterns").alias("category"),
                                    F.col("id").cast("string").alias("slug"), F.lit("z").alias("content"))
        with pytest.raises(Exception):  # noqa: B017
            note_files.write_note_files(df.coalesce(1).mapInArrow(die, FILES), str(root))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert not (root / note_files.PUBLISHED).exists()
    assert note_files.published_folders(spark, str(root)) is None


def test_an_attempt_that_does_not_count_is_not_read(spark, tmp_path):
    root = tmp_path / "n"
    writer = note_files._Writer(str(root), "w")
    stray = pathlib.Path(root, "files/w/000000-dead/r/patterns")
    stray.mkdir(parents=True)
    (stray / "half.md").write_text("---\nti")
    kept = pathlib.Path(root, "files/w/000000-live/r/patterns")
    kept.mkdir(parents=True)
    (kept / "a.md").write_text("whole")
    writer.commit([note_files.Staged("files/w/000000-live", 1), note_files.Staged("files/w/000001-none", 0), None])
    assert seen(spark, root) == [("r", "patterns/a.md", "whole")]


def test_unsafe_names_are_rejected(spark, tmp_path):
    rows = [("r", "patterns", "ok", "t"), ("r", "..", "x", "t"), ("r", "patterns", "../../x", "t"), ("", "a", "b", "t"),
            (None, "a", "b", "t"), ("r", "a", None, "t"), ("r", "a", "b", None), ("r", "patterns", "a..", "t"), ("r", "patterns", "_a", "t")]
    df = spark.createDataFrame(rows, FILES)
    note_files.write_note_files(df, str(tmp_path / "n"))
    assert [p for _, p, _ in seen(spark, tmp_path / "n")] == ["patterns/a...md", "patterns/ok.md"]
    assert note_files.unsafe_names(df).count() == 7
