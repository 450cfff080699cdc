"""Index and digest texts kept current from a change set.

A view is the ordered text of the notes of every (repo, category), held in parts. A part
begins at a note whose key's hash says so (one in ``16 ** digits``), and at the first of its
category, and is named by the name it begins with. So where parts begin depends on the
notes that are there, not on their number or on each other: a note that is changed, added
or removed touches its own part, and one that begins a part splits or joins two. Nothing is
numbered, and no other part moves.

Parts are rows of an append-only table. An update appends the touched parts, and a row
without items for each part that is gone; readers take the newest row of every part. The
texts of all other parts are neither read nor written. A view has one writer at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.ordering import last_flagged
from tallyloom.operators import notes as nt
from tallyloom.session import materialize
from tallyloom.sources import snapshots

GROUP = ["repo", "category"]
PART = [*GROUP, "start"]
DIGITS = 2


def begins(digits: int = DIGITS) -> Column:
    """Whether a note begins a part, by its key alone."""
    return F.left(F.md5(F.concat_ws("/", "repo", "category", "name").cast("binary")), F.lit(digits)) == "0" * digits


def index_pieces(scanned: DataFrame) -> DataFrame:
    """(repo, category, name, piece): the index line of every note."""
    rows = nt.routing_rows(scanned)
    return rows.select(*GROUP, nt.file_name().alias("name"), F.concat("line", F.lit("\n")).alias("piece"))


def digest_pieces(scanned: DataFrame) -> DataFrame:
    """(repo, category, name, piece): every note as it stands in a digest."""
    return scanned.select(*GROUP, nt.file_name().alias("name"), nt.digest_piece().alias("piece"))


def _parts(placed: DataFrame, version: int) -> DataFrame:
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("name", "piece"))), lambda x: x["piece"]), "")
    return placed.groupBy(*PART).agg(F.count(F.lit(1)).alias("n_items"), text.alias("text")).withColumn(
        "version", F.lit(version).cast("bigint"))


def _placed(pieces: DataFrame, starts: Column) -> DataFrame:
    """pieces with the start of their part; the first part of a category begins at the empty name."""
    out = last_flagged(pieces, GROUP, ["name"], starts, "_s")
    return out.withColumn("start", F.coalesce("_s.name", F.lit(""))).drop("_s")


def build(pieces: DataFrame, root: str, digits: int = DIGITS) -> None:
    """Write a view of all pieces."""
    snapshots.write_snapshot(_parts(_placed(pieces, begins(digits)), snapshots.current_version(pieces.sparkSession, root) + 1), root)


def parts(spark: SparkSession, root: str) -> DataFrame:
    """(repo, category, start, n_items, text, version): the parts as they are now, in order of rank of
    the category and start."""
    rows = snapshots.read_snapshot(spark, root)
    newest = rows.groupBy(*PART).agg(F.max("version").alias("version"))
    return rows.join(newest, [*PART, "version"]).filter("n_items > 0")


def update(pieces: DataFrame, changed: DataFrame, root: str, digits: int = DIGITS) -> int:
    """Bring a view up to date; returns the parts written.

    ``changed``: (repo, category, name) of notes changed, added or removed. ``pieces``: the pieces
    as they are now of all (repo, category) with a change; others may be left out."""
    spark = pieces.sparkSession
    version = snapshots.current_version(spark, root) + 1
    changed = changed.select(*GROUP, "name").distinct()
    touched = materialize(changed.select(*GROUP).distinct(), "view-groups")
    pieces = pieces.select(*GROUP, "name", "piece").join(touched, GROUP, "left_semi")
    there = changed.join(pieces.select(*GROUP, "name").withColumn("_there", F.lit(True)), [*GROUP, "name"], "left")
    marks = materialize(there.select(*GROUP, "name", F.col("_there").isNotNull().alias("there"), begins(digits).alias("mark")),
                        "view-changes")
    old = materialize(parts(spark, root).join(touched, GROUP, "left_semi").select(*GROUP, F.col("start").alias("name")), "view-starts")
    gone = marks.filter("mark and not there").select(*GROUP, "name")
    fresh = marks.filter("mark and there").select(*GROUP, "name").join(old, [*GROUP, "name"], "left_anti")
    first = touched.withColumn("name", F.lit(""))
    starts = old.join(gone, [*GROUP, "name"], "left_anti").unionByName(fresh).unionByName(first).distinct()
    # a change touches the part it lies in; a new start also the part that ended there before
    at = starts.withColumn("_tie", F.lit(0)).withColumn("_start", F.lit(True))
    probes = marks.select(*GROUP, "name").withColumn("_tie", F.lit(1)).unionByName(fresh.withColumn("_tie", F.lit(-1)))
    asked = last_flagged(at.unionByName(probes.withColumn("_start", F.lit(False))), GROUP, ["name", "_tie"], F.col("_start"), "_s")
    hit = materialize(asked.filter("not _start").select(*GROUP, F.col("_s.name").alias("start")).distinct(), "view-hits")
    known = starts.filter("name <> ''").select(*GROUP, "name").withColumn("_known", F.lit(True))
    placed = _placed(pieces.join(known, [*GROUP, "name"], "left"), F.col("_known"))
    new = _parts(placed.join(hit, PART, "left_semi"), version)
    # a touched part of which nothing is left, and a start that is gone
    empty = hit.unionByName(gone.select(*GROUP, F.col("name").alias("start"))).distinct().join(
        placed.select(*PART).distinct(), PART, "left_anti").join(
        old.select(*GROUP, F.col("name").alias("start")), PART, "left_semi")
    none = empty.select(*PART, F.lit(0).cast("bigint").alias("n_items"), F.lit("").alias("text"),
                        F.lit(version).cast("bigint").alias("version"))
    written = materialize(new.unionByName(none), "view-parts")
    snapshots.append(written, root)
    return written.count()


def update_catalog(catalog: DataFrame, scanned: DataFrame, changed: DataFrame) -> DataFrame:
    """The note catalog after a change: only changed notes (repo, category, slug) are parsed again."""
    keys = changed.select(*nt.NOTE_KEY).distinct()
    again = nt.note_catalog(scanned.join(keys, nt.NOTE_KEY, "left_semi"))
    return catalog.join(keys, nt.NOTE_KEY, "left_anti").unionByName(again)
