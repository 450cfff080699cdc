"""Notes as Markdown files: a sink and its reader.

Every note is a file ``<repo>/<category>/<slug>.md``. A write puts each task's files in a
folder of its own (``<root>/files/<write>/<task>``), and the driver's commit publishes
them by one atomic step: it moves a list of those folders to ``<root>/_published``.
Readers follow that list, so a lost, repeated or aborted task leaves nothing to see, a
running reader keeps the files it began with, and a later write replaces the whole tree.
The list has a line a task, not a line a note.

The folder is reached through ``pyarrow.fs`` on the executors (local and shared file
systems, HDFS, object stores) and read back by Spark's text source.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

PUBLISHED = "_published"
#: A name that is one path step, and that file scans do not hide.
STEP = r"\A[^/\x00._][^/\x00]*\z"


def place_of(path: str):
    """The pyarrow file system and inner path of a folder's address."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)


@dataclass
class Staged(WriterCommitMessage):
    folder: str
    files: int


class _Writer(DataSourceArrowWriter):
    def __init__(self, root: str, write: str):
        self.root, self.write_id = root.rstrip("/"), write

    def write(self, iterator):
        from pyspark import TaskContext

        place, root = place_of(self.root)
        folder = f"files/{self.write_id}/{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:12]}"
        made, files = set(), 0
        for batch in iterator:
            for repo, category, slug, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                where = f"{root}/{folder}/{repo}/{category}"
                if where not in made:
                    place.create_dir(where)
                    made.add(where)
                with place.open_output_stream(f"{where}/{slug}.md") as out:
                    out.write((content or "").encode())
                files += 1
        return Staged(folder, files)

    def commit(self, messages):
        place, root = place_of(self.root)
        place.create_dir(root)
        folders = sorted(m.folder for m in messages if m and m.files)
        staged = f"{root}/{PUBLISHED}.{self.write_id}"
        with place.open_output_stream(staged) as out:
            out.write("".join(f"{f}\n" for f in folders).encode())
        place.move(staged, f"{root}/{PUBLISHED}")

    def abort(self, messages):
        from pyarrow import fs

        place, root = place_of(self.root)
        folder = f"{root}/files/{self.write_id}"
        if place.get_file_info(folder).type != fs.FileType.NotFound:
            place.delete_dir(folder)


class NoteFiles(DataSource):
    """Data source ``note_files`` (write only): rows (repo, category, slug, content)."""

    @classmethod
    def name(cls):
        return "note_files"

    def writer(self, schema, overwrite):
        return _Writer(self.options["path"], uuid.uuid4().hex[:12])


def unsafe_names(files: DataFrame) -> DataFrame:
    """Rows that no file can stand for: a repo, category or slug that is null, not one path
    step or hidden from file scans (it begins with a dot or underscore), or a null content."""
    bad = [F.coalesce(~F.col(c).rlike(STEP), F.lit(True)) for c in ("repo", "category", "slug")]
    return files.filter(bad[0] | bad[1] | bad[2] | F.col("content").isNull()).select("repo", "category", "slug")


def write_note_files(files: DataFrame, root: str) -> None:
    """Publish rendered notes (repo, category, slug, content; keys unique) as the files
    under root. Rows of ``unsafe_names`` are left out. The input's partitioning is kept."""
    from tallyloom.session import travels

    travels(__name__)
    files.sparkSession.dataSource.register(NoteFiles)
    ok = [F.col(c).rlike(STEP) for c in ("repo", "category", "slug")]
    rows = files.filter(ok[0] & ok[1] & ok[2] & F.col("content").isNotNull()).select("repo", "category", "slug", "content")
    rows.write.format("note_files").mode("append").save(root)


def published_folders(spark: SparkSession, root: str) -> list[str] | None:
    """The task folders of the published write; null where root was not written by this sink."""
    from tallyloom.sources.snapshots import read_small

    text = read_small(spark, f"{root.rstrip('/')}/{PUBLISHED}")
    return None if text is None else [f"{root.rstrip('/')}/{line}" for line in text.split("\n") if line]
