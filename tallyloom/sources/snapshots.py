"""Versioned tables: an optimistic commit log over folders of Parquet files.

Plain Parquet has no MERGE, and overwriting a path that the same job reads destroys the
input. Here a table is

- ``<root>/data/<write>/...``  the files of one write, one folder a partition,
- ``<root>/manifest/<write>``  a Parquet table that names the folder of every partition,
- ``<root>/_log/<n>``          version n: the name of its manifest and what it replaced.

A write puts its files and its manifest in folders of their own and then claims the next
number by moving its log entry there, a step that fails if another writer was first. So a
failed write leaves nothing that a later one could meet, and readers keep the version they
resolved. ``replace_partitions`` writes the files of the touched partitions only; the other
partitions are named by the next manifest where they are, so an update of a few partitions
of a large table moves those alone. Where writers meet, the later one takes the newer
version as its base if they touched different partitions, and else stops with ``Conflict``,
to be run again.

File-system calls go through Hadoop's FileSystem API, so the same code works on HDFS,
object stores and local disk. The driver handles log entries (a few bytes), and the folder
names of the partitions that a write touches or a reader asks for, as any Spark scan does.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG, MANIFEST, DATA = "_log", "manifest", "data"
WHOLE = "_whole"  # the one partition of a table without partition columns


class Conflict(RuntimeError):
    """Another writer replaced one of the same partitions first."""


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def read_small(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; null where there is none."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def claim(spark: SparkSession, path: str, text: str) -> bool:
    """Make a small file whole in one step; false where the path is taken."""
    jvm = spark._jvm
    fs, p = _fs(spark, path)
    own = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(own, False)
    out.write(bytearray(text.encode()))
    out.close()
    how = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(own, p, how)  # without the overwrite option it fails on an existing target
        return True
    except Exception as e:
        fs.delete(own, False)
        if not fs.exists(p):
            raise e
        return False


def _entry(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/{LOG}/{version:08d}"


def current_version(spark: SparkSession, root: str) -> int:
    """The newest version, 0 when nothing was published."""
    fs, p = _fs(spark, f"{root.rstrip('/')}/{LOG}")
    if not fs.exists(p):
        return 0
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return max((int(n) for n in names if n.isdigit()), default=0)


def log_entry(spark: SparkSession, root: str, version: int) -> dict:
    text = read_small(spark, _entry(root, version))
    if text is None:
        raise FileNotFoundError(f"no version {version} under {root}")
    return json.loads(text)


def partition_files(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The manifest of a version: the partition columns as text, folder (below root), rows."""
    v = version if version is not None else current_version(spark, root)
    if v == 0:
        raise FileNotFoundError(f"no snapshot published under {root}")
    return spark.read.parquet(f"{root.rstrip('/')}/{MANIFEST}/{log_entry(spark, root, v)['manifest']}")


def _key(c: str):
    return F.col(c).cast("string").alias(c)


def _write_files(df: DataFrame, root: str, partition_by: Sequence[str], write: str) -> DataFrame:
    """Write the rows, a folder for each partition; the manifest rows of what was written.

    The files hold all columns, the partition columns too, so a folder can be read alone.
    """
    path = f"{root.rstrip('/')}/{DATA}/{write}"
    if partition_by:
        # marked, as Spark gives null and empty text the same folder
        dirs = {f"by{i}": F.coalesce(F.concat(F.lit("v"), _key(c)), F.lit("n")) for i, c in enumerate(partition_by)}
        df.withColumns(dirs).write.partitionBy(*dirs).parquet(path)
    else:
        df.write.parquet(path)
    spark = df.sparkSession
    fs, p = _fs(spark, path)
    if not any(True for s in fs.listStatus(p) if not s.getPath().getName().startswith("_")):
        keys = ", ".join(f"{c} string" for c in partition_by or [WHOLE])
        return spark.createDataFrame([], f"{keys}, folder string, rows long")
    files = spark.read.option("recursiveFileLookup", "true").schema(df.schema).parquet(path)
    # the folder's name as written: file addresses are percent-encoded once more
    address = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    folder = F.regexp_extract(address, rf"({DATA}/{write}(?:/.*)?)/[^/]+$", 1)
    keys = [_key(c) for c in partition_by] or [F.lit("").alias(WHOLE)]
    return (files.select(*keys, folder.alias("folder")).groupBy(*(partition_by or [WHOLE]), "folder")
            .agg(F.count(F.lit(1)).alias("rows")))


def _same(keys: Sequence[str], left: DataFrame, right: DataFrame):
    on = F.lit(True)
    for k in keys:
        on = on & left[k].eqNullSafe(right[k])
    return on


def _commit(spark: SparkSession, root: str, write: str, keys: Sequence[str], new: DataFrame,
            touched: DataFrame | None, base: int, facts: dict, append: bool = False) -> int:
    """Claim the next version; ``touched`` partitions (all, if None) are replaced by ``new``, or get it as well."""
    root = root.rstrip("/")
    marks = f"{root}/{MANIFEST}/{write}-touched"
    if touched is not None:
        touched.write.parquet(marks)
        touched = spark.read.parquet(marks)
    while True:
        now = current_version(spark, root)
        for v in range(base + 1, now + 1) if not append else ():  # versions since the rows were computed
            other = log_entry(spark, root, v)
            if touched is None or other["touched"] is None:
                raise Conflict(f"version {v} of {root} replaced all partitions, or this write does")
            theirs = spark.read.parquet(f"{root}/{MANIFEST}/{other['touched']}")
            if not touched.join(theirs, _same(keys, touched, theirs), "left_semi").isEmpty():
                raise Conflict(f"version {v} of {root} replaced partitions of this write")
        base, name = now, f"{write}-{now + 1}"
        rows = new
        if touched is not None and now:
            old = partition_files(spark, root, now)
            kept = old if append else old.join(touched, _same(keys, old, touched), "left_anti")
            rows = kept.unionByName(new)
        rows.write.mode("overwrite").parquet(f"{root}/{MANIFEST}/{name}")
        entry = {"manifest": name, "touched": None if touched is None else f"{write}-touched", "data": write, **facts}
        if claim(spark, _entry(root, now + 1), json.dumps(entry)):
            return now + 1


def write_snapshot(df: DataFrame, root: str, partition_by: Sequence[str] = (), base: int | None = None) -> int:
    """Write ``df`` as the whole next version and publish it. With ``base``, only if that is still the newest."""
    spark = df.sparkSession
    start = current_version(spark, root) if base is None else base
    write = uuid.uuid4().hex[:12]
    new = _write_files(df, root, partition_by, write)
    return _commit(spark, root, write, list(partition_by) or [WHOLE], new, None, start,
                   {"keys": list(partition_by), "schema": df.schema.json()})


def replace_partitions(df: DataFrame, root: str, touched: DataFrame, base: int) -> int:
    """The next version: the partitions named by ``touched`` hold exactly the rows of ``df``
    (none of their rows: the partition goes), all others keep their files. ``df`` was computed
    from version ``base``; its rows must lie in touched partitions."""
    spark = df.sparkSession
    facts = log_entry(spark, root, base)
    keys, write = facts["keys"], uuid.uuid4().hex[:12]
    if not keys:
        raise ValueError("a table without partition columns is written whole")
    new = _write_files(df, root, keys, write)
    return _commit(spark, root, write, keys, new, touched.select(*[_key(c) for c in keys]).distinct(), base,
                   {"keys": keys, "schema": facts["schema"]})


def append(df: DataFrame, root: str, partition_by: Sequence[str] = ()) -> int:
    """The next version: all rows of the newest one and those of ``df``. Appends never conflict with each other."""
    spark = df.sparkSession
    now = current_version(spark, root)
    if not now:
        try:
            return write_snapshot(df, root, partition_by, base=0)
        except Conflict:
            return append(df, root, partition_by)
    facts, write = log_entry(spark, root, now), uuid.uuid4().hex[:12]
    keys = facts["keys"] or [WHOLE]
    new = _write_files(df, root, facts["keys"], write)
    return _commit(spark, root, write, keys, new, new.select(*keys).distinct(), now,
                   {"keys": facts["keys"], "schema": facts["schema"]}, append=True)


def read_snapshot(spark: SparkSession, root: str, version: int | None = None,
                  partitions: DataFrame | None = None) -> DataFrame:
    """Read the newest version, or a given one; all of it, or the named partitions only."""
    from pyspark.sql.types import StructType

    root = root.rstrip("/")
    v = version if version is not None else current_version(spark, root)
    if v == 0:
        raise FileNotFoundError(f"no snapshot published under {root}")
    facts = log_entry(spark, root, v)
    files, schema = partition_files(spark, root, v), StructType.fromJson(json.loads(facts["schema"]))
    if partitions is not None:
        named = partitions.select(*[_key(c) for c in facts["keys"]]).distinct()
        files = files.join(named, _same(facts["keys"], files, named), "left_semi")
    folders = [f"{root}/{r.folder}" for r in files.select("folder").distinct().collect()]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.option("recursiveFileLookup", "true").schema(schema).parquet(*folders)
