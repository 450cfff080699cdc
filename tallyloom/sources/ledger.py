"""An append-only ledger of learned issues.

Instead of a label on every issue row, a batch appends the (repo, number) keys it learned
from. Appending is an anti-join against the ledger, so running a batch again adds nothing,
and two batches never rewrite each other's rows.

The ledger only grows, while a batch asks about few issues. So the asking side is turned
into a Bloom filter of fixed size first, and only the ledger rows that pass it are shuffled
for the (exact) anti-join. A filter that is too small for its keys lets more rows pass; the
result is the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.sources import snapshots

KEY = ["repo", "number"]
SCHEMA = "repo string, number long, learned_on date"
#: Slots of the filter, a byte each: the bound of what the driver sees and sends.
SLOTS = 1 << 20


def _slots(slots: int) -> Column:
    keys = [F.pmod(F.xxhash64(F.lit(seed), *KEY), F.lit(slots)).cast("int") for seed in (1, 2)]
    return F.array(*keys)


def key_filter(keys: DataFrame, slots: int = SLOTS) -> bytes:
    """A Bloom filter of the keys: at most ``slots`` slot numbers come to the driver."""
    filled = keys.select(F.explode(_slots(slots)).alias("slot")).distinct().toArrow()["slot"].to_pylist()
    out = bytearray(slots)
    for slot in filled:
        out[slot] = 1
    return bytes(out)


def may_hold(filled: bytes) -> Column:
    """Whether a row's key may be among those of the filter."""
    table = F.lit(filled)
    return F.forall(_slots(len(filled)), lambda s: F.substring(table, s + 1, F.lit(1)) == F.lit(b"\x01"))


def read(spark: SparkSession, root: str) -> DataFrame:
    if not snapshots.current_version(spark, root):
        return spark.createDataFrame([], SCHEMA)
    return snapshots.read_snapshot(spark, root)


def missing(keys: DataFrame, ledger: DataFrame, slots: int = SLOTS) -> DataFrame:
    """The rows of ``keys`` (repo, number and any others) that the ledger does not hold."""
    passed = ledger.select(*KEY).filter(may_hold(key_filter(keys, slots)))
    return keys.join(passed, KEY, "left_anti")


def append(learned: DataFrame, root: str, learned_on: str, slots: int = SLOTS) -> int:
    """Add the keys that are not there yet; returns how many."""
    from tallyloom.session import materialize

    spark = learned.sparkSession
    new = materialize(missing(learned.select(*KEY).distinct(), read(spark, root), slots), "ledger-new")
    n = new.count()
    if n:
        snapshots.append(new.withColumn("learned_on", F.lit(learned_on).cast("date")), root)
    return n


def seed(issues: DataFrame, root: str, learned_on: str, label: str = "learned") -> int:
    """Take over the issues that carry the label."""
    return append(issues.filter(F.array_contains("labels", label)), root, learned_on)


def unlearned_plans(issues: DataFrame, root: str, plan_label: str = "plan") -> DataFrame:
    """Closed plans that the ledger does not hold: the rows of the label form."""
    closed = issues.filter((F.col("state") == "CLOSED") & F.array_contains("labels", plan_label))
    return missing(closed, read(issues.sparkSession, root))
