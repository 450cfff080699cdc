"""Mixing sources to target weights by Pfair scheduling, DataFrame functions only.

Each source is a stream cut into blocks of ``block_chars`` characters. With the
exact rational weight w, block i of a source is released at slot floor(i / w) and
due by slot ceil((i + 1) / w); giving each slot to the released block that is due
first keeps every source within one block of its target weight at every slot of
the whole schedule, until it ends. (Order by the due slot alone would not: a source
of weight 1/2 beside 50 of 1/100 each would run 25 blocks ahead.) The plan has a row
for each block, not for each document; it is made from the sources' sizes, written
in chunks to the shared folder and joined to the numbered blocks. The driver holds
one block of each source and one chunk.

Weights: a mapping, or, by default, source size to the power ``temper``. Every
source has a stream of its own, null sources too; those that a mapping does not
name have equal parts of its least weight. No row is dropped: a source that ends
leaves its slots empty and the others keep to theirs. A caller may give ``period``
to round the weights to whole slots of a period of that length. Within a source rows
stand in hash order of (key, text), equal rows side by side. Null texts and
empty texts have no characters and lie in the block that starts with them. An
empty table gives no rows. Other columns pass through; ones named ``source_block``
or ``slot`` are replaced.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from fractions import Fraction
from itertools import chain, islice
from math import lcm

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.session import scratch_path

from .frames import free_name

BLOCK_CHARS = 65_536
TEMPER = 0.5
ROWS_A_BUCKET = 5_000
PLAN_ROWS = 1_000_000


def quotas(weights: dict[str, float], period: int) -> dict[str, int]:
    """Whole slots a period for each stream: at least 1, in sum the period (largest remainders)."""
    period = max(period, len(weights))
    total = sum(Fraction(w) for w in weights.values())
    if total <= 0:
        weights, total = dict.fromkeys(weights, 1), Fraction(len(weights))
    free = period - len(weights)
    exact = {s: Fraction(w) / total * period for s, w in weights.items()}
    over = sum(max(Fraction(0), x - 1) for x in exact.values())
    share = {s: max(Fraction(0), x - 1) * free / over if over else Fraction(free, len(weights)) for s, x in exact.items()}
    out = {s: 1 + int(x) for s, x in share.items()}
    for s in sorted(share, key=lambda s: (int(share[s]) - share[s], s))[:period - sum(out.values())]:
        out[s] += 1
    return out


def slots(weights: dict[str, float], blocks: dict[str, int]) -> Iterator[tuple[str, int, int]]:
    """(stream, block, slot) in slot order: earliest deadline first among the released, from exact weights."""
    exact = {s: Fraction(w) for s, w in weights.items()}
    unit = lcm(*(w.denominator for w in exact.values()))
    e = {s: int(w * unit) for s, w in exact.items()}
    q = sum(e.values())
    waiting = [(0, s, 0) for s in e if blocks.get(s, 0)]
    heapq.heapify(waiting)
    due: list[tuple[int, str, int]] = []
    t = 0
    while waiting or due:
        if not due:
            t = max(t, waiting[0][0])
        while waiting and waiting[0][0] <= t:
            _, s, i = heapq.heappop(waiting)
            heapq.heappush(due, (-(-(i + 1) * q // e[s]), s, i))
        _, s, i = heapq.heappop(due)
        yield s, i, t
        if i + 1 < blocks[s]:
            heapq.heappush(waiting, ((i + 1) * q // e[s], s, i + 1))
        t += 1


def one_period(quota: dict[str, int]) -> dict[str, list[int]]:
    """Slots of each stream's blocks within a period."""
    out: dict[str, list[int]] = {s: [] for s in quota}
    for s, _, t in slots(quota, quota):
        out[s].append(t)
    return out


def _stored_plan(spark, plan: Iterator[tuple[str, int, int]], names: list[str]) -> DataFrame:
    """The plan as a table in the shared folder, at most PLAN_ROWS rows at a time on the driver."""
    path, mode = scratch_path(spark, "llm-mix-plan"), "errorifexists"
    types = pa.schema([(names[0], pa.string()), (names[1], pa.int64()), (names[2], pa.int64())])
    first = list(islice(plan, PLAN_ROWS))
    for chunk in chain([first], iter(lambda: list(islice(plan, PLAN_ROWS)), [])):
        columns = list(zip(*chunk, strict=True)) or [[], [], []]
        spark.createDataFrame(pa.table([pa.array(c, t) for c, t in zip(columns, types.types, strict=True)], schema=types)
                              ).write.mode(mode).option("compression", "zstd").parquet(path)
        mode = "append"
    return spark.read.schema(f"`{names[0]}` string, `{names[1]}` long, `{names[2]}` long").parquet(path)


def _stream(source: str):
    return F.when(F.col(source).isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col(source).cast("string")))


def schedule(docs: DataFrame, source: str = "source", key: str = "doc_id", text: str = "text",
             weights: dict[str | None, float] | None = None, block_chars: int = BLOCK_CHARS,
             period: int | None = None, temper: float = TEMPER) -> DataFrame:
    """docs with source_block (number of the block in its stream) and slot (place of that block in the mix)."""
    n = {k: free_name(docs, f"_m_{k}") for k in ("s", "h", "size", "b", "before", "own")}
    df = docs.drop("source_block", "slot")
    df = df.withColumn(n["s"], _stream(source))
    size = F.coalesce(F.length(F.col(text)), F.lit(0)).cast("long")
    sizes = df.groupBy(n["s"]).agg(F.sum(size).alias("chars"), F.count("*").alias("rows"))
    whole = sizes.agg(F.sum("chars"), F.sum("rows")).first()
    chars = {r[0]: r[1] for r in sizes.select(n["s"], "chars").toLocalIterator()}
    if weights is None:
        goal = {k: float(max(v, 1)) ** temper for k, v in chars.items()}
    else:
        goal = {"n" if k is None else f"s{k}": w for k, w in weights.items() if w > 0}
        others, least = [k for k in chars if k not in goal], min(goal.values(), default=1.0)
        goal |= {k: Fraction(least) / len(others) for k in others}
    if period:
        goal = quotas(goal or {"n": 1.0}, period)
    blocks = {k: v // block_chars + 1 for k, v in chars.items()}
    table = _stored_plan(df.sparkSession, slots(goal, blocks), [n["s"], "source_block", "slot"])
    df = df.withColumn(n["h"], F.xxhash64(F.col(key).cast("string"), F.col(text))).withColumn(n["size"], size)
    # running sums in two levels: inside hash buckets of bounded rows, then over the buckets' sums
    buckets = max(1, -(-(whole[1] or 0) // ROWS_A_BUCKET))
    df = df.withColumn(n["b"], F.pmod(F.shiftrightunsigned(n["h"], 7), F.lit(buckets)).cast("int"))
    sums = df.groupBy(n["s"], n["b"]).agg(F.sum(n["size"]).alias(n["own"]))
    over = Window.partitionBy(n["s"]).orderBy(n["b"])
    sums = sums.select(n["s"], n["b"], (F.sum(n["own"]).over(over) - F.col(n["own"])).alias(n["before"]))
    inside = (Window.partitionBy(n["s"], n["b"]).orderBy(n["h"], F.col(key))
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    df = df.withColumn(n["own"], F.sum(n["size"]).over(inside) - F.col(n["size"]))
    df = df.join(sums, [n["s"], n["b"]])
    block = F.expr(f"(`{n['before']}` + `{n['own']}`) div {int(block_chars)}")
    df = df.withColumn("source_block", block).join(table, [n["s"], "source_block"])
    return df.select(*[c for c in docs.columns if c not in ("source_block", "slot")], "source_block", "slot")


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """docs, same columns and rows, laid out in the order of the mix: partitions are slot ranges, sorted inside."""
    df = schedule(docs, key=key, text=text, **how)
    order = [F.col("slot"), F.xxhash64(F.col(key).cast("string"), F.col(text)), F.col(key)]
    return df.repartitionByRange(*order).sortWithinPartitions(*order).select(*docs.columns)
