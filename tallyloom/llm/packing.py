"""Packing token sequences into fixed windows: bounded-space online best fit.

Each document becomes its ids and one end id. Whole windows are cut off first
and need no placing. The rest goes, as it arrives, into the open window of its
partition that it fills best; when none can take it, and the partition already
has ``open_windows`` of them, the fullest is emitted and a new one opened. What
stays open at the end of a partition is merged: the leftover windows, now items
themselves, are packed by the same rule in ever fewer partitions until one is
left. Every level works on a stored table, so a recomputed task cannot disagree
with rows already used.

Null and empty texts are one end id. Repeated rows are packed once each. A null
key stays null. An empty table gives no rows. Only the key and the text column
are read, so other columns cannot clash.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import Encoder
from .frames import stored

WINDOW = 2048
OPEN_WINDOWS = 128
END_ID = 1
MERGE_FAN_IN = 16
VOCABULARY = "byte_bpe_50k.json"


class OpenWindows:
    """The open windows of one partition; ``add`` returns windows that are closed by it.

    A window is [fill, members]; a member is (item, offset).
    """

    def __init__(self, size: int, limit: int):
        self.size, self.limit = size, limit
        self.order: list[tuple[int, int]] = []  # (fill, window number), ascending
        self.members: dict[int, list] = {}
        self.made = 0

    def add(self, item, length: int) -> list[list]:
        closed = []
        # best fit: the fullest window that still has room
        at = bisect_left(self.order, (self.size - length + 1, -1)) - 1
        if at >= 0:
            fill, w = self.order.pop(at)
        else:
            if len(self.order) >= self.limit:
                closed.append(self.members.pop(self.order.pop()[1]))
            fill, w = 0, self.made
            self.made += 1
            self.members[w] = []
        self.members[w].append((item, fill))
        if fill + length == self.size:
            closed.append(self.members.pop(w))
        else:
            insort(self.order, (fill + length, w))
        return closed

    def rest(self) -> list[list]:
        return [self.members[w] for _, w in self.order]


_SEQ_BITS = 30


def _tokenise_and_pack(key_type: pa.DataType, window: int, limit: int, end_id: int, vocabulary: str, with_ids: bool):
    names = ["key", "start", "length", "ids_crc32", "doc_tokens", "seq", "offset", "open"]
    types = [key_type, pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
    if with_ids:
        names, types = [*names, "ids"], [*types, pa.binary()]

    def run(batches):
        part = TaskContext.get().partitionId() << _SEQ_BITS
        encoder, windows, rows, made = Encoder(vocabulary), OpenWindows(window, limit), [], 0
        end = end_id.to_bytes(4, "little")

        def emit(members, still_open):
            nonlocal made
            rows.extend((*item[:5], part + made, offset, still_open, *item[5:]) for item, offset in members)
            made += 1

        def flush():
            cols = list(zip(*rows, strict=True)) or [()] * len(names)
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encoder.encode(text or "") + end
                n = len(ids) // 4
                for start in range(0, n, window):
                    piece = ids[4 * start:4 * (start + window)]
                    length = len(piece) // 4
                    item = (key, start, length, zlib.crc32(piece), n, *([piece] if with_ids else []))
                    if length == window:
                        emit([(item, 0)], False)
                    else:
                        for members in windows.add(item, length):
                            emit(members, False)
                if len(rows) >= 20_000:
                    yield flush()
        for members in windows.rest():
            emit(members, True)
        yield flush()

    return run


def _merge(level: int, window: int, limit: int):
    """Pack windows (seq, fill) of a partition as items: where each went."""
    names = ["seq", "to", "shift", "fill", "open"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]

    def run(batches):
        part = (level << 58) + (TaskContext.get().partitionId() << _SEQ_BITS)
        windows, rows, made = OpenWindows(window, limit), [], 0

        def emit(members, still_open):
            nonlocal made
            rows.extend((seq, part + made, offset, fill, still_open) for (seq, fill), offset in members)
            made += 1

        for batch in batches:
            for seq, fill in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for members in windows.add((seq, fill), fill):
                    emit(members, False)
        for members in windows.rest():
            emit(members, True)
        cols = list(zip(*rows, strict=True)) or [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)

    return run


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", *, vocabulary: str = VOCABULARY,
         window: int = WINDOW, open_windows: int = OPEN_WINDOWS, end_id: int = END_ID,
         with_ids: bool = False) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id,
    offset; with_ids adds the piece's ids as packed 32-bit numbers."""
    from pyspark.sql.pandas.types import to_arrow_type

    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = source.schema["key"].dataType
    schema = (f"key {kind.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long, seq long, "
              "offset long, open boolean" + (", ids binary" if with_ids else ""))
    placed = stored(source.mapInArrow(
        _tokenise_and_pack(to_arrow_type(kind), window, open_windows, end_id, vocabulary, with_ids), schema), "pieces")
    loose = placed.filter("open").groupBy("seq").agg(F.sum("length").alias("fill"))
    parts = placed.select((F.col("seq") / (1 << _SEQ_BITS)).cast("long").alias("p")).agg(F.max("p")).first()[0]
    parts, level, moves = (parts or 0) + 1, 0, None
    while True:
        parts, level = -(-parts // MERGE_FAN_IN), level + 1
        step = stored(loose.repartition(parts, F.xxhash64("seq")).sortWithinPartitions(F.desc("fill"), "seq")
                      .mapInArrow(_merge(level, window, open_windows),
                                  "seq long, to long, shift long, fill long, open boolean"), "merge")
        now = step.select("seq", "to", "shift")
        moves = now if moves is None else stored(
            moves.alias("a").join(now.alias("b"), F.col("a.to") == F.col("b.seq"), "left")
            .select("a.seq", F.coalesce("b.to", "a.to").alias("to"),
                    (F.col("a.shift") + F.coalesce("b.shift", F.lit(0))).alias("shift")), "moves")
        loose = step.filter("open").groupBy(F.col("to").alias("seq")).agg(F.sum("fill").alias("fill"))
        if parts == 1:
            break
    out = placed.join(moves.withColumn("open", F.lit(True)), ["seq", "open"], "left")
    cols = [F.col("key").alias(key), "start", "length", "ids_crc32", "doc_tokens",
            F.coalesce("to", "seq").alias("sequence_id"),
            (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset")]
    return out.select(*cols, *(["ids"] if with_ids else []))
