"""Removal of word passages that occur more than once, over FM-index shards.

A window is ``window`` consecutive words of one document. A word goes when some
window that covers it starts at another place too, in the same document or any
other; windows are judged on the input.

Every window is sent to one shard by its content: the least of the hashes of its
``gram``-word grams names it, and consecutive windows with the same least gram
form a segment. Equal windows so meet in one shard, and no shard meets all
documents. Segments whose gram occurs once in the whole table end there. The
others are gathered by content (a third of all rows may be one text: that is one
segment with a count), and each shard builds a compressed FM-index over its
distinct segments. Every segment is streamed through the index: backward search
gives its matching statistics, and places with a match of ``window`` words or
more that stands for at least two occurrences are reported as intervals.

A gram with more than ``hot_segments`` distinct segments (a passage inside very
many different texts) is split further: its windows are sent one by one, by
their own hash, gathered by content first. Words are compared by 64-bit hashes.

Null texts have no words; texts shorter than a window keep all. Repeated rows
count as places of their own and get equal results. An empty table gives no
rows. Other columns pass through; ones named like a result column are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .fm_index import FMIndex
from .frames import free_name, row_key, stored
from .tokens import U64, Words, as_long, grams, span_hash, text_slices

WINDOW = 35
GRAM = 8
#: About a million words, some 150 MB in a shard; beyond that a gram's windows go one by one.
HOT_SEGMENTS = 20_000
SHARD_WORDS = 300_000


def _least_gram(g: np.ndarray, span: int) -> np.ndarray:
    """Position of the first least value among each ``span`` consecutive ones."""
    val, pos, have = g, np.arange(len(g)), 1
    while have < span:
        step = min(have, span - have)
        if len(val) <= step:
            return np.zeros(0, np.int64)
        less = val[step:] < val[:-step]
        val = np.where(less, val[step:], val[:-step])
        pos = np.where(less, pos[step:], pos[:-step])
        have += step
    return pos


def _segments(window: int, gram: int):
    def run(batches):
        for batch in batches:
            keys = batch.column(0)
            for at, _, data, offs in text_slices(batch.column(1)):
                w = Words(data, offs, lower=False)
                g = grams(w.hash, gram)
                least = _least_gram(g, window - gram + 1)
                row = w.row_of_word()[:len(least)]
                p = np.flatnonzero(np.arange(len(least)) + window <= w.offs[1:][row])
                if not len(p):
                    continue
                row, least = row[p], least[p]
                new = np.ones(len(p), bool)
                new[1:] = (least[1:] != least[:-1]) | (row[1:] != row[:-1])
                first = np.flatnonzero(new)
                n = np.diff(np.append(first, len(p)))
                p0, r = p[first], row[first]
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(at + r)), pa.array((p0 - w.offs[r]).astype(np.int32)), pa.array(n.astype(np.int32)),
                     as_long(g[least[first]]), as_long(span_hash(w.hash, p0, p0 + n + window - 1))],
                    names=["k", "start", "n_win", "gram", "seg"])

    return run


def _least_grams(window: int, gram: int):
    """How many segments each least gram has, summed over a batch."""

    def run(batches):
        for batch in batches:
            found = [np.zeros(0, U64)]
            for _, _, data, offs in text_slices(batch.column(0)):
                w = Words(data, offs, lower=False)
                g = grams(w.hash, gram)
                least = _least_gram(g, window - gram + 1)
                row = w.row_of_word()[:len(least)]
                p = np.flatnonzero(np.arange(len(least)) + window <= w.offs[1:][row])
                row, least = row[p], least[p]
                new = np.ones(len(p), bool)
                new[1:] = (least[1:] != least[:-1]) | (row[1:] != row[:-1])
                found.append(g[least[new]])
            h, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([as_long(h), pa.array(n.astype(np.int64))], names=["gram", "count"])

    return run


def _contents(window: int, single: bool):
    """Text of the segments asked for; single: of each of their windows."""
    names = ["a", "b", "weight", "content", "off"]

    def run(batches):
        for batch in batches:
            asked = batch.column(1).to_pylist()
            for at, rows, data, offs in text_slices(batch.column(0)):
                w = Words(data, offs, lower=False)
                out = []
                for r in range(rows):
                    base = w.offs[r]
                    for x in asked[at + r]:
                        p = base + x["start"]
                        weight = min(x["n"], 2)
                        if single:
                            for off in range(x["n_win"]):
                                s, e = w.starts[p + off], w.ends[p + off + window - 1]
                                # gathered by content later: one form of white space
                                out.append((x["gram"], x["seg"], weight, b" ".join(data[s:e].tobytes().split()), off))
                        else:
                            s, e = w.starts[p], w.ends[p + x["n_win"] + window - 2]
                            out.append((x["gram"], x["seg"], weight, data[s:e].tobytes(), 0))
                cols = list(zip(*out, strict=True)) or [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int32()),
                     pa.array(cols[3], pa.binary()).cast(pa.string()), pa.array(cols[4], pa.int32())], names=names)

    return run


def _shard(window: int):
    """Index the segments of one shard, stream them through it, report repeated windows as intervals."""

    def run(batches):
        names, hashes, lens, weights = [], [], [], []
        for batch in batches:
            ab = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()], axis=1)
            names.append(ab)
            weights.append(batch.column(2).to_numpy().astype(np.int64))
            for _, _, data, offs in text_slices(batch.column(3)):
                w = Words(data, offs, lower=False)
                hashes.append(w.hash)
                lens.append(np.diff(w.offs))
        a = b = lo = hi = np.zeros(0, np.int64)
        if names and sum(map(len, names)):
            ab, h, n, wt = (np.concatenate(x) for x in (names, hashes, lens, weights))
            del names, hashes, lens, weights
            _, once = np.unique(ab, axis=0, return_index=True)
            if len(once) < len(ab):  # the same row stood twice in the input
                offs = np.concatenate([[0], np.cumsum(n)])
                take = np.concatenate([np.arange(offs[i], offs[i + 1]) for i in once])
                ab, h, n, wt = ab[once], h[take], n[once], wt[once]
            offs = np.concatenate([[0], np.cumsum(n)])
            ms = FMIndex(h, offs, wt).matching_statistics(h, offs, 2)
            hit = np.concatenate([[False], ms >= window, [False]])
            owner = np.repeat(np.arange(len(n)), n)
            edge = np.diff(hit.astype(np.int8))
            lo, hi = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            # a run cannot pass a segment's end: its last window - 1 places match fewer words
            o = owner[lo]
            a, b, lo, hi = ab[o, 0], ab[o, 1], lo - offs[o], hi - offs[o]
        yield pa.RecordBatch.from_arrays([as_long(a), as_long(b), pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32))],
                                         names=["a", "b", "lo", "hi"])

    return run


_FOUND = "a long, b long, lo int, hi int"
_PIECE = "a long, b long, weight int, content string, off int"


def repeated_spans(docs: DataFrame, key: str, text: str, window: int = WINDOW, gram: int = GRAM,
                   hot_segments: int = HOT_SEGMENTS, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(k, spans): row keys with the word intervals [from, to) that repeated windows cover."""
    rows = docs.select(row_key(key, text).alias("k"), F.col(text).alias("text")).filter("text is not null")
    grams_of = rows.select("text").mapInArrow(_least_grams(window, gram), "gram long, count long")
    segs = rows.mapInArrow(_segments(window, gram), "k binary, start int, n_win int, gram long, seg long")
    # stored first: a join of two plain shuffles is one whose large keys Spark can split
    often = stored(grams_of.groupBy("gram").agg(F.sum("count").alias("n")).filter("n > 1").select("gram"), "often")
    places = stored(segs.join(often, "gram"), "places")
    kinds = places.groupBy("gram", "seg").agg(F.count("*").alias("n"), F.min(F.struct("k", "start", "n_win")).alias("at"))
    hot = stored(kinds.groupBy("gram").count().filter(F.col("count") > hot_segments).select("gram"), "hot")
    any_hot = not hot.isEmpty()

    def contents(kinds: DataFrame, single: bool) -> DataFrame:
        asked = (kinds.groupBy(F.col("at.k").alias("k"))
                 .agg(F.collect_list(F.struct("at.start", "at.n_win", "gram", "seg", "n")).alias("asked")))
        return rows.join(asked, "k").select("text", "asked").mapInArrow(_contents(window, single), _PIECE)

    def through_index(pieces: DataFrame, words: int) -> DataFrame:
        shards = max(1, -(-words // shard_words))
        return (pieces.select("a", "b", "weight", "content").repartition(shards, "a")
                .mapInArrow(_shard(window), _FOUND))

    usual = kinds.join(hot, "gram", "left_anti") if any_hot else kinds
    words = usual.agg(F.sum(F.col("at.n_win") + F.lit(window - 1))).first()[0] or 0
    found = through_index(contents(usual, False), words)
    if any_hot:
        single = stored(contents(kinds.join(hot, "gram", "left_semi"), True)
                        .withColumn("wa", F.xxhash64("content")).withColumn("wb", F.xxhash64(F.reverse("content"))), "windows")
        pieces = (single.groupBy(F.col("wa").alias("a"), F.col("wb").alias("b"))
                  .agg(F.sum("weight").alias("weight"), F.first("content").alias("content"))
                  .withColumn("weight", F.least("weight", F.lit(2)).cast("int")))
        twice = through_index(pieces, single.agg(F.count("*")).first()[0] * window).select(
            F.col("a").alias("wa"), F.col("b").alias("wb"))
        found = found.unionByName(single.join(twice, ["wa", "wb"])
                                  .select("a", "b", F.col("off").alias("lo"), (F.col("off") + 1).alias("hi")))
    found = found.withColumnsRenamed({"a": "gram", "b": "seg"})
    spans = places.join(found, ["gram", "seg"]).select(
        "k", (F.col("start") + F.col("lo")).alias("from"), (F.col("start") + F.col("hi") + F.lit(window - 1)).alias("to"))
    return spans.groupBy("k").agg(F.collect_set(F.struct("from", "to")).alias("spans"))


def _cut(layout: str):
    """(text, spans) last in the batch -> n_words, n_removed, kept_text."""

    def run(batches):
        for batch in batches:
            m = batch.num_columns - 2
            asked = batch.column(m + 1).to_pylist()
            n_words, n_removed, kept = [], [], []
            for at, rows, data, offs in text_slices(batch.column(m)):
                w = Words(data, offs, lower=False)
                gone = np.zeros(len(w.hash) + 1, np.int32)
                for r in range(rows):
                    for x in asked[at + r] or ():
                        gone[w.offs[r] + x["from"]] += 1
                        gone[w.offs[r] + x["to"]] -= 1
                stay = np.cumsum(gone)[:-1] == 0
                for r in range(rows):
                    a, b = w.offs[r], w.offs[r + 1]
                    mask, doc = stay[a:b], data[offs[r]:offs[r + 1]]
                    left = int(mask.sum())
                    n_words.append(int(b - a))
                    n_removed.append(int(b - a) - left)
                    if layout == "words":
                        words = doc.tobytes().split()
                        text = b" ".join(words if left == b - a else [x for x, k in zip(words, mask.tolist(), strict=True) if k])
                    elif left == b - a:
                        text = doc.tobytes()
                    else:  # each kept run of words with the white space inside it
                        edge = np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8))
                        runs = zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True)
                        text = b"\n".join(data[w.starts[a + s]:w.ends[a + e - 1]].tobytes() for s, e in runs)
                    kept.append(text)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:m], pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string())],
                names=[*batch.schema.names[:m], "n_words", "n_removed", "kept_text"])

    return run


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", layout: str = "words", **how) -> DataFrame:
    """docs without the text column, with n_words, n_removed and kept_text.

    layout "words" joins the kept words by one space; "original" keeps the white
    space inside kept runs (a text that loses nothing stays as it is).
    """
    others = [c for c in docs.columns if c not in (text, "n_words", "n_removed", "kept_text")]
    k, s = free_name(docs, "_s_k"), free_name(docs, "_s_spans")
    spans = repeated_spans(docs, key, text, **how).withColumnsRenamed({"k": k, "spans": s})
    df = docs.select(*others, text).withColumn(k, row_key(key, text)).join(spans, k, "left").select(*others, text, s)
    schema = T.StructType([*[docs.schema[c] for c in others], T.StructField("n_words", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())])
    return df.mapInArrow(_cut(layout), schema)


