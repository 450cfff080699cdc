"""Katz backoff language model: training, normalisation and scoring over whole tables.

Tokens are the lower-cased words of a text and one end token. The model keeps
n-gram tables of orders 1 and 2, written as partitioned tables in the shared
folder, with Good-Turing discounts for counts up to ``top``. Recursion per token:

  p(w | h) = d c(h, w) / c(h)          if the pair was seen,
             alpha(h) p(w)             otherwise,
  p(w)     = d c(w) / N                if the word was seen, else what is left.

alpha(h) is what the seen followers of h leave over, divided by what their
unigram probabilities leave over, so the followers of every history sum to one.
Every pair of words is counted, by (word hash, word hash). A text's score is the
sum of log p(w) and log alpha(h) over its tokens, plus for each seen pair the
``gain`` log p(w | h) - log alpha(h) - log p(w), which the pair table holds. Words,
histories and pairs of at least one in ``sent_share`` tokens are a cache sent to
every task; everything rarer is looked up by a join on its key. Where discounting
leaves a history nothing for unseen words, one count is set aside.

A caller may give ``class_share`` to merge all words with less than one in
``class_share`` of the training tokens into one class, inside which a word has
its share of the unigram probability. Without it no words are merged.

Null and empty texts are one end token. Repeated rows count each in training and
get equal scores. Rows without a key train. Without training tokens all
probability is with the unseen word. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import short_row_key, stored
from .tokens import Words, as_long, mix, text_slices

TOP = 5
SENT_SHARE = 1_000_000
BATCH_PAIRS = 2_000_000
_NONE = 1e-300  # stands for probability 0 in logarithms
_REST, _END, _START = 0, 1, 2  # keys beside the word hashes; _START is a history only


def discounts(of: dict[int, int], top: int = TOP) -> list[float]:
    """Good-Turing factors d[0..top] from counts of counts; d[0] is unused.

    Where the estimate is not between 0 and 1 (few data) half a count is taken off.
    """
    n = [0.0, *(float(of.get(r, 0)) for r in range(1, top + 2))]
    out = [1.0]
    cut = (top + 1) * n[top + 1] / n[1] if n[1] else 1.0
    for r in range(1, top + 1):
        d = ((r + 1) * n[r + 1] / (r * n[r]) - cut) / (1 - cut) if n[r] and cut < 1 else 0.0
        out.append(d if 0 < d < 1 else 1 - 0.5 / r)
    return out


def _factor(c: np.ndarray, d: list[float]) -> np.ndarray:
    return np.where(c < len(d), np.array(d)[np.minimum(c, len(d) - 1)], 1.0)


def _factor_of(c, d: list[float]):
    out = F.lit(1.0)
    for r in range(1, len(d)):
        out = F.when(c == r, F.lit(float(d[r]))).otherwise(out)
    return out


def _pair_hash(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix(mix(h.view(np.uint64)) ^ w.view(np.uint64))


class Model:
    """The parts of a trained model that have a fixed bound, and the tables."""

    def __init__(self, words: DataFrame, top: int, class_share: int | None, sent_share: int):
        self.top, self.class_share, self.sent_share = top, class_share, sent_share
        self.words = words  # (word, c), the end token not among them
        self.histories: DataFrame | None = None  # (h, total, alpha_log)
        self.pairs: DataFrame | None = None  # (h, w, c, gain)
        n, self.types = words.agg(F.sum("c"), F.count("*")).first()
        self.ends = 0
        self.tokens = n or 0

    def set_unigrams(self, ends: int) -> None:
        self.ends = ends
        self.tokens += ends
        self.types += ends > 0
        often = self.words.filter(F.col("c") * self.sent_share >= self.tokens).toArrow()  # at most sent_share rows
        h = often["word"].to_numpy().view(np.uint64)
        order = np.argsort(h)
        self.hash, self.count = h[order], often["c"].to_numpy()[order]
        of = {r[0]: r[1] for r in self.words.filter(F.col("c") <= self.top + 1).groupBy("c").count().collect()}
        if 0 < ends <= self.top + 1:
            of[ends] = of.get(ends, 0) + 1
        self.d1 = discounts(of, self.top)
        kept = sum(r * k * self.d1[r] for r, k in of.items() if r <= self.top)
        kept += self.tokens - sum(r * k for r, k in of.items() if r <= self.top)
        if kept >= self.tokens:  # nothing left for unseen words
            self.scale1 = self.tokens / (self.tokens + 1) / (kept / self.tokens) if kept else 1.0
        else:
            self.scale1 = 1.0
        self.unseen = 1 - kept / self.tokens * self.scale1 if self.tokens else 1.0
        self.key = self.hash.view(np.int64)
        if self.class_share:
            self.key = np.where(self.count * self.class_share >= self.tokens, self.key, _REST)

    def p1(self, c: np.ndarray) -> np.ndarray:
        """Unigram probability of words with these counts."""
        return np.where(c > 0, _factor(c, self.d1) * c / max(self.tokens, 1) * self.scale1, self.unseen)

    def p1_of(self, c):
        """The same as a column."""
        seen = c * _factor_of(c, self.d1) * F.lit(self.scale1 / max(self.tokens, 1))
        return F.when(c > 0, seen).otherwise(F.lit(float(self.unseen)))

    def _often_followers(self, spark) -> DataFrame:
        """(w, p) of the end token and the words sent to every task: at most sent_share rows, and two more."""
        own = self.key != _REST
        key, p = [*self.key[own], _END], [*self.p1(self.count[own]), self.p1(np.array([self.ends]))[0]]
        if self.class_share:
            key, p = [*key, _REST], [*p, max(1 - sum(p), _NONE)]
        return spark.createDataFrame(pa.table({"w": np.array(key, np.int64), "p": np.array(p, float)}))

    def set_pairs(self, pairs: DataFrame) -> None:
        """Discounts, histories (total, alpha), gains, and the part of them that is sent to every task."""
        of = {r[0]: r[1] for r in pairs.filter(F.col("c") <= self.top + 1).groupBy("c").count().collect()}
        self.d2 = discounts(of, self.top)
        often_w = F.broadcast(self._often_followers(pairs.sparkSession))
        rare = self.words.filter(F.col("c") * self.sent_share < self.tokens)
        rare = rare.select(F.col("word").alias("w"), self.p1_of(F.col("c")).alias("p"))

        def with_p(df: DataFrame) -> DataFrame:
            df = df.join(often_w, "w", "left")
            return df.filter("p is not null").unionByName(df.filter("p is null").drop("p").join(rare, "w"))

        kept = F.col("c") * _factor_of(F.col("c"), self.d2)
        sums = with_p(pairs).groupBy("h").agg(F.sum("c").cast("double").alias("c"), F.sum(kept).alias("kept"),
                                              F.sum("p").alias("seen"))
        left = 1 - F.col("seen")
        full = left <= 1e-12  # every word was seen after h: nothing to back off to
        none_over = F.col("c") - F.col("kept") <= 1e-9 * F.col("c")
        total = F.when(full, F.col("kept")).when(none_over, F.col("c") + 1).otherwise(F.col("c"))
        alpha = F.when(full, _NONE).otherwise(F.greatest((1 - F.col("kept") / F.col("total")) / left, F.lit(_NONE)))
        self.histories = stored(sums.withColumn("total", total).select("h", "total", F.log10(alpha).alias("alpha_log")),
                                "histories")
        often = self.histories.filter((F.col("total") * self.sent_share >= self.tokens) | F.col("h").isin(_REST, _START))
        often_h = F.broadcast(often)  # at most sent_share rows, and two more
        of_pair = with_p(pairs.join(often_h, "h", "left"))
        of_pair = of_pair.filter("total is not null").unionByName(
            of_pair.filter("total is null").drop("total", "alpha_log").join(self.histories, "h"))
        gain = F.log10(kept / F.col("total")) - F.col("alpha_log") - F.log10("p")
        self.pairs = stored(of_pair.select("h", "w", "c", gain.alias("gain")), "bigrams")
        often = often.toArrow()
        alpha_of = dict(zip(often["h"].to_pylist(), often["alpha_log"].to_pylist(), strict=True))
        missing = self.histories.filter(F.col("total") * self.sent_share < self.tokens).join(
            F.broadcast(pairs.sparkSession.createDataFrame(pa.table({"h": self.key}))), "h", "left_semi")
        for r in missing.toArrow().to_pylist():  # words sent, whose total as a history is just under their count
            alpha_of[r["h"]] = r["alpha_log"]
        self.start_alpha, self.rest_alpha = alpha_of.get(_START, 0.0), alpha_of.get(_REST, 0.0)
        self.alpha = np.array([alpha_of.get(h, 0.0) for h in self.key.tolist()], float)
        often = self.pairs.filter(F.col("c") * self.sent_share >= self.tokens).toArrow()  # at most sent_share rows
        h, w, g = (often[k].to_numpy() for k in ("h", "w", "gain"))
        of_hash = _pair_hash(h, w)
        order = np.argsort(of_hash)
        self.pair, self.pair_h, self.pair_w, self.gain = of_hash[order], h[order], w[order], g[order]


def _tokens(w: Words, hashes: np.ndarray, keys: np.ndarray, merge: bool):
    """Word place (-1: not sent), row of each token, key of the token before it and its own; the end token closes a row."""
    rows, n = len(w.offs) - 1, len(w.hash)
    own = np.full(n, _REST, np.int64) if merge else w.hash.view(np.int64)
    if len(hashes):
        at = np.minimum(np.searchsorted(hashes, w.hash), len(hashes) - 1)
        at = np.where(hashes[at] == w.hash, at, -1)
        own = np.where(at >= 0, keys[at], own)
    else:
        at = np.full(n, -1)
    place = np.arange(n) + w.row_of_word()
    ends = w.offs[1:] + np.arange(rows)
    kind = np.empty(n + rows, np.int64)
    kind[place], kind[ends] = own, _END
    before = np.empty(n + rows, np.int64)
    before[1:] = kind[:-1]
    before[w.offs[:-1] + np.arange(rows)] = _START
    row = np.empty(n + rows, np.int64)
    row[place], row[ends] = w.row_of_word(), np.arange(rows)
    return at, row, before, kind


def _sum(row: np.ndarray, x: np.ndarray, rows: int) -> np.ndarray:
    return np.bincount(row, x, rows).astype(float) if len(row) else np.zeros(rows)


def _count_words(batches):
    for batch in batches:
        for _, _, data, offs in text_slices(batch.column(0)):
            h, c = np.unique(Words(data, offs, lower=True).hash, return_counts=True)
            yield pa.RecordBatch.from_arrays([as_long(h), pa.array(c.astype(np.int64))], names=["word", "c"])


def _count_pairs(sent):
    def run(batches):
        s, parts, have = sent.value, [], 0

        def flush():
            h, w = (np.concatenate(x) for x in zip(*parts, strict=True))
            names, at = np.unique(np.concatenate([h, w]), return_inverse=True)  # numbers below 2^32 in a batch
            k, c = np.unique(at[:len(h)] << 32 | at[len(h):], return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(names[k >> 32]), pa.array(names[k & 0xFFFFFFFF]),
                                               pa.array(c.astype(np.int64))], names=["h", "w", "c"])

        for batch in batches:
            for _, _, data, offs in text_slices(batch.column(0)):
                parts.append(_tokens(Words(data, offs, lower=True), s["hash"], s["key"], s["merge"])[2:])
                have += len(parts[-1][0])
                if have >= BATCH_PAIRS:
                    yield flush()
                    parts, have = [], 0
        if have:
            yield flush()

    return run


def train(docs: DataFrame, text: str = "text", top: int = TOP, class_share: int | None = None,
          sent_share: int = SENT_SHARE) -> Model:
    """Learn from every row of docs."""
    texts = docs.select(F.col(text).alias("text"))
    words = stored(texts.mapInArrow(_count_words, "word long, c long").groupBy("word").agg(F.sum("c").alias("c")), "unigrams")
    model = Model(words, top, class_share, sent_share)
    model.set_unigrams(texts.count())
    sent = docs.sparkSession.sparkContext.broadcast({"hash": model.hash, "key": model.key, "merge": bool(class_share)})
    pairs = texts.mapInArrow(_count_pairs(sent), "h long, w long, c long").groupBy("h", "w").agg(F.sum("c").alias("c"))
    model.set_pairs(stored(pairs, "pair-counts"))
    return model


_WORD, _PAIR, _ROW = 1, 2, 0
_ASK = "kind int, key long, w long, k long, n long, id {}, tokens long, known long, base double, score double"


def _score(sent, id_type: pa.DataType, scalars: dict):
    """Per row what can be worked out here, and per rare word and pair of it a question."""
    names = ["kind", "key", "w", "k", "n", "id", "tokens", "known", "base", "score"]
    types = [pa.int32(), *[pa.int64()] * 4, id_type, pa.int64(), pa.int64(), pa.float64(), pa.float64()]

    def rare(kind, row, key, w, k):
        order = np.lexsort((w, key, row))
        row, key, w = row[order], key[order], w[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (key[1:] != key[:-1]) | (w[1:] != w[:-1])
        first = np.flatnonzero(new)
        m = len(first)
        n = np.diff(np.append(first, len(row))).astype(np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(m, kind, np.int32)), as_long(key[first]), as_long(w[first]), as_long(k[row[first]]),
             pa.array(n), *(pa.nulls(m, t) for t in types[5:])], names=names)

    def run(batches):
        s = sent.value
        for batch in batches:
            for at, rows, data, offs in text_slices(batch.column(2)):
                words = Words(data, offs, lower=True)
                k = batch.column(1).slice(at, rows).to_numpy()
                place, row, h, w = _tokens(words, s["hash"], s["key"], s["merge"])
                word_row, here = words.row_of_word(), place >= 0
                base = _sum(word_row[here], s["base_log"][place[here]], rows) + scalars["end_base"]
                known = np.bincount(word_row[here], minlength=rows) + scalars["end_known"]
                score = _sum(word_row[here], s["word_log"][place[here]], rows) + scalars["edge_log"]
                score += np.bincount(word_row[~here], minlength=rows) * scalars["rest_alpha"]
                found = np.zeros(len(h), bool)
                if len(s["pair"]):
                    spot = np.minimum(np.searchsorted(s["pair"], _pair_hash(h, w)), len(s["pair"]) - 1)
                    found = (s["pair_h"][spot] == h) & (s["pair_w"][spot] == w)
                    score += _sum(row[found], s["gain"][spot[found]], rows)
                tokens = np.diff(words.offs) + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(rows, _ROW, np.int32)), as_long(k), pa.array(np.zeros(rows, np.int64)), as_long(k),
                     pa.array(np.ones(rows, np.int64)), batch.column(0).slice(at, rows), pa.array(tokens.astype(np.int64)),
                     pa.array(known.astype(np.int64)), pa.array(base.astype(float)), pa.array(score.astype(float))],
                    names=names)
                unsent = words.hash[~here].view(np.int64)
                yield rare(_WORD, word_row[~here], unsent, np.zeros(len(unsent), np.int64), k)
                yield rare(_PAIR, row[~found], h[~found], w[~found], k)

    return run


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, n_known, train_tokens, base_score, score), one row per row of docs."""
    from pyspark.sql.pandas.types import to_arrow_type

    spark = docs.sparkSession
    n, types = model.tokens, model.types
    denominator = n + 0.5 * (types + 1)
    sent = {"hash": model.hash, "key": model.key, "merge": bool(model.class_share),
            "base_log": np.log10((model.count + 0.5) / denominator),
            "word_log": np.log10(model.p1(model.count)) + model.alpha,  # as a follower and as a history
            "pair": model.pair, "pair_h": model.pair_h, "pair_w": model.pair_w, "gain": model.gain}
    scalars = {"end_base": float(np.log10((model.ends + 0.5) / denominator)), "end_known": int(model.ends > 0),
               "edge_log": float(np.log10(model.p1(np.array([model.ends])))[0]) + model.start_alpha,
               "rest_alpha": model.rest_alpha}
    rows = docs.select(F.col(key).alias("id"), short_row_key(key, text).alias("k"), F.col(text).alias("text"))
    kind = rows.schema["id"].dataType
    asked = rows.mapInArrow(_score(spark.sparkContext.broadcast(sent), to_arrow_type(kind), scalars),
                            _ASK.format(kind.simpleString()))
    words = model.words.join(model.histories.withColumnRenamed("h", "word"), "word", "left")
    known = (words.select(F.lit(_WORD).alias("kind"), F.col("word").alias("key"), F.lit(0).cast("long").alias("w"), "c",
                          F.coalesce("alpha_log", F.lit(0.0)).alias("log"))
             .unionByName(model.pairs.select(F.lit(_PAIR).alias("kind"), F.col("h").alias("key"), "w", "c",
                                             F.col("gain").alias("log"))))
    c, log = F.coalesce("c", F.lit(0)), F.coalesce("log", F.lit(0.0))
    got = asked.join(known, ["kind", "key", "w"], "left")
    is_row, is_word = F.col("kind") == _ROW, F.col("kind") == _WORD
    times = F.col("n")
    sums = got.groupBy("k").agg(
        F.max(F.when(is_row, F.col("id"))).alias("id"), F.sum(F.when(is_row, 1)).alias("rows"),
        F.max("tokens").alias("tokens"),
        F.sum(F.when(is_row, F.col("known")).when(is_word & (c > 0), times)).alias("known"),
        F.sum(F.when(is_row, F.col("base")).when(is_word, times * F.log10((c + 0.5) / F.lit(float(denominator))))).alias("base"),
        F.sum(F.when(is_row, F.col("score")).when(is_word, times * (F.log10(model.p1_of(c)) + log)).otherwise(times * log))
        .alias("score"))
    each = F.col("rows")  # equal rows share a key and have asked the same: a row's part is an equal share
    return sums.select(
        F.col("id").alias(key), F.col("tokens").alias("n_tokens"), (F.col("known") / each).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"), (F.col("base") / each).alias("base_score"),
        (F.col("score") / each).alias("score"), F.explode(F.sequence(F.lit(1), each.cast("int"))).alias("_copy")).drop("_copy")
