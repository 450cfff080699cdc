"""Toxicity scores from a learned lexicon, fuzzy matching and context windows.

Terms and stems (word beginnings) that mark toxic texts are learned from a
bounded sample of labelled rows. The terms form a trie; the Levenshtein
automaton of a word, intersected with it, finds misspelled terms: one edit from
five letters on, two from nine. The intersection is made deterministic as it is
walked, so a text's word costs a few table look-ups. Letters are folded first
(case, digits and signs that stand for letters).

Each hit is judged in a window of words around it: inside quotation marks or
after a verb of saying it counts as quoted, next to a second-person pronoun as
addressed. A logistic model over the weights of plain, fuzzy, quoted and
addressed hits, their number and their share of the text gives the score; it is
fitted on another half of the sample than the lexicon.

Labels are used only to learn; the score of a text depends on its text alone.
Null and empty texts have no hits and get the model's base score. Repeated rows
get equal scores; a document labelled more than once counts with its largest
label. Without labelled rows of both kinds every score is 0. An empty table gives
no rows.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bound of the labelled rows learned from (those of the least hashes of their ids).
SAMPLE_ROWS = 12_000
LEXICON = 2_000
MIN_DOCS = 4
MIN_LOG_ODDS = 2.5
THRESHOLD = 0.3
STEMS = (4, 5, 6, 7)
WINDOW = 6
CACHE_WORDS = 300_000
#: States of the automaton kept in a worker.
MAX_STATES = 100_000
#: Signs and digits used for letters.
_FOLD = str.maketrans("013457@$", "oieastas")
_SPLIT = re.compile(r"[\W_]+")
_SAYS = frozenset("said says say wrote writes quoted quote called calls told replied dit disait écrit sagte schrieb nannte "
                  "dijo escribió llamó according".split())
_YOU = frozenset("you your youre u ur du dein deine dich ihr tu toi vous votre ton ta tú usted tus vosotros".split())
_MARK = re.compile("[\"“”«»„‟]")
FEATURES = 8


class Lexicon:
    """Terms with weights, stems with weights, and the term trie with its lazily built automaton."""

    def __init__(self, terms: dict[str, float], stems: dict[str, float]):
        self.terms, self.stems = terms, stems
        self.child: list[dict[str, int]] = [{}]
        self.end: list[str | None] = [None]
        for t in sorted(terms):
            at = 0
            for c in t:
                if c not in self.child[at]:
                    self.child[at][c] = len(self.child)
                    self.child.append({})
                    self.end.append(None)
                at = self.child[at][c]
            self.end[at] = t
        self._forget()

    def _forget(self) -> None:
        """Begin the automaton anew: states are made as words need them, and bounded in number."""
        self._states: dict[frozenset, int] = {}
        self._sets: list[frozenset] = []
        self._moves: list[dict[str, int]] = []
        self._accept: list[str | None] = []
        self._start = self._state(self._close({(0, 0)}))

    @staticmethod
    def edits(term: str) -> int:
        return 0 if len(term) < 5 else 1 if len(term) < 9 else 2

    def _close(self, at: set) -> frozenset:
        """With letters of the term left out; of a node's entries the one with the fewest edits."""
        best: dict[int, int] = {}
        todo = list(at)
        while todo:
            node, e = todo.pop()
            if best.get(node, 3) <= e:
                continue
            best[node] = e
            if e < 2:
                todo.extend((c, e + 1) for c in self.child[node].values())
        return frozenset(best.items())

    def _state(self, s: frozenset) -> int:
        k = self._states.get(s)
        if k is None:
            k = self._states[s] = len(self._sets)
            self._sets.append(s)
            self._moves.append({})
            hits = [(e, self.end[n]) for n, e in s if self.end[n] and e <= self.edits(self.end[n])]
            self._accept.append(min(hits)[1] if hits else None)
        return k

    def _move(self, k: int, c: str) -> int:
        to = set()
        for node, e in self._sets[k]:
            nxt = self.child[node].get(c)
            if nxt is not None:
                to.add((nxt, e))
            if e < 2:
                to.add((node, e + 1))
                to.update((n, e + 1) for n in self.child[node].values())
        out = self._moves[k][c] = self._state(self._close(to)) if to else -1
        return out

    def fuzzy(self, word: str) -> str | None:
        """The nearest term within its edits, if any."""
        if len(self._sets) > MAX_STATES:
            self._forget()
        k = self._start
        for c in word:
            nxt = self._moves[k].get(c)
            k = self._move(k, c) if nxt is None else nxt
            if k < 0:
                return None
        return self._accept[k]

    def judge(self, token: str) -> tuple[int, float, str] | None:
        """(kind, weight, term) of a token as written; kind 0 term, 1 stem, 2 misspelled."""
        parts = [p for p in _SPLIT.split(token.lower()) if p]
        if len(parts) > 1:
            parts.append("".join(parts))
        for p in parts:
            if p in self.terms:
                return 0, self.terms[p], p
        for p in parts:
            for k in STEMS:
                if len(p) > k and p[:k] in self.stems:
                    return 1, self.stems[p[:k]], p[:k]
        for p in parts:
            folded = p.translate(_FOLD)
            if folded in self.terms:
                return 2, self.terms[folded], folded
            if len(folded) >= 4 and (t := self.fuzzy(folded)):
                return 2, self.terms[t], t
        return None


class _Judged(dict):
    """Token -> judgement; bounded memory."""

    def __init__(self, lexicon: Lexicon):
        super().__init__()
        self._lexicon = lexicon

    def __missing__(self, token: str):
        out = self._lexicon.judge(token)
        if len(self) < CACHE_WORDS:
            self[token] = out
        return out


def features(text: str | None, judged: _Judged) -> list[float]:
    tokens = (text or "").split()
    hit = {t: j for t in set(tokens) if (j := judged[t]) is not None}
    out = [0.0] * FEATURES
    if not hit:
        return out
    seen, n, quoted_marks = set(), 0, 0
    for i, t in enumerate(tokens):
        marks = len(_MARK.findall(t))
        if t in hit:
            kind, weight, term = hit[t]
            n += 1
            near = [x.lower().strip(".,;:!?\"'“”«»()") for x in tokens[max(0, i - WINDOW):i + WINDOW + 1]]
            inside = quoted_marks % 2 == 1 or marks >= 2
            quoted = inside and any(x in _SAYS for x in near) or inside and marks < 2
            out[kind] += weight
            if quoted:
                out[3] += weight
            elif any(x in _YOU for x in near):
                out[4] += weight
            seen.add(term)
        quoted_marks += marks
    out = [math.log1p(x) for x in out]
    out[5] = math.log1p(len(seen))
    out[6] = math.sqrt(n / len(tokens))
    out[7] = 1.0
    return out


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 50) -> np.ndarray:
    """Weights with the intercept last (Newton steps, ridge on all but the intercept)."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, r = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    r[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(r), x.T @ (y - p) - r * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _learn_words(batches):
    """Per batch: in how many toxic and other texts each word or stem stands."""
    for batch in batches:
        count: dict[str, list[int]] = {}
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            own = set()
            for w in {p for p in _SPLIT.split((text or "").lower()) if len(p) > 2}:
                own.add("=" + w)
                own.update("^" + w[:k] for k in STEMS if len(w) > k)
            for f in own:
                count.setdefault(f, [0, 0])[toxic] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(count), pa.string()), pa.array([c[1] for c in count.values()], pa.int64()),
             pa.array([c[0] for c in count.values()], pa.int64())], names=["f", "pos", "neg"])


def held_out(key: str) -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
          sample_rows: int = SAMPLE_ROWS) -> tuple[Lexicon, np.ndarray | None]:
    """Lexicon and model weights from labelled rows that are not held out."""
    usable = (labels.select(F.col(key).alias("id"), F.col(label).alias("y")).filter("id is not null and y in (0, 1)")
              .filter(~held_out("id")).groupBy("id").agg(F.max("y").cast("int").alias("y")))
    half = F.pmod(F.shiftrightunsigned(F.xxhash64(F.col("id").cast("string")), 9), F.lit(2))
    chosen = usable.orderBy(F.xxhash64(F.col("id").cast("string")), "id").limit(sample_rows).withColumn("half", half)
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen), "id")
    first, second = rows.filter("half = 0").select("text", "y"), rows.filter("half = 1").select("text", "y")
    size = {r[0]: r[1] for r in first.groupBy("y").count().collect()}
    pos, neg = size.get(1, 0), size.get(0, 0)
    if not pos or not neg:
        return Lexicon({}, {}), None
    odds = (F.log((F.col("pos") + 0.5) / F.lit(pos + 1.0)) - F.log((F.col("neg") + 0.5) / F.lit(neg + 1.0))).alias("odds")
    least = max(2, min(MIN_DOCS, pos // 20))
    found = (first.mapInArrow(_learn_words, "f string, pos long, neg long").groupBy("f")
             .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).filter(F.col("pos") >= least)
             .select("f", odds, "pos").filter(F.col("odds") >= MIN_LOG_ODDS)
             .orderBy(F.desc(F.col("odds") * F.sqrt("pos")), "f").limit(LEXICON).collect())
    stems = {r[0][1:]: r[1] for r in found if r[0][0] == "^"}
    lexicon = Lexicon({r[0][1:]: r[1] for r in found if r[0][0] == "="}, stems)

    def measured(batches):
        judged = _Judged(lexicon)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([features(t, judged) for t in batch.column(0).to_pylist()], pa.list_(pa.float64())), batch.column(1)],
                names=["x", "y"])

    table = second.mapInArrow(measured, "x array<double>, y int").collect()  # at most sample_rows short rows
    y = np.array([r[1] for r in table], float)
    if not len(y) or y.min() == y.max():
        return lexicon, None
    return lexicon, fit_logistic(np.array([r[0] for r in table]), y)


def score(docs: DataFrame, lexicon: Lexicon, weights: np.ndarray | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) of every row."""
    def run(batches):
        judged = _Judged(lexicon)
        for batch in batches:
            x = np.array([features(t, judged) for t in batch.column(1).to_pylist()], float).reshape(-1, FEATURES)
            z = np.clip(x @ weights[:-1] + weights[-1], -30, 30) if weights is not None else np.full(len(x), -np.inf)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-z)))], names=[key, "score"])

    df = docs.select(key, text)
    return df.mapInArrow(run, f"`{key}` {df.schema[key].dataType.simpleString()}, score double")
