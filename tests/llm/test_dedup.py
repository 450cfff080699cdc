import hashlib
from collections import Counter

import numpy as np
import pytest
from llm_helpers import docs, texts, words
from tallyloom.llm import substring_dedup as sd
from tallyloom.llm.fm_index import FMIndex


def test_matching_statistics_equal_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(30):
        k = rng.integers(1, 10)
        seqs = [rng.integers(1, 5, rng.integers(1, 20)).astype(np.uint64) for _ in range(k)]
        weight = rng.integers(1, 3, k)
        offs = np.concatenate([[0], np.cumsum([len(s) for s in seqs])])
        index = FMIndex(np.concatenate(seqs), offs, weight)
        count = Counter()
        for s, w in zip(seqs, weight, strict=True):
            for i in range(len(s)):
                for j in range(i + 1, len(s) + 1):
                    count[tuple(s[i:j])] += w
        pats = [*seqs, rng.integers(1, 7, 12).astype(np.uint64)]
        at = np.concatenate([[0], np.cumsum([len(s) for s in pats])])
        got = index.matching_statistics(np.concatenate(pats), at, 2)
        for p, o in zip(pats, at, strict=False):
            for i in range(len(p)):
                assert got[o + i] == max([j - i for j in range(i + 1, len(p) + 1) if count[tuple(p[i:j])] >= 2], default=0)


@pytest.mark.parametrize("hot", [1, 10_000])
def test_dedup_equals_brute_force(spark, hot):
    window = 6
    rows = [(i, t, "s", 1) for i, t in enumerate(texts(2, 60))]
    rows += [rows[5], rows[5], (None, rows[7][1], None, None)]  # repeated rows, a null key
    df = docs(spark, rows, ", n_words string, spans int")
    got = sd.dedup(df, window=window, gram=3, hot_segments=hot, shard_words=200).collect()
    count = Counter()
    for _, t, *_ in rows:
        w = words(t)
        for i in range(len(w) - window + 1):
            count[tuple(w[i:i + window])] += 1

    def brute(t):
        w = words(t)
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if count[tuple(w[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        return len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)

    want = Counter((i, *brute(t)) for i, t, *_ in rows)
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got) == want
    assert sum(x[2] > 0 for x in want) > 5 and "spans" in got[0].asDict()


def test_layout_and_empty(spark):
    rows = [(1, "a  b\nc"), (2, "x " + " ".join(f"p{i}" for i in range(35)) + "\n y  z"), (3, " ".join(f"p{i}" for i in range(35)))]
    got = {r.doc_id: r.kept_text for r in sd.dedup(docs(spark, rows), layout="original").collect()}
    assert got == {1: "a  b\nc", 2: "x\ny  z", 3: ""}
    assert sd.dedup(docs(spark, rows).limit(0)).count() == 0
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")
