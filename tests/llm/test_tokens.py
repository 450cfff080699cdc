import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import docs
from pyspark.sql import functions as F
from tallyloom.llm import jaccard_join, katz, substring_dedup, tokens
from tallyloom.llm.frames import row_key, short_row_key


def thue_morse(n, a, b):
    x, y = a, b
    while len(x) < n:
        x, y = x + y, y + x
    return x, y


def hashes(texts, lower=False):
    out = []
    for _, _, data, offs in tokens.text_slices(pa.array(texts, pa.string())):
        w = tokens.Words(data, offs, lower)
        out += [w.hash[w.offs[i]:w.offs[i + 1]].tolist() for i in range(len(w.offs) - 1)]
    return out


def test_words_without_structure_that_collides():
    pairs = [thue_morse(n, a, b) for n in (16, 64, 128, 1024, 4096) for a, b in (("a", "b"), ("xy", "yx"), ("é", "è"))]
    words = sorted({w for p in pairs for w in p} | {"a" * k for k in (1, 2, 63, 64, 65, 200)} | {"b" + "a" * 64, "a" * 64 + "b"})
    got = [h for [h] in hashes(words)]
    assert len(set(got)) == len(words)
    assert got == [h for [h] in hashes([" " * (k % 5) + w for k, w in enumerate(words)])]  # wherever they stand
    upper = "QWERTY" * 40
    assert hashes([upper], lower=True) == hashes([upper.lower()], lower=True) != hashes([upper])


def test_spans_of_words_without_structure_that_collides():
    x, y = thue_morse(2048, [3], [5])
    h = np.array([7, *x, 9, *y, *x], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    start, n = np.array([1, 2 + len(x), 2 + 2 * len(x)]), len(x)
    a, b, c = tokens.span_hash(h, start, start + n).tolist()
    assert a == c != b
    inner = tokens.span_hash(h, np.array([1, 1]), np.array([5, 6])).tolist()
    assert inner[0] != inner[1]


def test_products_modulo_the_prime():
    rng = np.random.default_rng(1)
    p = 2**61 - 1
    a, b = (np.concatenate([rng.integers(0, p, 500), [0, 1, p - 1, p - 1]]).astype(np.uint64) for _ in range(2))
    assert tokens._times(a, b).tolist() == [int(x) * int(y) % p for x, y in zip(a, b, strict=True)]
    up, down = tokens._powers(10)
    assert tokens._times(up[:3000], down[:3000]).tolist() == [1] * 3000


ROWS = [(5, None), (None, "5"), (5, "5"), (None, None), (5, "")]


def test_keys_tell_nulls_apart(spark):
    got = docs(spark, ROWS).select(F.hex(row_key("doc_id", "text")).alias("a"), short_row_key("doc_id", "text").alias("b"))
    assert got.select("a").distinct().count() == got.select("b").distinct().count() == len(ROWS)
    assert got.filter("length(a) = 32").count() == len(ROWS)


@pytest.mark.parametrize("rows", [ROWS, ROWS[:2]])
def test_operators_tell_nulls_apart(spark, rows):
    df = docs(spark, rows)
    same = lambda x, y: sorted(map(repr, x)) == sorted(map(repr, y))
    assert same([(r.doc_id, r.n_words) for r in substring_dedup.dedup(df).collect()], [(i, len((t or "").split())) for i, t in rows])
    assert same([(r.doc_id, r.n_shingles) for r in jaccard_join.join(df).collect()], [(i, bool(t) * 1) for i, t in rows])
    kept = [(r.doc_id, r.text) for r in jaccard_join.keep_one(df).collect()]
    texts = [x for x in rows if x[1]]
    assert same(kept, [*[x for x in rows if not x[1]], min(texts, key=lambda x: x[0] is None)])
    scored = katz.score(df, katz.train(df)).collect()
    assert same([(r.doc_id, r.n_tokens) for r in scored], [(i, 1 + bool(t)) for i, t in rows])
