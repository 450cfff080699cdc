import random
from collections import defaultdict

import numpy as np
import pytest
from llm_helpers import docs, texts, words
from tallyloom.llm import jaccard_join as jj
from tallyloom.llm.components import components


def brute(rows, n, percent):
    sets = {}
    for i, t in rows:
        w = words(t, lower=True)
        sets[i] = frozenset(zip(*[w[k:] for k in range(n)], strict=False)) if len(w) >= n else frozenset([tuple(w)] if w else [])
    comp = {i: i for i in sets}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                comp[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def family(seed, n=60, size=120):
    """Near copies of one text with 0 to 12 edits, some cut short."""
    rng = random.Random(seed)
    base = [f"t{rng.randrange(500)}" for _ in range(size)]
    out = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.choice((0, 1, 1, 2, 3, 5, 12))):
            w[rng.randrange(len(w))] = f"e{rng.randrange(4)}"
        out.append(" ".join(w[:len(w) - rng.choice((0, 0, 5, 20))]))
    return out


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80)])
def test_join_equals_brute_force(spark, n, percent):
    rows = list(enumerate([*texts(4, 40), *family(1), *family(2, 20, 30), "A B c", "a b C", "a", "A"]))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jj.join(docs(spark, rows), n=n, percent=percent).collect()}
    assert got == brute(rows, n, percent)


def test_repeats_nulls_and_empty(spark):
    rows = [(1, "a b c d"), (1, "a b c d"), (2, "A B C D"), (None, "a b c d"), (3, None), (4, ""), (None, None), (5, "z z z z z")]
    got = jj.join(docs(spark, rows)).collect()
    assert sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1) for r in got) == [
        (-1, 0, -1), (-1, 2, 1), (1, 2, 1), (1, 2, 1), (2, 2, 1), (3, 0, 3), (4, 0, 4), (5, 1, 5)]
    kept = jj.keep_one(docs(spark, [(*r, 7) for r in rows], ", _j_k int")).collect()
    assert sorted((r.doc_id or -1, r.text or "") for r in kept) == [
        (-1, ""), (1, "a b c d"), (3, ""), (4, ""), (5, "z z z z z")]
    assert jj.join(docs(spark, rows).limit(0)).count() == 0 and jj.keep_one(docs(spark, rows).limit(0)).count() == 0


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(50, 40), (40, 40)], "a long, b long")
    got = {r.node: r.component for r in components(links).collect()}
    groups = defaultdict(set)
    for k, v in got.items():
        groups[v].add(k)
    assert groups == {0: set(range(21)), 40: {40, 50}}


def test_heads_are_shuffled_once(spark, tmp_path):
    rows = [(1, 2, 9, False, 4, [7, 8]), (1, 3, 9, False, 4, [8, 9]), (1, 4, 9, True, 1, [9]), (1, 5, 99, False, 4, [8]),
            (2, 6, 9, False, 4, [8]), (1, 7, 9, True, 1, [9])]
    schema = "r long, y long, n_y long, linked boolean, d long, head array<long>"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "star"))
    star = spark.read.schema(schema).parquet(str(tmp_path / "star")).filter("head is not null")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = jj._derived(star, 50)
        plan = out._jdf.queryExecution().executedPlan().toString()
        got = sorted(map(tuple, out.collect()))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert got == [(2, 3), (3, 4), (3, 7)]
    assert "ReusedExchange" in plan


def test_a_common_passage_puts_unrelated_sets_in_no_list(spark, monkeypatch):
    rng = random.Random(7)
    passage = [f"p{i}" for i in range(50)]
    rows = [(i, " ".join([*(f"w{i}x{k}" for k in range(130)), *passage, *(f"v{i}x{k}" for k in range(130))])) for i in range(120)]
    near = rows[0][1].split()
    for k in (3, 99, 290):
        near[k] = f"e{rng.randrange(9)}"
    rows += [(500, " ".join(near)), (501, rows[5][1]), *((600 + i, t) for i, t in enumerate(family(3, 20, 60)))]
    listed = {}
    stored = jj.stored

    def seen(df, name):
        out = stored(df, name)
        listed.setdefault(name, out)
        return out

    monkeypatch.setattr(jj, "stored", seen)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jj.join(docs(spark, rows), n=5, percent=80).collect()}
    assert got == brute(rows, 5, 80)
    assert got[500][1] == 0 and got[501][1] == 5 and got[1][1] == 1
    named = {r.fp: r.id for r in listed["named"].collect()}
    assert {i for i in (named[r.fp] for r in listed["lists"].collect()) if 0 < i < 500} == set()


def test_rarest_parts_of_linked_sets_meet():
    rng = np.random.default_rng(11)
    for _ in range(300):
        parts, most = 12, int(rng.integers(1, 9))
        x = rng.integers(0, 2**62, parts).astype(np.uint64)
        y = np.where(rng.permutation(parts) < most, rng.integers(0, 2**62, parts).astype(np.uint64), x)
        small = lambda key: key % np.uint64(7) == 0
        key, row = np.concatenate([x, y]), np.repeat([0, 1], parts)
        at = jj._rarest(row, key, small(key), np.full(len(key), most), (key % np.uint64(3)).astype(np.int64))
        assert np.bincount(row[at]).tolist() == [most + 1] * 2
        assert set(key[at][row[at] == 0].tolist()) & set(key[at][row[at] == 1].tolist())


def test_pairs_whose_differences_meet_too_seldom_are_not_derived(spark):
    schema = "r long, y long, n_y long, linked boolean, d long, head array<long>"
    # 80 %: of 100 members each, linked ones have |y ^ z| <= 22, so 9 of 20 grams in common, at most 3 of them not in the heads
    head = list(range(100, 117))
    rows = [(1, 2, 100, False, 20, head), (1, 3, 100, False, 20, [*head[:6], *range(200, 211)]),
            (1, 4, 100, False, 20, [*head[:5], *range(300, 312)])]
    got = jj._derived(spark.createDataFrame(rows, schema), 80).collect()
    assert sorted(map(tuple, got)) == [(2, 3)]
