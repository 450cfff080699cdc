import math
from collections import Counter, defaultdict

import pytest
from llm_helpers import docs, texts, words
from tallyloom.llm import katz


def brute(train, rows, class_share, sent_share):
    tokens = lambda t: [*words(t, lower=True), "</s>"]
    c = Counter(w for t in train for w in tokens(t))
    n, v = sum(c.values()), len(c)
    own = {w for w in c if w != "</s>" and c[w] * class_share >= n and c[w] * sent_share >= n}
    cls = lambda w: w if w in own or w == "</s>" else "<rest>"
    pairs = defaultdict(Counter)
    for t in train:
        h = "<s>"
        for w in tokens(t):
            pairs[h][cls(w)] += 1
            h = cls(w)
    d1, d2 = katz.discounts(Counter(c.values())), katz.discounts(Counter(x for p in pairs.values() for x in p.values()))
    f = lambda k, d: d[k] if k < len(d) else 1.0
    kept = sum(k * f(k, d1) for k in c.values())
    scale = 1.0 if kept < n else n / (n + 1) / (kept / n)
    unseen = 1 - kept / n * scale
    p1 = lambda w: c[w] * f(c[w], d1) / n * scale if c[w] else unseen
    p = {w: p1(w) for w in [*own, "</s>"]}
    p["<rest>"] = 1 - sum(p.values())
    total, alpha = {}, {}
    for h, x in pairs.items():
        have, k, seen = sum(x.values()), sum(k * f(k, d2) for k in x.values()), sum(p[w] for w in x)
        full = 1 - seen <= 1e-12
        total[h] = k if full else have + 1 if have - k <= 1e-9 * have else have
        alpha[h] = 0 if full else (1 - k / total[h]) / (1 - seen)
        mass = sum(x[w] * f(x[w], d2) / total[h] if w in x else alpha[h] * p[w] for w in p)
        assert abs(mass - 1) < 1e-9  # the followers of every history sum to one
    out = []
    for i, t in rows:
        h, score, base = "<s>", 0.0, 0.0
        for w in tokens(t):
            k, x = cls(w), pairs.get(h, {})
            score += math.log10(x[k] * f(x[k], d2) / total[h]) if k in x else math.log10(alpha.get(h, 1) * p[k])
            score += math.log10(p1(w)) - math.log10(p["<rest>"]) if k == "<rest>" else 0
            base += math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1)))
            h = k
        out.append((i, len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n, base, score))
    return out


@pytest.mark.parametrize(("class_share", "sent_share"), [(50, 200), (100_000, 1_000_000), (3, 5)])
def test_scores_equal_brute_force(spark, class_share, sent_share):
    rows = list(enumerate(texts(5, 50)))
    train = [r for r in rows if r[0] % 5]
    rows += [rows[4], rows[4], (None, "never seen words w1"), (None, None)]
    model = katz.train(docs(spark, train), class_share=class_share, sent_share=sent_share)
    got = katz.score(docs(spark, rows), model).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    want = sorted(brute([t for _, t in train], rows, class_share, sent_share), key=key)
    got = sorted((tuple(r) for r in got), key=key)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    for g, w in zip(got, want, strict=True):
        assert g[4] == pytest.approx(w[4], rel=1e-9) and g[5] == pytest.approx(w[5], rel=1e-6)


def test_empty(spark):
    none = docs(spark, [(1, "a")]).limit(0)
    assert katz.score(none, katz.train(docs(spark, [(1, "a b")]))).count() == 0
    r = katz.score(docs(spark, [(1, "a b")]), katz.train(none)).first()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (3, 0, 0, 0.0)


def test_discounts():
    d = katz.discounts({1: 100, 2: 40, 3: 20, 4: 12, 5: 8, 6: 5})
    assert all(0 < x < 1 for x in d[1:]) and katz.discounts({})[1:] == [0.5, 0.75, 1 - 0.5 / 3, 0.875, 0.9]


@pytest.mark.parametrize("sent_share", [1, 5, 200, 1_000_000])
def test_all_pairs_are_kept_whatever_is_sent(spark, sent_share):
    rows = list(enumerate(texts(5, 50))) + [(None, "never seen words w1 never")]
    train = [r for r in rows[:-1] if r[0] % 5]
    got = katz.score(docs(spark, rows), katz.train(docs(spark, train), sent_share=sent_share)).collect()
    want = brute([t for _, t in train], rows, 10**9, 10**9)
    got = {r.doc_id: r.score for r in got}
    for w in want:
        assert got[w[0]] == pytest.approx(w[5], rel=1e-6)


def test_words_below_one_in_100_000_have_pairs(spark):
    train = [(0, "x y " * 110_000), (1, "rare pair")]
    got = katz.score(docs(spark, [(0, "rare pair"), (1, "pair rare")]), katz.train(docs(spark, train))).collect()
    score = {r.doc_id: r.score for r in got}
    assert score[0] > score[1] + 1
