from collections import Counter

from llm_helpers import docs, texts, words
from tallyloom.llm import line_quality as q


def brute(text):
    w = words(text)
    c = Counter(zip(w, w[1:], w[2:], strict=False))
    m = [False] * len(w)
    for k in range(len(w) - 2):
        if c[w[k], w[k + 1], w[k + 2]] > 1:
            m[k:k + 3] = [True] * 3
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum(ch in "#*$%&|<>" for ch in text or ""), len(lines) - len(set(lines)), sum(m))


def test_counts_equal_brute_force(spark):
    rows = list(enumerate([*texts(), "a b c a b c a", "x\nx\n \n x\ny", "é### b*", "a b a b a b a b"]))
    got = {r.doc_id: r for r in q.measure(docs(spark, rows)).collect()}
    for i, t in rows:
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(t), (i, t)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)


def test_lines_and_clean(spark):
    prose = " ".join(f"word{i}" for i in range(60)) + "."
    rows = [(1, prose, "x", 0), (2, prose + "\nAll rights reserved.", "x", 0), (3, "Home | News | About | Contact", "x", 0),
            (4, prose.upper().replace(" ", "!! "), "x", 0), (None, prose, None, None), (5, None, "x", 1), (6, "", "x", 1)]
    df = docs(spark, rows, ", kept string, n_chars long")
    out = sorted(q.clean(df).collect(), key=lambda r: (r.doc_id is None, r.doc_id))
    assert [(r.doc_id, r.text) for r in out] == [(1, prose), (2, prose), (None, prose)]
    assert out[1].n_chars == len(prose) and out[0].kept == "x"
    assert q.clean(df.limit(0)).count() == 0
