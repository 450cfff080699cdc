import numpy as np
from llm_helpers import docs
from pyspark.sql import functions as F
from tallyloom.llm import toxicity as tx

SF = "/root/testdata/sf0.1"


def test_fuzzy_equals_brute_force():
    terms = {"idiot": 1.0, "worthless": 1.0, "scum": 1.0, "moron": 1.0}
    lex = tx.Lexicon(terms, {})

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            new = [i + 1]
            for j, y in enumerate(b):
                new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
            row = new
        return row[-1]

    rng = np.random.default_rng(0)
    for _ in range(3000):
        w = list(str(rng.choice(list(terms))))
        for _ in range(rng.integers(0, 4)):
            at = int(rng.integers(0, len(w) + 1))
            if rng.random() < 0.4 and at < len(w):
                w.pop(at)
            else:
                w.insert(at, str(rng.choice(list("aeioumst"))))
        w = "".join(w)
        near = [t for t in terms if distance(w, t) <= tx.Lexicon.edits(t)]
        assert (lex.fuzzy(w) in near) if near else lex.fuzzy(w) is None, w
    assert lex.judge("1D10T!!")[0] == 2 and lex.judge("id-iot") [2] == "idiot" and lex.judge("fine") is None


def test_quotation_lowers_abuse():
    judged = tx._Judged(tx.Lexicon({"idiot": 3.0}, {}))
    plain, quoted = tx.features("what an idiot he is", judged), tx.features('he said "what an idiot" yesterday', judged)
    you = tx.features("you idiot", judged)
    assert plain[3] == 0 < quoted[3] and plain[4] == 0 < you[4] and tx.features("", judged) == [0.0] * tx.FEATURES


def test_held_out_accuracy(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    lexicon, weights = tx.learn(d, labels)
    some = d.join(labels, "doc_id").filter(tx.held_out("doc_id"))
    out = tx.score(some, lexicon, weights).join(labels, "doc_id").withColumn("hit", F.col("score") >= tx.THRESHOLD)
    got = {(r.toxic, r.hit): r["count"] for r in out.groupBy("toxic", "hit").count().collect()}
    assert got[1, True] >= 0.9 * (got[1, True] + got.get((1, False), 0))
    assert got.get((0, True), 0) <= 0.02 * got[0, False]


def test_nulls_and_no_labels(spark):
    df = docs(spark, [(1, None), (None, ""), (2, "x"), (2, "x")])
    none = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, toxic int")
    out = tx.score(df, *tx.learn(df, none))
    assert [r.score for r in out.collect()] == [0.0] * 4 and tx.score(df.limit(0), *tx.learn(df, none)).count() == 0


def test_long_words_and_bounded_states(monkeypatch):
    long_term = "pneumonoultramicroscopicsilicovolcanoconiosis"
    lex = tx.Lexicon({long_term: 2.0, "idiot": 1.0}, {})
    assert lex.judge(long_term[:20] + "x" + long_term[20:])[2] == long_term  # of any length
    assert lex.judge("z" * 100_000) is None
    monkeypatch.setattr(tx, "MAX_STATES", 5)
    small = tx.Lexicon({long_term: 2.0, "idiot": 1.0}, {})
    words = ["idiiot", "idio", "moron", long_term[1:], "idiots", "fine", "iidiott"]
    assert [small.fuzzy(w) for w in words] == [lex.fuzzy(w) for w in words]
    for w in words * 20:
        small.fuzzy(w)
    assert len(small._sets) < 500


def test_clashing_columns(spark):
    rows = [(1, "you idiot", 1, 2, 3, 4), (2, "a kind word", 1, 2, 3, 4)]
    df = docs(spark, rows, ", id long, y long, score long, half long")
    lexicon, weights = tx.Lexicon({"idiot": 3.0}, {}), np.arange(tx.FEATURES + 1, dtype=float)
    got = {r.doc_id: r.score for r in tx.score(df, lexicon, weights).collect()}
    plain = {r.doc_id: r.score for r in tx.score(df.select("doc_id", "text"), lexicon, weights).collect()}
    assert got == plain and got[1] > got[2]
