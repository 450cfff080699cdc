"""Views from change sets equal full rebuilds, and write only what a change touches."""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyloom import schemas
from tallyloom.functions.ordering import last_flagged
from tallyloom.operators import notes as nt
from tallyloom.operators import views
from tallyloom.session import scratch_path


def scanned(spark, state):
    rows = [(r, c, s, t, ["w"], [], dt.date(2024, 1, 1), [1], "b" + t) for (r, c, s), t in state.items()]
    return nt.scan_notes(nt.render_notes(spark.createDataFrame(rows, schemas.NOTES)))


def held(spark, root):
    return {(r.repo, r.category, r.start): (r.n_items, r.text, r.version) for r in views.parts(spark, root).collect()}


def test_updates_equal_rebuilds(spark):
    rng = random.Random(3)
    place = lambda: (rng.choice(["r", "r", "r", "q"]), rng.choice(["patterns", "testing"]), f"n{rng.randrange(400)}")
    state = {place(): "T0" for _ in range(260)}
    root, other = scratch_path(spark, "view-a"), scratch_path(spark, "view-b")
    views.build(views.index_pieces(scanned(spark, state)), root, 1)
    for k in range(4):
        before = held(spark, root)
        keys = {place() for _ in range((3, 40, 1, 25)[k])}
        for key in keys:
            if rng.random() < 0.4:
                state.pop(key, None)
            else:
                state[key] = f"T{k + 1}"
        if k == 1:  # a whole category goes
            keys |= {x for x in state if x[:2] == ("q", "testing")}
            state = {x: t for x, t in state.items() if x[:2] != ("q", "testing")}
        changed = spark.createDataFrame([(r, c, s + ".md") for r, c, s in keys], "repo string, category string, name string")
        n = views.update(views.index_pieces(scanned(spark, state)), changed, root, 1)
        views.build(views.index_pieces(scanned(spark, state)), other, 1)
        now, want = held(spark, root), held(spark, other)
        assert {p: x[:2] for p, x in now.items()} == {p: x[:2] for p, x in want.items()}
        same = [p for p in before if p in now and before[p][:2] == now[p][:2]]
        kept = [p for p in same if before[p][2] == now[p][2]]
        assert n <= 2 * len(keys) + 2 and len(kept) >= len(before) - 2 * len(keys) - 2
    assert len(kept) > 0


def test_parts_join_to_the_index(spark):
    state = {("r", c, f"s{i}"): "T" for c in ("patterns", "testing") for i in range(70)}
    root = scratch_path(spark, "view-c")
    views.build(views.digest_pieces(scanned(spark, state)), root, 1)
    rank = nt.category_rank()
    rows = views.parts(spark, root).withColumn("rank", rank).orderBy("rank", "start").collect()
    assert len(rows) > 4
    assert "".join(r.text for r in rows) == nt.notes_digest(scanned(spark, state)).first().digest


def test_last_flagged(spark):
    df = spark.range(3000).select((F.col("id") % 3).alias("k"), ((F.col("id") * 7919) % 10007).alias("v"))
    df = df.withColumn("f", F.col("v") % 40 == 0)
    got = last_flagged(df, ["k"], ["v"], F.col("f"), "s")
    w = Window.partitionBy("k").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    want = F.last(F.when(F.col("f"), F.col("v")), ignorenulls=True).over(w)
    assert got.count() == 3000 and got.withColumn("w", want).filter("not (w <=> s.v)").count() == 0


def test_catalog_from_changes(spark):
    state = {("r", "patterns", f"s{i}"): "T" for i in range(6)}
    old = nt.note_catalog(scanned(spark, state))
    state[("r", "patterns", "s2")] = "New"
    state.pop(("r", "patterns", "s3"))
    state[("r", "testing", "s9")] = "Added"
    changed = spark.createDataFrame([("r", "patterns", "s2"), ("r", "patterns", "s3"), ("r", "testing", "s9")],
                                    "repo string, category string, slug string")
    got = views.update_catalog(old, scanned(spark, state), changed)
    assert sorted(map(str, got.collect())) == sorted(map(str, nt.note_catalog(scanned(spark, state)).collect()))
