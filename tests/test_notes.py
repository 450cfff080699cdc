"""Note table: upsert, index, compaction passes, managed block, drift, folder scan."""

import datetime as dt

from pyspark.sql import functions as F

from tallyloom import schemas
from tallyloom.operators import notes as nt

AS_OF = "2025-01-02"
EMPTY_TW = []


def items_df(spark, rows):
    return spark.createDataFrame(
        [("r", issue, pos, cat, slug, title, rw, tw, body) for issue, pos, cat, slug, title, rw, tw, body in rows],
        "repo string, issue long, pos long, category string, slug string, title string, read_when array<string>, "
        "tripwires array<struct<action:string,warning:string>>, body string")


def notes_df(spark, rows):
    return spark.createDataFrame(rows, schemas.NOTES)


def note(cat, slug, ids, title="T", rw=("when x",), body="body"):
    return ("r", cat, slug, title, list(rw), [], dt.date(2024, 1, 1), list(ids), body)


def test_upsert_create_then_accumulate(spark):
    empty = notes_df(spark, [])
    it1 = items_df(spark, [(1, 1, "tripwires", "s", "Title", ["a", "b"], [("do x", "beware")], "Body")])
    snap = nt.upsert_notes(empty, it1, AS_OF)
    r = snap.first()
    assert (r.change, r.title, list(r.source_issues), str(r.last_updated)) == ("insert", "Title", [1], AS_OF)
    content = nt.render_notes(snap.drop("change")).first().content
    assert content.startswith('---\ntitle: "Title"\nread_when:\n  - "a"\n  - "b"\n')
    assert 'tripwires:\n  - action: "do x"\n    warning: "beware"\n' in content
    assert content.endswith('source_issues: [1]\n---\n\nBody\n')
    it2 = items_df(spark, [(2, 2, "tripwires", "s", "New", [], [], "B2")])
    r2 = nt.upsert_notes(snap.drop("change"), it2, AS_OF).first()
    assert (r2.change, r2.title, list(r2.source_issues)) == ("update", "New", [1, 2])
    assert "tripwires: []" in nt.render_notes(nt.upsert_notes(snap.drop("change"), it2, AS_OF).drop("change")).first().content


def test_upsert_last_item_wins(spark):
    its = items_df(spark, [(5, 2, "patterns", "s", "second", [], [], "b2"), (3, 1, "patterns", "s", "first", [], [], "b1")])
    r = nt.upsert_notes(notes_df(spark, []), its, AS_OF).first()
    assert (r.title, list(r.source_issues)) == ("second", [3, 5])


def _scanned(spark, rows):
    return nt.scan_notes(nt.render_notes(notes_df(spark, rows)))


def test_routing_index(spark):
    sc = _scanned(spark, [note("patterns", "b", [1], title=None, rw=()), note("tripwires", "a", [1]),
                          note("patterns", "a", [1]), note("other", "z", [1])])
    rows = [(r.file, r.title, r.read_when) for r in nt.routing_rows(sc).orderBy("rank", "slug").collect()]
    assert rows == [("@memory/patterns/a.md", "T", "when x"), ("@memory/patterns/b.md", "b", "—"),
                    ("@memory/tripwires/a.md", "T", "when x")]
    txt = nt.routing_index_text(sc).first().index_text
    assert txt.startswith("| File | Title | Read when |\n|------|-------|-----------|\n| @memory/patterns/a.md")
    repos = spark.createDataFrame([("r",), ("empty",)], "repo string")
    got = {r.repo: r.index_text for r in nt.routing_index_text(sc, repos=repos).collect()}
    assert got["empty"] == "_No learnings yet._\n" and got["r"] == txt
    dig = {r.repo: r.digest for r in nt.notes_digest(sc, repos=repos).collect()}
    assert dig["empty"] == "" and dig["r"].startswith("### [patterns/a]\n---\n")


def actions_df(spark, rows):
    return spark.createDataFrame(
        [("r", pos, a, c, s, None, tc, ts, tb) for pos, a, c, s, tc, ts, tb in rows],
        "repo string, pos long, action string, category string, slug string, reason string, "
        "target_category string, target_slug string, target_updated_body string")


def test_compact_merge_and_delete(spark):
    notes = notes_df(spark, [note("patterns", "a", [1]), note("patterns", "b", [2]), note("testing", "c", [3]),
                             note("testing", "d", [4]), note("testing", "e", [5])])
    acts = actions_df(spark, [
        (1, "merge_into", "patterns", "a", "testing", "c", "merged body"),   # a -> c with body
        (2, "merge_into", "patterns", "b", "testing", "c", None),            # b -> c ids only
        (3, "merge_into", "testing", "d", "testing", "missing", "x"),        # absent target
        (4, "merge_into", "testing", "e", None, None, None),                 # no target fields
        (5, "delete", "testing", "c", None, None, None),                     # target also deleted
        (6, "keep", "patterns", "zzz", None, None, None)])
    m = {r.slug: r for r in nt.compact_merge(notes, acts, AS_OF).collect()}
    assert set(m) == {"c"}
    assert list(m["c"].source_issues) == [1, 2, 3] and m["c"].n_sources == 2
    assert m["c"].content.endswith("---\n\nmerged body\n\n")  # body merge, then one ids-only merge
    assert f'last_updated: "{AS_OF}"' in m["c"].content and "source_issues: [1, 2, 3]" in m["c"].content
    drop = {(r.slug, r.removed_by) for r in nt.compact_delete(notes, acts, on_orphan="drop").collect()}
    assert drop == {("a", "merge_into"), ("b", "merge_into"), ("d", "merge_into"), ("e", "merge_into"),
                    ("c", "delete")}
    keep = {r.slug for r in nt.compact_delete(notes, acts, on_orphan="keep").collect()}
    assert keep == {"a", "b", "c"}
    assert {r.slug: r.reason for r in nt.orphan_merges(notes, acts).collect()} == {
        "d": "target missing", "e": "no target given"}
    counts = nt.action_counts(acts).first()
    assert (counts.n_keep, counts.n_delete, counts.n_merge) == (1, 1, 4)
    snap = nt.apply_compaction(notes, acts, AS_OF, on_orphan="keep")
    assert sorted(r.slug for r in snap.collect()) == ["d", "e"]


def test_compaction_keeps_the_merged_body(spark):
    notes = notes_df(spark, [note("patterns", "a", [1]), note("patterns", "b", [2])])
    acts = actions_df(spark, [(1, "merge_into", "patterns", "a", "patterns", "b", "merged text")])
    snap = nt.apply_compaction(nt.with_content(notes), acts, AS_OF)
    row = snap.first()
    assert (snap.count(), row.slug, row.body, list(row.source_issues)) == (1, "b", "merged text", [1, 2])
    assert "merged text" in nt.render_notes(snap).first().content
    items = spark.createDataFrame([("r", "patterns", "new", "T", ["w"], [], "b", 5, 1)],
                                  "repo string, category string, slug string, title string, read_when array<string>, "
                                  "tripwires array<struct<action:string,warning:string>>, body string, issue long, pos long")
    after = nt.upsert_notes(snap, items, AS_OF)
    assert "merged text" in {r.slug: r.content for r in nt.render_notes(after).collect()}["b"]


def test_compact_chain_uses_snapshot_ids(spark):
    notes = notes_df(spark, [note("patterns", "a", [1]), note("patterns", "b", [2]), note("patterns", "c", [3])])
    acts = actions_df(spark, [(1, "merge_into", "patterns", "a", "patterns", "b", None),
                              (2, "merge_into", "patterns", "b", "patterns", "c", None)])
    m = {r.slug: list(r.source_issues) for r in nt.compact_merge(notes, acts, AS_OF).collect()}
    assert m == {"b": [1, 2], "c": [2, 3]}


def test_compact_chains_followed_to_their_end(spark):
    names = "abcdefghuvwxy"
    notes = notes_df(spark, [note("patterns", s, [i]) for i, s in enumerate(names)])
    to = lambda pos, s, t, body=None: (pos, "merge_into", "patterns", s, "patterns", t, body)
    acts = actions_df(spark, [
        to(1, "a", "b", "for b"), to(2, "b", "c"), to(3, "c", "d", "for d"),  # a -> b -> c -> d
        to(4, "e", "d"), to(5, "f", "gone"), to(6, "g", "f"),                 # f keeps: its target is absent
        to(7, "u", "v"), to(8, "v", "w"), to(9, "w", "u"), to(10, "x", "u"),  # a circle, and one that leads to it
        to(11, "y", "y")])                                                    # into itself
    finals, cycles = nt.merge_targets(notes, acts)
    assert {r.slug: (r.final_slug, r.hops) for r in finals.collect()} == {
        "a": ("d", 3), "b": ("d", 2), "c": ("d", 1), "e": ("d", 1), "g": ("f", 1)}
    assert {r.slug: r.leads_to for r in cycles.collect()} == {"u": False, "v": False, "w": False, "x": True, "y": False}
    m = {r.slug: r for r in nt.compact_merge(notes, acts, AS_OF, chains="follow").collect()}
    assert set(m) == {"d", "f"}
    assert list(m["d"].source_issues) == [0, 1, 2, 3, 4] and m["d"].new_body == "for d" and m["d"].n_sources == 4
    left = nt.apply_compaction(notes, acts, AS_OF, chains="follow")
    assert sorted(r.slug for r in left.collect()) == ["d", "f", "h", "u", "v", "w", "x", "y"]


def test_long_merge_chain(spark):
    n = 37
    notes = notes_df(spark, [note("patterns", f"s{i}", [i]) for i in range(n)])
    acts = actions_df(spark, [(i, "merge_into", "patterns", f"s{i}", "patterns", f"s{i + 1}", None) for i in range(n - 1)])
    finals, cycles = nt.merge_targets(notes, acts)
    assert {(r.final_slug, r.hops) for r in finals.collect()} == {(f"s{n - 1}", h) for h in range(1, n)}
    assert cycles.count() == 0
    only = nt.compact_merge(notes, acts, AS_OF, chains="follow").first()
    assert (only.slug, list(only.source_issues)) == (f"s{n - 1}", list(range(n)))


def test_source_issues_as_rows(spark):
    notes = notes_df(spark, [note("patterns", "a", [1, 2])])
    items = items_df(spark, [(2, 1, "patterns", "a", "T", [], [], ""), (3, 2, "patterns", "a", "T", [], [], ""),
                             (3, 3, "testing", "b", "T", [], [], "")])
    rows = nt.upsert_source_issues(nt.source_issue_rows(notes), items)
    assert sorted((r.slug, r.issue) for r in rows.collect()) == [("a", 1), ("a", 2), ("a", 3), ("b", 3)]


def test_audit_coverage(spark):
    sc = _scanned(spark, [note("patterns", "a", [1]), note("patterns", "b", [1]), note("patterns", "c", [1])])
    acts = actions_df(spark, [(1, "keep", "patterns", "b", None, None, None),
                              (2, "delete", "patterns", "b", None, None, None),
                              (3, "keep", "patterns", "c", None, None, None),
                              (4, "keep", "patterns", "ghost", None, None, None)])
    got = {r.slug: r.issue for r in nt.audit_coverage(sc, acts).collect()}
    assert got == {"a": "no_action", "b": "repeated", "ghost": "unknown_file"}


def test_managed_block(spark):
    s, e = "<!-- loom:start -->", "<!-- loom:end -->"
    docs = spark.createDataFrame([(1, "r", f"top\n{s}\nold\n{e}\nmid\n{s}\nold2\n{e}\ntail"),
                                  (2, "r", "plain text  \n"), (3, "r", ""), (4, "q", "x $1 \\ y")],
                                 "id long, repo string, text string")
    notes = notes_df(spark, [note("patterns", "a", [1])])
    out = {r.id: (r.action, r.text) for r in nt.managed_block(docs, notes).collect()}
    block = f"{s}\n## Memory\n\n@memory/index.md\n\n{e}"
    assert out[1] == ("replaced", f"top\n{block}\ntail")
    assert out[2] == ("appended", f"plain text\n\n{block}")
    assert out[3] == ("created", block)
    assert out[4][1].endswith("_No learnings yet._\n\n" + e) and out[4][1].startswith("x $1 \\ y")


def test_content_drift(spark):
    exp = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "path string, content string")
    act = spark.createDataFrame([("a", "1"), ("c", "x"), ("z", "9")], "path string, content string")
    assert {r.path: r.status for r in nt.content_drift(exp, act).collect()} == {
        "a": "current", "b": "missing", "c": "stale"}


def test_read_note_folder(spark, tmp_path):
    base = tmp_path / "notes"
    for repo, cat, slug, text in [("r1", "patterns", "x", "---\ntitle: X\n---\n\nbody\n"),
                                  ("r1", "other", "y", "ignored"), ("r2", "testing", "z", "zz")]:
        d = base / repo / cat
        d.mkdir(parents=True, exist_ok=True)
        (d / f"{slug}.md").write_text(text)
    (base / "r1" / "patterns" / "skip.txt").write_text("not markdown")
    (base / "r1" / "patterns" / ".md").write_text("no name, no extension")
    files = nt.read_note_folder(spark, str(base))
    sc = nt.scan_notes(files)
    got = sorted((r.repo, r.category, r.slug, r.content) for r in sc.collect())
    assert got == [("r1", "patterns", "x", "---\ntitle: X\n---\n\nbody\n"), ("r2", "testing", "z", "zz")]
    cat = nt.note_catalog(sc).filter(F.col("slug") == "x").first()
    assert (cat.title, cat.body) == ("X", "body")
