"""Life-cycle updates and prompt rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyloom import schemas
from tallyloom.operators import issues as iss
from tallyloom.operators import lifecycle as lc
from tallyloom.operators import notes as nt
from tallyloom.operators import prompts as pr
from tallyloom.session import scratch_path
from tallyloom.sources import snapshots


def nodes_df(spark, rows, objective=1):
    data = [("r", objective, i + 1, nid, f"d{nid}", st, plan, None, list(deps))
            for i, (nid, st, deps, plan) in enumerate(rows)]
    return spark.createDataFrame(data, schemas.NODES)


def test_plan_guard_and_start(spark):
    n = nodes_df(spark, [("a", "pending", [], None), ("b", "in_progress", [], 7), ("c", "pending", [], None)])
    g = {r.node_id: (r.outcome, r.reason) for r in lc.plan_guard(n).collect()}
    assert g["a"] == ("accepted", None)
    assert g["b"] == ("rejected", "plan #7 holds node b")
    created = spark.createDataFrame([("r", 1, 1, "https://h/r/issues/55"), ("r", 1, 3, "https://h/r/issues/new")],
                                    "repo string, objective long, pos long, url string")
    started, rej = lc.start_nodes(n, created)
    assert [(r.node_id, r.status, r.plan_issue) for r in started.collect()] == [("a", "in_progress", 55)]
    assert [(r.pos, r.reason) for r in rej.collect()] == [(3, "no issue number in url")]
    row = lc.plan_issue_rows(started, F.lit("plan text")).first()
    assert (row.title, row.body) == ("[a] da", "Objective: #1 (node a)\n\nplan text")


def test_finish_nodes_and_close(spark):
    n = nodes_df(spark, [("a", "done", [], 1), ("b", "in_progress", [], 2), ("b", "pending", [], None)])
    landed = spark.createDataFrame([("r", 10, "Objective: #1 (node b)"), ("r", 11, "Objective: #1 (node zz)"),
                                    ("r", 12, "Objective: #9 (node a)"), ("r", 13, "no marker")],
                                   "repo string, number long, body string")
    fin = lc.finish_nodes(n, landed)
    got = {r.plan: (r.outcome, r.pos) for r in fin.collect()}
    assert got == {10: ("marked_done", 2), 11: ("node_not_found", None), 12: ("objective_not_found", None)}
    after = lc.apply_finished(n, fin)
    assert [r.status for r in after.orderBy("pos").collect()] == ["done", "done", "pending"]  # first "b" only
    issues = spark.createDataFrame(
        [("r", 1, "o", "", "OPEN", dt.datetime(2024, 1, 1), ["objective"], "u"),
         ("r", 2, "o", "", "CLOSED", dt.datetime(2024, 1, 1), ["objective"], "u")], schemas.ISSUES)
    all_done = nodes_df(spark, [("a", "done", [], 1)], objective=1).unionByName(
        nodes_df(spark, [("x", "done", [], 1)], objective=2))
    assert [r.objective for r in lc.close_objectives(all_done, issues).collect()] == [1]


def test_create_plans_attach_mark_learned(spark):
    drafts = spark.createDataFrame([(1, "t", "**Why** x **Scope** y"), (2, "t", "")],
                                   "doc_id long, title string, body string")
    got = {r.doc_id: r.n_missing for r in lc.create_plans(drafts).collect()}
    assert got == {1: 5, 2: 7}
    turns = spark.createDataFrame([("r", 5, 0, None), ("r", 5, 1, "we talked"), ("r", 5, 2, "more"), ("r", 6, 0, ""),
                                   ("q", 5, 0, "elsewhere")], "repo string, number long, seq long, conversation string")
    c = lc.attach_conversation(turns).orderBy("repo", "issue", "seq").collect()
    mark, more = "<!-- loom:conversation -->\n", "<!-- loom:conversation more -->\n"
    assert [(r.repo, r.issue, r.seq, r.body) for r in c] == [
        ("q", 5, 0, mark + "elsewhere"), ("r", 5, 0, mark + "we talked\n\nmore")]
    c = lc.attach_conversation(turns, comment_chars=6).filter("repo = 'r'").orderBy("seq").collect()
    assert [r.body for r in c] == [mark + "we tal", more + "ked\n\nm", more + "ore"]
    issues = spark.createDataFrame(
        [("r", 1, "t", "", "CLOSED", dt.datetime(2024, 1, 1), ["plan"], "u"),
         ("r", 2, "t", "", "CLOSED", dt.datetime(2024, 1, 1), ["plan", "learned"], "u"),
         ("r", 3, "t", "", "CLOSED", dt.datetime(2024, 1, 1), ["plan"], "u")], schemas.ISSUES)
    learned = spark.createDataFrame([("r", 1), ("r", 2)], "repo string, number long")
    got = {r.number: list(r.labels) for r in lc.mark_learned(issues, learned).collect()}
    assert got == {1: ["plan", "learned"], 2: ["plan", "learned"]}
    # two repos share numbers: only the learned repo's issue is labelled, and the snapshot keeps every issue
    both = issues.unionByName(issues.withColumn("repo", F.lit("q")))
    after = {(r.repo, r.number): list(r.labels) for r in lc.apply_learned(both, learned).collect()}
    assert len(after) == 6 and after["q", 1] == ["plan"] and after["r", 1] == ["plan", "learned"]
    with pytest.raises(ValueError):
        lc.mark_learned(both, learned.drop("repo"))


def test_batch_summary_and_issue_list(spark):
    out = spark.createDataFrame([("r", 3, "learned"), ("r", 1, "learned"), ("r", 2, "failed"), ("q", 9, "learned")],
                                "repo string, number long, outcome string")
    s = {(r.repo, r.outcome): r.n for r in lc.batch_summary(out).collect()}
    assert s == {("r", "learned"): 2, ("r", "failed"): 1, ("q", "learned"): 1}
    learned = out.filter("outcome = 'learned'")
    t = {r.repo: r.issues for r in lc.issue_list_text(learned).collect()}
    assert t == {"r": "#1, #3", "q": "#9"}


def _prompts(spark, notes=(), hooks=(), conversation="", diff="d", **how):
    ctx = spark.createDataFrame(
        [("r", 1, "Issue", "body", 10, "PR", "pr body", diff, conversation)],
        "repo string, issue long, issue_title string, issue_body string, pr_number long, pr_title string, "
        "pr_body string, diff string, conversation string")
    rows = spark.createDataFrame([("r", "patterns", s, "T", ["w"], [], dt.date(2024, 1, 1), [1], b) for s, b in notes],
                                 schemas.NOTES)
    rules = spark.createDataFrame(list(hooks), "repo string, path string, text string")
    segments = pr.repo_segments(nt.scan_notes(nt.render_notes(rows)), rules)
    return pr.learn_prompt(ctx, segments, **how).orderBy("seg").collect(), segments


def test_learn_prompt_segments(spark):
    p, _ = _prompts(spark)
    assert [(r.seg, r.kind) for r in p] == [(1, "text"), (2, "text"), (4, "text")]
    assert "## Issue: Issue\n\nbody\n\n## Merged change: PR\n\npr body\n\n## Diff\nd\n" in p[0].text
    assert p[1].text == "_none yet_" and "Planning conversation" not in p[0].text
    p, _ = _prompts(spark, conversation="c" * 9000, diff="x" * 9000)  # nothing is cut by default
    assert "\n## Planning conversation\n" + "c" * 9000 + "\n" in p[0].text and "x" * 9000 in p[0].text
    p, _ = _prompts(spark, conversation="c" * 9000, diff="x" * 9000, cap=8000)
    assert "x" * 8001 not in p[0].text and "c" * 8001 not in p[0].text


def test_prompts_refer_to_all_notes_at_any_size(spark):
    notes = [(f"s{i}", "y" * 60_000 + f" body {i}") for i in range(5)]
    p, segments = _prompts(spark, notes, [("r", "b.md", "H"), ("r", "README.md", "no")])
    assert [(r.kind, r.text is None) for r in p] == [("text", False), ("memory", True), ("hooks", True), ("text", False)]
    rows = segments.orderBy("kind", "rank", "name").collect()
    assert [(r.kind, r.name) for r in rows] == [("hooks", "b.md")] + [("memory", f"s{i}.md") for i in range(5)]
    assert all(f"body {i}" in r.text for i, r in enumerate(rows[1:]))


def test_node_plan_prompt(spark):
    n = nodes_df(spark, [("a", "pending", [], None), ("b", "pending", [], None)])
    bodies = spark.createDataFrame([("r", 1, "Objective 1", "goal text")], "repo string, objective long, title string, body string")
    shared = pr.objective_segments(bodies).collect()
    assert [(r.kind, r.text) for r in shared] == [("objective", "Objective 1\n\ngoal text")]
    p = pr.node_plan_prompt(n).filter("node_id = 'a'").orderBy("seg").collect()
    assert [(r.seg, r.kind) for r in p] == [(1, "text"), (2, "objective"), (3, "text")] and p[1].text is None
    whole = "".join(r.text or shared[0].text for r in p)
    assert "## Node a\nda\n\n## Part of: Objective 1\n\ngoal text\n" in whole


def test_node_plan_text_holds_the_whole_objective(spark):
    n = nodes_df(spark, [("a", "pending", [], None), ("b", "pending", [], None)])
    bodies = spark.createDataFrame([("r", 1, "Objective 1", "goal text\n" * 5000)],
                                   "repo string, objective long, title string, body string")
    p = {r.node_id: r.prompt for r in pr.node_plan_text(n, bodies).collect()}
    segments = pr.node_plan_prompt(n).orderBy("node_id", "seg").collect()
    objective = pr.objective_segments(bodies).first().text
    assert p == {k: "".join(r.text or objective for r in segments if r.node_id == k) for k in ("a", "b")}


def talk(rows):
    return [("r", 1, k, body) for k, body in enumerate(rows)]


def test_conversations_read_all_their_parts(spark):
    mark, more = "<!-- loom:conversation -->", "<!-- loom:conversation more -->"
    cases = [
        (["hi", f"intro {mark}\nfirst ", f"{more}\nsecond", "other", f"{more}\nthird\n"], "intro \nfirst secondthird"),
        ([f"{mark}\none", f"{mark}\ntwo", f"{more}\nnot ours"], "one"),
        ([f"{more}\nno head before", f"{mark}\none", f"{more}\n quoting {mark} here"], "one quoting " + mark + " here"),
        (["nothing"], None)]
    for rows, want in cases:
        df = spark.createDataFrame(talk(rows), "repo string, issue long, seq long, body string")
        got = [r.conversation for r in iss.conversation_of(df).collect()]
        assert got == ([] if want is None else [want])
    turns = spark.createDataFrame([("r", 1, k, f"turn {k} " + "é" * k + "\n") for k in range(40)],
                                  "repo string, number long, seq long, conversation string")
    told = lc.attach_conversation(turns, comment_chars=17)
    assert told.count() > 10
    want = "\n\n".join(f"turn {k} " + "é" * k + "\n" for k in range(40)).strip()
    assert iss.conversation_of(told).first().conversation == want


def test_a_batch_is_published_before_its_failures_raise(spark):
    rows = spark.createDataFrame([("r", 1, "learned"), ("r", 2, "failed"), ("q", 2, "failed"), ("q", 3, "nothing_found")],
                                 "repo string, number long, outcome string")
    root = scratch_path(spark, "batch-test")
    with pytest.raises(lc.BatchFailed, match=r"2 issue\(s\) failed") as e:
        lc.publish_outcomes(rows, root)
    assert e.value.counts == {"learned": 1, "nothing_found": 1, "failed": 2}
    assert snapshots.read_snapshot(spark, root, e.value.version).count() == 4
    assert lc.publish_outcomes(rows.filter("outcome <> 'failed'"), root)[1]["failed"] == 0
    assert lc.publish_outcomes(rows.limit(0), root)[1] == {"learned": 0, "nothing_found": 0, "failed": 0}


def test_landing_leaves_failed_nodes(spark):
    n = nodes_df(spark, [("a", "in_progress", [], 1), ("b", "in_progress", [], 2), ("c", "in_progress", [], 3),
                         ("d", "in_progress", [], 4), ("e", "done", [], 5), ("f", "pending", [], None)])
    told = spark.createDataFrame([("r", 1, "learned"), ("r", 2, "nothing_found"), ("r", 3, "failed"), ("q", 4, "learned")],
                                 "repo string, number long, outcome string")
    assert {r.node_id: (r.outcome, r.status) for r in lc.land_nodes(n, told).collect()} == {
        "a": ("learned", "done"), "b": ("nothing_found", "done"), "c": ("failed", "in_progress"), "d": ("not_run", "in_progress")}
