"""Issue tables: close-event order, top-k caps, references, strict replies."""

import datetime as dt

from tallyloom import schemas
from tallyloom.operators import extract as ex
from tallyloom.operators import issues as iss

T0 = dt.datetime(2024, 1, 1)


def events(spark, rows):
    return spark.createDataFrame(
        [("r", issue, T0 + dt.timedelta(days=day), seq, ct, num, num if ct == "PullRequest" else None, st, 0)
         for issue, day, seq, ct, num, st in rows],
        "repo string, issue long, closed_at timestamp_ntz, seq int, closer_type string, closer_id long, "
        "pr_number long, pr_state string, actor long")


def prs(spark):
    return spark.createDataFrame([("r", 10, "feat-1", "Closes #1", "PR ten", "diff", "OPEN")], schemas.PULL_REQUESTS)


def test_linked_pr_last_event_then_filter(spark):
    ev = events(spark, [(1, 1, 1, "PullRequest", 10, "MERGED"),   # closed by merged PR
                        (1, 5, 1, "User", 99, None),              # reopened, then closed by hand
                        (2, 1, 1, "PullRequest", 10, "MERGED")])
    got = [(r.issue, r.pr_number) for r in iss.linked_pr(ev, prs(spark)).collect()]
    assert got == [(2, 10)]
    last = {r.issue: r.closer_type for r in iss.latest_close_event(ev).collect()}
    assert last == {1: "User", 2: "PullRequest"}


def test_pr_for_branch_takes_open_ones(spark):
    p = spark.createDataFrame([("r", 1, "b", "x", "first", "", "OPEN"), ("r", 2, "b", "x", "second", "", "MERGED"),
                               ("r", 3, "c", "x", "third", "", "CLOSED")], schemas.PULL_REQUESTS)
    assert [(r.head_ref, r.number) for r in iss.pr_for_branch(p).collect()] == [("b", 1)]


def issues_df(spark, rows):
    return spark.createDataFrame(
        [("r", n, f"t{n}", body, state, T0 + dt.timedelta(days=day), labels, f"https://h/r/issues/{n}")
         for n, body, state, day, labels in rows], schemas.ISSUES)


def test_topk_and_unlearned(spark):
    df = issues_df(spark, [(n, None, "OPEN", n % 3, ["plan"]) for n in range(1, 8)])
    top = [r.number for r in iss.open_plans_topk(df, "plan", "OPEN", 3).orderBy("rank").collect()]
    assert top == [5, 2, 7]  # created_at desc, then number desc
    closed = issues_df(spark, [(1, None, "CLOSED", 3, ["plan", "learned"]), (2, None, "CLOSED", 2, ["plan"]),
                               (3, None, "CLOSED", 1, ["plan"]), (4, None, "OPEN", 1, ["plan"])])
    assert sorted(r.number for r in iss.unlearned_plans(closed).collect()) == [2, 3]
    # the source tool's cap applies before the label filter and can hide work
    assert [r.number for r in iss.unlearned_plans(closed, limit=1).collect()] == []
    rej = {r.number: r.outcome for r in iss.closed_only(closed).collect()}
    assert rej[4] == "rejected" and rej[2] == "accepted"


def test_resolve_ref_and_plan_links(spark):
    df = issues_df(spark, [(1, "Objective: #3 (node 1.1)", "OPEN", 0, ["plan"]),
                           (2, "Objective: #99 (node 1.2)", "CLOSED", 0, ["plan"]),
                           (3, None, "OPEN", 0, ["objective"])])
    p = spark.createDataFrame([("r", 10, "main", "fixes #1", "t", "", "OPEN"), ("r", 11, "feat-2-x", "none", "t", "", "OPEN"),
                               ("r", 12, "main", "none", "t", "", "OPEN")], schemas.PULL_REQUESTS)
    got = {r.pr_number: (r.ref_issue, r.ref_source, r.outcome) for r in iss.resolve_ref(p, df).collect()}
    assert got == {10: (1, "body", "open_issue"), 11: (2, "branch", "fallback_open_plans"),
                   12: (None, None, "fallback_open_plans")}
    links = {r.child: (r.parent, r.node_id, r.status) for r in iss.plan_links(df).collect()}
    assert links == {1: (3, "1.1", "linked"), 2: (99, "1.2", "missing_parent")}


def test_decode_replies_strict(spark):
    good = '[{"category":"patterns","slug":"s","title":"t","read_when":["w"],"body":"b"}]'
    cases = [(1, good), (2, "```json\n" + good + "\n```"), (3, "Sure: " + good + " done"),
             (4, good[:-1]), (5, good + " trailing ]"),
             (6, '{"category":"patterns","slug":"s","title":"t","read_when":["w"],"body":"b"}'),
             (7, '[{"category":"patterns","slug":"s","read_when":["w"],"body":"b"}]'), (8, "nothing"),
             (9, good.replace('"body":"b"}', '"body":"b"}, {"slug": 1}')),
             (10, good.replace('"slug":"s"', '"slug":5')),
             (11, good.replace('"body":"b"}', '"body":"b","tripwires":[{"action":"a"}]}')),
             (12, good.replace('"body":"b"}', '"body":"b","tripwires":null}')),
             (13, good.replace('"body":"b"}', '"body":"b","extra":1,"tripwires":[{"action":"a","warning":"w"}]}'))]
    rows, rej = ex.decode_replies(spark.createDataFrame(cases, "id long, reply string"))
    assert sorted(r.id for r in rows.collect()) == [1, 2, 3, 13]
    reasons = {r.id: r.reason for r in rej.collect()}
    assert reasons[8] == "no json array" and reasons[7] == "missing or invalid field"
    assert reasons[10] == "wrong json type"  # a number where text is required
    assert set(reasons) == {4, 5, 6, 7, 8, 9, 10, 11, 12}
    acts, arej = ex.decode_replies(spark.createDataFrame(
        [(1, '[{"action":"keep","category":"c","slug":"s"}]'), (2, '[{"action":"keep"}]')],
        "id long, reply string"), kind="actions")
    assert [r.id for r in acts.collect()] == [1] and [r.id for r in arej.collect()] == [2]
