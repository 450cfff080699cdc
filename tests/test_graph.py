"""Dependency graph: blocking, unblocked, completion, renderings, round trip."""

from pyspark.sql import functions as F

from tallyloom import schemas
from tallyloom.operators import extract as ex
from tallyloom.operators import graph


def nodes_df(spark, rows, objective=1):
    data = [("r", objective, i + 1, nid, f"d{nid}", st, plan, None, deps)
            for i, (nid, st, deps, plan) in enumerate(rows)]
    return spark.createDataFrame(data, schemas.NODES)


def n(nid, st="pending", deps=(), plan=None):
    return (nid, st, list(deps), plan)


def ids(df, col="node_id"):
    return sorted(r[col] for r in df.collect())


def test_blocked_by_rules(spark):
    df = nodes_df(spark, [n("a"), n("b", deps=["a"]), n("c", "done"), n("d", deps=["c"]),
                          n("e", deps=["zz"]), n("f", deps=["f"]), n("g", deps=["h"]), n("h", deps=["g"])])
    got = sorted((r.node_id, r.dep_id) for r in graph.blocked_by(df).collect())
    # pending dep blocks, done dep does not, unknown does not, self blocks, cycle blocks both ways
    assert got == [("b", "a"), ("f", "f"), ("g", "h"), ("h", "g")]
    assert ids(graph.dangling_dependencies(df)) == ["e"]


def test_blocked_by_first_node_with_repeated_id(spark):
    df = nodes_df(spark, [n("a", "done"), n("a"), n("b", deps=["a"])])
    assert graph.blocked_by(df).count() == 0  # the first "a" is done


def test_unblocked_nodes(spark):
    assert graph.unblocked_nodes(nodes_df(spark, [])).count() == 0
    df = nodes_df(spark, [n("a"), n("b", deps=["a"]), n("c", deps=["b"]), n("x", "in_progress")])
    assert ids(graph.unblocked_nodes(df)) == ["a"]  # chain of 3: only the first
    df = nodes_df(spark, [n("a", "done"), n("b", deps=["a"])])
    assert ids(graph.unblocked_nodes(df)) == ["b"]  # freed once the dependency is done


def test_all_nodes_done(spark):
    def done(rows):
        r = graph.all_nodes_done(nodes_df(spark, rows)).collect()
        return r[0].all_done if r else False
    assert done([]) is False
    assert done([n("a", "done"), n("b", "done")]) is True
    assert done([n("a", "done"), n("b")]) is False
    assert done([n("a", "done"), n("b", "in_progress")]) is False
    assert done([n("a", "done")]) is True
    objectives = spark.createDataFrame([("r", 1), ("r", 2)], "repo string, objective long")
    r = {x.objective: x.all_done for x in graph.all_nodes_done(nodes_df(spark, [n("a", "done")]), objectives).collect()}
    assert r == {1: True, 2: False}


def test_roadmap_table_and_close_comment(spark):
    df = nodes_df(spark, [n("1.1", "done", plan=42), n("1.2", deps=["1.1"]), n("1.3", deps=["1.2"])])
    t = graph.roadmap_table(df).first().table
    lines = t.split("\n")
    assert lines[0] == "| ID | Description | Status | Plan | PR | Blocked By |"
    assert lines[2] == "| 1.1 | d1.1 | done | #42 |  |  |"
    assert lines[4] == "| 1.3 | d1.3 | pending |  |  | 1.2 |"
    assert graph.close_comment(df).count() == 0
    c = graph.close_comment(nodes_df(spark, [n("a", "done"), n("b", "done")])).first().comment
    assert c == "All nodes completed — closing objective.\n\n- a da\n- b db"


def test_state_round_trip_and_rewrite(spark):
    df = nodes_df(spark, [n("1.1", "in_progress", plan=42), n("1.2", deps=["1.1"])])
    blob = graph.state_comment(df).first().blob
    assert blob.startswith("<!-- loom:nodes [") and blob.endswith("] -->")
    assert '"plan_issue":42' in blob and "pr_url" not in blob  # null fields omitted
    bodies = spark.createDataFrame([("r", 1, "## Goal\ng\n\n## Roadmap\n- 1.1: x\n\n## Notes\nkeep")],
                                   "repo string, objective long, body string")
    once = ex.rewrite_roadmap(bodies, df)
    twice = ex.rewrite_roadmap(once, df)
    body = twice.first().body
    assert body.count("<!-- loom:nodes ") == 1 and body.endswith("## Notes\nkeep")
    assert "- 1.1: x" not in body
    back, rej = ex.load_node_state(twice)
    assert rej.count() == 0
    got = [(r.node_id, r.status, r.plan_issue, list(r.depends_on)) for r in back.orderBy("pos").collect()]
    assert got == [("1.1", "in_progress", 42, []), ("1.2", "pending", None, ["1.1"])]
    appended = ex.rewrite_roadmap(bodies.withColumn("body", F.lit("just text  ")), df).first().body
    assert appended.startswith("just text\n\n## Roadmap\n| ID")


def test_decode_node_state_strict(spark):
    m = "<!-- loom:nodes "
    cases = {
        "ok": m + '[{"id":"a","description":"x","status":"done"}] -->',
        "wrong_type": m + '[{"id":"a","description":"x","status":"done","plan_issue":"n"}] -->',
        "truncated": m + '[{"id":"a","description":"x" -->',
        "trailing": m + '[{"id":"a","description":"x","status":"done"}] extra -->',
        "lone": m + '{"id":"a","description":"x","status":"done"} -->',
        "missing_id": m + '[{"description":"x","status":"done"}] -->',
        "bad_status": m + '[{"id":"a","description":"x","status":"started"}] -->',
        "number_id": m + '[{"id":1,"description":"x","status":"done"}] -->',
        "null_deps": m + '[{"id":"a","description":"x","status":"done","depends_on":null}] -->',
        "none": "no blob here",
    }
    df = spark.createDataFrame(list(cases.items()), "objective string, body string").withColumn("repo", F.lit("r"))
    nodes, rej = ex.load_node_state(df)
    assert [r.objective for r in nodes.collect()] == ["ok"]
    reasons = {r.objective: r.reason for r in rej.collect()}
    assert reasons["none"] == "no marker"
    assert set(reasons) == set(cases) - {"ok"}
    assert all(v.startswith("bad state") for k, v in reasons.items() if k != "none")


def test_extract_roadmaps_rejects(spark):
    df = spark.createDataFrame([("r", 1, "## Roadmap\n- 1.1: A\n- 1.2: B (depends: 1.1)\n"),
                                ("r", 2, "no roadmap"), ("r", 3, "## Roadmap\nprose only\n")],
                               "repo string, objective long, body string")
    nodes, rej = ex.extract_roadmaps(df)
    assert [(r.pos, r.node_id, list(r.depends_on)) for r in nodes.orderBy("pos").collect()] == [
        (1, "1.1", []), (2, "1.2", ["1.1"])]
    assert {r.objective: r.reason for r in rej.collect()} == {2: "no section", 3: "no nodes"}


def test_state_in_parts_round_trips(spark):
    rows = [("r", o, i, f"n{i}", f"d{i}", "pending", i, None, [f"n{i - 1}"] if i > 1 else [])
            for o, n in ((1, 7), (2, 2)) for i in range(1, n + 1)]
    df = spark.createDataFrame(rows, "repo string, objective long, pos long, node_id string, description string, "
                                     "status string, plan_issue long, pr_url string, depends_on array<string>")
    want = sorted((r[1], r[2], r[3], r[6], r[8]) for r in rows)

    def read(bodies):
        back, rej = ex.load_node_state(bodies)
        assert rej.count() == 0
        return sorted((r.objective, r.pos, r.node_id, r.plan_issue, list(r.depends_on)) for r in back.collect())

    blobs = graph.state_comment(df, part_rows=2).withColumnRenamed("blob", "body")
    assert read(blobs) == want
    one_text = blobs.groupBy("repo", "objective").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "body"))), lambda x: x["body"]), "\n").alias("body"))
    assert read(one_text) == want
    bodies = spark.createDataFrame([("r", 1, "## Goal\ng\n\n## Roadmap\n- 1.1: x\n\n## Notes\nkeep"), ("r", 2, "text")],
                                   "repo string, objective long, body string")
    once = ex.rewrite_roadmap(bodies, df, part_rows=2)
    assert sorted((r.objective, r.part) for r in once.collect()) == [(1, 0), (1, 1), (1, 2), (1, 3), (2, 0)]
    assert read(once) == want and read(ex.rewrite_roadmap(once, df, part_rows=3)) == want
    bad = blobs.withColumn("body", F.when((F.col("objective") == 1) & (F.col("part") == 2), F.lit("<!-- loom:nodes [1] -->"))
                           .otherwise(F.col("body")))
    back, rej = ex.load_node_state(bad)
    assert {r.objective for r in back.collect()} == {2} and [r.objective for r in rej.collect()] == [1]
