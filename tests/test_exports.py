"""Code-host JSON exports flattened into tables, then used by the operators."""

import json

from tallyloom.operators import issues as iss
from tallyloom.sources import exports as ex


def _write(path, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(json.dumps(r) for r in rows) + "\n")


def test_exports_round_trip(spark, tmp_path):
    _write(tmp_path / "issues" / "acme" / "part.json", [
        {"number": 1, "title": "Plan", "body": None, "state": "CLOSED", "createdAt": "2024-01-05T10:00:00Z",
         "labels": [{"name": "plan"}], "url": "https://h/acme/issues/1"},
        {"repo": "other", "number": 2, "title": "Obj", "body": "x", "state": "OPEN",
         "createdAt": "2024-01-06T00:00:00Z", "labels": [], "url": "u"}])
    _write(tmp_path / "prs" / "acme" / "part.json", [
        {"number": 10, "title": "PR", "body": "Closes #1", "state": "MERGED", "headRefName": "feat-1"}])
    _write(tmp_path / "timeline" / "acme" / "part.json", [
        {"number": 1, "timelineItems": {"nodes": [
            {"createdAt": "2024-01-07T00:00:00Z", "closer": {"__typename": "PullRequest", "number": 10,
                                                           "state": "MERGED", "title": "PR"}},
            {"createdAt": "2024-01-09T00:00:00Z", "closer": None}]}}])
    _write(tmp_path / "comments" / "acme" / "part.json", [
        {"number": 1, "comments": [{"body": "hi"}, {"body": "<!-- loom:conversation -->\nplan talk"}]}])
    issues = ex.read_issue_export(spark, str(tmp_path / "issues"))
    got = sorted((r.repo, r.number, list(r.labels), str(r.created_at)) for r in issues.collect())
    assert got == [("acme", 1, ["plan"], "2024-01-05 10:00:00"), ("other", 2, [], "2024-01-06 00:00:00")]
    ev = ex.read_close_event_export(spark, str(tmp_path / "timeline"))
    assert sorted((r.seq, r.closer_type, r.pr_number) for r in ev.collect()) == [(1, "PullRequest", 10), (2, "User", None)]
    prs = ex.read_pr_export(spark, str(tmp_path / "prs"))
    assert iss.linked_pr(ev, prs).count() == 0  # last event was a manual close
    conv = iss.conversation_of(ex.read_comment_export(spark, str(tmp_path / "comments"))).first()
    assert (conv.repo, conv.issue, conv.seq, conv.conversation) == ("acme", 1, 1, "plan talk")


def test_bad_lines_and_times(spark, tmp_path):
    p = tmp_path / "issues" / "acme"
    p.mkdir(parents=True)
    (p / "part.json").write_text('{"number": 1, "createdAt": "2024-01-05T10:00:00.123Z", "state": "OPEN"}\n'
                                 '{"number": 2, "createdAt": "yesterday", "state": "OPEN"}\n{"number": 3, broken\n\n')
    got = {r.number: str(r.created_at) for r in ex.read_issue_export(spark, str(tmp_path / "issues")).collect()}
    assert got == {1: "2024-01-05 10:00:00.123000", 2: "None"}
    bad = ex.read_export_rejects(spark, str(tmp_path / "issues"), ex.ISSUE_EXPORT).collect()
    assert [(r.repo, r.line) for r in bad] == [("acme", '{"number": 3, broken')]


def test_close_events_schema_serves_the_operator(spark):
    from tallyloom import schemas
    assert iss.latest_close_event(spark.createDataFrame([], schemas.CLOSE_EVENTS)).count() == 0


def test_exports_are_kept_compressed(spark):
    """A host's export repeats itself from line to line: it is stored compressed, and read back whole."""
    import os

    from pyspark.sql import functions as F

    from tallyloom.plans import catalog
    from tallyloom.sources import exports

    diff = F.repeat(F.concat(F.lit("+line "), F.col("id").cast("string"), F.lit("\n")), 500)
    prs = spark.range(200).select(F.lit("r").alias("repo"), F.struct(
        F.col("id").alias("number"), F.lit("t").alias("title"), F.lit(None).cast("string").alias("body"),
        F.lit("OPEN").alias("state"), F.lit("main").alias("headRefName"), diff.alias("diff")).alias("line"))
    path = catalog._export(prs, "prs")
    stored = sum(os.path.getsize(os.path.join(path, f)) for f in os.listdir(path) if f.startswith("part-"))
    back = exports.read_pr_export(spark, path)
    texts = back.agg(F.sum(F.length("diff"))).first()[0]
    assert stored * 10 < texts
    assert back.select("number", "diff").exceptAll(prs.select("line.number", "line.diff")).count() == 0 and back.count() == 200
