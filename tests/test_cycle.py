"""End to end on sf0.001: plans -> context -> prompts -> replies -> notes
upsert -> snapshot -> index, and a second batch accumulates source issues."""

from pyspark.sql import functions as F

from tallyloom.operators import extract, issues, notes, prompts
from tallyloom.session import scratch_path
from tallyloom.sources import fixtures as fx
from tallyloom.sources import snapshots

SF = "/root/testdata/sf0.001"


def _replies(ctx, slug_expr):
    return ctx.select("repo", "issue", F.concat(F.lit('[{"category":"patterns","slug":"'), slug_expr,
                                        F.lit('","title":"t","read_when":["w"],"body":"b"}]')).alias("reply"))


def test_learn_cycle(spark):
    current = fx.notes(spark, SF).drop("content")
    ctx, no_pr = prompts.learn_context(issues.unlearned_plans(fx.issues(spark, SF)), fx.close_events(spark, SF),
                                       fx.pull_requests(spark, SF), fx.comments(spark, SF))
    segments = prompts.repo_segments(notes.scan_notes(notes.render_notes(current)), fx.hooks(spark, SF))
    n_ctx = ctx.count()
    told = prompts.learn_prompt(ctx, segments).groupBy("repo", "issue").agg(F.max("seg").alias("last"))
    assert n_ctx > 0 and told.filter("last = 4").count() == n_ctx
    assert no_pr.count() > 0  # plans without a merged PR are reported, not dropped silently

    # batch 1: every plan teaches the same shared note
    items, bad = extract.decode_replies(_replies(ctx, F.lit("shared")), key=["repo", "issue"])
    assert bad.count() == 0
    items = items.withColumn("pos", F.struct("issue", "item_pos"))
    snap1 = notes.upsert_notes(current, items, "2025-01-02").drop("change")
    root = scratch_path(spark, "cycle-notes")
    snapshots.write_snapshot(snap1, root, ["repo", "category"])

    # batch 2 reads the live snapshot and adds one more issue per repo
    live = snapshots.read_snapshot(spark, root)
    extra = (ctx.groupBy("repo").agg(F.max("issue").alias("issue"))
             .select("repo", (F.col("issue") + 100000).alias("issue"),
                     F.struct(F.col("issue"), F.lit(0).cast("bigint").alias("item_pos")).alias("pos"),
                     F.lit("patterns").alias("category"), F.lit("shared").alias("slug"), F.lit("t2").alias("title"),
                     F.array(F.lit("w2")).alias("read_when"),
                     F.array().cast("array<struct<action:string,warning:string>>").alias("tripwires"),
                     F.lit("b2").alias("body")))
    snap2 = notes.upsert_notes(live, extra, "2025-01-03")
    shared = {r.repo: (r.change, len(r.source_issues), r.title) for r in
              snap2.filter(F.col("slug") == "shared").collect()}
    per_repo = {r.repo: r.n for r in ctx.groupBy("repo").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert shared == {repo: ("update", n + 1, "t2") for repo, n in per_repo.items()}
    index = {r.repo: r.index_text for r in
             notes.routing_index_text(notes.scan_notes(notes.render_notes(snap2.drop("change")))).collect()}
    assert all("@memory/patterns/shared.md | t2 | w2" in index[r] for r in per_repo)
