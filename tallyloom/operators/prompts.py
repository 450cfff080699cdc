"""Prompt segments for the outside language model, and the context they need.

The job stops at prompt rows and resumes at reply rows (``decode_replies``);
the model call sits between the two and is not part of this package. Every
prompt is built from one snapshot of the notes.

A prompt is a list of ordered segments. Texts of the issue and its change are
segments of their own rows; the notes and hooks of a repo, which every prompt of
the repo holds, are one ordered segment table per repo (``repo_segments``) with
all their text. A prompt refers to it by key and never copies it, at any size:
the sender writes, for a ``memory`` or ``hooks`` segment, the repo's rows of that
kind in (rank, name) order.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import text as T
from tallyloom.operators import issues as iss
from tallyloom.operators import notes as nt

#: Before the notes, and after notes and hooks.
LEARN_HEAD = (
    "Extract reusable learnings from a finished piece of work.\n\n"
    "## Issue: {issue_title}\n\n{issue_body}\n\n"
    "## Merged change: {pr_title}\n\n{pr_body}\n\n"
    "## Diff\n{diff}\n{conversation_section}\n"
    "## Existing notes\n")
LEARN_TAIL = (
    "\n---\n\n"
    "Reply with a JSON array of objects with keys category, slug, title, read_when, "
    "tripwires and body; return an empty array when nothing clears the bar.")

#: Before and after the objective's title and body.
NODE_HEAD = "Plan the work of one node.\n\n## Node {node_id}\n{description}\n\n## Part of: "
NODE_OBJECTIVE = "{objective_title}\n\n{objective_body}"
NODE_TAIL = "\n\nThe plan says what to do and why, how it is checked, what it leaves out and where it can go wrong."


def render_template(template: str, cols: dict[str, Column]) -> Column:
    """Fill ``{name}`` fields of a template string with columns."""
    parts = []
    for lit, field, _, _ in string.Formatter().parse(template):
        if lit:
            parts.append(F.lit(lit))
        if field is not None:
            parts.append(cols[field])
    return F.concat(*parts)


def repo_segments(scanned: DataFrame, hooks: DataFrame) -> DataFrame:
    """(repo, kind, rank, name, text): every note and every hook text of each repo."""
    memory = scanned.select("repo", F.lit("memory").alias("kind"), "rank", nt.file_name().alias("name"), nt.digest_piece().alias("text"))
    rules = nt.hook_texts(hooks).select("repo", F.lit("hooks").alias("kind"), F.lit(0).cast("bigint").alias("rank"),
                                        F.col("path").alias("name"), F.concat("text", F.lit("\n\n")).alias("text"))
    return memory.unionByName(rules)


def learn_context(plans: DataFrame, close_events: DataFrame, prs: DataFrame, comments: DataFrame,
                  prefix: str = T.DEFAULT_PREFIX) -> tuple[DataFrame, DataFrame]:
    """One row per closed plan with its own prompt inputs. A plan without a
    merged closing PR becomes a reject row. Keys are matched first; the texts
    of the PRs that matched come last. PR rows are joined by a shuffle: a table
    generated from a small one is estimated too small for a broadcast to be safe."""
    p = plans.select("repo", F.col("number").alias("issue"), F.col("title").alias("issue_title"),
                     F.coalesce("body", F.lit("")).alias("issue_body"))
    there = prs.select("repo", F.col("number").alias("pr_number"))
    keys = (p.select("repo", "issue").join(iss.linked_keys(close_events).drop("closed_at"), ["repo", "issue"])
            .join(there.hint("merge"), ["repo", "pr_number"]))
    rejects = p.select("repo", "issue").join(keys, ["repo", "issue"], "left_anti").withColumn(
        "reason", F.concat(F.lit("#"), F.col("issue").cast("string"), F.lit(" has no merged change")))
    texts = prs.select("repo", F.col("number").alias("pr_number"), F.col("title").alias("pr_title"),
                       F.coalesce("body", F.lit("")).alias("pr_body"), F.coalesce("diff", F.lit("")).alias("diff"))
    conv = iss.conversation_of(comments, prefix).select("repo", "issue", "conversation")
    ctx = (keys.join(p.hint("merge"), ["repo", "issue"]).join(conv.hint("merge"), ["repo", "issue"], "left")
           .join(texts.hint("merge"), ["repo", "pr_number"]))
    return ctx.select("repo", "issue", "issue_title", "issue_body", "pr_number", "pr_title", "pr_body", "diff",
                      F.coalesce("conversation", F.lit("")).alias("conversation")), rejects


def learn_prompt(ctx: DataFrame, segments: DataFrame, cap: int | None = None) -> DataFrame:
    """(repo, issue, seg, kind, text): the segments of each plan's prompt.

    Kind ``text`` holds its text; ``memory`` and ``hooks`` stand for the repo's
    rows of ``repo_segments`` (a repo without notes has a text that says so, one
    without hooks has no such segment). ``cap`` cuts diff and conversation, by
    default nothing is cut."""
    cut = (lambda c: c) if cap is None else (lambda c: T.truncate_text(c, cap))
    conv = cut(F.col("conversation"))
    conv_sec = F.when(conv == "", F.lit("")).otherwise(F.concat(F.lit("\n## Planning conversation\n"), conv, F.lit("\n")))
    cols = {c: F.col(c) for c in ("issue_title", "issue_body", "pr_title", "pr_body")}
    head = render_template(LEARN_HEAD, cols | {"diff": cut(F.col("diff")), "conversation_section": conv_sec})
    has = segments.groupBy("repo").agg(F.max(F.col("kind") == "memory").alias("_memory"),
                                       F.max(F.col("kind") == "hooks").alias("_hooks"))
    none = F.lit(None).cast("string")

    def seg(n, kind, text):
        return F.struct(F.lit(n).cast("bigint").alias("seg"), kind.alias("kind"), text.alias("text"))

    memory = F.coalesce("_memory", F.lit(False))
    parts = F.array(seg(1, F.lit("text"), head),
                    seg(2, F.when(memory, "memory").otherwise("text"), F.when(memory, none).otherwise(F.lit(nt.NONE_YET))),
                    seg(3, F.when(F.coalesce("_hooks", F.lit(False)), "hooks"), none),
                    seg(4, F.lit("text"), F.lit(LEARN_TAIL)))
    return (ctx.join(has, "repo", "left").select("repo", "issue", F.explode(parts).alias("p"))
            .select("repo", "issue", "p.*").filter(F.col("kind").isNotNull()))


def objective_segments(objective_bodies: DataFrame) -> DataFrame:
    """(repo, objective, kind, text): title and body of every objective, once."""
    return objective_bodies.select("repo", "objective", F.lit("objective").alias("kind"),
                                   F.concat("title", F.lit("\n\n"), F.coalesce("body", F.lit(""))).alias("text"))


def node_plan_prompt(unblocked: DataFrame) -> DataFrame:
    """(repo, objective, pos, node_id, seg, kind, text): the segments of the prompt of each unblocked node.

    Kind ``text`` holds its text; ``objective`` stands for the objective's row of
    ``objective_segments``. No prompt copies a body, so the output grows with the nodes alone."""
    head = render_template(NODE_HEAD, {k: F.col(k) for k in ("node_id", "description")})
    parts = [("text", head), ("objective", F.lit(None).cast("string")), ("text", F.lit(NODE_TAIL))]
    segs = F.array(*[F.struct(F.lit(i + 1).cast("bigint").alias("seg"), F.lit(kind).alias("kind"), text.alias("text"))
                     for i, (kind, text) in enumerate(parts)])
    return unblocked.select("repo", "objective", "pos", "node_id", F.inline(segs))


def node_plan_text(unblocked: DataFrame, objective_bodies: DataFrame) -> DataFrame:
    """(repo, objective, pos, node_id, prompt): the whole prompt of each unblocked node, with its
    objective's title and body. Bodies are joined by a shuffle: estimates of built texts are not to be trusted."""
    o = objective_bodies.select("repo", "objective", F.col("title").alias("objective_title"),
                                F.coalesce("body", F.lit("")).alias("objective_body"))
    j = unblocked.select("repo", "objective", "pos", "node_id", "description").join(o.hint("merge"), ["repo", "objective"])
    cols = {k: F.col(k) for k in ("objective_title", "objective_body", "node_id", "description")}
    return j.select("repo", "objective", "pos", "node_id",
                    render_template(NODE_HEAD + NODE_OBJECTIVE + NODE_TAIL, cols).alias("prompt"))
