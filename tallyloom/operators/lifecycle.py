"""Plan and objective life cycle as table-in, table-out updates.

The source tool mutates one objective body or one issue per call; here every
step takes the current tables plus a batch of requests and returns the rows to
write (new issues, comments, changed nodes) together with reject rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tallyloom.functions import text as T
from tallyloom.functions.ordering import concat_by_ordinal, ordered_text_parts, ordinal_by_numeric
from tallyloom.operators import extract as ex
from tallyloom.operators import graph
from tallyloom.operators.issues import LEARNED_LABEL
from tallyloom.session import materialize
from tallyloom.sources import snapshots

NODE_KEY = ["repo", "objective", "pos"]


def plan_guard(requests: DataFrame) -> DataFrame:
    """A node that already has a plan issue cannot get another; the others go
    on (per-node error, not a batch failure)."""
    has = F.col("plan_issue").isNotNull()
    return requests.select(
        *NODE_KEY, "node_id", F.when(has, "rejected").otherwise("accepted").alias("outcome"),
        F.when(has, F.concat(F.lit("plan #"), F.col("plan_issue").cast("string"), F.lit(" holds node "),
                             F.col("node_id")))
        .alias("reason"))


def plan_issue_rows(nodes: DataFrame, plan_body=None) -> DataFrame:
    """New plan issue per node: title ``[id] description``, body starting with
    the objective marker line."""
    marker = F.concat(F.lit("Objective: #"), F.col("objective").cast("string"), F.lit(" (node "),
                      F.col("node_id"), F.lit(")"))
    body = F.concat(marker, F.lit("\n\n"), plan_body if plan_body is not None else F.lit(""))
    return nodes.select(*NODE_KEY, "node_id", F.concat(F.lit("["), F.col("node_id"), F.lit("] "),
                                                      F.col("description")).alias("title"), body.alias("body"))


def start_nodes(nodes: DataFrame, created: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Created plan issues (``NODE_KEY`` + ``url``) -> nodes in progress with
    their plan number. A URL without a number is rejected."""
    c = created.select(*NODE_KEY, "url", T.id_from_url(F.col("url")).alias("_num"))
    rejects = c.filter(F.col("_num").isNull()).select(*NODE_KEY, F.lit("no issue number in url").alias("reason"))
    ok = c.filter(F.col("_num").isNotNull()).select(*NODE_KEY, "_num")
    started = (nodes.join(ok, NODE_KEY)
               .withColumn("status", F.lit("in_progress"))
               .withColumn("plan_issue", F.col("_num")).drop("_num"))
    return started, rejects


def finish_nodes(nodes: DataFrame, landed: DataFrame) -> DataFrame:
    """Landed plan bodies -> ``Objective: #N (node ID)`` -> the *first* node with
    that id becomes done; unknown objectives or nodes give warning rows."""
    ref = T.objective_ref(F.col("body"))
    refs = landed.select("repo", ref["objective"].alias("objective"), ref["node_id"].alias("node_id"),
                         F.col("number").alias("plan")).filter(F.col("objective").isNotNull())
    first = graph.first_node_per_id(nodes).select("repo", "objective", "node_id", "pos")
    objectives = nodes.select("repo", "objective").distinct().withColumn("_obj", F.lit(True))
    j = refs.join(first, ["repo", "objective", "node_id"], "left").join(objectives, ["repo", "objective"], "left")
    outcome = (F.when(F.col("pos").isNotNull(), "marked_done")
               .when(F.col("_obj").isNull(), "objective_not_found").otherwise("node_not_found"))
    return j.select("repo", "objective", "node_id", "plan", "pos", outcome.alias("outcome"))


def apply_started(nodes: DataFrame, created: DataFrame) -> DataFrame:
    """The new node snapshot: every node, the started ones in progress with their plan number."""
    started, _ = start_nodes(nodes, created)
    now = started.select(*NODE_KEY, F.col("plan_issue").alias("_plan"))
    j = nodes.join(now, NODE_KEY, "left")
    on = F.col("_plan").isNotNull()
    new = {"status": F.when(on, "in_progress").otherwise(F.col("status")),
           "plan_issue": F.coalesce("_plan", "plan_issue")}
    return j.select(*[new[c].alias(c) if c in new else F.col(c) for c in nodes.columns])


def apply_finished(nodes: DataFrame, finished: DataFrame) -> DataFrame:
    """The new node snapshot: every node, the finished ones done."""
    done = finished.filter(F.col("outcome") == "marked_done").select(*NODE_KEY).distinct() \
        .withColumn("_done", F.lit(True))
    j = nodes.join(done, NODE_KEY, "left")
    return j.withColumn("status", F.when(F.col("_done"), "done").otherwise(F.col("status"))).drop("_done")


def close_objectives(nodes: DataFrame, objective_issues: DataFrame) -> DataFrame:
    """Objectives whose nodes are all done and whose issue is not yet CLOSED
    (closing again is harmless, so repeating the job is safe)."""
    done = graph.all_nodes_done(nodes).filter("all_done").select("repo", "objective", "n_nodes")
    open_obj = objective_issues.filter(F.col("state") != "CLOSED").select(
        "repo", F.col("number").alias("objective"))
    return done.join(open_obj, ["repo", "objective"])


def create_objectives(drafts: DataFrame, prefix: str = T.DEFAULT_PREFIX) -> tuple[DataFrame, DataFrame]:
    """Drafts with a ``## Roadmap`` -> objective issue rows whose body carries
    the rendered table and node state; no roadmap / no nodes -> rejects."""
    nodes, rejects = ex.extract_roadmaps(drafts)
    # parsed nodes feed the table, the blob and the blocking join: parse once
    nodes = materialize(nodes, "roadmap-nodes")
    created = ex.rewrite_roadmap(drafts.join(nodes.select("repo", "objective").distinct(),
                                             ["repo", "objective"], "left_semi"), nodes, prefix)
    return created, rejects


def create_plans(drafts: DataFrame) -> DataFrame:
    """Plan drafts -> issue rows; missing sections only warn (kept as a column)."""
    miss = T.missing_sections(F.col("body"))
    return drafts.withColumn("missing", miss).withColumn("n_missing", F.size("missing").cast("bigint"))


#: Characters of one comment, below what code hosts take.
COMMENT_CHARS = 60_000


def attach_conversation(turns: DataFrame, prefix: str = T.DEFAULT_PREFIX, sep: str = "\n\n",
                        comment_chars: int = COMMENT_CHARS) -> DataFrame:
    """Comment rows (repo, issue, seq, body) that carry each issue's whole planning conversation:
    the texts of its turns, in turn order (``seq``), joined by ``sep``; empty ones are left out.

    A conversation longer than a comment is cut into several. The first stands behind the
    sentinel, the others behind a mark of their own; ``conversation_of`` reads them as one."""
    m = T.markers(prefix)
    told = turns.filter(F.col("conversation").isNotNull() & (F.col("conversation") != ""))
    parts = ordered_text_parts(told, ["repo", "number"], ["seq"], "conversation", sep, comment_chars, "text")
    mark = F.when(F.col("part") == 0, m["conversation"]).otherwise(m["conversation_more"])
    return parts.select("repo", F.col("number").alias("issue"), F.col("part").alias("seq"),
                        F.concat(mark, F.lit("\n"), "text").alias("body"))


def mark_learned(issues: DataFrame, learned: DataFrame, label: str = LEARNED_LABEL) -> DataFrame:
    """Add the learned label to issues that produced at least one item (an
    issue with zero items stays unlabelled and comes back next run)."""
    _needs_repo(learned)
    j = issues.join(learned.select("repo", "number").distinct(), ["repo", "number"], "left_semi")
    return j.withColumn("labels", F.array_union("labels", F.array(F.lit(label))))


def apply_learned(issues: DataFrame, learned: DataFrame, label: str = LEARNED_LABEL) -> DataFrame:
    """The new issue snapshot: every issue, the learned ones labelled."""
    _needs_repo(learned)
    mark = learned.select("repo", "number").distinct().withColumn("_learned", F.lit(True))
    j = issues.join(mark, ["repo", "number"], "left")
    labels = F.when(F.col("_learned"), F.array_union("labels", F.array(F.lit(label)))).otherwise(F.col("labels"))
    return j.select(*[labels.alias(c) if c == "labels" else F.col(c) for c in issues.columns])


def _needs_repo(df: DataFrame) -> None:
    if "repo" not in df.columns:
        raise ValueError("issue numbers belong to a repo: the rows need a repo column")


def batch_summary(outcomes: DataFrame) -> DataFrame:
    """learned / nothing found / failed per repo; failures never stop a batch."""
    return outcomes.groupBy("repo", "outcome").agg(F.count(F.lit(1)).alias("n"))


class BatchFailed(RuntimeError):
    """A batch was published, and some of its issues failed."""

    def __init__(self, version: int, counts: dict[str, int]):
        super().__init__(f"{counts['failed']} issue(s) failed")
        self.version, self.counts = version, counts


def publish_outcomes(outcomes: DataFrame, root: str, raise_on_failure: bool = True) -> tuple[int, dict[str, int]]:
    """Write a batch's outcomes (repo, number, outcome) as the next version under root; returns
    the version and the counts of the whole batch (learned, nothing_found, failed).

    The counts are observed while the rows are written, so there is no second pass. Failures
    never stop a batch: they raise ``BatchFailed`` after it is published."""
    seen = Observation()
    kinds = ("learned", "nothing_found", "failed")
    watched = outcomes.observe(seen, *[F.count_if(F.col("outcome") == k).alias(k) for k in kinds])
    version = snapshots.write_snapshot(watched, root)
    counts = {k: int(seen.get[k] or 0) for k in kinds}
    if counts["failed"] and raise_on_failure:
        raise BatchFailed(version, counts)
    return version, counts


def land_nodes(nodes: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Landable nodes with what became of their plan: a learned plan and one with nothing to
    learn finish their node, a failed one (or one without outcome) leaves it as it is."""
    told = outcomes.select("repo", F.col("number").alias("plan_issue"), "outcome")
    j = graph.landable_nodes(nodes).join(told, ["repo", "plan_issue"], "left")
    done = F.col("outcome").isin("learned", "nothing_found")
    return j.select(*NODE_KEY, "node_id", "plan_issue", F.coalesce("outcome", F.lit("not_run")).alias("outcome"),
                    F.when(done, "done").otherwise(F.col("status")).alias("status"))


def issue_list_text(df: DataFrame, part_rows: int = 5_000) -> DataFrame:
    """``#1, #2`` per repo in number order (parts of at most ``part_rows``)."""
    ranked = ordinal_by_numeric(df, ["repo"], "number", "_ord")  # a unique number in its repo
    return concat_by_ordinal(ranked, ["repo"], "_ord", F.concat(F.lit("#"), F.col("number").cast("string")),
                             ", ", part_rows, "issues")
