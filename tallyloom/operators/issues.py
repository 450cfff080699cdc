"""Issue, pull-request, close-event and comment operators.

The source tool fetches these per issue through a code-host client; here each
lookup is one batch join or aggregate over exported tables for all repos.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions import text as T
from tallyloom.session import materialize

# ---- fixed values (per-call caps of the source tool's list calls) ----------
OPEN_LIST_CAP = 50
CLOSED_LIST_CAP = 100
# ---------------------------------------------------------------------------

PLAN_LABEL, OBJECTIVE_LABEL, LEARNED_LABEL = "plan", "objective", "learned"


def scan_issues(issues: DataFrame) -> DataFrame:
    """Typed issue rows; a missing body reads as empty text."""
    return issues.withColumn("body", F.coalesce("body", F.lit("")))


def open_plans_topk(issues: DataFrame, label: str = PLAN_LABEL, state: str = "OPEN",
                    k: int | None = None) -> DataFrame:
    """Issues in ``state`` carrying ``label``; all, or at most ``k`` per repo, newest
    first (created_at desc, number desc). ``row_number <= k`` plans as a
    partial + final WindowGroupLimit, so a hot repo sends at most k rows per
    map task through the shuffle."""
    f = issues.filter((F.col("state") == state) & F.array_contains("labels", label))
    if k is None:
        return f.withColumn("rank", F.lit(None).cast("bigint"))
    w = Window.partitionBy("repo").orderBy(F.col("created_at").desc(), F.col("number").desc())
    return (f.withColumn("rank", F.row_number().over(w).cast("bigint"))
            .filter(F.col("rank") <= k))


def unlearned_plans(issues: DataFrame, plan_label: str = PLAN_LABEL,
                    learned_label: str = LEARNED_LABEL, limit: int | None = None) -> DataFrame:
    """Closed plans without the learned label. ``limit`` reproduces the source
    tool's cap, applied *before* the label filter; none by default."""
    closed = open_plans_topk(issues, plan_label, "CLOSED", limit)
    return closed.filter(~F.array_contains("labels", learned_label))


def latest_close_event(close_events: DataFrame) -> DataFrame:
    """Last close event per issue, by (closed_at, seq, closer_id, actor).
    ``max(struct)`` is a partial aggregate: a hot issue combines map-side."""
    last = F.max(F.struct("closed_at", "seq", "closer_id", "actor", "closer_type", "pr_number", "pr_state"))
    return (close_events.groupBy("repo", "issue").agg(last.alias("e"))
            .select("repo", "issue", "e.*"))


def linked_keys(close_events: DataFrame) -> DataFrame:
    """(repo, issue, pr_number, closed_at) of issues closed by a merged PR: take
    the *last* close event, *then* require a merged PR closer (filtering first
    would pick older merges)."""
    last = latest_close_event(close_events)
    merged = last.filter((F.col("closer_type") == "PullRequest") & (F.col("pr_state") == "MERGED"))
    return merged.select("repo", "issue", "pr_number", "closed_at")


def linked_pr(close_events: DataFrame, prs: DataFrame) -> DataFrame:
    """Merged PR that closed the issue, with its texts. They come by a shuffle
    join: estimates of text columns are not to be trusted with a broadcast."""
    p = prs.select("repo", F.col("number").alias("pr_number"), F.col("title").alias("pr_title"),
                   F.col("body").alias("pr_body"), "head_ref", "diff")
    return linked_keys(close_events).join(p.hint("merge"), ["repo", "pr_number"])


def pr_for_branch(prs: DataFrame, branches: DataFrame | None = None) -> DataFrame:
    """Newest open PR (highest number) per (repo, head branch)."""
    best = (prs.filter(F.col("state") == "OPEN").groupBy("repo", "head_ref")
            .agg(F.max(F.struct("number", "title", "body")).alias("p"))
            .select("repo", "head_ref", "p.number", "p.title", "p.body"))
    if branches is not None:
        best = branches.select("repo", "head_ref").join(best, ["repo", "head_ref"], "left")
    return best


def conversation_parts(comments: DataFrame, prefix: str = T.DEFAULT_PREFIX) -> DataFrame:
    """(repo, issue, first_seq, seq, text): the comments of each issue's planning conversation. It
    begins with the first comment (by seq) that contains the sentinel, which is removed, and goes
    on in the comments behind the mark for more, up to the next one with a sentinel."""
    m = T.markers(prefix)
    more_mark = F.col("body").startswith(m["conversation_more"] + "\n")
    heads = comments.filter(F.col("body").contains(m["conversation"]) & ~more_mark)
    first = heads.groupBy("repo", "issue").agg(F.min("seq").alias("first_seq"))
    later = (heads.select("repo", "issue", "seq").join(first, ["repo", "issue"]).filter(F.col("seq") > F.col("first_seq"))
             .groupBy("repo", "issue").agg(F.min("seq").alias("_until")))
    spans = first.join(later, ["repo", "issue"], "left")
    marked = comments.filter(F.col("body").contains(m["conversation"]) | more_mark)
    mine = marked.join(spans, ["repo", "issue"]).filter(
        (F.col("seq") >= F.col("first_seq")) & (F.col("_until").isNull() | (F.col("seq") < F.col("_until"))))
    more = F.substring(F.col("body"), F.lit(len(m["conversation_more"]) + 2), F.length("body"))
    i = F.instr("body", m["conversation"])
    head = F.concat(F.substring(F.col("body"), F.lit(1), i - 1),
                    F.substring(F.col("body"), i + F.lit(len(m["conversation"])), F.length("body")))
    return mine.select("repo", "issue", "first_seq", "seq",
                       F.when(F.col("seq") == F.col("first_seq"), head).otherwise(more).alias("text"))


def conversation_of(comments: DataFrame, prefix: str = T.DEFAULT_PREFIX) -> DataFrame:
    """Each issue's planning conversation as one trimmed text (``conversation_parts`` has it in parts)."""
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "text"))), lambda x: x["text"]), "")
    return conversation_parts(comments, prefix).groupBy("repo", "issue").agg(
        F.min("first_seq").alias("seq"), T.trim_ws(text).alias("conversation"))


def resolve_ref(prs: DataFrame, issues: DataFrame) -> DataFrame:
    """PR -> referenced issue (closing keyword, else first digits of the branch)
    -> still open? Otherwise the caller falls back to the open-plan list."""
    body_ref = T.closing_ref(F.col("body"))
    br = T.branch_ref(F.col("head_ref"))
    r = prs.select("repo", F.col("number").alias("pr_number"),
                   F.coalesce(body_ref, br).alias("ref_issue"),
                   F.when(body_ref.isNotNull(), "body").when(br.isNotNull(), "branch").alias("ref_source"))
    i = issues.select("repo", F.col("number").alias("ref_issue"), F.col("state").alias("issue_state"))
    j = r.join(i, ["repo", "ref_issue"], "left")
    return j.withColumn("outcome", F.when(F.col("issue_state").isNotNull() & (F.col("issue_state") != "CLOSED"),
                                          "open_issue").otherwise("fallback_open_plans"))


def open_plan_lists(issues: DataFrame, k: int = OPEN_LIST_CAP, label: str = PLAN_LABEL) -> DataFrame:
    """(repo, rank, number, title): the open-plan list of each repo, newest first, at most k rows a repo."""
    return open_plans_topk(issues, label, "OPEN", k).select("repo", "rank", "number", "title")


def resolve_with_lists(prs: DataFrame, issues: DataFrame, k: int = OPEN_LIST_CAP) -> tuple[DataFrame, DataFrame]:
    """(refs, lists). refs: ``resolve_ref`` and, where a PR falls back, ``list_repo``, the repo
    whose list (in lists) stands for it; outcome ``no_open_plans`` where that list is empty.
    A list is held once, however many PRs refer to it."""
    lists = materialize(open_plan_lists(issues, k), "open-plans")
    some = lists.filter("rank = 1").select("repo", F.col("repo").alias("_list"))
    refs = resolve_ref(prs, issues).join(some, "repo", "left")
    falls = F.col("outcome") == "fallback_open_plans"
    return refs.withColumn("list_repo", F.when(falls, F.col("_list"))).withColumn(
        "outcome", F.when(falls & F.col("_list").isNull(), "no_open_plans").otherwise(F.col("outcome"))).drop("_list"), lists


def reference_edges(issues: DataFrame, prs: DataFrame, nodes: DataFrame) -> DataFrame:
    """All textual references as one edge table (kind, repo, from, to), each
    matched against existing issues of the same repo: plan to objective by its
    body, PR to issue by its body and by its branch, plan to PR by the address
    its node holds. Every table is scanned once for its edges."""
    def edges_of(df, number, **kinds):
        found = F.array(*[F.struct(F.lit(k).alias("kind"), to.alias("to_number")) for k, to in kinds.items()])
        return df.select("repo", number.alias("from_number"), F.inline(found)).filter(F.col("to_number").isNotNull())

    edges = edges_of(issues, F.col("number"), objective=T.objective_ref(F.col("body"))["objective"])
    edges = edges.unionByName(edges_of(prs, F.col("number"), closes=T.closing_ref(F.col("body")),
                                       branch=T.branch_ref(F.col("head_ref"))))
    edges = edges.unionByName(edges_of(nodes.filter(F.col("pr_url").isNotNull()), F.col("plan_issue"),
                                       url=T.id_from_url(F.col("pr_url"))))
    known = issues.select("repo", F.col("number").alias("to_number"), F.lit(True).alias("matched"))
    return (edges.join(known, ["repo", "to_number"], "left")
            .withColumn("matched", F.coalesce("matched", F.lit(False))))


def plan_links(issues: DataFrame) -> DataFrame:
    """Parent (objective) -> child (plan) links from ``Objective: #N (node ID)``;
    a parent that does not exist is reported, not linked."""
    oref = T.objective_ref(F.col("body"))
    links = issues.select("repo", oref["objective"].alias("parent"), F.col("number").alias("child"),
                          oref["node_id"].alias("node_id")).filter(F.col("parent").isNotNull())
    parents = issues.select("repo", F.col("number").alias("parent"), F.lit(True).alias("_p"))
    return (links.join(parents, ["repo", "parent"], "left")
            .withColumn("status", F.when(F.col("_p"), "linked").otherwise("missing_parent")).drop("_p"))


def listing_line(number: Column, title: Column, age: Column) -> Column:
    """``#n title (age)`` with n left-aligned to width 4, never cut."""
    n = number.cast("string")
    padded = F.when(F.length(n) >= 4, n).otherwise(F.rpad(n, 4, " "))
    return F.concat(F.lit("#"), padded, F.lit(" "), title, F.lit(" ("), age, F.lit(")"))


def plan_listing(issues: DataFrame, as_of: str, label: str = PLAN_LABEL, k: int | None = None) -> DataFrame:
    top = open_plans_topk(issues, label, "OPEN", k)
    age = T.age_label(F.date_format("created_at", "yyyy-MM-dd"), F.lit(as_of).cast("date"))
    return top.select("repo", "number", "rank", listing_line(F.col("number"), F.col("title"), age).alias("line"))


def closed_only(issues: DataFrame, label: str = PLAN_LABEL) -> DataFrame:
    """Accept closed issues; every other one becomes a reject row (a batch
    counts it and goes on)."""
    f = issues.filter(F.array_contains("labels", label))
    ok = F.col("state") == "CLOSED"
    return f.select("repo", "number", F.when(ok, "accepted").otherwise("rejected").alias("outcome"),
                    F.when(~ok, F.concat(F.lit("#"), F.col("number").cast("string"),
                                         F.lit(" has state "), F.col("state")))
                    .alias("reason"))
