"""Project-history tables derived from the driver's TPC-H-style tables.

The driver data holds no issues, notes or roadmaps, so each table is a fixed,
documented derivation (FIXTURES.md part B); structured text is *built from
columns* here and parsed back by the jobs, while the DuckDB oracle reads the
columns. Every derivation is a narrow projection, a generator or an equi-join,
so it scales with the input tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.functions.note_text import render_note_content
from tallyloom.functions.ordering import ordinal_by_numeric
from tallyloom.functions.text import CATEGORIES, PLAN_SECTIONS, markers
from tallyloom.session import materialize
from tallyloom.sources.tables import read_table

AS_OF_EVENTS = "2024-01-30"
REPOS = [f"r{i}" for i in range(10)]


def _repo(c: Column) -> Column:
    return F.concat(F.lit("r"), (c % 10).cast("string"))


def _category_of(doc_id: Column) -> Column:
    cats = F.array(*[F.lit(c) for c in CATEGORIES])
    return F.when(doc_id % 40 == 39, F.lit("other")).otherwise(
        F.element_at(cats, (doc_id % 4 + 1).cast("int")))


# ---- F1 / F1s: objective nodes ----------------------------------------------

def nodes(spark: SparkSession, sf_dir: str, small: bool = False, checkpoint: bool = False) -> DataFrame:
    """F1 (objective = customer) or F1s (objective = orderkey div 3)."""
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"])
    if small:
        objective = F.floor(F.col("o_orderkey") / 3).cast("bigint")
    else:
        objective = F.col("o_custkey")
    base = o.select(
        objective.alias("objective"), "o_orderkey", "o_orderstatus", "o_orderpriority")
    base = base.withColumn("repo", _repo(F.col("objective")))
    if small:
        # objective = orderkey div 3 holds at most 3 rows by construction
        w = Window.partitionBy("objective").orderBy("o_orderkey")
        base = base.withColumn("pos", F.row_number().over(w).cast("bigint"))
    else:
        base = ordinal_by_numeric(base, ["objective"], "o_orderkey", "pos")
    base = base.withColumn("node_id", F.col("o_orderkey").cast("string"))
    # lag 1 / lag 3 as equi-joins on (objective, pos): no per-objective task
    prev1 = base.select("objective", (F.col("pos") + 1).alias("pos"), F.col("node_id").alias("_d1"))
    prev3 = base.select("objective", (F.col("pos") + 3).alias("pos"), F.col("node_id").alias("_d3"))
    j = base.join(prev1, ["objective", "pos"], "left").join(prev3, ["objective", "pos"], "left")
    status = (F.when(F.col("o_orderstatus") == "P", "pending")
              .when(F.col("o_orderstatus") == "O", "in_progress").otherwise("done"))
    dangling = F.when(F.col("o_orderkey") % 7 == 0, F.concat(F.lit("x"), F.col("node_id")))
    out = j.select(
        "repo", "objective", "pos", "node_id",
        F.col("o_orderpriority").alias("description"),
        status.alias("status"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey") + 1000000).alias("plan_issue"),
        F.when(F.col("o_orderstatus") == "F",
               F.concat(F.lit("https://host/"), F.col("repo"), F.lit("/pull/"), F.col("node_id"))).alias("pr_url"),
        F.filter(F.array(F.col("_d1"), F.col("_d3"), dangling), lambda x: x.isNotNull()).alias("depends_on"))
    # The derivation is deterministic, so re-reading it is correct; a caller
    # that feeds the table to many consumers (the rewrite family reads it four
    # times) can write it once to the shared folder.
    if not checkpoint:
        return out
    return materialize(out, "nodes")


# ---- F2: issues ---------------------------------------------------------------

def issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders",
                   ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"])
    k = F.col("o_orderkey")
    body = (F.when(k % 26 == 5, F.lit(None).cast("string"))
            .when(k % 2 == 0, F.concat(F.lit("Objective: #"), F.col("o_custkey").cast("string"),
                                       F.lit(" (node "), k.cast("string"), F.lit(")")))
            .otherwise(F.lit("plain")))
    labels = F.array_compact(F.array(
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("objective")).otherwise(F.lit("plan")),
        F.when(k % 3 == 0, F.lit("learned"))))
    repo = _repo(F.col("o_custkey"))
    return o.select(
        repo.alias("repo"), k.alias("number"),
        F.concat(F.lit("Plan "), k.cast("string"), F.lit(": "), F.col("o_orderpriority")).alias("title"),
        body.alias("body"),
        F.when(F.col("o_orderstatus") == "F", "CLOSED").otherwise("OPEN").alias("state"),
        F.col("o_orderdate").alias("created_at"),
        labels.alias("labels"),
        F.concat(F.lit("https://host/"), repo, F.lit("/issues/"), k.cast("string")).alias("url"))


# ---- F3: close events -----------------------------------------------------------

def close_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag",
                     "l_linestatus", "l_shipdate"])
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    is_pr = F.col("l_linestatus") == "O"
    state = (F.when(F.col("l_returnflag") == "R", "MERGED")
             .when(F.col("l_returnflag") == "A", "CLOSED").otherwise("OPEN"))
    return j.select(
        _repo(F.col("o_custkey")).alias("repo"), F.col("l_orderkey").alias("issue"),
        F.col("l_shipdate").alias("closed_at"), F.col("l_linenumber").alias("seq"),
        F.when(is_pr, "PullRequest").otherwise("User").alias("closer_type"),
        F.col("l_partkey").alias("closer_id"),
        F.when(is_pr, F.col("l_partkey")).alias("pr_number"),
        F.when(is_pr, state).alias("pr_state"),
        F.col("l_suppkey").alias("actor"))


# ---- F4: comments ---------------------------------------------------------------

def comments(spark: SparkSession, sf_dir: str, prefix: str = "loom") -> DataFrame:
    cv = read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"])
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    j = cv.join(o, cv.conv_id == o.o_orderkey)
    sentinel = markers(prefix)["conversation"]
    body = F.when(F.col("role") == "assistant",
                  F.concat(F.lit(sentinel + "\n"), F.col("text"))).otherwise(F.col("text"))
    return j.select(_repo(F.col("o_custkey")).alias("repo"), F.col("conv_id").alias("issue"),
                    F.col("turn").alias("seq"), body.alias("body"))


# ---- F5a / F5b: plan and objective bodies ----------------------------------------

def plan_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang"])
    parts = [F.when(F.col("doc_id").bitwiseAND(1 << i) != 0, F.lit(f"**{name}** x ")).otherwise(F.lit(""))
             for i, (name, _) in enumerate(PLAN_SECTIONS)]
    return d.select("doc_id", F.concat(*parts, F.col("text")).alias("body"), "lang")


def roadmap_bullet(node_id: Column, description: Column, deps: Column) -> Column:
    return F.concat(F.lit("- "), node_id, F.lit(": "), description,
                    F.when(F.size(deps) > 0, F.concat(F.lit(" (depends: "), F.array_join(deps, ", "), F.lit(")")))
                    .otherwise(F.lit("")))


def objective_bodies(spark: SparkSession, sf_dir: str, nodes_df: DataFrame | None = None) -> DataFrame:
    """F5b: one body per objective. One body is one issue text, so its size is
    bounded by what a code host stores per issue; the bullets are ordered by the
    already-computed ``pos``."""
    n = nodes_df if nodes_df is not None else nodes(spark, sf_dir)
    deps = F.filter(F.col("depends_on"), lambda x: ~x.startswith("x"))
    b = n.select("repo", "objective", "pos",
                 roadmap_bullet(F.col("node_id"), F.col("description"), deps).alias("bullet"))
    agg = b.groupBy("repo", "objective").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "bullet"))),
                                 lambda x: x["bullet"]), "\n").alias("bullets"))
    notes = F.when(F.col("objective") % 2 == 0, F.lit("\n## Notes\nKeep scope small.\n")).otherwise(F.lit(""))
    body = F.concat(F.lit("## Goal\nDeliver objective "), F.col("objective").cast("string"),
                    F.lit("\n\n## Roadmap\n"), F.col("bullets"), F.lit("\n"), notes)
    return agg.select("repo", "objective",
                      F.concat(F.lit("Objective "), F.col("objective").cast("string")).alias("title"),
                      body.alias("body"))


# ---- F6: notes -----------------------------------------------------------------------

def notes(spark: SparkSession, sf_dir: str, keep_doc_id: bool = False) -> DataFrame:
    d = read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang", "source"])
    i = F.col("doc_id")
    read_when = F.slice(F.array(F.concat(F.lit("lang "), F.col("lang")),
                                F.concat(F.lit("source "), F.col("source"))), 1, (i % 3).cast("int"))
    tripwires = F.when(i % 5 == 0, F.array(F.struct(
        F.concat(F.lit("editing "), F.col("source")).alias("action"),
        F.concat(F.lit("check "), F.col("lang")).alias("warning")))).otherwise(
        F.array().cast("array<struct<action:string,warning:string>>"))
    out = d.select(
        i.alias("doc_id"), _repo(i).alias("repo"), _category_of(i).alias("category"),
        F.concat(F.lit("n"), i.cast("string")).alias("slug"),
        F.when(i % 11 == 0, F.lit(None).cast("string")).otherwise(
            F.concat(F.lit("Note "), i.cast("string"))).alias("title"),
        read_when.alias("read_when"), tripwires.alias("tripwires"),
        F.date_add(F.lit("2024-01-01").cast("date"), (i % 28).cast("int")).alias("last_updated"),
        F.array(i % 50, i % 50 + 7).alias("source_issues"),
        F.col("text").alias("body"))
    out = out.withColumn("content", render_note_content(
        F.col("title"), F.col("read_when"), F.col("tripwires"), F.col("last_updated"),
        F.col("source_issues"), F.col("body")))
    return out if keep_doc_id else out.drop("doc_id")


# ---- F7: audit actions ----------------------------------------------------------------

def audit_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = read_table(spark, sf_dir, "labels", ["doc_id", "quality", "toxic"])
    n = notes(spark, sf_dir, keep_doc_id=True).select("doc_id", "repo", "category", "slug") \
        .filter(F.col("category").isin(CATEGORIES))
    j = lab.join(n, "doc_id")
    i = F.col("doc_id")
    action = (F.when(F.col("toxic") == 1, "delete").when(F.col("quality") == 0, "merge_into").otherwise("keep"))
    is_merge = action == "merge_into"
    return j.select(
        "repo", i.alias("pos"), action.alias("action"), "category", "slug",
        F.when(action == "delete", "low value").when(is_merge, "same insight").alias("reason"),
        F.when(is_merge, _category_of(i + 10)).alias("target_category"),
        F.when(is_merge, F.when(i % 5 == 0, F.concat(F.lit("n"), (i + 10000000).cast("string")))
               .otherwise(F.concat(F.lit("n"), (i + 10).cast("string")))).alias("target_slug"),
        F.when(is_merge & (i % 2 == 1), F.concat(F.lit("Merged body "), i.cast("string")))
        .alias("target_updated_body"))


# ---- F8: learning items ------------------------------------------------------------------

def learning_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = read_table(spark, sf_dir, "labels", ["doc_id", "quality", "toxic"])
    i = F.col("doc_id")
    cats = F.array(*[F.lit(c) for c in CATEGORIES])
    return lab.select(
        _repo(i).alias("repo"), i.alias("issue"), i.alias("pos"),
        F.element_at(cats, ((i % 100) % 4 + 1).cast("int")).alias("category"),
        F.concat(F.lit("n"), (i % 100).cast("string")).alias("slug"),
        F.concat(F.lit("Learning "), i.cast("string")).alias("title"),
        F.when(F.col("quality") == 0, F.array().cast("array<string>"))
        .otherwise(F.array(F.concat(F.lit("touching area "), (i % 7).cast("string")))).alias("read_when"),
        F.when(F.col("toxic") == 1, F.array(F.struct(
            F.concat(F.lit("act "), i.cast("string")).alias("action"),
            F.concat(F.lit("warn "), i.cast("string")).alias("warning"))))
        .otherwise(F.array().cast("array<struct<action:string,warning:string>>")).alias("tripwires"),
        F.concat(F.lit("Learned from "), i.cast("string")).alias("body"))


# ---- F8e: dated events -----------------------------------------------------------------

def dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events", ["event_id", "ts"])


# ---- F9: pull requests ---------------------------------------------------------------------

#: Pull requests that one task makes at most: a narrow part row becomes a PR, with its diff, in every repo.
PRS_A_TASK = 250_000


def pull_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_brand", "p_type", "p_size"])
    # a small file is read by few tasks, however many PRs come of it: deal its rows before they grow
    tasks = -(-p.count() * len(REPOS) // PRS_A_TASK)
    if tasks > 1:
        p = p.repartition(tasks, "p_partkey")
    k = F.col("p_partkey").cast("string")
    m = F.col("p_size") % 6
    body = (F.when(m == 0, F.concat(F.lit("Closes #"), k))
            .when(m == 1, F.concat(F.lit("fixes #1 then closes #"), k))
            .when(m == 2, F.concat(F.lit("RESOLVES #"), k))
            .when(m == 3, F.concat(F.lit("closes #abc, fixes #"), k))
            .when(m == 4, F.concat(F.lit("discloses #"), k))
            .otherwise(F.lit("no reference")))
    head = F.when(F.col("p_partkey") % 4 == 0,
                  F.concat(F.lit("feat-"), k, F.lit("-"), F.col("p_size").cast("string"))).otherwise(F.lit("main"))
    diff = F.concat(F.lit("diff --git a/"), F.col("p_type"), F.lit(" b/"), F.col("p_type"), F.lit("\n"),
                    F.repeat(F.concat(F.lit("+"), F.col("p_name"), F.lit("\n")), F.col("p_size") * 8))
    # one PR per part in every repo: a generator over a fixed list, not a join
    return p.select(F.explode(F.array(*[F.lit(r) for r in REPOS])).alias("repo"),
                    F.col("p_partkey").alias("number"), head.alias("head_ref"), body.alias("body"),
                    F.col("p_name").alias("title"), diff.alias("diff"),
                    F.when(F.col("p_partkey") % 3 == 0, "MERGED").otherwise("OPEN").alias("state"))


# ---- F10: model replies ---------------------------------------------------------------------

def _item_json(i: Column, tag: str, with_title: Column) -> Column:
    cats = F.array(*[F.lit(c) for c in CATEGORIES])
    s = i.cast("string")
    return F.concat(
        F.lit('{"category":"'), F.element_at(cats, (i % 4 + 1).cast("int")),
        F.lit('","slug":"s'), s, F.lit(tag + '",'),
        F.when(with_title, F.concat(F.lit('"title":"t'), s, F.lit(tag + '",'))).otherwise(F.lit("")),
        F.lit('"read_when":["w'), s, F.lit('"],'),
        F.when(i % 3 == 0, F.concat(F.lit('"tripwires":[{"action":"a'), s, F.lit('","warning":"x'), s,
                                    F.lit('"}],'))).otherwise(F.lit("")),
        F.lit('"body":"b'), s, F.lit(tag + '"}'))


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = read_table(spark, sf_dir, "labels", ["doc_id", "quality"])
    i = F.col("doc_id")
    ok_title = F.col("quality") != 0
    js = F.concat(F.lit("["), _item_json(i, "", F.lit(True)),
                  F.when(i % 2 == 0, F.concat(F.lit(", "), _item_json(i, "x", ok_title))).otherwise(F.lit("")),
                  F.lit("]"))
    m = i % 5
    reply = (F.when(m == 0, F.concat(F.lit("```json\n"), js, F.lit("\n```")))
             .when(m == 1, js)
             .when(m == 2, F.concat(F.lit("Here: "), js))
             .when(m == 3, F.left(js, F.lit(20)))
             .otherwise(F.concat(js, F.lit(" trailing ]"))))
    return lab.select(i.alias("id"), reply.alias("reply"))


# ---- F11: managed pages -------------------------------------------------------------------

def managed(spark: SparkSession, sf_dir: str, prefix: str = "loom") -> DataFrame:
    pg = read_table(spark, sf_dir, "pages", ["page_id", "html"])
    m = markers(prefix)
    text = F.when(F.col("page_id") % 2 == 0,
                  F.concat(F.col("html"), F.lit("\n" + m["block_start"] + "\nold index\n" + m["block_end"]
                                                + "\ntrailer\n"))).otherwise(F.col("html"))
    return pg.select("page_id", _repo(F.col("page_id")).alias("repo"), F.col("html"), text.alias("text"))


# ---- F12: prompt hooks ----------------------------------------------------------------------

def hooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents", ["doc_id", "lang"])
    i = F.col("doc_id")
    path = (F.when(i % 7 == 0, F.lit("README.md")).when(i % 7 == 1, F.lit("x.txt"))
            .otherwise(F.concat(F.lit("h"), i.cast("string"), F.lit(".md"))))
    return d.select(_repo(i).alias("repo"), path.alias("path"), F.col("lang").alias("text"), i.alias("doc_id"))


# ---- F13: manifests ---------------------------------------------------------------------------

def manifests(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    d = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    path = F.concat(F.lit("docs/"), F.col("doc_id").cast("string"), F.lit(".md"))
    expected = d.select(path.alias("path"), F.col("text").alias("content"))
    actual = d.filter(F.col("doc_id") % 10 != 0).select(
        path.alias("path"),
        F.when(F.col("doc_id") % 10 == 1, F.concat(F.col("text"), F.lit(" (edited)")))
        .otherwise(F.col("text")).alias("content"))
    return expected, actual


# ---- F14: a large tree, two of whose 64 subtrees differ ---------------------------------------

def trees(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    d = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    i, sub = F.col("doc_id"), F.col("doc_id") % 64
    path = F.concat(F.lit("t"), F.lpad(sub.cast("string"), 2, "0"), F.lit("/"), i.cast("string"), F.lit(".md"))
    expected = d.select(path.alias("path"), F.col("text").alias("content"))
    edited = F.when((sub == 5) & (i % 3 == 0), F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    return expected, d.filter(~((sub == 3) & (i % 2 == 1))).select(path.alias("path"), edited.alias("content"))


# ---- F15: the auditor's replies ------------------------------------------------------------------

def audit_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reply for each repo and 16 documents: the actions as a JSON array; every fifth reply is cut off."""
    a = audit_actions(spark, sf_dir)
    item = F.to_json(F.struct("action", "category", "slug", "reason", "target_category", "target_slug", "target_updated_body"))
    no = F.expr("pos div 160")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", item.alias("j")))), lambda x: x["j"]), ",\n")
    rows = a.withColumn("reply_no", no).groupBy("repo", "reply_no").agg(text.alias("t"))
    full = F.concat(F.lit("Audit:\n["), "t", F.lit("]"))
    return rows.select("repo", "reply_no", F.when(F.col("reply_no") % 5 == 4, F.left(full, F.length(full) - 3))
                       .otherwise(full).alias("reply"))


# ---- F16: exports of the code host: (repo, line) with one object a line --------------------------

def _utc(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def issue_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = F.transform("labels", lambda x: F.struct(x.alias("name")))
    return issues(spark, sf_dir).select("repo", F.struct(
        "number", "title", "body", "state", _utc("created_at").alias("createdAt"), labels.alias("labels"), "url").alias("line"))


def pr_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pull_requests(spark, sf_dir).select("repo", F.struct(
        "number", "title", "body", "state", F.col("head_ref").alias("headRefName"), "diff").alias("line"))


def close_event_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timelines as a host gives them: the events of an issue in order."""
    e = close_events(spark, sf_dir)
    closer = F.when(F.col("closer_type") == "PullRequest", F.struct(
        F.col("closer_type").alias("__typename"), F.col("pr_number").alias("number"), F.col("pr_state").alias("state")))
    order = F.struct("closed_at", "seq", "closer_id", "actor")
    nodes_ = F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), _utc("closed_at").alias("createdAt"),
                                                              closer.alias("closer")))),
                         lambda x: F.struct(x["createdAt"].alias("createdAt"), x["closer"].alias("closer")))
    return (e.groupBy("repo", F.col("issue").alias("number")).agg(nodes_.alias("nodes"))
            .select("repo", F.struct("number", F.struct("nodes").alias("timelineItems")).alias("line")))


def comment_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = comments(spark, sf_dir)
    body = F.transform(F.array_sort(F.collect_list(F.struct("seq", "body"))), lambda x: F.struct(x["body"].alias("body")))
    return (c.groupBy("repo", F.col("issue").alias("number")).agg(body.alias("comments"))
            .select("repo", F.struct("number", "comments").alias("line")))
