"""Objective dependency graph: first node per id, blocking edges, unblocked
and landable nodes, completion roll-ups and the per-objective renderings.

``nodes`` follows ``schemas.NODES``; ``pos`` is the dense 1-based position of
the node inside its objective. The per-id lookup of the source tool is a
linear scan per dependency; here it is one equi-join on
``(repo, objective, node_id)``, so a large objective spreads over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.ordering import concat_by_ordinal
from tallyloom.functions.text import markers

# ---- fixed values (text the renderings must reproduce) ----------------------
ROADMAP_HEADER = ("| ID | Description | Status | Plan | PR | Blocked By |\n"
                  "|----|-------------|--------|------|----|------------|")
CLOSE_HEADER = "All nodes completed — closing objective."
# ---------------------------------------------------------------------------

NODE_KEY = ["repo", "objective"]
# Text renderings are split into parts of at most this many nodes.
PART_NODES = 10_000


def first_node_per_id(nodes: DataFrame) -> DataFrame:
    """First node (lowest pos) for each id; a partial aggregate, so a repeated
    hot id is combined map-side."""
    return (nodes.groupBy("repo", "objective", "node_id")
            .agg(F.min(F.struct("pos", "status")).alias("f"))
            .select("repo", "objective", "node_id", F.col("f.pos").alias("pos"),
                    F.col("f.status").alias("status")))


def dependency_edges(nodes: DataFrame) -> DataFrame:
    return nodes.select("repo", "objective", "pos", "node_id",
                        F.posexplode("depends_on").alias("dep_pos", "dep_id"))


def blocked_by(nodes: DataFrame) -> DataFrame:
    """One row per blocking dependency: the first node with that id exists and
    is not done. Unknown ids do not block; self-dependency blocks; one hop."""
    open_first = (first_node_per_id(nodes).filter(F.col("status") != "done")
                  .select("repo", "objective", F.col("node_id").alias("dep_id")))
    return (dependency_edges(nodes).join(open_first, ["repo", "objective", "dep_id"])
            .select("repo", "objective", "pos", "node_id",
                    F.col("dep_pos").cast("bigint").alias("dep_pos"), "dep_id"))


def dangling_dependencies(nodes: DataFrame) -> DataFrame:
    """Dependencies naming no node of the objective (they never block)."""
    ids = nodes.select("repo", "objective", F.col("node_id").alias("dep_id"))
    return (dependency_edges(nodes).join(ids, ["repo", "objective", "dep_id"], "left_anti")
            .select("repo", "objective", "pos", "node_id",
                    F.col("dep_pos").cast("bigint").alias("dep_pos"), "dep_id"))


def unblocked_nodes(nodes: DataFrame, blocked: DataFrame | None = None) -> DataFrame:
    """Pending nodes with no blocking dependency."""
    blocked = blocked if blocked is not None else blocked_by(nodes)
    return (nodes.filter(F.col("status") == "pending")
            .join(blocked.select("repo", "objective", "pos"), ["repo", "objective", "pos"], "left_anti"))


def landable_nodes(nodes: DataFrame) -> DataFrame:
    """Nodes that have a plan issue and are not done (no dependency test)."""
    return nodes.filter(F.col("plan_issue").isNotNull() & (F.col("status") != "done"))


def all_nodes_done(nodes: DataFrame, objectives: DataFrame | None = None) -> DataFrame:
    """At least one node and every node done; objectives without nodes -> false."""
    agg = nodes.groupBy(*NODE_KEY).agg(
        F.count(F.lit(1)).alias("n_nodes"),
        F.bool_and(F.col("status") == "done").alias("all_done"))
    if objectives is None:
        return agg
    return (objectives.select(*NODE_KEY).join(agg, NODE_KEY, "left")
            .select(*NODE_KEY, F.coalesce("n_nodes", F.lit(0)).alias("n_nodes"),
                    F.coalesce("all_done", F.lit(False)).alias("all_done")))


def objective_progress(nodes: DataFrame, blocked: DataFrame | None = None) -> DataFrame:
    """Counts per objective: by status, blocked nodes, unblocked pending nodes."""
    blocked = blocked if blocked is not None else blocked_by(nodes)
    per_node = blocked.groupBy("repo", "objective", "pos").agg(F.count(F.lit(1)).alias("n_blockers"))
    j = nodes.join(per_node, ["repo", "objective", "pos"], "left")
    is_blocked = F.col("n_blockers").isNotNull()
    st = F.col("status")
    return j.groupBy(*NODE_KEY).agg(
        F.count(F.lit(1)).alias("n_nodes"),
        F.count_if(st == "pending").alias("n_pending"),
        F.count_if(st == "in_progress").alias("n_in_progress"),
        F.count_if(st == "done").alias("n_done"),
        F.count_if(is_blocked).alias("n_blocked"),
        F.count_if((st == "pending") & ~is_blocked).alias("n_unblocked"))


def concat_by_pos(df: DataFrame, keys: list[str], pos: str, piece: Column, sep: str,
                  part_rows: int = PART_NODES, text_name: str = "text") -> DataFrame:
    """Concatenate ``piece`` per objective in dense ``pos`` order, in parts."""
    return concat_by_ordinal(df, keys, pos, piece, sep, part_rows, text_name).drop("n_items", "first_ord")


def blocked_lists(nodes: DataFrame, blocked: DataFrame | None = None) -> DataFrame:
    """Per node: blocking ids joined ``", "`` in dependency order."""
    blocked = blocked if blocked is not None else blocked_by(nodes)
    return blocked.groupBy("repo", "objective", "pos").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("dep_pos", "dep_id"))),
                                 lambda x: x["dep_id"]), ", ").alias("blocked"))


def _table_row() -> Column:
    row = F.concat_ws(" | ", F.col("node_id"), F.col("description"), F.col("status"),
                      F.coalesce(F.concat(F.lit("#"), F.col("plan_issue").cast("string")), F.lit("")),
                      F.coalesce(F.col("pr_url"), F.lit("")), F.coalesce(F.col("blocked"), F.lit("")))
    return F.concat(F.lit("| "), row, F.lit(" |"))


def node_state_json(nodes: DataFrame | None = None) -> Column:
    """One node as the stored JSON object (null fields omitted)."""
    return F.to_json(F.struct(F.col("node_id").alias("id"), "description", "status", "plan_issue",
                              "pr_url", F.coalesce("depends_on", F.array().cast("array<string>"))
                              .alias("depends_on")))


def render_objectives(nodes: DataFrame, blocked: DataFrame | None = None, prefix: str = "loom",
                      part_rows: int = PART_NODES) -> DataFrame:
    """Roadmap table and state blob per objective part, in one aggregation
    (one shuffle) over the nodes joined to their blocking lists."""
    m = markers(prefix)
    j = nodes.join(blocked_lists(nodes, blocked), ["repo", "objective", "pos"], "left")
    d = (j.withColumn("part", F.floor((F.col("pos") - 1) / F.lit(part_rows)).cast("bigint"))
         .withColumn("_e", F.struct(F.col("pos").alias("p"), _table_row().alias("row"),
                                    node_state_json().alias("js"))))
    agg = d.groupBy(*NODE_KEY, "part").agg(F.array_sort(F.collect_list("_e")).alias("_es"))
    rows = F.array_join(F.transform("_es", lambda x: x["row"]), "\n")
    table = F.when(F.col("part") == 0, F.concat(F.lit(ROADMAP_HEADER + "\n"), rows)).otherwise(rows)
    blob = F.concat(F.lit(m["nodes_start"] + "["), F.array_join(F.transform("_es", lambda x: x["js"]), ","),
                    F.lit("]" + m["nodes_end"]))
    return agg.select(*NODE_KEY, "part", table.alias("table"), blob.alias("blob"))


def roadmap_table(nodes: DataFrame, blocked: DataFrame | None = None,
                  part_rows: int = PART_NODES) -> DataFrame:
    """Markdown table per objective; the header leads part 0."""
    return render_objectives(nodes, blocked, part_rows=part_rows).select(*NODE_KEY, "part", "table")


def state_comment(nodes: DataFrame, prefix: str = "loom", part_rows: int = PART_NODES) -> DataFrame:
    """Node rows -> the hidden state blob (one per objective part). Needs no
    blocking lists, so it aggregates the nodes directly."""
    m = markers(prefix)
    t = concat_by_pos(nodes, NODE_KEY, "pos", node_state_json(), ",", part_rows)
    return t.select(*NODE_KEY, "part",
                    F.concat(F.lit(m["nodes_start"] + "["), "text", F.lit("]" + m["nodes_end"])).alias("blob"))


def close_comment(nodes: DataFrame, part_rows: int = PART_NODES) -> DataFrame:
    """Closing comment for objectives whose nodes are all done."""
    done = all_nodes_done(nodes).filter("all_done").select(*NODE_KEY)
    n = nodes.join(done, NODE_KEY, "left_semi")
    line = F.concat(F.lit("- "), F.col("node_id"), F.lit(" "), F.col("description"))
    t = concat_by_pos(n, NODE_KEY, "pos", line, "\n", part_rows)
    return t.select(*NODE_KEY, "part", F.when(F.col("part") == 0, F.concat(F.lit(CLOSE_HEADER + "\n\n"), "text"))
                    .otherwise(F.col("text")).alias("comment"))
