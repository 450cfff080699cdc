"""The registered queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Each query reads the driver tables through ``sources.fixtures`` and runs one
operator over the whole tables. Output columns are scalars (arrays joined to
text, ids and counts as BIGINT, no floats) so the DuckDB oracle can hash them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import text as T
from tallyloom.operators import extract as ex
from tallyloom.operators import graph
from tallyloom.operators import issues as iss
from tallyloom.operators import lifecycle as lc
from tallyloom.operators import notes as nt
from tallyloom.operators import prompts as pr
from tallyloom.operators import trees, views
from tallyloom.session import materialize, scratch_path
from tallyloom.sources import fixtures as fx
from tallyloom.sources import bucketed, exports, ledger, note_files, snapshots

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def reg(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return reg


def _nodes_out(df: DataFrame) -> DataFrame:
    return df.select("repo", "objective", F.col("pos").cast("bigint").alias("pos"), "node_id", "description",
                     "status", "plan_issue", "pr_url", F.array_join("depends_on", ",").alias("depends_on"))


# ---- 2.5 / 2.7 graph -----------------------------------------------------------

@query("first_node_per_id")
def q_first_node_per_id(spark, d):
    return graph.first_node_per_id(fx.nodes(spark, d))


@query("blocked_by")
def q_blocked_by(spark, d):
    return graph.blocked_by(fx.nodes(spark, d))


@query("unblocked_nodes")
def q_unblocked_nodes(spark, d):
    return _nodes_out(graph.unblocked_nodes(fx.nodes(spark, d)))


@query("landable_nodes")
def q_landable_nodes(spark, d):
    return _nodes_out(graph.landable_nodes(fx.nodes(spark, d)))


@query("all_nodes_done")
def q_all_nodes_done(spark, d):
    return graph.all_nodes_done(fx.nodes(spark, d, small=True))


@query("objective_progress")
def q_objective_progress(spark, d):
    return graph.objective_progress(fx.nodes(spark, d))


@query("close_comment")
def q_close_comment(spark, d):
    return graph.close_comment(fx.nodes(spark, d, small=True))


@query("roadmap_table")
def q_roadmap_table(spark, d):
    return graph.roadmap_table(fx.nodes(spark, d))


@query("roadmap_table_parts")
def q_roadmap_table_parts(spark, d):
    return graph.roadmap_table(fx.nodes(spark, d), part_rows=4)


@query("state_comment")
def q_state_comment(spark, d):
    return graph.state_comment(fx.nodes(spark, d))


# ---- 2.1 / 2.4 / 2.5 / 2.7 issue tables ------------------------------------------


AS_OF_ISSUES = "1998-12-31"


def _issue_row(df: DataFrame) -> DataFrame:
    return df.select("repo", "number", "title", "rank", F.date_format("created_at", "yyyy-MM-dd").alias("created"))


@query("scan_issues")
def q_scan_issues(spark, d):
    return iss.scan_issues(fx.issues(spark, d)).select(
        "repo", "number", "title", "body", "state", F.date_format("created_at", "yyyy-MM-dd").alias("created"),
        F.array_join("labels", ",").alias("labels"), "url")


@query("list_open_plans")
def q_list_open_plans(spark, d):
    return _issue_row(iss.open_plans_topk(fx.issues(spark, d), iss.PLAN_LABEL, "OPEN", iss.OPEN_LIST_CAP))


@query("list_open_objectives")
def q_list_open_objectives(spark, d):
    return _issue_row(iss.open_plans_topk(fx.issues(spark, d), iss.OBJECTIVE_LABEL, "OPEN", iss.OPEN_LIST_CAP))


@query("open_plans_topk")
def q_open_plans_topk(spark, d):
    """The closed-list cap: newest 100 closed plans per repo."""
    return _issue_row(iss.open_plans_topk(fx.issues(spark, d), iss.PLAN_LABEL, "CLOSED", iss.CLOSED_LIST_CAP))


@query("unlearned_plans")
def q_unlearned_plans(spark, d):
    return iss.unlearned_plans(fx.issues(spark, d)).select(
        "repo", "number", "title", F.date_format("created_at", "yyyy-MM-dd").alias("created"))


def _event_out(df: DataFrame) -> DataFrame:
    return df.select("repo", "issue", F.date_format("closed_at", "yyyy-MM-dd HH:mm:ss").alias("closed_at"),
                     F.col("seq").cast("bigint").alias("seq"), "closer_type", "pr_number", "pr_state")


@query("latest_close_event")
def q_latest_close_event(spark, d):
    return _event_out(iss.latest_close_event(fx.close_events(spark, d)))


@query("linked_pr")
def q_linked_pr(spark, d):
    return iss.linked_pr(fx.close_events(spark, d), fx.pull_requests(spark, d)).select(
        "repo", "issue", "pr_number", "pr_title", "head_ref")


@query("pr_for_branch")
def q_pr_for_branch(spark, d):
    return iss.pr_for_branch(fx.pull_requests(spark, d)).select(
        "repo", "head_ref", "number", "title", T.first_line(F.col("body")).alias("first_line"))


@query("scan_comments")
def q_scan_comments(spark, d):
    return fx.comments(spark, d)


@query("conversation_of")
def q_conversation_of(spark, d):
    return iss.conversation_of(fx.comments(spark, d))


@query("conversation_parts")
def q_conversation_parts(spark, d):
    return iss.conversation_parts(fx.comments(spark, d)).select("repo", "issue", "seq", "text")


@query("resolve_ref_lists")
def q_resolve_ref_lists(spark, d):
    """Each PR that falls back names its repo's list; of the list, its length and its newest plan."""
    refs, lists = iss.resolve_with_lists(fx.pull_requests(spark, d), fx.issues(spark, d))
    heads = lists.groupBy(F.col("repo").alias("list_repo")).agg(
        F.count(F.lit(1)).alias("n_listed"), F.min_by("number", "rank").alias("newest"))
    return refs.join(heads, "list_repo", "left").select(
        "repo", "pr_number", "ref_issue", "outcome", "list_repo", "n_listed", "newest")


@query("open_plan_lists")
def q_open_plan_lists(spark, d):
    return iss.open_plan_lists(fx.issues(spark, d))


@query("resolve_ref")
def q_resolve_ref(spark, d):
    return iss.resolve_ref(fx.pull_requests(spark, d), fx.issues(spark, d))


@query("reference_edges")
def q_reference_edges(spark, d):
    return iss.reference_edges(fx.issues(spark, d), fx.pull_requests(spark, d), fx.nodes(spark, d)).select(
        "kind", "repo", "from_number", "to_number", "matched")


@query("plan_links")
def q_plan_links(spark, d):
    return iss.plan_links(fx.issues(spark, d))


@query("plan_listing")
def q_plan_listing(spark, d):
    return iss.plan_listing(fx.issues(spark, d), AS_OF_ISSUES, k=iss.OPEN_LIST_CAP)


@query("closed_only")
def q_closed_only(spark, d):
    return iss.closed_only(fx.issues(spark, d))


# ---- 2.1 / 2.2 / 2.3 / 2.5 / 2.6 / 2.8 / 2.9 notes ----------------------------------------


AS_OF_NOTES = "2024-02-01"


def _scanned(spark, d):
    return nt.scan_notes(nt.render_notes(fx.notes(spark, d)))


def _ids_txt(c):
    return F.array_join(F.transform(c, lambda x: x.cast("string")), ",")


def _tw_txt(c):
    return F.array_join(F.transform(c, lambda t: F.concat(t["action"], F.lit("=>"), t["warning"])), "|")


def _notes_out(df: DataFrame, *more: str) -> DataFrame:
    return df.select(*nt.NOTE_KEY, "title", F.array_join("read_when", "|").alias("read_when"),
                     _tw_txt(F.col("tripwires")).alias("tripwires"),
                     F.date_format("last_updated", "yyyy-MM-dd").alias("last_updated"),
                     _ids_txt(F.col("source_issues")).alias("source_issues"), "body", *more)


@query("render_notes")
def q_render_notes(spark, d):
    return nt.render_notes(fx.notes(spark, d))


@query("scan_notes")
def q_scan_notes(spark, d):
    return _scanned(spark, d).select("repo", "category", "slug", "rank", "content")


@query("note_files")
def q_note_files(spark, d):
    """All notes written as files, then read back from them."""
    root = scratch_path(spark, "notes")
    note_files.write_note_files(nt.render_notes(fx.notes(spark, d)), root)
    return nt.scan_notes(nt.read_note_folder(spark, root)).select("repo", "category", "slug", "rank", "path", "content")


def _stored_notes(spark, d):
    """The note table as a versioned snapshot, a partition for each repo and category."""
    root = scratch_path(spark, "note-table")
    snapshots.write_snapshot(fx.notes(spark, d).drop("content"), root, ["repo", "category"])
    return root


def _upserted(spark, d):
    """A snapshot of the notes, then a version in which a quarter of the learning items (those of
    the repos r0 and r4) changed only the partitions they touch."""
    root = _stored_notes(spark, d)
    items = fx.learning_items(spark, d).filter(F.col("repo").isin("r0", "r4"))
    touched = items.select("repo", "category").distinct()
    now = nt.upsert_notes(snapshots.read_snapshot(spark, root, 1, touched), items, AS_OF_NOTES)
    snapshots.replace_partitions(now.drop("change"), root, touched, 1)
    return root


@query("upsert_snapshot")
def q_upsert_snapshot(spark, d):
    return _notes_out(snapshots.read_snapshot(spark, _upserted(spark, d)))


@query("snapshot_partitions")
def q_snapshot_partitions(spark, d):
    """Which partitions the second version shares with the first, with their rows."""
    root = _upserted(spark, d)
    old = snapshots.partition_files(spark, root, 1).select("repo", "category", F.col("folder").alias("_old"))
    return snapshots.partition_files(spark, root, 2).join(old, ["repo", "category"], "left").select(
        "repo", "category", "rows", F.coalesce(F.col("folder") == F.col("_old"), F.lit(False)).alias("shared"))


@query("ordered_notes")
def q_ordered_notes(spark, d):
    return nt.ordered_notes(_scanned(spark, d)).select("repo", "category", "slug", "ord")


@query("notes_digest")
def q_notes_digest(spark, d):
    return nt.notes_digest(_scanned(spark, d)).select("repo", "part", "n_items", "digest")


@query("notes_digest_parts")
def q_notes_digest_parts(spark, d):
    """The digest in small parts: notes longer than a part span several."""
    return nt.notes_digest(_scanned(spark, d), part_chars=1500).select("repo", "part", "n_items", "digest")


@query("hooks_concat")
def q_hooks_concat(spark, d):
    return nt.hooks_concat(fx.hooks(spark, d)).select("repo", "part", "n_items", "hooks")


@query("routing_index")
def q_routing_index(spark, d):
    return nt.routing_rows(_scanned(spark, d)).select("repo", "category", "slug", "file", "title",
                                                      "read_when", "line")


@query("routing_index_text")
def q_routing_index_text(spark, d):
    """Each repo's index text, in small parts; repos without notes say so."""
    size = fx.read_table(spark, d, "part", ["p_size"])
    repos = size.select(F.concat(F.lit("r"), (F.col("p_size") % 12).cast("string")).alias("repo"))
    return nt.routing_index_text(_scanned(spark, d), part_chars=700, repos=repos)


def _changed_notes(spark, d):
    """The notes after the learning items of r0 and r4, less every ninth document's note of r4; the keys that changed."""
    notes = fx.notes(spark, d).drop("content")
    items = fx.learning_items(spark, d).filter(F.col("repo").isin("r0", "r4"))
    gone = (F.col("repo") == "r4") & (F.substring("slug", 2, 20).cast("bigint") % 9 == 0)
    after = nt.upsert_notes(notes, items, AS_OF_NOTES).drop("change").filter(~gone)
    keys = items.select(*nt.NOTE_KEY).unionByName(notes.filter(gone).select(*nt.NOTE_KEY))
    return notes, after, keys.distinct()


@query("index_view")
def q_index_view(spark, d):
    """The index in parts, built once and then brought up to date from a change set."""
    notes, after, keys = _changed_notes(spark, d)
    root = scratch_path(spark, "index-view")
    views.build(views.index_pieces(nt.scan_notes(nt.render_notes(notes))), root, digits=1)
    changed = keys.filter(F.col("category").isin(T.CATEGORIES)).select("repo", "category", nt.file_name().alias("name"))
    touched = after.join(changed.select("repo", "category").distinct(), ["repo", "category"], "left_semi")
    views.update(views.index_pieces(nt.scan_notes(nt.render_notes(touched))), changed, root, digits=1)
    return views.parts(spark, root).select("repo", "category", "start", "n_items", "text")


@query("catalog_update")
def q_catalog_update(spark, d):
    """The note catalog brought up to date: only changed notes are parsed."""
    notes, after, keys = _changed_notes(spark, d)
    old = nt.note_catalog(nt.scan_notes(nt.render_notes(notes)))
    out = views.update_catalog(old, nt.scan_notes(nt.render_notes(after)), keys)
    return out.select("repo", "category", "slug", "title", F.array_join("read_when", "|").alias("read_when"),
                      T.iso_date(F.col("last_updated")).alias("last_updated"),
                      _ids_txt(F.col("source_issues")).alias("source_issues"))


@query("note_catalog")
def q_note_catalog(spark, d):
    c = nt.note_catalog(_scanned(spark, d))
    return c.select("repo", "category", "slug", "title", F.array_join("read_when", "|").alias("read_when"),
                    F.date_format("last_updated", "yyyy-MM-dd").alias("last_updated"),
                    _ids_txt(F.col("source_issues")).alias("source_issues"), "body")


@query("audit_prompt")
def q_audit_prompt(spark, d):
    return nt.audit_prompt(_scanned(spark, d)).select("repo", "part", "n_items", "files")


@query("audit_prompt_parts")
def q_audit_prompt_parts(spark, d):
    return nt.audit_prompt(_scanned(spark, d), part_chars=2048).select("repo", "part", "n_items", "files")


@query("union_issues")
def q_union_issues(spark, d):
    items = fx.learning_items(spark, d)
    agg = items.groupBy(*nt.NOTE_KEY).agg(F.collect_set("issue").alias("new"))
    old = fx.notes(spark, d).select(*nt.NOTE_KEY, "source_issues")
    j = agg.join(old, nt.NOTE_KEY, "left")
    ids = nt.union_issues(F.coalesce("source_issues", F.array().cast("array<bigint>")), F.col("new"))
    return j.select(*nt.NOTE_KEY, _ids_txt(ids).alias("source_issues"))


@query("upsert_notes")
def q_upsert_notes(spark, d):
    return _notes_out(nt.upsert_notes(fx.notes(spark, d), fx.learning_items(spark, d), AS_OF_NOTES), "change")


@query("compact_merge")
def q_compact_merge(spark, d):
    m = nt.compact_merge(fx.notes(spark, d), fx.audit_actions(spark, d), AS_OF_NOTES)
    return m.select(*nt.NOTE_KEY, "n_sources", _ids_txt(F.col("source_issues")).alias("source_issues"),
                    "body_replaced", "content")


BUCKETS = 16


def _bucketed_notes(spark, d):
    """The note table in buckets of its key, as a table of the session's catalog."""
    df = fx.notes(spark, d)
    path = scratch_path(spark, "notes_in_buckets")
    return bucketed.write_bucketed(df, path.rsplit("/", 1)[1].replace("-", "_"), path, nt.NOTE_KEY, BUCKETS)


@query("upsert_notes_bucketed")
def q_upsert_notes_bucketed(spark, d):
    u = nt.upsert_notes(_bucketed_notes(spark, d), fx.learning_items(spark, d), AS_OF_NOTES, BUCKETS)
    return _notes_out(u, "change")


@query("compact_merge_bucketed")
def q_compact_merge_bucketed(spark, d):
    m = nt.compact_merge(_bucketed_notes(spark, d), fx.audit_actions(spark, d), AS_OF_NOTES, buckets=BUCKETS)
    return m.select(*nt.NOTE_KEY, "n_sources", _ids_txt(F.col("source_issues")).alias("source_issues"),
                    "body_replaced", "content")


@query("compact_delete_bucketed")
def q_compact_delete_bucketed(spark, d):
    return nt.compact_delete(_bucketed_notes(spark, d), fx.audit_actions(spark, d), on_orphan="drop", buckets=BUCKETS)


@query("audit_coverage_bucketed")
def q_audit_coverage_bucketed(spark, d):
    known = _bucketed_notes(spark, d).filter(F.col("category").isin(T.CATEGORIES))
    return nt.audit_coverage(known, fx.audit_actions(spark, d), BUCKETS)


@query("compact_merge_chains")
def q_compact_merge_chains(spark, d):
    """Merges that follow their chains to the end."""
    m = nt.compact_merge(fx.notes(spark, d), fx.audit_actions(spark, d), AS_OF_NOTES, chains="follow")
    return m.select(*nt.NOTE_KEY, "n_sources", _ids_txt(F.col("source_issues")).alias("source_issues"), "body_replaced")


@query("merge_chains")
def q_merge_chains(spark, d):
    """Where the chain of each merged note ends, after how many merges."""
    return nt.merge_targets(fx.notes(spark, d), fx.audit_actions(spark, d))[0]


@query("source_issue_rows")
def q_source_issue_rows(spark, d):
    """Source issues of all notes as rows, after the learning items."""
    return nt.upsert_source_issues(nt.source_issue_rows(fx.notes(spark, d)), fx.learning_items(spark, d))


def _audit_decoded(spark, d):
    """Audit replies decoded to actions; pos is their order: reply, then place in it."""
    rows, _ = ex.decode_replies(fx.audit_replies(spark, d), key=["repo", "reply_no"], kind="actions")
    return rows.withColumn("pos", F.col("reply_no") * 1000 + F.col("item_pos"))


@query("decode_actions")
def q_decode_actions(spark, d):
    return _audit_decoded(spark, d).select("repo", "reply_no", "item_pos", "action", "category", "slug", "reason",
                                           "target_category", "target_slug", "target_updated_body")


@query("action_rejects")
def q_action_rejects(spark, d):
    return ex.decode_replies(fx.audit_replies(spark, d), key=["repo", "reply_no"], kind="actions")[1]


@query("audit_to_compaction")
def q_audit_to_compaction(spark, d):
    """From the auditor's replies to the compacted notes, in one job."""
    notes = fx.notes(spark, d).drop("content")
    actions = _audit_decoded(spark, d).select("repo", "pos", "action", "category", "slug", "reason", "target_category",
                                              "target_slug", "target_updated_body")
    out = nt.apply_compaction(notes, materialize(actions, "audit-actions"), AS_OF_NOTES)
    return out.select(*nt.NOTE_KEY, _ids_txt(F.col("source_issues")).alias("source_issues"),
                      T.iso_date(F.col("last_updated")).alias("last_updated"), "body")


@query("compact_delete")
def q_compact_delete(spark, d):
    """Reference behaviour (``on_orphan='drop'``)."""
    return nt.compact_delete(fx.notes(spark, d), fx.audit_actions(spark, d), on_orphan="drop")


@query("orphan_merges")
def q_orphan_merges(spark, d):
    return nt.orphan_merges(fx.notes(spark, d), fx.audit_actions(spark, d))


@query("audit_coverage")
def q_audit_coverage(spark, d):
    return nt.audit_coverage(_scanned(spark, d), fx.audit_actions(spark, d))


@query("action_counts")
def q_action_counts(spark, d):
    return nt.action_counts(fx.audit_actions(spark, d))


@query("content_drift")
def q_content_drift(spark, d):
    exp, act = fx.manifests(spark, d)
    return nt.content_drift(exp, act)


def _trees(spark, d):
    roots = [scratch_path(spark, "tree") for _ in range(2)]
    for files, root in zip(fx.trees(spark, d), roots, strict=True):
        trees.store_tree(files, root, depth=3)
    return roots


@query("tree_drift")
def q_tree_drift(spark, d):
    """Drift of a large tree: texts are read only in the subtrees whose hashes differ."""
    return trees.tree_drift(spark, *_trees(spark, d), depth=3)


@query("tree_nodes")
def q_tree_nodes(spark, d):
    """The lowest nodes that differ."""
    return trees.differing_nodes(spark, *_trees(spark, d), depth=3)


@query("managed_block")
def q_managed_block(spark, d):
    out = nt.managed_block(fx.managed(spark, d).select("page_id", "repo", "text"), fx.notes(spark, d))
    return out.select("page_id", "repo", "action", F.length("text").cast("bigint").alias("text_len"),
                      F.sha2("text", 256).alias("text_sha"))


@query("marker_span")
def q_marker_span(spark, d):
    return fx.managed(spark, d).select("page_id", T.marker_span(F.col("html"), "<!-- ad ", " -->").alias("span"))


# ---- 2.3 text extraction jobs ----------------------------------------------------------


AS_OF_EVENTS = fx.AS_OF_EVENTS


def _stored_bodies(spark, d):
    """Objective bodies after a roadmap rewrite: they carry the state blob."""
    n = fx.nodes(spark, d, checkpoint=True)
    return ex.rewrite_roadmap(fx.objective_bodies(spark, d, n), n)


@query("extract_roadmaps")
def q_extract_roadmaps(spark, d):
    nodes, _ = ex.extract_roadmaps(fx.objective_bodies(spark, d))
    return _nodes_out(nodes)


def _faulty(kinds: dict, column: str):
    """The column with other texts where objective modulo 7 says so."""
    out = F.col(column)
    for k, text in kinds.items():
        out = F.when(F.col("objective") % 7 == k, text).otherwise(out)
    return out


@query("roadmap_rejects")
def q_roadmap_rejects(spark, d):
    """Bodies without a roadmap, or with one that lists nothing."""
    body = _faulty({3: F.replace("body", F.lit("## Roadmap"), F.lit("## Plan")),
                    5: F.lit("## Goal\nx\n\n## Roadmap\nnothing listed yet\n")}, "body")
    return ex.extract_roadmaps(fx.objective_bodies(spark, d).withColumn("body", body))[1]


@query("node_state_rejects")
def q_node_state_rejects(spark, d):
    """Bodies without a state blob, or with one that is cut, of a wrong type or status."""
    blobs = graph.state_comment(fx.nodes(spark, d)).withColumnRenamed("blob", "body")
    body = _faulty({2: F.lit("no state here"), 3: F.lit('<!-- loom:nodes [{"id":"a" -->'),
                    5: F.replace("body", F.lit('"id":"'), F.lit('"id":7,"was":"')),
                    6: F.lit('<!-- loom:nodes [{"id":"a","description":"b","status":"lost","depends_on":[]}] -->')}, "body")
    return ex.load_node_state(blobs.withColumn("body", body))[1]


@query("load_node_state")
def q_load_node_state(spark, d):
    nodes, _ = ex.load_node_state(_stored_bodies(spark, d))
    return _nodes_out(nodes)


@query("node_state_round_trip")
def q_node_state_round_trip(spark, d):
    """State blobs in parts of three nodes, read back."""
    blobs = graph.state_comment(fx.nodes(spark, d), part_rows=3).withColumnRenamed("blob", "body")
    nodes, _ = ex.load_node_state(blobs)
    return _nodes_out(nodes)


@query("rewrite_roadmap")
def q_rewrite_roadmap(spark, d):
    return _stored_bodies(spark, d).select("repo", "objective", "part", "title", "body")


@query("rewrite_roadmap_parts")
def q_rewrite_roadmap_parts(spark, d):
    """Objective bodies of parts of three nodes."""
    n = fx.nodes(spark, d, checkpoint=True)
    return ex.rewrite_roadmap(fx.objective_bodies(spark, d, n), n, part_rows=3).select(
        "repo", "objective", "part", "title", "body")


@query("section_coverage")
def q_section_coverage(spark, d):
    return ex.section_coverage(fx.plan_bodies(spark, d))


@query("decode_replies")
def q_decode_replies(spark, d):
    rows, _ = ex.decode_replies(fx.replies(spark, d))
    return rows.select("id", "item_pos", "category", "slug", "title",
                       F.array_join("read_when", "|").alias("read_when"),
                       _tw_txt(F.col("tripwires")).alias("tripwires"), "body")


@query("reply_rejects")
def q_reply_rejects(spark, d):
    _, rej = ex.decode_replies(fx.replies(spark, d))
    return rej


@query("age_histogram")
def q_age_histogram(spark, d):
    return ex.age_histogram(fx.dated(spark, d), "ts", AS_OF_EVENTS)


@query("truncation_report")
def q_truncation_report(spark, d):
    return ex.truncation_report(fx.plan_bodies(spark, d).select("lang", F.col("body").alias("text")),
                                "lang", "text")


# ---- 2.4 / 2.6 / 2.9 life cycle, 2.11 prompts -----------------------------------------------


@query("plan_guard")
def q_plan_guard(spark, d):
    return lc.plan_guard(fx.nodes(spark, d))


def _created_urls(unblocked: DataFrame) -> DataFrame:
    k = F.col("node_id").cast("bigint")
    url = F.concat(F.lit("https://host/"), F.col("repo"), F.lit("/issues/"),
                   F.when(k % 50 == 0, F.lit("pending")).otherwise((k + 2000000).cast("string")))
    return unblocked.select(*lc.NODE_KEY, url.alias("url"))


@query("start_nodes")
def q_start_nodes(spark, d):
    n = fx.nodes(spark, d)
    started, _ = lc.start_nodes(n, _created_urls(graph.unblocked_nodes(n)))
    rows = lc.plan_issue_rows(started).select(*lc.NODE_KEY, "title", "body")
    return started.join(rows, lc.NODE_KEY).select(*lc.NODE_KEY, "node_id", "status", "plan_issue", "title", "body")


@query("finish_nodes")
def q_finish_nodes(spark, d):
    i = fx.issues(spark, d)
    landed = i.filter((F.col("state") == "CLOSED") & F.array_contains("labels", "plan"))
    return lc.finish_nodes(fx.nodes(spark, d), landed)


@query("close_objectives")
def q_close_objectives(spark, d):
    return lc.close_objectives(fx.nodes(spark, d, small=True), fx.issues(spark, d))


@query("create_objectives")
def q_create_objectives(spark, d):
    created, _ = lc.create_objectives(fx.objective_bodies(spark, d))
    return created.select("repo", "objective", "part", "title", "body")


@query("create_plans")
def q_create_plans(spark, d):
    drafts = fx.plan_bodies(spark, d).select(
        "doc_id", F.concat(F.lit("Draft "), F.col("doc_id").cast("string")).alias("title"), "body")
    return lc.create_plans(drafts).select("doc_id", "title", "n_missing",
                                          F.array_join("missing", ", ").alias("missing"))


def _turns(spark, d):
    i = fx.issues(spark, d).select("repo", "number")
    cv = fx.read_table(spark, d, "conversations", ["conv_id", "turn", "text"])
    turns = i.join(cv, i.number == cv.conv_id).select("repo", "number", F.col("turn").alias("seq"),
                                                      F.col("text").alias("conversation"))
    return turns


@query("attach_conversation")
def q_attach_conversation(spark, d):
    """Comments of at most 700 characters of conversation."""
    return lc.attach_conversation(_turns(spark, d), comment_chars=700)


@query("conversation_round_trip")
def q_conversation_round_trip(spark, d):
    """Whole conversations written as comments and read back, beside comments of other kinds."""
    told = lc.attach_conversation(_turns(spark, d), comment_chars=300)
    # the host numbers comments in the order they come, here behind others
    other = fx.issues(spark, d).select("repo", F.col("number").alias("issue"), F.lit(0).cast("bigint").alias("seq"),
                                       F.lit("on it").alias("body"))
    table = told.withColumn("seq", F.col("seq") + 1).unionByName(other)
    return iss.conversation_of(table).select("repo", "issue", "conversation")


def _decoded(spark, d):
    """Replies to issues, keyed by (repo, issue)."""
    asked = fx.issues(spark, d).select("repo", F.col("number").alias("issue"))
    told = asked.join(fx.replies(spark, d).withColumnRenamed("id", "issue"), "issue")
    return ex.decode_replies(told, key=["repo", "issue"])


@query("mark_learned")
def q_mark_learned(spark, d):
    rows, _ = _decoded(spark, d)
    learned = rows.select("repo", F.col("issue").alias("number")).distinct()
    return lc.mark_learned(fx.issues(spark, d), learned).select(
        "repo", "number", F.array_join("labels", ",").alias("labels"))


def _outcomes(spark, d):
    i = fx.issues(spark, d)
    plans = iss.unlearned_plans(i).select("repo", F.col("number").alias("issue"))
    numbers = fx.pull_requests(spark, d).select("repo", F.col("number").alias("pr_number"))
    linked = iss.linked_keys(fx.close_events(spark, d)).join(numbers.hint("merge"), ["repo", "pr_number"]).select(
        "repo", "issue", F.lit(True).alias("_pr"))
    rows, rej = _decoded(spark, d)
    key = ["repo", "issue"]
    got = rows.select(*key).distinct().withColumn("_ok", F.lit(True))
    bad = rej.select(*key).withColumn("_bad", F.lit(True))
    j = plans.join(linked, key, "left").join(got, key, "left").join(bad, key, "left")
    outcome = (F.when(F.col("_pr").isNull() | F.col("_bad").isNotNull(), "failed")
               .when(F.col("_ok").isNotNull(), "learned").otherwise("nothing_found"))
    return j.select("repo", F.col("issue").alias("number"), outcome.alias("outcome"))


@query("batch_summary")
def q_batch_summary(spark, d):
    return lc.batch_summary(_outcomes(spark, d))


@query("batch_status")
def q_batch_status(spark, d):
    """The batch published, its counts observed while it was written, and the status it ends with."""
    version, n = lc.publish_outcomes(_outcomes(spark, d), scratch_path(spark, "batch"), raise_on_failure=False)
    status = f"{n['failed']} issue(s) failed" if n["failed"] else "ok"
    rows = [(version, n["learned"], n["nothing_found"], n["failed"], status)]
    return spark.createDataFrame(rows, "version long, n_learned long, n_nothing_found long, n_failed long, status string")


@query("land_nodes")
def q_land_nodes(spark, d):
    """Landing objectives: three quarters of the open plans were run; failed ones leave their node."""
    rows, rej = _decoded(spark, d)
    key = ["repo", "issue"]
    ran = fx.issues(spark, d).filter("state = 'OPEN' and number % 4 <> 3").select("repo", F.col("number").alias("issue"))
    j = (ran.join(rows.select(*key).distinct().withColumn("_ok", F.lit(True)), key, "left")
         .join(rej.select(*key).withColumn("_bad", F.lit(True)), key, "left"))
    outcome = F.when(F.col("_bad"), "failed").when(F.col("_ok"), "learned").otherwise("nothing_found")
    told = j.select("repo", (F.col("issue") + 1000000).alias("number"), outcome.alias("outcome"))
    return lc.land_nodes(fx.nodes(spark, d), told)


def _ledger(spark, d):
    """A ledger seeded from the label, then a batch that is run twice; what each added."""
    root, issues = scratch_path(spark, "ledger"), fx.issues(spark, d)
    learned = _decoded(spark, d)[0].select("repo", F.col("issue").alias("number"))
    added = [ledger.seed(issues, root, "2024-01-01"), *(ledger.append(learned, root, f"2024-01-0{k}") for k in (2, 3))]
    return root, added


@query("ledger_unlearned")
def q_ledger_unlearned(spark, d):
    root, _ = _ledger(spark, d)
    return ledger.unlearned_plans(fx.issues(spark, d), root).select("repo", "number", "title")


@query("ledger_runs")
def q_ledger_runs(spark, d):
    """What each run added to the ledger; the third repeats the second."""
    root, added = _ledger(spark, d)
    runs = spark.createDataFrame([(i + 1, f"2024-01-0{i + 1}", n) for i, n in enumerate(added)], "run long, on string, told long")
    held = ledger.read(spark, root).groupBy(T.iso_date(F.col("learned_on")).alias("on")).agg(F.count(F.lit(1)).alias("n"))
    return runs.join(held, "on", "left").select("run", "told", F.coalesce("n", F.lit(0)).alias("held"))


@query("issue_list_text")
def q_issue_list_text(spark, d):
    learned = _outcomes(spark, d).filter(F.col("outcome") == "learned")
    return lc.issue_list_text(learned).select("repo", "part", "n_items", "issues")


def _context(spark, d):
    i = fx.issues(spark, d)
    return pr.learn_context(iss.unlearned_plans(i), fx.close_events(spark, d), fx.pull_requests(spark, d),
                            fx.comments(spark, d))


def _sha(c):
    return F.sha2(F.col(c), 256).alias(f"{c}_sha")


@query("learn_context")
def q_learn_context(spark, d):
    ctx, _ = _context(spark, d)
    return ctx.select("repo", "issue", "pr_number", _sha("issue_title"), _sha("issue_body"), _sha("pr_title"),
                      _sha("pr_body"), _sha("conversation"), _sha("diff"))


@query("learn_context_rejects")
def q_learn_context_rejects(spark, d):
    return _context(spark, d)[1]


@query("learn_prompt")
def q_learn_prompt(spark, d):
    ctx, _ = _context(spark, d)
    parts = pr.learn_prompt(ctx, _repo_segments(spark, d))
    return parts.select("repo", "issue", "seg", "kind", F.length("text").cast("bigint").alias("n_chars"), _sha("text"))


def _repo_segments(spark, d):
    return pr.repo_segments(_scanned(spark, d), fx.hooks(spark, d))


@query("repo_segments")
def q_repo_segments(spark, d):
    """All note and hook texts that the prompts refer to."""
    return _repo_segments(spark, d).select("repo", "kind", "rank", "name", F.length("text").cast("bigint").alias("n_chars"),
                                           _sha("text"))


@query("start_nodes_snapshot")
def q_start_nodes_snapshot(spark, d):
    n = fx.nodes(spark, d)
    return _nodes_out(lc.apply_started(n, _created_urls(graph.unblocked_nodes(n))))


@query("finish_nodes_snapshot")
def q_finish_nodes_snapshot(spark, d):
    i, n = fx.issues(spark, d), fx.nodes(spark, d)
    landed = i.filter((F.col("state") == "CLOSED") & F.array_contains("labels", "plan"))
    return _nodes_out(lc.apply_finished(n, lc.finish_nodes(n, landed)))


@query("learned_snapshot")
def q_learned_snapshot(spark, d):
    rows, _ = _decoded(spark, d)
    learned = rows.select("repo", F.col("issue").alias("number"))
    return lc.apply_learned(fx.issues(spark, d), learned).select(
        "repo", "number", "state", F.array_join("labels", ",").alias("labels"))


@query("node_plan_prompt")
def q_node_plan_prompt(spark, d):
    """The whole prompt of each unblocked node; the bodies and the blocking join read the same stored nodes."""
    n = fx.nodes(spark, d, checkpoint=True)
    out = pr.node_plan_text(graph.unblocked_nodes(n), fx.objective_bodies(spark, d, n))
    return out.select("repo", "objective", "pos", "node_id", F.length("prompt").cast("bigint").alias("prompt_chars"), _sha("prompt"))


@query("objective_segments")
def q_objective_segments(spark, d):
    """The titles and bodies that node prompts refer to."""
    out = pr.objective_segments(fx.objective_bodies(spark, d))
    return out.select("repo", "objective", "kind", F.length("text").cast("bigint").alias("n_chars"), _sha("text"))


@query("iso_date")
def q_iso_date(spark, d):
    return fx.dated(spark, d).groupBy(T.iso_date(F.col("ts")).alias("day")).agg(F.count(F.lit(1)).alias("n"))


# ---- 2.1 exports of the code host, written and read back -------------------------------------


def _export(df: DataFrame, name: str) -> str:
    """The export as JSON lines, compressed: diffs and comments are most of it."""
    path = scratch_path(df.sparkSession, f"export-{name}")
    lines = df.select(F.to_json(F.struct("repo", "line.*"), {"ignoreNullFields": "false"}).alias("value"))
    lines.write.text(path, compression="gzip")
    return path


@query("issue_export")
def q_issue_export(spark, d):
    path = _export(fx.issue_export(spark, d), "issues")
    return exports.read_issue_export(spark, path).select(
        "repo", "number", "title", "body", "state", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created"),
        F.array_join("labels", ",").alias("labels"), "url")


@query("pr_export")
def q_pr_export(spark, d):
    return exports.read_pr_export(spark, _export(fx.pr_export(spark, d), "prs")).select(
        "repo", "number", "head_ref", "body", "title", F.length("diff").cast("bigint").alias("diff_chars"), "state")


@query("close_event_export")
def q_close_event_export(spark, d):
    return _event_out(exports.read_close_event_export(spark, _export(fx.close_event_export(spark, d), "events")))


@query("comment_export")
def q_comment_export(spark, d):
    return exports.read_comment_export(spark, _export(fx.comment_export(spark, d), "comments"))



@query("dangling_dependencies")
def q_dangling_dependencies(spark, d):
    return graph.dangling_dependencies(fx.nodes(spark, d))


@query("note_issue_index")
def q_note_issue_index(spark, d):
    return nt.notes_by_issue(nt.note_catalog(_scanned(spark, d)))


@query("visible_body")
def q_visible_body(spark, d):
    """Stored objective bodies as the view shows them (state-blob lines dropped)."""
    return _stored_bodies(spark, d).select("repo", "objective", "part", T.visible_body(F.col("body")).alias("body"))
