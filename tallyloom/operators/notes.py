"""Categorised note table: scan, digest, routing index, catalog, upsert,
two-pass compaction, coverage checks and managed text blocks.

Notes are keyed by ``(repo, category, slug)``; a note's file is
``<category>/<slug>.md`` under a per-repo root. Typed columns are the truth;
Markdown ``content`` is rendered from them (or, for compaction, edited line by
line the way the source tool edits files).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import text as T
from tallyloom.functions import ordering
from tallyloom.functions.ordering import ordered_text_parts, ordinal_within_group
from tallyloom.functions.note_text import render_note_content
from tallyloom.session import materialize
from tallyloom.sources.bucketed import dealt
from tallyloom.sources.note_files import published_folders

# ---- fixed values ------------------------------------------------------------
EMPTY_READ_WHEN = "—"
INDEX_HEADER = "| File | Title | Read when |\n|------|-------|-----------|"
NO_LEARNINGS = "_No learnings yet._"
NONE_YET = "_none yet_"
# ------------------------------------------------------------------------------

NOTE_KEY = ["repo", "category", "slug"]
MEMORY_ROOT = "memory"
# Repo-level texts (digest, index, audit prompt) are cut into parts of this many characters.
PART_CHARS = ordering.PART_CHARS


def category_rank(categories=T.CATEGORIES) -> Column:
    return F.array_position(F.array(*[F.lit(c) for c in categories]), F.col("category"))


def file_name() -> Column:
    return F.concat(F.col("slug"), F.lit(".md"))


def note_path(root: str = MEMORY_ROOT) -> Column:
    return F.concat(F.lit(root + "/"), F.col("category"), F.lit("/"), F.col("slug"), F.lit(".md"))


# ---- sinks / sources -----------------------------------------------------------

def render_notes(notes: DataFrame) -> DataFrame:
    """Typed notes -> Markdown files table (repo, category, slug, path, content)."""
    content = render_note_content(F.col("title"), F.col("read_when"), F.col("tripwires"),
                                  F.col("last_updated"), F.col("source_issues"), F.col("body"))
    return notes.select(*NOTE_KEY, F.concat(F.col("category"), F.lit("/"), file_name()).alias("path"),
                        content.alias("content"))


NOTE_FILE = "repo string, path string, content string"


def read_note_folder(spark, root: str) -> DataFrame:
    """Markdown note files under ``root/<repo>/<category>/<slug>.md`` as a files
    table (repo, path, content); each file is one row (whole text; Spark's scans
    pass over files of no bytes, which hold no note). Of a folder that
    ``note_files`` wrote, the published files."""
    folders = published_folders(spark, root)
    if folders == []:
        return spark.createDataFrame([], NOTE_FILE)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.md")
    df = reader.load(folders or root)
    return df.select(F.regexp_extract("path", r"([^/]+)/[^/]+/[^/]+$", 1).alias("repo"),
                     F.regexp_extract("path", r"([^/]+/[^/]+)$", 1).alias("path"),
                     F.col("content").cast("string").alias("content"))


def scan_notes(files: DataFrame, categories=T.CATEGORIES) -> DataFrame:
    """Files table -> note rows of the known categories, ``.md`` only, with
    their category rank (the read order is rank, then file name)."""
    f = files.select("repo", F.regexp_extract("path", r"(?:^|/)([^/]+)/[^/]+$", 1).alias("category"),
                     F.regexp_extract("path", r"([^/]+)\.md$", 1).alias("slug"), "path", "content")
    # a ``.md`` extension needs a non-empty name before it (".md" alone has none)
    f = f.filter(F.col("path").rlike(r"(?:^|/)[^/]+\.md$") & F.col("category").isin(list(categories)))
    return f.withColumn("rank", category_rank(categories).cast("bigint"))


def ordered_notes(scanned: DataFrame) -> DataFrame:
    """Read order per repo (category rank, then file name) as an ordinal."""
    return ordinal_within_group(scanned, ["repo"], [F.col("rank"), file_name()], "ord")


def _with_empty_repos(parts: DataFrame, repos: DataFrame | None, text: str, empty: str) -> DataFrame:
    """Give every listed repo without notes one part 0 holding ``empty``."""
    if repos is None:
        return parts
    missing = repos.select("repo").distinct().join(parts.select("repo"), "repo", "left_anti")
    filler = missing.select("repo", F.lit(0).cast("bigint").alias("part"), F.lit(0).cast("bigint").alias("n_items"),
                            F.lit(None).cast("bigint").alias("first_ord"), F.lit(empty).alias(text))
    return parts.unionByName(filler)


def digest_piece() -> Column:
    """One note in a digest: ``### [cat/slug]``, the file text, a blank line."""
    return F.concat(F.lit("### ["), F.col("category"), F.lit("/"), F.col("slug"), F.lit("]\n"),
                    F.col("content"), F.lit("\n\n"))


def hook_texts(hooks: DataFrame) -> DataFrame:
    """Hook files that count: ``.md``, not README.md."""
    return hooks.filter(F.col("path").rlike(r"(?:^|/)[^/]+\.md$") & (F.col("path") != "README.md"))


def notes_digest(scanned: DataFrame, part_chars: int = PART_CHARS, repos: DataFrame | None = None) -> DataFrame:
    """``### [cat/slug]\ncontent\n\n`` per note, concatenated in read order;
    a listed repo without notes gets the empty text."""
    parts = ordered_text_parts(scanned, ["repo"], [F.col("rank"), file_name()], digest_piece(), "", part_chars, "digest")
    return _with_empty_repos(parts, repos, "digest", "")


def hooks_concat(hooks: DataFrame, part_chars: int = PART_CHARS) -> DataFrame:
    """Prompt-hook texts in path order, ``.md`` only, README.md skipped,
    joined by a blank line."""
    return ordered_text_parts(hook_texts(hooks), ["repo"], ["path"], F.col("text"), "\n\n", part_chars, "hooks")


def routing_rows(scanned: DataFrame, root: str = MEMORY_ROOT) -> DataFrame:
    """One routing row per note: file, title (falls back to slug), read-when."""
    title = F.coalesce(T.fm_field(F.col("content"), "title"), F.col("slug"))
    rw_txt = T.once(T.fm_list(F.col("content"), "read_when"), lambda rw: F.when(
        F.size(rw) == 0, F.lit(EMPTY_READ_WHEN)).otherwise(F.array_join(rw, "; ")))
    f = F.concat(F.lit("@" + root + "/"), F.col("category"), F.lit("/"), F.col("slug"), F.lit(".md"))
    out = scanned.select("repo", "category", "slug", "rank", f.alias("file"), title.alias("title"),
                         rw_txt.alias("read_when"))
    return out.withColumn("line", F.concat(F.lit("| "), F.col("file"), F.lit(" | "), F.col("title"),
                                           F.lit(" | "), F.col("read_when"), F.lit(" |")))


def routing_index_text(scanned: DataFrame, part_chars: int = PART_CHARS,
                       repos: DataFrame | None = None) -> DataFrame:
    """The index table per repo (its text begins with the header); a listed repo
    without notes gets ``_No learnings yet._``."""
    t = ordered_text_parts(routing_rows(scanned), ["repo"], [F.col("rank"), file_name()],
                           F.concat("line", F.lit("\n")), "", part_chars, "index_text", lead=INDEX_HEADER + "\n")
    return _with_empty_repos(t, repos, "index_text", NO_LEARNINGS + "\n").drop("first_ord")


def note_catalog(scanned: DataFrame) -> DataFrame:
    """Parse each note's front matter into typed columns."""
    c = F.col("content")
    rest = T.fm_rest(c)
    body = F.regexp_replace(F.regexp_replace(rest, r"\A\n+", ""), r"\n\z", "")
    return scanned.select(
        "repo", "category", "slug",
        T.fm_field(c, "title").alias("title"),
        T.fm_list(c, "read_when").alias("read_when"),
        F.try_to_date(T.fm_field(c, "last_updated"), "yyyy-MM-dd").alias("last_updated"),
        T.fm_issues(c).alias("source_issues"),
        body.alias("body"))


def notes_by_issue(catalog: DataFrame) -> DataFrame:
    """Inverted index: issue -> number of notes citing it."""
    return (catalog.select("repo", F.explode("source_issues").alias("issue"), "category", "slug")
            .groupBy("repo", "issue").agg(F.count(F.lit(1)).alias("n_notes")))


def audit_prompt(scanned: DataFrame, part_chars: int = PART_CHARS) -> DataFrame:
    """All notes of a repo as audit text: ``### cat/slug\\ncontent\\n`` joined by
    a newline, in read order; repos without notes get no row."""
    piece = F.concat(F.lit("### "), F.col("category"), F.lit("/"), F.col("slug"), F.lit("\n"),
                     F.col("content"), F.lit("\n"))
    return ordered_text_parts(scanned, ["repo"], [F.col("rank"), file_name()], piece, "\n", part_chars, "files")


# ---- state updates --------------------------------------------------------------

def union_issues(*arrays: Column) -> Column:
    """Sorted set union of id arrays."""
    return F.array_sort(F.array_distinct(F.flatten(F.array(*arrays))))


def upsert_notes(notes: DataFrame, items: DataFrame, as_of: str, buckets: int | None = None) -> DataFrame:
    """Learning items into notes, keyed (repo, category, slug). The last item
    (by ``pos``) replaces every field; source issues accumulate; touched notes
    get ``last_updated = as_of``. Returns the new snapshot with a ``change``
    column (insert / update / unchanged). ``buckets`` tells that notes is a
    table in so many buckets of its key: it is then joined where it lies."""
    last = F.max_by(F.struct("title", "read_when", "tripwires", "body"), "pos")
    agg = items.groupBy(*NOTE_KEY).agg(last.alias("it"), F.collect_set("issue").alias("new_issues"))
    old = notes.select(*NOTE_KEY, "title", "read_when", "tripwires", "last_updated", "source_issues", "body",
                       F.lit(True).alias("_old"))
    j = old.join(dealt(agg, NOTE_KEY, buckets), NOTE_KEY, "full_outer")
    touched = F.col("it").isNotNull()
    empty = F.array().cast("array<bigint>")

    def pick(field):
        return F.when(touched, F.col("it")[field]).otherwise(F.col(field)).alias(field)

    return j.select(
        *NOTE_KEY, pick("title"), pick("read_when"), pick("tripwires"),
        F.when(touched, F.lit(as_of).cast("date")).otherwise(F.col("last_updated")).alias("last_updated"),
        F.when(touched, union_issues(F.coalesce("source_issues", empty), F.col("new_issues")))
        .otherwise(F.col("source_issues")).alias("source_issues"),
        pick("body"),
        F.when(~touched, "unchanged").when(F.col("_old").isNull(), "insert").otherwise("update").alias("change"))


def with_content(notes: DataFrame) -> DataFrame:
    """Notes with their Markdown ``content`` (rendered when not stored)."""
    if "content" in notes.columns:
        return notes
    return notes.withColumn("content", render_note_content(*[F.col(c) for c in (
        "title", "read_when", "tripwires", "last_updated", "source_issues", "body")]))


def _merge_actions(actions: DataFrame) -> DataFrame:
    return actions.filter((F.col("action") == "merge_into") & F.col("target_category").isNotNull()
                          & F.col("target_slug").isNotNull())


def merge_targets(notes: DataFrame, actions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(finals, cycles) of merge chains. finals: (repo, category, slug, final_category,
    final_slug, hops) for every note that is merged on: the last note of the chain its
    first merge into an existing note begins. cycles: the notes on a circle of merges,
    and ``leads_to`` false; or those whose chain runs into one, and ``leads_to`` true.

    Pointer jumping: every round doubles the hops of every pointer, so a chain of n
    merges takes log2(n) rounds. A pointer that has not ended after more hops than
    there are merges is on its way round a circle, and points at a note of it."""
    there = notes.select("repo", F.col("category").alias("target_category"), F.col("slug").alias("target_slug"))
    ok = _merge_actions(actions).join(there, ["repo", "target_category", "target_slug"], "left_semi")
    first = ok.groupBy(*NOTE_KEY).agg(F.min(F.struct("pos", "target_category", "target_slug")).alias("t"))
    edges = materialize(first.select("repo", F.struct("category", "slug").alias("node"),
                                     F.struct("t.target_category", "t.target_slug").alias("to")), "merge-edges")
    edges = edges.select("repo", "node", F.struct(F.col("to.target_category").alias("category"),
                                                  F.col("to.target_slug").alias("slug")).alias("to"))
    total, at, reach, moved = edges.count(), edges.withColumn("hops", F.lit(1).cast("bigint")), 1, True
    while moved and reach <= total:
        onward = at.select("repo", F.col("node").alias("to"), F.col("to").alias("_next"), F.col("hops").alias("_more"))
        at = materialize(at.select("repo", "node", "to", "hops").join(onward, ["repo", "to"], "left").select(
            "repo", "node", F.coalesce("_next", "to").alias("to"),
            (F.col("hops") + F.coalesce("_more", F.lit(0))).alias("hops"),
            F.col("_next").isNotNull().alias("_moved")), "merge-pointers")
        moved, reach = not at.filter("_moved").isEmpty(), 2 * reach
    ended = at.join(edges.select("repo", F.col("node").alias("to")), ["repo", "to"], "left_anti")
    finals = ended.select("repo", "node.category", "node.slug", F.col("to.category").alias("final_category"),
                          F.col("to.slug").alias("final_slug"), "hops")
    stuck = at.join(edges.select("repo", F.col("node").alias("to")), ["repo", "to"], "left_semi")
    circle = stuck.select("repo", F.col("to").alias("node"), F.lit(True).alias("_on")).distinct()
    cycles = stuck.join(circle, ["repo", "node"], "left").select(
        "repo", "node.category", "node.slug", F.col("_on").isNull().alias("leads_to"))
    return finals, cycles


def follow_chains(notes: DataFrame, actions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(actions, cycles): merges whose target is merged on itself go to the end of its chain, without their
    body (that was written for a note that goes); merges into or on a circle become ``keep``."""
    finals, cycles = merge_targets(notes, actions)
    end = finals.select("repo", F.col("category").alias("target_category"), F.col("slug").alias("target_slug"),
                        "final_category", "final_slug")
    bad = cycles.select("repo", F.col("category").alias("target_category"), F.col("slug").alias("target_slug"),
                        F.lit(True).alias("_bad"))
    key = ["repo", "target_category", "target_slug"]
    j = actions.join(end, key, "left").join(bad, key, "left")
    merge, on = F.col("action") == "merge_into", F.col("final_slug").isNotNull()
    new = {"action": F.when(merge & F.col("_bad"), "keep").otherwise(F.col("action")),
           "target_category": F.when(merge & on, F.col("final_category")).otherwise(F.col("target_category")),
           "target_slug": F.when(merge & on, F.col("final_slug")).otherwise(F.col("target_slug")),
           "target_updated_body": F.when(~(merge & on), F.col("target_updated_body"))}
    return j.select(*[new[c].alias(c) if c in new else F.col(c) for c in actions.columns]), cycles


def compact_merge(notes: DataFrame, actions: DataFrame, as_of: str, categories=T.CATEGORIES,
                  chains: str = "snapshot", buckets: int | None = None) -> DataFrame:
    """Pass 1: merge sources into existing targets. Source ids are read from the
    snapshot (chains do not carry ids further; with ``chains="follow"`` a source
    goes to the end of its chain, see ``follow_chains``); several sources union their
    ids; the body becomes the last non-null ``target_updated_body``. The target
    content is edited like a file: header lines ``last_updated`` and
    ``source_issues`` are replaced (never added), the body kept or replaced.
    Returns one row per changed target."""
    if chains == "follow":
        actions, _ = follow_chains(notes, actions)
    m = _merge_actions(actions)
    src = (notes.filter(F.col("category").isin(list(categories)))
           .select(*NOTE_KEY, F.col("source_issues").alias("src_issues")))
    m = (dealt(m, NOTE_KEY, buckets).join(src, NOTE_KEY, "left")
         .select("repo", F.col("target_category").alias("category"), F.col("target_slug").alias("slug"),
                 "pos", "target_updated_body", "src_issues"))
    # last body-carrying merge per target (partial aggregate), then the count
    # of ids-only merges after it: two passes, no per-target position list
    last_body = m.groupBy(*NOTE_KEY).agg(
        F.max(F.when(F.col("target_updated_body").isNotNull(),
                     F.struct("pos", "target_updated_body"))).alias("b"))
    per_target = m.join(last_body, NOTE_KEY).groupBy(*NOTE_KEY).agg(
        F.count(F.lit(1)).alias("n_sources"),
        F.array_distinct(F.flatten(F.collect_set(F.coalesce("src_issues", F.array().cast("array<bigint>")))))
        .alias("add_issues"),
        F.first("b").alias("b"),
        F.count_if(F.col("b").isNull() | (F.col("pos") > F.col("b.pos"))).alias("_after"))
    tgt = with_content(notes).select(*NOTE_KEY, "content")
    j = dealt(per_target, NOTE_KEY, buckets).join(tgt, NOTE_KEY)  # target must exist
    existing = T.fm_issues(F.col("content"))
    ids = union_issues(existing, F.col("add_issues"))
    ids_txt = F.concat(F.lit("["), F.array_join(F.transform(ids, lambda x: x.cast("string")), ", "), F.lit("]"))
    header = T.fm_header(F.col("content"))
    header = T.fm_replace(T.fm_replace(header, "last_updated", F.lit(f'"{as_of}"')), "source_issues", ids_txt)
    new_body = F.col("b.target_updated_body")
    # Each merge rewrites the file: a body merge writes "<header>\n<body>\n";
    # an ids-only merge keeps the text after the header (leading newlines
    # dropped) and appends one newline. So the result is the last body (or the
    # original text) plus one newline per ids-only merge after it.
    after = F.col("_after").cast("int")
    base = F.when(new_body.isNotNull(), F.concat(new_body, F.lit("\n"))) \
            .otherwise(F.regexp_replace(T.fm_rest(F.col("content")), r"\A\n+", ""))
    content = F.concat(header, F.lit("\n"), base, F.repeat(F.lit("\n"), after))
    return j.select(*NOTE_KEY, "n_sources", ids.alias("source_issues"), new_body.isNotNull().alias("body_replaced"),
                    content.alias("content"), new_body.alias("new_body"))


def orphan_merges(notes: DataFrame, actions: DataFrame) -> DataFrame:
    """Merge actions whose target is absent: their source would be deleted
    while its content goes nowhere."""
    m = actions.filter(F.col("action") == "merge_into")
    tgt = notes.select("repo", F.col("category").alias("target_category"), F.col("slug").alias("target_slug"),
                       F.lit(True).alias("_t"))
    j = m.join(tgt, ["repo", "target_category", "target_slug"], "left").filter(F.col("_t").isNull())
    return j.select(*NOTE_KEY, "pos", "target_category", "target_slug",
                    F.when(F.col("target_category").isNull() | F.col("target_slug").isNull(), "no target given")
                    .otherwise("target missing").alias("reason"))


def compact_delete(notes: DataFrame, actions: DataFrame, on_orphan: str = "keep", buckets: int | None = None) -> DataFrame:
    """Pass 2: remove deleted notes and merge sources. ``on_orphan='drop'``
    reproduces the source tool (a merge source goes even when its merge had no
    target); ``'keep'`` keeps such sources. Each existing file counts once, for
    its first action. Returns the removed keys with ``removed_by``."""
    rm = actions.filter(F.col("action").isin("delete", "merge_into"))
    if on_orphan == "keep":
        orphans = orphan_merges(notes, actions).select(*NOTE_KEY, "pos")
        rm = rm.join(orphans, [*NOTE_KEY, "pos"], "left_anti")
    first = rm.groupBy(*NOTE_KEY).agg(F.min(F.struct("pos", "action")).alias("a"))
    return (dealt(first, NOTE_KEY, buckets).join(notes.select(*NOTE_KEY), NOTE_KEY)
            .select(*NOTE_KEY, F.col("a.action").alias("removed_by")))


def apply_compaction(notes: DataFrame, actions: DataFrame, as_of: str, on_orphan: str = "keep",
                     chains: str = "snapshot") -> DataFrame:
    """New snapshot of the typed columns: merged targets with their new body,
    ids and date, removed keys dropped. Files are rendered from it
    (``render_notes``); a stored ``content`` column is left out, as it would be
    stale."""
    if chains == "follow":
        actions, _ = follow_chains(notes, actions)
    merged = compact_merge(notes, actions, as_of).select(
        *NOTE_KEY, F.lit(True).alias("_hit"), F.col("new_body").alias("_body"), F.col("source_issues").alias("_ids"))
    removed = compact_delete(notes, actions, on_orphan)
    out = notes.join(merged, NOTE_KEY, "left").join(removed.select(*NOTE_KEY), NOTE_KEY, "left_anti")
    new = {"body": F.coalesce("_body", "body"), "source_issues": F.coalesce("_ids", "source_issues"),
           "last_updated": F.when(F.col("_hit"), F.lit(as_of).cast("date")).otherwise(F.col("last_updated"))}
    return out.select(*[new[c].alias(c) if c in new else F.col(c) for c in notes.columns if c != "content"])


def action_counts(actions: DataFrame) -> DataFrame:
    """keep / delete / merge totals per repo; unknown actions count nowhere."""
    a = F.col("action")
    return actions.groupBy("repo").agg(F.count_if(a == "keep").alias("n_keep"),
                                       F.count_if(a == "delete").alias("n_delete"),
                                       F.count_if(a == "merge_into").alias("n_merge"))


def audit_coverage(scanned: DataFrame, actions: DataFrame, buckets: int | None = None) -> DataFrame:
    """Every audited note should get exactly one action: report notes with
    none, notes with several, and actions naming no note."""
    per = actions.groupBy(*NOTE_KEY).agg(F.count(F.lit(1)).alias("n_actions"))
    n = scanned.select(*NOTE_KEY, F.lit(True).alias("_n"))
    j = n.join(dealt(per, NOTE_KEY, buckets), NOTE_KEY, "full_outer")
    issue = (F.when(F.col("_n").isNull(), "unknown_file").when(F.col("n_actions").isNull(), "no_action")
             .when(F.col("n_actions") > 1, "repeated"))
    return (j.select(*NOTE_KEY, F.coalesce("n_actions", F.lit(0)).cast("bigint").alias("n_actions"),
                     issue.alias("issue")).filter(F.col("issue").isNotNull()))


def source_issue_rows(notes: DataFrame) -> DataFrame:
    """(repo, category, slug, issue): a note's source issues as rows, for notes that gather them without bound."""
    return notes.select(*NOTE_KEY, F.explode("source_issues").alias("issue")).distinct()


def upsert_source_issues(rows: DataFrame, items: DataFrame) -> DataFrame:
    """The issue rows after a batch of learning items: a set union, no array of a hot note's issues anywhere."""
    return rows.unionByName(items.select(*NOTE_KEY, "issue")).distinct()


def content_drift(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Expected files missing or different in ``actual``; extras ignored."""
    a = actual.select("path", F.sha2("content", 256).alias("_h"), F.lit(True).alias("_there"))
    e = expected.select("path", F.sha2("content", 256).alias("_e"))
    j = e.join(a, "path", "left")
    return j.select("path", F.when(F.col("_there").isNull(), "missing").when(~F.col("_h").eqNullSafe(F.col("_e")), "stale")
                    .otherwise("current").alias("status"))


def managed_section(has_index: Column, prefix: str = T.DEFAULT_PREFIX, root: str = MEMORY_ROOT) -> Column:
    m = T.markers(prefix)
    body = F.when(has_index, F.lit(f"@{root}/index.md\n")).otherwise(F.lit(NO_LEARNINGS + "\n"))
    return F.concat(F.lit(m["block_start"] + "\n## Memory\n\n"), body, F.lit("\n" + m["block_end"]))


def managed_block(docs: DataFrame, notes: DataFrame, prefix: str = T.DEFAULT_PREFIX) -> DataFrame:
    """Upsert the marked block in each document: first start marker to last
    end marker is replaced; without markers the block is appended after a
    blank line; empty text becomes the block alone. The block points at the
    repo's index (one row per repo joined, not the index text itself)."""
    m = T.markers(prefix)
    repos = notes.select("repo").distinct().withColumn("_has", F.lit(True))
    j = docs.join(repos, "repo", "left")
    section = managed_section(F.col("_has").isNotNull(), prefix)
    t = F.coalesce(F.col("text"), F.lit(""))
    pat = "(?s)" + T.java_quote(m["block_start"]) + ".*" + T.java_quote(m["block_end"])
    has_block = t.contains(m["block_start"]) & t.rlike(pat)
    new = (F.when(has_block, F.regexp_replace(t, F.lit(pat), T.replacement_quote(section)))
           .when(t == "", section)
           .otherwise(F.concat(T.rtrim_ws(t), F.lit("\n\n"), section)))
    action = F.when(has_block, "replaced").when(t == "", "created").otherwise("appended")
    return j.select(*[c for c in docs.columns if c != "text"], action.alias("action"), new.alias("text"))
