"""Text extraction jobs: each scans a text column, fans out rows, and returns
``(result, rejects)``; rejects carry the key and a reason so a batch never
stops on a bad row. Only built-in functions are used (no Python UDF).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom import schemas
from tallyloom.functions import text as T
from tallyloom.functions.strict_json import OPT_STR, OPT_STR_LIST, OPT_UINT, STR, STR_LIST, strict_decode
from tallyloom.session import materialize

# Field types the decoders accept (a typed decoder's rules: required text,
# optional text, lists of text; tripwires default to empty when absent).
NODE_TYPES = {"id": STR, "description": STR, "status": STR, "plan_issue": OPT_UINT, "pr_url": OPT_STR,
              "depends_on": OPT_STR_LIST}
LEARNING_TYPES = {"category": STR, "slug": STR, "title": STR, "body": STR, "read_when": STR_LIST,
                  "tripwires": r"MISSING|ARRAY<VOID>|ARRAY<OBJECT<.*action: STRING.*warning: STRING.*>>"}
ACTION_TYPES = {"action": STR, "category": STR, "slug": STR, "reason": OPT_STR, "target_category": OPT_STR,
                "target_slug": OPT_STR, "target_updated_body": OPT_STR}
from tallyloom.operators import graph


def reject_rows(d: DataFrame, keys, reason) -> DataFrame:
    """(keys, reason) for rows whose reason is set. An outer generator plus a
    filter on its output keeps the optimizer from pushing a filter (and the
    parse behind it) below the parse."""
    return (d.select(*keys, F.explode_outer(F.when(reason.isNotNull(), F.array(reason))).alias("reason"))
            .where(F.col("reason").isNotNull()))


def extract_roadmaps(bodies: DataFrame, keys=("repo", "objective")) -> tuple[DataFrame, DataFrame]:
    """Objective bodies -> node rows from the ``## Roadmap`` bullets (all
    pending). Rejects: ``no section`` and ``no nodes``.

    Bullet lines are selected inside the row (one regex per line), then
    exploded with their position, and parsed with flat column expressions so
    whole-stage codegen evaluates each step once."""
    keys = list(keys)
    sec = T.extract_section(F.col("body"), "Roadmap")
    d = bodies.select(*keys, sec.alias("_sec")).withColumn(
        "_lines", F.when(F.col("_sec").isNotNull(), T.roadmap_bullet_lines(F.col("_sec"))))
    reason = F.when(F.col("_sec").isNull(), "no section").when(F.size("_lines") == 0, "no nodes")
    rejects = reject_rows(d, keys, reason)
    # a generator, not a filter: a filter on a parsed column would be pushed
    # below the parse and evaluate it twice
    rows = d.select(*keys, F.posexplode_outer(F.coalesce("_lines", F.array().cast("array<string>")))
                    .alias("_i", "_line")).where(F.col("_line").isNotNull())
    parsed = T.parse_roadmap_line(rows, "_line")
    nodes = parsed.select(*keys, (F.col("_i") + 1).cast("bigint").alias("pos"), "node_id", "description",
                          F.lit("pending").alias("status"), F.lit(None).cast("bigint").alias("plan_issue"),
                          F.lit(None).cast("string").alias("pr_url"), "depends_on")
    return nodes, rejects


def load_node_state(bodies: DataFrame, keys=("repo", "objective"),
                    prefix: str = T.DEFAULT_PREFIX) -> tuple[DataFrame, DataFrame]:
    """Stored objective bodies -> current node rows. An objective is one row, or
    one row for each ``part``; each row may hold several blobs, a blob being the
    text between a start marker and the first end marker after it. All blobs
    are decoded and numbered on in (part, place) order. One bad element rejects
    the objective's whole list (``bad state: ...``), as does a row without a
    blob (``no marker``); the reason is that of the first faulty part.

    The decoded parts are read three times (rejects, node counts of earlier
    parts, nodes), so they are checkpointed: each is parsed once."""
    keys = list(keys)
    m = T.markers(prefix)
    part = F.col("part") if "part" in bodies.columns else F.lit(0)
    d = bodies.select(*keys, part.cast("bigint").alias("_part"),
                      F.posexplode_outer(T.marker_spans(F.col("body"), m["nodes_start"], m["nodes_end"]))
                      .alias("_n", "_span"))
    d = strict_decode(d, "_span", schemas.NODE_STATE, ["id", "description", "status"],
                      lambda x: x["status"].isin(*T.NODE_STATUSES)
                      & (x["plan_issue"].isNull() | (x["plan_issue"] >= 0)),
                      items="_items", reason="_why", types=NODE_TYPES)
    d = d.withColumn("reason", F.when(F.col("_span").isNull(), F.lit("no marker"))
                     .when(F.col("_why").isNotNull(), F.concat(F.lit("bad state: "), F.col("_why"))))
    place = ["_part", "_n"]
    d = materialize(d.select(*keys, *place, "_items", "reason"), "node-state")
    rejects = (d.where(F.col("reason").isNotNull()).groupBy(*keys)
               .agg(F.min_by("reason", F.struct(*place)).alias("reason")))
    # a row for each part, not for each node
    before = Window.partitionBy(*keys).orderBy(*place).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (d.where(F.col("reason").isNull()).select(*keys, *place, F.size("_items").alias("_size"))
               .select(*keys, *place, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_off")))
    nodes = (d.join(rejects.select(*keys), keys, "left_anti").join(offsets, [*keys, *place])
             .select(*keys, "_off", F.posexplode("_items").alias("_i", "n"))
             .select(*keys, (F.col("_off") + F.col("_i") + 1).cast("bigint").alias("pos"), F.col("n.id").alias("node_id"),
                     F.col("n.description").alias("description"), F.col("n.status").alias("status"),
                     F.col("n.plan_issue").alias("plan_issue"), F.col("n.pr_url").alias("pr_url"),
                     F.coalesce(F.col("n.depends_on"), F.array().cast("array<string>")).alias("depends_on")))
    return nodes, rejects


def section_coverage(plan_bodies: DataFrame) -> DataFrame:
    """Required plan sections present per section and language."""
    names = [n for n, _ in T.PLAN_SECTIONS]
    d = plan_bodies.select("lang", T.missing_sections(F.col("body")).alias("_miss"))
    d = d.select("lang", "_miss", F.explode(F.array(*[F.lit(n) for n in names])).alias("section"))
    return d.groupBy("lang", "section").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.count_if(~F.array_contains("_miss", F.col("section"))).alias("n_present"))


def decode_replies(replies: DataFrame, key: str | list[str] = "id", kind: str = "learnings") -> tuple[DataFrame, DataFrame]:
    """Model replies -> learning rows (or audit-action rows). The JSON array is
    taken from the reply (optional code fence, first ``[`` to last ``]``) and
    strictly decoded; a faulty reply goes to rejects with a reason."""
    keys = [key] if isinstance(key, str) else list(key)
    d = replies.select(*keys, T.json_payload(F.col("reply")).alias("_span"))
    if kind == "learnings":
        d = strict_decode(d, "_span", schemas.LEARNING_ITEM, ["category", "slug", "title", "read_when", "body"],
                          lambda x: F.forall(F.coalesce(x["tripwires"], F.array()),
                                             lambda t: t["action"].isNotNull() & t["warning"].isNotNull()),
                          items="_items", types=LEARNING_TYPES)
    else:
        d = strict_decode(d, "_span", schemas.AUDIT_ACTION, ["action", "category", "slug"], items="_items",
                          types=ACTION_TYPES)
    rejects = reject_rows(d, keys, F.col("reason"))
    rows = d.select(*keys, F.posexplode_outer("_items").alias("item_pos", "it")).where(F.col("it").isNotNull())
    if kind == "learnings":
        rows = rows.select(*keys, F.col("item_pos").cast("bigint").alias("item_pos"), "it.category", "it.slug",
                           "it.title", "it.read_when",
                           F.coalesce("it.tripwires", F.array().cast("array<struct<action:string,warning:string>>"))
                           .alias("tripwires"), "it.body")
    else:
        rows = rows.select(*keys, F.col("item_pos").cast("bigint").alias("item_pos"), "it.*")
    return rows, rejects


def age_histogram(dated: DataFrame, ts_col: str, as_of: str) -> DataFrame:
    """Count of items per age label (``today``, ``1 day ago``, ``N days ago``)."""
    iso = F.date_format(F.col(ts_col), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    age = T.age_label(iso, F.lit(as_of).cast("date"))
    return dated.select(age.alias("age")).groupBy("age").agg(F.count(F.lit(1)).alias("n"))


def truncation_report(texts: DataFrame, group: str, text_col: str, cap: int = T.TEXT_CAP) -> DataFrame:
    """Share of texts the prompt cap would cut, per group; counted in
    characters (ours) and in bytes (the source tool's unit)."""
    t = F.col(text_col)
    return texts.groupBy(group).agg(
        F.count(F.lit(1)).alias("n_texts"),
        F.count_if(F.length(t) > cap).alias("n_truncated"),
        F.count_if(F.octet_length(t) > cap).alias("n_over_bytes"),
        F.sum(F.length(T.truncate_text(t, cap))).cast("bigint").alias("kept_chars"))


def rewrite_roadmap(bodies: DataFrame, nodes: DataFrame, prefix: str = T.DEFAULT_PREFIX,
                    keys=("repo", "objective"), part_rows: int = graph.PART_NODES) -> DataFrame:
    """Replace the ``## Roadmap`` part of each body with the rendered table and
    the state blob; other sections are kept; no heading -> appended.

    The output has a row for each ``part`` of at most ``part_rows`` nodes. Part 0
    is the body with the first part of table and blob; later parts hold only
    theirs. Of bodies that are in parts already, part 0 is rewritten and the
    later ones are replaced."""
    keys = list(keys)
    if "part" in bodies.columns:
        bodies = bodies.filter(F.col("part") == 0).drop("part")
    rendered = graph.render_objectives(nodes, prefix=prefix, part_rows=part_rows).select(*keys, "part", "table", "blob")
    j = bodies.join(rendered, keys, "left")
    part = F.coalesce("part", F.lit(0).cast("bigint"))
    later = F.concat("table", F.lit("\n\n"), "blob")
    new_content = F.concat(F.lit("\n"), F.coalesce("table", F.lit(graph.ROADMAP_HEADER)), F.lit("\n\n"),
                           F.coalesce("blob", F.lit(T.markers(prefix)["nodes_start"] + "[]" + T.markers(prefix)["nodes_end"])))
    b = F.coalesce(F.col("body"), F.lit(""))
    hp = F.instr(b, "## Roadmap")
    tail = F.substring(b, hp, F.length(b))
    nl = F.instr(tail, "\n")
    before = F.when(nl > 0, F.substring(b, F.lit(1), hp - 1 + nl)).otherwise(b)
    rest = F.when(nl > 0, F.substring(b, hp + nl, F.length(b))).otherwise(F.lit(""))
    e = F.instr(rest, "\n## ")
    after = F.when(e > 0, F.substring(rest, e + 1, F.length(rest))).otherwise(F.lit(""))
    replaced = F.when(after == "", F.concat(before, new_content)).otherwise(
        F.concat(before, new_content, F.lit("\n\n"), after))
    appended = F.concat(T.rtrim_ws(b), F.lit("\n\n## Roadmap"), new_content)
    return j.select(*keys, *[c for c in bodies.columns if c not in keys and c != "body"], part.alias("part"),
                    F.when(part > 0, later).when(hp > 0, replaced).otherwise(appended).alias("body"))
