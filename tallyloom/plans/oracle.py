"""DuckDB SQL for every registered query, over the driver's tables.

The oracle derives the fixture tables with window functions and reads the
columns directly; it never repeats the Spark jobs' text parsing.
"""

from __future__ import annotations

NL = "chr(10)"


def nodes_cte(small: bool = False, name: str = "nodes") -> str:
    obj = "(o_orderkey // 3)" if small else "o_custkey"
    return f"""{name} AS (
  SELECT concat('r', {obj} % 10) AS repo, CAST({obj} AS BIGINT) AS objective,
         CAST(row_number() OVER w AS BIGINT) AS pos, CAST(o_orderkey AS VARCHAR) AS node_id,
         o_orderpriority AS description,
         CASE o_orderstatus WHEN 'P' THEN 'pending' WHEN 'O' THEN 'in_progress' ELSE 'done' END AS status,
         CASE WHEN o_orderstatus <> 'P' THEN o_orderkey + 1000000 END AS plan_issue,
         CASE WHEN o_orderstatus = 'F' THEN concat('https://host/r', {obj} % 10, '/pull/', o_orderkey) END AS pr_url,
         list_filter([CAST(lag(o_orderkey, 1) OVER w AS VARCHAR), CAST(lag(o_orderkey, 3) OVER w AS VARCHAR),
                      CASE WHEN o_orderkey % 7 = 0 THEN concat('x', o_orderkey) END],
                     lambda x: x IS NOT NULL) AS depends_on
  FROM orders WINDOW w AS (PARTITION BY {obj} ORDER BY o_orderkey))"""


FIRST = """first_nodes AS (
  SELECT repo, objective, node_id, min(pos) AS pos, arg_min(status, pos) AS status
  FROM nodes GROUP BY repo, objective, node_id)"""

EDGES = """edges AS (
  SELECT repo, objective, pos, node_id, CAST(generate_subscripts(depends_on, 1) - 1 AS BIGINT) AS dep_pos,
         unnest(depends_on) AS dep_id
  FROM nodes)"""

BLOCKED = """blocked AS (
  SELECT e.repo, e.objective, e.pos, e.node_id, e.dep_pos, e.dep_id
  FROM edges e JOIN first_nodes f ON e.repo = f.repo AND e.objective = f.objective AND e.dep_id = f.node_id
  WHERE f.status <> 'done')"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


NODE_COLS = ("repo, objective, pos, node_id, description, status, plan_issue, pr_url, "
             "array_to_string(depends_on, ',') AS depends_on")

ROADMAP_HEADER_SQL = ("'| ID | Description | Status | Plan | PR | Blocked By |' || chr(10) || "
                      "'|----|-------------|--------|------|----|------------|'")

SQL: dict[str, str] = {}

SQL["first_node_per_id"] = with_(nodes_cte(), FIRST) + "SELECT repo, objective, node_id, pos, status FROM first_nodes"

SQL["blocked_by"] = with_(nodes_cte(), FIRST, EDGES, BLOCKED) + "SELECT * FROM blocked"

SQL["unblocked_nodes"] = with_(nodes_cte(), FIRST, EDGES, BLOCKED) + f"""
SELECT {NODE_COLS} FROM nodes n
WHERE status = 'pending'
  AND NOT EXISTS (SELECT 1 FROM blocked b WHERE b.repo = n.repo AND b.objective = n.objective AND b.pos = n.pos)"""

SQL["landable_nodes"] = with_(nodes_cte()) + f"""
SELECT {NODE_COLS} FROM nodes WHERE plan_issue IS NOT NULL AND status <> 'done'"""

SQL["all_nodes_done"] = with_(nodes_cte(small=True)) + """
SELECT repo, objective, count(*) AS n_nodes, bool_and(status = 'done') AS all_done
FROM nodes GROUP BY repo, objective"""

SQL["objective_progress"] = with_(nodes_cte(), FIRST, EDGES, BLOCKED) + """
, per_node AS (SELECT repo, objective, pos, count(*) AS n_blockers FROM blocked GROUP BY ALL)
SELECT n.repo, n.objective, count(*) AS n_nodes,
       count(*) FILTER (WHERE status = 'pending') AS n_pending,
       count(*) FILTER (WHERE status = 'in_progress') AS n_in_progress,
       count(*) FILTER (WHERE status = 'done') AS n_done,
       count(*) FILTER (WHERE p.n_blockers IS NOT NULL) AS n_blocked,
       count(*) FILTER (WHERE status = 'pending' AND p.n_blockers IS NULL) AS n_unblocked
FROM nodes n LEFT JOIN per_node p USING (repo, objective, pos)
GROUP BY n.repo, n.objective"""

SQL["close_comment"] = with_(nodes_cte(small=True)) + """
, done AS (SELECT repo, objective FROM nodes GROUP BY ALL HAVING bool_and(status = 'done'))
SELECT n.repo, n.objective, CAST((pos - 1) // 10000 AS BIGINT) AS part,
       CASE WHEN (pos - 1) // 10000 = 0 THEN 'All nodes completed — closing objective.' || chr(10) || chr(10) ELSE '' END ||
       string_agg(concat('- ', node_id, ' ', description), chr(10) ORDER BY pos) AS comment
FROM nodes n JOIN done USING (repo, objective)
GROUP BY n.repo, n.objective, (pos - 1) // 10000"""



def roadmap_table_sql(part_rows: int) -> str:
    return with_(nodes_cte(), FIRST, EDGES, BLOCKED) + f"""
, bl AS (SELECT repo, objective, pos, string_agg(dep_id, ', ' ORDER BY dep_pos) AS blocked FROM blocked GROUP BY ALL)
, rows AS (
  SELECT n.repo, n.objective, n.pos, CAST((n.pos - 1) // {part_rows} AS BIGINT) AS part,
         '| ' || concat_ws(' | ', node_id, description, status,
                CASE WHEN plan_issue IS NOT NULL THEN concat('#', plan_issue) ELSE '' END,
                coalesce(pr_url, ''), coalesce(bl.blocked, '')) || ' |' AS row
  FROM nodes n LEFT JOIN bl USING (repo, objective, pos))
SELECT repo, objective, part,
       CASE WHEN part = 0 THEN {ROADMAP_HEADER_SQL} || chr(10) ELSE '' END || string_agg(row, chr(10) ORDER BY pos) AS "table"
FROM rows GROUP BY repo, objective, part"""


SQL["roadmap_table"] = roadmap_table_sql(10_000)
SQL["roadmap_table_parts"] = roadmap_table_sql(4)

NODE_JSON_SQL = """'{"id":"' || node_id || '","description":"' || description || '","status":"' || status || '"'
  || CASE WHEN plan_issue IS NOT NULL THEN concat(',"plan_issue":', plan_issue) ELSE '' END
  || CASE WHEN pr_url IS NOT NULL THEN concat(',"pr_url":"', pr_url, '"') ELSE '' END
  || ',"depends_on":[' || coalesce(array_to_string(list_transform(depends_on, lambda x: concat('"', x, '"')), ','), '')
  || ']}'"""

SQL["state_comment"] = with_(nodes_cte()) + f"""
SELECT repo, objective, CAST((pos - 1) // 10000 AS BIGINT) AS part,
       '<!-- loom:nodes [' || string_agg({NODE_JSON_SQL}, ',' ORDER BY pos) || '] -->' AS blob
FROM nodes GROUP BY repo, objective, (pos - 1) // 10000"""


# ---- issue tables -----------------------------------------------------------------

ISSUES = """issues AS (
  SELECT concat('r', o_custkey % 10) AS repo, o_orderkey AS number,
         concat('Plan ', o_orderkey, ': ', o_orderpriority) AS title,
         CASE WHEN o_orderkey % 26 = 5 THEN NULL
              WHEN o_orderkey % 2 = 0 THEN concat('Objective: #', o_custkey, ' (node ', o_orderkey, ')')
              ELSE 'plain' END AS body,
         CASE WHEN o_orderstatus = 'F' THEN 'CLOSED' ELSE 'OPEN' END AS state,
         o_orderdate AS created_at,
         list_filter([CASE WHEN o_orderpriority = '5-LOW' THEN 'objective' ELSE 'plan' END,
                      CASE WHEN o_orderkey % 3 = 0 THEN 'learned' END], lambda x: x IS NOT NULL) AS labels,
         concat('https://host/r', o_custkey % 10, '/issues/', o_orderkey) AS url,
         o_custkey, o_orderkey
  FROM orders)"""

CLOSE_EVENTS = """close_events AS (
  SELECT concat('r', o_custkey % 10) AS repo, l_orderkey AS issue, l_shipdate AS closed_at,
         CAST(l_linenumber AS BIGINT) AS seq,
         CASE WHEN l_linestatus = 'O' THEN 'PullRequest' ELSE 'User' END AS closer_type,
         l_partkey AS closer_id,
         CASE WHEN l_linestatus = 'O' THEN l_partkey END AS pr_number,
         CASE WHEN l_linestatus = 'O' THEN CASE WHEN l_returnflag = 'R' THEN 'MERGED'
              WHEN l_returnflag = 'A' THEN 'CLOSED' ELSE 'OPEN' END END AS pr_state,
         l_suppkey AS actor
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

REPO_LIST = "[" + ", ".join(f"'r{i}'" for i in range(10)) + "]"

PRS = f"""pull_requests AS (
  SELECT r.repo, p_partkey AS number,
         CASE WHEN p_partkey % 4 = 0 THEN concat('feat-', p_partkey, '-', p_size) ELSE 'main' END AS head_ref,
         CASE p_size % 6 WHEN 0 THEN concat('Closes #', p_partkey)
              WHEN 1 THEN concat('fixes #1 then closes #', p_partkey)
              WHEN 2 THEN concat('RESOLVES #', p_partkey)
              WHEN 3 THEN concat('closes #abc, fixes #', p_partkey)
              WHEN 4 THEN concat('discloses #', p_partkey) ELSE 'no reference' END AS body,
         p_name AS title,
         concat('diff --git a/', p_type, ' b/', p_type, chr(10), repeat(concat('+', p_name, chr(10)), p_size * 8)) AS diff,
         p_size, p_partkey,
         CASE WHEN p_size % 6 < 5 THEN p_partkey END AS body_ref,
         CASE WHEN p_partkey % 4 = 0 THEN p_partkey END AS branch_ref
  FROM part CROSS JOIN (SELECT unnest({REPO_LIST}) AS repo) r)"""

COMMENTS = """comments AS (
  SELECT concat('r', o_custkey % 10) AS repo, conv_id AS issue, turn AS seq,
         CASE WHEN role = 'assistant' THEN '<!-- loom:conversation -->' || chr(10) || text ELSE text END AS body,
         role, text
  FROM conversations JOIN orders ON conv_id = o_orderkey)"""

# White_Space characters (what a Unicode-aware trim removes), for RE2.
WS = r"[\t\n\x0B\f\r\x{85}\p{Z}]"


def trim_ws(expr: str) -> str:
    return f"regexp_replace({expr}, '^{WS}+|{WS}+$', '', 'g')"


def age_sql(date_expr: str, as_of: str) -> str:
    n = f"date_diff('day', {date_expr}, DATE '{as_of}')"
    return (f"CASE WHEN {n} = 0 THEN 'today' WHEN {n} = 1 THEN '1 day ago' "
            f"ELSE concat({n}, ' days ago') END")


def topk_sql(label: str, state: str, k: int) -> str:
    return with_(ISSUES) + f"""
SELECT repo, number, title, rank, strftime(created_at, '%Y-%m-%d') AS created FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY repo ORDER BY created_at DESC, number DESC) AS BIGINT) AS rank
  FROM issues WHERE state = '{state}' AND list_contains(labels, '{label}')) WHERE rank <= {k}"""


SQL["scan_issues"] = with_(ISSUES) + """
SELECT repo, number, title, coalesce(body, '') AS body, state, strftime(created_at, '%Y-%m-%d') AS created,
       array_to_string(labels, ',') AS labels, url FROM issues"""
SQL["list_open_plans"] = topk_sql("plan", "OPEN", 50)
SQL["list_open_objectives"] = topk_sql("objective", "OPEN", 50)
SQL["open_plans_topk"] = topk_sql("plan", "CLOSED", 100)
SQL["unlearned_plans"] = with_(ISSUES) + """
SELECT repo, number, title, strftime(created_at, '%Y-%m-%d') AS created FROM issues
WHERE state = 'CLOSED' AND list_contains(labels, 'plan') AND NOT list_contains(labels, 'learned')"""

LATEST = """latest AS (
  SELECT * FROM close_events
  QUALIFY row_number() OVER (PARTITION BY repo, issue ORDER BY closed_at DESC, seq DESC, closer_id DESC, actor DESC) = 1)"""

SQL["latest_close_event"] = with_(CLOSE_EVENTS, LATEST) + """
SELECT repo, issue, strftime(closed_at, '%Y-%m-%d %H:%M:%S') AS closed_at, seq, closer_type, pr_number, pr_state
FROM latest"""

SQL["linked_pr"] = with_(CLOSE_EVENTS, LATEST, PRS) + """
SELECT l.repo, l.issue, l.pr_number, p.title AS pr_title, p.head_ref
FROM latest l JOIN pull_requests p ON l.repo = p.repo AND l.pr_number = p.number
WHERE l.closer_type = 'PullRequest' AND l.pr_state = 'MERGED'"""

SQL["pr_for_branch"] = with_(PRS) + """
SELECT repo, head_ref, max(number) AS number, arg_max(title, number) AS title,
       split_part(arg_max(body, number), chr(10), 1) AS first_line
FROM pull_requests WHERE p_partkey % 3 <> 0 GROUP BY repo, head_ref"""

SQL["scan_comments"] = with_(COMMENTS) + "SELECT repo, issue, seq, body FROM comments"

SQL["conversation_of"] = with_(COMMENTS) + f"""
SELECT repo, issue, min(seq) AS seq, {trim_ws("arg_min(text, seq)")} AS conversation
FROM comments WHERE role = 'assistant' GROUP BY repo, issue"""

SQL["conversation_parts"] = with_(COMMENTS) + """
SELECT repo, issue, min(seq) AS seq, chr(10) || arg_min(text, seq) AS text
FROM comments WHERE role = 'assistant' GROUP BY repo, issue"""

OPEN_LISTS = """lists AS (SELECT repo, rank, number, title FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY repo ORDER BY created_at DESC, number DESC) AS BIGINT) AS rank
  FROM issues WHERE state = 'OPEN' AND list_contains(labels, 'plan')) WHERE rank <= 50)"""

SQL["open_plan_lists"] = with_(ISSUES, OPEN_LISTS) + "SELECT repo, rank, number, title FROM lists"

SQL["resolve_ref_lists"] = with_(PRS, ISSUES, OPEN_LISTS) + """
, heads AS (SELECT repo, count(*) AS n_listed, arg_min(number, rank) AS newest FROM lists GROUP BY repo)
, refs AS (SELECT p.repo, p.number AS pr_number, coalesce(p.body_ref, p.branch_ref) AS ref_issue,
                  i.state IS NOT NULL AND i.state <> 'CLOSED' AS found
           FROM pull_requests p LEFT JOIN issues i ON i.repo = p.repo AND i.number = coalesce(p.body_ref, p.branch_ref))
SELECT r.repo, pr_number, ref_issue,
       CASE WHEN found THEN 'open_issue' WHEN h.repo IS NULL THEN 'no_open_plans' ELSE 'fallback_open_plans' END AS outcome,
       CASE WHEN NOT found THEN h.repo END AS list_repo, CASE WHEN NOT found THEN n_listed END AS n_listed,
       CASE WHEN NOT found THEN newest END AS newest
FROM refs r LEFT JOIN heads h ON h.repo = r.repo"""

SQL["resolve_ref"] = with_(PRS, ISSUES) + """
SELECT p.repo, p.number AS pr_number, coalesce(p.body_ref, p.branch_ref) AS ref_issue,
       CASE WHEN p.body_ref IS NOT NULL THEN 'body' WHEN p.branch_ref IS NOT NULL THEN 'branch' END AS ref_source,
       i.state AS issue_state,
       CASE WHEN i.state IS NOT NULL AND i.state <> 'CLOSED' THEN 'open_issue' ELSE 'fallback_open_plans' END AS outcome
FROM pull_requests p LEFT JOIN issues i ON i.repo = p.repo AND i.number = coalesce(p.body_ref, p.branch_ref)"""

SQL["reference_edges"] = with_(ISSUES, PRS, nodes_cte()) + """
, edges AS (
  SELECT 'objective' AS kind, repo, number AS from_number, o_custkey AS to_number FROM issues WHERE o_orderkey % 2 = 0 AND o_orderkey % 26 <> 5
  UNION ALL SELECT 'url', repo, plan_issue, CAST(node_id AS BIGINT) FROM nodes WHERE pr_url IS NOT NULL
  UNION ALL SELECT 'closes', repo, number, body_ref FROM pull_requests WHERE body_ref IS NOT NULL
  UNION ALL SELECT 'branch', repo, number, branch_ref FROM pull_requests WHERE branch_ref IS NOT NULL)
SELECT e.kind, e.repo, e.from_number, e.to_number, i.number IS NOT NULL AS matched
FROM edges e LEFT JOIN issues i ON i.repo = e.repo AND i.number = e.to_number"""

SQL["plan_links"] = with_(ISSUES) + """
SELECT c.repo, c.o_custkey AS parent, c.number AS child, CAST(c.o_orderkey AS VARCHAR) AS node_id,
       CASE WHEN p.number IS NOT NULL THEN 'linked' ELSE 'missing_parent' END AS status
FROM issues c LEFT JOIN issues p ON p.repo = c.repo AND p.number = c.o_custkey
WHERE c.o_orderkey % 2 = 0 AND c.o_orderkey % 26 <> 5"""

SQL["plan_listing"] = with_(ISSUES) + f"""
SELECT repo, number, rank,
       concat('#', CASE WHEN length(CAST(number AS VARCHAR)) >= 4 THEN CAST(number AS VARCHAR)
                        ELSE rpad(CAST(number AS VARCHAR), 4, ' ') END, ' ', title, ' (',
              {age_sql("CAST(created_at AS DATE)", "1998-12-31")}, ')') AS line
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY repo ORDER BY created_at DESC, number DESC) AS BIGINT) AS rank
      FROM issues WHERE state = 'OPEN' AND list_contains(labels, 'plan')) WHERE rank <= 50"""

SQL["closed_only"] = with_(ISSUES) + """
SELECT repo, number, CASE WHEN state = 'CLOSED' THEN 'accepted' ELSE 'rejected' END AS outcome,
       CASE WHEN state <> 'CLOSED' THEN concat('#', number, ' has state ', state) END AS reason
FROM issues WHERE list_contains(labels, 'plan')"""


# ---- notes ---------------------------------------------------------------------------

CATS = "['patterns', 'tripwires', 'architecture', 'testing']"


def category_of(expr: str) -> str:
    return f"CASE WHEN ({expr}) % 40 = 39 THEN 'other' ELSE ({CATS})[({expr}) % 4 + 1] END"


def render_sql(title, read_when, tw_text, last_updated, ids_text, body) -> str:
    """Rendered note text; ``tw_text`` is the full tripwires block."""
    return f"""('---' || chr(10)
  || CASE WHEN {title} IS NOT NULL THEN 'title: "' || {title} || '"' || chr(10) ELSE '' END
  || 'read_when:' || chr(10)
  || coalesce(array_to_string(list_transform({read_when}, lambda x: '  - "' || x || '"' || chr(10)), ''), '')
  || {tw_text}
  || 'last_updated: "' || {last_updated} || '"' || chr(10)
  || 'source_issues: [' || {ids_text} || ']' || chr(10) || '---' || chr(10) || chr(10) || {body} || chr(10))"""


NOTE_TW = ("CASE WHEN has_tw THEN 'tripwires:' || chr(10) || '  - action: \"editing ' || source || '\"' || chr(10) "
           "|| '    warning: \"check ' || lang || '\"' || chr(10) ELSE 'tripwires: []' || chr(10) END")

NOTES_BASE = f"""notes0 AS (
  SELECT doc_id, concat('r', doc_id % 10) AS repo, {category_of('doc_id')} AS category,
         concat('n', doc_id) AS slug,
         CASE WHEN doc_id % 11 = 0 THEN NULL ELSE concat('Note ', doc_id) END AS title,
         (['lang ' || lang, 'source ' || source])[1:CAST(doc_id % 3 AS INTEGER)] AS read_when,
         doc_id % 5 = 0 AS has_tw, source, lang,
         DATE '2024-01-01' + CAST(doc_id % 28 AS INTEGER) AS last_updated,
         [doc_id % 50, doc_id % 50 + 7] AS source_issues,
         text AS body
  FROM documents),
notes AS (
  SELECT *, {render_sql('title', 'read_when', NOTE_TW, "strftime(last_updated, '%Y-%m-%d')",
                        "concat(doc_id % 50, ', ', doc_id % 50 + 7)", 'body')} AS content,
         list_position({CATS}, category) AS rank, slug || '.md' AS fname
  FROM notes0)"""

SCANNED = f"""scanned AS (SELECT * FROM notes WHERE category IN ('patterns', 'tripwires', 'architecture', 'testing'))"""


def parts_sql(src: str, piece: str, sep: str, order: str, out: str, part_rows: int = 2000) -> str:
    return f"""SELECT repo, CAST((ord - 1) // {part_rows} AS BIGINT) AS part, count(*) AS n_items,
       string_agg({piece}, {sep} ORDER BY ord) AS {out}
FROM (SELECT *, row_number() OVER (PARTITION BY repo ORDER BY {order}) AS ord FROM {src})
GROUP BY repo, part"""


def text_parts_sql(src: str, piece: str, sep: str, order: str, out: str, size: int = 1_000_000, lead: str = "''") -> str:
    """The whole text of each repo, then its characters k * size and on."""
    return f"""
, pieces AS (SELECT repo, row_number() OVER w AS ord,
                    CASE WHEN row_number() OVER w = 1 THEN {lead} ELSE {sep} END || coalesce({piece}, '') AS p
             FROM {src} WINDOW w AS (PARTITION BY repo ORDER BY {order}))
, begins AS (SELECT repo, coalesce(sum(length(p)) OVER (PARTITION BY repo ORDER BY ord
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // {size} AS part FROM pieces)
, whole AS (SELECT repo, string_agg(p, '' ORDER BY ord) AS t FROM pieces GROUP BY repo)
, parts AS (SELECT repo, CAST(unnest(range(0, (length(t) + {size} - 1) // {size})) AS BIGINT) AS part, t FROM whole)
, cut AS (SELECT p.repo, p.part, (SELECT count(*) FROM begins b WHERE b.repo = p.repo AND b.part = p.part) AS n_items,
                 substr(t, p.part * {size} + 1, {size}) AS {out}
          FROM parts p)
SELECT repo, part, n_items, {out} FROM cut"""


SQL["render_notes"] = with_(NOTES_BASE) + """
SELECT repo, category, slug, category || '/' || slug || '.md' AS path, content FROM notes"""

SQL["scan_notes"] = with_(NOTES_BASE, SCANNED) + "SELECT repo, category, slug, CAST(rank AS BIGINT) AS rank, content FROM scanned"

SQL["note_files"] = with_(NOTES_BASE, SCANNED) + """
SELECT repo, category, slug, CAST(rank AS BIGINT) AS rank, category || '/' || fname AS path, content FROM scanned"""

SQL["ordered_notes"] = with_(NOTES_BASE, SCANNED) + """
SELECT repo, category, slug, CAST(row_number() OVER (PARTITION BY repo ORDER BY rank, fname) AS BIGINT) AS ord
FROM scanned"""

DIGEST = ("scanned", "'### [' || category || '/' || slug || ']' || chr(10) || content || chr(10) || chr(10)",
          "''", "rank, fname", "digest")
SQL["notes_digest"] = with_(NOTES_BASE, SCANNED) + text_parts_sql(*DIGEST)
SQL["notes_digest_parts"] = with_(NOTES_BASE, SCANNED) + text_parts_sql(*DIGEST, size=1500)

HOOKS = """hooks AS (
  SELECT concat('r', doc_id % 10) AS repo,
         CASE WHEN doc_id % 7 = 0 THEN 'README.md' WHEN doc_id % 7 = 1 THEN 'x.txt'
              ELSE concat('h', doc_id, '.md') END AS path, lang AS text
  FROM documents)"""

SQL["hooks_concat"] = with_(HOOKS) + """, h AS (SELECT * FROM hooks WHERE path LIKE '%.md' AND path <> 'README.md')
""" + text_parts_sql("h", "text", "chr(10) || chr(10)", "path", "hooks")

ROUTING = """routing AS (
  SELECT repo, category, slug, rank, fname, '@memory/' || category || '/' || slug || '.md' AS file,
         coalesce(title, slug) AS title,
         CASE WHEN len(read_when) = 0 THEN '—' ELSE array_to_string(read_when, '; ') END AS read_when
  FROM scanned)"""

SQL["routing_index"] = with_(NOTES_BASE, SCANNED, ROUTING) + """
SELECT repo, category, slug, file, title, read_when,
       '| ' || file || ' | ' || title || ' | ' || read_when || ' |' AS line
FROM routing"""

SQL["routing_index_text"] = with_(NOTES_BASE, SCANNED, ROUTING) + text_parts_sql(
    "routing", "'| ' || file || ' | ' || title || ' | ' || read_when || ' |' || chr(10)", "''", "rank, fname", "index_text",
    size=700, lead="'| File | Title | Read when |' || chr(10) || '|------|-------|-----------|' || chr(10)") + """
UNION ALL SELECT repo, 0, 0, '_No learnings yet._' || chr(10)
FROM (SELECT DISTINCT concat('r', p_size % 12) AS repo FROM part) WHERE repo NOT IN (SELECT repo FROM routing)"""

SQL["note_catalog"] = with_(NOTES_BASE, SCANNED) + """
SELECT repo, category, slug, title, array_to_string(read_when, '|') AS read_when,
       strftime(last_updated, '%Y-%m-%d') AS last_updated, array_to_string(source_issues, ',') AS source_issues,
       body
FROM scanned"""

AUDIT = ("scanned", "'### ' || category || '/' || slug || chr(10) || content || chr(10)", "chr(10)", "rank, fname", "files")
SQL["audit_prompt"] = with_(NOTES_BASE, SCANNED) + text_parts_sql(*AUDIT)
SQL["audit_prompt_parts"] = with_(NOTES_BASE, SCANNED) + text_parts_sql(*AUDIT, size=2048)

ITEMS = f"""items AS (
  SELECT concat('r', doc_id % 10) AS repo, doc_id AS issue, doc_id AS pos,
         ({CATS})[(doc_id % 100) % 4 + 1] AS category, concat('n', doc_id % 100) AS slug,
         concat('Learning ', doc_id) AS title,
         CASE WHEN quality = 0 THEN []::VARCHAR[] ELSE [concat('touching area ', doc_id % 7)] END AS read_when,
         CASE WHEN toxic = 1 THEN concat('act ', doc_id, '=>warn ', doc_id) ELSE '' END AS tw,
         concat('Learned from ', doc_id) AS body
  FROM labels)"""

SQL["union_issues"] = with_(NOTES_BASE, ITEMS) + """
, agg AS (SELECT repo, category, slug, list(issue) AS new FROM items GROUP BY ALL)
SELECT a.repo, a.category, a.slug,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(n.source_issues, []::BIGINT[]), a.new))), ',')
         AS source_issues
FROM agg a LEFT JOIN notes n USING (repo, category, slug)"""

SQL["upsert_notes"] = with_(NOTES_BASE, ITEMS) + """
, agg AS (SELECT repo, category, slug, arg_max(title, pos) AS title, arg_max(read_when, pos) AS read_when,
                 arg_max(tw, pos) AS tw, arg_max(body, pos) AS body, list(issue) AS new
          FROM items GROUP BY ALL)
, old AS (SELECT repo, category, slug, title, read_when,
                 CASE WHEN has_tw THEN 'editing ' || source || '=>check ' || lang ELSE '' END AS tw,
                 last_updated, source_issues, body FROM notes)
SELECT coalesce(a.repo, o.repo) AS repo, coalesce(a.category, o.category) AS category,
       coalesce(a.slug, o.slug) AS slug,
       CASE WHEN a.slug IS NOT NULL THEN a.title ELSE o.title END AS title,
       array_to_string(CASE WHEN a.slug IS NOT NULL THEN a.read_when ELSE o.read_when END, '|') AS read_when,
       CASE WHEN a.slug IS NOT NULL THEN a.tw ELSE o.tw END AS tripwires,
       CASE WHEN a.slug IS NOT NULL THEN '2024-02-01' ELSE strftime(o.last_updated, '%Y-%m-%d') END AS last_updated,
       array_to_string(CASE WHEN a.slug IS NOT NULL
            THEN list_sort(list_distinct(list_concat(coalesce(o.source_issues, []::BIGINT[]), a.new)))
            ELSE o.source_issues END, ',') AS source_issues,
       CASE WHEN a.slug IS NOT NULL THEN a.body ELSE o.body END AS body,
       CASE WHEN a.slug IS NULL THEN 'unchanged' WHEN o.slug IS NULL THEN 'insert' ELSE 'update' END AS change
FROM agg a FULL OUTER JOIN old o ON a.repo = o.repo AND a.category = o.category AND a.slug = o.slug"""

SQL["upsert_snapshot"] = SQL["upsert_notes"].replace(
    "FROM items GROUP BY ALL)", "FROM items WHERE repo IN ('r0', 'r4') GROUP BY ALL)").replace(
    """,
       CASE WHEN a.slug IS NULL THEN 'unchanged' WHEN o.slug IS NULL THEN 'insert' ELSE 'update' END AS change""", "")

AFTER = """agg AS (SELECT repo, category, slug, arg_max(title, pos) AS title, arg_max(read_when, pos) AS read_when, list(issue) AS new
          FROM items WHERE repo IN ('r0', 'r4') GROUP BY ALL),
after AS (SELECT * FROM (
  SELECT coalesce(a.repo, o.repo) AS repo, coalesce(a.category, o.category) AS category, coalesce(a.slug, o.slug) AS slug,
         CASE WHEN a.slug IS NOT NULL THEN a.title ELSE o.title END AS title,
         CASE WHEN a.slug IS NOT NULL THEN a.read_when ELSE o.read_when END AS read_when,
         CASE WHEN a.slug IS NOT NULL THEN '2024-02-01' ELSE strftime(o.last_updated, '%Y-%m-%d') END AS last_updated,
         CASE WHEN a.slug IS NOT NULL
              THEN list_sort(list_distinct(list_concat(coalesce(o.source_issues, []::BIGINT[]), a.new)))
              ELSE o.source_issues END AS source_issues
  FROM agg a FULL OUTER JOIN notes o ON a.repo = o.repo AND a.category = o.category AND a.slug = o.slug)
  WHERE category IN ('patterns', 'tripwires', 'architecture', 'testing')
    AND NOT (repo = 'r4' AND CAST(substr(slug, 2) AS BIGINT) % 9 = 0))"""

SQL["index_view"] = with_(NOTES_BASE, ITEMS, AFTER) + """
, l AS (SELECT repo, category, slug || '.md' AS name,
               '| @memory/' || category || '/' || slug || '.md | ' || coalesce(title, slug) || ' | '
               || CASE WHEN len(read_when) = 0 THEN '—' ELSE array_to_string(read_when, '; ') END || ' |' || chr(10) AS line
        FROM after)
, s AS (SELECT *, coalesce(max(CASE WHEN md5(repo || '/' || category || '/' || name)[1] = '0' THEN name END)
                           OVER (PARTITION BY repo, category ORDER BY name), '') AS start FROM l)
SELECT repo, category, start, count(*) AS n_items, string_agg(line, '' ORDER BY name) AS text
FROM s GROUP BY repo, category, start"""

SQL["catalog_update"] = with_(NOTES_BASE, ITEMS, AFTER) + """
SELECT repo, category, slug, title, array_to_string(read_when, '|') AS read_when, last_updated,
       array_to_string(source_issues, ',') AS source_issues
FROM after"""

SQL["snapshot_partitions"] = with_(NOTES_BASE, ITEMS) + """
, hit AS (SELECT DISTINCT repo, category, slug FROM items WHERE repo IN ('r0', 'r4'))
, keys AS (SELECT repo, category, slug FROM notes UNION SELECT repo, category, slug FROM hit)
SELECT k.repo, k.category, count(*) AS rows,
       (k.repo, k.category) NOT IN (SELECT (repo, category) FROM hit) AS shared
FROM keys k GROUP BY k.repo, k.category"""

ACTIONS = f"""actions AS (
  SELECT n.repo, l.doc_id AS pos,
         CASE WHEN toxic = 1 THEN 'delete' WHEN quality = 0 THEN 'merge_into' ELSE 'keep' END AS action,
         n.category, n.slug,
         CASE WHEN toxic = 1 THEN 'low value' WHEN quality = 0 THEN 'same insight' END AS reason,
         CASE WHEN toxic <> 1 AND quality = 0 THEN {category_of('l.doc_id + 10')} END AS target_category,
         CASE WHEN toxic <> 1 AND quality = 0 THEN
              CASE WHEN l.doc_id % 5 = 0 THEN concat('n', l.doc_id + 10000000) ELSE concat('n', l.doc_id + 10) END
         END AS target_slug,
         CASE WHEN toxic <> 1 AND quality = 0 AND l.doc_id % 2 = 1 THEN concat('Merged body ', l.doc_id) END
           AS target_updated_body
  FROM labels l JOIN notes n ON n.doc_id = l.doc_id
  WHERE n.category IN ('patterns', 'tripwires', 'architecture', 'testing'))"""

SQL["compact_merge"] = with_(NOTES_BASE, ACTIONS) + """
, m AS (SELECT a.*, s.source_issues AS src_ids FROM actions a
        LEFT JOIN notes s ON s.repo = a.repo AND s.category = a.category AND s.slug = a.slug
        WHERE a.action = 'merge_into' AND a.target_category IS NOT NULL AND a.target_slug IS NOT NULL)
, b AS (SELECT repo, target_category, target_slug, max(pos) FILTER (WHERE target_updated_body IS NOT NULL) AS b_pos,
               arg_max(target_updated_body, pos) FILTER (WHERE target_updated_body IS NOT NULL) AS b_body
        FROM m GROUP BY ALL)
, t AS (SELECT m.repo, m.target_category AS category, m.target_slug AS slug, count(*) AS n_sources,
               flatten(list(coalesce(m.src_ids, []::BIGINT[]))) AS add_ids, any_value(b.b_body) AS b_body,
               count(*) FILTER (WHERE b.b_pos IS NULL OR m.pos > b.b_pos) AS k
        FROM m JOIN b USING (repo, target_category, target_slug) GROUP BY ALL)
, j AS (SELECT t.*, n.title, n.read_when, n.has_tw, n.source, n.lang, n.body,
               list_sort(list_distinct(list_concat(n.source_issues, t.add_ids))) AS ids
        FROM t JOIN notes n USING (repo, category, slug))
SELECT repo, category, slug, n_sources, array_to_string(ids, ',') AS source_issues,
       b_body IS NOT NULL AS body_replaced,
       """ + render_sql("title", "read_when", NOTE_TW, "'2024-02-01'", "array_to_string(ids, ', ')",
                        "coalesce(b_body, body)") + """ || repeat(chr(10), CAST(k AS INTEGER)) AS content
FROM j"""

CHAINS = """first_merge AS (SELECT a.repo, a.category, a.slug, arg_min(a.target_category, a.pos) AS tc, arg_min(a.target_slug, a.pos) AS ts
  FROM actions a JOIN notes n ON n.repo = a.repo AND n.category = a.target_category AND n.slug = a.target_slug
  WHERE a.action = 'merge_into' GROUP BY ALL),
walk AS (SELECT repo, category, slug, tc, ts, CAST(1 AS BIGINT) AS hops FROM first_merge
  UNION ALL SELECT w.repo, w.category, w.slug, e.tc, e.ts, w.hops + 1
  FROM walk w JOIN first_merge e ON e.repo = w.repo AND e.category = w.tc AND e.slug = w.ts),
finals AS (SELECT * FROM walk w WHERE NOT EXISTS (
  SELECT 1 FROM first_merge e WHERE e.repo = w.repo AND e.category = w.tc AND e.slug = w.ts))"""


def recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


SQL["merge_chains"] = recursive(with_(NOTES_BASE, ACTIONS, CHAINS)) + """
SELECT repo, category, slug, tc AS final_category, ts AS final_slug, hops FROM finals"""

SQL["compact_merge_chains"] = recursive(with_(NOTES_BASE, ACTIONS, CHAINS)) + """
, m AS (SELECT a.repo, coalesce(f.tc, a.target_category) AS category, coalesce(f.ts, a.target_slug) AS slug,
               CASE WHEN f.ts IS NULL THEN a.target_updated_body END AS new_body, s.source_issues AS src
        FROM actions a
        LEFT JOIN finals f ON f.repo = a.repo AND f.category = a.target_category AND f.slug = a.target_slug
        LEFT JOIN notes s ON s.repo = a.repo AND s.category = a.category AND s.slug = a.slug
        WHERE a.action = 'merge_into' AND a.target_category IS NOT NULL AND a.target_slug IS NOT NULL)
, t AS (SELECT repo, category, slug, count(*) AS n_sources, flatten(list(coalesce(src, []::BIGINT[]))) AS ids,
               bool_or(new_body IS NOT NULL) AS body_replaced
        FROM m GROUP BY repo, category, slug)
SELECT repo, category, slug, n_sources,
       array_to_string(list_sort(list_distinct(list_concat(n.source_issues, t.ids))), ',') AS source_issues, body_replaced
FROM t JOIN notes n USING (repo, category, slug)"""

SQL["source_issue_rows"] = with_(NOTES_BASE, ITEMS) + """
SELECT repo, category, slug, unnest(source_issues) AS issue FROM notes
UNION SELECT repo, category, slug, issue FROM items"""

SQL["decode_actions"] = with_(NOTES_BASE, ACTIONS) + """
SELECT repo, pos // 160 AS reply_no,
       CAST(row_number() OVER (PARTITION BY repo, pos // 160 ORDER BY pos) - 1 AS BIGINT) AS item_pos,
       action, category, slug, reason, target_category, target_slug, target_updated_body
FROM actions WHERE (pos // 160) % 5 <> 4"""

SQL["action_rejects"] = with_(NOTES_BASE, ACTIONS) + """
SELECT DISTINCT repo, pos // 160 AS reply_no, 'no json array' AS reason FROM actions WHERE (pos // 160) % 5 = 4"""

SQL["audit_to_compaction"] = with_(NOTES_BASE, ACTIONS) + """
, acc AS (SELECT * FROM actions WHERE (pos // 160) % 5 <> 4)
, m AS (SELECT a.*, s.source_issues AS src FROM acc a
        JOIN notes n ON n.repo = a.repo AND n.category = a.target_category AND n.slug = a.target_slug
        LEFT JOIN notes s ON s.repo = a.repo AND s.category = a.category AND s.slug = a.slug
        WHERE a.action = 'merge_into')
, t AS (SELECT repo, target_category AS category, target_slug AS slug, flatten(list(coalesce(src, []::BIGINT[]))) AS ids,
               arg_max(target_updated_body, pos) FILTER (WHERE target_updated_body IS NOT NULL) AS new_body
        FROM m GROUP BY ALL)
, gone AS (SELECT repo, category, slug FROM acc WHERE action = 'delete' UNION SELECT repo, category, slug FROM m)
SELECT n.repo, n.category, n.slug,
       array_to_string(CASE WHEN t.slug IS NULL THEN n.source_issues
                            ELSE list_sort(list_distinct(list_concat(n.source_issues, t.ids))) END, ',') AS source_issues,
       CASE WHEN t.slug IS NULL THEN strftime(n.last_updated, '%Y-%m-%d') ELSE '2024-02-01' END AS last_updated,
       coalesce(t.new_body, n.body) AS body
FROM notes n LEFT JOIN t ON t.repo = n.repo AND t.category = n.category AND t.slug = n.slug
WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.repo = n.repo AND g.category = n.category AND g.slug = n.slug)"""

SQL["compact_delete"] = with_(NOTES_BASE, ACTIONS) + """
SELECT a.repo, a.category, a.slug, arg_min(a.action, a.pos) AS removed_by
FROM actions a JOIN notes n USING (repo, category, slug)
WHERE a.action IN ('delete', 'merge_into') GROUP BY a.repo, a.category, a.slug"""

SQL["orphan_merges"] = with_(NOTES_BASE, ACTIONS) + """
SELECT a.repo, a.category, a.slug, a.pos, a.target_category, a.target_slug,
       CASE WHEN a.target_category IS NULL OR a.target_slug IS NULL THEN 'no target given' ELSE 'target missing' END
         AS reason
FROM actions a LEFT JOIN notes n ON n.repo = a.repo AND n.category = a.target_category AND n.slug = a.target_slug
WHERE a.action = 'merge_into' AND n.slug IS NULL"""

SQL["audit_coverage"] = with_(NOTES_BASE, SCANNED, ACTIONS) + """
, per AS (SELECT repo, category, slug, count(*) AS n_actions FROM actions GROUP BY ALL)
SELECT * FROM (
  SELECT coalesce(s.repo, p.repo) AS repo, coalesce(s.category, p.category) AS category,
         coalesce(s.slug, p.slug) AS slug, coalesce(p.n_actions, 0) AS n_actions,
         CASE WHEN s.slug IS NULL THEN 'unknown_file' WHEN p.n_actions IS NULL THEN 'no_action'
              WHEN p.n_actions > 1 THEN 'repeated' END AS issue
  FROM scanned s FULL OUTER JOIN per p ON s.repo = p.repo AND s.category = p.category AND s.slug = p.slug)
WHERE issue IS NOT NULL"""

for _name in ("upsert_notes", "compact_merge", "compact_delete", "audit_coverage"):
    SQL[f"{_name}_bucketed"] = SQL[_name]

SQL["action_counts"] = with_(NOTES_BASE, ACTIONS) + """
SELECT repo, count(*) FILTER (WHERE action = 'keep') AS n_keep, count(*) FILTER (WHERE action = 'delete') AS n_delete,
       count(*) FILTER (WHERE action = 'merge_into') AS n_merge
FROM actions GROUP BY repo"""

SQL["content_drift"] = """
WITH expected AS (SELECT concat('docs/', doc_id, '.md') AS path, text AS content FROM documents),
actual AS (SELECT concat('docs/', doc_id, '.md') AS path,
                  CASE WHEN doc_id % 10 = 1 THEN text || ' (edited)' ELSE text END AS content
           FROM documents WHERE doc_id % 10 <> 0)
SELECT e.path, CASE WHEN a.path IS NULL THEN 'missing' WHEN sha256(a.content) <> sha256(e.content) THEN 'stale'
                    ELSE 'current' END AS status
FROM expected e LEFT JOIN actual a USING (path)"""

TREE = "concat('t', lpad(CAST(doc_id % 64 AS VARCHAR), 2, '0'))"
SQL["tree_drift"] = f"""
SELECT concat({TREE}, '/', doc_id, '.md') AS path,
       CASE WHEN doc_id % 64 = 3 AND doc_id % 2 = 1 THEN 'missing' WHEN doc_id % 64 = 5 AND doc_id % 3 = 0 THEN 'stale'
            ELSE 'current' END AS status
FROM documents"""

SQL["tree_nodes"] = f"""
SELECT DISTINCT {TREE} AS prefix FROM documents WHERE doc_id % 64 = 3 OR doc_id % 64 = 5 AND doc_id % 3 = 0"""

SECTION_SQL = ("'<!-- loom:start -->' || chr(10) || '## Memory' || chr(10) || chr(10) || "
               "CASE WHEN has_index THEN '@memory/index.md' ELSE '_No learnings yet._' END || chr(10) || chr(10) "
               "|| '<!-- loom:end -->'")

SQL["managed_block"] = with_(NOTES_BASE) + f"""
, pg AS (SELECT page_id, concat('r', page_id % 10) AS repo, html,
                concat('r', page_id % 10) IN (SELECT DISTINCT repo FROM notes) AS has_index FROM pages)
, out AS (SELECT page_id, repo,
                 CASE WHEN page_id % 2 = 0 THEN 'replaced' WHEN html = '' THEN 'created' ELSE 'appended' END AS action,
                 CASE WHEN page_id % 2 = 0 THEN html || chr(10) || {SECTION_SQL} || chr(10) || 'trailer' || chr(10)
                      WHEN html = '' THEN {SECTION_SQL}
                      ELSE regexp_replace(html, '{WS}+$', '') || chr(10) || chr(10) || {SECTION_SQL} END AS text
          FROM pg)
SELECT page_id, repo, action, CAST(length(text) AS BIGINT) AS text_len, sha256(text) AS text_sha FROM out"""

SQL["marker_span"] = """
SELECT page_id, CASE WHEN regexp_matches(html, '(?s)<!-- ad (.*?) -->')
                     THEN regexp_extract(html, '(?s)<!-- ad (.*?) -->', 1) END AS span
FROM pages"""


# ---- text extraction jobs -----------------------------------------------------------------

def tables_cte(part_rows: int = 10_000) -> str:
    """Rendered table and state blob of each objective's parts."""
    return f"""bl AS (SELECT repo, objective, pos, string_agg(dep_id, ', ' ORDER BY dep_pos) AS blocked
               FROM blocked GROUP BY ALL),
tables AS (
  SELECT n.repo, n.objective, CAST((n.pos - 1) // {part_rows} AS BIGINT) AS part,
         CASE WHEN (n.pos - 1) // {part_rows} = 0 THEN {ROADMAP_HEADER_SQL} || chr(10) ELSE '' END
         || string_agg('| ' || concat_ws(' | ', node_id, description, status,
                CASE WHEN plan_issue IS NOT NULL THEN concat('#', plan_issue) ELSE '' END,
                coalesce(pr_url, ''), coalesce(bl.blocked, '')) || ' |', chr(10) ORDER BY n.pos) AS tbl
  FROM nodes n LEFT JOIN bl USING (repo, objective, pos) GROUP BY n.repo, n.objective, (n.pos - 1) // {part_rows}),
blobs AS (
  SELECT repo, objective, CAST((pos - 1) // {part_rows} AS BIGINT) AS part,
         '<!-- loom:nodes [' || string_agg({NODE_JSON_SQL}, ',' ORDER BY pos) || '] -->' AS blob
  FROM nodes GROUP BY repo, objective, (pos - 1) // {part_rows})"""


TABLES = tables_cte()
REWRITTEN = """
SELECT t.repo, t.objective, part, concat('Objective ', t.objective) AS title,
  CASE WHEN part > 0 THEN t.tbl || chr(10) || chr(10) || b.blob ELSE
  '## Goal' || chr(10) || concat('Deliver objective ', t.objective) || chr(10) || chr(10) || '## Roadmap'
  || chr(10) || chr(10) || t.tbl || chr(10) || chr(10) || b.blob
  || CASE WHEN t.objective % 2 = 0 THEN chr(10) || chr(10) || '## Notes' || chr(10) || 'Keep scope small.' || chr(10)
          ELSE '' END END AS body
FROM tables t JOIN blobs b USING (repo, objective, part)"""


SQL["extract_roadmaps"] = with_(nodes_cte()) + """
SELECT repo, objective, pos, node_id, description, 'pending' AS status, CAST(NULL AS BIGINT) AS plan_issue,
       CAST(NULL AS VARCHAR) AS pr_url,
       array_to_string(list_filter(depends_on, lambda x: NOT starts_with(x, 'x')), ',') AS depends_on
FROM nodes"""

SQL["roadmap_rejects"] = with_(nodes_cte()) + """
SELECT DISTINCT repo, objective, CASE WHEN objective % 7 = 3 THEN 'no section' ELSE 'no nodes' END AS reason
FROM nodes WHERE objective % 7 IN (3, 5)"""

SQL["node_state_rejects"] = with_(nodes_cte()) + """
SELECT DISTINCT repo, objective, CASE objective % 7 WHEN 2 THEN 'no marker' WHEN 3 THEN 'bad state: malformed json'
       WHEN 5 THEN 'bad state: wrong json type'
       ELSE 'bad state: missing or invalid field' END AS reason
FROM nodes WHERE objective % 7 IN (2, 3, 5, 6)"""

SQL["load_node_state"] = with_(nodes_cte()) + f"SELECT {NODE_COLS} FROM nodes"

SQL["node_state_round_trip"] = SQL["load_node_state"]

SQL["rewrite_roadmap"] = with_(nodes_cte(), FIRST, EDGES, BLOCKED, TABLES) + REWRITTEN
SQL["rewrite_roadmap_parts"] = with_(nodes_cte(), FIRST, EDGES, BLOCKED, tables_cte(3)) + REWRITTEN

SECTIONS = [("Why", "**Why"), ("Background", "**Background"), ("Approach", "**Approach"),
            ("Acceptance criteria", "**Acceptance criteria"), ("Scope", "**Scope"),
            ("Edge cases and risks", "**Edge cases"), ("Key files", "**Key files")]

PLAN_BODIES = "plan_bodies AS (SELECT doc_id, lang, text, concat(" + ", ".join(
    f"CASE WHEN (doc_id & {1 << i}) <> 0 THEN '**{name}** x ' ELSE '' END" for i, (name, _) in enumerate(SECTIONS)
) + ", text) AS body FROM documents)"

SQL["section_coverage"] = with_(PLAN_BODIES) + "\n" + "\nUNION ALL\n".join(
    f"""SELECT lang, '{name}' AS section, count(*) AS n_docs,
       count(*) FILTER (WHERE (doc_id & {1 << i}) <> 0 OR contains(text, '{prefix}')) AS n_present
FROM plan_bodies GROUP BY lang""" for i, (name, prefix) in enumerate(SECTIONS))

SQL["decode_replies"] = f"""
WITH acc AS (SELECT doc_id FROM labels WHERE doc_id % 5 IN (0, 1, 2) AND NOT (doc_id % 2 = 0 AND quality = 0)),
items AS (SELECT doc_id AS id, 0 AS item_pos, '' AS tag FROM acc
          UNION ALL SELECT doc_id, 1, 'x' FROM acc WHERE doc_id % 2 = 0)
SELECT id, CAST(item_pos AS BIGINT) AS item_pos, ({CATS})[id % 4 + 1] AS category, concat('s', id, tag) AS slug,
       concat('t', id, tag) AS title, concat('w', id) AS read_when,
       CASE WHEN id % 3 = 0 THEN concat('a', id, '=>x', id) ELSE '' END AS tripwires, concat('b', id, tag) AS body
FROM items"""

SQL["reply_rejects"] = """
SELECT doc_id AS id, CASE WHEN doc_id % 5 = 3 THEN 'no json array' WHEN doc_id % 5 = 4 THEN 'malformed json'
                          ELSE 'missing or invalid field' END AS reason
FROM labels WHERE doc_id % 5 IN (3, 4) OR (doc_id % 2 = 0 AND quality = 0)"""

SQL["age_histogram"] = f"""
SELECT age, count(*) AS n FROM (SELECT {age_sql("CAST(ts AS DATE)", "2024-01-30")} AS age FROM events) GROUP BY age"""

SQL["truncation_report"] = with_(PLAN_BODIES) + """
SELECT lang, count(*) AS n_texts, count(*) FILTER (WHERE length(body) > 8000) AS n_truncated,
       count(*) FILTER (WHERE strlen(body) > 8000) AS n_over_bytes,
       CAST(sum(least(length(body), 8000)) AS BIGINT) AS kept_chars
FROM plan_bodies GROUP BY lang"""


# ---- life cycle and prompts ----------------------------------------------------------------

UNBLOCKED = """unblocked AS (
  SELECT n.* FROM nodes n WHERE status = 'pending'
    AND NOT EXISTS (SELECT 1 FROM blocked b WHERE b.repo = n.repo AND b.objective = n.objective AND b.pos = n.pos))"""

SQL["plan_guard"] = with_(nodes_cte()) + """
SELECT repo, objective, pos, node_id, CASE WHEN plan_issue IS NOT NULL THEN 'rejected' ELSE 'accepted' END AS outcome,
       CASE WHEN plan_issue IS NOT NULL THEN concat('plan #', plan_issue, ' holds node ', node_id) END AS reason
FROM nodes"""

SQL["start_nodes"] = with_(nodes_cte(), FIRST, EDGES, BLOCKED, UNBLOCKED) + """
SELECT repo, objective, pos, node_id, 'in_progress' AS status, CAST(node_id AS BIGINT) + 2000000 AS plan_issue,
       concat('[', node_id, '] ', description) AS title,
       concat('Objective: #', objective, ' (node ', node_id, ')') || chr(10) || chr(10) AS body
FROM unblocked WHERE CAST(node_id AS BIGINT) % 50 <> 0"""

SQL["finish_nodes"] = with_(nodes_cte(), FIRST, ISSUES) + """
SELECT i.repo, i.o_custkey AS objective, CAST(i.o_orderkey AS VARCHAR) AS node_id, i.number AS plan, f.pos,
       CASE WHEN f.pos IS NOT NULL THEN 'marked_done'
            WHEN (i.repo, i.o_custkey) IN (SELECT (repo, objective) FROM nodes) THEN 'node_not_found'
            ELSE 'objective_not_found' END AS outcome
FROM issues i LEFT JOIN first_nodes f
  ON f.repo = i.repo AND f.objective = i.o_custkey AND f.node_id = CAST(i.o_orderkey AS VARCHAR)
WHERE i.state = 'CLOSED' AND list_contains(i.labels, 'plan') AND i.o_orderkey % 2 = 0 AND i.o_orderkey % 26 <> 5"""

SQL["close_objectives"] = with_(nodes_cte(small=True), ISSUES) + """
, done AS (SELECT repo, objective, count(*) AS n_nodes FROM nodes GROUP BY ALL HAVING bool_and(status = 'done'))
SELECT d.repo, d.objective, d.n_nodes FROM done d JOIN issues i ON i.repo = d.repo AND i.number = d.objective
WHERE i.state <> 'CLOSED'"""

PENDING_NODES = nodes_cte(name="nodes0") + """,
nodes AS (SELECT repo, objective, pos, node_id, description, 'pending' AS status, CAST(NULL AS BIGINT) AS plan_issue,
                 CAST(NULL AS VARCHAR) AS pr_url, list_filter(depends_on, lambda x: NOT starts_with(x, 'x')) AS depends_on
          FROM nodes0)"""

SQL["create_objectives"] = with_(PENDING_NODES, FIRST, EDGES, BLOCKED, TABLES) + REWRITTEN

SQL["create_plans"] = with_(PLAN_BODIES) + """
SELECT doc_id, concat('Draft ', doc_id) AS title, CAST(""" + " + ".join(
    f"CASE WHEN (doc_id & {1 << i}) <> 0 OR contains(text, '{p}') THEN 0 ELSE 1 END"
    for i, (_, p) in enumerate(SECTIONS)) + """ AS BIGINT) AS n_missing,
       concat_ws(', ', """ + ", ".join(
    f"CASE WHEN NOT ((doc_id & {1 << i}) <> 0 OR contains(text, '{p}')) THEN '{n}' END"
    for i, (n, p) in enumerate(SECTIONS)) + """) AS missing
FROM plan_bodies"""

TOLD = """told AS (SELECT i.repo, i.number AS issue, string_agg(c.text, chr(10) || chr(10) ORDER BY c.turn) AS t
  FROM issues i JOIN conversations c ON c.conv_id = i.number
  WHERE c.text IS NOT NULL AND c.text <> '' GROUP BY i.repo, i.number)"""

SQL["attach_conversation"] = with_(ISSUES, TOLD) + """
, parts AS (SELECT repo, issue, t, CAST(unnest(range(0, (length(t) + 699) // 700)) AS BIGINT) AS seq FROM told)
SELECT repo, issue, seq, CASE WHEN seq = 0 THEN '<!-- loom:conversation -->' ELSE '<!-- loom:conversation more -->' END
       || chr(10) || substr(t, seq * 700 + 1, 700) AS body
FROM parts"""

SQL["conversation_round_trip"] = with_(ISSUES, TOLD) + f"SELECT repo, issue, {trim_ws('t')} AS conversation FROM told"

ACCEPTED = """accepted AS (SELECT doc_id AS id FROM labels
                     WHERE doc_id % 5 IN (0, 1, 2) AND NOT (doc_id % 2 = 0 AND quality = 0)),
rejected AS (SELECT doc_id AS id FROM labels WHERE NOT (doc_id % 5 IN (0, 1, 2) AND NOT (doc_id % 2 = 0 AND quality = 0)))"""

SQL["mark_learned"] = with_(ISSUES, ACCEPTED) + """
SELECT repo, number, array_to_string(CASE WHEN list_contains(labels, 'learned') THEN labels
                                          ELSE list_append(labels, 'learned') END, ',') AS labels
FROM issues WHERE number IN (SELECT id FROM accepted)"""

OUTCOMES = """unlearned AS (SELECT repo, number FROM issues
                   WHERE state = 'CLOSED' AND list_contains(labels, 'plan') AND NOT list_contains(labels, 'learned')),
linked AS (SELECT repo, issue FROM latest WHERE closer_type = 'PullRequest' AND pr_state = 'MERGED'),
outcomes AS (
  SELECT u.repo, u.number,
         CASE WHEN l.issue IS NULL OR u.number IN (SELECT id FROM rejected) THEN 'failed'
              WHEN u.number IN (SELECT id FROM accepted) THEN 'learned' ELSE 'nothing_found' END AS outcome
  FROM unlearned u LEFT JOIN linked l ON l.repo = u.repo AND l.issue = u.number)"""

SQL["batch_summary"] = with_(ISSUES, CLOSE_EVENTS, LATEST, ACCEPTED, OUTCOMES) + """
SELECT repo, outcome, count(*) AS n FROM outcomes GROUP BY repo, outcome"""

SQL["batch_status"] = with_(ISSUES, CLOSE_EVENTS, LATEST, ACCEPTED, OUTCOMES) + """
SELECT CAST(1 AS BIGINT) AS version, count(*) FILTER (WHERE outcome = 'learned') AS n_learned,
       count(*) FILTER (WHERE outcome = 'nothing_found') AS n_nothing_found,
       count(*) FILTER (WHERE outcome = 'failed') AS n_failed,
       CASE WHEN count(*) FILTER (WHERE outcome = 'failed') > 0
            THEN concat(count(*) FILTER (WHERE outcome = 'failed'), ' issue(s) failed') ELSE 'ok' END AS status
FROM outcomes"""

SQL["land_nodes"] = with_(nodes_cte(), ISSUES, ACCEPTED) + """
, told AS (SELECT repo, number + 1000000 AS plan_issue,
                  CASE WHEN number IN (SELECT id FROM rejected) THEN 'failed'
                       WHEN number IN (SELECT id FROM accepted) THEN 'learned' ELSE 'nothing_found' END AS outcome
           FROM issues WHERE state = 'OPEN' AND number % 4 <> 3)
SELECT n.repo, n.objective, n.pos, n.node_id, n.plan_issue, coalesce(t.outcome, 'not_run') AS outcome,
       CASE WHEN t.outcome IN ('learned', 'nothing_found') THEN 'done' ELSE n.status END AS status
FROM nodes n LEFT JOIN told t ON t.repo = n.repo AND t.plan_issue = n.plan_issue
WHERE n.plan_issue IS NOT NULL AND n.status <> 'done'"""

SQL["ledger_unlearned"] = with_(ISSUES, ACCEPTED) + """
SELECT repo, number, title FROM issues
WHERE state = 'CLOSED' AND list_contains(labels, 'plan') AND NOT list_contains(labels, 'learned')
  AND number NOT IN (SELECT id FROM accepted)"""

SQL["ledger_runs"] = with_(ISSUES, ACCEPTED) + """
, n AS (SELECT count(*) FILTER (WHERE list_contains(labels, 'learned')) AS a,
               count(*) FILTER (WHERE NOT list_contains(labels, 'learned') AND number IN (SELECT id FROM accepted)) AS b FROM issues)
SELECT CAST(1 AS BIGINT) AS run, a AS told, a AS held FROM n UNION ALL SELECT 2, b, b FROM n UNION ALL SELECT 3, 0, 0"""

SQL["issue_list_text"] = with_(ISSUES, CLOSE_EVENTS, LATEST, ACCEPTED, OUTCOMES) + """
, l AS (SELECT * FROM outcomes WHERE outcome = 'learned')
""" + parts_sql("l", "concat('#', number)", "', '", "number", "issues", 5000)


def sql_template(template: str, fields: dict[str, str]) -> str:
    """SQL concatenation for a Python format template."""
    import string as _s
    parts = []
    for lit, field, _, _ in _s.Formatter().parse(template):
        if lit:
            parts.append(" || chr(10) || ".join("'" + seg.replace("'", "''") + "'" for seg in lit.split("\n"))
                         .replace("'' || ", "").replace(" || ''", ""))
        if field is not None:
            parts.append(f"({fields[field]})")
    return " || ".join(p for p in parts if p and p != "''")


CONTEXT = f"""unlearned AS (SELECT repo, number AS issue, title AS issue_title, coalesce(body, '') AS issue_body FROM issues
                   WHERE state = 'CLOSED' AND list_contains(labels, 'plan') AND NOT list_contains(labels, 'learned')),
linked AS (SELECT l.repo, l.issue, l.pr_number, p.title AS pr_title, p.body AS pr_body, p.diff
           FROM latest l JOIN pull_requests p ON p.repo = l.repo AND p.number = l.pr_number
           WHERE l.closer_type = 'PullRequest' AND l.pr_state = 'MERGED'),
conv AS (SELECT repo, issue, {trim_ws("arg_min(text, seq)")} AS conversation FROM comments
         WHERE role = 'assistant' GROUP BY repo, issue),
ctx AS (
  SELECT u.repo, u.issue, u.issue_title, u.issue_body, l.pr_number, l.pr_title, coalesce(l.pr_body, '') AS pr_body,
         coalesce(l.diff, '') AS diff, coalesce(c.conversation, '') AS conversation
  FROM unlearned u JOIN linked l ON l.repo = u.repo AND l.issue = u.issue
  LEFT JOIN conv c ON c.repo = u.repo AND c.issue = u.issue),
segments AS (
  SELECT repo, 'memory' AS kind, rank, fname AS name,
         '### [' || category || '/' || slug || ']' || chr(10) || content || chr(10) || chr(10) AS text FROM scanned
  UNION ALL
  SELECT repo, 'hooks', 0, path, text || chr(10) || chr(10) FROM hooks WHERE path LIKE '%.md' AND path <> 'README.md')"""

CTX_CTES = (ISSUES, CLOSE_EVENTS, LATEST, PRS, COMMENTS, NOTES_BASE, SCANNED, ROUTING, HOOKS, CONTEXT)

SQL["learn_context"] = with_(*CTX_CTES) + """
SELECT repo, issue, pr_number, sha256(issue_title) AS issue_title_sha, sha256(issue_body) AS issue_body_sha,
       sha256(pr_title) AS pr_title_sha, sha256(pr_body) AS pr_body_sha, sha256(conversation) AS conversation_sha,
       sha256(diff) AS diff_sha
FROM ctx"""

SQL["learn_context_rejects"] = with_(*CTX_CTES) + """
SELECT repo, issue, concat('#', issue, ' has no merged change') AS reason FROM unlearned u
WHERE NOT EXISTS (SELECT 1 FROM linked l WHERE l.repo = u.repo AND l.issue = u.issue)"""

SQL["repo_segments"] = with_(*CTX_CTES) + """
SELECT repo, kind, CAST(rank AS BIGINT) AS rank, name, CAST(length(text) AS BIGINT) AS n_chars, sha256(text) AS text_sha
FROM segments"""


def _learn_prompt_sql() -> str:
    from tallyloom.operators.prompts import LEARN_HEAD, LEARN_TAIL
    fields = {c: c for c in ("issue_title", "issue_body", "pr_title", "pr_body", "diff")}
    fields["conversation_section"] = (
        "CASE WHEN conversation = '' THEN '' ELSE chr(10) || '## Planning conversation' || chr(10) || conversation "
        "|| chr(10) END")
    return f"""
, p AS (SELECT repo, issue, 1 AS seg, 'text' AS kind, {sql_template(LEARN_HEAD, fields)} AS text FROM ctx
        UNION ALL SELECT c.repo, issue, 2, CASE WHEN s.repo IS NULL THEN 'text' ELSE 'memory' END,
                         CASE WHEN s.repo IS NULL THEN '_none yet_' END
                  FROM ctx c LEFT JOIN (SELECT DISTINCT repo FROM segments WHERE kind = 'memory') s ON s.repo = c.repo
        UNION ALL SELECT c.repo, issue, 3, 'hooks', NULL
                  FROM ctx c JOIN (SELECT DISTINCT repo FROM segments WHERE kind = 'hooks') s ON s.repo = c.repo
        UNION ALL SELECT repo, issue, 4, 'text', {sql_template(LEARN_TAIL, {})} FROM ctx)
SELECT repo, issue, CAST(seg AS BIGINT) AS seg, kind, CAST(length(text) AS BIGINT) AS n_chars, sha256(text) AS text_sha
FROM p"""


SQL["learn_prompt"] = with_(*CTX_CTES) + _learn_prompt_sql()

_NODE_OUT = ("repo, objective, pos, node_id, description, {status} AS status, {plan} AS plan_issue, pr_url, "
             "array_to_string(depends_on, ',') AS depends_on")

SQL["start_nodes_snapshot"] = with_(nodes_cte(), FIRST, EDGES, BLOCKED, UNBLOCKED) + """
, go AS (SELECT repo, objective, pos FROM unblocked WHERE CAST(node_id AS BIGINT) % 50 <> 0)
SELECT """ + _NODE_OUT.format(
    status="CASE WHEN (repo, objective, pos) IN (SELECT (repo, objective, pos) FROM go) THEN 'in_progress' ELSE status END",
    plan="CASE WHEN (repo, objective, pos) IN (SELECT (repo, objective, pos) FROM go) "
         "THEN CAST(node_id AS BIGINT) + 2000000 ELSE plan_issue END") + " FROM nodes"

SQL["finish_nodes_snapshot"] = with_(nodes_cte(), FIRST, ISSUES) + """
, go AS (SELECT f.repo, f.objective, f.pos FROM issues i JOIN first_nodes f
         ON f.repo = i.repo AND f.objective = i.o_custkey AND f.node_id = CAST(i.o_orderkey AS VARCHAR)
         WHERE i.state = 'CLOSED' AND list_contains(i.labels, 'plan') AND i.o_orderkey % 2 = 0 AND i.o_orderkey % 26 <> 5)
SELECT """ + _NODE_OUT.format(
    status="CASE WHEN (repo, objective, pos) IN (SELECT (repo, objective, pos) FROM go) THEN 'done' ELSE status END",
    plan="plan_issue") + " FROM nodes"

SQL["learned_snapshot"] = with_(ISSUES, ACCEPTED) + """
SELECT repo, number, state, array_to_string(
         CASE WHEN number IN (SELECT id FROM accepted) AND NOT list_contains(labels, 'learned')
              THEN list_append(labels, 'learned') ELSE labels END, ',') AS labels
FROM issues"""


OBJ_BODIES = """obj_bodies AS (
  SELECT repo, objective, '## Goal' || chr(10) || concat('Deliver objective ', objective) || chr(10) || chr(10)
         || '## Roadmap' || chr(10)
         || string_agg(concat('- ', node_id, ': ', description,
                  CASE WHEN len(list_filter(depends_on, lambda x: NOT starts_with(x, 'x'))) > 0
                       THEN concat(' (depends: ', array_to_string(list_filter(depends_on, lambda x: NOT starts_with(x, 'x')), ', '), ')')
                       ELSE '' END), chr(10) ORDER BY pos)
         || chr(10) || CASE WHEN objective % 2 = 0 THEN chr(10) || '## Notes' || chr(10) || 'Keep scope small.' || chr(10)
                            ELSE '' END AS body
  FROM nodes GROUP BY repo, objective)"""


def _node_prompt_sql() -> str:
    from tallyloom.operators.prompts import NODE_HEAD, NODE_OBJECTIVE, NODE_TAIL
    return sql_template(NODE_HEAD + NODE_OBJECTIVE + NODE_TAIL,
                        {"objective_title": "concat('Objective ', u.objective)", "objective_body": "ob.body",
                         "node_id": "u.node_id", "description": "u.description"})


SQL["node_plan_prompt"] = with_(nodes_cte(), FIRST, EDGES, BLOCKED, UNBLOCKED, OBJ_BODIES) + f"""
, p AS (SELECT u.repo, u.objective, u.pos, u.node_id, {_node_prompt_sql()} AS prompt
        FROM unblocked u JOIN obj_bodies ob ON ob.repo = u.repo AND ob.objective = u.objective)
SELECT repo, objective, pos, node_id, CAST(length(prompt) AS BIGINT) AS prompt_chars, sha256(prompt) AS prompt_sha
FROM p"""

SQL["objective_segments"] = with_(nodes_cte(), OBJ_BODIES) + """
, s AS (SELECT repo, objective, concat('Objective ', objective) || chr(10) || chr(10) || body AS text FROM obj_bodies)
SELECT repo, objective, 'objective' AS kind, CAST(length(text) AS BIGINT) AS n_chars, sha256(text) AS text_sha FROM s"""

SQL["iso_date"] = "SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY day"


# ---- exports ----------------------------------------------------------------------------------------

SQL["issue_export"] = with_(ISSUES) + """
SELECT repo, number, title, body, state, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created,
       array_to_string(labels, ',') AS labels, url FROM issues"""

SQL["pr_export"] = with_(PRS) + """
SELECT repo, number, head_ref, body, title, CAST(length(diff) AS BIGINT) AS diff_chars,
       CASE WHEN p_partkey % 3 = 0 THEN 'MERGED' ELSE 'OPEN' END AS state FROM pull_requests"""

SQL["close_event_export"] = with_(CLOSE_EVENTS) + """
SELECT repo, issue, strftime(closed_at, '%Y-%m-%d %H:%M:%S') AS closed_at,
       CAST(row_number() OVER (PARTITION BY repo, issue ORDER BY closed_at, seq, closer_id, actor) AS BIGINT) AS seq,
       closer_type, pr_number, pr_state
FROM close_events"""

SQL["comment_export"] = with_(COMMENTS) + """
SELECT repo, issue, CAST(row_number() OVER (PARTITION BY repo, issue ORDER BY seq) - 1 AS BIGINT) AS seq, body FROM comments"""


# ---- extra outputs ------------------------------------------------------------------------------

SQL["dangling_dependencies"] = with_(nodes_cte(), EDGES) + """
SELECT e.repo, e.objective, e.pos, e.node_id, e.dep_pos, e.dep_id FROM edges e
WHERE NOT EXISTS (SELECT 1 FROM nodes n WHERE n.repo = e.repo AND n.objective = e.objective AND n.node_id = e.dep_id)"""

SQL["note_issue_index"] = with_(NOTES_BASE, SCANNED) + """
SELECT repo, issue, count(*) AS n_notes FROM (SELECT repo, unnest(source_issues) AS issue FROM scanned)
GROUP BY repo, issue"""

SQL["visible_body"] = with_(nodes_cte(), FIRST, EDGES, BLOCKED, TABLES) + """
SELECT t.repo, t.objective, part, CASE WHEN part > 0 THEN t.tbl || chr(10) ELSE
       '## Goal' || chr(10) || concat('Deliver objective ', t.objective) || chr(10) || chr(10) || '## Roadmap'
       || chr(10) || chr(10) || t.tbl || chr(10)
       || CASE WHEN t.objective % 2 = 0 THEN chr(10) || chr(10) || '## Notes' || chr(10) || 'Keep scope small.'
               ELSE '' END END AS body
FROM tables t"""
