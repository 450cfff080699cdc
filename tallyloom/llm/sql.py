"""DuckDB SQL for the queries that SQL can express.

The others (page trees, language model and toxicity scores, hash-ordered mixing,
byte-pair packing, the pipeline) are held against brute-force versions in tests/llm.
"""

from .line_quality import BARE_LINK, BOILERPLATE, MAX_LOST, MAX_REPEAT, MIN_WORDS

_GAP = r"[\x20\x09-\x0D]+"


def _words(text: str) -> str:
    return f"list_filter(regexp_split_to_array(coalesce({text}, ''), '{_GAP}'), lambda x: x <> '')"


_ASCII_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


SQL: dict[str, str] = {
    "op1_substring_dedup": f"""
WITH d AS (SELECT doc_id, {_words('text')} AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d),
x AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS h FROM p),
dup AS (SELECT h FROM x GROUP BY h HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM x SEMI JOIN dup USING (h)),
t AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM d),
k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept, count(*) AS n FROM t ANTI JOIN gone USING (doc_id, i)
      GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
""",
    "op2_exact_topk": """
WITH v AS (SELECT vec_id AS id, list_transform(embedding, lambda x: floor(256.0 * CAST(x AS DOUBLE))) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.id AS query_id, c.id AS vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
      FROM v q JOIN v c ON q.id % 50 = 0 AND c.id <> q.id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
""",
    "op4_jaccard_join": f"""
WITH RECURSIVE d AS (SELECT doc_id, {_words(_ASCII_LOWER)} AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) END AS s FROM d),
c AS (SELECT min(doc_id) AS id, k AS s, len(k) AS n FROM (SELECT doc_id, list_sort(s) AS k FROM s) GROUP BY k),
g AS (SELECT id, n, unnest(s) AS g FROM c),
l AS (SELECT a.id AS a, b.id AS b FROM g a JOIN g b ON a.g = b.g AND a.id < b.id AND 100 * a.n >= 90 * b.n AND 100 * b.n >= 90 * a.n
      GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(id, root) AS (SELECT id, id FROM c UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.id),
m AS (SELECT id, min(root) AS root FROM r GROUP BY id)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, CASE WHEN len(s.s) = 0 THEN s.doc_id ELSE m.root END AS component_id
FROM s JOIN c ON c.s = list_sort(s.s) JOIN m ON m.id = c.id
""",
    "op5_line_quality": f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {_words('text')} AS w,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l
           FROM documents),
x AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
again AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM x) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT i) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS i FROM again) GROUP BY doc_id),
ln AS (SELECT doc_id, line, {_words('line')} AS w,
              length(line) - length(translate(line, '|»›·', '')) AS bars
       FROM (SELECT doc_id, unnest(l) AS line FROM d)),
bad AS (SELECT doc_id, sum(length(array_to_string(w, ''))) AS lost FROM ln
        WHERE 3 * len(list_filter(w, lambda x: regexp_matches(x, '[#*$%&<>!]{{2,}}$'))) >= len(w)
           OR bars >= 2 AND 4 * bars >= len(w)
           OR len(w) <= 12 AND regexp_matches(line, {_quote(BOILERPLATE)}) OR regexp_matches(line, {_quote(BARE_LINK)})
        GROUP BY doc_id),
b AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
             CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
             CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(lost, 0) AS BIGINT) AS lost_chars
      FROM d LEFT JOIN rep USING (doc_id) LEFT JOIN bad USING (doc_id)),
f AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT} * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * lost_chars <= {MAX_LOST} * word_chars AS kept, lost_chars FROM f
""",
    "op6_warc": """
WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n, sha256(coalesce(html, '')) AS h FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, n AS payload_bytes, h AS payload_digest,
       CASE WHEN n >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND first <> page_id THEN first END AS refers_to FROM f
""",
}
