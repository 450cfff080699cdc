"""Line-rule text expressions used by the extraction jobs.

Each function builds a Spark Column from built-in functions; the rules follow
the line-oriented parsing of the tool whose data these tables hold. Regexes use
Java syntax: ``(?d)`` makes ``\\n`` the only line end (as a ``lines()`` split
does), ``(?U)`` makes ``\\s`` Unicode-aware (as ``trim()`` is).
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values (must equal the source tool's for equal results) ----------
# Note categories, in rank order.
CATEGORIES = ["patterns", "tripwires", "architecture", "testing"]
# Plan body sections: (name, required prefix), in report order.
PLAN_SECTIONS = [
    ("Why", "**Why"),
    ("Background", "**Background"),
    ("Approach", "**Approach"),
    ("Acceptance criteria", "**Acceptance criteria"),
    ("Scope", "**Scope"),
    ("Edge cases and risks", "**Edge cases"),
    ("Key files", "**Key files"),
]
# Closing keywords, in precedence order.
CLOSING_KEYWORDS = ["closes", "fixes", "resolves"]
# Diff / conversation cap in the learn prompt.
TEXT_CAP = 8000
# Node statuses.
NODE_STATUSES = ["pending", "in_progress", "done"]
# ------------------------------------------------------------------------------

DEFAULT_PREFIX = "loom"


def markers(prefix: str = DEFAULT_PREFIX) -> dict[str, str]:
    """Marker literals; the prefix replaces the source tool's own name."""
    return {
        "nodes_start": f"<!-- {prefix}:nodes ",
        "nodes_end": " -->",
        "conversation": f"<!-- {prefix}:conversation -->",
        "conversation_more": f"<!-- {prefix}:conversation more -->",
        "block_start": f"<!-- {prefix}:start -->",
        "block_end": f"<!-- {prefix}:end -->",
    }


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def trim_ws(c) -> Column:
    """Trim Unicode whitespace (tabs, newlines too), unlike Spark ``trim``."""
    return F.regexp_replace(_c(c), r"(?U)\A\s+|\s+\z", "")


def ltrim_ws(c) -> Column:
    return F.regexp_replace(_c(c), r"(?U)\A\s+", "")


def rtrim_ws(c) -> Column:
    return F.regexp_replace(_c(c), r"(?U)\s+\z", "")


def strip_quotes(c) -> Column:
    """Strip every leading and trailing double quote."""
    return F.regexp_replace(_c(c), r'\A"+|"+\z', "")


def lines(c) -> Column:
    """Split into lines: ``\\n`` ends a line, a trailing ``\\r`` is dropped, a
    final newline adds no empty line, empty text has no lines."""
    t = _c(c)
    body = F.regexp_replace(t, r"\r?\n\z", "")
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(body, r"\r?\n", -1))


def java_quote(s: str) -> str:
    return re.sub(r"([\\.^$|?*+()\[\]{}])", r"\\\1", s)


def replacement_quote(c) -> Column:
    """Quote ``\\`` and ``$`` so a column can serve as regexp_replace text."""
    return F.regexp_replace(F.regexp_replace(_c(c), r"\\", r"\\\\"), r"\$", r"\\\$")


def extract_section(body, heading: str) -> Column:
    """Body of the first ``## <heading>`` hit, up to and including the newline
    before the next ``\\n## ``; null when the heading is absent."""
    b = _c(body)
    needle = f"## {heading}"
    pos = F.instr(b, needle)
    after = F.substring(b, pos + F.lit(len(needle)), F.lit(1 << 30))
    nl = F.instr(after, "\n")
    content = F.when(nl > 0, F.substring(after, nl + 1, F.lit(1 << 30))).otherwise(after)
    end = F.instr(content, "\n## ")
    section = F.when(end > 0, F.substring(content, F.lit(1), end)).otherwise(content)
    return F.when(pos > 0, section)


_BULLET = r"(?sU)\A\s*- .*: .*\S"


def roadmap_bullet_lines(text) -> Column:
    """Lines that parse as nodes: trimmed, start ``- ``, hold ``": "``."""
    return F.filter(lines(text), lambda ln: ln.rlike(_BULLET))


def parse_roadmap_line(df, line_col: str):
    """Add node_id, description, depends_on for one bullet line per row."""
    d = df.withColumn("_t", trim_ws(F.col(line_col)))
    d = d.withColumn("_rest", F.substring("_t", 3, 1 << 30))
    d = d.withColumn("_sep", F.instr("_rest", ": "))
    d = d.withColumn("node_id", trim_ws(F.substring(F.col("_rest"), F.lit(1), F.col("_sep") - 1)))
    d = d.withColumn("_dd", F.substring(F.col("_rest"), F.col("_sep") + 2, F.lit(1 << 30)))
    d = d.withColumn("_hd", F.instr("_dd", "(depends:") > 0)
    d = d.withColumn("description", F.when(F.col("_hd"), trim_ws(
        F.regexp_extract("_dd", r"(?s)\A(.*)\(depends:", 1))).otherwise(trim_ws(F.col("_dd"))))
    deps_part = F.regexp_replace(ltrim_ws(F.regexp_extract(
        "_dd", r"(?s)\(depends:((?:(?!\(depends:).)*)\z", 1)), r"\)+\z", "")
    deps = F.filter(F.transform(F.split(deps_part, ",", -1), lambda x: trim_ws(x)), lambda x: x != "")
    d = d.withColumn("depends_on", F.when(F.col("_hd"), deps).otherwise(F.array().cast("array<string>")))
    return d.drop("_t", "_rest", "_sep", "_dd", "_hd")


def visible_body(body, prefix: str = DEFAULT_PREFIX) -> Column:
    """Drop the lines that begin with the node-state marker."""
    m = markers(prefix)["nodes_start"]
    return F.array_join(F.filter(lines(F.coalesce(_c(body), F.lit(""))),
                                 lambda ln: ~ln.startswith(m)), "\n")


def marker_span(text, start: str, end: str) -> Column:
    """Text between the first ``start`` and the first ``end`` after it; null
    when either is missing."""
    pat = "(?s)" + java_quote(start) + "(.*?)" + java_quote(end)
    t = _c(text)
    return F.when(t.rlike(pat), F.regexp_extract(t, pat, 1))


def marker_spans(text, start: str, end: str) -> Column:
    """All texts between a ``start`` and the first ``end`` after it, in order."""
    pat = "(?s)" + java_quote(start) + "(.*?)" + java_quote(end)
    return F.regexp_extract_all(_c(text), F.lit(pat), F.lit(1))


_OBJ_REF = r"(?dmU)^[^\S\n]*Objective: #([0-9]+) \(node (.*?)\)*[^\S\n]*$"


def objective_ref(body) -> Column:
    """First valid ``Objective: #N (node ID)`` line -> struct(objective, node_id)."""
    b = F.coalesce(_c(body), F.lit(""))
    num = _digits_to_bigint(F.regexp_extract(b, _OBJ_REF, 1))
    return F.when(b.rlike(_OBJ_REF) & num.isNotNull(),
                  F.struct(num.alias("objective"),
                           F.regexp_extract(b, _OBJ_REF, 2).alias("node_id")))


def _digits_to_bigint(s: Column) -> Column:
    """Digit text -> BIGINT; empty or out-of-range text -> null."""
    return F.when(s != "", s).try_cast("bigint")


def closing_ref(body) -> Column:
    """``closes/fixes/resolves #N``: keyword precedence beats text order, only
    the first hit per keyword counts, case-insensitive, no word boundary."""
    b = F.coalesce(_c(body), F.lit(""))
    hits = [_digits_to_bigint(F.regexp_extract(b, r"(?is)\A.*?" + k + r" #([0-9]*)", 1))
            for k in CLOSING_KEYWORDS]
    return F.coalesce(*hits)


def branch_ref(branch) -> Column:
    """First run of digits in a branch name that parses as a number (a run too
    long for a number is passed over)."""
    runs = F.regexp_extract_all(F.coalesce(_c(branch), F.lit("")), F.lit(r"([0-9]+)"), 1)
    nums = F.filter(F.transform(runs, lambda r: r.try_cast("bigint")), lambda x: x.isNotNull())
    return F.try_element_at(nums, F.lit(1))


def missing_sections(body) -> Column:
    """Names of required plan sections whose prefix is absent, in order."""
    b = F.coalesce(_c(body), F.lit(""))
    arr = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(p).alias("prefix")) for n, p in PLAN_SECTIONS])
    return F.transform(F.filter(arr, lambda x: ~b.contains(x["prefix"])), lambda x: x["name"])


def _field_line(field: str) -> str:
    return r"(?dmU)^[^\S\n]*" + java_quote(field) + r":(.*)$"


def once(value: Column, f) -> Column:
    """``f(value)`` with ``value`` computed once, however often ``f`` uses it."""
    return F.transform(F.array(value), f)[0]


def fm_field(content, field: str) -> Column:
    """First line of the whole file starting ``field:``; value trimmed and
    stripped of quotes; null if there is no such line."""
    pat = _field_line(field)
    return once(F.regexp_extract(_c(content), pat, 0), lambda line: F.when(
        line != "", strip_quotes(trim_ws(F.regexp_extract(line, pat, 1)))))


def fm_list(content, field: str) -> Column:
    """``- item`` lines after the first ``field:`` line; blank lines and repeated
    ``field:`` lines are skipped, the first other line ends the list. The lines of
    the list are found by one search (a possessive group, which a list of any length
    does not nest), and only they are split and trimmed."""
    key = java_quote(field + ":")
    row = r"\n[^\S\n]*+(?:- [^\S\n]*+\S[^\n]*+|" + key + r"[^\n]*+|(?=\n|\z))"
    span = F.regexp_extract(_c(content), r"(?dmU)^[^\S\n]*+" + key + r"[^\n]*+((?:" + row + ")*+)", 1)
    rows = F.transform(F.split(F.coalesce(span, F.lit("")), "\n", -1), trim_ws)
    return F.transform(F.filter(rows, lambda t: t.startswith("- ")),
                       lambda t: strip_quotes(F.regexp_replace(t, r"\A(?:- )++", "")))


def fm_issues(content) -> Column:
    """``source_issues: [a, b]`` (first such line anywhere) -> array<bigint>."""
    inner = F.regexp_replace(trim_ws(F.regexp_extract(_c(content), _field_line("source_issues"), 1)),
                             r"\A[\[\]]+|[\[\]]+\z", "")
    # no such line reads as empty text, which holds no number
    nums = F.transform(F.split(F.coalesce(inner, F.lit("")), ",", -1), lambda s: once(trim_ws(s), lambda t: _digits_to_bigint(
        F.when(t.rlike(r"\A\+?[0-9]+\z"), F.regexp_replace(t, r"\A\+", "")).otherwise(F.lit("")))))
    return F.filter(nums, lambda x: x.isNotNull())


_FM_HEADER = r"(?s)\A[^\S\n]*---[^\S\n]*\n(?:.*?\n)??[^\S\n]*---[^\S\n]*(?:\n|\z)"


def fm_header(content) -> Column:
    """Front matter up to and including the closing ``---`` line; the whole
    text when there is no closed header."""
    c = _c(content)
    h = F.regexp_extract(c, _FM_HEADER, 0)
    return F.when(h != "", h).otherwise(c)


def fm_rest(content) -> Column:
    """The text after ``fm_header``."""
    c = _c(content)
    return once(F.length(F.regexp_extract(c, _FM_HEADER, 0)), lambda n: F.when(
        n > 0, F.substring(c, n + 1, F.lit(1 << 30))).when(n == 0, F.lit("")))


def fm_replace(header, field: str, value) -> Column:
    """Replace every ``field:`` line of a header; an absent field is not added."""
    pat = r"(?dmU)^[^\S\n]*" + java_quote(field) + r":[^\n]*"
    return F.regexp_replace(_c(header), F.lit(pat), F.concat(F.lit(field + ": "), replacement_quote(value)))


_FENCE = r"(?s)\A```[^\n]*\n(.*?)(?:(?:\n|(?<=\n))```.*|\z)"


def json_payload(reply) -> Column:
    """JSON array span of a model reply: optional code fence, then first ``[``
    to last ``]``; null when there is none."""
    t = trim_ws(F.coalesce(_c(reply), F.lit("")))
    inner = F.when(t.startswith("```") & t.rlike(_FENCE), F.regexp_extract(t, _FENCE, 1)) \
             .otherwise(F.when(t.startswith("```"), F.lit("")).otherwise(t))
    span = F.regexp_extract(inner, r"(?s)\[.*\]", 0)
    return F.when(span != "", span)


def id_from_url(url) -> Column:
    """Number after the last ``/``; null when it is not a number."""
    last = F.substring_index(F.coalesce(_c(url), F.lit("")), "/", -1)
    return _digits_to_bigint(F.when(last.rlike(r"\A[0-9]+\z"), last).otherwise(F.lit("")))


def iso_date(c) -> Column:
    """A date (or time) as ``yyyy-MM-dd``."""
    return F.date_format(_c(c), "yyyy-MM-dd")


def conversation_text(body, prefix: str = DEFAULT_PREFIX) -> Column:
    """Remove the first conversation sentinel, then trim."""
    s = markers(prefix)["conversation"]
    b = _c(body)
    i = F.instr(b, s)
    removed = F.when(i > 0, F.concat(F.substring(b, F.lit(1), i - 1),
                                     F.substring(b, i + F.lit(len(s)), F.lit(1 << 30)))).otherwise(b)
    return trim_ws(removed)


def truncate_text(c, cap: int = TEXT_CAP) -> Column:
    """First ``cap`` characters (the source tool counts bytes; we count
    characters, an intended change)."""
    return F.left(_c(c), F.lit(cap))


def first_line(body) -> Column:
    b = F.coalesce(_c(body), F.lit(""))
    return F.regexp_replace(F.substring_index(b, "\n", 1), r"\r\z", "")


def age_label(created, as_of) -> Column:
    """``today`` / ``1 day ago`` / ``N days ago`` in whole days between the
    date part of ``created`` (text before ``T``) and ``as_of``. The date part
    counts when exactly three of its ``-``-separated pieces are whole numbers
    (other pieces are skipped); otherwise the input comes back as is."""
    s = _c(created).cast("string")
    part = F.substring_index(s, "T", 1)
    # fast path for the usual Y-M-D text; the piece-skipping rule only runs
    # for other inputs (CASE evaluates one branch per row)
    pieces = F.split(part, "-", -1)
    nums = F.filter(pieces, lambda p: p.rlike(r"\A\+?[0-9]+\z"))
    slow = F.when(F.size(nums) == 3, F.try_to_date(F.array_join(
        F.transform(nums, lambda p: F.regexp_replace(p, r"\A\+", "")), "-"), "y-M-d"))
    d = F.when(part.rlike(r"\A[0-9]+-[0-9]+-[0-9]+\z"), F.try_to_date(part, "y-M-d")).otherwise(slow)
    n = F.datediff(_c(as_of), d)
    label = (F.when(n == 0, F.lit("today"))
             .when(n == 1, F.lit("1 day ago"))
             .otherwise(F.concat(n.cast("string"), F.lit(" days ago"))))
    return F.when(d.isNull(), s).otherwise(label)
