"""Literal cases for the line-rule text expressions."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import one
from tallyloom.functions import text as T




def _t():
    return F.col("t")



def _roadmap(spark, text):
    df = spark.createDataFrame([(text,)], "t string").select(F.posexplode(T.roadmap_bullet_lines(F.col("t"))).alias("i", "line"))
    return T.parse_roadmap_line(df, "line").orderBy("i").collect()


def test_parse_roadmap_lines(spark):
    text = "- 1.1: First\nsome prose\n- 1.2: Second (depends: 1.1)\n  - 1.3: Third (depends: 1.1, 1.2)\n"
    assert [(x.node_id, x.description, list(x.depends_on)) for x in _roadmap(spark, text)] == [
        ("1.1", "First", []), ("1.2", "Second", ["1.1"]), ("1.3", "Third", ["1.1", "1.2"])]
    assert _roadmap(spark, "") == []


def test_parse_roadmap_last_depends_and_blanks(spark):
    r = _roadmap(spark, "- a: x (depends: q) y (depends: b, , c))")
    assert r[0].description == "x (depends: q) y" and list(r[0].depends_on) == ["b", "c"]
    # a line without ": " is skipped
    assert _roadmap(spark, "- no separator") == []


def test_objective_ref(spark):
    r = one(spark, T.objective_ref(_t()), "Objective: #42 (node 1.2)")
    assert (r.objective, r.node_id) == (42, "1.2")
    assert one(spark, T.objective_ref(_t()), "nothing here") is None
    # an invalid first line is passed over for a valid later one
    r = one(spark, T.objective_ref(_t()), "Objective: #abc (node 1)\n  Objective: #7 (node 2.1))  ")
    assert (r.objective, r.node_id) == (7, "2.1")


def test_closing_ref(spark):
    cases = {"Closes #12": 12, "Fixes #3": 3, "RESOLVES #9": 9, "no ref": None,
             "line one\nthis fixes #77\n": 77, "fixes #1 closes #2": 2, "closes #abc fixes #3": 3,
             "discloses #4": 4, "closes #x closes #9": None}
    for text, want in cases.items():
        assert one(spark, T.closing_ref(_t()), text) == want, text


def test_branch_ref(spark):
    assert one(spark, T.branch_ref(_t()), "feat-123-x-9") == 123
    assert one(spark, T.branch_ref(_t()), "main") is None
    assert one(spark, T.branch_ref(_t()), "b-" + "9" * 30 + "-42") == 42


def test_missing_sections(spark):
    assert one(spark, T.missing_sections(_t()), "") == [n for n, _ in T.PLAN_SECTIONS]
    full = " ".join(p for _, p in T.PLAN_SECTIONS)
    assert one(spark, T.missing_sections(_t()), full) == []
    assert one(spark, T.missing_sections(_t()), "**Why** x **Scope** y **Edge cases and risks**") == [
        "Background", "Approach", "Acceptance criteria", "Key files"]


NOTE = ('---\ntitle: "My note"\nread_when:\n  - "editing a"\n\n  - "b"\ntripwires: []\n'
        'last_updated: "2024-01-02"\nsource_issues: [3, 1, x, 7]\n---\n\nBody text\n')


def test_front_matter_fields(spark):
    assert one(spark, T.fm_field(_t(), "title"), NOTE) == "My note"
    assert one(spark, T.fm_field(_t(), "missing"), NOTE) is None
    assert one(spark, T.fm_list(_t(), "read_when"), NOTE) == ["editing a", "b"]
    assert one(spark, T.fm_list(_t(), "tripwires"), NOTE) == []
    assert one(spark, T.fm_list(_t(), "nothing"), NOTE) == []
    assert one(spark, T.fm_list(_t(), "k"), "k:\n- a\nk:\n  - b\nother: 1\n- c") == ["a", "b"]
    assert one(spark, T.fm_issues(_t()), NOTE) == [3, 1, 7]
    assert one(spark, T.fm_issues(_t()), "source_issues: []") == []
    assert one(spark, T.fm_issues(_t()), "source_issues: [5]") == [5]
    assert one(spark, T.fm_issues(_t()), "no issues") == []


def test_front_matter_split_and_replace(spark):
    header = one(spark, T.fm_header(_t()), NOTE)
    assert header.endswith('source_issues: [3, 1, x, 7]\n---\n')
    assert one(spark, T.fm_rest(_t()), NOTE) == "\nBody text\n"
    # unclosed header: everything is header
    assert one(spark, T.fm_header(_t()), "---\ntitle: x\n") == "---\ntitle: x\n"
    assert one(spark, T.fm_header(_t()), "---x\ntitle: y\n---x\n") == "---x\ntitle: y\n---x\n"
    rep = one(spark, T.fm_replace(_t(), "last_updated", F.lit('"2025-05-05"')), header)
    assert 'last_updated: "2025-05-05"' in rep and 'title: "My note"' in rep
    # an absent field is not added
    assert one(spark, T.fm_replace(_t(), "absent", F.lit("v")), header) == header


def test_json_payload(spark):
    cases = {"[1, 2]": "[1, 2]", "```json\n[1, 2]\n```": "[1, 2]", "```\n[3]\n```": "[3]",
             "```json\n[\n  1,\n  2\n]\n```": "[\n  1,\n  2\n]", "```json\n[4]": "[4]",
             "Here you go: [5] thanks": "[5]", "no array": None, "text [1] more [2] x": "[1] more [2]",
             "```json\n```": None}
    for text, want in cases.items():
        assert one(spark, T.json_payload(_t()), text) == want, text


def test_extract_section(spark):
    body = "## Goal\ng\n\n## Roadmap\n- 1: a\n\n## Notes\nn"
    assert one(spark, T.extract_section(_t(), "Roadmap"), body) == "- 1: a\n\n"
    assert one(spark, T.extract_section(_t(), "Roadmap"), "## Goal\nx") is None
    # an empty section swallows the following one
    assert one(spark, T.extract_section(_t(), "Roadmap"), "## Roadmap\n## Next\nx") == "## Next\nx"
    assert one(spark, T.extract_section(_t(), "Roadmap"), "### Roadmap\n- a: b") == "- a: b"
    # heading with no newline: content starts right after the heading
    assert one(spark, T.extract_section(_t(), "Roadmap"), "## Roadmap") == ""


def test_trim_and_text_helpers(spark):
    assert one(spark, T.trim_ws(_t()), "\t\n x y  \n") == "x y"
    assert one(spark, T.conversation_text(_t()), "<!-- loom:conversation -->\n  hello \n") == "hello"
    assert one(spark, T.first_line(_t()), "first\r\nsecond") == "first"
    assert one(spark, T.id_from_url(_t()), "https://h/o/r/issues/42") == 42
    assert one(spark, T.id_from_url(_t()), "https://h/o/r/issues/x") is None
    assert one(spark, T.visible_body(_t()), "a\n<!-- loom:nodes []-->\nb") == "a\nb"
    assert one(spark, T.truncate_text(_t(), 3), "abcdef") == "abc"
    assert one(spark, T.marker_span(_t(), "<!-- ad ", " -->"), "x <!-- ad 7 --> y <!-- ad 8 -->") == "7"


def test_age_label_and_dates(spark):
    as_of = F.lit("2024-01-31").cast("date")
    assert one(spark, T.age_label(_t(), as_of), "2024-01-31T10:00:00Z") == "today"
    assert one(spark, T.age_label(_t(), as_of), "2024-01-30") == "1 day ago"
    assert one(spark, T.age_label(_t(), as_of), "2024-01-01") == "30 days ago"
    assert one(spark, T.age_label(_t(), as_of), "2024-02-02") == "-2 days ago"
    assert one(spark, T.age_label(_t(), as_of), "not-a-date") == "not-a-date"
    assert one(spark, T.age_label(_t(), as_of), "2024-01-30 10:00") == "2024-01-30 10:00"  # no T: 2 numbers
    assert one(spark, T.age_label(_t(), as_of), "2024-x-01-30") == "1 day ago"  # unparsable piece skipped
    assert one(spark, T.age_label(_t(), as_of), "1970-01-01").endswith(" days ago")
    for d, n in [("1970-01-01", 0), ("1970-01-02", 1), ("2000-01-01", 10957), ("2000-02-29", 11016),
                 ("1970-12-31", 364)]:
        assert one(spark, F.unix_date(F.lit(d).cast("date")), "x") == n
    assert one(spark, F.date_from_unix_date(F.lit(11016)), "x") == dt.date(2000, 2, 29)


def test_fm_list_of_any_length(spark):
    lines = [x for i in range(50_000) for x in (f'  - "item {i}"', "")]
    text = "---\nread_when:\n" + "\n".join(lines) + "\ntripwires: []\n  - not ours\n---\n"
    got = one(spark, T.fm_list(F.col("t"), "read_when"), text)
    assert got == [f"item {i}" for i in range(50_000)]
    assert one(spark, T.fm_list(F.col("t"), "read_when"), "read_when:\n- - a\n\r\nread_when: x\n\t- b \n-\n- c") == ["a", "b"]
    assert one(spark, T.fm_list(F.col("t"), "read_when"), "x\n" * 100_000) == []


def test_front_matter_is_read_without_splitting_the_body(spark):
    """One search finds a list's lines; the rest of a note, however long, is neither split nor trimmed."""
    body = "\n".join(f"line {i} " for i in range(20_000))
    note = f'---\ntitle: "T"\nread_when:\n  - "a"\n\n - b\nsource_issues: [3, +4]\n---\n\n{body}'
    df = spark.createDataFrame([(note,), (None,), ("",), ("read_when:\n- x\r\n-\n- y",)], "c string")
    out = df.select(T.fm_list("c", "read_when").alias("l"), T.fm_issues("c").alias("i"), T.fm_field("c", "title").alias("f"),
                    T.fm_rest("c").alias("r"))
    assert [(r.l, r.i, r.f) for r in out.collect()] == [(["a", "b"], [3, 4], "T"), ([], [], None), ([], [], None), (["x"], [], None)]
    assert out.first().r == "\n" + body
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "split(c#" not in plan and plan.count("regexp_extract(c#") == 4
