"""The Markdown file text of a note."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.functions.text import iso_date

# ---- fixed values: the layout of a note file -----------------------------------
def render_note_content(title: Column, read_when: Column, tripwires: Column, last_updated: Column,
                        source_issues: Column, body: Column) -> Column:
    """Markdown file text of one note; field order title, read_when, tripwires,
    last_updated, source_issues; values are not escaped."""
    title_line = F.when(title.isNotNull(), F.concat(F.lit('title: "'), title, F.lit('"\n'))).otherwise(F.lit(""))
    rw = F.array_join(F.transform(read_when, lambda x: F.concat(F.lit('  - "'), x, F.lit('"\n'))), "")
    tw = F.when(F.size(tripwires) == 0, F.lit("tripwires: []\n")).otherwise(
        F.concat(F.lit("tripwires:\n"), F.array_join(F.transform(tripwires, lambda t: F.concat(
            F.lit('  - action: "'), t["action"], F.lit('"\n    warning: "'), t["warning"], F.lit('"\n'))), "")))
    issues_txt = F.concat(F.lit("["), F.array_join(F.transform(source_issues, lambda x: x.cast("string")), ", "),
                          F.lit("]"))
    return F.concat(F.lit("---\n"), title_line, F.lit("read_when:\n"), rw, tw,
                    F.lit('last_updated: "'), iso_date(last_updated), F.lit('"\n'),
                    F.lit("source_issues: "), issues_txt, F.lit("\n---\n\n"), body, F.lit("\n"))
