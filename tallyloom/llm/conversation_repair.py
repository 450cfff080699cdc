"""Repairing the turn structure of conversations by Knuth's lightest-derivation agenda.

The rows of a conversation, in order, become the least costly sequence whose role
initials read ``(s?(ua)+)?``. Edits: Keep (0), Rerole to user or assistant (2), Delete
(3, the only edit of a blank or duplicate row), Insert an empty user or assistant row
(2); a truncated row that stays adds 1. Among equal costs the audit, the initials of
the edits in order, is the least in ASCII order.

The deduction system: an item is ("the first i rows are done, the grammar is in state
q") or ("row i, or nothing, becomes role c or goes"). One rule joins a finished prefix
with an edit of its next row, or with an insertion; its weight is the sum of the costs
and the joined audits. Items of one prefix and cost never have audits of which one
begins the other (the shorter would lack only insertions, which cost), so the rule is
monotone and superior in (cost, audit), and an item is final when it leaves the agenda.

At scale, rows are dealt in ranges of (conversation, turn, role, text), so a
conversation that holds a third of all rows spans many tasks. Each task derives the
lightest way from every state to every state over its stretch, in runs of ``RUN`` rows
that are joined pairwise; a small second step chains the stretches of a conversation.
The audit of one conversation is one value, a letter a row, and so must fit in a task;
texts are only streamed.

Results in other cases: nulls of any column but the turn read as one space, a null turn
comes first, null conversations are one conversation. Rows of equal turn come by role,
then text. Repeated rows are duplicates (all after the first). Empty texts are blank. A row
whose role has another initial cannot be kept as it is; an empty role has none and can be kept
anywhere. An empty table gives no rows.
Conversations and turns are read as longs. Only the four named columns are read, so others cannot clash.
"""

from __future__ import annotations

import hashlib
import heapq
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import shuffle_width, stored

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: Rows that one agenda handles at once in a long stretch.
RUN = 32
#: Grammar of (s?(ua)+)?: state -> {role initial: next state}; 0 nothing yet, 1 after s, 2 after u, 3 after a.
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ENDS = (0, 3)
ROLE = {"u": "user", "a": "assistant"}
PART_BITS = 33  # of monotonically_increasing_id

Table = dict  # (from state, to state) -> (cost, audit)


def _row_edits(initial: str, fault: str) -> dict:
    """What may become of a row: role initial ('' if it adds none) -> its (cost, letter) ways."""
    edits = {"": [(DELETE, "D")]}
    if fault in ("", "t"):
        more = TRUNCATED * (fault == "t")
        edits |= {role: [(REROLE + more, "R")] for role in "ua"}
        if initial in ("s", "u", "a", ""):
            edits.setdefault(initial, []).append((KEEP + more, "K"))
    return edits


def derive(rows: list[tuple[str, str]], start: int, goals=None) -> dict[int, tuple[int, str]]:
    """Lightest derivations over rows of (role initial, fault) from a state: {state at the end: (cost, audit)}.

    With ``goals`` it stops at the first goal state that is final and returns only that one.
    """
    n = len(rows)
    agenda = [(0, "", 0, 0, start)]  # cost, audit, prefix or edit, row, state or role
    agenda += [(INSERT, "I", 1, -1, role) for role in "ua"]
    agenda += [(cost, letter, 1, i, role) for i, row in enumerate(rows)
               for role, each in _row_edits(*row).items() for cost, letter in each]
    heapq.heapify(agenda)
    prefixes: list[dict] = [{} for _ in range(n + 1)]  # rows done -> {state: (cost, audit)}, all final
    edits: dict = defaultdict(dict)  # row, or -1 for insertions -> {role: (cost, letter)}, all final

    def join(i, state, weight, at, role, edit):
        to, j = state if role == "" else NEXT[state].get(role), i + (at >= 0)
        if to is not None and to not in prefixes[j]:
            heapq.heappush(agenda, (weight[0] + edit[0], weight[1] + edit[1], 0, j, to))

    while agenda:
        cost, audit, kind, i, what = heapq.heappop(agenda)
        if kind == 0 and what not in prefixes[i]:
            prefixes[i][what] = (cost, audit)
            if i == n and goals and what in goals:
                return {what: (cost, audit)}
            for at in (i, -1):
                for role, edit in edits[at].items():
                    join(i, what, (cost, audit), at, role, edit)
        elif kind == 1 and what not in edits[i]:
            edits[i][what] = (cost, audit)
            for j in (i,) if i >= 0 else range(n + 1):
                for state, weight in prefixes[j].items():
                    join(j, state, weight, i, what, (cost, audit))
    return prefixes[n]


def table(rows: list[tuple[str, str]]) -> Table:
    """The lightest way from each state to each state."""
    return {(p, q): w for p in range(4) for q, w in derive(rows, p).items()}


def chain(a: Table, b: Table) -> Table:
    """The lightest ways over two neighbouring stretches."""
    out: Table = {}
    for p in range(4):
        for q in range(4):
            ways = [(a[p, r][0] + b[r, q][0], r) for r in range(4) if (p, r) in a and (r, q) in b]
            if ways:
                least = min(ways)[0]
                out[p, q] = (least, min(a[p, r][1] + b[r, q][1] for cost, r in ways if cost == least))
    return out


class Stretch:
    """Rows of one conversation in order, folded into tables of runs joined pairwise."""

    def __init__(self, edge: bool):
        self.edge, self.rows, self.tables = edge, [], []  # tables: (rank, table), ranks falling

    def add(self, initial: str, fault: str) -> None:
        self.rows.append((initial, fault))
        if len(self.rows) == RUN:
            self._fold()

    def _fold(self) -> None:
        rank, now = 0, table(self.rows)
        while self.tables and self.tables[-1][0] == rank:
            now, rank = chain(self.tables.pop()[1], now), rank + 1
        self.tables.append((rank, now))
        self.rows = []

    def result(self, edge: bool) -> Table:
        """All pairs of states at a task's edge; a whole conversation needs only the way from start to end."""
        if not (self.edge or edge or self.tables):
            return {(0, q): w for q, w in derive(self.rows, 0, ENDS).items()}
        if self.rows:
            self._fold()
        now = self.tables.pop()[1]
        while self.tables:
            now = chain(self.tables.pop()[1], now)
        return now


def _arrow(fields: list, rows: list) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, fields, strict=True)],
                                      names=[n for n, _ in fields])


_LONG, _TEXT = pa.int64(), pa.string()
_STRETCH = [("part", _LONG), ("conv", _LONG), ("at", _LONG), ("turn_lo", _LONG), ("turn_hi", _LONG), ("turns", _LONG),
            ("blank", _LONG), ("duplicate", _LONG), ("truncated", _LONG), ("illegal", _LONG),
            ("first", _TEXT), ("last", _TEXT), ("ways", pa.list_(_LONG)), ("audits", pa.list_(_TEXT))]
_STRETCH_DDL = ("part long, conv long, at long, turn_lo long, turn_hi long, turns long, blank long, duplicate long, "
                "truncated long, illegal long, first string, last string, ways array<long>, audits array<string>")
LEGAL = ("su", "ua", "au")


def _stretches(batches):
    """One row for each conversation and stored range: counts, edges and lightest ways."""
    part = conv = stretch = None
    out: list = []

    def close(edge: bool):
        ways = stretch.result(edge)
        out.append((part, conv, at, lo, hi, turns, *(counts[k] for k in "bdt"), illegal, first, last,
                    [x for (p, q), (cost, _) in ways.items() for x in (p, q, cost)], [a for _, a in ways.values()]))

    for batch in batches:
        for pos, c, turn, initial, fault, copies in zip(*(col.to_pylist() for col in batch.columns), strict=True):
            here = pos >> PART_BITS
            if stretch is None or (here, c) != (part, conv):
                if stretch is not None:
                    close(edge=here != part)
                stretch = Stretch(edge=here != part)
                part, conv, at, lo, hi, turns, illegal, first, last = here, c, pos, turn, turn, 0, 0, initial, None
                counts = dict.fromkeys("bdt", 0)
            if turn is not None and (not turns or turn != hi):
                turns, hi, lo = turns + 1, turn, turn if lo is None else lo
            for k in range(copies):
                # all copies but the first repeat it
                now = "d" if k and fault != "b" else fault
                if now:
                    counts[now] += 1
                if last is not None and last + initial not in LEGAL:
                    illegal += 1
                last = initial
                stretch.add(initial, now)
            if len(out) >= 2000:
                yield _arrow(_STRETCH, out)
                out.clear()
    if stretch is not None:
        close(edge=True)
    yield _arrow(_STRETCH, out)


_PLAN = [("part", _LONG), ("conv", _LONG), ("at", _LONG), ("state", _LONG), ("piece", _TEXT), ("gaps", _LONG),
         ("blank", _LONG), ("duplicate", _LONG), ("truncated", _LONG), ("illegal", _LONG), ("cost", _LONG), ("audit", _TEXT)]
_PLAN_DDL = ("part long, conv long, at long, state long, piece string, gaps long, blank long, duplicate long, "
             "truncated long, illegal long, cost long, audit string")


def _chained(stretches: list[dict]) -> list[tuple]:
    """The stretches of one conversation, in order, chained from start to end: a row of the plan for each."""
    best = {0: (0, "", ())}  # state -> cost, audit, (state before, piece) of each stretch, linked
    low = high = last = None
    totals = dict.fromkeys(("turns", "blank", "duplicate", "truncated", "illegal"), 0)
    for s in stretches:
        ways = {tuple(s["ways"][3 * k:3 * k + 2]): (s["ways"][3 * k + 2], a) for k, a in enumerate(s["audits"])}
        new: dict = {}
        for (p, q), (cost, piece) in ways.items():
            if p in best:
                way = (best[p][0] + cost, best[p][1] + piece, (best[p][2], p, piece))
                if q not in new or way[:2] < new[q][:2]:
                    new[q] = way
        best = new
        for k in totals:
            totals[k] += s[k]
        if s["turn_lo"] is not None:
            totals["turns"] -= s["turn_lo"] == high
            low, high = s["turn_lo"] if low is None else low, s["turn_hi"]
        if last is not None and last + s["first"] not in LEGAL:
            totals["illegal"] += 1
        last = s["last"]
    cost, audit, link = min(best[q] for q in ENDS if q in best)
    pieces = []
    while link:
        link, state, piece = link
        pieces.append((state, piece))
    gaps = 0 if low is None else high - low + 1 - totals["turns"]
    report = (gaps, *(totals[k] for k in ("blank", "duplicate", "truncated", "illegal")), cost, audit)
    return [(s["part"], s["conv"], s["at"], state, piece, *(report if k == 0 else (None,) * len(report)))
            for k, (s, (state, piece)) in enumerate(zip(stretches, reversed(pieces), strict=True))]


def _plans(batches):
    group, out = [], []
    for batch in batches:
        for row in batch.to_pylist():
            if group and group[0]["conv"] != row["conv"]:
                out += _chained(group)
                group = []
            group.append(row)
        if len(out) >= 2000:
            yield _arrow(_PLAN, out)
            out = []
    if group:
        out += _chained(group)
    yield _arrow(_PLAN, out)


_ROW = [("conv", _LONG), ("pos", _LONG), ("step", _LONG), ("edit", _TEXT), ("role", _TEXT), ("text", _TEXT)]
_ROW_DDL = "conv long, pos long, step long, edit string, role string, text string"


def _apply(batches):
    """Rows in order, each stretch headed by its plan: the edits carried out."""
    out, piece, state, size = [], "", 0, 0
    for batch in batches:
        for pos, conv, plan, first_state, role, text, copies in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if plan is not None:
                piece, state, step, k = plan, first_state, 0, 0
            for n in range(1 if plan is not None else copies):
                # a row takes the next letter that is no insertion; insertions go right behind what they follow
                letters = "" if plan is not None else piece[k]
                k += len(letters)
                while k < len(piece) and piece[k] == "I":
                    letters, k = letters + "I", k + 1
                for letter in letters:
                    new = role if letter in "KD" else ROLE["a" if state == 2 else "u"]
                    if letter != "D" and new:
                        state = NEXT[state][new[:1]]
                    out.append((conv, pos, step, letter, new, "" if letter == "I" else text))
                    step, size = step + 1, size + len(out[-1][5])
                if size > 4 << 20 or len(out) >= 5000:
                    yield _arrow(_ROW, out)
                    out, size = [], 0
    yield _arrow(_ROW, out)


def cleaned(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, role, text) with nulls of role and text as one space."""
    return df.select(F.col(conv).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"),
                     F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"),
                     F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("text"))


def _digits(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def damaged(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows damaged by crc32 of ``conv:turn`` modulo 20: 0 drops the row, 1 empties its text,
    2 takes its sentence ends out, 3 repeats it (copies 2), 4 makes it the user's."""
    rows = cleaned(df, conv, turn, role, text)
    kind = F.crc32(F.concat(_digits("conv"), F.lit(":"), _digits("turn")).cast("binary")) % 20
    rows = rows.withColumn("kind", kind).filter("kind <> 0")
    return rows.select(
        "conv", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"), F.when(F.col("kind") == 3, 2).otherwise(1).cast("long").alias("copies"))


def ordered(rows: DataFrame) -> DataFrame:
    """Distinct rows in order (pos), with their copies, role initials and first faults; stored.

    Copies are counted before anything is dealt by conversation, and the first row of each
    role and text is found by a minimum, so neither a hot row nor a hot text gathers in a task.
    """
    one = rows.groupBy("conv", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    one = one.withColumn("_h", F.sha2(F.concat_ws("\x00", "role", "text").cast("binary"), 256))
    first = (one.groupBy("conv", "_h").agg(F.min(F.struct("turn")).alias("first"))
             .withColumnsRenamed({"conv": "_c", "_h": "_hh"}))
    one = one.join(first, F.col("conv").eqNullSafe(F.col("_c")) & (F.col("_h") == F.col("_hh")))
    gap = r"[\x20\x09-\x0D]"
    end = F.regexp_extract("text", rf"([^\x20\x09-\x0D]){gap}*\z", 1)
    fault = (F.when(end == "", "b").when(~F.col("first.turn").eqNullSafe(F.col("turn")), "d")
             .when(~end.isin(".", "!", "?"), "t").otherwise(""))
    head = F.substring("text", 1, 200).alias("_head")  # the bounds of the ranges hold no whole texts
    dealt = one.select("*", head, fault.alias("fault")).repartitionByRange("conv", "turn", "role", "_head")
    return stored(dealt.sortWithinPartitions("conv", "turn", "role", "text")
                  .select(F.monotonically_increasing_id().alias("pos"), "conv", "turn", "role", "text", "copies",
                          F.substring("role", 1, 1).alias("initial"), "fault"), "turns")


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(report, repaired rows) of rows (conv, turn, role, text, copies).

    report: conv, gaps, blank, duplicate, truncated, illegal, cost, audit. Repaired rows:
    conv, pos, step (order by both), edit (K, R, D or I), role, text; deleted rows are
    among them, with edit D.
    """
    width = shuffle_width(rows)
    turns = ordered(rows)
    part = F.shiftright("pos", PART_BITS)
    stretches = (turns.select("pos", "conv", "turn", "initial", "fault", "copies")
                 .repartition(width, part).sortWithinPartitions("pos").mapInArrow(_stretches, _STRETCH_DDL))
    plan = stored(stretches.repartition(width, "conv").sortWithinPartitions("conv", "part")
                  .mapInArrow(_plans, _PLAN_DDL), "plan")
    report = plan.filter("audit is not null").select(
        "conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    none = F.lit(None)
    heads = plan.select(F.col("at").alias("pos"), "conv", "piece", "state", none.cast("string").alias("role"),
                        none.cast("string").alias("text"), F.lit(0).cast("long").alias("copies"))
    bodies = turns.select("pos", "conv", none.cast("string").alias("piece"), none.cast("long").alias("state"),
                          "role", "text", "copies")
    repaired = (heads.unionByName(bodies).repartition(width, part)
                .sortWithinPartitions("pos", F.col("piece").isNull()).mapInArrow(_apply, _ROW_DDL))
    return report, repaired


def _hashes(batches):
    """SHA-256 of each conversation's ``role:text`` lines, in order; texts are only streamed."""
    fields = [("conv", _LONG), ("repaired_sha256", _TEXT)]
    conv, sha, out = None, None, []
    for batch in batches:
        for c, role, text in zip(*(col.to_pylist() for col in batch.columns), strict=True):
            line = f"{role}:{text}".encode()
            if sha is None or c != conv:
                if sha is not None:
                    out.append((conv, sha.hexdigest()))
                conv, sha = c, hashlib.sha256(line)
            else:
                sha.update(b"\n")
                sha.update(line)
    if sha is not None:
        out.append((conv, sha.hexdigest()))
    yield _arrow(fields, out)


def digests(repaired: DataFrame) -> DataFrame:
    """(conv, repaired_sha256). A hash takes its text in order, so one task reads a conversation, as a stream."""
    return (repaired.filter("edit <> 'D'").repartition(shuffle_width(repaired), "conv")
            .sortWithinPartitions("conv", "pos", "step").select("conv", "role", "text")
            .mapInArrow(_hashes, "conv long, repaired_sha256 string"))
