import hashlib
import itertools
import random
import re
import zlib

import pytest
from tallyloom.llm import conversation_repair, queries

SCHEMA = "conv_id long, turn long, role string, text string"
GRAMMAR = re.compile(r"(s?(ua)+)?\Z")
SOLID = re.compile(r"[^\x20\x09-\x0D]")
EMPTY = hashlib.sha256(b"").hexdigest()


def faults(rows):
    out, seen = [], set()
    for role, text in rows:
        solid = SOLID.findall(text)
        out.append("b" if not solid else "d" if (role, text) in seen else "t" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows):
    """Every sequence of edits with insertions of up to len + 2 rows, by plain search over (cost, audit)."""
    found = faults(rows)
    best = {(0, ""): (0, "", ())}  # (rows done, initials' automaton as text) -> least

    def shape(initials):  # what matters of the initials so far
        return initials[:1] if len(initials) < 2 and initials == "s" else initials[-1:]

    layer = {"": (0, "", ())}
    def closure(layer):
        for _ in range(3):
            for key, (cost, audit, made) in list(layer.items()):
                for role in ("user", "assistant"):
                    new = "".join(x[0][:1] for x in made) + role[0]
                    if not any(GRAMMAR.match(new + tail) for tail in ("", "a", "ua")):
                        continue
                    way = (cost + 2, audit + "I", (*made, (role, "")))
                    k = shape(new)
                    if k not in layer or way[:2] < layer[k][:2]:
                        layer[k] = way
        return layer

    layer = closure(layer)
    for (role, text), fault in zip(rows, found, strict=True):
        new_layer = {}
        for cost, audit, made in layer.values():
            ways = [(3, "D", None)]
            if fault in ("", "t"):
                ways += [(0, "K", role), (2, "R", "user"), (2, "R", "assistant")]
            for c, letter, r in ways:
                now = made if r is None else (*made, (r, text))
                initials = "".join(x[0][:1] for x in now)
                if not any(GRAMMAR.match(initials + tail) for tail in ("", "a", "ua")):
                    continue
                way = (cost + c + (fault == "t" and r is not None), audit + letter, now)
                k = shape(initials)
                if k not in new_layer or way[:2] < new_layer[k][:2]:
                    new_layer[k] = way
        layer = closure(new_layer)
    assert best
    return min((w for w in layer.values() if GRAMMAR.match("".join(x[0][:1] for x in w[2]))), key=lambda w: w[:2])


def enumerated(rows):
    """All edit strings with at most two insertions between rows, for short conversations."""
    found, out = faults(rows), []
    slots = [x for k in range(3) for x in itertools.product(("user", "assistant"), repeat=k)]
    each = []
    for (role, text), fault in zip(rows, found, strict=True):
        ways = [(3, "D", ())]
        if fault in ("", "t"):
            more = fault == "t"
            ways += [(more, "K", ((role, text),)), (2 + more, "R", (("user", text),)), (2 + more, "R", (("assistant", text),))]
        each.append(ways)
    for ways in itertools.product(*each):
        for ins in itertools.product(slots, repeat=len(rows) + 1):
            made, audit, cost = [], "", 0
            for k, extra in enumerate(ins):
                made += [(r, "") for r in extra]
                audit += "I" * len(extra)
                cost += 2 * len(extra)
                if k < len(rows):
                    cost, audit = cost + ways[k][0], audit + ways[k][1]
                    made += ways[k][2]
            if GRAMMAR.match("".join(r[:1] for r, _ in made)):
                out.append((cost, audit, tuple(made)))
    return min(out, key=lambda w: w[:2])


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def brute(rows):
    out = {}
    after = damage(rows)
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in after if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        turns = {r[1] for r in mine if r[1] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        talk = [(r[2], r[3]) for r in mine]
        found = faults(talk)
        illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for (a, _), (b, _) in itertools.pairwise(talk))
        cost, audit, made = cheapest(talk)
        text = "\n".join(f"{r}:{t}" for r, t in made)
        out[conv] = (gaps, *(found.count(k) for k in "bdt"), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


def check(spark, rows, tmp_path, parts=3):
    df = spark.createDataFrame(rows, SCHEMA + ", pos long, part long, conv long", verifySchema=False) if rows and len(rows[0]) > 4 \
        else spark.createDataFrame(rows, SCHEMA)
    df.repartition(parts).write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.op11_conversation_repair(spark, str(tmp_path)).collect()
    assert len(got) == len({r.conv_id for r in got})
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert {r.conv_id: tuple(r[n] for n in names) for r in got} == brute([r[:4] for r in rows])


def talk(rng, n):
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None]
    texts = ["Yes.", "No!", "open", "", " \n", None, "why? ", "ünd so.\t", "a\nb."]
    return [(rng.choice(roles[:rng.choice((3, 5, 8))]), rng.choice(texts)) for _ in range(n)]


@pytest.mark.parametrize("seed", range(60))
def test_agenda_equals_enumeration(seed):
    rng = random.Random(seed)
    rows = [(r or " ", t if t is not None else " ") for r, t in talk(rng, rng.choice((1, 2, 3)))]
    facts = [(r[:1], f) for (r, _), f in zip(rows, faults(rows), strict=True)]
    [(cost, audit)] = conversation_repair.derive(facts, 0, conversation_repair.ENDS).values()
    assert (cost, audit) == enumerated(rows)[:2] == cheapest(rows)[:2]


@pytest.mark.parametrize("seed", range(20))
def test_joined_runs_equal_one_agenda(seed):
    rng = random.Random(seed)
    facts = [(rng.choice("suaux "), rng.choice(["", "", "", "t", "b", "d"])) for _ in range(90)]
    whole = conversation_repair.table(facts)
    for edge in (False, True):
        s = conversation_repair.Stretch(edge)
        for f in facts:
            s.add(*f)
        assert s.result(edge) == whole
    cut = rng.randrange(1, 89)
    assert conversation_repair.chain(conversation_repair.table(facts[:cut]), conversation_repair.table(facts[cut:])) == whole


def test_small_conversations(spark, tmp_path):
    rng = random.Random(5)
    rows = []
    for conv in [*range(300), None]:
        n = rng.choice((1, 2, 4, 7))
        turns = [rng.choice((k, k, k, 2 * k, None)) for k in range(n)]
        rows += [(conv, turn, *x) for turn, x in zip(turns, talk(rng, n), strict=True)]
    rows += rows[:40]  # repeated rows
    check(spark, rows, tmp_path)


def test_one_conversation_over_many_ranges(spark, tmp_path):
    rng = random.Random(6)
    rows = [(7, k, *x) for k, x in enumerate(talk(rng, 900))] + [(c, k, *x) for c in (6, 8) for k, x in enumerate(talk(rng, 3))]
    rows += [(9, 1, "user", "same.")] * 50 + [(10, None, "user", "x" * 200_000 + ".")]
    check(spark, rows, tmp_path, parts=5)


def test_clashing_columns_and_empty_table(spark, tmp_path):
    rows = [(1, 0, "user", "Hi.", 5, 6, 7), (1, 1, "assistant", "Ho.", 5, 6, 7)]
    check(spark, rows, tmp_path / "a")
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/b/conversations.parquet")
    assert queries.op11_conversation_repair(spark, f"{tmp_path}/b").count() == 0


def test_everything_dropped_is_still_returned(spark, tmp_path):
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    spark.createDataFrame([(conv, 0, "user", "Hi.")], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    [row] = queries.op11_conversation_repair(spark, str(tmp_path)).collect()
    assert tuple(row) == (conv, 0, 0, 0, 0, 0, 0, "", EMPTY)
