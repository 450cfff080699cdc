from collections import Counter
from fractions import Fraction
from itertools import islice

from llm_helpers import docs
from tallyloom.llm import mixing


def test_period_keeps_within_one_block():
    for weights in ({"a": 1, "b": 1}, {"a": 0.7, "b": 0.2, "c": 0.1}, {"a": 5, "b": 3, "c": 3, "d": 1, "e": 0.01}, {"x": 1}):
        q = mixing.quotas(weights, 97)
        slots = mixing.one_period(q)
        period = sum(q.values())
        assert sorted(x for v in slots.values() for x in v) == list(range(period))
        for s, v in slots.items():
            done = 0
            for t in range(period + 1):
                done = sum(x < t for x in v)
                assert abs(done - t * q[s] / period) < 1


def test_mix_keeps_all_rows_in_slot_order(spark):
    rows = [(i, "x" * (i % 50), ("a", "b", None)[i % 3 if i % 9 else 0], "z") for i in range(400)] + [(7, None, "a", "z"), (7, None, "a", "z")]
    df = docs(spark, rows, ", source string, slot string")
    out = mixing.schedule(df, block_chars=200, period=32)
    assert out.columns == ["doc_id", "text", "source", "source_block", "slot"]
    got = out.collect()
    assert Counter((r.doc_id, r.text, r.source) for r in got) == Counter(r[:3] for r in rows)
    blocks = Counter()
    for r in got:
        blocks[r.source, r.source_block] += len(r.text or "")
    assert all(v < 200 + 50 for v in blocks.values())
    assert len({(r.source, r.source_block): r.slot for r in got}) == len({r.slot for r in got})
    mixed = mixing.mix(df, block_chars=200, period=32)
    order = {(r.doc_id, r.text): r.slot for r in got}
    slots = [order[r.doc_id, r.text] for r in mixed.collect()]
    assert slots == sorted(slots) and mixed.columns == df.columns


def test_weights_rest_and_empty(spark):
    df = docs(spark, [(i, "abc", f"s{i % 5}") for i in range(50)], ", source string")
    assert mixing.schedule(df, weights={"s0": 3.0, "s1": 1.0}, block_chars=6).count() == 50
    assert mixing.schedule(df.limit(0)).count() == 0


def test_every_source_has_its_own_stream(spark):
    df = docs(spark, [(i, "abc", f"s{i % 300:03}") for i in range(600)], ", source string")
    got = mixing.schedule(df, block_chars=3).collect()
    places = {(r.source, r.source_block): r.slot for r in got}
    assert len(places) == len(set(places.values())) == 600
    assert {block for _, block in places} == {0, 1}  # no source's blocks are numbered among another's


def test_one_block_from_the_target_weight_over_the_whole_schedule(spark):
    cases = [dict.fromkeys(range(20), 1.0), {0: 0.5} | dict.fromkeys(range(1, 51), 0.01), {0: 0.9999, 1: 0.0001},
             {i: (i + 1) ** 0.5 for i in range(60)}, {i: 1 / (i + 1) for i in range(100)}]
    for weights in cases:
        total, end = sum(Fraction(w) for w in weights.values()), 11_000
        want = {s: Fraction(w) / total for s, w in weights.items()}
        done = dict.fromkeys(weights, 0)
        for s, i, t in islice(mixing.slots(weights, dict.fromkeys(weights, end)), end):
            assert i == done[s] and i / want[s] - 1 < t < (i + 1) / want[s]  # within its window
            done[s] += 1
            assert -1 < done[s] - (t + 1) * want[s] < 1
            if t % 500 == 0:
                assert all(abs(done[k] - (t + 1) * want[k]) < 1 for k in want)
    rows = [(i, "x" * 10, f"s{i % 20:02}") for i in range(6_000)]
    got = mixing.schedule(docs(spark, rows, ", source string"), block_chars=10).collect()
    order = [r.source for r in sorted(got, key=lambda r: r.slot)]
    assert sorted(r.slot for r in got) == list(range(6_000))
    done = Counter()
    for t, s in enumerate(order, 1):
        done[s] += 1
        assert max(abs(done[f"s{j:02}"] - t / 20) for j in range(20)) < 1
