"""The pipeline's stages against brute-force versions, each on its own input."""

from collections import Counter

import corpus_pipeline as cp
from llm_helpers import words
from test_jaccard import brute as components
from tallyloom.llm.frames import stored

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = [docs]
    for name, stage in cp.STAGES:
        seen.append(stored(stage(spark, seen[-1], SF), f"test-{name}"))
    assert all(x.columns == docs.columns for x in seen[:-1])
    raw, clean, unique, cut, mixed = ({r.doc_id: r for r in x.collect()} for x in seen[:5])
    assert set(clean) <= set(raw) and all(len(words(r.text)) >= 1 for r in clean.values())
    found = components([(i, r.text) for i, r in clean.items()], 5, 80)
    assert set(unique) == {i for i, (_, c) in found.items() if c == i}
    assert set(cut) == set(unique)
    count = Counter()
    for r in unique.values():
        w = words(r.text)
        for i in range(len(w) - 34):
            count[tuple(w[i:i + 35])] += 1
    for i, r in unique.items():
        w = words(r.text)
        gone = [False] * len(w)
        for k in range(len(w) - 34):
            if count[tuple(w[k:k + 35])] > 1:
                gone[k:k + 35] = [True] * 35
        assert words(cut[i].text) == [x for x, g in zip(w, gone, strict=True) if not g]
        assert any(gone) or cut[i].text == r.text
        assert cut[i].n_chars == len(cut[i].text)
    assert {i: r.text for i, r in mixed.items()} == {i: r.text for i, r in cut.items()}
    pieces = Counter()
    for r in seen[5].collect():
        pieces[r.doc_id] += r.length
        assert r.length <= 2048
    assert set(pieces) == set(mixed)


def test_packing_receives_the_order_of_the_mix(spark, monkeypatch):
    rows = [(i, "x" * (i * 20), f"s{i % 3}") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    order = ["source", "doc_id"]
    written = stored(df.repartitionByRange(6, *order).sortWithinPartitions(*order), "test-order")
    monkeypatch.setattr(cp.packing, "pack", lambda docs: docs)
    got = cp.packing_stage(spark, written, SF)
    assert got.columns == df.columns
    assert [r.doc_id for r in got.collect()] == [r[0] for r in sorted(rows, key=lambda r: (r[2], r[0]))]
    assert [r.doc_id for r in written.collect()] != [r.doc_id for r in got.collect()]  # files are read by size
