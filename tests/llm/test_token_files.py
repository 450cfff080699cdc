import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from llm_helpers import docs, texts
from tallyloom.llm import queries, token_files
from tokenizers import Tokenizer

ODD = ["", " ", "  a  b ", "don't we'll", "x <|endoftext|> y", "é ü  z　", "😀 a😀", "word " * 9000, None]


def expected(rows, end_id=2):
    lib = Tokenizer.from_file(public_tokenizers.path(token_files.VOCABULARY))
    return {i: [*lib.encode(t or "", add_special_tokens=False).ids, end_id] for i, t in rows}


def packed(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


@pytest.mark.parametrize("length", [7, 2048])
def test_round_trip_and_random_access(spark, tmp_path, length):
    rows = [(3 * k - 50, t) for k, t in enumerate([*texts(3, 200), *ODD])]
    want = expected(rows)
    path = str(tmp_path / "t")
    token_files.write(docs(spark, rows).repartition(6), path, length=length)
    got = token_files.read(spark, path, with_ids=True).collect()
    start = 0
    for r, i in zip(sorted(got, key=lambda r: r.doc_id), sorted(want), strict=True):
        assert (r.doc_id, r.start, r.n_tokens, r.ids) == (i, start, len(want[i]), want[i])
        assert r.ids_crc32 == zlib.crc32(packed(want[i]))
        start += r.n_tokens
    sequences = token_files.Sequences(path)
    stream = []
    for k in range(len(sequences)):
        ids, mask = sequences[k]
        assert len(ids) == len(mask) == length and not ids.flags.owndata
        stream += ids[mask.to_numpy(zero_copy_only=False)].tolist()
    assert stream == [x for i in sorted(want) for x in want[i]]
    with pytest.raises(IndexError):
        sequences[len(sequences)]


def test_reads_are_views_of_the_mapped_file(spark, tmp_path):
    path = str(tmp_path / "t")
    token_files.write(docs(spark, [(1, "word " * 5000)]), path, length=64)
    import pyarrow as pa

    sequences = token_files.Sequences(path)
    before = pa.total_allocated_bytes()
    views = [sequences[k][0] for k in range(0, len(sequences), 3)]
    assert pa.total_allocated_bytes() - before < 1000 and len(views) > 20
    assert views[0].dtype == np.uint16  # the vocabulary has 50,257 ids


def test_repeated_rows_null_keys_and_clashing_columns(spark, tmp_path):
    rows = [(None, "b c", 1, 2, 3), (5, None, 1, 2, 3), (5, "same", 1, 2, 3), (5, "same", 1, 2, 3), (4, "x", 1, 2, 3)]
    df = docs(spark, rows, ", key long, start long, n_tokens long")
    path = str(tmp_path / "t")
    token_files.write(df, path, length=8)
    got = token_files.read(spark, path).collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens) for r in got) == [
        (False, 0, 3), (True, 4, 2), (True, 5, 1), (True, 5, 2), (True, 5, 2)]
    order = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in order] == [None, 4, 5, 5, 5]
    assert all(a.start + a.n_tokens == b.start for a, b in zip(order, order[1:], strict=False))


def test_empty_table_and_string_keys(spark, tmp_path):
    token_files.write(docs(spark, []), str(tmp_path / "a"))
    assert token_files.read(spark, str(tmp_path / "a")).count() == 0 and len(token_files.Sequences(str(tmp_path / "a"))) == 0
    named = spark.createDataFrame([("b", "x y"), ("a", "z")], "name string, text string")
    token_files.write(named, str(tmp_path / "b"), key="name")
    got = token_files.read(spark, str(tmp_path / "b"), key="name", key_type="string").collect()
    assert [(r.name, r.start) for r in sorted(got, key=lambda r: r.start)] == [("a", 0), ("b", 2)]


def test_failed_tasks_leave_nothing_to_see(spark, tmp_path):
    path = tmp_path / "t"
    bad = docs(spark, [(k, "x") for k in range(20)]).selectExpr(
        "doc_id", "if(doc_id = 13, raise_error('lost'), text) as text")
    with pytest.raises(Exception, match="lost"):
        token_files.write(bad.repartition(4), str(path))
    assert not (path / token_files.MANIFEST).exists()


def test_query(spark, tmp_path):
    rows = list(enumerate(texts(9, 60)))
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    want = expected(rows)
    got = queries.op12_token_files(spark, str(tmp_path))
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    start = {i: sum(len(want[j]) for j in want if j < i) for i in want}
    assert {tuple(r) for r in got.collect()} == {(i, start[i], len(x), zlib.crc32(packed(x))) for i, x in want.items()}
