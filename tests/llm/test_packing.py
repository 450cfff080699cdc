import struct
import zlib
from collections import defaultdict

import public_tokenizers
from llm_helpers import docs, texts
from tallyloom.llm import packing
from tallyloom.llm.bpe import Encoder
from tokenizers import Tokenizer

ODD = ["", " ", "  a  b ", "a\n b\t\tc", "don't we'll  I'M", "x <|endoftext|> y", "a<|endoftext|>b", "<|endoftext|><|endoftext|>", "<|endoftext|", "é ü  z　", "12 345,6!? --", "😀 a😀", "a" * 9000]


def test_ids_equal_the_library():
    lib = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    own = Encoder(packing.VOCABULARY)
    for t in [*ODD, *(x for x in texts(6) if x)]:
        ids = lib.encode(t, add_special_tokens=False).ids
        assert own.encode(t) == struct.pack(f"<{len(ids)}I", *ids), t


def test_pieces_and_sequences(spark):
    rows = list(enumerate([*texts(7, 300), *ODD, "word " * 5000, None])) + [(None, "a b"), (3, "same"), (3, "same")]
    df = docs(spark, rows).repartition(5)
    got = packing.pack(df, window=64, open_windows=4, with_ids=True).collect()
    own, seq, doc = Encoder(packing.VOCABULARY), defaultdict(list), defaultdict(list)
    for r in got:
        assert len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32
        seq[r.sequence_id].append(r)
        doc[r.doc_id].append(r)
    for rows_of in seq.values():
        at = 0
        for r in sorted(rows_of, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 64
    for i, t in rows:
        if i is None or i == 3:
            continue
        at = sorted(doc[i], key=lambda r: r.start)
        ids = own.encode(t or "") + (1).to_bytes(4, "little")
        assert b"".join(bytes(r.ids) for r in at) == ids and [r.start for r in at] == list(range(0, len(ids) // 4, 64))
        assert {r.doc_tokens for r in at} == {len(ids) // 4}
    assert len(doc[None]) == 1
    used = sum(r.length for r in got)
    assert used >= 0.9 * 64 * len(seq)
    assert packing.pack(df.limit(0)).count() == 0
