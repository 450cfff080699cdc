import gzip
import hashlib
from pathlib import Path

from pyspark.sql import functions as F
from tallyloom.llm import warc

BIG = "<p>é" + "x" * 120


def test_round_trip(spark, tmp_path):
    rows = [(5, "http://h/a?b", BIG), (3, "http://h/b", BIG), (9, "http://h/c\r\nX: y", "a\r\n\r\nb\r\n\r\n" + "c" * 100 + "\r\n"),
            (4, None, None), (7, "u", "short"), (8, "u", "short"), (None, "u", BIG), (3, "http://h/b", BIG)]
    path = str(tmp_path / "w")
    warc.write(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3), path)
    records = warc.read(spark, path, with_payload=True)
    whole = warc.assemble(records)
    got = whole.select(F.col("metadata.page_id").cast("long").alias("id"), "capture.*", "capture_id", "copies").collect()
    assert sum(r.copies for r in got) == len(rows) and records.count() == 3 * len(rows)
    found = sorted((r.id or 0, r.payload_bytes, r.payload_digest, r.record_type, r.copies) for r in got)
    want = [(i or 0, len((t or "").encode()), hashlib.sha256((t or "").encode()).hexdigest(), kind, n) for (i, _, t), kind, n in (
        (rows[0], "revisit", 1), (rows[1], "response", 2), (rows[2], "response", 1), (rows[3], "response", 1),
        (rows[4], "response", 1), (rows[5], "response", 1), (rows[6], "revisit", 1))]
    assert found == sorted(want)
    first = {r.payload_digest: r.capture_id for r in got if r.record_type == "response"}
    assert all(r.refers_to == first[r.payload_digest] for r in got if r.record_type == "revisit")
    bodies = sorted(bytes(r.payload) for r in got if r.record_type == "response")
    assert bodies == sorted([BIG.encode(), rows[2][2].encode(), b"", b"short", b"short"])
    assert whole.filter("request is null or metadata is null").count() == 0
    text = b"".join(gzip.open(f).read() for f in Path(path).glob("*.gz"))
    assert text.count(b"WARC/1.1\r\n") == 3 * len(rows) and text.endswith(b"\r\n\r\n")


def test_empty(spark, tmp_path):
    path = str(tmp_path / "w")
    warc.write(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.assemble(warc.read(spark, path)).count() == 0


def test_orphans_stay(spark):
    r = spark.createDataFrame([("a", "request", "gone", None), ("b", "response", None, None)],
                              "record_id string, record_type string, concurrent_to string, refers_to string")
    for c in ("target_uri", "date", "payload_digest", "page_id"):
        r = r.withColumn(c, F.lit(None).cast("string"))
    r = r.withColumn("payload_bytes", F.lit(1).cast("long")).withColumn("payload", F.lit(None).cast("binary"))
    got = {x.capture_id: (x.capture is None, x.request is None) for x in warc.assemble(r).collect()}
    assert got == {"gone": (True, False), "b": (False, True)}
