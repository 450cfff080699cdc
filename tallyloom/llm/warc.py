"""WARC archives through Spark's own text source: write captures, read records, assemble transactions.

A record ends with CRLF CRLF, so a gzipped text table with that line separator,
one record a row, is a WARC file; Spark commits, places and reads the files,
wherever the shared folder is. Reading splits at the same separator; the parts
of a file come in order to one task, which cuts the byte stream into records by
Content-Length, so payloads may hold the separator themselves.

Each capture has a request, a response or revisit, and a metadata record; the
first and last name the capture in WARC-Concurrent-To, and ``assemble`` joins on
it. Of captures with equal payloads of at least ``min_bytes`` the first by
(page id, nulls last; then URL) is the response and the others are revisits that
refer to it. Record ids are made from page id, URL and payload, so that they do
not change when a task runs again; repeated rows are captures with one id, which
``assemble`` counts. Null payloads are empty, null page ids have no page-id field
and come back null. Runs of
control characters in a URL become %0A. Empty tables give no rows.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CRLF = "\r\n"
GAP = "\r\n\r\n"
MIN_BYTES = 100
RECORDS_A_FILE = 60_000
DATE = "2025-01-01T00:00:00Z"


def _urn(*parts: Column) -> Column:
    h = F.sha2(F.concat_ws("|", *parts), 256)
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _record(kind: str | Column, rid: Column, block: Column, mime: str, *extra: Column) -> Column:
    """One record's text without the closing gap; a null extra header is left out."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    head = F.concat_ws(CRLF, F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), kind),
                       F.concat(F.lit("WARC-Record-ID: "), rid), F.lit(f"WARC-Date: {DATE}"),
                       F.lit(f"Content-Type: {mime}"), *extra,
                       F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    return F.concat(head, F.lit(GAP), block)


def _header(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value)


def plan_captures(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html",
                  min_bytes: int = MIN_BYTES) -> DataFrame:
    """pages with payload (never null), digest, n_bytes, rid (record id) and refers (the response's record id);
    the key and url columns must not be named so."""
    df = pages.withColumn("payload", F.coalesce(F.col(payload), F.lit("")))
    df = df.withColumn("digest", F.sha2(F.col("payload").cast("binary"), 256))
    df = df.withColumn("n_bytes", F.octet_length("payload").cast("long"))
    order = F.struct(F.col(key).isNull().alias("z"), F.col(key).alias("k"), F.col(url).alias("u"))
    first = (df.filter(F.col("n_bytes") >= min_bytes).groupBy("digest")
             .agg(F.min(order).alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n"))

    def rid(k, u):
        null = F.concat(k.isNull().cast("string"), u.isNull().cast("string"))
        return _urn(F.lit("capture"), null, k.cast("string"), u, F.col("digest"))

    df = df.join(first, "digest", "left").withColumn("rid", rid(F.col(key), F.col(url)))
    to = rid(F.col("first.k"), F.col("first.u"))
    return df.withColumn("refers", F.when(F.col("first").isNotNull() & (to != F.col("rid")), to)).drop("first")


def write(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html",
          min_bytes: int = MIN_BYTES) -> None:
    """Write request, response or revisit, and metadata records of every row as gzipped WARC files under path."""
    pages = pages.select(F.col(key).alias("k"), F.col(url).alias("u"), F.col(payload).alias("p"))
    df = plan_captures(pages, "k", "u", "p", min_bytes)
    rid, digest = F.col("rid"), F.concat(F.lit("sha256:"), F.col("digest"))
    clean = F.when(F.col("u").rlike(r"[\x00-\x1f\x7f]"), F.regexp_replace("u", r"[\x00-\x1f\x7f]+", "%0A")).otherwise(F.col("u"))
    target = _header("WARC-Target-URI", clean)
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("n_bytes").cast("string"), F.lit(GAP))
    again = F.col("refers").isNotNull()
    get = F.concat(F.lit("GET "), F.coalesce(F.regexp_extract(clean, r"^[a-z]+://[^/?#]*([^#]*)", 1), F.lit("/")),
                   F.lit(" HTTP/1.1\r\nHost: "),
                   F.coalesce(F.regexp_extract(clean, r"^[a-z]+://([^/?#]*)", 1), F.lit("")), F.lit(GAP))
    about = F.coalesce(F.concat(F.lit("page-id: "), F.col("k").cast("string"), F.lit(CRLF)), F.lit(""))
    linked = _header("WARC-Concurrent-To", rid)
    records = F.array(
        _record("request", _urn(F.lit("request"), rid), get, "application/http; msgtype=request", target, linked),
        _record(F.when(again, "revisit").otherwise("response"), rid,
                F.when(again, http).otherwise(F.concat(http, F.col("payload"))), "application/http; msgtype=response",
                target, _header("WARC-Payload-Digest", digest), _header("WARC-Refers-To", F.col("refers")),
                F.when(again, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        _record("metadata", _urn(F.lit("metadata"), rid), about, "application/warc-fields", target, linked))
    (df.select(F.explode(records).alias("value")).write.option("lineSep", GAP).option("compression", "gzip")
     .option("maxRecordsPerFile", RECORDS_A_FILE).text(path))


_RECORD = ("record_id string, record_type string, concurrent_to string, refers_to string, target_uri string, "
           "date string, payload_digest string, declared_digest string, payload_bytes long, page_id string, payload binary")


def _parse(head: bytes, block: bytes, with_payload: bool) -> tuple:
    fields = dict(x.split(": ", 1) for x in head.decode("utf-8", "replace").split(CRLF)[1:] if ": " in x)
    kind = fields.get("WARC-Type")
    n = digest = body = page = None
    if kind in ("response", "revisit"):
        http, _, body = block.partition(GAP.encode())
        if kind == "response":
            n, digest = len(body), hashlib.sha256(body).hexdigest()
        else:
            said = dict(x.split(b": ", 1) for x in http.split(b"\r\n")[1:] if b": " in x).get(b"Content-Length")
            n = int(said) if said else None
            digest = fields.get("WARC-Payload-Digest", "").removeprefix("sha256:") or None
    elif kind == "metadata":
        page = dict(x.split(": ", 1) for x in block.decode("utf-8", "replace").split(CRLF) if ": " in x).get("page-id")
    return (fields.get("WARC-Record-ID"), kind, fields.get("WARC-Concurrent-To"), fields.get("WARC-Refers-To"),
            fields.get("WARC-Target-URI"), fields.get("WARC-Date"), digest, fields.get("WARC-Payload-Digest"), n, page,
            body if with_payload and kind == "response" else None)


def _cut(with_payload: bool):
    """Parts of files, in order, to records."""
    names = [x.split()[0] for x in _RECORD.split(", ")]
    types = [{"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[x.split()[1]] for x in _RECORD.split(", ")]
    gap = GAP.encode()

    def run(batches):
        file, head, parts, have, need = None, None, [], 0, 0
        for batch in batches:
            rows = []
            for part, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if name != file:
                    file, head, parts, have = name, None, [], 0
                parts.append(part + gap)
                have += len(part) + 4
                while True:
                    if head is None:
                        data = b"".join(parts)
                        head, found, data = data.partition(gap)
                        if not found:
                            head, parts, have = None, [data], len(data)
                            break
                        size = next((x[15:] for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:")), b"0")
                        parts, have, need = [data], len(data), int(size) + 4
                    if have < need:
                        break
                    data = b"".join(parts)
                    rows.append(_parse(head, data[:need - 4], with_payload))
                    head, parts, have = None, [data[need:]], len(data) - need
                    if not have:
                        break
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(list(zip(*rows, strict=True)) or [()] * len(names), types, strict=True)],
                names=names)

    return run


def read(spark, path: str, with_payload: bool = False) -> DataFrame:
    """One row per record of the gzipped archives under path."""
    parts = (spark.read.option("lineSep", GAP).text(path)
             .select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file")))
    return parts.mapInArrow(_cut(with_payload), _RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: capture, request and metadata structs, joined through concurrent-to.

    Records whose capture is missing stay, with a null capture. ``copies`` says how
    many times the capture stands in the archives (repeated rows).
    """
    kinds = {"capture": ("response", "revisit"), "request": ("request",), "metadata": ("metadata",)}
    of = {"capture": ["record_id", "record_type", "refers_to", "target_uri", "date", "payload_digest", "payload_bytes",
                      "payload"], "request": ["record_id", "target_uri", "date"], "metadata": ["record_id", "page_id"]}
    return (records.withColumn("capture_id", F.coalesce("concurrent_to", "record_id")).groupBy("capture_id")
            .agg(*[F.min(F.when(F.col("record_type").isin(*kinds[k]), F.struct(*of[k]))).alias(k) for k in kinds],
                 F.count_if(F.col("record_type").isin(*kinds["capture"])).alias("copies")))
