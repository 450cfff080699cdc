"""Token ids as Arrow files of equal-length sequences, for zero-copy random access.

The ids of all documents, in ascending key order and each closed by an end id, form one
stream that is cut into sequences of ``length`` ids. A table is a folder of Arrow IPC files,
uncompressed, in record batches of ``BATCH`` rows; a row is a fixed-size list of ids and a
fixed-size list of mask bits (set where there is an id; only the last sequence of a file is
filled up). So row r of a file lies at a computable place of batch r div BATCH, and a reader
that maps the file into memory gets ids and mask without copying. Beside each file stands an
index, also Arrow, of its documents (key, first id in the file, number of ids). Ids are
stored in 16 bits where the vocabulary has at most 65,536, else in 32.

Rows are dealt in ranges of (key, text) and each task writes one file and its index through
a Python data source: files have names of their own, and only the driver's commit writes the
manifest that names the files of the tasks that counted, with the ids and sequences before
each. A reader sees what the manifest names, so a lost or repeated task leaves nothing to
see; an aborted write removes its files. The folder is reached through ``pyarrow.fs`` (local
and shared file systems, HDFS, object stores).

Null and empty texts are one end id. Null keys come first. Rows of equal key come by a hash
of the text, repeated rows are written once each. Special strings of the vocabulary in a text
are its added tokens, as in the ``tokenizers`` library. Texts longer than a batch span batches,
never files. An empty table gives a manifest without documents. Only the key and the text
column are read, so other columns cannot clash.
"""

from __future__ import annotations

import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from .bpe import Encoder

LENGTH = 2048
#: Sequences of a record batch.
BATCH = 256
END_ID = 2
VOCABULARY = "byte_bpe_50k.json"
MANIFEST = "_manifest.arrow"
INDEX_ROWS = 1 << 16


def _place(path: str):
    """The file system and inner path of a folder's address."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class _Sequences:
    """One file: ids come in, record batches of whole sequences go out."""

    def __init__(self, out, kind: pa.DataType, length: int):
        self.kind, self.length = kind, length
        self.numpy = np.dtype(kind.to_pandas_dtype()).newbyteorder("<")
        self.schema = pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.file = pa.ipc.new_file(out, self.schema)
        self.waiting, self.held, self.total, self.rows = [], 0, 0, 0

    def add(self, ids: np.ndarray) -> None:
        self.waiting.append(ids)
        self.held += len(ids)
        self.total += len(ids)
        if self.held >= BATCH * self.length:
            self._flush(self.held // (BATCH * self.length) * BATCH)

    def _flush(self, rows: int) -> None:
        every = np.concatenate(self.waiting) if self.waiting else np.zeros(0, self.numpy)
        for at in range(0, rows, BATCH):
            n = min(BATCH, rows - at)
            ids = every[at * self.length:(at + n) * self.length]
            mask = np.ones(n * self.length, bool)
            if len(ids) < len(mask):
                mask[len(ids):] = False
                ids = np.concatenate([ids, np.zeros(len(mask) - len(ids), self.numpy)])
            self.file.write_batch(pa.record_batch(
                [pa.FixedSizeListArray.from_arrays(pa.array(ids, self.kind), self.length),
                 pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length)], schema=self.schema))
        self.rows += rows
        rest = every[rows * self.length:]
        self.waiting, self.held = [rest], len(rest)

    def close(self) -> None:
        self._flush(-(-self.held // self.length))
        self.file.close()


@dataclass
class Written(WriterCommitMessage):
    part: int
    name: str
    tokens: int
    sequences: int
    documents: int


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path, self.vocabulary = options["path"], options["vocabulary"]
        self.length, self.end_id = int(options["length"]), int(options["end_id"])

    def write(self, iterator):
        from pyspark import TaskContext

        place, folder = _place(self.path)
        place.create_dir(folder)
        part, encoder = TaskContext.get().partitionId(), Encoder(self.vocabulary)
        small = encoder.size <= 1 << 16 and self.end_id < 1 << 16
        kind = pa.uint16() if small else pa.uint32()
        name = f"part-{part:06d}-{uuid.uuid4().hex}"
        end = np.array([self.end_id], "<u4")
        keys, starts, counts, documents, index = [], [], [], 0, None
        with (place.open_output_stream(f"{folder}/{name}.arrow") as out,
              place.open_output_stream(f"{folder}/{name}.index.arrow") as index_out):
            sequences = _Sequences(out, kind, self.length)

            def flush():
                nonlocal documents
                index.write_batch(pa.record_batch([pa.array(keys, schema.field(0).type), pa.array(starts, pa.int64()),
                                                   pa.array(counts, pa.int64())], schema=schema))
                documents += len(keys)
                for x in (keys, starts, counts):
                    x.clear()

            for batch in iterator:
                schema = pa.schema([batch.schema.field(0), ("start", pa.int64()), ("n_tokens", pa.int64())])
                index = index or pa.ipc.new_file(index_out, schema)
                for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    ids = np.concatenate([np.frombuffer(encoder.encode(text or ""), "<u4"), end])
                    keys.append(key)
                    starts.append(sequences.total)
                    counts.append(len(ids))
                    sequences.add(ids.astype(sequences.numpy))
                    if len(keys) >= INDEX_ROWS:
                        flush()
            if index is not None:
                flush()
                index.close()
            sequences.close()
        return Written(part, name, sequences.total, sequences.rows, documents)

    def commit(self, messages):
        place, folder = _place(self.path)
        place.create_dir(folder)
        rows, tokens, sequences = [], 0, 0
        self.abort([m for m in messages if m and not m.documents])  # tasks without rows leave no files
        for m in sorted((m for m in messages if m and m.documents), key=lambda m: m.part):
            rows.append((m.name, tokens, m.tokens, sequences, m.sequences, m.documents))
            tokens, sequences = tokens + m.tokens, sequences + m.sequences
        fields = ("name", "first_token", "tokens", "first_sequence", "sequences", "documents")
        kinds = (pa.string(), *(pa.int64(),) * 5)
        facts = {"length": str(self.length), "batch": str(BATCH), "end_id": str(self.end_id)}
        schema = pa.schema(list(zip(fields, kinds, strict=True)), metadata=facts)
        cols = list(zip(*rows, strict=True)) or [()] * len(fields)
        with place.open_output_stream(f"{folder}/{MANIFEST}") as out, pa.ipc.new_file(out, schema) as f:
            f.write_batch(pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], schema=schema))

    def abort(self, messages):
        place, folder = _place(self.path)
        for m in messages:
            if m:
                for name in (f"{m.name}.arrow", f"{m.name}.index.arrow"):
                    place.delete_file(f"{folder}/{name}")


def manifest(path: str) -> pa.Table:
    """The files of a written table: name, first_token, tokens, first_sequence, sequences, documents."""
    place, folder = _place(path)
    with place.open_input_file(f"{folder}/{MANIFEST}") as f:
        return pa.ipc.open_file(f).read_all()


@dataclass
class _File(InputPartition):
    name: str
    first_token: int


class _Reader(DataSourceReader):
    """Documents from the files: key, start in the whole stream, n_tokens, ids_crc32 (and ids)."""

    def __init__(self, options: dict):
        self.path, self.with_ids = options["path"], options.get("with_ids") == "true"

    def partitions(self):
        return [_File(r["name"], r["first_token"]) for r in manifest(self.path).to_pylist()] or [_File("", 0)]

    def read(self, file):
        if not file.name:
            return
        place, folder = _place(self.path)
        with (place.open_input_file(f"{folder}/{file.name}.arrow") as a,
              place.open_input_file(f"{folder}/{file.name}.index.arrow") as b):
            sequences, index = pa.ipc.open_file(a), pa.ipc.open_file(b)
            length = sequences.schema.field(0).type.list_size
            held, first, ids = -1, 0, np.zeros(0, "<u4")  # the batch at hand and its first id

            def batch_at(token: int):
                nonlocal held, first, ids
                k = token // (length * BATCH)
                if k != held:
                    held, first = k, k * length * BATCH
                    ids = sequences.get_batch(k).column(0).flatten().to_numpy().astype("<u4")
                return first, ids

            for k in range(index.num_record_batches):
                rows = index.get_batch(k)
                starts, counts = rows.column(1).to_pylist(), rows.column(2).to_pylist()
                checks, parts, size, done = [], [], 0, 0

                def batch(to):
                    cols = [rows.column(0).slice(done, to - done),
                            pa.array([file.first_token + s for s in starts[done:to]], pa.int64()),
                            pa.array(counts[done:to], pa.int64()), pa.array(checks, pa.int64())]
                    names = ["key", "start", "n_tokens", "ids_crc32"]
                    if self.with_ids:
                        cols.append(pa.array(parts, pa.list_(pa.int64())))
                        names.append("ids")
                    return pa.RecordBatch.from_arrays(cols, names=names)

                for at, (start, count) in enumerate(zip(starts, counts, strict=True)):
                    crc, token, pieces = 0, start, []
                    while token < start + count:
                        base, now = batch_at(token)
                        piece = now[token - base:start + count - base]
                        crc, token = zlib.crc32(piece, crc), token + len(piece)
                        if self.with_ids:
                            pieces.append(piece)
                    checks.append(crc)
                    if self.with_ids:
                        parts.append(np.concatenate(pieces).astype(np.int64))
                        size += count
                    if size > 1 << 20 or at == len(starts) - 1:
                        yield batch(at + 1)
                        checks, parts, size, done = [], [], 0, at + 1


class TokenFiles(DataSource):
    """Data source ``token_files``; options path, vocabulary, length, end_id to write, path, key_type, with_ids to read."""

    @classmethod
    def name(cls):
        return "token_files"

    def schema(self):
        ids = ", ids array<long>" if self.options.get("with_ids") == "true" else ""
        return f"key {self.options.get('key_type', 'long')}, start long, n_tokens long, ids_crc32 long{ids}"

    def reader(self, schema):
        return _Reader(dict(self.options))

    def writer(self, schema, overwrite):
        return _Writer({k: self.options[k] for k in ("path", "vocabulary", "length", "end_id")})


def write(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", *, vocabulary: str = VOCABULARY,
          length: int = LENGTH, end_id: int = END_ID) -> None:
    """Write the ids of all documents as a table of sequences in a new folder."""
    docs.sparkSession.dataSource.register(TokenFiles)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    # the last key parts repeated rows, which may be many
    dealt = rows.withColumn("_h", F.xxhash64("text")).withColumn("_n", F.monotonically_increasing_id())
    (dealt.repartitionByRange("key", "_h", "_n").sortWithinPartitions("key", "_h", "_n").select("key", "text")
     .write.format("token_files").mode("append").options(vocabulary=vocabulary, length=length, end_id=end_id).save(path))


def read(spark: SparkSession, path: str, key: str = "doc_id", key_type: str = "long", with_ids: bool = False) -> DataFrame:
    """One row a document of a written table: key, start, n_tokens, ids_crc32 (and ids)."""
    spark.dataSource.register(TokenFiles)
    return (spark.read.format("token_files").option("key_type", key_type).option("with_ids", str(with_ids).lower())
            .load(path).withColumnRenamed("key", key))


class Sequences:
    """Random access to a table's sequences by number; on a local folder ids and masks are views of mapped files."""

    def __init__(self, path: str):
        table = manifest(path)
        self._place, self._folder = _place(path)
        self._names = table.column("name").to_pylist()
        self._first = np.array(table.column("first_sequence").to_pylist(), np.int64)
        self._count = int(sum(table.column("sequences").to_pylist()))
        self._open: dict = {}

    def __len__(self) -> int:
        return self._count

    def _file(self, k: int):
        if k not in self._open:
            where = f"{self._folder}/{self._names[k]}.arrow"
            local = self._place.type_name == "local"
            self._open[k] = pa.ipc.open_file(pa.memory_map(where) if local else self._place.open_input_file(where))
        return self._open[k]

    def __getitem__(self, number: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """(ids, mask) of a sequence. The mask stays an Arrow array, as its bits are packed."""
        if not 0 <= number < self._count:
            raise IndexError(number)
        k = int(np.searchsorted(self._first, number, "right")) - 1
        row = number - int(self._first[k])
        batch = self._file(k).get_batch(row // BATCH)
        ids, mask = (batch.column(c).slice(row % BATCH, 1).flatten() for c in (0, 1))
        return ids.to_numpy(zero_copy_only=True), mask
