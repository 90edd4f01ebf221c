"""Token-ID output in Arrow stream files of fixed-size lists.

Documents are dealt by ranges of their id, encoded in ascending order, and each
task writes its run of ids as one Arrow stream file.  A file's record batches
hold ``BATCH_ROWS`` sequences (the last one fewer) of exactly ``seq_len`` ids:

* ``ids``: ``fixed_size_list<uint16 or uint32>[seq_len]``,
* ``mask``: ``fixed_size_list<bool>[seq_len]``, true for real ids (only the
  end of a file's last sequence is padding),
* ``doc_ids`` and ``doc_ends``: the documents that end in this sequence, and
  the position just after each one's last id.

So sequence ``i`` of a memory-mapped file is a view into its buffers
(``TokenFile``).  Files are written through ``pyarrow.fs``, hence to any store
it knows, under a name of their own for each attempt; the manifest, a Parquet
table committed by Spark, names the files of the attempts that count.  A folder
without a scheme belongs to Spark's default file system, not to the executor's
own disk.

Defined cases: null text is empty (its ids are the end id alone); documents
with equal ids stand in the order of their texts; null ids come first; an
empty table gives an empty manifest; other columns are ignored.
"""

from __future__ import annotations

import posixpath
import uuid
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chanfold.llm import common
from chanfold.llm.tokens import documents_ids, shared_encoder

BATCH_ROWS = 128
MANIFEST = "shard int, path string, n_docs long, n_tokens long, n_sequences long"


def schema_of(seq_len: int, id_type: pa.DataType) -> pa.Schema:
    return pa.schema([("ids", pa.list_(id_type, seq_len)), ("mask", pa.list_(pa.bool_(), seq_len)),
                      ("doc_ids", pa.list_(pa.int64())), ("doc_ends", pa.list_(pa.int32()))])


class _Writer:
    """Cuts a run of ids into sequences and writes them batch by batch."""

    def __init__(self, uri: str, seq_len: int, id_type: pa.DataType):
        self.fs, self.path = pafs.FileSystem.from_uri(uri)
        self.fs.create_dir(posixpath.dirname(self.path), recursive=True)
        self.schema, self.seq_len, self.id_type = schema_of(seq_len, id_type), seq_len, id_type
        self.sink = self.fs.open_output_stream(self.path)
        self.out = pa.ipc.new_stream(self.sink, self.schema)
        self.pending: list[np.ndarray] = []
        self.docs: list[tuple[int | None, int]] = []
        self.n_pending = self.n_docs = self.n_tokens = self.n_sequences = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.pending.append(ids)
        self.n_pending += len(ids)
        self.n_tokens += len(ids)
        self.n_docs += 1
        self.docs.append((doc_id, self.n_pending))
        if self.n_pending >= BATCH_ROWS * self.seq_len:
            self._flush(self.n_pending // (BATCH_ROWS * self.seq_len) * BATCH_ROWS)

    def _flush(self, rows: int) -> None:
        """Write ``rows`` sequences; keep the ids after them."""
        width, run = self.seq_len, np.concatenate(self.pending)
        n = min(len(run), rows * width)
        ids = np.zeros(rows * width, self.id_type.to_pandas_dtype())
        ids[:n] = run[:n]
        done = [(d, e) for d, e in self.docs if e <= n]
        ends = np.array([e for _, e in done], np.int64)
        row = (ends - 1) // width
        cuts = np.searchsorted(row, np.arange(rows + 1))
        offsets = pa.array(cuts, pa.int32())
        batch = pa.record_batch([
            pa.FixedSizeListArray.from_arrays(pa.array(ids), width),
            pa.FixedSizeListArray.from_arrays(pa.array(np.arange(rows * width) < n), width),
            pa.ListArray.from_arrays(offsets, pa.array([d for d, _ in done], pa.int64())),
            pa.ListArray.from_arrays(offsets, pa.array(ends - row * width, pa.int32())),
        ], schema=self.schema)
        for lo in range(0, rows, BATCH_ROWS):
            self.out.write_batch(batch.slice(lo, BATCH_ROWS))
        self.n_sequences += rows
        self.pending, self.n_pending = [run[n:]], len(run) - n
        self.docs = [(d, e - n) for d, e in self.docs[len(done):]]

    def close(self) -> None:
        if self.n_pending:
            self._flush(-(-self.n_pending // self.seq_len))
        self.out.close()
        self.sink.close()


def write(docs: DataFrame, tokenizer_path: str, folder: str | None = None, end_id: int = 2,
          seq_len: int = 2048, vocab_size: int = 1 << 16, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """Encode ``docs`` and write the files; the manifest has one row per file:
    shard (ascending with the ids of its documents), path, n_docs, n_tokens,
    n_sequences and start (ids in all files before it)."""
    spark = docs.sparkSession
    common.python_tasks(spark)
    folder = common.arrow_uri(spark, folder or common.scratch_path(spark, "token-files"))
    id_type = pa.uint16() if vocab_size <= 1 << 16 else pa.uint32()
    run = uuid.uuid4().hex

    def task(batches):
        writer = None
        with shared_encoder(tokenizer_path, run) as encoder:
            for batch in batches:
                ids = documents_ids(encoder, batch.column("text"), end_id)
                for doc_id, own in zip(batch.column("id").to_pylist(), ids):
                    if writer is None:
                        shard = TaskContext.get().partitionId()
                        uri = f"{folder}/shard-{shard:06d}-{uuid.uuid4().hex}.arrows"
                        writer = _Writer(uri, seq_len, id_type)
                    writer.add(doc_id, own)
        if writer is not None:
            writer.close()
            yield pa.record_batch([pa.array([shard], pa.int32()), pa.array([uri]), pa.array([writer.n_docs]),
                                   pa.array([writer.n_tokens]), pa.array([writer.n_sequences])],
                                  names=["shard", "path", "n_docs", "n_tokens", "n_sequences"])
        del encoder
        common.release()

    rows = docs.select(F.col(id_col).cast("long").alias("id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    ordered = rows.repartitionByRange(F.col("id"), F.xxhash64("text")).sortWithinPartitions("id", "text")
    manifest = common.written(ordered.mapInArrow(task, MANIFEST), "token-manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


class TokenFile:
    """Zero-copy random access to the sequences of one file."""

    def __init__(self, uri: str):
        fs, path = pafs.FileSystem.from_uri(uri)
        local = isinstance(fs, pafs.LocalFileSystem)
        self.source = pa.memory_map(path) if local else fs.open_input_file(path)
        self.reader = pa.ipc.open_stream(self.source)
        self.seq_len = self.reader.schema.field("ids").type.list_size
        self.batches = list(self.reader)

    def __len__(self) -> int:
        return sum(b.num_rows for b in self.batches)

    def sequence(self, i: int) -> np.ndarray:
        """ids of sequence ``i``, a view into the file."""
        column = self.batches[i // BATCH_ROWS].column("ids")
        at = i % BATCH_ROWS * self.seq_len
        return column.values[at:at + self.seq_len].to_numpy(zero_copy_only=True)

    def mask(self, i: int) -> pa.BooleanArray:
        """Mask of sequence ``i``, an Arrow view into the file."""
        column = self.batches[i // BATCH_ROWS].column("mask")
        at = i % BATCH_ROWS * self.seq_len
        return column.values[at:at + self.seq_len]


def read_documents(manifest: DataFrame) -> DataFrame:
    """The documents of the files, a task for each file: doc_id, start (ids of
    all documents before it), n_tokens, ids_crc32 (of its ids as little-endian
    unsigned 32-bit integers) and shard."""
    common.python_tasks(manifest.sparkSession)

    def documents(uri: str, start: int, shard: int):
        fs, path = pafs.FileSystem.from_uri(uri)
        local = isinstance(fs, pafs.LocalFileSystem)
        crc, size = 0, 0
        with (pa.memory_map(path) if local else fs.open_input_file(path)) as source:
            for batch in pa.ipc.open_stream(source):
                width = batch.schema.field("ids").type.list_size
                values = batch.column("ids").flatten().to_numpy(zero_copy_only=True)
                doc_ids, doc_ends = batch.column("doc_ids"), batch.column("doc_ends")
                of_row = np.repeat(np.arange(batch.num_rows), doc_ends.value_lengths().to_numpy())
                ends = doc_ends.flatten().to_numpy() + of_row * width
                rows, lo = [], 0
                for doc_id, hi in zip(doc_ids.flatten().to_pylist(), ends.tolist()):
                    crc = zlib.crc32(values[lo:hi].astype("<u4").data, crc)
                    size += hi - lo
                    rows.append((doc_id, start, size, crc, shard))
                    start, lo, crc, size = start + size, hi, 0, 0
                real = int(batch.column("mask").flatten().true_count)
                crc = zlib.crc32(values[lo:real].astype("<u4").data, crc)
                size += real - lo
                yield pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids_crc32", "shard"]
                                   ).astype({"doc_id": "Int64"})

    def task(frames):
        for frame in frames:
            for row in frame.itertuples():
                yield from documents(row.path, row.start, row.shard)

    files = manifest.select("path", "start", "shard")
    return files.repartition(max(1, manifest.count())).mapInPandas(
        task, "doc_id long, start long, n_tokens long, ids_crc32 long, shard int")
