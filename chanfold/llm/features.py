"""Hashed byte n-grams of whole texts, and feature rows to learn from."""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chanfold.llm.common import batches, python_tasks, release
from chanfold.llm.spans import text_slices

_SLICE = 1 << 19                     # bytes hashed at a time; bounds memory
TEXT_BYTES = 4 << 20                 # bytes of texts that are Python strings at a time
_MIX = np.array([2654435761, 2246822519, 3266489917, 668265263], np.uint32)


def ngram_counts(texts: list[bytes], orders: tuple[int, ...], buckets: int,
                 skip_pair: bytes | None = None) -> np.ndarray:
    """Counts of hashed n-grams: one row per text, ``buckets`` columns.

    n-grams that hold the two bytes ``skip_pair`` next to each other are left
    out.  Long texts are hashed slice by slice, whole."""
    out = np.zeros((len(texts), buckets), np.float32)
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    for lo in range(0, len(data), _SLICE):
        run = data[lo:lo + _SLICE + max(orders) - 1]
        first, last = np.searchsorted(ends, [lo, lo + len(run) - 1], side="right")
        doc = np.searchsorted(ends, np.arange(lo, lo + len(run)), side="right") - first
        wide = run.astype(np.uint32)
        pair = None
        if skip_pair is not None:
            pair = np.concatenate([[0], np.cumsum((run[:-1] == skip_pair[0]) & (run[1:] == skip_pair[1]))])
        for n in orders:
            size = min(_SLICE, len(run) - n + 1)
            if size <= 0:
                continue
            code = np.full(size, n * 40503, np.uint32)
            for k in range(n):
                code = (code ^ wide[k:k + size]) * _MIX[k % 4]
                code ^= code >> np.uint32(15)
            own = doc[:size]
            good = own == doc[n - 1:n - 1 + size]
            if pair is not None and n > 1:
                good &= pair[n - 1:n - 1 + size] == pair[:size]
            at = own[good].astype(np.int64) * buckets + (code[good] & np.uint32(buckets - 1))
            rows = int(last - first) + 1
            out[first:first + rows] += np.bincount(at, minlength=rows * buckets).reshape(rows, buckets)
    return out


def unit_rows(counts: np.ndarray) -> np.ndarray:
    """Square roots of counts, each row of length 1 (empty rows stay 0)."""
    x = np.sqrt(counts)
    norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.maximum(norm, 1e-12)


def groups_of(texts: list[str | None]):
    """Slices of texts whose bytes and feature rows take little memory."""
    yield from batches([max(len(t or ""), 4096) for t in texts], 1 << 20)


def sample_ids(rows: DataFrame, id_col: Column, label: Column, per_label: int) -> DataFrame:
    """At most ``per_label`` rows of each label: id, label.  They are those
    with the smallest hash of the id, so the sample does not depend on
    partitioning; only ids and labels are read.

    Of a label with many ids only those with a hash below twice the share that
    is wanted are ranked, so the ranking stays small however large it is."""
    own = rows.select(id_col.cast("string").alias("id"), label.alias("label"))
    own = own.where(F.col("label").isNotNull() & F.col("id").isNotNull()).distinct()
    place = F.shiftrightunsigned(F.xxhash64("id"), 11) / F.lit(float(1 << 53))      # 0 to 1
    sizes = own.groupBy("label").agg(F.count(F.lit(1)).alias("size"))
    low = own.join(F.broadcast(sizes), "label").where(place * F.col("size") <= 2 * per_label)
    order = Window.partitionBy("label").orderBy(place, "id")
    return low.select("id", "label", F.row_number().over(order).alias("n")).where(F.col("n") <= per_label).drop("n")


def training_rows(docs: DataFrame, sample: DataFrame, vectors, id_col: str = "doc_id",
                  text_col: str = "text", label: Column | None = None):
    """Labels and feature rows of the sampled documents with a text.

    ``sample`` (id, label) is broadcast: the caller bounds it.  ``vectors``
    turns a list of texts into a float32 array.  A sampled id and label give one
    row, however often they occur: that of the text with the smallest hash.  So
    the sample bounds the rows, and repeated ids displace no label.  ``label`` is
    the label of the rows of ``docs`` themselves, where they have one."""
    python_tasks(docs.sparkSession)
    own = [] if label is None else [label.alias("label")]
    texts = (docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"), *own)
             .where(F.col("text").isNotNull())
             .join(F.broadcast(sample), ["id", "label"] if own else "id")
             .groupBy("id", "label").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("first"))
             .select("id", "label", "first.text"))

    def task(frames):
        for batch in frames:
            texts = batch.column("text").to_pylist()
            rows = [r.tobytes() for part in groups_of(texts) for r in vectors(texts[part])]
            yield pa.record_batch([batch.column("id"), batch.column("label"), pa.array(rows, pa.binary())],
                                  names=["id", "label", "vector"])

    kind = dict(sample.dtypes)["label"]
    got = (texts.mapInArrow(task, f"id string, label {kind}, vector binary")
           .orderBy("label", F.xxhash64("id"), "vector").collect())
    x = np.frombuffer(b"".join(r["vector"] for r in got), np.float32)
    return [r["label"] for r in got], x.reshape(len(got), -1 if got else 0)


def labelled_vectors(docs: DataFrame, marks: DataFrame, vectors, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """Feature rows of all documents with a text and a label: place (hash of the
    id), label and vector (packed, see ``matrix``).

    ``marks`` (id as text, label) may be of any size.  An id and label give one
    row, however often they occur: that of the text with the smallest hash.
    Feature rows are shuffled, not texts."""
    python_tasks(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.where(F.col("id").isNotNull() & F.col("text").isNotNull())
    rows = rows.select("id", F.xxhash64("text").alias("text_hash"), "text")

    def task(frames):
        for batch in frames:
            texts = batch.column("text")
            packed = []
            for lo, offsets, _ in text_slices(texts, TEXT_BYTES):
                own = texts.slice(lo, len(offsets) - 1).to_pylist()
                for part in groups_of(own):
                    packed += [zlib.compress(r.tobytes(), 1) for r in vectors(own[part])]
            yield pa.record_batch([batch.column("id"), batch.column("text_hash"), pa.array(packed, pa.binary())],
                                  names=["id", "text_hash", "vector"])
        release()

    marks = marks.where(F.col("id").isNotNull() & F.col("label").isNotNull()).distinct()
    return (rows.mapInArrow(task, "id string, text_hash long, vector binary").join(marks, "id")
            .groupBy("id", "label").agg(F.min(F.struct("text_hash", "vector")).alias("first"))
            .select(F.xxhash64("id").alias("place"), "label", "first.vector"))


def matrix(packed) -> np.ndarray:
    """Feature rows of a column of packed vectors."""
    rows = [zlib.decompress(v) for v in packed.to_pylist()]
    return np.frombuffer(b"".join(rows), np.float32).reshape(len(rows), -1 if rows else 0)


def moments(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and standard deviation of each feature over all packed vectors."""
    def task(frames):
        n, first, second = 0, 0.0, 0.0
        for batch in frames:
            x = matrix(batch.column("vector")).astype(np.float64)
            if len(x):
                n, first, second = n + len(x), first + x.sum(axis=0), second + np.einsum("ij,ij->j", x, x)
        if n:
            yield pa.record_batch([pa.array([n]), pa.array([first.tobytes()]), pa.array([second.tobytes()])],
                                  names=["n", "first", "second"])

    got = rows.select("vector").mapInArrow(task, "n long, first binary, second binary").collect()
    n = sum(r["n"] for r in got)
    mean, second = (sum(np.frombuffer(r[k]) for r in got) / n for k in ("first", "second"))
    return mean, np.sqrt(np.maximum(second - mean * mean, 0))


def deal(rows: DataFrame, sizes: dict, size: int, least: int) -> DataFrame:
    """All ``rows`` (place, label, ...) dealt by place to groups of about
    ``size`` rows.  ``sizes`` has the rows of each label.  A label with fewer
    than ``least`` rows for each group goes to several groups a row."""
    n = math.ceil(sum(sizes.values()) / size)
    copies = F.lit(1)
    for label, count in sizes.items():
        copies = F.when(F.col("label") == label, min(n, math.ceil(least * n / count))).otherwise(copies)
    at = F.pmod(F.col("place"), F.lit(n))
    groups = F.transform(F.sequence(F.lit(0), copies - 1),
                         lambda k: F.pmod(at + F.floor(k * F.lit(n) / copies), F.lit(n)).cast("long"))
    return rows.withColumn("group", F.explode(groups))


def keep_rows(docs: DataFrame, decide, text_col: str = "text") -> DataFrame:
    """Rows of ``docs``, with all their columns, for whose text ``decide``
    (a list of texts or nulls to a list of booleans) is true."""
    python_tasks(docs.sparkSession)
    at = docs.columns.index(text_col)

    def task(frames):
        for batch in frames:
            texts = pc.cast(batch.column(at), pa.string())
            for lo, offsets, _ in text_slices(texts, TEXT_BYTES):
                n = len(offsets) - 1
                yield batch.slice(lo, n).filter(pa.array(decide(texts.slice(lo, n).to_pylist()), pa.bool_()))
        release()

    return docs.mapInArrow(task, docs.schema)
