"""Line dedup by content-defined chunks of lines.

A text's lines are cut into chunks where a rolling hash over the hashes of the
last ``WINDOW`` lines is a multiple of ``DIVISOR``, and on either side of a line
of ``long_words`` words or more.  Cuts depend on nearby lines alone, so a passage
that stands in many documents is cut alike in all of them, wherever it starts.

Chunks count if they have two or more lines that are not blank and
``least_words`` words, or are one long line.  Of all chunks with equal bytes in
the whole table the first one (by doc_id, then chunk) stays and the others are
removed, after a comparison of their bytes with those of the one that stays.

Cuts can miss a passage of few lines, or its ends.  With ``passages`` every run
of lines of ``long_words`` words or more that also stands at an earlier place is
removed as well, wherever it starts and ends.  It is enough to compare the
shortest such run from each line on and the shortest one up to each line: they
cover every longer run line by line.  Of runs that overlap their own first copy
only the lines beyond that copy go.  Single lines
below ``long_words`` are never removed by themselves.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chanfold.llm.common import python_tasks, release, written
from chanfold.llm.spans import text_slices

WINDOW, DIVISOR = 2, 3
#: Rows up to which a side is broadcast; beyond, the join shuffles.
BROADCAST_ROWS = 500_000
#: Bytes of texts whose chunks are made at a time; bounds memory.
SLICE = 1 << 20
_M = (1 << 64) - 1


def chunks(text: str, least_words: int, long_words: int) -> list[tuple[int, int, bool]]:
    """(first line, line after the last, counts) of each chunk of a text."""
    lines = text.split("\n")
    words = [len(x.split()) for x in lines]
    hashes = [zlib.crc32(x.encode("utf-8", "replace")) for x in lines]
    out, lo = [], 0
    for i in range(len(lines)):
        rolled = 0
        for h in hashes[max(lo, i - WINDOW + 1):i + 1]:
            rolled = ((rolled * 0x9E3779B97F4A7C15 & _M) + (h ^ h >> 15) * 0xD6E8FEB86659FD93) & _M
        last = i + 1 == len(lines)
        if (last or words[i] >= long_words or words[i + 1] >= long_words
                or (rolled >> 32) % DIVISOR == 0):
            own = words[lo:i + 1]
            some = sum(w > 0 for w in own)
            out.append((lo, i + 1, (some >= 2 and sum(own) >= least_words) or sum(own) >= long_words))
            lo = i + 1
    return out


def runs(text: str, long_words: int) -> list[tuple[int, int]]:
    """(first line, line after the last) of the shortest runs of lines with
    ``long_words`` words from each line on, and up to each line."""
    words = [len(x.split()) for x in text.split("\n")]
    out, hi, total = set(), 0, 0
    for lo in range(len(words)):
        while hi < len(words) and total < long_words:
            total += words[hi]
            hi += 1
        if total < long_words:
            break
        out.add((lo, hi))
        total -= words[lo]
    lo, total = 0, 0
    for hi in range(len(words)):
        total += words[hi]
        while total - words[lo] >= long_words:
            total -= words[lo]
            lo += 1
        if total >= long_words:
            out.add((lo, hi + 1))
    return sorted(out)


def _spans(text: str, least_words: int, long_words: int, passages: bool) -> list[tuple[int, int]]:
    own = [(lo, hi) for lo, hi, counts in chunks(text, least_words, long_words) if counts]
    return sorted({*own, *runs(text, long_words)}) if passages else own


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"),
                        text.alias("text")).where(F.col("text").isNotNull()))


def _chunk_rows(rows: DataFrame, least_words: int, long_words: int, passages: bool, with_text: bool) -> DataFrame:
    """A row per chunk that counts (and run); k1 and k2 are 128 bits of its bytes' hash."""
    def task(batches):
        for batch in batches:
            for start, offsets, _ in text_slices(batch.column("text"), SLICE):
                yield _keyed(batch.slice(start, len(offsets) - 1))
        release()

    def _keyed(batch):
        doc, lo_, hi_, k1, k2, body = [], [], [], [], [], []
        for d, text in enumerate(batch.column("text").to_pylist()):
            lines = None
            for lo, hi in _spans(text, least_words, long_words, passages):
                lines = lines or text.split("\n")
                own = "\n".join(lines[lo:hi])
                key = hashlib.blake2b(own.encode("utf-8", "replace"), digest_size=16).digest()
                doc.append(d)
                lo_.append(lo)
                hi_.append(hi)
                k1.append(key[:8])
                k2.append(key[8:])
                body.append(own if with_text else None)
        pick = pa.array(doc, pa.int64())
        longs = [pa.array(np.frombuffer(b"".join(k), "<i8")) for k in (k1, k2)]
        return pa.record_batch([batch.column("doc_id").take(pick), batch.column("text_hash").take(pick),
                                pa.array(lo_, pa.int32()), pa.array(hi_, pa.int32()), *longs,
                                pa.array(body, pa.string())],
                               names=["doc_id", "text_hash", "lo", "hi", "k1", "k2", "body"])

    return rows.mapInArrow(task, "doc_id long, text_hash long, lo int, hi int, k1 long, k2 long, body string")


def repeated(docs: DataFrame, least_words: int = 12, long_words: int = 50, id_col: str = "doc_id",
             text_col: str = "text", passages: bool = False) -> DataFrame:
    """Chunks (and runs, with ``passages``) to remove: doc_id, text_hash, lo and
    hi (lines), and the document, first_doc, whose equal chunk stays.

    Rows that repeat both doc_id and text are one document here."""
    python_tasks(docs.sparkSession)
    rows = _rows(docs, id_col, text_col)
    keys = _chunk_rows(rows, least_words, long_words, passages, False).drop("body")
    place = F.struct("doc_id", "text_hash", "lo")
    several = (keys.groupBy("k1", "k2").agg(F.min(place).alias("first"), F.max(place).alias("last"))
               .where(~F.col("first").eqNullSafe(F.col("last"))).select("k1", "k2", "first"))
    several = written(several, "repeated-chunks")
    small = several.count() <= BROADCAST_ROWS
    found = _chunk_rows(rows, least_words, long_words, passages, True).join(
        F.broadcast(several) if small else several, ["k1", "k2"])
    found = written(found, "chunk-texts")
    is_first = place.eqNullSafe(F.col("first"))
    kept = found.where(is_first).select("k1", "k2", F.col("body").alias("kept")).dropDuplicates(["k1", "k2"])
    # Runs can overlap their first copy, which stays whole.
    own = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash"))
    beyond = F.when(own, F.greatest("lo", F.col("first.lo") + F.col("hi") - F.col("lo"))).otherwise(F.col("lo"))
    return (found.where(~is_first).join(kept, ["k1", "k2"]).where(F.col("body") == F.col("kept"))
            .select("doc_id", "text_hash", beyond.alias("lo"), "hi", F.col("first.doc_id").alias("first_doc")))


def dedup(docs: DataFrame, least_words: int = 12, long_words: int = 50, id_col: str = "doc_id",
          text_col: str = "text", passages: bool = False) -> DataFrame:
    """``docs`` with all its columns and rows; repeated chunks (and runs, with
    ``passages``) are gone from the texts, and the lines left are joined by line
    feeds.

    Null and empty texts stay as they are; a text may become empty; rows that
    repeat both id and text are treated alike; a null id is a document like any
    other and comes first; other columns are not touched."""
    python_tasks(docs.sparkSession)
    gone = written(repeated(docs, least_words, long_words, id_col, text_col, passages), "removals")
    small = gone.count() <= BROADCAST_ROWS
    spans = gone.groupBy(F.col("doc_id").alias("__ld_id"), F.col("text_hash").alias("__ld_hash")).agg(
        F.collect_set(F.struct("lo", "hi")).alias("__ld_spans"))
    if small:
        spans = F.broadcast(spans)
    schema, at = docs.schema, docs.columns.index(text_col)
    same = (F.col(id_col).cast("long").eqNullSafe(F.col("__ld_id"))
            & (F.xxhash64(F.col(text_col).cast("string")) == F.col("__ld_hash")))
    joined = docs.join(spans, same, "left").select(*docs.columns, "__ld_spans")

    def task(batches):
        for batch in batches:
            for start, offsets, _ in text_slices(pc.cast(batch.column(at), pa.string()), SLICE):
                yield _without(batch.slice(start, len(offsets) - 1))
        release()

    def _without(batch):
        texts = batch.column(at).to_pylist()
        for i, own in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
            if own and texts[i] is not None:
                lines, left = texts[i].split("\n"), []
                lo = 0
                for s in sorted((s["lo"], s["hi"]) for s in own):
                    left += lines[lo:s[0]]
                    lo = max(lo, s[1])
                texts[i] = "\n".join(left + lines[lo:])
        columns = list(batch.columns[:-1])
        columns[at] = pa.array(texts, columns[at].type)
        return pa.record_batch(columns, names=schema.names)

    return joined.mapInArrow(task, schema)
