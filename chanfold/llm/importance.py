"""Importance resampling towards a target distribution.

A text's features are its words and pairs of neighbouring words, hashed into
buckets by their CRC-32 (``position_crc``).  All documents give the source
distribution over buckets and all target texts the target's, both smoothed by
one per bucket.  A document's weight is the mean logarithm of their ratio over
its features, in thousandths; Gumbel noise from the id's hash is added, and the
documents with the highest sums are the sample, drawn without replacement.

Two passes read the texts: one counts buckets, the other looks gains up.  Only
the two counts of each bucket reach the driver.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chanfold.llm.common import python_tasks, release, written
from chanfold.llm.position_crc import span_crcs
from chanfold.llm.spans import joined, runs, text_slices

BUCKETS, LEAST_WORDS, PERCENT, SEED = 10_000, 20, 25, 7
SLICE = 2 << 20

_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_IN_WORD = np.array([b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 for b in range(256)])


def features(offsets: np.ndarray, data: np.ndarray, buckets: int = BUCKETS):
    """Bucket of each word, bucket of each pair of neighbouring words of all
    texts laid end to end, and the number of words before each text (and in
    all).  The pair between two texts is among the pairs."""
    data, starts = joined(offsets, data, 32)
    data = _LOWER[data]
    inside = _IN_WORD[data]
    at, lens = runs(inside)
    first = np.searchsorted(at, starts)
    # The words alone, each with one space after it.
    inside[at + lens] = True
    data[at + lens] = 32
    data = data[inside]
    ends = np.cumsum(lens + 1)
    at = ends - lens - 1
    words = span_crcs(data, at, lens) % np.uint32(buckets)
    pairs = np.zeros(max(0, len(at) - 1), np.uint32)
    for odd in (0, 1):                                   # pairs that do not overlap
        one = np.arange(odd, len(at) - 1, 2)
        pairs[odd::2] = span_crcs(data, at[one], lens[one] + 1 + lens[one + 1]) % np.uint32(buckets)
    return words, pairs, first


def _inner_pairs(first: np.ndarray, n: int) -> np.ndarray:
    """Which pairs stand inside one text."""
    inner = np.ones(n, bool)
    between = first[1:-1] - 1
    inner[between[(between >= 0) & (between < n)]] = False
    return inner


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs in all texts (null: none)."""
    python_tasks(texts.sparkSession)

    def task(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, offsets, data in text_slices(batch.column("text"), SLICE):
                words, pairs, first = features(offsets, data, buckets)
                total += np.bincount(words, minlength=buckets)
                total += np.bincount(pairs[_inner_pairs(first, len(pairs))], minlength=buckets)
        hit = np.flatnonzero(total)
        yield pa.record_batch([pa.array(hit), pa.array(total[hit])], names=["bucket", "n"])
        release()

    rows = texts.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    got = rows.mapInArrow(task, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for r in got:
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of the target's to the source's share."""
    all_source, all_target = float(source.sum() + len(source)), float(target.sum() + len(target))
    return np.array([math.floor(1000 * math.log((t + 1) * all_source / ((s + 1) * all_target)))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """Thousandths of Gumbel noise from the hash of seed and id (null: empty)."""
    own = f"{seed}:{'' if doc_id is None else doc_id}".encode()
    h = int(hashlib.sha256(own).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _sums(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    upto = np.concatenate([[0], np.cumsum(values)])
    return upto[hi] - upto[lo]


def scores(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
           seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and text_hash of every row."""
    python_tasks(docs.sparkSession)
    table = docs.sparkSession.sparkContext.broadcast(gain)

    def task(batches):
        for batch in batches:
            for lo, offsets, data in text_slices(batch.column("text"), SLICE):
                words, pairs, first = features(offsets, data, len(table.value))
                n = np.diff(first)
                last = np.maximum(first[1:] - 1, first[:-1])
                total = _sums(table.value[words], first[:-1], first[1:])
                if len(pairs):
                    total += _sums(table.value[pairs], np.minimum(first[:-1], len(pairs)), np.minimum(last, len(pairs)))
                size = n + np.maximum(n - 1, 0)
                weight = np.where(size > 0, total // np.maximum(size, 1), 0)
                some = batch.slice(lo, len(n))
                own = np.array([noise(i, seed) for i in some.column("doc_id").to_pylist()], np.int64)
                yield pa.record_batch(
                    [some.column("doc_id"), some.column("text_hash"), pa.array(n.astype(np.int64)),
                     pa.array(size.astype(np.int64)), pa.array(weight), pa.array(weight + own)],
                    names=["doc_id", "text_hash", "n_words", "n_features", "weight", "score"])
        release()

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"),
                       text.alias("text"))
    return rows.mapInArrow(task, "doc_id long, text_hash long, n_words long, n_features long, weight long, score long")


def ranked(rows: DataFrame, *order) -> DataFrame:
    """``rows`` with ``rank`` (long, from 1) in the given order, made without a
    task that sees all of them: ranges of the order are sorted each by itself,
    and one count per range gives the ranks before it."""
    place = written(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                    .withColumn("__place", F.monotonically_increasing_id()), "places")
    part = F.shiftright("__place", 33)
    sizes = sorted(place.groupBy(part.alias("part")).count().collect())
    start, bases = 0, []
    for p, n in sizes:
        bases.append((p, start - (p << 33) + 1))
        start += n
    base = rows.sparkSession.createDataFrame(bases, "__part long, __base long")
    return (place.withColumn("__part", part).join(F.broadcast(base), "__part")
            .withColumn("rank", F.col("__place") + F.col("__base")).drop("__part", "__place", "__base"))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS,
             buckets: int = BUCKETS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row of ``docs``;
    rank is null for rows that are not drawn.

    Of the N rows with at least ``least_words`` words, ``percent * N // 100``
    are drawn, highest score first, ties to the smaller id, then (rows that
    repeat an id) to the smaller text hash.  Null and empty texts have no
    features, weight 0 and are not drawn; null ids share one noise value and
    come last among ties; empty tables (of either kind) are allowed; other
    columns are ignored."""
    gain = gains(bucket_counts(docs, text_col, buckets), bucket_counts(target, text_col, buckets))
    rows = written(scores(docs, gain, id_col, text_col, seed), "scores")
    long = F.col("n_words") >= least_words
    n = rows.where(long).count()
    names = ["doc_id", "n_features", "weight", "score"]
    best = ranked(rows.where(long), F.desc("score"), F.col("doc_id").asc_nulls_last(), F.col("text_hash"))
    drawn = F.when(F.col("rank") <= percent * n // 100, F.col("rank"))
    return best.select(*names, drawn.alias("rank")).unionByName(
        rows.where(~long).select(*names, F.lit(None).cast("long").alias("rank")))
