"""Filter interaction audit: what each of several filters removes in any order.

Five filters judge a text by itself or by the table: A too few words, B too few
distinct words, C too many capitals, D symbols, E equal to the text of a smaller
id.  The first four come from one pass of a table-driven transducer over the
UTF-8 bytes of the text: each byte's row of ``_OUT`` says whether the machine is
inside a word after it and which of the counts of capitals, code points and
symbols it adds to.  The spans of words that the machine leaves go into a hash
table that compares bytes (``spans.distinct``), which counts distinct words.

``audit`` then needs only the number of documents of each part and set of failed
filters: an order of the filters is replayed on these sets, not on documents.
"""

from __future__ import annotations

import hashlib
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chanfold.llm.common import python_tasks, release, written
from chanfold.llm.spans import distinct, joined, runs, text_slices

FILTERS = "ABCDE"
LEAST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT, SYMBOLS = 200, 50, 3, b"#$%&*|"
#: Bytes of texts in one pass; bounds memory.
SLICE = 2 << 20
#: Rows up to which a side is broadcast; beyond, the join shuffles.
BROADCAST_ROWS = 500_000

#: State after a byte and what the byte adds, as bits.
_WORD, _CAPITAL, _POINT, _SYMBOL = 1, 2, 4, 8
_OUT = np.array([(0 if b == 32 or 9 <= b <= 13 else _WORD) | (_CAPITAL if 65 <= b <= 90 else 0)
                 | (0 if 128 <= b < 192 else _POINT) | (_SYMBOL if b in SYMBOLS else 0) for b in range(256)], np.uint8)


def counts(offsets: np.ndarray, data: np.ndarray) -> dict[str, np.ndarray]:
    """Words, distinct words, capitals, code points and symbols of each text."""
    n = len(offsets) - 1
    data, starts = joined(offsets, data, 32)
    out = _OUT[data]
    own = out[:starts[-1]].copy()
    own[starts[1:] - 1] = 0                              # the marks between texts add nothing
    total = lambda bit: np.add.reduceat((own & bit) > 0, starts[:-1], dtype=np.int64)
    at, lens = runs((own & _WORD) > 0)
    at, lens = at.astype(np.int32), lens.astype(np.int32)
    text = (np.searchsorted(starts, at, "right") - 1).astype(np.int32)
    first = distinct(data, at, lens, owners=text) == np.arange(len(at))
    return {"words": np.bincount(text, minlength=n), "distinct": np.bincount(text[first], minlength=n),
            "capitals": total(_CAPITAL), "points": total(_POINT), "symbols": total(_SYMBOL)}


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """doc_id, part, the five counts, failed (bits of A to D, from 1) and k1,
    k2 (128 bits of the text's hash) of every row.  Null text is empty."""
    python_tasks(docs.sparkSession)
    names = ["words", "distinct", "capitals", "points", "symbols"]
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def task(batches):
        for batch in batches:
            for lo, offsets, data in text_slices(batch.column("text"), SLICE):
                c = counts(offsets, data)
                failed = ((c["words"] < LEAST_WORDS) + 2 * (100 * c["distinct"] < DISTINCT_PERCENT * c["words"])
                          + 4 * (100 * c["capitals"] > CAPITAL_PERCENT * c["points"]) + 8 * (c["symbols"] > 0))
                keys = b"".join(hashlib.blake2b(data[a:b], digest_size=16).digest()
                                for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()))
                keys = np.frombuffer(keys, "<i8").reshape(-1, 2)
                some = batch.slice(lo, len(offsets) - 1)
                yield pa.record_batch(
                    [some.column("doc_id"), some.column("part"), *(pa.array(c[k].astype(np.int64)) for k in names),
                     pa.array(failed.astype(np.int32)), pa.array(keys[:, 0]), pa.array(keys[:, 1])],
                    names=["doc_id", "part", *names, "failed", "k1", "k2"])
        release()

    return rows.mapInArrow(task, "doc_id long, part string, words long, distinct long, capitals long, points long, "
                                 "symbols long, failed int, k1 long, k2 long")


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """doc_id, part and failed (bits of A to E, from 1) of every row.

    A row fails E if a row with a smaller id has the same text.  Rows with a
    null id neither fail E nor make others fail; rows that repeat the smallest
    id of a text do not fail it."""
    rows = written(measure(docs, id_col, text_col, part_col).select("doc_id", "part", "failed", "k1", "k2"), "judged")
    several = (rows.where(F.col("doc_id").isNotNull()).groupBy("k1", "k2")
               .agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
               .where("least < most").select("k1", "k2", "least"))
    several = written(several, "repeated-texts")
    again = F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False))
    return rows.join(_small(several), ["k1", "k2"], "left").select(
        "doc_id", "part", (F.col("failed") + F.when(again, 16).otherwise(0)).alias("failed"))


def failure_sets(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 part_col: str = "lang") -> DataFrame:
    """part, failed, good, toxic, docs: documents by part, failed filters and
    labels.  Of repeated labels of an id, a 1 counts."""
    marks = (labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("doc_id"))
             .agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")))
    marks = written(marks, "marks")
    flag = lambda c: F.coalesce(F.col(c), F.lit(False)).alias(c)
    return (judged(docs, id_col, text_col, part_col).join(_small(marks), "doc_id", "left")
            .groupBy("part", "failed", flag("good"), flag("toxic")).agg(F.count(F.lit(1)).alias("docs")))


def audit(sets: DataFrame) -> DataFrame:
    """For every part, order of the filters and step: kept (documents left after
    the step), removed (by it), redundant (failing its filter, removed before),
    unique_fails (failing its filter alone), good_lost and toxic_lost (of the
    removed) and shapley (documents that its filter removes, summed over all
    orders).  An empty table gives no rows."""
    orders = F.array(*(F.lit("".join(p)) for p in permutations(FILTERS)))
    rows = written(sets, "failure-sets").withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(
        F.array(*(F.lit(i + 1) for i in range(len(FILTERS))))))
    place = {f: F.instr("filter_order", f) for f in FILTERS}
    bits = lambda holds: sum((F.when(holds(place[f]), 1 << i).otherwise(0)
                              for i, f in enumerate(FILTERS)), F.lit(0))
    rows = rows.withColumn("own", bits(lambda at: at == F.col("step"))).withColumn(
        "before", bits(lambda at: at < F.col("step")))
    fails = F.col("failed").bitwiseAND(F.col("own")) != 0
    gone = F.col("failed").bitwiseAND(F.col("before")) != 0
    number = lambda c, name: F.sum(F.when(c, F.col("docs")).otherwise(0)).alias(name)
    steps = rows.groupBy("part", "filter_order", "step").agg(
        number(~fails & ~gone, "kept"), number(fails & ~gone, "removed"), number(fails & gone, "redundant"),
        number(F.col("failed") == F.col("own"), "unique_fails"),
        number(fails & ~gone & F.col("good"), "good_lost"), number(fails & ~gone & F.col("toxic"), "toxic_lost"))
    letter: Column = F.substring(F.col("filter_order"), F.col("step"), F.lit(1))
    steps = steps.withColumn("filter", letter)
    everywhere = Window.partitionBy("part", "filter")    # a row per order
    return steps.select("part", "filter_order", "step", "filter", "kept", "removed", "redundant", "unique_fails",
                        "good_lost", "toxic_lost", F.sum("removed").over(everywhere).alias("shapley"))
