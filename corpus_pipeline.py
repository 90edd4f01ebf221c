"""Training-data pipeline over ``documents``: quality, language, line dedup,
near-duplicate documents, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that ``run``
writes as Parquet and reads back as the next stage's ``docs``.  All stages but
the last return the columns of their input.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chanfold.llm import bin_completion, bt_quality, common, ecoc_langid, jaccard_join, line_chunks
from chanfold.llm.features import keep_rows

#: A language is accepted from this score on.
LEAST_LANGUAGE_SCORE = 0.5
#: Rows up to which a side is broadcast; beyond, the join shuffles.
BROADCAST_ROWS = 1_000_000


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pairwise-ranking classifier accepts (all of them when
    there are no labels of both kinds to learn from)."""
    model = bt_quality.train(docs, common.table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return keep_rows(docs, lambda texts: [s >= bt_quality.THRESHOLD for s in bt_quality.scores(model, texts)])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters whose language is clear (with any letters, when
    there is no labelled language to learn from)."""
    model = ecoc_langid.train(docs)

    def clear(texts):
        langs, scores, _ = ecoc_langid.decode(model, texts)
        if model is None:
            return [ecoc_langid.has_letter(t) for t in texts]
        return [k != ecoc_langid.UNKNOWN and s >= LEAST_LANGUAGE_SCORE for k, s in zip(langs, scores)]

    return keep_rows(docs, clear)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without chunks and runs of lines that stand at an earlier
    place; ``n_chars`` follows the text."""
    out = line_chunks.dedup(docs, passages=True)
    if "n_chars" not in out.columns:
        return out
    kind = dict(docs.dtypes)["n_chars"]
    return out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(
        F.char_length("text")).cast(kind))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked texts, the one with the smallest
    doc_id; of rows that repeat id and text one stays.  Documents without words
    and rows with a null doc_id all stay."""
    groups = jaccard_join.join(docs)
    gone = (groups.where(F.col("doc_id") != F.col("component_id"))
            .select(F.col("doc_id").alias("__nd_id"), F.col("text_hash").alias("__nd_hash")).distinct())
    gone = common.written(gone, "near-duplicates")
    text_hash = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    mine = F.col("doc_id").cast("long")
    side = F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone
    left = docs.join(side, (mine == F.col("__nd_id")) & (text_hash == F.col("__nd_hash")), "left_anti")
    twice = (docs.where(F.col("doc_id").isNotNull()).groupBy(mine.alias("__nd_id"), text_hash.alias("__nd_hash"))
             .count().where("count > 1").drop("count"))
    twice = common.written(twice, "repeated-rows")
    if not twice.limit(1).count():
        return left
    same = (mine == F.col("__nd_id")) & (text_hash == F.col("__nd_hash"))
    once = left.join(twice, same, "left_semi").dropDuplicates(["doc_id", "text"])
    return left.join(twice, same, "left_anti").unionByName(once)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their ids and their place in a packed sequence."""
    pieces = bin_completion.token_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return bin_completion.pack(pieces.drop("ids"), capacity=1024)


STAGES = [
    ("quality classifier", quality),
    ("language ID", language),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("best-fit packing", packing),
]

#: The classifiers are not expressible in SQL; the tests compare each stage
#: with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
