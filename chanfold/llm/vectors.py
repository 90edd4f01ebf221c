"""Vectors in Spark: which take part, blocks of them, and exact cosines.

A block is one row that holds many vectors as bytes, so that a join of blocks
carries matrices and tasks multiply them; no row per pair of vectors is made.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = "cell long, ids binary, data binary"


def usable(rows: DataFrame, id_col: str, vector_col: str, length: int | None = None) -> DataFrame:
    """id, vector (array<double>) of the rows that take part, one for each id:
    the id is not null, and the vector is not null, has only finite components,
    is not all zero and has ``length`` components, else as many as most vectors
    (of equals, the smaller).  Of rows that repeat an id the one with the
    smallest hash of its vector is taken (of equal hashes, the smaller vector)."""
    v = F.col("vector")
    out = rows.select(F.col(id_col).cast("long").alias("id"),
                      F.col(vector_col).cast("array<double>").alias("vector"))
    out = out.where(F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0)).where(
        F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        & F.exists(v, lambda x: x != 0.0))
    if length is None:
        most = out.groupBy(F.size(v).alias("n")).count().orderBy(F.desc("count"), "n").first()
        length = most["n"] if most else 0
    return (out.where(F.size(v) == length).groupBy("id")
            .agg(F.min(F.struct(F.xxhash64("vector").alias("hash"), "vector")).alias("own")).select("id", "own.vector"))


def first_copies(rows: DataFrame, most: int) -> DataFrame:
    """Of rows with equal vectors, the ``most`` with the smallest ids."""
    order = Window.partitionBy("vector").orderBy("id")
    return rows.withColumn("__n", F.row_number().over(order)).where(F.col("__n") <= most).drop("__n")


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, also where squares would over- or underflow."""
    x = np.asarray(vectors, np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def matrix(series) -> np.ndarray:
    return np.array(series.tolist(), np.float64)


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, by one rule of summation, so equal rows get equal values."""
    return np.clip((a * b).sum(axis=1), -1.0, 1.0)


def cells_to_blocks(cells: np.ndarray, ids: np.ndarray, data: np.ndarray, most: int, kind: str = "<f8"):
    """Rows (cell, ids, data) that hold the rows of each cell, at most ``most``
    of them in a row; ``kind`` is the type of the data's numbers."""
    order = np.argsort(cells, kind="stable")
    cuts = np.flatnonzero(np.diff(cells[order])) + 1
    out = []
    for part in np.split(order, cuts):
        for lo in range(0, len(part), most):
            own = part[lo:lo + most]
            if len(own):
                out.append((int(cells[own[0]]), ids[own].astype("<i8").tobytes(),
                            np.ascontiguousarray(data[own], kind).tobytes()))
    return pd.DataFrame(out, columns=["cell", "ids", "data"])


def read_block(ids: bytes, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    own = np.frombuffer(ids, "<i8")
    return own, np.frombuffer(data, "<f8").reshape(len(own), -1)


def sample(rows: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """At most ``most`` rows, those with the smallest id hashes, as arrays."""
    got = rows.orderBy(F.xxhash64("id"), "id").limit(most).toPandas()
    return got["id"].to_numpy(np.int64), unit(matrix(got["vector"])) if len(got) else np.zeros((0, 1))
