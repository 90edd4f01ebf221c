"""Quality classifier by Bradley-Terry pairwise ranking.

A document's strength is a linear function of its features.  It is learnt from
preference pairs, each a document of label 1 preferred to one of label 0, by
logistic loss on the difference of their features.  The threshold is a quantile
of the strengths of the labelled documents, weighted to the labels' shares in
all labelled rows: of the quantile levels, the one with the fewest labelled
documents on the wrong side.  The score is the logistic function of the
distance to the threshold, placed so that the threshold itself scores
``THRESHOLD``.

Every labelled document takes part in the fit.  Their features, scaled by the
means and deviations of all of them, are dealt by id hash to groups of about
``2 * per_label`` documents; each group learns its weights from pairs in which
each of its documents occurs, and the model has the mean of the groups'
weights.  The threshold is then taken from the strengths of all labelled
documents, counted in steps of ``STEP``.  Scoring reads every whole text.
"""

from __future__ import annotations

import math
import operator
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chanfold.llm import common
from chanfold.llm.features import (deal, groups_of, labelled_vectors, matrix, moments, ngram_counts, unit_rows)

BUCKETS, ORDERS, THRESHOLD = 512, (1, 2, 3), 0.3
#: Resolution of the strengths that the threshold is chosen from.
STEP = 0.001
#: A group has about this many documents of a rarer label, which go to several groups.
LEAST_PER_GROUP = 100
#: Bytes as they are hashed: the shape of a text without its words.
_SHAPE = bytes(ord("a") if b >= 128 or chr(b).islower() else ord("A") if chr(b).isupper()
               else ord("0") if chr(b).isdigit() else b for b in range(256))


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def score(self, x: np.ndarray) -> np.ndarray:
        s = ((x - self.mean) / self.scale) @ self.weights - self.threshold
        return 1 / (1 + np.exp(-np.clip(s + math.log(THRESHOLD / (1 - THRESHOLD)), -30, 30)))


def _traits(text: str, data: bytes) -> list[float]:
    words, lines = text.split(), text.split("\n")
    n = max(1, len(words))
    packed = zlib.compressobj(1)
    size = sum(len(packed.compress(data[i:i + (1 << 20)])) for i in range(0, len(data), 1 << 20))
    size += len(packed.flush())
    letters = sum(map(len, words))
    return [math.log1p(len(data)), size / (len(data) + 20), len(set(words)) / n,
            sum(map(operator.eq, words, words[1:])) / n, letters / n / 10,
            len(set(lines)) / len(lines), math.log1p(n / len(lines))]


def vectors(texts: list[str | None]) -> np.ndarray:
    """Shape n-grams and a few traits of whole texts (null: empty); callers
    pass a few at a time."""
    own = [t or "" for t in texts]
    data = [t.encode("utf-8", "replace") for t in own]
    grams = unit_rows(ngram_counts([d.translate(_SHAPE) for d in data], ORDERS, BUCKETS))
    traits = np.array([_traits(t, d) for t, d in zip(own, data)], np.float32).reshape(len(own), 7)
    return np.concatenate([grams, traits], axis=1).astype(np.float32, copy=False)


def learn(z: np.ndarray, i: np.ndarray, j: np.ndarray, steps: int = 400, decay: float = 1e-3) -> np.ndarray:
    """Weights under which rows ``i`` are preferred to rows ``j``, pair by pair."""
    z = np.ascontiguousarray(z, np.float64)
    w, v, rate = np.zeros(z.shape[1]), np.zeros(z.shape[1]), 0.05
    for k in range(steps):
        look = w + k / (k + 3) * v
        s = z @ look
        g = -1 / (1 + np.exp(np.clip(s[i] - s[j], -50, 50))) / len(i)
        per_doc = np.bincount(i, g, len(z)) - np.bincount(j, g, len(z))
        new = look - rate * (per_doc @ z + decay * look)
        v, w = new - w, new
    return w


def cut(s: np.ndarray, good: np.ndarray, poor: np.ndarray) -> float:
    """Threshold of strengths ``s`` (ascending, distinct) that hold the weights
    ``good`` and ``poor`` of labels 1 and 0: least weight on the wrong side, in
    the widest gap."""
    # Cutting below item k: label 1 items before k and label 0 items from k on are wrong.
    wrong = (np.concatenate([[0], np.cumsum(good)])
             + np.concatenate([np.cumsum(poor[::-1])[::-1], [0]]))
    inner = np.concatenate([[s[0] - 1], s, [s[-1] + 1]])
    ties = np.flatnonzero(wrong <= wrong.min() + 1e-12)
    best = max(ties, key=lambda k: inner[k + 1] - inner[k])
    return float((inner[best] + inner[best + 1]) / 2)


def fit(x: np.ndarray, y: np.ndarray, shares: tuple[float, float], max_pairs: int = 40_000,
        steps: int = 400, decay: float = 1e-3, seed: int = 11) -> Model:
    """Model of the rows ``x`` alone, from ``max_pairs`` random pairs.
    ``shares``: of labels 0 and 1 among all labelled rows."""
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3)
    z = (x - mean) / scale
    good, poor = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    rng = np.random.default_rng(seed)
    w = learn(z, rng.choice(good, max_pairs), rng.choice(poor, max_pairs), steps, decay)
    s, at = np.unique(z @ w, return_inverse=True)
    return Model(mean, scale, w, cut(s, np.bincount(at, (y == 1) * shares[1] / len(good), len(s)),
                                     np.bincount(at, (y == 0) * shares[0] / len(poor), len(s))))


def pairs(y: np.ndarray, most: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a row of label 1 and a row of label 0: ``most``, or as many as
    the larger label has rows; each row occurs."""
    rng = np.random.default_rng(seed)
    good, poor = rng.permutation(np.flatnonzero(y == 1)), rng.permutation(np.flatnonzero(y == 0))
    n = max(most, len(good), len(poor))
    return np.resize(good, n), rng.permutation(np.resize(poor, n))


def train(docs: DataFrame, labels: DataFrame, per_label: int = 2000, max_pairs: int = 40_000,
          id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model | None:
    """Model from all labelled documents; None unless both labels occur.  Null
    ids, labels and texts are left out; other labels than 0 and 1 are ignored.

    ``per_label`` and ``max_pairs`` are those of a group, not of all."""
    label = F.col(label_col).cast("int")
    rows = labels.where(label.isin(0, 1))
    shares = {r[0]: r[1] for r in rows.groupBy(label.alias("label")).count().collect()}
    if len(shares) < 2:
        return None
    marks = rows.select(F.col(id_col).cast("string").alias("id"), label.alias("label"))
    own = common.written(labelled_vectors(docs, marks, vectors, id_col, text_col), "vectors")
    sizes = {r[0]: r[1] for r in own.groupBy("label").count().collect()}
    if len(sizes) < 2:
        common.delete(own.sparkSession, own)
        return None
    mean, std = moments(own)
    scale = np.maximum(std, 1e-3)

    def group_weights(group: pa.Table) -> pa.Table:
        group = group.sort_by([("place", "ascending"), ("label", "ascending")])
        y = group.column("label").to_numpy()
        if len(set(y.tolist())) < 2:
            return pa.table({"group": [], "rows": [], "weights": []}, schema=kind)
        w = learn((matrix(group.column("vector")) - mean) / scale, *pairs(y, max_pairs))
        return pa.table({"group": group.column("group")[:1], "rows": [len(y)], "weights": [w.tobytes()]}, schema=kind)

    kind = pa.schema([("group", pa.int64()), ("rows", pa.int64()), ("weights", pa.binary())])
    dealt = deal(own, sizes, 2 * per_label, LEAST_PER_GROUP)
    got = sorted(dealt.groupBy("group").applyInArrow(group_weights, "group long, rows long, weights binary").collect())
    if not got:
        common.delete(own.sparkSession, own)
        return None
    weights = np.average([np.frombuffer(r["weights"]) for r in got], axis=0, weights=[r["rows"] for r in got])

    def strengths(frames):
        for batch in frames:
            s = (matrix(batch.column("vector")) - mean) / scale @ weights
            yield pa.record_batch([batch.column("label"), pa.array(np.rint(s / STEP).astype(np.int64))],
                                  names=["label", "step"])

    # Ordinary strengths are within some tens; farther ones count at the ends.
    step = F.greatest(F.least("step", F.lit(100_000)), F.lit(-100_000)).alias("step")
    counts = (own.select("label", "vector").mapInArrow(strengths, "label int, step long").groupBy("label", step)
              .count().collect())
    common.delete(own.sparkSession, own)
    s, at = np.unique([r["step"] for r in counts], return_inverse=True)
    weight = [r["count"] / sizes[r["label"]] * shares[r["label"]] / sum(shares.values()) for r in counts]
    y = np.array([r["label"] for r in counts])
    return Model(mean, scale, weights, cut(s * STEP, np.bincount(at, weight * (y == 1), len(s)),
                                           np.bincount(at, weight * (y == 0), len(s))))


def scores(model: Model | None, texts: list[str | None]) -> list[float]:
    """Scores of texts; 0.5 for every text when there is no model."""
    if model is None:
        return [0.5] * len(texts)
    return [s for part in groups_of(texts) for s in model.score(vectors(texts[part])).tolist()]


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """doc_id, score (0 to 1) and predicted (1 if score >= THRESHOLD, else 0)
    of every row.  Null text is empty and scored like any other; repeated rows
    are scored each; null ids stay null; other columns are ignored."""
    common.python_tasks(docs.sparkSession)

    def task(frames):
        for frame in frames:
            s = np.array(scores(model, frame["text"].tolist()), np.float64)
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "score": s,
                                "predicted": (s >= THRESHOLD).astype(np.int32)})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInPandas(task, "doc_id long, score double, predicted int")
