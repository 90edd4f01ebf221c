"""Language identification by error-correcting output codes.

Every language has a codeword of bits.  For each bit a logistic classifier on
hashed character n-grams tells whether a text belongs to the languages whose
codeword has that bit set.  A text gets the language with the smallest sum of
logistic losses between its codeword and the classifiers' margins, each bit
weighted by how well it was learnt.  The soft minimum of the losses is the
score; a text whose two best languages are close is flagged as ambiguous.

The model is fitted on at most ``max_train`` labelled documents (as many for
each language, those with the smallest id hashes) of at most ``max_languages``
languages, those with the most documents (of equals, the first by name); rarer
ones are never predicted.  Prediction reads every whole text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chanfold.llm import common
from chanfold.llm.features import groups_of, ngram_counts, sample_ids, training_rows, unit_rows

BUCKETS, ORDERS, UNKNOWN = 2048, (1, 2, 3), "und"
_LETTER = regex.compile(r"\p{L}")
#: Bytes as they are hashed: letters and bytes beyond ASCII, all else a space.
_CLASSES = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray                # languages x bits, of -1 and 1
    weights: np.ndarray             # BUCKETS x bits
    bias: np.ndarray
    trust: np.ndarray               # weight of each bit, summing to the bits


def has_letter(text: str | None) -> bool:
    return bool(text and _LETTER.search(text))


def vectors(texts: list[str | None]) -> np.ndarray:
    """Feature rows of whole texts; callers pass a few at a time."""
    rows = [b" " + (t or "").lower().encode("utf-8", "replace").translate(_CLASSES) + b" " for t in texts]
    return unit_rows(ngram_counts(rows, ORDERS, BUCKETS, b"  ")).astype(np.float32, copy=False)


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """Codewords of ``max(15, 10 log2 n)`` bits: of 300 random codes the one
    with the largest least distance between two words."""
    bits = max(15, int(np.ceil(10 * np.log2(max(n, 2)))))
    rng = np.random.default_rng(seed)
    best, best_gap = None, -1
    for _ in range(300):
        half = np.where(np.arange(n) < max(1, n // 2), 1, -1).astype(np.float64)
        code = np.stack([rng.permutation(half) for _ in range(bits)], axis=1)
        same = code @ code.T                             # bits less twice the distance
        np.fill_diagonal(same, -bits)
        gap = bits if n < 2 else int(round((bits - same.max()) / 2))
        if gap > best_gap:
            best, best_gap = code, gap
    return best


def fit(x: np.ndarray, labels: list[str], steps: int = 200, decay: float = 1e-4) -> Model | None:
    """All bit classifiers together, by accelerated gradient descent."""
    languages, x = sorted(set(labels)), np.asarray(x, np.float32)
    if not languages:
        return None
    code = codewords(len(languages))
    y = code[np.searchsorted(languages, labels)].astype(np.float32)
    w, b = np.zeros((x.shape[1], code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    vw, vb, rate = np.zeros_like(w), np.zeros_like(b), 4.0
    for k in range(steps):
        m = k / (k + 3)
        lw, lb = w + m * vw, b + m * vb
        g = -y / (1 + np.exp(np.clip(y * (x @ lw + lb), -50, 50))) / len(x)
        nw, nb = lw - rate * (x.T @ g + decay * lw), lb - rate * g.sum(axis=0)
        vw, vb, w, b = nw - w, nb - b, nw, nb
    loss = np.logaddexp(0, -y * (x @ w + b)).mean(axis=0)
    trust = 1 / (0.05 + loss)
    return Model(languages, code, w, b, trust * len(trust) / trust.sum())


def train(docs: DataFrame, max_train: int = 2400, max_languages: int = 120, id_col: str = "doc_id",
          text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """Model from the labelled rows of ``docs`` (null ids, labels and texts are
    left out); None without any."""
    lang = F.col(lang_col).cast("string")
    sizes = (docs.where(lang.isNotNull()).groupBy(lang.alias("lang")).count()
             .orderBy(F.desc("count"), "lang").limit(max_languages).collect())
    if not sizes:
        return None
    docs = docs.where(lang.isin([r["lang"] for r in sizes]))
    sample = sample_ids(docs, F.col(id_col), lang, max(1, max_train // len(sizes)))
    labels, x = training_rows(docs, sample, vectors, id_col, text_col, lang)
    return fit(x, labels) if labels else None


def decode(model: Model | None, texts: list[str | None], ambiguous_below: float = 0.15):
    """Language, score and whether the two best languages are close, per text.

    A text that is null or has no letter is ``und`` with score 0; so is every
    text when there is no model."""
    langs, scores, unsure = [UNKNOWN] * len(texts), [0.0] * len(texts), [True] * len(texts)
    rows = [i for i, t in enumerate(texts) if has_letter(t)]
    if model is None or not rows:
        return langs, scores, unsure
    own = [texts[i] for i in rows]
    margin = np.concatenate([vectors(own[part]) @ model.weights + model.bias for part in groups_of(own)])
    loss = np.logaddexp(0, -margin[:, None, :] * model.code[None]) @ model.trust
    odds = np.exp(loss.min(axis=1, keepdims=True) - loss)
    share = odds / odds.sum(axis=1, keepdims=True)
    best = share.argmax(axis=1)
    second = np.sort(share, axis=1)[:, -2] if share.shape[1] > 1 else np.zeros(len(rows))
    for i, k, s, t in zip(rows, best.tolist(), share.max(axis=1).tolist(), second.tolist()):
        langs[i], scores[i], unsure[i] = model.languages[k], s, s - t < ambiguous_below
    return langs, scores, unsure


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score (0 to 1) and ambiguous of every row.

    Repeated rows are predicted each, null ids stay null, an empty table gives
    no rows, and other columns are ignored."""
    common.python_tasks(docs.sparkSession)

    def task(frames):
        for frame in frames:
            langs, scores, unsure = decode(model, frame["text"].tolist())
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "lang_pred": langs,
                                "score": scores, "ambiguous": unsure})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInPandas(task, "doc_id long, lang_pred string, score double, ambiguous boolean")
