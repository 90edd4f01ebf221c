"""Sets of hashed word shingles of whole texts.

Words are maximal runs of bytes other than ``\\x20`` and ``\\x09`` to ``\\x0D``,
with A-Z lower-cased.  A text's set holds its distinct shingles of ``width``
words; a text with fewer words has its whole sequence as the one shingle; a
text without words has none.  Shingles are 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from chanfold.llm.common import batches, mix
from chanfold.llm.spans import joined, text_slices

_SLICE = 1 << 19
_BYTE = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.random.default_rng(21).integers(1, 1 << 62, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_P = 0x9E3779B97F4A7C15 | 1
_FOLD = bytes(32 if b == 32 or 9 <= b <= 13 else b + 32 if 65 <= b <= 90 else b for b in range(256))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    out[1:] = base & (2**64 - 1)
    return np.cumprod(out, dtype=np.uint64)


_UP, _DOWN = _powers(_P, _SLICE + 1), _powers(pow(_P, -1, 2**64), _SLICE + 1)


def _word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every word of folded bytes."""
    hashes, starts, lo = [], [], 0
    while lo < len(data):
        hi = min(lo + _SLICE, len(data))
        if hi < len(data):  # end the slice at a space, if it has one
            gaps = np.flatnonzero(data[lo:hi] == 32)
            hi = lo + int(gaps[-1]) + 1 if len(gaps) else hi
        part = data[lo:hi]
        if hi < len(data) and part[-1] != 32:  # a word longer than a slice
            end = lo + int(np.argmax(data[lo:] == 32)) if (data[lo:] == 32).any() else len(data)
            value = np.uint64(1469598103934665603)
            for at in range(lo, end, _SLICE):
                own = _BYTE[data[at:min(end, at + _SLICE)]]
                value = mix(np.array([value], np.uint64) + (own * _UP[:len(own)]).sum(dtype=np.uint64))[0]
            hashes.append(np.array([value], np.uint64))
            starts.append(np.array([lo]))
            lo = end
            continue
        inside = part != 32
        edge = np.diff(np.concatenate([[0], inside.view(np.int8), [0]]))
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTE[part] * _UP[:len(part)], out=sums[1:])
        value = (sums[last] - sums[first]) * _DOWN[first]
        hashes.append(mix(value + (last - first).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
        starts.append(first + lo)
        lo = hi
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(starts)


def _sets(data: np.ndarray, texts: np.ndarray, width: int) -> list[np.ndarray]:
    """Sets of texts that start at ``texts`` (the last is the end of all) in
    folded bytes with a space after each text."""
    words, starts = _word_hashes(data)
    cuts = np.searchsorted(starts, texts)
    n = max(0, len(words) - width + 1)
    grams = np.zeros(n, np.uint64)
    for k in range(width):
        grams += words[k:k + n] * _STEP[k]
    grams = mix(grams)
    out: list[np.ndarray] = []
    for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if hi - lo >= width:
            out.append(np.unique(grams[lo:hi - width + 1]))
        elif hi > lo:
            few = (words[lo:hi] * _STEP[:hi - lo]).sum(dtype=np.uint64)
            out.append(mix(np.array([few], np.uint64) + _STEP[40 + hi - lo]))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def shingle_sets(texts: list[str | None], width: int = 5) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text (null: none)."""
    out: list[np.ndarray] = []
    for group in batches([len(t or "") + 1 for t in texts], _SLICE):
        own = [(t or "").encode("utf-8", "replace").translate(_FOLD) for t in texts[group]]
        out += _sets(np.frombuffer(b" ".join(own) + b" ", np.uint8), np.cumsum([0, *(len(d) + 1 for d in own)]), width)
    return out


def column_sets(texts: pa.Array, width: int = 5):
    """Yields lists of the sets of consecutive texts of an Arrow column."""
    fold = np.frombuffer(_FOLD, np.uint8)
    for _, offsets, data in text_slices(texts, _SLICE):
        data, starts = joined(offsets, fold[data], 32)
        yield _sets(data[:starts[-1]], starts, width)
