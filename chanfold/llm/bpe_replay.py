"""Byte-level BPE by corpus-level merge replay.

The distinct words of a block of texts are laid out as one array of byte
tokens linked to their neighbours.  An inverted index leads from the rank of a
token pair to the positions where that pair stands.  Ranks are taken in
ascending order; each merge is applied at all its positions at once, and only
the pairs on either side of a merged position are looked up anew and put into
the index.

Blocks are independent, so Spark deals the documents out and every task
replays the merges over its own words.  Two cases are kept exact beside the
sweep: a word that is a token as a whole takes that token, and a word in which
a merge brings up a pair of lower rank than its own is merged again by itself,
lowest rank first.
"""

from __future__ import annotations

import base64
import hashlib
import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chanfold.llm.common import csr_gather, python_tasks, release
from chanfold.llm.tokens import PieceEncoder, documents_ids

_NONE = np.iinfo(np.int32).max
#: Bytes of texts whose new words are replayed together; bounds memory.
GROUP_BYTES = 8 << 20


class MergeTable:
    """Ranks of a rank file: ``rank_of(left, right)`` for arrays of ids."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.size = max(ranks.values()) + 1
        keys, values = [], []
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    keys.append(left * self.size + right)
                    values.append(rank)
        order = np.argsort(np.array(keys, np.int64), kind="stable")
        self.keys = np.append(np.array(keys, np.int64)[order], np.iinfo(np.int64).max)
        self.values = np.append(np.array(values, np.int32)[order], _NONE)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        by_id = [b""] * self.size
        for token, rank in ranks.items():
            by_id[rank] = token
        self.token_ends = np.concatenate([[0], np.cumsum([len(t) for t in by_id])]).astype(np.int64)
        self.token_bytes = np.frombuffer(b"".join(by_id), np.uint8)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) * self.size + right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.values[at], _NONE)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        return csr_gather(self.token_ends, self.token_bytes, ids.astype(np.int64))[0]


def load_ranks(path: str) -> MergeTable:
    with open(path, "rb") as f:
        return MergeTable({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})


def merge_one(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """One word, lowest rank first, leftmost among equals."""
    parts = [word[i:i + 1] for i in range(len(word))]
    while len(parts) > 1:
        best = min(range(len(parts) - 1),
                   key=lambda i: (ranks.get(parts[i] + parts[i + 1], _NONE), i))
        if parts[best] + parts[best + 1] not in ranks:
            break
        parts[best:best + 2] = [parts[best] + parts[best + 1]]
    return [ranks[p] for p in parts]


def _alternate(pos: np.ndarray, nxt: np.ndarray) -> np.ndarray:
    """Of ascending positions of a pair, those that merge when runs of
    overlapping pairs (``aaa``) are taken from the left."""
    clash = nxt[pos[:-1]] == pos[1:]
    if not clash.any():
        return pos
    at = np.arange(len(pos))
    first = np.maximum.accumulate(np.where(np.concatenate([[True], ~clash]), at, 0))
    return pos[(at - first) % 2 == 0]


def replay(words: list[bytes], table: MergeTable):
    """ids of all words, concatenated, and the number of ids of each."""
    sizes = np.array([len(w) for w in words], np.int64)
    ends = np.cumsum(sizes)
    n = int(ends[-1]) if len(words) else 0
    if not n:
        return np.zeros(0, np.uint32), sizes
    tok = table.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
    word_of = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
    nxt, prv = np.arange(1, n + 1), np.arange(-1, n - 1)
    full = sizes > 0
    nxt[ends[full] - 1] = -1
    prv[(ends - sizes)[full]] = -1
    rank = np.full(n, _NONE, np.int32)
    has = np.flatnonzero(nxt >= 0)
    rank[has] = table.rank_of(tok[has], tok[has + 1])
    alive = np.ones(n, bool)
    index: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []

    def put(pos: np.ndarray) -> None:
        r = rank[pos]
        order = np.argsort(r, kind="stable")
        pos, r = pos[order], r[order]
        cuts = np.flatnonzero(r[1:] != r[:-1]) + 1
        for some, first in zip(np.split(pos, cuts), r[np.concatenate([[0], cuts])].tolist()):
            if first in index:
                index[first].append(some)
            else:
                index[first] = [some]
                heapq.heappush(heap, first)

    has = np.flatnonzero(rank < _NONE)
    if len(has):
        put(has)
    again: list[np.ndarray] = []
    while heap:
        now = heapq.heappop(heap)
        found = index.pop(now)
        pos = found[0] if len(found) == 1 else np.unique(np.concatenate(found))
        pos = pos[rank[pos] == now]
        if not len(pos):
            continue
        pos = _alternate(pos, nxt)
        gone = nxt[pos]
        after = nxt[gone]
        tok[pos], nxt[pos] = now, after
        rank[gone], alive[gone] = _NONE, False
        inner = after >= 0
        prv[after[inner]] = pos[inner]
        rank[pos] = _NONE
        left = prv[pos]
        left = left[left >= 0]
        rank[left] = table.rank_of(tok[left], tok[nxt[left]])
        pos, after = pos[inner], after[inner]
        rank[pos] = table.rank_of(tok[pos], tok[after])
        near = np.concatenate([left, pos])
        r = rank[near]
        near = near[r < _NONE]
        if len(near):
            low = near[rank[near] < now]
            if len(low):
                again.append(word_of[low])
            put(np.unique(near))
    lens = np.add.reduceat(np.append(alive, False).astype(np.int64), np.minimum(ends - sizes, n))
    lens[~full] = 0
    ids = tok[alive].astype(np.uint32)
    redo = {i: merge_one(words[i], table.ranks) for i in np.unique(np.concatenate(again))} if again else {}
    for i, w in enumerate(words):
        if w in table.ranks and lens[i] > 1:
            redo[i] = [table.ranks[w]]
    if redo:
        split = np.split(ids, np.cumsum(lens)[:-1])
        for i, own in redo.items():
            split[i] = np.array(own, np.uint32)
        ids, lens = np.concatenate(split), np.array([len(x) for x in split], np.int64)
    return ids, lens


_TABLES: dict[tuple, tuple] = {}                         # one merge table per file, of constant size


def replay_encoder(path: str, pattern: str) -> tuple[PieceEncoder, MergeTable]:
    """A new encoder, with no words yet, and the merge table."""
    if (path, pattern) not in _TABLES:
        _TABLES[path, pattern] = load_ranks(path), regex.compile(pattern).findall
    table, words_of = _TABLES[path, pattern]

    def encode_many(pieces: list[str]):
        found = [words_of(p) for p in pieces]
        index: dict[str, int] = {}
        picks = np.fromiter((index.setdefault(w, len(index)) for ws in found for w in ws), np.int64,
                            sum(map(len, found)))
        flat, lens = replay([w.encode("utf-8", "surrogatepass") for w in index], table)
        ids, each = csr_gather(np.concatenate([[0], np.cumsum(lens)]).astype(np.int64), flat, picks)
        ends = np.concatenate([[0], np.cumsum([len(ws) for ws in found])])
        return ids, np.diff(np.concatenate([[0], np.cumsum(each)])[ends])

    return PieceEncoder(encode_many, GROUP_BYTES), table


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens and ids (array<int>) of every whole text.

    Null text is empty and has no ids; repeated rows are encoded each; null
    ids and an empty table are allowed; other columns are ignored."""
    python_tasks(docs.sparkSession)

    def task(batches):
        encoder, _ = replay_encoder(path, pattern)
        for batch in batches:
            ids = documents_ids(encoder, batch.column("text"), None)
            for lo in range(0, batch.num_rows, 512):
                some = batch.column("doc_id").slice(lo, 512)
                own = [next(ids).astype(np.int32) for _ in range(len(some))]
                ends = np.concatenate([[0], np.cumsum([len(x) for x in own])])
                yield pa.record_batch([some, pa.array(np.diff(ends)), pa.ListArray.from_arrays(
                    pa.array(ends, pa.int32()), pa.array(np.concatenate(own)))], names=["doc_id", "n_tokens", "ids"])
        del encoder
        release()

    return _texts(docs, id_col, text_col).mapInArrow(task, "doc_id long, n_tokens long, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and data (the bytes of the ids) of rows of ``encode``."""
    python_tasks(encoded.sparkSession)

    def task(frames):
        for frame in frames:
            _, table = replay_encoder(path, pattern)
            data = [table.decode(np.asarray(x if x is not None else [], np.int64)).tobytes()
                    for x in frame["ids"]]
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "data": data})

    return encoded.select("doc_id", "ids").mapInPandas(task, "doc_id long, data binary")


def digest(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """Encodes and decodes in one task: doc_id, n_tokens, ids_sha256 (of the
    decimal ids joined by one space) and decoded_sha256 (of the bytes)."""
    python_tasks(docs.sparkSession)

    def task(batches):
        encoder, table = replay_encoder(path, pattern)
        if not hasattr(table, "decimals"):
            table.decimals = np.array([str(i) for i in range(table.size)], object)
        for batch in batches:
            rows = []
            for ids in documents_ids(encoder, batch.column("text"), None):
                decimal = " ".join(table.decimals[ids].tolist()).encode()
                rows.append((len(ids), hashlib.sha256(decimal).hexdigest(),
                             hashlib.sha256(table.decode(ids).data).hexdigest()))
            yield pa.record_batch([batch.column("doc_id"), *map(pa.array, zip(*rows))],
                                  names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        del encoder
        release()

    return _texts(docs, id_col, text_col).mapInArrow(
        task, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
