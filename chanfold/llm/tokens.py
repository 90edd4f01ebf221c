"""Tokenizing of whole texts inside Spark tasks.

The tokenizers used here first split a text into words by the same rules: a
run of letters, digits or other characters, each with at most one leading
space, and runs of white space.  No word crosses the start of a run of white
space, a line feed between two other characters, or the place where
punctuation follows a letter.  So the ids of a text are the ids of the pieces
between such cuts, one after another.

Texts stay arrays of bytes: cuts are found for many texts at once, every piece
is looked up by its bytes in a table (``spans.Dictionary``), and only pieces that
are new to the table are encoded by the library.  The ids of all texts are then
one array gather.  A table lives as long as its task, in bounded memory; one
of ``shared_encoder`` goes on to the next task of the run in its Python worker.
"""

from __future__ import annotations

import os
from contextlib import contextmanager
from itertools import chain

import numpy as np
import pyarrow as pa

from chanfold.llm.common import csr_gather
from chanfold.llm.spans import Dictionary, Grown, distinct, hashes, joined, runs, text_slices

#: Bytes of a table, of the longest piece that is kept, and of texts cut at a
#: time; pieces encoded at a time.  They bound memory, not results.
TABLE_BYTES, MAX_PIECE_BYTES, GROUP_BYTES, ENCODE_PIECES = 64 << 20, 64, 2 << 20, 1 << 18

_SPACE, _OTHER, _LETTER, _TAIL, _SOLID = 1, 2, 4, 8, 16
_MARK = 0xFF                                             # no byte of UTF-8
_KIND = np.array([(_SPACE if b in b" \n" else 0) | (_OTHER if b in b"\t\r\x0b\x0c\x1c\x1d\x1e\x1f" else 0)
                  | (_LETTER if b < 128 and chr(b).isalpha() else 0) | (_TAIL if b in b",.!?;:|$#%&*" else 0)
                  | (_SOLID if 33 <= b < 127 else 0) for b in range(256)], np.uint8)
#: First bytes of the white space beyond ASCII (and of other characters).
_WIDE = np.zeros(256, bool)
_WIDE[[0xC2, 0xE1, 0xE2, 0xE3]] = True


def pieces(data: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the pieces of texts (``spans.joined`` with two
    marks ahead).  Where a byte may belong to white space beyond ASCII there is
    no cut."""
    end = int(texts[-1])
    kind = _KIND[data[:end]]
    bound = np.zeros(end + 1, bool)
    bound[0] = True
    bound[texts] = True
    bound[texts[1:] - 1] = True
    at = np.flatnonzero(kind & _SPACE)
    last, before = data[at - 1], data[at - 2]
    blank = (kind[at - 1] & (_SPACE | _OTHER)) > 0
    blank |= (before == 0xC2) & ((last == 0x85) | (last == 0xA0))
    blank |= ((before == 0x9A) | (before == 0x80) | (before == 0x81)) & (last >= 0x80) & (last < 0xB0)
    at = at[~blank]
    bound[at] = True
    line = at[data[at] == 10]
    bound[line[((kind[line + 1] & (_SPACE | _OTHER)) == 0) & ~_WIDE[data[line + 1]]] + 1] = True
    at, lens = runs((kind & _TAIL) > 0)
    last, before = data[at - 1], data[at - 2]
    letter = (kind[at - 1] & _LETTER) > 0
    letter |= ((before >= 0xC3) & (before <= 0xC5) & (last >= 0x80) & (last < 0xC0)
               & ~((before == 0xC3) & ((last == 0x97) | (last == 0xB7))))
    bound[at[letter & bound[at + lens]]] = True
    starts = np.flatnonzero(bound[:end])
    lens = np.diff(np.append(starts, end))
    real = data[starts] != _MARK
    return starts[real], lens[real]


def segments(data: np.ndarray, most: int):
    """A long text in parts of about ``most`` bytes, cut where pieces are cut."""
    lo = 0
    while lo < len(data):
        hi = lo
        while hi < len(data):
            size = max(most, 2 * (hi - lo))
            hi = min(lo + size, len(data))
            if hi == len(data):
                break
            cuts = np.flatnonzero((data[lo + 1:hi] == 32) & ((_KIND[data[lo:hi - 1]] & _SOLID) > 0))
            if len(cuts):
                hi = lo + 1 + int(cuts[-1])
                break
        yield data[lo:hi]
        lo = hi


class PieceEncoder:
    """ids of texts from ``encode_many(pieces) -> (flat ids, lengths)``."""

    def __init__(self, encode_many, group_bytes: int | None = None):
        self.encode_many = encode_many
        self.group_bytes = group_bytes or GROUP_BYTES
        self._start(Dictionary(), np.zeros(0, np.uint32), np.zeros(0, np.int64))

    def _start(self, book: Dictionary, ids: np.ndarray, lens: np.ndarray) -> None:
        self.book, self.ids = book, Grown(np.uint32, ids)
        self.ends = Grown(np.int64, np.concatenate([[0], np.cumsum(lens)]))
        self.uses = np.ones(len(book), np.int64)

    def _forget(self) -> None:
        """Keep what was asked for more than once."""
        keep = np.flatnonzero(self.uses > 1)
        if 2 * len(keep) > len(self.book):
            keep = keep[:0]
        old, book = self.book, Dictionary()
        book.add(old.bytes.all, old.starts.all[keep], old.lens.all[keep], old.keys.all[keep])
        self._start(book, *csr_gather(self.ends.all, self.ids.all, keep))

    def encode(self, texts: pa.Array):
        """Yields for groups of consecutive texts: the ids of all, and the
        number of ids of each."""
        for _, offsets, data in text_slices(texts, self.group_bytes):
            if len(offsets) == 2 and len(data) > 2 * self.group_bytes:
                own = [self._encode(np.array([0, len(part)]), part)[0] for part in segments(data, self.group_bytes)]
                yield np.concatenate(own), np.array([sum(map(len, own))])
            else:
                yield self._encode(offsets, data)

    def _encode(self, offsets: np.ndarray, data: np.ndarray):
        data, texts = joined(offsets, data, _MARK, 2)
        starts, lens = pieces(data, texts)
        keys = hashes(data, starts, lens)
        picks = self.book.find(data, starts, lens, keys)
        new = np.flatnonzero(picks < 0)
        if len(new):
            picks[new] = self._learn(data, starts[new], lens[new], keys[new])
        ids, sizes = csr_gather(self.ends.all, self.ids.all, picks)
        upto = np.concatenate([[0], np.cumsum(sizes)])
        out = ids, np.diff(upto[np.searchsorted(starts, texts)])
        kept = len(self.book)                            # longer pieces are not kept
        self.ends.n, self.ids.n = kept + 1, int(self.ends.room[kept])
        used = np.bincount(picks[picks < kept], minlength=kept)
        used[:len(self.uses)] += self.uses
        self.uses = used
        if self.book.size + 4 * self.ids.n + 16 * kept > TABLE_BYTES:
            self._forget()
        return out

    def _learn(self, data: np.ndarray, starts: np.ndarray, lens: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Numbers of pieces that are not in the table; long ones get the last."""
        same = distinct(data, starts, lens, keys)
        first = np.flatnonzero(same == np.arange(len(same)))
        long = lens[first] > MAX_PIECE_BYTES
        first = first[np.argsort(long, kind="stable")]
        number = np.empty(len(same), np.int64)
        number[first] = len(self.book) + np.arange(len(first))
        whole = data.tobytes()
        names = [whole[a:b].decode("utf-8") for a, b in zip(starts[first].tolist(), (starts + lens)[first].tolist())]
        for lo in range(0, len(names), ENCODE_PIECES):
            ids, sizes = self.encode_many(names[lo:lo + ENCODE_PIECES])
            self.ids.add(np.asarray(ids, np.uint32))
            self.ends.add(self.ends.all[-1] + np.cumsum(sizes))
        short = first[:len(first) - int(long.sum())]
        self.book.add(data, starts[short], lens[short], keys[short])
        return number[same]


def is_plain(piece: str) -> bool:
    """One run of characters other than white space and zero bytes, after one
    space at most."""
    words = piece.split()
    return (len(words) == 1 and len(piece) - len(words[0]) == (piece[0] == " ")
            and "\0" not in piece)


_LIBRARY: dict[str, object] = {}                         # one tokenizer per file, of constant size
_SHARED: dict[tuple[str, str], PieceEncoder] = {}        # at most one, of the latest run


def library_encoder(path: str) -> PieceEncoder:
    """A new encoder of a ``tokenizers`` file, with an empty table; strings of
    special tokens inside a text are ordinary text."""
    if path not in _LIBRARY:
        _LIBRARY[path] = _library(path)
    return PieceEncoder(_LIBRARY[path])


@contextmanager
def shared_encoder(path: str, run: str):
    """The encoder of a task of ``run`` (a name of its own for each run), with
    the table that the run's last task in this Python worker left, so that
    pieces are new to a worker and not to each task.  Tables of other runs are
    dropped; a task that fails or is cut short leaves none."""
    encoder = _SHARED.pop((path, run), None)
    _SHARED.clear()
    encoder = encoder or library_encoder(path)
    yield encoder
    _SHARED[path, run] = encoder


def _library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True

    def one_by_one(pieces):
        ids = [e.ids for e in tok.encode_batch_fast(pieces, add_special_tokens=False)]
        return (np.fromiter(chain.from_iterable(ids), np.uint32),
                np.fromiter(map(len, ids), np.int64, len(ids)))

    # One text of many pieces is encoded faster than many texts.  A line
    # feed (or, where white space has no ids, a zero byte) between two
    # pieces is a token of its own and occurs in none of them.
    mark = next(m for m in ("\n", " \0 ")
                if len(tok.encode(f"a{m}b", add_special_tokens=False).ids) == 3)
    mark_id = tok.encode(mark, add_special_tokens=False).ids

    def together(pieces):
        if len(mark_id) != 1 or not pieces:
            return one_by_one(pieces)
        text = mark.join(pieces) + mark
        ids = np.array(tok.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        ends = np.flatnonzero(ids == mark_id[0])
        if len(ends) != len(pieces):
            return one_by_one(pieces)
        return np.delete(ids, ends), np.diff(np.concatenate([[-1], ends])) - 1

    def encode_many(pieces):
        odd = [not is_plain(p) for p in pieces]
        order = np.argsort(odd, kind="stable")
        plain = [p for p, o in zip(pieces, odd) if not o]
        got = [together(plain[lo:lo + 8192]) for lo in range(0, len(plain), 8192)]
        strange = [p for p, o in zip(pieces, odd) if o]
        got += [one_by_one(strange[lo:lo + 1024]) for lo in range(0, len(strange), 1024)]
        flat = np.concatenate([ids for ids, _ in got])
        lens = np.concatenate([n for _, n in got])
        if not strange:
            return flat, lens
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return csr_gather(np.concatenate([[0], np.cumsum(lens)]), flat, back)

    return encode_many


def documents_ids(encoder: PieceEncoder, texts, end_id: int | None):
    """Yields one uint32 array of ids per text (null: empty) of a list or an
    Arrow array, with ``end_id`` appended."""
    tail = np.array([] if end_id is None else [end_id], np.uint32)
    column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
    for ids, lens in encoder.encode(column):
        ends = np.cumsum(lens).tolist()
        for lo, hi in zip([0, *ends], ends):
            yield np.concatenate([ids[lo:hi], tail])
