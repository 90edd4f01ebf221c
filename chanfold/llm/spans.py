"""Spans of bytes in whole texts: words, hashes and verified hash tables.

Texts stay bytes from Arrow to numpy, so no Python string is made for a word.
A span is a start and a length in one array of bytes that ends with ``PAD``
zero bytes.  Spans are found in tables by a 64-bit hash and accepted only if
their bytes are equal.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

from chanfold.llm.common import csr_gather, mix

PAD = 16
#: Spans up to this many bytes are hashed and compared eight bytes at a time.
SHORT = 64
_KEEP = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)
_LENGTH, _OWNER = np.uint64(0xD6E8FEB86659FD93), np.uint64(0x9E3779B97F4A7C15)


def text_slices(column: pa.Array, most: int):
    """(first text, offsets, bytes) of runs of consecutive texts with at most
    ``most`` bytes (a longer text is a run of its own); views, no copies.
    Null texts are empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    if not len(column):
        return
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + most, "right")) - 1)
        yield lo, ends[lo:hi + 1] - ends[lo], data[ends[lo]:ends[hi]]
        lo = hi


def joined(offsets: np.ndarray, data: np.ndarray, mark: int, before: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The texts with the byte ``mark`` after each (and ``before`` times ahead
    of all), padded; and the start of each text, with the end of all."""
    n = len(offsets) - 1
    out = np.zeros(before + len(data) + n + PAD, np.uint8)
    out[:before] = mark
    starts = before + offsets + np.arange(n + 1)
    if len(data) < 4 * n:
        at = np.arange(len(data)) + np.repeat(np.arange(n), np.diff(offsets)) + before
        out[at] = data
    else:
        for lo, hi, at in zip(offsets[:-1].tolist(), offsets[1:].tolist(), starts.tolist()):
            out[at:at + hi - lo] = data[lo:hi]
    out[starts[1:] - 1] = mark
    return out, starts


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of true values."""
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        edge = np.concatenate([[0], edge])
    if len(edge) % 2:
        edge = np.append(edge, len(inside))
    return edge[::2], edge[1::2] - edge[::2]


def _block(eight: np.ndarray, starts: np.ndarray, lens: np.ndarray, k: int) -> np.ndarray:
    """Bytes 8k to 8k+7 of each span as a number, zeros after its end."""
    return eight[starts + 8 * k] & _KEEP[np.clip(lens - 8 * k, 0, 8)]


def _eight(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, as numbers (a view)."""
    return np.ndarray(len(data) - 7, "<u8", data, strides=(1,))


def hashes(data: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    eight = _eight(data)
    out = mix(_block(eight, starts, lens, 0) + lens.astype(np.uint64) * _LENGTH)
    k, rest = 1, np.flatnonzero(lens > 8)
    while len(rest) and 8 * k < SHORT:
        out[rest] = mix(out[rest] * _OWNER + _block(eight, starts[rest], lens[rest], k))
        k += 1
        rest = rest[lens[rest] > 8 * k]
    for i in rest.tolist():
        own = data[starts[i]:starts[i] + lens[i]].tobytes()
        out[i] = int.from_bytes(hashlib.blake2b(own, digest_size=8).digest(), "little")
    return out


def same(a: np.ndarray, a_starts: np.ndarray, b: np.ndarray, b_starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Whether spans of equal lengths hold equal bytes, pair by pair."""
    one, two = _eight(a), _eight(b)
    out = _block(one, a_starts, lens, 0) == _block(two, b_starts, lens, 0)
    k, rest = 1, np.flatnonzero(out & (lens > 8))
    while len(rest) and 8 * k < SHORT:
        out[rest] = (_block(one, a_starts[rest], lens[rest], k) == _block(two, b_starts[rest], lens[rest], k))
        k += 1
        rest = rest[out[rest] & (lens[rest] > 8 * k)]
    for i in rest.tolist():
        out[i] = np.array_equal(a[a_starts[i]:a_starts[i] + lens[i]], b[b_starts[i]:b_starts[i] + lens[i]])
    return out


def distinct(data: np.ndarray, starts: np.ndarray, lens: np.ndarray, keys: np.ndarray | None = None,
             owners: np.ndarray | None = None) -> np.ndarray:
    """For each span the number of the span that stands for all equal to it
    (with ``owners``: of the same owner).

    All spans go into one open-addressing table at once.  In each round a span
    takes its slot if that is free, or else is compared, byte by byte, with the
    one that has it; those that differ go on to the next slot."""
    n = len(starts)
    keys = hashes(data, starts, lens) if keys is None else keys
    if owners is not None:
        keys = mix(keys + owners.astype(np.uint64) * _OWNER)
    size = 1 << max(4, (2 * n).bit_length())
    table = np.full(size, -1, np.int32)
    slots = (keys & np.uint64(size - 1)).astype(np.int32)
    out, todo = np.empty(n, np.int32), np.arange(n, dtype=np.int32)
    while len(todo):
        at = slots[todo]
        free = table[at] < 0
        table[at[free]] = todo[free]
        there = table[at]
        equal = (keys[there] == keys[todo]) & (lens[there] == lens[todo])
        if owners is not None:
            equal &= owners[there] == owners[todo]
        check = np.flatnonzero(equal & (there != todo))
        equal[check] = same(data, starts[there[check]], data, starts[todo[check]], lens[todo[check]])
        out[todo[equal]] = there[equal]
        todo = todo[~equal]
        slots[todo] = (slots[todo] + 1) & (size - 1)
    return out


class Grown:
    """An array that items are appended to."""

    def __init__(self, kind, first=()):
        self.room = np.array(first, kind)
        self.n = len(self.room)

    def add(self, items: np.ndarray) -> None:
        if self.n + len(items) > len(self.room):
            room = np.zeros(max(1024, (self.n + len(items)) * 5 // 4), self.room.dtype)
            room[:self.n] = self.room[:self.n]
            self.room = room
        self.room[self.n:self.n + len(items)] = items
        self.n += len(items)

    @property
    def all(self) -> np.ndarray:
        return self.room[:self.n]


class Dictionary:
    """Numbers of spans, kept with their bytes."""

    def __init__(self):
        self.slots = np.full(1 << 12, -1, np.int32)
        self.keys, self.lens, self.starts = Grown(np.uint64), Grown(np.int64), Grown(np.int64)
        self.bytes = Grown(np.uint8, np.zeros(PAD))

    def __len__(self) -> int:
        return self.keys.n

    @property
    def size(self) -> int:
        return 4 * len(self.slots) + 24 * self.keys.n + self.bytes.n

    def find(self, data: np.ndarray, starts: np.ndarray, lens: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """The number of each span, -1 if it is not here."""
        out, todo = np.full(len(starts), -1, np.int64), np.arange(len(starts))
        slots, last = (keys & np.uint64(len(self.slots) - 1)).astype(np.int64), len(self.slots) - 1
        while len(todo):
            there = self.slots[slots[todo]]
            todo, there = todo[there >= 0], there[there >= 0]
            equal = (self.keys.room[there] == keys[todo]) & (self.lens.room[there] == lens[todo])
            check = np.flatnonzero(equal)
            equal[check] = same(self.bytes.all, self.starts.room[there[check]], data, starts[todo[check]],
                                lens[todo[check]])
            out[todo[equal]] = there[equal]
            todo = todo[~equal]
            slots[todo] = (slots[todo] + 1) & last
        return out

    def add(self, data: np.ndarray, starts: np.ndarray, lens: np.ndarray, keys: np.ndarray) -> None:
        """Number spans that are not here and differ from each other."""
        first = len(self)
        ends = np.zeros(2 * len(starts), np.int64)
        ends[::2], ends[1::2] = starts, starts + lens
        flat, _ = csr_gather(ends, data, np.arange(0, len(ends), 2)) if len(starts) else (data[:0], None)
        at = self.bytes.n - PAD + np.concatenate([[0], np.cumsum(lens)])[:-1]
        self.bytes.n -= PAD
        self.bytes.add(np.concatenate([flat, np.zeros(PAD, np.uint8)]))
        self.keys.add(keys)
        self.lens.add(lens)
        self.starts.add(at)
        if 2 * len(self) > len(self.slots):
            self.slots = np.full(1 << (3 * len(self)).bit_length(), -1, np.int32)
            self._put(np.arange(len(self)))
        else:
            self._put(np.arange(first, len(self)))

    def _put(self, todo: np.ndarray) -> None:
        last = len(self.slots) - 1
        slots = (self.keys.room[todo] & np.uint64(last)).astype(np.int64)
        while len(todo):
            free = self.slots[slots] < 0
            self.slots[slots[free]] = todo[free]
            left = self.slots[slots] != todo
            todo, slots = todo[left], (slots[left] + 1) & last
