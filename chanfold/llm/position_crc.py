"""CRC-32 of many spans of bytes at once, by a position table.

The register of a CRC is linear: what a byte adds to it depends only on the byte
and on its distance from the end of the span.  ``_TABLE`` holds these
contributions, so the register of a span is the XOR of one look-up per byte
(``bitwise_xor.reduceat`` over the spans), and the initial value adds a constant
of the span's length.  A span longer than the table is folded blockwise: the
registers of its blocks are joined two by two, each time moving the left one on
by the bytes of the right one.
"""

from __future__ import annotations

import zlib

import numpy as np

#: Distances from the end that the table holds; also the size of a block.
SPAN = 64
#: Bytes looked up at a time; bounds memory.
_PART = 1 << 20


def _byte_table() -> np.ndarray:
    r = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        r = np.where(r & np.uint32(1), (r >> np.uint32(1)) ^ np.uint32(0xEDB88320), r >> np.uint32(1))
    return r


_BYTE = _byte_table()


def _zero_byte(r: np.ndarray) -> np.ndarray:
    """Registers after one more zero byte."""
    return (r >> np.uint32(8)) ^ _BYTE[r & np.uint32(255)]


def _position_table() -> np.ndarray:
    """Row d + 1: contributions at distance d; row 0: none."""
    rows = [np.zeros(256, np.uint32), _BYTE]
    for _ in range(SPAN - 1):
        rows.append(_zero_byte(rows[-1]))
    return np.concatenate(rows)


_TABLE = _position_table()
#: CRC of as many zero bytes: the constant of each length.
_LENGTHS = np.array([zlib.crc32(bytes(n)) for n in range(SPAN + 1)], np.uint32)


def _moved(tables: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Registers moved on by the zero bytes that ``tables`` stands for."""
    out = tables[0][r & np.uint32(255)]
    for k in (1, 2, 3):
        out = out ^ tables[k][(r >> np.uint32(8 * k)) & np.uint32(255)]
    return out


def _block_move() -> np.ndarray:
    tables = np.arange(256, dtype=np.uint32)[None] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for _ in range(SPAN):
        tables = _zero_byte(tables)
    return tables


_BLOCK_MOVE = _block_move()


def _long(data: np.ndarray) -> int:
    """CRC-32 of one span, block by block."""
    blocks = -(-len(data) // SPAN)
    size = 1 << (blocks - 1).bit_length()
    row = np.tile(np.arange(SPAN, 0, -1), blocks)[blocks * SPAN - len(data):]
    edges = np.concatenate([[0], np.arange(len(data) - (blocks - 1) * SPAN, len(data), SPAN)])
    own = np.bitwise_xor.reduceat(_TABLE[row * 256 + data], edges)
    r = np.concatenate([np.zeros(size - blocks, np.uint32), own])       # leading zeros add nothing
    move = _BLOCK_MOVE
    while len(r) > 1:
        r = _moved(move, r[::2]) ^ r[1::2]
        move = _moved(move, move)
    return int(r[0]) ^ zlib.crc32(bytes(len(data)))


def span_crcs(data: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Unsigned CRC-32 of spans that follow one another with at least one byte
    between them, in ascending order."""
    if len(starts) and starts[-1] + lens[-1] - starts[0] > _PART and len(starts) > 1:
        cuts = np.searchsorted(starts, np.arange(int(starts[0]), int(starts[-1]) + 1, _PART))
        cuts = np.unique(np.append(cuts, len(starts)))
        return np.concatenate([_crcs(data, starts[a:b], lens[a:b]) for a, b in zip(cuts[:-1], cuts[1:])])
    return _crcs(data, starts, lens)


def _crcs(data: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    if not len(starts):
        return np.zeros(0, np.uint32)
    lo, hi = int(starts[0]), int(starts[-1] + lens[-1])
    gaps = np.append(starts[1:], hi) - starts                           # a span and the bytes after it
    row = np.repeat((starts + lens - lo).astype(np.int32), gaps) - np.arange(hi - lo, dtype=np.int32)
    row[(row < 0) | (row > SPAN)] = 0
    out = np.bitwise_xor.reduceat(_TABLE[row * 256 + data[lo:hi]], starts - lo)
    out ^= _LENGTHS[np.minimum(lens, SPAN)]
    for i in np.flatnonzero(lens > SPAN).tolist():
        out[i] = _long(data[starts[i]:starts[i] + lens[i]])
    return out
