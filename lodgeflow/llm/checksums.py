"""CRC-32C of many byte ranges at once (numpy).

A checksum is linear over bits, so a range is cut into blocks of ``BLOCK`` bytes whose
checksums are looked up byte by byte for all blocks together; a block that stands j
blocks from the end of its range is then moved on by j * ``BLOCK`` zero bytes, one
doubling per bit of j, and the blocks of a range are combined by exclusive or.
"""

from __future__ import annotations

import numpy as np

BLOCK = 64
#: Blocks looked up at a time (they stay in the cache).
ROWS = 4096
_POLYNOMIAL = np.uint32(0x82F63B78)  # Castagnoli, bits reversed


def _table() -> np.ndarray:
    """Checksum of every single byte (without the usual first and last inversion)."""
    crc = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        crc = (crc >> np.uint32(1)) ^ (crc & np.uint32(1)) * _POLYNOMIAL
    return crc


_ONE = _table()


def _next_byte(crc: np.ndarray) -> np.ndarray:
    """The checksum after one more zero byte."""
    return _ONE[crc & np.uint32(0xFF)] ^ (crc >> np.uint32(8))


def _moved(crc: np.ndarray, by: np.ndarray) -> np.ndarray:
    """The checksum after the zero bytes that table ``by`` stands for."""
    out = by[0][crc & np.uint32(0xFF)]
    for i in range(1, 4):
        out = out ^ by[i][(crc >> np.uint32(8 * i)) & np.uint32(0xFF)]
    return out


def _moves() -> np.ndarray:
    """[b][i][v]: the checksum v << 8 i after BLOCK * 2 ** b zero bytes."""
    step = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * i) for i in range(4)])
    for _ in range(BLOCK):
        step = _next_byte(step)
    steps = [step]
    for _ in range(31):
        steps.append(_moved(steps[-1], steps[-1]))
    return np.stack(steps)


def _places() -> np.ndarray:
    """[k][v]: checksum of byte v at place k of a block."""
    tables = [_ONE]
    for _ in range(BLOCK - 1):
        tables.append(_next_byte(tables[-1]))
    return np.stack(tables[::-1])


_MOVES, _PLACES = _moves(), _places()


def crc32c(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32C of data[start:start + length] for each range of at least 4 bytes."""
    if not len(starts):
        return np.empty(0, np.uint32)
    blocks = -(-lengths // BLOCK)
    ends = np.cumsum(blocks)
    rows = np.zeros(int(ends[-1]) * BLOCK, np.uint8)
    first = ends * BLOCK - lengths  # ranges end with their last block
    for to, start, length in zip(first.tolist(), starts.tolist(), lengths.tolist()):
        rows[to:to + length] = data[start:start + length]
    rows[(first[:, None] + np.arange(4)).ravel()] ^= np.uint8(0xFF)
    rows = rows.reshape(-1, BLOCK)
    crc = np.zeros(len(rows), np.uint32)
    for at in range(0, len(rows), ROWS):
        part = rows[at:at + ROWS]
        own = crc[at:at + ROWS]
        for k in range(BLOCK):
            own ^= _PLACES[k][part[:, k]]
    behind = np.repeat(ends, blocks) - 1 - np.arange(len(rows))  # blocks of the range that follow
    for b in range(int(behind.max()).bit_length()):
        some = np.flatnonzero((behind >> b) & 1)
        crc[some] = _moved(crc[some], _MOVES[b])
    return np.bitwise_xor.reduceat(crc, ends - blocks) ^ np.uint32(0xFFFFFFFF)


def masked(crc: np.ndarray) -> np.ndarray:
    """Rotated and shifted, so that a checksum stored in its own data does not hide faults."""
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(0xA282EAD8)
