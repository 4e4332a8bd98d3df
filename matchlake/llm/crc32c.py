"""CRC-32C (Castagnoli) of many byte strings at once, with numpy.

A CRC is linear: that of a string is the exclusive or of what each 64-byte block
of it adds, moved past the blocks behind it.  Blocks are summed by a table for
each place in a block; moving past ``64 x 2^k`` bytes is four table look-ups.
"""

from __future__ import annotations

import numpy as np

POLY = 0x82F63B78       # fixed value
BLOCK, LEVELS = 64, 26  # strings up to 64 x 2^26 bytes


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """(what a byte adds from each place of a block, what four bytes of a CRC
    become past 64 x 2^k zero bytes)."""
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & 1, (one >> 1) ^ np.uint32(POLY), one >> 1).astype(np.uint32)
    step = lambda v: one[v & 0xFF] ^ (v >> np.uint32(8))  # noqa: E731  past one zero byte
    place = [one]
    for _ in range(BLOCK - 1):
        place.append(step(place[-1]))
    moved = np.arange(256, dtype=np.uint32)[None, :] << (np.uint32(8) * np.arange(4, dtype=np.uint32))[:, None]
    for _ in range(BLOCK):
        moved = step(moved)
    past = [moved]
    for _ in range(LEVELS - 1):
        past.append(_move(past[-1], past[-1]))
    return np.array(place[::-1]), np.array(past)


def _move(table: np.ndarray, v: np.ndarray) -> np.ndarray:
    return (table[0][v & 0xFF] ^ table[1][(v >> np.uint32(8)) & 0xFF]
            ^ table[2][(v >> np.uint32(16)) & 0xFF] ^ table[3][v >> np.uint32(24)])


_PLACE, _PAST = _tables()
#: The same as maps from byte to byte, one for each byte of the CRC: translating
#: bytes is much faster than looking up an array.
_MAPS = [[bytes((t >> (8 * k)).astype(np.uint8)) for k in range(4)] for t in _PLACE]


def crc32c(strings: list[bytes]) -> np.ndarray:
    """The CRC-32C of each of ``strings`` (four bytes or more each) as uint32."""
    if not strings:
        return np.zeros(0, np.uint32)
    size = np.array([len(s) for s in strings], np.int64)
    if size.min() < 4:
        raise ValueError("strings of four bytes or more")
    blocks = -(-size // BLOCK)
    ends = np.cumsum(blocks)
    # zeros in front change nothing when the CRC starts at 0; starting at all
    # ones is the same as flipping the first four bytes
    data = np.zeros(int(ends[-1]) * BLOCK, np.uint8)
    for s, end, n in zip(strings, (ends * BLOCK).tolist(), size.tolist()):
        data[end - n:end] = np.frombuffer(s, np.uint8)
        data[end - n:end - n + 4] ^= 0xFF
    columns = np.ascontiguousarray(data.reshape(-1, BLOCK).T)
    parts = np.zeros((4, len(data) // BLOCK), np.uint8)
    for maps, column in zip(_MAPS, columns):
        column = column.tobytes()
        for part, m in zip(parts, maps):
            part ^= np.frombuffer(column.translate(m), np.uint8)
    crc = np.ascontiguousarray(parts.T).view("<u4").ravel().astype(np.uint32)
    behind = np.repeat(ends, blocks) - 1 - np.arange(len(crc))
    for k in range(int(behind.max()).bit_length()):
        some = np.flatnonzero((behind >> k) & 1)
        crc[some] = _move(_PAST[k], crc[some])
    return np.bitwise_xor.reduceat(crc, ends - blocks) ^ np.uint32(0xFFFFFFFF)
