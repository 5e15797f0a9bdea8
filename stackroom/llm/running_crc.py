"""Checksums of any run of words from one scan over a text.

The scan keeps the register of CRC-32 before and after every word.  Registers are linear over GF(2):
with A the bytes up to a run B, register(AB) is register(A) moved on by as many zero bytes as B is long,
xor what B adds.  Moving register(A) on and xoring it away leaves the checksum of B, so runs of any
number of words cost a few look-ups each and no second look at their bytes.

A scan goes through its buffer in columns: the buffer is cut into chunks of ``_CHUNK`` bytes, all chunks
are scanned side by side from a zero register, and a chunk's true starting register is then moved on to
the places asked for and added.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

POLYNOMIAL = 0xEDB88320  # CRC-32 of zlib, bits reversed
ALL = np.uint32(0xFFFFFFFF)
_CHUNK = 255


@lru_cache(maxsize=1)
def byte_table() -> np.ndarray:
    """What one byte adds to the register, and how the register's low byte moves on."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, np.uint32(POLYNOMIAL) ^ (table >> 1), table >> 1)
    return table.astype(np.uint32)


def _applied(tables: np.ndarray, registers: np.ndarray) -> np.ndarray:
    """A linear map, given by its values on each of the four bytes, on registers."""
    out = tables[0][registers & 0xFF]
    for k in (1, 2, 3):
        out = out ^ tables[k][(registers >> np.uint32(8 * k)) & 0xFF]
    return out


@lru_cache(maxsize=8)
def zero_bytes(digit: int) -> np.ndarray:
    """[m, k, b]: byte k of value b moved on by m * 256**digit zero bytes, m from 0 to 255."""
    first = np.empty((256, 4, 256), np.uint32)
    for k in range(4):
        first[0, k] = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
    if digit == 0:
        step = byte_table()
        for m in range(1, 256):
            first[m] = step[first[m - 1] & 0xFF] ^ (first[m - 1] >> 8)
        return first
    below = zero_bytes(digit - 1)
    unit = _applied(below[1], below[255])  # 255 steps of the digit below, and one more
    for m in range(1, 256):
        first[m] = _applied(unit, first[m - 1])
    return first


def moved_on(registers: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Registers after as many zero bytes as ``lengths`` says."""
    out, digit = registers.astype(np.uint32), 0
    rest = lengths
    while rest.size and rest.max() > 0:
        tables, row = zero_bytes(digit).reshape(-1), (rest & 0xFF) * 1024
        moved = tables.take(row + (out & 0xFF))
        for k in (1, 2, 3):
            moved ^= tables.take(row + (256 * k + ((out >> np.uint32(8 * k)) & 0xFF)))
        out, rest, digit = moved, rest >> 8, digit + 1
    return out


def scan(buffer: np.ndarray, places: np.ndarray, register: int) -> tuple[np.ndarray, int]:
    """Registers after each number of bytes in ``places``, and after the whole buffer.

    ``places`` rises; ``register`` is the one the buffer begins with.
    """
    chunks = -(-len(buffer) // _CHUNK)
    if not chunks:
        return np.full(len(places), register, np.uint32), register
    padded = np.zeros(chunks * _CHUNK, np.uint8)
    padded[: len(buffer)] = buffer
    columns = np.ascontiguousarray(padded.reshape(chunks, _CHUNK).T)
    table = byte_table()
    after = np.zeros((_CHUNK + 1, chunks), np.uint32)
    state = after[0]
    for i in range(_CHUNK):
        state = table.take((state ^ columns[i]) & 0xFF) ^ (state >> np.uint32(8))
        after[i + 1] = state
    # Each chunk's true starting register, from that of the chunk before.
    t = [row.tolist() for row in zero_bytes(0)[_CHUNK]]
    t0, t1, t2, t3 = t
    starts, at = [], int(register)
    for own in after[_CHUNK].tolist():
        starts.append(at)
        at = own ^ t0[at & 255] ^ t1[at >> 8 & 255] ^ t2[at >> 16 & 255] ^ t3[at >> 24]
    starts.append(at)
    starts = np.array(starts, np.uint32)
    ends = np.r_[places, len(buffer)]
    chunk, inside = np.divmod(ends, _CHUNK)
    own = np.where(chunk < chunks, after[inside, np.minimum(chunk, chunks - 1)], 0).astype(np.uint32)
    found = own ^ moved_on(starts[chunk], inside)
    return found[:-1], int(found[-1])


def one_byte(registers: np.ndarray, byte: int) -> np.ndarray:
    """Registers after one more byte."""
    return byte_table()[(registers ^ np.uint32(byte)) & 0xFF] ^ (registers >> np.uint32(8))


def run_checksums(
    before: np.ndarray, after: np.ndarray, begins: np.ndarray, ends: np.ndarray
) -> np.ndarray:
    """CRC-32 of runs that begin and end at given places, from the registers there."""
    return after ^ moved_on(before ^ ALL, ends - begins) ^ ALL
