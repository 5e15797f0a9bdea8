"""Words and their hashes, for whole batches of texts inside tasks.

A word is a run of bytes other than space and 0x09-0x0D, with A-Z lower-cased.  Its hash is a
polynomial of random byte values modulo 2^64, mixed: sums over a whole buffer give those of all words in it
without a loop.  Of two different words, hashes agree with a chance of about 2^-58; sets of such hashes
are held to be equal where the texts' sets are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes handled at a time; a longer text is cut between words.
BUFFER = 1 << 20
SPACE = b" \t\n\x0b\x0c\r"
_FACTOR = 0x9E3779B97F4A7C13  # odd, 3 modulo 8
_INVERSE = pow(_FACTOR, -1, 1 << 64)


def _byte_values() -> np.ndarray:
    values = np.random.default_rng(20240229).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2)
    values += np.uint64(1)
    values[65:91] = values[97:123]
    values[list(SPACE)] = 0
    return values


_VALUES = _byte_values()
_INSIDE = _VALUES != 0
_POWERS: dict[int, np.ndarray] = {}


def _powers(factor: int, size: int) -> np.ndarray:
    have = _POWERS.get(factor)
    if have is None or len(have) < size:
        have = np.full(max(size, BUFFER + (BUFFER >> 2)), factor, np.uint64)
        have[0] = 1
        _POWERS[factor] = have = np.multiply.accumulate(have)
    return have[:size]


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finalizer of MurmurHash3)."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def _buffer_hashes(buffer: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each word of a buffer that ends in white space."""
    data = np.frombuffer(buffer, np.uint8)
    inside = _INSIDE[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edges = np.r_[0, edges]
    starts, ends = edges[0::2], edges[1::2]
    sums = np.cumsum(_VALUES[data] * _powers(_FACTOR, len(data)))
    before = np.where(starts > 0, sums[starts - 1], np.uint64(0))
    return mixed((sums[ends - 1] - before) * _powers(_INVERSE, len(data))[starts]), starts


def _lots(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """(number of the first text, texts) of up to BUFFER bytes in all."""
    held: list[bytes] = []
    size, first = 0, 0
    for i, text in enumerate(texts):
        if held and size + len(text) >= BUFFER:
            yield first, held
            held, size, first = [], 0, i
        held.append(text)
        size += len(text) + 1
    if held:
        yield first, held


def hashed_words(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and where each text's begin (one more than texts)."""
    cut, owner = [], []
    for i, text in enumerate(texts):
        rest = text or b""
        while len(rest) > BUFFER:
            # From the second byte on, as the rest begins with the white space it was cut at.
            at = max(rest.rfind(bytes([c]), 1, BUFFER) for c in SPACE)
            if at < 0:
                at = min((p for c in SPACE if (p := rest.find(bytes([c]), 1)) >= 0), default=-1)
            if at < 0:
                break
            cut.append(rest[:at])
            owner.append(i)
            rest = rest[at:]
        cut.append(rest)
        owner.append(i)
    hashes, counts = [], np.zeros(len(cut) + 1, np.int64)
    for first, lot in _lots(cut):
        found, starts = _buffer_hashes(b"\n".join(lot) + b"\n")
        hashes.append(found)
        begins = np.cumsum([0, *(len(text) + 1 for text in lot)])
        counts[first + 1 : first + 1 + len(lot)] = np.diff(np.searchsorted(starts, begins))
    per_text = np.bincount(owner, weights=counts[1:], minlength=len(texts)) if cut else []
    bounds = np.r_[0, np.cumsum(per_text)].astype(np.int64)
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), bounds


def _combined(hashes: np.ndarray, n: int) -> np.ndarray:
    last = max(0, len(hashes) - n + 1)
    out = np.full(last, n, np.uint64)
    for k in range(n):
        out *= np.uint64(0xD6E8FEB86659FD93)
        out += hashes[k : k + last]
    return mixed(out)


def shingle_sets(texts: list[bytes | None], n: int = 5) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of n words in a row; of all words if there are fewer."""
    hashes, bounds = hashed_words(texts)
    rolled = _combined(hashes, n)
    for a, b in zip(bounds.tolist(), bounds[1:].tolist(), strict=False):
        if b - a >= n:
            found = np.sort(rolled[a : b - n + 1])
            new = np.empty(len(found), bool)
            new[0] = True
            np.not_equal(found[1:], found[:-1], out=new[1:])
            yield found[new]
        else:
            yield _combined(hashes[a:b], b - a) if b > a else hashes[:0]


def utf8(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """A text column as bytes, without decoding them."""
    column = batch.column(batch.schema.get_field_index(name))
    return column.cast(pa.binary()).to_pylist()


def values(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()
