"""Hashes of words, shingles and shingle sets, many texts at a time in numpy."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_U = np.uint64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_GAP = re.compile(rb"[\x20\x09-\x0D]")
#: Bytes that are hashed at once; a cut lies between words.
BLOCK = 2_000_000
_BASE = 0x9E3779B97F4A7C15 | 1
_BYTES = np.random.Generator(np.random.PCG64(20240229)).integers(0, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Powers:
    """Powers of the base and of its inverse, as many as a block has needed."""

    up = down = np.ones(1, dtype=np.uint64)

    @classmethod
    def upto(cls, n: int) -> None:
        if len(cls.up) < n:
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                powers = np.full(max(n, BLOCK + 65536), base, dtype=np.uint64)
                powers[0] = 1
                setattr(cls, name, np.multiply.accumulate(powers))


def _block_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word of a block of bytes."""
    data = np.frombuffer(raw, dtype=np.uint8)
    space = _SPACE[data]
    edge = np.diff(np.concatenate(([True], space, [True])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    _Powers.upto(len(data))
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTES[data] * _Powers.up[: len(data)], out=total[1:])
    return starts, mix((total[ends] - total[starts]) * _Powers.down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(texts: list[bytes], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in order, and the place of each text's first word (one more place at the end)."""
    joined = b"\n".join(texts) + b"\n"
    if lower:
        joined = joined.lower()  # on bytes: A-Z only
    begins = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts]))).astype(np.int64)
    starts, hashes, at = [], [], 0
    while at < len(joined):
        cut = _GAP.search(joined, min(at + BLOCK, len(joined) - 1)).end()
        s, h = _block_hashes(joined[at:cut])
        starts.append(s + at)
        hashes.append(h)
        at = cut
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), begins)


def shingle_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """Each text's sorted distinct shingle hashes (63 bits, int64); a text of fewer words is one shingle, of none is empty."""
    hashes, firsts = word_hashes(texts)
    n = len(hashes)
    rolled = np.zeros(max(0, n - words + 1), dtype=np.uint64)
    for k in range(words):
        rolled = mix(rolled * _U(0xD6E8FEB86659FD93) + hashes[k : n - words + 1 + k])
    out = []
    for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist()):
        if b - a >= words:
            own = rolled[a : b - words + 1]
        elif b > a:
            own = np.zeros(1, dtype=np.uint64)
            for h in hashes[a:b]:
                own = mix(own * _U(0xD6E8FEB86659FD93) + h)
            own = mix(own + _U(b - a))
        else:
            own = rolled[:0]
        out.append(np.unique((own >> _U(1)).astype(np.int64)))
    return out


def set_prints(own: np.ndarray) -> tuple[int, int]:
    """Two independent fingerprints of a set of hashes, as signed 64-bit numbers."""
    u = own.astype(np.uint64)
    a = mix(np.sum(mix(u + _U(0x1234567)), dtype=np.uint64, keepdims=True) + _U(len(own)))
    b = mix(np.bitwise_xor.reduce(mix(u ^ _U(0x5DEECE66D1234567)), keepdims=True) + _U(len(own)))
    return int(a.astype(np.int64)[0]), int(b.astype(np.int64)[0])


def utf8_slices(column: pa.Array, limit: int = BLOCK) -> Iterator[tuple[int, int, list[bytes]]]:
    """Ranges of a column of strings of about `limit` bytes in sum, with their UTF-8 (null: empty)."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(sizes, (int(sizes[lo - 1]) if lo else 0) + limit)))
        yield lo, hi, pc.fill_null(column.slice(lo, hi - lo).cast(pa.binary()), b"").to_pylist()
        lo = hi


def slices(texts: list, limit: int = BLOCK):
    """Ranges of texts of about `limit` bytes in sum."""
    lo = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= limit:
            yield lo, i + 1
            lo, size = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)
