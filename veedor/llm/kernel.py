"""Vectorised text kernels for operators that stream documents through Arrow batches.

Words are maximal runs of other than ASCII white space, found on the UTF-8 bytes of many documents
at once. A word's hash is a polynomial over random values of its bytes, modulo 2^64, then mixed; it
comes from two prefix sums, so no word is ever cut out as an object.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are handled as one block; a longer document is a block of its own.
BLOCK_BYTES = 1 << 18

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLDED = _BYTE.copy()
_FOLDED[65:91] = _BYTE[97:123]  # A-Z as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: ASCII bytes that are neither letters nor digits.
SIGNS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse, modulo 2^64."""
    have = _powers.get(0)
    if have is None or len(have[0]) < n:
        size = max(n, BLOCK_BYTES + 4096)
        up, down = np.full(size, _BASE), np.full(size, _INVERSE)
        up[0] = down[0] = 1
        have = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
        if n <= BLOCK_BYTES + 4096:
            _powers[0] = have
    return have[0][:n], have[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of each 64-bit value over all bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


@dataclass
class Words:
    """The words of a block of documents; document i has words ``first[i]:first[i + 1]``."""

    rows: range
    data: np.ndarray
    first: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray


def blocks(texts: pa.Array) -> Iterator[tuple[range, np.ndarray, np.ndarray]]:
    """Cut a column into blocks: row range, their bytes, and the rows' offsets in these."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(at, at[i] + BLOCK_BYTES, side="right")) - 1)
        yield range(i, j), raw[at[i] : at[j]], at[i : j + 1] - at[i]
        i = j


def span_hasher(data: np.ndarray, fold: bool = False) -> Callable[..., np.ndarray]:
    """A function that hashes any spans ``starts, ends`` of ``data``; ``salt`` sets kinds of spans apart."""
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_FOLDED if fold else _BYTE)[data] * up[:-1], out=sums[1:])
    return lambda starts, ends, salt=0: mix((sums[ends] - sums[starts]) * down[starts] + np.uint64(salt))


def split_words(texts: pa.Array, fold: bool = False, parts: np.ndarray | None = None) -> Iterator[Words]:
    """The words of every document, block by block; ``fold`` hashes A-Z as a-z.

    ``parts`` marks the byte values that part words, instead of white space.
    """
    parts = _SPACE if parts is None else parts
    for rows, data, at in blocks(texts):
        solid = ~parts[data]
        begin, end = solid.copy(), solid.copy()
        begin[1:] &= ~solid[:-1]
        end[:-1] &= ~solid[1:]
        edges = np.unique(at)
        inner = edges[edges < len(data)]
        begin[inner] |= solid[inner]
        inner = edges[edges > 0] - 1
        end[inner] |= solid[inner]
        starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
        yield Words(rows, data, np.searchsorted(starts, at), starts, ends, span_hasher(data, fold)(starts, ends))


_PLACE = _rng.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def ngrams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(hashes) - n + 1, np.uint64)
    for j in range(n):
        total += hashes[j : len(hashes) - n + 1 + j] * _PLACE[j]
    return mix(total)


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words, by prefix sums: for long runs."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    up, down = powers(len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up[:-1], out=sums[1:])
    return mix((sums[n:] - sums[:-n]) * down[: len(hashes) - n + 1])


def shingle_set(hashes: np.ndarray, n: int = 5) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``n`` words; of fewer words, the whole sequence's."""
    if 0 < len(hashes) < n:
        return mix((hashes * _PLACE[: len(hashes)]).sum(dtype=np.uint64, keepdims=True) + _PLACE[32 + len(hashes)])
    return np.unique(ngrams(hashes, n))
