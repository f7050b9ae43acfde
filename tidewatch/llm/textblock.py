"""Vectorised text primitives over Arrow string columns.

A *block* is a run of rows whose UTF-8 bytes are viewed as one ``uint8`` array
plus row offsets.  Everything here is bounded by the block, whose size the
caller limits in bytes, so a worker's memory does not depend on the table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20

#: A-Z to a-z, all other bytes unchanged.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32

#: The bytes 0x20 and 0x09 to 0x0D, which separate words.
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_RNG = np.random.default_rng(20240601)
_BYTE_CODE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out)


_POW: list[np.ndarray] = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _POW[0].size < n:
        size = max(4096, n + n // 8)
        _POW[0], _POW[1] = _powers(_BASE, size), _powers(pow(_BASE, -1, 1 << 64), size)
    return _POW[0], _POW[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective), applied elementwise."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its n + 1 row offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def blocks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in record batches of about ``limit`` text bytes; one longer text stays whole."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, off = text_bytes(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(off, off[at] + limit, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def word_spans(data: np.ndarray, off: np.ndarray, separators: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words (maximal runs without separators, never across rows), and the n + 1 offsets of each row's words."""
    if not data.size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(off.size, np.int64)
    inside = ~separators[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edge = off[:-1][off[:-1] < data.size]
    first[edge] = inside[edge]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edge = off[1:][off[1:] > 0] - 1
    last[edge] = inside[edge]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, off)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = True) -> np.ndarray:
    """A 64-bit content hash of each span of bytes, case of A-Z ignored unless ``fold`` is false."""
    if not starts.size:
        return np.zeros(0, np.uint64)
    powers, inverse = _power_tables(data.size + 1)
    code = _BYTE_CODE[FOLD] if fold else _BYTE_CODE
    sums = np.zeros(data.size + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(code[data] * powers[: data.size], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * inverse[starts])


_GRAM = [np.uint64(int(x) | 1) for x in _RNG.integers(1, 2**63, 64, dtype=np.uint64)]


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` consecutive words, by their first word; runs across rows are the caller's to leave out."""
    n = words.size - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = words[:n] * _GRAM[0]
        for j in range(1, k):
            out += words[j : j + n] * _GRAM[j]
            out ^= out >> np.uint64(29)
        return mix(out)
