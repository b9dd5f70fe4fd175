"""Vectorised work on the bytes of many texts at once: Arrow batches cut into blocks, and hashes of any span in O(1).

A block is a run of whole texts of about max_bytes together, so memory follows the block and not the Arrow batch.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_BASE = U(0x9E3779B97F4A7C15 & ~7 | 5)
_INVERSE = U(pow(int(_BASE), -1, 1 << 64))
_BYTE = np.random.default_rng(20240229).integers(0, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
_powers = [np.ones(1, U), np.ones(1, U)]

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, _INVERSE)):
            x = np.full(max(n, 1 << 16), base)
            x[0] = 1
            _powers[i] = np.cumprod(x)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U(33))
    x *= U(0xFF51AFD7ED558CCD)
    x ^= x >> U(33)
    x *= U(0xC4CEB9FE1A85EC53)
    x ^= x >> U(33)
    return x


def prefix_sums(buf: np.ndarray) -> np.ndarray:
    """Of the bytes' values at rising powers of the base; span_hash() reads any span off them."""
    out = np.zeros(len(buf) + 1, U)
    np.cumsum(_BYTE[buf] * powers(len(buf))[0], out=out[1:])
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span; the length takes part."""
    inverse = powers(len(sums))[1]
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(U) * U(0xD6E8FEB86659FD93))


def text_blocks(batches, ids: str, text: str, max_bytes: int = 2 << 20) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) for runs of whole texts; a null text is empty."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(text)
        if column.null_count:
            column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
        wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
        offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
        data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
        i = 0
        while i < len(column):
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + max_bytes, "right")) - 1)
            yield batch.slice(i, j - i), data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            i = j


def words(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each run of bytes outside [\\x20\\x09-\\x0D]; no word crosses a text's end."""
    if not len(buf):
        return (np.zeros(0, np.int64),) * 3
    inside = ~SPACE[buf]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cuts = offsets[:-1][np.diff(offsets) > 0]
    first[cuts] = inside[cuts]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    ends = offsets[1:][np.diff(offsets) > 0] - 1
    last[ends] = inside[ends]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices start, start+1, ... of every range, one range after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - before, lengths)
