"""Words and their 64-bit hashes, vectorised over Arrow string columns.

All functions work on the UTF-8 bytes of a column: lower-casing touches
A-Z only, and a word is a maximal run of bytes of a given class inside one
row. The hash of a word depends on its bytes alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20  # rows are taken together up to this many bytes of text

# Byte classes (fixed values). SPACED: all but space and 09-0D. ALNUM: digits, letters, bytes of non-ASCII characters.
SPACED = np.ones(256, bool)
SPACED[[0x20, 9, 10, 11, 12, 13]] = False
LETTERS = np.zeros(256, bool)
LETTERS[ord("a"):ord("z") + 1] = True
LETTERS[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

_P = 0x9E3779B97F4A7C15 | 1
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_P, pow(_P, -1, 1 << 64))):
            x = np.full(n, base, np.uint64)
            x[0] = 1
            _POWERS[k] = np.cumprod(x, dtype=np.uint64)
    return _POWERS


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chunks(col: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, lower-cased bytes, row offsets in them) for runs of rows of about ``limit`` bytes.

    A null is an empty text. A text longer than ``limit`` is a run of its own.
    """
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not len(col):
        return
    col = col.cast(pa.large_binary())
    offs = np.frombuffer(col.buffers()[1], np.int64, len(col) + 1, col.offset * 8)
    data = col.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    size = np.diff(offs)
    if col.null_count:
        size = np.where(col.is_null().to_numpy(zero_copy_only=False), 0, size)
    row = 0
    while row < len(col):
        end = max(row + 1, int(np.searchsorted(offs, offs[row] + limit, "right")) - 1)
        end = min(end, len(col))
        own = np.concatenate([[0], np.cumsum(size[row:end])])
        if own[-1] == offs[end] - offs[row]:
            buf = data[offs[row]:offs[end]]
        else:  # bytes kept under nulls
            buf = np.concatenate([data[offs[i]:offs[i] + size[i]] for i in range(row, end)])
        yield row, LOWER[buf], own
        row = end


def spans(buf: np.ndarray, offs: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and for each row the index of its first word (with one closing entry)."""
    inside = np.zeros(len(buf) + 2, bool)
    inside[1:-1] = kind[buf]
    first = np.zeros(len(buf) + 1, bool)  # a row starts here
    first[offs[:-1]] = True
    here, before = inside[1:-1], inside[:-2]
    starts = np.flatnonzero(here & (~before | first[:-1]))
    after = inside[2:] & ~first[1:]
    ends = np.flatnonzero(here & ~after) + 1
    return starts, ends, np.searchsorted(starts, offs)


def hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of buf[s:e] for each span."""
    up, down = _powers(len(buf) + 1)
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * up[:len(buf)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts])


def list_array(parts: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    offs = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offs), pa.array(flat, kind))
