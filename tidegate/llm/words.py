"""Words, lines and shingles of Arrow text columns, as numpy arrays.

Works on the UTF-8 bytes of a whole batch at once; no Python object is made per
word. White space is the six ASCII characters of ``[\\x20\\x09-\\x0D]``.
Hashes are 64 bits wide and the same in every process.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_STEP = np.uint64(0xC2B2AE3D27D4EB4F | 1)

_NOT_SPACE = np.ones(256, dtype=bool)
_NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
PLAIN = np.arange(1, 257, dtype=np.uint64)
LOWER = PLAIN.copy()
LOWER[65:91] = LOWER[97:123]  # A-Z

#: Bytes that are hashed at a time, so that a long text costs little more than itself.
SEGMENT = 1 << 20


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that all bits count."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text column; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def pieces(batch: pa.RecordBatch, text: str, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``size`` bytes of text each."""
    n = batch.num_rows
    if n == 0:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(lengths)
    cut = np.flatnonzero(np.diff(total // size)) + 1
    for a, b in zip([0, *cut], [*cut, n], strict=True):
        yield batch.slice(a, b - a)


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and the number of words before each text (and in all)."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = _NOT_SPACE[data]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    first = offsets[:-1][offsets[:-1] < len(data)]
    start[first] = inside[first]
    end = inside.copy()
    end[:-1] &= ~inside[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    end[last] = inside[last]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offsets)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table=PLAIN) -> np.ndarray:
    """A hash of each span of bytes; ``table`` maps bytes to what is hashed. Spans may be empty."""
    out = np.zeros(len(starts), dtype=np.uint64)
    lengths = ends - starts
    total = np.cumsum(lengths)
    cut = np.flatnonzero(np.diff(total // SEGMENT)) + 1
    for a, b in zip([0, *cut], [*cut, len(starts)], strict=True):
        n = lengths[a:b]
        if b <= a or not n.sum():
            continue
        before = np.cumsum(n) - n
        place = np.arange(n.sum()) - np.repeat(before, n)
        values = table[data[np.repeat(starts[a:b], n) + place]]
        values = values * _powers(_BASE, int(n.max()))[place]
        some = n > 0
        out[a:b][some] = np.add.reduceat(values, before[some])
    return mix(out + lengths.astype(np.uint64))


def sequence_hashes(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """A hash of each run of hashes; run i ends where run i + 1 begins, no run is empty."""
    if not len(firsts):
        return np.zeros(0, np.uint64)
    n = np.diff(np.append(firsts, len(values)))
    place = np.arange(len(values)) - np.repeat(firsts, n)
    summed = np.add.reduceat(values * _powers(_STEP, int(n.max()))[place], firsts)
    return mix(summed + n.astype(np.uint64))


def windows(values: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of ``width`` consecutive hashes."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for k, power in enumerate(_powers(_STEP, width)):
        out += values[k : k + n] * power
    return mix(out + np.uint64(width))


def shingle_sets(column: pa.Array, width: int = 5) -> Iterator[np.ndarray]:
    """Per text the sorted distinct shingles of its words, A-Z lower-cased.

    A text of fewer words has one shingle, the whole sequence; without words it has none.
    """
    data, offsets = utf8(column)
    starts, ends, first = spans(data, offsets)
    words = hashes(data, starts, ends, LOWER)
    rolled = windows(words, width)
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= width:
            yield np.unique(rolled[a : b - width + 1])
        elif b > a:
            yield sequence_hashes(words[a:b], np.zeros(1, np.int64))
        else:
            yield np.zeros(0, np.uint64)


def signed(values: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark longs."""
    return values.view(np.int64)
