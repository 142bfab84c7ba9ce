"""Simple-8b coding of whole numbers in 64-bit words, in blocks that decode on their own.

A word has a 4-bit selector at the top and 60 bits of values, the first one lowest:

selector   0     1  2  3  4  5  6  7  8 9 10 11 12 13 14 15
values     1   120 60 30 20 15 12 10  8 7  6  5  4  3  2  1
bits       -     0  1  2  3  4  5  6  7 8 10 12 15 20 30 60

Selector 0 is an escape: the rest of the word is a place in the block's list of raw 64-bit values, so that
the words can be taken apart without knowing the ones before. A block has at most ``BLOCK``
values; its last word may be part empty. All numbers are little-endian.
"""

from __future__ import annotations

import numpy as np

BLOCK = 8192
COUNTS = np.array([1, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([64, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
_PAD = 120
#: Lengths of runs, each with that of the two overlapping runs it is made of.
_RUNS = [(2, 1), (3, 2), (4, 2), (5, 4), (6, 4), (7, 4), (8, 4), (10, 8), (12, 8), (15, 8), (20, 12), (30, 15), (60, 30), (120, 60)]


def _widths(values: np.ndarray) -> np.ndarray:
    """Bits that each value needs."""
    top = values >> np.uint64(32)
    low = np.where(top > 0, top, values).astype(np.float64)
    return (np.frexp(low)[1] + np.where(top > 0, 32, 0)).astype(np.uint8)


def encode(values: np.ndarray) -> list[tuple[int, bytes, bytes]]:
    """(number of values, words, escaped values) of each block."""
    n_blocks = -(-len(values) // BLOCK)
    if not n_blocks:
        return []
    grid = np.zeros((n_blocks, BLOCK + _PAD), np.uint64)
    left = np.pad(values.astype(np.uint64), (0, n_blocks * BLOCK - len(values)))
    grid[:, :BLOCK] = left.reshape(n_blocks, BLOCK)
    size = np.full(n_blocks, BLOCK)
    size[-1] = len(values) - (n_blocks - 1) * BLOCK
    widths = _widths(grid)
    widths[:, BLOCK:] = 0
    # The widest of the next values, for as many as each selector holds; each from two shorter runs.
    widest = {1: widths}
    for n, part in _RUNS:
        longer = widest[part].copy()
        longer[:, : part - n] = np.maximum(widest[part][:, : part - n], widest[part][:, n - part :])
        widest[n] = longer
    choice = np.zeros(grid.shape, np.uint8)
    for selector in range(15, 0, -1):  # the last that fits has the most values
        choice[widest[COUNTS[selector]] <= BITS[selector]] = selector
    choice[:, BLOCK:] = 1
    # All blocks step from word to word together.
    rows, at, found = np.arange(n_blocks), np.zeros(n_blocks, np.int64), []
    while len(rows):
        found.append((rows, at))
        at = at + COUNTS[choice[rows, at]]
        more = at < size[rows]
        rows, at = rows[more], at[more]
    rows = np.concatenate([f[0] for f in found])
    at = np.concatenate([f[1] for f in found])
    order = np.argsort(rows, kind="stable")
    rows, at = rows[order], at[order]
    selectors = choice[rows, at]
    words = selectors.astype(np.uint64) << np.uint64(60)
    flat, base = grid.ravel(), rows * (BLOCK + _PAD) + at
    for selector in np.unique(selectors):
        if BITS[selector] == 0:
            continue
        here = np.flatnonzero(selectors == selector)
        if selector == 0:
            before = np.searchsorted(rows[here], rows[here])
            words[here] |= (np.arange(len(here)) - before).astype(np.uint64)
            continue
        for k in range(COUNTS[selector]):
            words[here] |= flat[base[here] + k] << np.uint64(k * BITS[selector])
    cut = np.searchsorted(rows, np.arange(n_blocks + 1))
    raw = selectors == 0
    return [
        (int(size[b]), words[a:z].tobytes(), flat[base[a:z][raw[a:z]]].tobytes())
        for b, (a, z) in enumerate(zip(cut[:-1], cut[1:], strict=True))
    ]


def decode(blocks: list[tuple[int, bytes, bytes]]) -> np.ndarray:
    """The values of some blocks."""
    if not blocks:
        return np.zeros(0, np.uint64)
    sizes = np.array([b[0] for b in blocks])
    n_words = np.array([len(b[1]) // 8 for b in blocks])
    words = np.frombuffer(b"".join(b[1] for b in blocks), "<u8")
    escaped = np.frombuffer(b"".join(b[2] for b in blocks), "<u8")
    n_escaped = np.array([len(b[2]) // 8 for b in blocks])
    block = np.repeat(np.arange(len(blocks)), n_words)
    selectors = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[selectors]
    total = np.cumsum(counts) - counts
    start = total - total[(np.cumsum(n_words) - n_words)[block]] + block * (BLOCK + _PAD)
    out = np.zeros(len(blocks) * (BLOCK + _PAD), np.uint64)
    payload = words & np.uint64((1 << 60) - 1)
    for selector in np.unique(selectors):
        here = np.flatnonzero(selectors == selector)
        if selector == 0:
            first = np.cumsum(n_escaped) - n_escaped
            out[start[here]] = escaped[first[block[here]] + payload[here].astype(np.int64)]
            continue
        bits = int(BITS[selector])
        mask = np.uint64((1 << bits) - 1)
        for k in range(COUNTS[selector] if bits else 0):
            out[start[here] + k] = (payload[here] >> np.uint64(k * bits)) & mask
    grid = out.reshape(len(blocks), BLOCK + _PAD)
    if len(blocks) and (sizes[:-1] == BLOCK).all():
        return np.concatenate([grid[:-1, :BLOCK].ravel(), grid[-1, : sizes[-1]]])
    return np.concatenate([row[:n] for row, n in zip(grid, sizes, strict=True)])
