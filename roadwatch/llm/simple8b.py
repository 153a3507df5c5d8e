"""Simple-8b: whole numbers packed into 64-bit words.

The top four bits of a word select how many numbers of how many bits the other
sixty hold. Selector 0 is the escape: its number is too wide for any other and
lies, raw, in a list of its own, in order. Selector 1 is a run of zeros.
Every block of ``BLOCK`` numbers begins with a word of its own, and the word
count up to each block's end is kept, so blocks are coded and decoded side by
side: step k of all blocks is one numpy operation.
"""

from __future__ import annotations

import numpy as np

from .common import ship

ship(__name__)

BLOCK = 512
# Fixed values of the format: numbers per word and bits per number, by selector.
COUNTS = np.array([1, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([64, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])


def _fits_all(fits: np.ndarray, count: int) -> np.ndarray:
    """Where ``count`` numbers in a row fit; by doubling."""
    span, window = 1, fits
    while span < count:
        step = min(span, count - span)
        window = window[:, :-step] & window[:, step:]
        span += step
    return window


_SMALL = np.frexp(np.arange(1 << 18).astype(np.float64))[1].astype(np.uint8)


def _bit_lengths(values: np.ndarray) -> np.ndarray:
    if values.max(initial=0) < len(_SMALL):
        return _SMALL[values.astype(np.uint32)]
    high = (values >> np.uint64(32)).astype(np.float64)
    low = (values & np.uint64(0xFFFFFFFF)).astype(np.float64)
    return np.where(high > 0, np.frexp(high)[1] + 32, np.frexp(low)[1]).astype(np.uint8)


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, words up to each block's end, escaped numbers)."""
    values = np.ascontiguousarray(values, dtype=np.uint64)
    blocks = -(-len(values) // BLOCK)
    if not blocks:
        return np.empty(0, np.uint64), np.empty(0, np.int32), np.empty(0, np.uint64)
    pad = int(COUNTS.max())
    grid = np.zeros((blocks, BLOCK + pad), np.uint64)
    flat = np.zeros(blocks * BLOCK, np.uint64)
    flat[:len(values)] = values
    grid[:, :BLOCK] = flat.reshape(blocks, BLOCK)
    ends = np.full(blocks, BLOCK)
    ends[-1] = len(values) - (blocks - 1) * BLOCK

    # The selector with the most numbers per word, at every position.
    need = _bit_lengths(grid)
    choice = np.zeros((blocks, BLOCK), np.uint8)
    for selector in range(15, 0, -1):
        fits = need <= BITS[selector]
        if selector > 1 and fits.all() and BITS[selector] > need.max():
            choice[:] = selector
            continue
        share = np.count_nonzero(fits[:, :BLOCK]) / choice.size
        if share ** int(COUNTS[selector]) * choice.size < 1:
            continue  # hardly any word would use it; a selector of fewer numbers does
        good = _fits_all(fits, int(COUNTS[selector]))[:, :BLOCK]
        np.copyto(choice, np.uint8(selector), where=good)

    # Where words start: step by step, for all blocks that still go on.
    rows, at, steps = np.arange(blocks), np.zeros(blocks, np.int64), []
    counts = COUNTS[choice]
    while len(rows):
        step = np.full(blocks, -1)
        step[rows] = at
        steps.append(step)
        at = at + counts[rows, at]
        going = at < ends[rows]
        if not going.all():
            rows, at = rows[going], at[going]
    by_block = np.stack(steps, axis=1)
    word_rows, place = np.nonzero(by_block >= 0)
    word_at = by_block[word_rows, place]
    selectors = choice[word_rows, word_at]
    words = selectors.astype(np.uint64) << np.uint64(60)
    for selector in np.unique(selectors):
        if selector in (0, 1):
            continue
        mine = np.flatnonzero(selectors == selector)
        places = word_rows[mine] * grid.shape[1] + word_at[mine]
        packed = np.zeros(len(mine), np.uint64)
        for i in range(COUNTS[selector]):
            packed |= grid.ravel()[places + i] << np.uint64(i * BITS[selector])
        words[mine] |= packed
    escaped = selectors == 0
    ends_of_blocks = np.cumsum(np.bincount(word_rows, minlength=blocks)).astype(np.int32)
    return words, ends_of_blocks, grid[word_rows[escaped], word_at[escaped]]


def decode(words: np.ndarray, block_ends: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` numbers that were encoded."""
    if not n:
        return np.empty(0, np.uint64)
    selectors = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[selectors]
    blocks = len(block_ends)
    first = np.concatenate([[0], block_ends[:-1]]).astype(np.int64)
    rows = np.repeat(np.arange(blocks), block_ends - first)
    before = np.cumsum(counts) - counts
    at = before - before[first][rows]
    grid = np.zeros((blocks, BLOCK + int(COUNTS.max())), np.uint64)
    flat = grid.ravel()
    for selector in np.unique(selectors):
        mine = np.flatnonzero(selectors == selector)
        places = rows[mine] * grid.shape[1] + at[mine]
        if selector == 0:
            flat[places] = escapes
        elif selector > 1:
            bits, body = np.uint64(BITS[selector]), words[mine]
            mask = (np.uint64(1) << bits) - np.uint64(1)
            for i in range(COUNTS[selector]):
                flat[places + i] = (body >> (np.uint64(i) * bits)) & mask
    return grid[:, :BLOCK].reshape(-1)[:n]
