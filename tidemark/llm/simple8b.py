"""Simple-8b: many small numbers in 64-bit words.

The top four bits of a word are its selector: how many numbers it holds and how many bits
each has. A word takes as many numbers as fit from where it starts. Numbers of more than
60 bits are escaped: the word only marks the place, and the number itself stands whole at
the end of the block. Numbers are coded in blocks of ``BLOCK``, each found by its offset
and decoded by itself; all words of one selector are decoded together.
"""

from __future__ import annotations

import numpy as np

#: Numbers in a word and bits of each, by selector.
SELECTORS = (
    (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8),
    (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60),
)
ESCAPE = 15
BLOCK = 4096
_LONGEST = SELECTORS[0][0]


def _bit_lengths(values: np.ndarray) -> np.ndarray:
    """Bits needed by each number, 61 if more than 60; zero takes one."""
    limits = np.array([1 << b for b in range(1, 61)], dtype=np.uint64)
    return (np.searchsorted(limits, values, side="right") + 1).astype(np.uint8)


def _choose(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Selector and count of a word that starts at each place; rows are blocks."""
    count = np.ones(bits.shape, dtype=np.uint8)
    selector = np.where(bits > 60, ESCAPE, len(SELECTORS) - 1).astype(np.uint8)
    widest = {1: bits}
    size = 1
    while size * 2 <= _LONGEST:
        half = widest[size]
        both = half.copy()
        np.maximum(half[:, :-size], half[:, size:], out=both[:, :-size])
        size *= 2
        widest[size] = both
    for k in range(len(SELECTORS) - 2, -1, -1):
        n, width = SELECTORS[k]
        part = 1 << (n.bit_length() - 1)
        most = widest[part].copy()
        if n > part:
            shift = n - part
            np.maximum(most[:, :-shift], widest[part][:, shift:], out=most[:, :-shift])
        fits = most <= width
        if not fits.any():
            break
        count[fits], selector[fits] = n, k
    return selector, count


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of all blocks, and per block ``(words, escaped, numbers)``; empty for no numbers."""
    values = np.ascontiguousarray(values, dtype=np.uint64)
    blocks = -(-len(values) // BLOCK)
    numbers = np.full(blocks, BLOCK, dtype=np.int64)
    if blocks:
        numbers[-1] = len(values) - BLOCK * (blocks - 1)
    padded = np.zeros((blocks, BLOCK + _LONGEST), dtype=np.uint64)
    full = np.zeros(blocks * BLOCK, dtype=np.uint64)
    full[: len(values)] = values
    padded[:, :BLOCK] = full.reshape(blocks, BLOCK)
    bits = _bit_lengths(padded.reshape(-1)).reshape(padded.shape)
    selector, count = _choose(bits)

    row = np.arange(blocks)
    at = np.zeros(blocks, dtype=np.int64)
    steps = []
    while len(row):
        steps.append((row, at))
        at = at + count[row, at]
        more = at < numbers[row]
        row, at = row[more], at[more]
    if not steps:
        return np.zeros(0, dtype="<u8"), np.zeros((0, 3), dtype="<i8")
    rows = np.concatenate([r for r, _ in steps])
    places = np.concatenate([a for _, a in steps])
    order = np.lexsort((places, rows))
    rows, places = rows[order], places[order]

    chosen = selector[rows, places]
    words = chosen.astype(np.uint64) << np.uint64(60)
    flat, base = padded.reshape(-1), rows * padded.shape[1] + places
    for k, (n, width) in enumerate(SELECTORS):
        here = np.flatnonzero(chosen == k)
        if len(here):
            packed, start = words[here], base[here]
            for j in range(n):
                packed |= flat[start + j] << np.uint64(j * width)
            words[here] = packed
    escaped = chosen == ESCAPE
    table = np.zeros((blocks, 3), dtype="<i8")
    table[:, 0] = np.bincount(rows, minlength=blocks)
    table[:, 1] = np.bincount(rows[escaped], minlength=blocks)
    table[:, 2] = numbers
    if not escaped.any():
        return words.astype("<u8"), table
    tail_rows, tail = rows[escaped], flat[base[escaped]]
    mixed = np.concatenate([words, tail])
    kind = np.concatenate([np.zeros(len(words), np.int8), np.ones(len(tail), np.int8)])
    owner = np.concatenate([rows, tail_rows])
    return mixed[np.lexsort((kind, owner))].astype("<u8"), table


def decode(words: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The numbers of consecutive blocks, from their words and their part of the table."""
    words = np.ascontiguousarray(words, dtype=np.uint64)
    if not len(table):
        return np.zeros(0, dtype=np.uint64)
    sizes = table[:, 0] + table[:, 1]
    owner = np.repeat(np.arange(len(table)), sizes)
    inside = np.arange(len(words)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    is_tail = inside >= table[owner, 0]
    packed, tail = words[~is_tail], words[is_tail]
    owner = owner[~is_tail]
    chosen = (packed >> np.uint64(60)).astype(np.int64)
    counts = np.ones(16, dtype=np.int64)
    counts[: len(SELECTORS)] = [n for n, _ in SELECTORS]
    held = counts[chosen]
    ends = np.cumsum(held)
    starts = ends - held
    out = np.zeros(int(ends[-1]), dtype=np.uint64)
    for k, (n, width) in enumerate(SELECTORS):
        here = np.flatnonzero(chosen == k)
        if len(here):
            word, start, mask = packed[here], starts[here], np.uint64((1 << width) - 1)
            for j in range(n):
                out[start + j] = (word >> np.uint64(j * width)) & mask
    out[starts[chosen == ESCAPE]] = tail
    per_block = np.bincount(owner, weights=held, minlength=len(table)).astype(np.int64)
    block_start = np.cumsum(per_block) - per_block
    if (per_block == table[:, 2]).all():
        return out
    place = np.arange(len(out)) - np.repeat(block_start, per_block)
    return out[place < np.repeat(table[:, 2], per_block)]
